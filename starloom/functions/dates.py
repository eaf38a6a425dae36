"""Calendar expressions (the warehouse keeps every time value as a DATE)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date_literal(value: dt.date | str) -> Column:
    """A DATE literal from a ``date`` or an ISO string."""
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def date_key_of(value: dt.date) -> int:
    """YYYYMMDD integer of a Python date (used for the snapshot parameter)."""
    return value.year * 10000 + value.month * 100 + value.day


def date_key(c: ColumnOrName) -> Column:
    """YYYYMMDD integer key of a date column."""
    d = _col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(c: ColumnOrName) -> list[Column]:
    """``date_key, full_date, month, quarter, year`` for a date column."""
    d = _col(c)
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
    ]


def month_label(c: ColumnOrName) -> Column:
    """``yyyy-MM`` label of a date."""
    return F.date_format(_col(c), "yyyy-MM")


def month_start(year: ColumnOrName, month: ColumnOrName) -> Column:
    return F.make_date(_col(year), _col(month), F.lit(1))


def month_end(year: ColumnOrName, month: ColumnOrName) -> Column:
    return F.last_day(month_start(year, month))
