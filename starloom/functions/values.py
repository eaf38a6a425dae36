"""Value conversions and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions.dates import ColumnOrName, _col


def yes_no_flag(c: ColumnOrName) -> Column:
    """Case-insensitive ``'yes'`` test; anything else, NULL included, is false."""
    return F.coalesce(F.lower(_col(c)) == F.lit("yes"), F.lit(False))


def money(c: ColumnOrName, precision: int = 12) -> Column:
    """Round to cents, half away from zero (the cast rounds HALF_UP)."""
    return _col(c).cast(f"decimal({precision},2)")


def tenure_days(as_of: Column, hire_date: ColumnOrName) -> Column:
    """Days from hire to the snapshot, never negative; NULL hire stays NULL."""
    hire = _col(hire_date)
    return F.when(hire.isNull(), F.lit(None).cast("int")).otherwise(
        F.greatest(F.datediff(as_of, hire), F.lit(0))
    )


def period_label(start: ColumnOrName, end: ColumnOrName) -> Column:
    """``start → end``, or ``start → present`` for an open version."""
    return F.concat(
        _col(start).cast("string"),
        F.lit(" → "),
        F.coalesce(_col(end).cast("string"), F.lit("present")),
    )


def employee_label(name: ColumnOrName, role: ColumnOrName) -> Column:
    """``name (role)`` picklist label."""
    return F.concat(_col(name), F.lit(" ("), _col(role), F.lit(")"))


def conformed(c: ColumnOrName, collation: str | None = None) -> Column:
    """A name compared under ``collation`` (e.g. ``UNICODE_CI_AI_RTRIM`` for
    case-, accent- and trailing-blank-insensitive matching); binary if None."""
    col = _col(c)
    return F.collate(col, collation) if collation else col
