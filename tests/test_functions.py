import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from starloom.functions import (
    calendar_columns,
    date_key,
    employee_label,
    money,
    period_label,
    tenure_days,
    yes_no_flag,
)
from starloom.functions.dates import as_date_literal, month_end, month_label, month_start


def test_date_key_and_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 11, 5),)], "d date")
    row = df.select(*calendar_columns("d")).first()
    assert row["date_key"] == 20241105
    assert (row["month"], row["quarter"], row["year"]) == (11, 4, 2024)
    assert df.select(date_key("d")).first()[0] == 20241105


def test_month_helpers(spark):
    row = spark.range(1).select(
        month_label(month_start(F.lit(2024), F.lit(2))).alias("label"),
        month_end(F.lit(2024), F.lit(2)).alias("end"),
    ).first()
    assert row["label"] == "2024-02"
    assert row["end"] == dt.date(2024, 2, 29)


def test_yes_no_is_case_insensitive_and_null_false(spark):
    df = spark.createDataFrame([("Yes",), ("YES",), ("yes",), ("No",), (None,)], "a string")
    assert [r[0] for r in df.select(yes_no_flag("a")).collect()] == [True, True, True, False, False]


def test_money_rounds_half_up(spark):
    df = spark.createDataFrame([(2.675,), (1.005,), (133830.675,), (-2.675,)], "x double")
    got = [r[0] for r in df.select(money("x")).collect()]
    assert got == [Decimal("2.68"), Decimal("1.01"), Decimal("133830.68"), Decimal("-2.68")]


def test_tenure_clamps_future_hires_and_keeps_null(spark):
    df = spark.createDataFrame(
        [(dt.date(2020, 1, 1),), (dt.date(2024, 3, 1),), (None,)], "h date"
    )
    got = [r[0] for r in df.select(tenure_days(as_date_literal("2024-01-01"), "h")).collect()]
    assert got == [1461, 0, None]


def test_labels(spark):
    df = spark.createDataFrame(
        [(dt.date(2020, 1, 1), dt.date(2021, 1, 1)), (dt.date(2021, 1, 2), None)], "s date, e date"
    )
    assert [r[0] for r in df.select(period_label("s", "e")).collect()] == [
        "2020-01-01 → 2021-01-01",
        "2021-01-02 → present",
    ]
    row = spark.range(1).select(employee_label(F.lit("Ann Lee"), F.lit("Manager"))).first()
    assert row[0] == "Ann Lee (Manager)"
