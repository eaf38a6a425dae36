"""SCD2 edge cases (one per decision D2, D3, D4, D8) and interval building."""

import datetime as dt

import pytest

from starloom.operators.scd2 import (
    apply_scd2,
    interval_violations,
    intervals_from_changelog,
    scd2_changes,
    scd2_summary,
)

D = dt.date
EMP = "employee_id long, name string"
HIST = ("history_id long, employee_id long, role string, salary int, "
        "effective_start date, effective_end date, is_current boolean")
DIM = ("employee_key long, employee_id long, name string, role string, is_current boolean, "
       "effective_start date, effective_end date")


def _run(spark, employees, history, dim):
    emp = spark.createDataFrame(employees, EMP)
    hist = spark.createDataFrame(history, HIST)
    d = spark.createDataFrame(dim, DIM)
    changes = scd2_changes(emp, hist, d)
    return changes, apply_scd2(d, changes)


def _actions(changes):
    return {r["employee_id"]: r["action"] for r in changes.collect()}


def test_new_employee_is_inserted(spark):
    changes, after = _run(spark, [(1, "Ann")], [(1, 1, "A", 10, D(2020, 1, 1), None, True)], [])
    assert _actions(changes) == {1: "insert"}
    rows = after.collect()
    assert len(rows) == 1 and rows[0]["employee_key"] == 1 and rows[0]["is_current"]
    s = scd2_summary(changes).first()
    assert (s["inserted"], s["closed"]) == (1, 0)


def test_unchanged_is_idempotent(spark):
    changes, after = _run(
        spark, [(1, "Ann")], [(1, 1, "A", 10, D(2020, 1, 1), None, True)],
        [(5, 1, "Ann", "A", True, D(2020, 1, 1), None)],
    )
    assert _actions(changes) == {1: "skip"}
    assert [tuple(r) for r in after.collect()] == [(5, 1, "Ann", "A", True, D(2020, 1, 1), None)]


def test_promotion_closes_and_inserts(spark):
    changes, after = _run(
        spark, [(2, "Bo")], [(9, 2, "Manager", 20, D(2024, 1, 2), None, True)],
        [(7, 2, "Bo", "Rep", True, D(2020, 1, 1), None)],
    )
    assert _actions(changes) == {2: "close_insert"}
    rows = sorted((tuple(r) for r in after.collect()))
    assert rows == [
        (7, 2, "Bo", "Rep", False, D(2020, 1, 1), D(2024, 1, 1)),
        (8, 2, "Bo", "Manager", True, D(2024, 1, 2), None),
    ]


def test_salary_only_change_is_skipped(spark):
    changes, _ = _run(
        spark, [(3, "Cy")], [(1, 3, "A", 99, D(2020, 1, 1), None, True)],
        [(1, 3, "Cy", "A", True, D(2020, 1, 1), None)],
    )
    assert _actions(changes) == {3: "skip"}


def test_rename_with_same_start_is_rejected(spark):
    changes, after = _run(
        spark, [(4, "Dee New")], [(1, 4, "A", 10, D(2020, 1, 1), None, True)],
        [(1, 4, "Dee", "A", True, D(2020, 1, 1), None)],
    )
    row = changes.first()
    assert row["action"] == "reject" and "before" in row["reason"]
    assert [tuple(r) for r in after.collect()] == [(1, 4, "Dee", "A", True, D(2020, 1, 1), None)]


def test_two_current_rows_close_the_smallest_key(spark):
    changes, after = _run(
        spark, [(3, "Cy")], [(1, 3, "B", 10, D(2023, 1, 1), None, True)],
        [(4, 3, "Cy", "A", True, D(2020, 1, 1), None), (6, 3, "Cy", "A", True, D(2021, 1, 1), None)],
    )
    assert changes.first()["employee_key"] == 4
    current = sorted(r["employee_key"] for r in after.collect() if r["is_current"])
    assert current == [6, 7]


def test_employee_gone_from_source_is_untouched(spark):
    changes, after = _run(spark, [], [], [(1, 9, "Zed", "A", True, D(2020, 1, 1), None)])
    assert changes.count() == 0
    assert [tuple(r) for r in after.collect()] == [(1, 9, "Zed", "A", True, D(2020, 1, 1), None)]


def test_changelog_to_intervals_collapses_same_day(spark):
    log = spark.createDataFrame(
        [(1, 1, "A", D(2020, 1, 1)), (2, 1, "B", D(2020, 1, 1)), (3, 1, "C", D(2020, 3, 1)),
         (4, 2, "X", D(2021, 5, 5))],
        "change_id long, employee_id long, role string, effective_start date",
    )
    rows = sorted(
        (r["employee_id"], r["role"], r["effective_start"], r["effective_end"], r["is_current"])
        for r in intervals_from_changelog(
            log, "employee_id", "effective_start", ["change_id"], ["role"]
        ).collect()
    )
    assert rows == [
        (1, "B", D(2020, 1, 1), D(2020, 2, 29), False),
        (1, "C", D(2020, 3, 1), None, True),
        (2, "X", D(2021, 5, 5), None, True),
    ]


def test_interval_violations(spark):
    v = spark.createDataFrame(
        [(1, D(2020, 1, 1), D(2020, 6, 30)), (1, D(2020, 6, 30), None),
         (2, D(2020, 1, 1), D(2020, 1, 31)), (2, D(2020, 3, 1), None),
         (3, D(2020, 1, 1), None), (3, D(2021, 1, 1), None)],
        "employee_id long, effective_start date, effective_end date",
    )
    got = sorted((r["entity_id"], r["problem"], r["row_count"])
                 for r in interval_violations(v, "employee_id").collect())
    assert got == [(1, "overlap", 1), (2, "gap", 1), (3, "overlap", 1), (3, "several_open", 2)]


def test_interval_copies_are_counted_not_expanded(spark):
    rows = [(7, D(2020, 1, 1), D(2020, 12, 31))] * 5 + [(7, D(2020, 6, 1), None)]
    v = spark.createDataFrame(rows, "employee_id long, effective_start date, effective_end date")
    got = sorted((r["problem"], r["effective_start"], r["row_count"])
                 for r in interval_violations(v, "employee_id").collect())
    # four copies overlap the first; the later open version overlaps them all
    assert got == [("overlap", D(2020, 1, 1), 4), ("overlap", D(2020, 6, 1), 1)]


@pytest.mark.parametrize("runs", [2])
def test_apply_is_idempotent_on_rerun(spark, runs):
    emp = spark.createDataFrame([(1, "Ann"), (2, "Bo")], EMP)
    hist = spark.createDataFrame(
        [(1, 1, "A", 10, D(2020, 1, 1), None, True), (2, 2, "B", 10, D(2021, 1, 1), None, True)],
        HIST,
    )
    dim = spark.createDataFrame([], DIM)
    for _ in range(runs):
        changes = scd2_changes(emp, hist, dim)
        dim = spark.createDataFrame(apply_scd2(dim, changes).collect(), DIM)
    assert scd2_summary(changes).first()["inserted"] == 0
    assert dim.count() == 2
