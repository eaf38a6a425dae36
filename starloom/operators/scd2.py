"""Slowly changing dimension, Type 2 (H1, H2, D-SCD2, L4).

* ``intervals_from_changelog``: a log of dated changes -> non-overlapping
  versions (end = next start - 1 day, the last one open and current).
* ``interval_violations``: overlap / gap / several-open checks on versions.
* ``scd2_changes``: compare current source versions with the current
  dimension rows and classify each entity (insert, close+insert, skip,
  reject).
* ``apply_scd2``: the complete next version of the dimension.

Windows run over rows already collapsed to one per entity and day, so their
size is bounded by the calendar, not by the data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.dedup import keep_last
from starloom.operators.keys import assign_dense_keys, next_key_base

OPEN_END = "9999-12-31"
TRACKED_COLUMNS = ("name", "role", "effective_start")


def intervals_from_changelog(
    changes: DataFrame,
    key: str,
    start_col: str,
    tie_breakers: Sequence[str],
    value_cols: Sequence[str],
) -> DataFrame:
    """Dated change log -> SCD2 versions.

    Several changes of one entity on one day collapse to the one that is
    largest by ``tie_breakers``.  Output: ``key, start_col, tie_breakers...,
    value_cols..., effective_end, is_current``.
    """
    tie_breakers = list(tie_breakers)
    # duplicates of one entity and day are combined map-side before any shuffle
    # (a burst of copies never lands whole in one task); what the window sees is
    # at most one row per entity and calendar day
    day = keep_last(
        changes.select(key, start_col, *tie_breakers, *value_cols), [key, start_col], tie_breakers
    )
    following = F.lead(start_col).over(Window.partitionBy(key).orderBy(start_col))
    return day.withColumn("_next", following).withColumns(
        {"effective_end": F.date_sub("_next", 1), "is_current": F.col("_next").isNull()}
    ).drop("_next")


def interval_violations(
    versions: DataFrame,
    key: str,
    start_col: str = "effective_start",
    end_col: str = "effective_end",
    table: str = "employee_history",
) -> DataFrame:
    """Overlaps, gaps and several open versions per key (H2).

    Output: ``table_name, entity_id, problem, effective_start, effective_end,
    row_count``: one row per distinct violating interval, with how many rows
    have it.  Versions are taken in ``(start, end)`` order (open ends first
    within a day, as NULLs sort); an open end counts as the far future; a
    version overlaps when it starts on or before the latest end of the
    versions before it, and leaves a gap when it starts later than the day
    after it.

    Identical intervals are first collapsed into counts (a partial aggregate).
    One window per key then carries the latest end over the key's distinct
    intervals, whose number the calendar bounds, and counts its open versions:
    one scan, one shuffle for the counts and one by key, no join.
    """
    end_or_open = F.coalesce(F.col(end_col), F.lit(OPEN_END).cast("date"))
    groups = versions.groupBy(key, start_col, end_col).agg(F.count(F.lit(1)).alias("_n"))
    in_order = Window.partitionBy(key).orderBy(F.col(start_col), F.col(end_col).asc_nulls_first())
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    is_open = F.when(F.col(end_col).isNull(), F.col("_n")).otherwise(0)
    rows = groups.select(
        key, start_col, end_col, "_n", end_or_open.alias("_e"), F.max(end_or_open).over(earlier).alias("_before"),
        F.sum(is_open).over(whole).alias("_open"), F.row_number().over(in_order).alias("_at"))

    def problem(prior):
        return (
            F.when(prior >= F.col(start_col), F.lit("overlap"))
            .when(F.date_add(prior, 1) < F.col(start_col), F.lit("gap"))
        )

    first = problem(F.col("_before"))              # the first row of a group
    copies = problem(F.greatest("_before", "_e"))  # its identical copies follow it
    alike = first.eqNullSafe(copies)

    def case(problem, start, end, n):
        return F.struct(problem.alias("problem"), start.alias("effective_start"), end.alias("effective_end"),
                        n.cast("long").alias("row_count"))

    day, until, none = F.col(start_col), F.col(end_col), F.lit(None).cast("date")
    cases = F.array(
        case(first, day, until, F.when(alike, F.col("_n")).otherwise(1)),
        case(copies, day, until, F.when(alike, 0).otherwise(F.col("_n") - 1)),
        case(F.when((F.col("_at") == 1) & (F.col("_open") > 1), F.lit("several_open")), none, none, F.col("_open")),
    )
    return (
        rows.select(F.col(key).alias("entity_id"), F.inline(cases))
        .where(F.col("problem").isNotNull() & (F.col("row_count") > 0))
        .select(F.lit(table).alias("table_name"), "entity_id", "problem", "effective_start", "effective_end", "row_count")
    )


def current_dimension_rows(dim: DataFrame) -> DataFrame:
    """First current dim row per employee by smallest key (D3)."""
    current = dim.where(F.col("is_current")).select(
        "employee_id", "employee_key", "name", "role", "effective_start"
    )
    packed = F.struct("employee_key", "name", "role", "effective_start")
    return current.groupBy("employee_id").agg(F.min(packed).alias("_d")).select(
        "employee_id",
        F.col("_d.employee_key").alias("dim_employee_key"),
        F.col("_d.name").alias("dim_name"),
        F.col("_d.role").alias("dim_role"),
        F.col("_d.effective_start").alias("dim_effective_start"),
    )


def scd2_changes(
    employees: DataFrame,
    history: DataFrame,
    dim: DataFrame,
    tracked: Sequence[str] = TRACKED_COLUMNS,
) -> DataFrame:
    """Classify every current source version against the current dim row.

    Output columns: ``employee_id, action, employee_key, name, role,
    effective_start, close_date, reason`` where ``action`` is

    * ``insert``: no current dim row; a new open version is added;
    * ``close_insert``: a tracked column changed; the dim row
      ``employee_key`` is closed on ``close_date`` (= new start - 1 day) and a
      new open version is added;
    * ``skip``: the tracked columns are equal (null-safe): nothing to do;
    * ``reject``: a change whose close date would precede the version it
      closes (D4), that has no start date, or that stands beside a later
      current source version of the same employee (of those the latest start,
      then the largest role, counts: a key is closed once); nothing is written,
      ``reason`` says why.

    Salary is not tracked: a salary change reaches the dimension only through
    the new ``effective_start`` it brings (D2).
    """
    version = F.struct("effective_start", "role")
    current = (
        history.where(F.col("is_current")).groupBy("employee_id")
        .agg(F.max(version).alias("_v"), F.count(F.lit(1)).alias("_n"))
    )
    staff = employees.groupBy("employee_id").agg(F.max("name").alias("name"))
    source = current.join(staff, "employee_id", "inner").select(
        "employee_id", "name", "_n", "_v.role", "_v.effective_start")
    compared = source.join(current_dimension_rows(dim), "employee_id", "left")

    same = F.lit(True)
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.col(f"dim_{c}"))
    close_date = F.date_sub(F.col("effective_start"), 1)
    action = (
        F.when(F.col("dim_employee_key").isNull(), F.lit("insert"))
        .when(same, F.lit("skip"))
        .when(F.col("effective_start").isNull(), F.lit("reject"))
        .when(close_date < F.col("dim_effective_start"), F.lit("reject"))
        .otherwise(F.lit("close_insert"))
    )
    classified = compared.select(
        "employee_id",
        action.alias("action"),
        F.col("dim_employee_key").alias("employee_key"),
        "name",
        "role",
        "effective_start",
        F.when(action.isin("close_insert", "reject"), close_date).alias("close_date"),
        F.when((action == "reject") & F.col("effective_start").isNull(), F.lit("no start date"))
        .when(action == "reject", F.lit("close date before the start of the version it closes"))
        .alias("reason"),
        "_n",
    )
    # further current source versions of one employee: one report row each employee
    plain = [F.col(c) for c in classified.columns if c != "_n"]
    extra = [
        {"action": F.lit("reject"), "employee_key": F.lit(None).cast("long"),
         "reason": F.concat((F.col("_n") - 1).cast("string"), F.lit(" further current source versions")),
         "role": F.lit(None).cast("string"), "effective_start": F.lit(None).cast("date"),
         "close_date": F.lit(None).cast("date")}.get(c, F.col(c)).alias(c)
        for c in classified.columns if c != "_n"
    ]
    row = F.struct(*plain)
    out = F.when(F.col("_n") > 1, F.array(row, F.struct(*extra))).otherwise(F.array(row))
    return classified.select(F.inline(out))


def apply_scd2(dim: DataFrame, changes: DataFrame, last_key: int | None = None) -> DataFrame:
    """Next complete version of the dimension: closed, kept and inserted rows.

    New versions get keys after ``last_key`` (default: the largest in ``dim``,
    which must then hold every version, closed ones too) (L5), in employee id
    order within the key buckets.
    """
    closes = changes.where(F.col("action") == "close_insert").select(
        F.col("employee_key").alias("_close_key"), F.col("close_date").alias("_close_date")
    )
    kept = dim.join(closes, dim["employee_key"] == closes["_close_key"], "left")
    matched = F.col("_close_key").isNotNull()
    kept = kept.select(
        "employee_key",
        "employee_id",
        "name",
        "role",
        F.when(matched, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
        "effective_start",
        F.when(matched, F.col("_close_date")).otherwise(F.col("effective_end")).alias(
            "effective_end"
        ),
    )
    inserts = changes.where(F.col("action").isin("insert", "close_insert")).select(
        "employee_id", "name", "role", "effective_start"
    )
    inserted = assign_dense_keys(
        inserts, ["employee_id", "effective_start"], "employee_key",
        next_key_base(dim, "employee_key") if last_key is None else last_key,
    ).select(
        "employee_key",
        "employee_id",
        "name",
        "role",
        F.lit(True).alias("is_current"),
        "effective_start",
        F.lit(None).cast("date").alias("effective_end"),
    )
    return kept.unionByName(inserted)


def scd2_backfill(
    dim: DataFrame, employees: DataFrame, history: DataFrame, as_of: dt.date, last_key: int | None = None
) -> DataFrame:
    """The dimension with every version that the source's history holds.

    The versions of an employee, the dimension's and the source's, are compared
    as whole sequences by their start day: a start that only the source has is
    inserted (closed or open); one that both have takes the source's role and
    end; one that only the dimension has stays.  No version outlasts the day
    before the next one's start; the last is open if the source (or, where the
    source has no such version, the dimension) leaves it open.  An employee who
    is no longer in ``employees`` has the open version closed on ``as_of``.

    Returns the dimension's columns and ``action``: ``insert``, ``update`` or
    ``keep``.  New versions get keys after ``last_key`` (default: the largest in
    ``dim``).  Done again on its own result it keeps every row.  Of several rows
    of one employee and day the dimension's smallest key, and the source's latest
    end, count; the dimension's others stay as they are.  A row without an
    employee or a start day stays as it is in the dimension and is left out of
    the source's.

    Sequences have one row per employee and calendar day, so the window does not
    grow with copies.
    """
    known = F.col("employee_id").isNotNull() & F.col("effective_start").isNotNull()
    days = ["employee_id", "effective_start"]
    end = F.coalesce(F.col("effective_end"), F.lit(OPEN_END).cast("date"))
    source = history.where(known).groupBy(*days).agg(F.max(F.struct(end.alias("end"), "role")).alias("_s"))
    staff = employees.groupBy("employee_id").agg(F.max("name").alias("_name"))
    source = source.join(staff, "employee_id", "inner").select(
        *days, "_name", F.col("_s.role").alias("_role"), F.col("_s.end").alias("_end"))
    packed = F.struct("employee_key", "name", "role", "is_current", "effective_end")
    first = dim.where(known).groupBy(*days).agg(F.min(packed).alias("_d"))
    spare = dim.where(~known).unionByName(
        dim.where(known).join(first.select("_d.employee_key"), "employee_key", "left_anti").select(dim.columns))

    both = first.join(source, days, "full_outer").join(
        staff.select("employee_id", F.lit(True).alias("_here")), "employee_id", "left")
    following = F.lead("effective_start").over(Window.partitionBy("employee_id").orderBy("effective_start"))
    own_end = F.coalesce(F.col("_d.effective_end"), F.lit(OPEN_END).cast("date"))
    both = both.withColumn("_until", F.least(F.coalesce("_end", own_end), F.date_sub(following, 1)))
    open_end = F.col("_until") == F.lit(OPEN_END).cast("date")
    gone = F.col("_here").isNull()
    closing = F.greatest(F.lit(as_of), F.col("effective_start"))
    rows = both.select(
        F.col("_d.employee_key").alias("employee_key"), "employee_id", F.coalesce("_d.name", "_name").alias("name"),
        F.coalesce("_role", "_d.role").alias("role"), (open_end & ~gone).alias("is_current"), "effective_start",
        F.when(~open_end, F.col("_until")).when(gone, closing).alias("effective_end"), "_d")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_d.{c}")) for c in ("role", "is_current", "effective_end")])
    rows = rows.withColumn("action", F.when(F.col("employee_key").isNull(), F.lit("insert"))
                           .when(same, F.lit("keep")).otherwise(F.lit("update"))).drop("_d")
    base = next_key_base(dim, "employee_key") if last_key is None else last_key
    inserted = assign_dense_keys(rows.where("action = 'insert'").drop("employee_key"), days, "employee_key", base,
                                 spread=True).select(rows.columns)
    return (rows.where("action <> 'insert'").unionByName(inserted)
            .unionByName(spare.withColumn("action", F.lit("keep"))))


def versions_at(rows: DataFrame, versions: DataFrame, date_col: str, key: str = "employee_id",
                surrogate: str = "employee_key") -> DataFrame:
    """``rows`` with ``surrogate`` of the version that covers ``date_col`` (NULL if none does).

    The version of a day is the one with the latest start on or before it (of
    one start day the largest surrogate); it covers the day unless it has ended
    before.  The rows are reduced to distinct keys and days, and the versions to
    one per key and start day, so the window that carries the latest start
    forward is bounded by the calendar, however many rows a key has.
    """
    days = rows.select(F.col(key), F.col(date_col).alias("_day")).where(
        F.col(key).isNotNull() & F.col("_day").isNotNull()).distinct()
    starts = versions.groupBy(key, F.col("effective_start").alias("_day")).agg(
        F.max(F.struct(surrogate, "effective_end")).alias("_v"))
    line = starts.withColumn("_asked", F.lit(0)).unionByName(
        days.withColumn("_asked", F.lit(1)), allowMissingColumns=True)
    so_far = Window.partitionBy(key).orderBy("_day", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    found = line.withColumn("_v", F.last("_v", ignorenulls=True).over(so_far)).where("_asked = 1")
    covers = F.col("_v.effective_end").isNull() | (F.col("_v.effective_end") >= F.col("_day"))
    found = found.select(F.col(key).alias("_key"), "_day", F.when(covers, F.col(f"_v.{surrogate}")).alias(surrogate))
    return rows.join(found, (F.col(key) == F.col("_key")) & (F.col(date_col) == F.col("_day")), "left").drop("_key", "_day")


def scd2_summary(changes: DataFrame) -> DataFrame:
    """One row: ``inserted, closed, skipped, rejected`` counts."""
    a = F.col("action")
    return changes.agg(
        F.count_if(a.isin("insert", "close_insert")).alias("inserted"),
        F.count_if(a == "close_insert").alias("closed"),
        F.count_if(a == "skip").alias("skipped"),
        F.count_if(a == "reject").alias("rejected"),
    )


def versions_of(dim: DataFrame, employee_id: int | None = None) -> DataFrame:
    """SCD2 verification view (R7): the versions of one employee, or all."""
    out = dim.select(
        "employee_key", "employee_id", "role", "is_current", "effective_start", "effective_end"
    )
    if employee_id is not None:
        out = out.where(F.col("employee_id") == F.lit(employee_id))
    return out
