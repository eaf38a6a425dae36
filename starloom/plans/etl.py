"""The whole load: extract -> dimensions -> SCD2 -> fact -> counts.

Jobs run only at the writes.  Every table is written as a new version and
read back before the next step uses it, which fixes the generated keys and
cuts the lineage (a lost executor recomputes from the last written table,
not from the sources).  Nothing is visible to readers until the end of the
run, when one manifest write publishes every new version together; a run
that fails half-way leaves the previous warehouse in place.  The change sets
(project upsert, SCD2) are kept as tables too: they are the audit of a run.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions.dates import date_key_of
from starloom.operators.clean import prepare_attrition
from starloom.operators.dims import build_dim_date, build_dim_department, build_dim_project
from starloom.operators.fact import (
    enriched_assignments,
    has_keys,
    rejects_from_enriched,
    require_snapshot_date,
)
from starloom.operators.keys import largest_key
from starloom.operators.load import (
    ACCEPTED,
    LAST_KEY,
    PublishConflict,
    claim_run,
    current_versions,
    new_dates,
    new_departments,
    publish,
    read_published,
    read_scd2_version,
    read_version,
    table_counts,
    upsert_dim_project,
    snapshot_entry,
    write_scd2_unpublished,
    write_snapshot_unpublished,
    write_unpublished,
)
from starloom.operators.scd2 import apply_scd2, scd2_backfill, scd2_changes
from starloom.sources.tables import TableSource, empty_frame, extract_all

STAR_TABLES = ("dim_date", "dim_department", "dim_project", "dim_employee",
               "fact_employee_performance")


#: Manifest entry: the largest employee_key given so far, in open or closed versions.
LAST_EMPLOYEE_KEY = f"dim_employee{LAST_KEY}"


@dataclass(frozen=True)
class LoadOptions:
    """Departures from the default load, all off.

    ``point_in_time`` (D20): the fact takes the employee version that covers the
    snapshot date, not the newest one; assignments of employees without such a
    version are rejected.  ``backfill`` (D8): ``dim_employee`` gets every version
    of the history, not only the current ones, and is rewritten whole.
    ``collation`` (D9): department and project names that it holds equal (e.g.
    ``UNICODE_CI_AI_RTRIM``) are one dimension row, in the spelling known first.
    """

    point_in_time: bool = False
    backfill: bool = False
    collation: str | None = None


class _Run:
    """One run: its number, what was published before it and what it wrote.

    All tables it writes carry the run's number as their version.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.number = claim_run(spark, root)
        self.before = current_versions(spark, root)
        self.written: dict[str, int] = {}

    def old(self, table: str, schema) -> DataFrame:
        return read_published(self.spark, self.root, table, schema, self.before)

    def write(self, df: DataFrame, table: str, schema, partition_by=None,
              allow_empty: bool = True) -> DataFrame:
        write_unpublished(df, self.root, table, self.number, partition_by, allow_empty)
        self.written[table] = self.number
        return read_version(self.spark, self.root, table, self.number, schema)


def run_etl(
    spark: SparkSession,
    source: TableSource,
    warehouse: str,
    as_of: dt.date,
    attrition_csv: str,
    full_refresh: bool = True,
    attempts: int = 3,
    options: LoadOptions | None = None,
) -> dict[str, int]:
    """Load one snapshot into the warehouse folder; returns the run's counts.

    ``options`` changes what is loaded (see there); the default loads as the
    operational databases' own job does.

    If another run publishes one of its tables meanwhile, the load is done anew
    on what that run published, ``attempts`` times in all; then
    ``PublishConflict`` is raised.  Nothing of an attempt before is published.

    ``full_refresh=True`` publishes a fact holding only this snapshot (the
    fact is replaced each run); ``False`` keeps the other published snapshots
    untouched and replaces only this snapshot.  An empty fact is never
    published.
    """
    for left in range(attempts - 1, -1, -1):
        try:
            return _load_once(spark, source, warehouse, as_of, attrition_csv, full_refresh, options or LoadOptions())
        except PublishConflict:
            if not left:
                raise
    raise ValueError("attempts must be at least 1")


def _load_once(spark: SparkSession, source: TableSource, warehouse: str, as_of: dt.date, attrition_csv: str,
               full_refresh: bool, options: LoadOptions) -> dict[str, int]:
    names = options.collation
    sc = spark.sparkContext

    def step(name: str) -> None:
        sc.setJobDescription(f"starloom etl: {name}")

    run = _Run(spark, warehouse)
    x = extract_all(spark, source, attrition_csv)
    employees = x["employees"]
    attrition = prepare_attrition(x["attrition_raw"])

    # The three reference dimensions and the SCD2 step depend on nothing but
    # the sources, so they run as concurrent jobs; the fact waits for all.
    def load_dates():
        # reference dimensions: append what is new (insert-if-absent)
        step("dim_date")
        old = run.old("dim_date", schemas.DIM_DATE)
        fresh = new_dates(build_dim_date(employees, x["assignments"], as_of), old)
        return run.write(old.unionByName(fresh), "dim_date", schemas.DIM_DATE), old

    def load_departments():
        step("dim_department")
        old = run.old("dim_department", schemas.DIM_DEPARTMENT)
        fresh = new_departments(build_dim_department(x["departments"], names), old, names)
        return run.write(old.unionByName(fresh), "dim_department", schemas.DIM_DEPARTMENT), old

    def load_projects():
        step("dim_project")
        old = run.old("dim_project", schemas.DIM_PROJECT)
        upsert = run.write(
            upsert_dim_project(build_dim_project(x["projects"], names), old, names),
            "dim_project_changes", schemas.DIM_PROJECT_CHANGES,
        )
        return run.write(upsert.drop("action"), "dim_project", schemas.DIM_PROJECT), upsert

    def load_employees():
        # SCD2: only the current rows take part in a run; the largest key ever
        # given is published with the dimension, so closed history is neither
        # read nor rewritten (read once for a dimension published without it)
        step("dim_employee scd2")
        before = run.before.get("dim_employee", 0)
        old_current = (
            read_scd2_version(spark, warehouse, "dim_employee", before, schemas.DIM_EMPLOYEE,
                              current_only=True)
            if before else empty_frame(spark, schemas.DIM_EMPLOYEE)
        )
        last_key = run.before.get(LAST_EMPLOYEE_KEY)
        if last_key is None:
            last_key = largest_key(run.old("dim_employee", schemas.DIM_EMPLOYEE), "employee_key")
        changes = run.write(
            scd2_changes(employees, x["employee_history"], old_current),
            "scd2_changes", schemas.SCD2_CHANGES,
        )
        run.written["dim_employee"] = run.number
        if options.backfill:
            whole = run.old("dim_employee", schemas.DIM_EMPLOYEE)
            after = scd2_backfill(whole, employees, x["employee_history"], as_of, last_key)
            write_scd2_unpublished(after.drop("action"), warehouse, "dim_employee", run.number)
            written = read_scd2_version(spark, warehouse, "dim_employee", run.number, schemas.DIM_EMPLOYEE,
                                        rewritten=True)
            run.written[LAST_EMPLOYEE_KEY] = max(last_key, largest_key(written, "employee_key"))
            return written, changes
        write_scd2_unpublished(apply_scd2(old_current, changes, last_key), warehouse, "dim_employee",
                               run.number)
        written = read_scd2_version(spark, warehouse, "dim_employee", run.number,
                                    schemas.DIM_EMPLOYEE, current_only=True)
        run.written[LAST_EMPLOYEE_KEY] = max(last_key, largest_key(written, "employee_key"))
        return read_version(spark, warehouse, "dim_employee", run.number,
                            schemas.DIM_EMPLOYEE), changes

    with ThreadPoolExecutor(max_workers=4) as pool:
        jobs = [pool.submit(f) for f in (load_dates, load_departments, load_projects,
                                         load_employees)]
        (dim_date, old_dates), (dim_department, old_depts), (dim_project, upsert), (
            dim_employee, changes) = [j.result() for j in jobs]

    # fact for the snapshot
    step("fact")
    require_snapshot_date(dim_date, as_of)
    # The joined rows are written once, as the snapshot's version, in two folders:
    # those with all keys are the fact, the others are read back for its rejects.
    # A run writes only its own snapshot; a full refresh unpublishes the others.
    rows = enriched_assignments(
        employees, x["projects"], x["assignments"], attrition, dim_employee, dim_department,
        dim_project, as_of, names, options.point_in_time,
    ).withColumn(ACCEPTED, has_keys().cast("int"))
    joined = write_snapshot_unpublished(rows, warehouse, "fact_employee_performance", date_key_of(as_of), run.number)
    run.written[snapshot_entry("fact_employee_performance", date_key_of(as_of))] = run.number
    run.write(rejects_from_enriched(joined.where(F.col(ACCEPTED) == 0)), "fact_rejects", schemas.FACT_REJECTS)

    publish(spark, warehouse, run.written,
            replace_prefix="fact_employee_performance@" if full_refresh else None, based_on=run.before,
            rewritten=("dim_employee",) if options.backfill else ())
    fact = read_published(spark, warehouse, "fact_employee_performance",
                          schemas.FACT_EMPLOYEE_PERFORMANCE)

    step("counts")
    summary = changes.agg(
        F.count_if(F.col("action").isin("insert", "close_insert")).alias("scd2_inserted"),
        F.count_if(F.col("action") == "close_insert").alias("scd2_closed"),
        F.count_if(F.col("action") == "reject").alias("scd2_rejected"),
    ).first().asDict()
    project_actions = {
        r["action"]: r["n"]
        for r in upsert.groupBy("action").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    sizes = {
        r["table_name"]: r["row_count"]
        for r in table_counts({
            "dim_date": dim_date, "dim_department": dim_department, "dim_project": dim_project,
            "dim_employee": dim_employee, "fact_employee_performance": fact,
            "dim_date_before": old_dates, "dim_department_before": old_depts,
        }).collect()
    }
    sc.setJobDescription(None)
    return {
        "dim_date_inserted": sizes["dim_date"] - sizes["dim_date_before"],
        "dim_department_inserted": sizes["dim_department"] - sizes["dim_department_before"],
        "dim_project_inserted": project_actions.get("inserted", 0),
        "dim_project_changed": project_actions.get("changed", 0),
        "dim_project_unchanged": project_actions.get("unchanged", 0),
        **{k: int(v) for k, v in summary.items()},
        **{f"rows_{t}": sizes[t] for t in STAR_TABLES},
    }


def warehouse_tables(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """The published star schema (current versions)."""
    versions = current_versions(spark, warehouse)
    return {
        name: read_published(spark, warehouse, name, schemas.SCHEMAS[name], versions)
        for name in STAR_TABLES
    }
