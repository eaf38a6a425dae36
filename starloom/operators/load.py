"""Loads and writes.

Spark has no ``UPDATE``/``MERGE`` on parquet, so every load computes the
complete next state of a table as a DataFrame, writes it as a new version
beside the old one and then publishes it with one new manifest.  Claims and
manifests are objects that exactly one run can create (``sources.objects``), so
every run has a number, and folders, of its own, and none hides another's tables.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas
from starloom.functions.values import conformed
from starloom.operators.clean import resolve_departments, resolve_projects
from starloom.operators.keys import assign_dense_keys, largest_key, next_key_base
from starloom.operators.scd2 import intervals_from_changelog
from starloom.session import checkpoint_dir
from starloom.sources.objects import numbers, put_if_absent, read_object
from starloom.sources.tables import empty_frame

# --------------------------------------------------------------------------
# insert-if-absent and upsert (set-based, no per-row statements)
# --------------------------------------------------------------------------


def rows_not_in(
    incoming: DataFrame, existing: DataFrame, keys: list[str], collation: str | None = None
) -> DataFrame:
    """Incoming rows whose key is not in ``existing`` (null-safe anti join).

    Under ``collation`` (string keys) names that it holds equal are one key (D9).
    """
    known = existing.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    same = [conformed(k, collation).eqNullSafe(conformed(f"_known_{k}", collation)) for k in keys]
    return incoming.join(known, same, "left_anti")


def new_dates(dim_date: DataFrame, existing: DataFrame) -> DataFrame:
    """L1: calendar rows to append."""
    return rows_not_in(dim_date, existing, ["date_key"])


def new_departments(
    dim_department: DataFrame, existing: DataFrame, collation: str | None = None
) -> DataFrame:
    """L2: department names to append, keyed after the largest existing key."""
    fresh = rows_not_in(dim_department, existing, ["dept_name"], collation)
    keyed = assign_dense_keys(
        fresh, ["source_id"], "department_key", next_key_base(existing, "department_key")
    )
    return keyed.select("department_key", "dept_name")


def upsert_dim_project(
    incoming: DataFrame, existing: DataFrame, collation: str | None = None
) -> DataFrame:
    """The next dim_project with an ``action`` per row.

    ``inserted`` (new name, new key), ``changed`` / ``unchanged`` (matched by
    name; the incoming budget wins), ``untouched`` (not in this load).  The
    counts by action replace the reference's single "inserted + matched" sum.
    Under ``collation`` a known name keeps its spelling (D9).
    """
    inc = incoming.select(
        F.col("project_name").alias("_name"), F.col("budget").alias("_budget"), "source_id"
    )
    same_name = conformed("project_name", collation) == conformed("_name", collation)
    merged = existing.join(inc, same_name, "full_outer")
    is_new = F.col("project_key").isNull()
    action = (
        F.when(is_new, F.lit("inserted"))
        .when(F.col("_name").isNull(), F.lit("untouched"))
        .when(F.col("budget") == F.col("_budget"), F.lit("unchanged"))
        .otherwise(F.lit("changed"))
    )
    merged = merged.withColumn("action", action)
    kept = merged.where(~is_new).select(
        "project_key",
        "project_name",
        F.coalesce(F.col("_budget"), F.col("budget")).alias("budget"),
        "action",
    )
    fresh = assign_dense_keys(
        merged.where(is_new).select("_name", "_budget", "source_id", "action"),
        ["source_id"],
        "project_key",
        next_key_base(existing, "project_key"),
    ).select(
        "project_key",
        F.col("_name").alias("project_name"),
        F.col("_budget").alias("budget"),
        "action",
    )
    return kept.unionByName(fresh)


# --------------------------------------------------------------------------
# operational-side changes
# --------------------------------------------------------------------------


def apply_role_changes(
    history: DataFrame, employees: DataFrame, changes: DataFrame,
    closed: DataFrame | None = None, last_history_id: int | None = None,
    store: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """role/salary changes -> ``(history, employees, rejected)``.

    ``changes``: ``change_id, employee_id, role, salary, effective_start``.
    The open version of each employee and its changes are re-cut into
    intervals (the open one is closed the day before the first change; several
    changes on one day keep the largest ``change_id``).  Rejected, with a
    reason: changes without employee or date, of an employee not in
    ``employees``, dated on or before the start of the open version (D4), or,
    where no version is open, on or before the last day of the closed ones.
    Closed versions, and rows whose flag is NULL, are not touched.  Only
    employees with an accepted change get a new role and salary.

    Rows in ``closed`` are versions that count for the checks but are not
    returned (a store that keeps closed versions need not rewrite them).  New
    versions are numbered after ``last_history_id`` (default: the largest in
    ``history``, which must then hold all versions).  ``store`` may write the
    judged changes and the re-cut versions and return them as read back, so that
    several results are not each computed from the start.
    """
    is_open = F.coalesce(F.col("is_current"), F.lit(False))
    open_rows = history.where(is_open)
    seen = history if closed is None else history.unionByName(closed)
    state = seen.groupBy("employee_id").agg(
        F.max(F.when(is_open, F.col("effective_start"))).alias("_open_start"),
        F.max(F.coalesce("effective_end", "effective_start")).alias("_last_day"),
    )
    known = employees.select("employee_id").distinct().withColumn("_known", F.lit(True))
    start = F.col("effective_start")
    checked = (
        changes.join(state, "employee_id", "left").join(known, "employee_id", "left")
        .withColumn(
            "reason",
            F.when(F.col("employee_id").isNull() | start.isNull(), F.lit("employee or date is missing"))
            .when(F.col("_known").isNull(), F.lit("unknown employee"))
            .when(start <= F.col("_open_start"), F.lit("change dated on or before the open version's start"))
            .when(F.col("_open_start").isNull() & (start <= F.col("_last_day")),
                  F.lit("change dated on or before the end of the closed versions")),
        )
    )
    checked = store(checked.select("change_id", "employee_id", "role", "salary", "effective_start", "reason"))
    rejected = checked.where(F.col("reason").isNotNull()).select(
        "change_id", "employee_id", "effective_start", "reason")
    accepted = checked.where(F.col("reason").isNull())
    tail = open_rows.select(
        "employee_id", "role", "salary", "effective_start", "history_id",
        F.lit(0).alias("_src"), F.lit(None).cast("long").alias("change_id"),
    ).unionByName(
        accepted.select(
            "employee_id", "role", "salary", "effective_start",
            F.lit(None).cast("long").alias("history_id"), F.lit(1).alias("_src"), "change_id",
        )
    )
    recut = intervals_from_changelog(
        tail, "employee_id", "effective_start", ["_src", "change_id"],
        ["role", "salary", "history_id"],
    )
    recut = store(recut)
    fresh = assign_dense_keys(
        recut.where(F.col("history_id").isNull()).drop("history_id"),
        ["employee_id", "effective_start"],
        "history_id",
        next_key_base(history, "history_id") if last_history_id is None else last_history_id,
        spread=True,  # one employee may bring many changes
    )
    columns = list(history.columns)
    new_history = (
        history.where(~is_open)
        .select(columns)
        .unionByName(recut.where(F.col("history_id").isNotNull()).select(columns))
        .unionByName(fresh.select(columns))
    )
    latest = accepted.groupBy("employee_id").agg(
        F.max(F.struct("effective_start", "change_id", "role", "salary")).alias("_new"))
    role = F.when(F.col("_new").isNotNull(), F.col("_new.role")).otherwise(F.col("current_role"))
    salary = F.when(F.col("_new").isNotNull(), F.col("_new.salary")).otherwise(F.col("current_salary"))
    updated = {"current_role": role, "current_salary": salary}
    new_employees = employees.join(latest, "employee_id", "left").select(
        *[updated.get(c, F.col(c)).alias(c) for c in employees.columns]
    )
    return new_history, new_employees, rejected


ONBOARD_STATUSES = ("Active", "Terminated")


def onboarding_checks(requests: DataFrame) -> DataFrame:
    """Q7: add ``reason`` (NULL when the request is valid)."""
    def blank(c: str):
        return F.col(c).isNull() | (F.trim(F.col(c)) == "")

    needed = ("hire_date", "current_salary", "status", "allocation_pct", "assignment_start")
    missing = F.lit(False)
    for c in needed:
        missing = missing | F.col(c).isNull()
    reason = (
        F.when(blank("name") | blank("email") | blank("current_role"),
               F.lit("name, email and role are required"))
        .when(missing, F.lit("a required value is missing"))
        .when(F.col("assignment_start") < F.col("hire_date"),
              F.lit("assignment start before hire date"))
        .when(F.col("current_salary") < 0, F.lit("negative salary"))
        .when(~F.col("allocation_pct").between(1, 100), F.lit("allocation outside 1..100"))
        .when(~F.col("status").isin(*ONBOARD_STATUSES), F.lit("unknown status"))
        .when(F.col("dept_id").isNull(), F.lit("unknown department"))
        .when(F.col("project_id").isNull(), F.lit("unknown project"))
    )
    return requests.withColumn("reason", reason)


def email_checks(checked: DataFrame, employees: DataFrame) -> DataFrame:
    """UNIQUE email: a valid request whose trimmed email an employee has, or an
    earlier valid request (by ``request_id``) of the batch, gets a ``reason``."""
    email = F.trim("email")
    valid = checked.where(F.col("reason").isNull())
    first = valid.groupBy(email.alias("_email")).agg(F.min("request_id").alias("_first"))
    taken = employees.select(F.trim("email").alias("_email")).distinct().withColumn("_taken", F.lit(True))
    first = first.join(taken, "_email", "left")
    rows = checked.withColumn("_email", email).join(first, "_email", "left")
    reason = (
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(F.col("_taken").isNotNull(), F.lit("email already used by an employee"))
        .when(F.col("request_id") > F.col("_first"), F.lit("email repeated in the batch"))
    )
    return rows.withColumn("reason", reason).drop("_email", "_first", "_taken")


def onboard(
    requests: DataFrame,
    employees: DataFrame,
    assignments: DataFrame,
    departments: DataFrame,
    projects: DataFrame,
    history: DataFrame | None = None,
    collation: str | None = None,
) -> dict[str, DataFrame]:
    """L8 as a batch: validate hires, give ids, build their three records.

    ``requests``: ``request_id, name, email, dept_name, hire_date,
    current_salary, current_role, status, project_name, allocation_pct,
    assignment_start``.  Returns ``employees``, ``employee_history``,
    ``assignments`` (new rows only, in the columns of ``schemas``) and
    ``rejected``.  New ids follow the largest existing id (A13), densely, in
    request order within key buckets; with ``history`` the first versions get
    ``history_id`` the same way.  The batch is numbered once for all ids.
    Department and project names are compared under ``collation`` (D9).
    """
    resolved = resolve_projects(resolve_departments(requests, departments, collation), projects, collation)
    checked = email_checks(onboarding_checks(resolved), employees)
    ok = assign_dense_keys(checked.where(F.col("reason").isNull()), ["request_id"], "_number")
    ok = ok.withColumns({
        "employee_id": next_key_base(employees, "employee_id") + F.col("_number"),
        "assignment_id": next_key_base(assignments, "assignment_id") + F.col("_number"),
        "history_id": next_key_base(history, "history_id") + F.col("_number"),
    })
    hires = ok.select(
        "request_id", "employee_id", "assignment_id", "history_id",
        F.trim("name").alias("name"), F.trim("email").alias("email"), "dept_id", "hire_date",
        F.col("current_salary").cast("decimal(12,2)").alias("current_salary"),
        F.trim("current_role").alias("current_role"), "status", "project_id",
        F.col("allocation_pct").cast("decimal(5,2)").alias("allocation_pct"),
        F.col("assignment_start").alias("start_date"),
    )
    new_employees = hires.select(
        "employee_id", "name", "email", "dept_id", "hire_date", "current_salary",
        "current_role", "status",
    )
    new_history = hires.select(
        "history_id",
        "employee_id",
        F.col("current_role").alias("role"),
        F.col("current_salary").alias("salary"),
        F.col("hire_date").alias("effective_start"),
        F.lit(None).cast("date").alias("effective_end"),
        F.lit(True).alias("is_current"),
    )
    new_assignments = hires.select(
        "assignment_id", "employee_id", "project_id", "allocation_pct", "start_date",
        F.lit(None).cast("date").alias("end_date"),
    )
    rejected = checked.where(F.col("reason").isNotNull()).select("request_id", "reason")
    return {
        "hires": hires.drop("history_id"),
        "employees": new_employees,
        "employee_history": new_history,
        "assignments": new_assignments,
        "rejected": rejected,
    }


#: Manifest entry: the largest history_id given so far, in open or closed versions.
LAST_HISTORY_ID = "employee_history.last_key"


def write_operational(
    spark: SparkSession, root: str, tables: dict[str, DataFrame], run: int, last_history_id: int = 0
) -> dict[str, int]:
    """Write tables as version ``run`` without publishing; the entries to publish.

    Versions of ``employee_history`` are stored as those of a Type 2 dimension:
    open ones anew each run, closed ones once.  The largest ``history_id`` goes
    into the manifest, so ids are never given twice, whatever is deleted.
    """
    entries = dict.fromkeys(tables, run)
    for name, df in tables.items():
        if name in SCD2_TABLES:
            write_scd2_unpublished(df, root, name, run)
        else:
            write_unpublished(df, root, name, run)
    if "employee_history" in tables:
        written = [_read_stored(spark, [f"{root}/employee_history/{part}"], schemas.EMPLOYEE_HISTORY)
                   for part in (f"current/v{run:06d}", f"closed/run={run}")]
        entries[LAST_HISTORY_ID] = max(last_history_id, *(largest_key(w, "history_id") for w in written))
    return entries


def publish_onboarding(
    spark: SparkSession, root: str, batch: dict[str, DataFrame], tables: dict[str, DataFrame]
) -> int:
    """L8 durably: the three tables with the batch's rows appended, published together.

    Of a published ``employee_history`` only the open versions are read and
    written again.
    """
    run, before = claim_run(spark, root), current_versions(spark, root)
    grown = {}
    for name in ("employees", "employee_history", "assignments"):
        base = tables[name]
        if name in SCD2_TABLES and name in before:
            base = read_scd2_version(spark, root, name, before[name], base.schema, current_only=True)
        grown[name] = base.unionByName(batch[name].select(*base.columns))
    publish(spark, root, write_operational(spark, root, grown, run, before.get(LAST_HISTORY_ID, 0)), based_on=before)
    return run


def publish_role_changes(spark: SparkSession, root: str, changes: DataFrame) -> int:
    """L11 durably: changes of role and salary on the published operational tables.

    Reads the published ``employees`` and the open versions of
    ``employee_history`` (of the closed ones only those of employees the changes
    name, for the checks), applies ``apply_role_changes`` and publishes both
    tables and ``role_change_rejects`` together: readers see all of a batch or
    nothing.  Closed versions are written once and never again.  New versions
    are numbered after the largest ``history_id`` ever published.  Raises
    ``PublishConflict`` if another run has published one of the tables meanwhile.
    """
    run, before = claim_run(spark, root), current_versions(spark, root)
    if "employee_history" not in before or "employees" not in before:
        raise ValueError(f"no published employees and employee_history in {root}")
    schema, version = schemas.EMPLOYEE_HISTORY, before["employee_history"]
    current = read_scd2_version(spark, root, "employee_history", version, schema, current_only=True)
    closed = read_scd2_version(spark, root, "employee_history", version, schema, closed_only=True).join(
        changes.select("employee_id").distinct(), "employee_id", "left_semi").select(schema.fieldNames())
    employees = read_published(spark, root, "employees", schemas.EMPLOYEES, before)
    last = before.get(LAST_HISTORY_ID)
    if last is None:
        last = largest_key(read_version(spark, root, "employee_history", version, schema), "history_id")
    checkpoint_dir(spark)
    history, staff, rejected = apply_role_changes(
        current, employees, changes, closed, last, store=lambda df: df.checkpoint())
    tables = {"employee_history": history, "employees": staff, "role_change_rejects": rejected}
    publish(spark, root, write_operational(spark, root, tables, run, last), based_on=before)
    return run


# --------------------------------------------------------------------------
# versioned tables: write beside, then publish a manifest
# --------------------------------------------------------------------------

#: Manifest entries with this ending hold the largest key given, not a version.
LAST_KEY = ".last_key"


class PublishConflict(RuntimeError):
    """Another run has published a table that this run had read before and replaces."""


def _newest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the newest manifest: ``versions`` and, for SCD2 tables, the runs in
    ``closed`` whose closed rows count: a list for each time the table was rewritten whole.

    A manifest is one object ``manifest/N`` that is never overwritten: a reader
    sees it whole or not at all.  Only the newest is read; of the others only
    the names are listed.
    """
    known = numbers(spark, f"{root}/manifest")
    if not known:
        return 0, {"versions": {}, "closed": {}}
    return known[-1], json.loads(read_object(spark, f"{root}/manifest/{known[-1]}"))


def claim_run(spark: SparkSession, root: str) -> int:
    """A run number that no other run has or had, also not one that failed.

    The claim is an object ``runs/N`` that exactly one run can create: of any
    number of runs that want a number, one has it and the others move on.
    """
    versions = _newest(spark, root)[1]["versions"]
    published = [v for name, v in versions.items() if not name.endswith(LAST_KEY)]
    run = max([*numbers(spark, f"{root}/runs")[-1:], *published, 0]) + 1
    while not put_if_absent(spark, f"{root}/runs/{run}", b""):
        run += 1
    return run


def version_path(root: str, table: str, version: int) -> str:
    return f"{root}/{table}/v{version:06d}"


def current_versions(spark: SparkSession, root: str) -> dict[str, int]:
    """What the newest manifest names: a version per table (empty before any)."""
    return _newest(spark, root)[1]["versions"]


def current_version(spark: SparkSession, root: str, table: str) -> int:
    """Published version of one table; 0 before its first publication."""
    return current_versions(spark, root).get(table, 0)


def publish(
    spark: SparkSession, root: str, versions: dict[str, int], replace_prefix: str | None = None,
    based_on: dict[str, int] | None = None, rewritten: Collection[str] = (),
) -> None:
    """Make ``versions`` current, all tables at once (one small new manifest).

    Until this is done, readers keep seeing the previous versions, so a run that
    fails half-way publishes nothing.  Entries starting with ``replace_prefix``
    that are not in ``versions`` are unpublished (e.g. older fact snapshots).
    Of SCD2 tables in ``rewritten`` this run's closed rows are all there are;
    older versions keep theirs.

    If another run publishes meanwhile, this goes on from its manifest, so
    neither hides the other's tables.  ``based_on`` are the versions that this
    run read: where one of the tables it replaces has another version by now,
    the run's rows lack the other's, and ``PublishConflict`` is raised.
    """
    while True:
        newest, old = _newest(spark, root)
        before = old["versions"]
        if based_on is not None:
            lost = sorted(t for t in versions if before.get(t) != based_on.get(t))
            if lost:
                raise PublishConflict(f"published by another run meanwhile: {', '.join(lost)}")
        kept = {k: v for k, v in before.items() if not (replace_prefix and k.startswith(replace_prefix))}
        closed = dict(old["closed"])
        for table in SCD2_TABLES & versions.keys():
            past = closed.get(table, [])
            if table in rewritten or not past:
                closed[table] = [*past, [versions[table]]]
            else:
                closed[table] = [*past[:-1], sorted({*past[-1], versions[table]})]
        content = json.dumps({"versions": {**kept, **versions}, "closed": closed}, sort_keys=True)
        if put_if_absent(spark, f"{root}/manifest/{newest + 1}", content.encode()):
            return


def version_folders(spark: SparkSession, root: str, table: str) -> list[str]:
    """Folders of the published version of a table: for SCD2 tables that of the open rows, then those of closed ones."""
    newest = _newest(spark, root)[1]
    version = newest["versions"][table]
    if table not in SCD2_TABLES:
        return [version_path(root, table, version)]
    return [f"{root}/{table}/current/v{version:06d}",
            *(f"{root}/{table}/closed/run={r}" for r in newest["closed"].get(table, [[]])[-1])]


def read_version(
    spark: SparkSession, root: str, table: str, version: int, schema: T.StructType
) -> DataFrame:
    if version == 0:
        return empty_frame(spark, schema)
    if table in SCD2_TABLES:
        return read_scd2_version(spark, root, table, version, schema)
    return _read_stored(spark, [version_path(root, table, version)], schema)


def _read_stored(
    spark: SparkSession, paths: list[str], schema: T.StructType, base: str | None = None
) -> DataFrame:
    """Folders that a manifest names: a lost one is an error, never an empty table."""
    reader = spark.read.schema(schema)
    df = (reader.option("basePath", base) if base else reader).parquet(*paths)
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_published(
    spark: SparkSession, root: str, table: str, schema: T.StructType,
    versions: dict[str, int] | None = None,
) -> DataFrame:
    """A table as the manifest ``versions`` (default: as published) names it."""
    versions = current_versions(spark, root) if versions is None else versions
    if table in SNAPSHOT_TABLES:
        return read_snapshots(spark, root, table, schema, versions)
    return read_version(spark, root, table, versions.get(table, 0), schema)


# --------------------------------------------------------------------------
# snapshot tables: each snapshot (partition value) has its own versions, so a
# run writes only its snapshot and keeping the others costs nothing
# --------------------------------------------------------------------------

SNAPSHOT_TABLES = {"fact_employee_performance": "date_key"}
#: Folder column of a snapshot: 1 for the table's rows, 0 for the rows that it rejects.
ACCEPTED = "has_keys"


def snapshot_entry(table: str, value: int) -> str:
    return f"{table}@{value}"


def snapshot_path(root: str, table: str, value: int, version: int) -> str:
    return f"{root}/{table}/{SNAPSHOT_TABLES[table]}={value}/version={version}"


def read_snapshots(
    spark: SparkSession, root: str, table: str, schema: T.StructType, versions: dict[str, int]
) -> DataFrame:
    """Union of the published version of every published snapshot."""
    prefix = f"{table}@"
    paths = [snapshot_path(root, table, int(k[len(prefix):]), v)
             for k, v in sorted(versions.items()) if k.startswith(prefix)]
    if not paths:
        return empty_frame(spark, schema)
    folders = [T.StructField(name, T.IntegerType()) for name in ("version", ACCEPTED)]
    df = spark.read.schema(T.StructType(schema.fields + folders)).option(
        "basePath", f"{root}/{table}").parquet(*paths).where(F.col(ACCEPTED) == 1)
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_snapshot_unpublished(
    df: DataFrame, root: str, table: str, value: int, version: int, allow_empty: bool = False
) -> DataFrame:
    """Write one snapshot (all rows have partition value ``value``) and return it as stored.

    Rows with ``ACCEPTED`` = 1 are the table's; others are only kept beside them.
    Columns that the table doesn't have are stored but never read with it.
    """
    path = snapshot_path(root, table, value, version)
    df.drop(SNAPSHOT_TABLES[table]).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").partitionBy(ACCEPTED).parquet(path)
    stored = df.sparkSession.read.schema(df.drop(SNAPSHOT_TABLES[table]).schema).parquet(path)
    if not allow_empty and stored.where(F.col(ACCEPTED) == 1).isEmpty():
        raise ValueError(f"refusing to publish an empty {table} snapshot {value}")
    return stored


# --------------------------------------------------------------------------
# SCD2 tables: closed versions are immutable, so they are appended once
# (``closed/run=N``) and only the current rows are rewritten per run.
# --------------------------------------------------------------------------

SCD2_TABLES = {"dim_employee", "employee_history"}


def read_scd2_version(
    spark: SparkSession, root: str, table: str, version: int, schema: T.StructType,
    current_only: bool = False, closed_only: bool = False, rewritten: bool = False,
) -> DataFrame:
    """Version ``version``: its current rows plus the rows closed by it and, unless
    it has ``rewritten`` the table, by the published runs before it (a run that
    failed never counts)."""
    current = _read_stored(spark, [f"{root}/{table}/current/v{version:06d}"], schema)
    if current_only:
        return current
    past = [] if rewritten else _newest(spark, root)[1]["closed"].get(table, [])
    runs = next((runs for runs in reversed(past) if runs[0] <= version), [])
    runs = sorted({r for r in runs if r < version} | {version})
    closed = _read_stored(spark, [f"{root}/{table}/closed/run={r}" for r in runs], schema)
    return closed if closed_only else closed.unionByName(current)


def write_scd2_unpublished(df: DataFrame, root: str, table: str, version: int) -> None:
    """Split the next state: current rows as a new version, all others (a NULL
    flag included) as the rows closed by this run.  Both folders are replaced
    whole, so a retry leaves nothing of the attempt before."""
    current = F.coalesce(F.col("is_current"), F.lit(False))
    for rows, path in ((df.where(current), f"current/v{version:06d}"), (df.where(~current), f"closed/run={version}")):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/{table}/{path}")


def read_current(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """The table as published; empty with ``schema`` before its first version."""
    return read_version(spark, root, table, current_version(spark, root, table), schema)


def write_unpublished(
    df: DataFrame,
    root: str,
    table: str,
    version: int,
    partition_by: list[str] | None = None,
    allow_empty: bool = True,
) -> str:
    """Write ``df`` as ``version`` of ``table`` without publishing it.

    With ``allow_empty=False`` an empty result raises ``ValueError`` (D19).
    """
    path = version_path(root, table, version)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    if not allow_empty and df.sparkSession.read.parquet(path).isEmpty():
        raise ValueError(f"refusing to publish an empty {table}")
    return path


def write_version(
    df: DataFrame,
    root: str,
    table: str,
    partition_by: list[str] | None = None,
    allow_empty: bool = False,
) -> int:
    """Write ``df`` as the next version of ``table`` and publish it.

    An empty result is not published unless ``allow_empty`` (D19): the old
    version stays current and ``ValueError`` is raised.
    """
    spark = df.sparkSession
    version = claim_run(spark, root)
    write_unpublished(df, root, table, version, partition_by, allow_empty)
    publish(spark, root, {table: version})
    return version


def load_oltp(tables: dict[str, DataFrame], root: str) -> DataFrame:
    """Publish the operational tables that keep the rules, the others' rows apart.

    A row that breaks a rule (``quality.gate``) is not loaded; with its reasons
    it goes to the table ``load_rejects``, published in the same manifest.  The
    result is that table as stored.
    """
    from starloom.operators.quality import gate

    spark = next(iter(tables.values())).sparkSession
    run, before = claim_run(spark, root), current_versions(spark, root)
    entries: dict[str, int] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        entries.update(write_operational(spark, root, {name: df}, run, before.get(LAST_HISTORY_ID, 0)))
        return read_version(spark, root, name, run, df.schema)

    rejects = gate(tables, store)[1]
    rejected = store("load_rejects", rejects)
    publish(spark, root, entries, based_on=before)
    return rejected


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for every table, one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
