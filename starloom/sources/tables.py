"""Table sources.

A source is either a folder of parquet tables or a JDBC database.  Both are
read lazily with an explicit schema so column pruning and predicate pushdown
reach the scan (parquet ``ReadSchema``/``PushedFilters``; JDBC ``WHERE``).
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from starloom import schemas

# Columns each extract keeps (the operational query's select list).
EXTRACT_COLUMNS: dict[str, tuple[str, ...]] = {
    "departments": ("dept_id", "dept_name"),
    "employees": (
        "employee_id", "name", "email", "dept_id", "hire_date",
        "current_salary", "current_role", "status",
    ),
    "projects": ("project_id", "project_name", "start_date", "end_date", "budget"),
    "assignments": (
        "assignment_id", "employee_id", "project_id", "allocation_pct", "start_date", "end_date",
    ),
    "employee_history": (
        "history_id", "employee_id", "role", "salary", "effective_start", "effective_end",
        "is_current",
    ),
}


#: Lookup tables that one JDBC task may read whole.
SMALL_TABLES = ("departments",)


@dataclass(frozen=True)
class TableSource:
    """Where tables live.

    ``kind="parquet"``: table ``t`` is ``{root}/{t}{suffix}``.
    ``kind="jdbc"``: table ``t`` is read through ``url``; the password comes
    from the environment variable ``password_env`` and a missing one is an
    error.  ``partitioning`` maps a table to ``(column, n)``: the read is split
    into ``n`` queries at the column's own quantiles, which the database is asked
    for first, so they are of even size whatever the ids look like; or to
    ``(column, lower, upper, n)``: ``n`` even ranges between bounds given by hand.
    Every table but ``SMALL_TABLES`` must have an entry.
    ``kind="published"``: the tables that ``operators.load`` has published in
    ``root`` (onboarding, role changes, gated loads), at their newest versions.
    """

    kind: str = "parquet"
    root: str | None = None
    suffix: str = ""
    url: str | None = None
    user: str | None = None
    password_env: str = "DB_PASSWORD"
    driver: str | None = None
    partitioning: Mapping[str, tuple[str, int, int, int] | tuple[str, int]] = field(default_factory=dict)

    def jdbc_options(self, table: str) -> dict[str, str]:
        if not self.url:
            raise ValueError("jdbc source needs a url")
        password = os.environ.get(self.password_env, "")
        if not password:
            raise ValueError(f"{self.password_env} is not set: the jdbc source needs a password")
        options = {"url": self.url, "dbtable": table, "password": password}
        if self.user:
            options["user"] = self.user
        if self.driver:
            options["driver"] = self.driver
        if table not in self.partitioning and table not in SMALL_TABLES:
            raise ValueError(f"jdbc table {table} needs partitioning (column, n) or (column, lower, upper, n): "
                             "without it one task reads the whole table")
        if len(self.partitioning.get(table, ())) == 4:
            column, lower, upper, n = self.partitioning[table]
            options.update(
                partitionColumn=column,
                lowerBound=str(lower),
                upperBound=str(upper),
                numPartitions=str(n),
            )
        return options


def quantile_query(table: str, column: str, n: int) -> str:
    """SQL for the smallest value of each of ``n`` parts of even size (at most ``n`` rows)."""
    return (f"SELECT MIN({column}) AS bound FROM (SELECT {column}, NTILE({n}) OVER (ORDER BY {column}) AS part "
            f"FROM {table} WHERE {column} IS NOT NULL) parts GROUP BY part ORDER BY bound")


def split_predicates(column: str, bounds: Sequence) -> list[str]:
    """WHERE clauses of which exactly one holds for every row, NULLs included.

    ``bounds`` are the parts' smallest values, ascending; parts that begin with
    one value are one part.  Without bounds (no rows) the only clause takes all.
    """
    def literal(value) -> str:
        if isinstance(value, str):
            return "'" + value.replace("'", "''") + "'"
        if isinstance(value, dt.date):
            return f"'{value}'"
        return str(value)

    cuts = [literal(b) for b in dict.fromkeys(bounds)][1:]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {lo} AND {column} < {hi}" for lo, hi in zip(cuts, cuts[1:], strict=False)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def _read_jdbc(spark: SparkSession, source: TableSource, name: str) -> DataFrame:
    options = source.jdbc_options(name)
    if len(source.partitioning.get(name, ())) != 2:
        return spark.read.format("jdbc").options(**options).load()
    column, n = source.partitioning[name]
    del options["dbtable"]
    bounds = spark.read.format("jdbc").options(**options, query=quantile_query(name, column, n)).load()
    url = options.pop("url")
    return spark.read.jdbc(url, name, predicates=split_predicates(column, [r[0] for r in bounds.collect()]),
                           properties=options)


def literal_frame(
    spark: SparkSession, rows: list[tuple], schema: T.StructType
) -> DataFrame:
    """A small literal table built in the JVM (``range`` + ``inline``).

    ``spark.createDataFrame(list)`` ships the rows through Python worker
    processes; for a handful of parameter rows that costs more than the job.
    """
    if not rows:
        return spark.range(0).select(
            [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        )
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, with ``schema``'s columns."""
    return literal_frame(spark, [], schema)


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast to the declared types."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_table(spark: SparkSession, source: TableSource, name: str) -> DataFrame:
    """Scan one operational table with its declared columns and types."""
    schema = schemas.SCHEMAS.get(name)
    if source.kind == "jdbc":
        df = _read_jdbc(spark, source, name)
    elif source.kind == "parquet":
        if not source.root:
            raise ValueError("parquet source needs a root folder")
        df = spark.read.parquet(f"{source.root}/{name}{source.suffix}")
    elif source.kind == "published":
        from starloom.operators.load import read_published

        return read_published(spark, source.root, name, schema)
    else:
        raise ValueError(f"unknown source kind {source.kind!r}")
    if schema is None:
        return df
    return _conform(df, schema)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a warehouse table; an absent table (first run) is empty, not an error."""
    try:
        return _conform(spark.read.schema(schema).parquet(path), schema)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return empty_frame(spark, schema)
        raise


def extract_all(
    spark: SparkSession, source: TableSource, attrition_csv: str | None = None
) -> dict[str, DataFrame]:
    """All extracts as lazy DataFrames; employees carry their department name."""
    frames = {name: read_table(spark, source, name) for name in EXTRACT_COLUMNS}
    frames["employees"] = employees_with_department(frames["employees"], frames["departments"])
    if attrition_csv is not None:
        from starloom.sources.csv import read_attrition_csv

        frames["attrition_raw"] = read_attrition_csv(spark, attrition_csv)
    return frames


def employees_with_department(employees: DataFrame, departments: DataFrame) -> DataFrame:
    """Employees inner-joined to their department name.

    Departments are a handful of rows; AQE turns the join into a broadcast
    hash join from the measured size, so no unchecked hint is needed.
    """
    return employees.join(departments.select("dept_id", "dept_name"), "dept_id", "inner").select(
        "employee_id", "name", "email", "dept_id", "hire_date", "current_salary",
        "current_role", "status", "dept_name",
    )


def run_sql(spark: SparkSession, query: str, **params) -> DataFrame:
    """Parameterised SQL (``:name`` markers) over registered views."""
    return spark.sql(query, args=params or None)


def register_database(
    spark: SparkSession, database: str, tables: Mapping[str, str], location: str | None = None
) -> None:
    """Expose parquet folders as ``database.table`` in the session catalog.

    Two databases (operational and star schema) can then be joined in one SQL
    statement, as the reports do across them.  ``location`` is the database's own
    folder (default: under the session's warehouse folder); the tables stay
    where they are.
    """
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")
    for name, path in tables.items():
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(f"CREATE TABLE {database}.{name} USING parquet LOCATION '{path}'")
