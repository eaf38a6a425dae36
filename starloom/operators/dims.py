"""Reference dimensions: department, project, date (D-DEPT, D-PROJ, D-DATE, U1)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import as_date_literal, calendar_columns
from starloom.functions.values import conformed
from starloom.operators.dedup import keep_first
from starloom.operators.keys import assign_dense_keys, next_key_base


def build_dim_department(departments: DataFrame, collation: str | None = None) -> DataFrame:
    """Distinct department names; ``source_id`` (smallest dept_id) orders keys.

    With ``collation`` names equal under it form one row (D9), shown as the
    spelling of the smallest ``dept_id``.
    """
    if collation is None:
        return departments.groupBy("dept_name").agg(
            F.min("dept_id").cast("long").alias("source_id")
        )
    first = departments.groupBy(conformed("dept_name", collation).alias("_name")).agg(
        F.min_by("dept_name", "dept_id").alias("dept_name"),
        F.min("dept_id").cast("long").alias("source_id"),
    )
    return first.select("dept_name", "source_id")


def build_dim_project(projects: DataFrame, collation: str | None = None) -> DataFrame:
    """One row per project name: the project with the smallest id wins.

    With ``collation`` names equal under it are one (D9).
    """
    if collation is None:
        first = keep_first(
            projects.select("project_name", "project_id", "budget"), ["project_name"], ["project_id"]
        )
        return first.select("project_name", "budget", F.col("project_id").alias("source_id"))
    first = projects.groupBy(conformed("project_name", collation).alias("_name")).agg(
        F.min(F.struct("project_id", "project_name", "budget")).alias("_p"))
    return first.select("_p.project_name", "_p.budget", F.col("_p.project_id").alias("source_id"))


def build_dim_date(
    employees: DataFrame, assignments: DataFrame, as_of: dt.date | str
) -> DataFrame:
    """Sparse calendar: the snapshot date, hire dates and assignment dates.

    Each input is reduced to its distinct dates before the union, so the
    shuffle carries at most one row per calendar day per partition.
    """
    spark = employees.sparkSession
    dates = (
        spark.range(1)
        .select(as_date_literal(as_of).alias("d"))
        .union(employees.select(F.col("hire_date").alias("d")))
        .union(assignments.select(F.explode(F.array("start_date", "end_date")).alias("d")))
        .where(F.col("d").isNotNull())
        .distinct()
    )
    return dates.select(*calendar_columns(F.col("d")))


def key_dim_department(dim: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """``department_key`` for new department names (max existing key + dense)."""
    keyed = assign_dense_keys(
        dim, ["source_id"], "department_key", next_key_base(existing, "department_key")
    )
    return keyed.select("department_key", "dept_name")


def key_dim_project(dim: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """``project_key`` for new project names (max existing key + dense)."""
    keyed = assign_dense_keys(
        dim, ["source_id"], "project_key", next_key_base(existing, "project_key")
    )
    return keyed.select("project_key", "project_name", "budget")
