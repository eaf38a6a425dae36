"""Snapshot ingest and conforming."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.dates import as_date_literal
from starloom.functions.values import conformed, money, yes_no_flag
from starloom.operators.dedup import keep_first
from starloom.schemas import ATTRITION_CSV_COLUMNS

# The names the snapshot's columns take.
SNAPSHOT_RENAMES = {
    "EmployeeNumber": "employee_id",
    "JobSatisfaction": "job_satisfaction",
    "WorkLifeBalance": "work_life_balance",
    "PerformanceRating": "performance_rating",
    "DistanceFromHome": "distance_from_home",
}

# Department role ladders and role aliases used to place a role on a
# seniority ladder (fixed values).
DEPT_ROLE_LADDERS: dict[str, list[str]] = {
    "Sales": ["Sales Representative", "Sales Executive", "Manager"],
    "Research & Development": [
        "Laboratory Technician",
        "Research Scientist",
        "Research Director",
        "Manager",
    ],
    "Human Resources": ["Human Resources", "Manager"],
}
ROLE_ALIASES: dict[str, str] = {
    "Healthcare Representative": "Sales Representative",
    "Manufacturing Director": "Research Director",
}


def prepare_attrition(raw: DataFrame) -> DataFrame:
    """Snapshot file columns -> per-employee attributes.

    Keeps the first row per ``EmployeeNumber`` (ordered by all columns, D1),
    turns Yes/No into booleans (case-insensitive, NULL -> false) and renames
    to snake_case.
    """
    cols = list(ATTRITION_CSV_COLUMNS)
    first = keep_first(raw.select(cols), ["EmployeeNumber"], cols[1:])
    return first.select(
        F.col("EmployeeNumber").cast("long").alias("employee_id"),
        yes_no_flag("Attrition").alias("is_attrition_flag"),
        F.col("JobSatisfaction").cast("int").alias("job_satisfaction"),
        F.col("WorkLifeBalance").cast("int").alias("work_life_balance"),
        yes_no_flag("OverTime").alias("overtime"),
        F.col("PerformanceRating").cast("int").alias("performance_rating"),
        F.col("DistanceFromHome").cast("int").alias("distance_from_home"),
    )


RAW_TYPES = {
    "EmployeeNumber": "bigint",
    "MonthlyIncome": "double",
    "YearsAtCompany": "int",
    "YearsInCurrentRole": "int",
    "YearsSinceLastPromotion": "int",
    "PercentSalaryHike": "int",
}
RAW_TEXT = ("Department", "JobRole", "Attrition", "Gender")


def clean_raw_snapshot(raw: DataFrame) -> DataFrame:
    """First row per ``EmployeeNumber``, typed numbers, trimmed text.

    Casts run under ANSI mode, so a malformed number fails the job rather
    than silently becoming NULL; a missing text value stays NULL (D14).
    """
    typed = raw.withColumns(
        {
            **{c: F.trim(F.col(c)).cast(t) for c, t in RAW_TYPES.items() if c in raw.columns},
            **{c: F.trim(F.col(c)) for c in RAW_TEXT if c in raw.columns},
        }
    )
    others = [c for c in typed.columns if c != "EmployeeNumber"]
    return keep_first(typed, ["EmployeeNumber"], others)


def departments_from_snapshot(clean: DataFrame) -> DataFrame:
    """Distinct department names (order is applied by the reader)."""
    return clean.select(F.col("Department").alias("dept_name")).distinct()


def employees_from_snapshot(
    clean: DataFrame,
    as_of: dt.date,
    domain: str = "company.com",
    first_name: str = "FirstName",
    last_name: str = "LastName",
) -> DataFrame:
    """Snapshot rows -> employee records (department by name).

    ``hire_date`` is the snapshot date minus ``YearsAtCompany`` whole years,
    clamped at zero years (month-end days clamp, as calendar arithmetic does).
    """
    first, last = F.col(first_name), F.col(last_name)
    years = F.greatest(F.col("YearsAtCompany"), F.lit(0))
    return clean.select(
        F.col("EmployeeNumber").alias("employee_id"),
        F.concat_ws(" ", first, last).alias("name"),
        F.concat(
            F.concat_ws(".", F.lower(first), F.lower(last), F.col("EmployeeNumber")),
            F.lit("@" + domain),
        ).alias("email"),
        F.col("Department").alias("dept_name"),
        F.add_months(as_date_literal(as_of), -12 * years).alias("hire_date"),
        money("MonthlyIncome").alias("current_salary"),
        F.col("JobRole").alias("current_role"),
        F.when(F.lower(F.col("Attrition")) == "yes", F.lit("Terminated"))
        .otherwise(F.lit("Active"))
        .alias("status"),
    )


def _resolve(frame: DataFrame, lookup: DataFrame, name: str, key: str, collation: str | None) -> DataFrame:
    """``name`` -> smallest ``key`` of the rows of ``lookup`` with that name (left join)."""
    if collation is None:
        return frame.join(lookup.groupBy(name).agg(F.min(key).alias(key)), name, "left")
    ids = lookup.groupBy(conformed(name, collation).alias("_name")).agg(F.min(key).alias(key))
    return frame.join(ids, conformed(name, collation) == F.col("_name"), "left").drop("_name")


def resolve_departments(frame: DataFrame, departments: DataFrame, collation: str | None = None) -> DataFrame:
    """``dept_name`` -> ``dept_id`` (no match -> NULL); names compared under ``collation``."""
    return _resolve(frame, departments, "dept_name", "dept_id", collation)


def resolve_projects(frame: DataFrame, projects: DataFrame, collation: str | None = None) -> DataFrame:
    """P20: ``project_name`` -> smallest ``project_id`` with that name, compared under ``collation``."""
    return _resolve(frame, projects, "project_name", "project_id", collation)


def ladder_frames(
    spark: SparkSession,
    ladders: dict[str, list[str]] = DEPT_ROLE_LADDERS,
    aliases: dict[str, str] = ROLE_ALIASES,
) -> tuple[DataFrame, DataFrame]:
    """Ladder ``(department, role, position)`` and alias ``(role, alias)`` frames."""
    from starloom.sources.tables import literal_frame

    ladder = literal_frame(
        spark,
        [(d, r, i) for d, roles in ladders.items() for i, r in enumerate(roles)],
        T.StructType([T.StructField("department", T.StringType()),
                      T.StructField("role", T.StringType()),
                      T.StructField("position", T.IntegerType())]),
    )
    alias = literal_frame(
        spark, list(aliases.items()),
        T.StructType([T.StructField("role", T.StringType()), T.StructField("alias", T.StringType())]),
    )
    return ladder, alias


def role_levels(
    frame: DataFrame,
    ladder: DataFrame,
    aliases: DataFrame,
    dept_col: str = "dept_name",
    role_col: str = "current_role",
) -> DataFrame:
    """H3: position of each role on its department's ladder.

    Alias first, then the raw role, else the top of the ladder; a department
    without a ladder gives 0.  Ladder and alias tables are parameters of fixed,
    small size; the joins against them are equi-joins that AQE broadcasts.
    """
    lad_a = ladder.select(
        F.col("department").alias("_da"), F.col("role").alias("_ra"), F.col("position").alias("_pa")
    )
    lad_r = ladder.select(
        F.col("department").alias("_dr"), F.col("role").alias("_rr"), F.col("position").alias("_pr")
    )
    sizes = ladder.groupBy(F.col("department").alias("_ds")).agg(F.count(F.lit(1)).alias("_len"))
    al = aliases.select(F.col("role").alias("_al_role"), F.col("alias").alias("_alias"))
    x = frame.join(al, frame[role_col] == al["_al_role"], "left")
    normalized = F.coalesce(F.col("_alias"), F.col(role_col))
    x = x.join(lad_a, (x[dept_col] == lad_a["_da"]) & (normalized == lad_a["_ra"]), "left")
    x = x.join(lad_r, (x[dept_col] == lad_r["_dr"]) & (x[role_col] == lad_r["_rr"]), "left")
    x = x.join(sizes, x[dept_col] == sizes["_ds"], "left")
    position = F.coalesce(
        F.col("_pa"),
        F.col("_pr"),
        F.when(F.col("_len").isNull(), F.lit(0)).otherwise(F.greatest(F.col("_len") - 1, F.lit(0))),
    ).cast("int")
    return x.select(*frame.columns, position.alias("role_level"))
