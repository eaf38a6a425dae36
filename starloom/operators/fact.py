"""The per-snapshot performance fact (D-FACT, J4-J9, P9-P16, Q5, Q6).

Grain: one row per assignment of an employee who has a current dimension
row, stamped with the snapshot date key.  Everything keyed by employee is
joined first at the employee grain (one row per employee).  The large
assignment table is shuffled once by ``project_id`` and then once by
``employee_id``, so the many columns of an employee are added last and never
shuffled per assignment.  Both joins hash the smaller side, a row per project or
employee, and stream the assignments, which are never sorted and so never spill.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import as_date_literal, date_key_of
from starloom.functions.values import conformed, money, tenure_days
from starloom.operators.scd2 import versions_at
from starloom.schemas import FACT_COLUMNS

ATTRIBUTE_DEFAULTS = {
    # Neutral values for staff absent from the snapshot (fixed values).
    "job_satisfaction": 3,
    "work_life_balance": 3,
    "overtime": False,
    "performance_rating": 3,
    "distance_from_home": 0,
}
KEY_COLUMNS = ("employee_key", "department_key", "project_key")


def require_snapshot_date(dim_date: DataFrame, as_of: dt.date) -> None:
    """Q5: the snapshot's date key must already be in the date dimension."""
    key = date_key_of(as_of)
    if dim_date.where(F.col("date_key") == F.lit(key)).isEmpty():
        raise ValueError(f"as-of date key {key} is missing from dim_date")


def employee_profile(
    employees: DataFrame,
    attrition: DataFrame,
    dim_employee: DataFrame,
    dim_department: DataFrame,
    collation: str | None = None,
    valid_on: dt.date | None = None,
) -> DataFrame:
    """Everything the fact needs per employee, one row per current dim key.

    ``collation`` matches department names under it (D9); binary by default.
    With ``valid_on`` (D20) each employee has the key of the version that covers
    that day, NULL where none does, instead of the current one.
    """
    if valid_on is None:
        keys = dim_employee.where(F.col("is_current")).select("employee_key", "employee_id")
    else:
        asked = employees.select("employee_id").distinct().withColumn("_on", as_date_literal(valid_on))
        keys = versions_at(asked, dim_employee, "_on").drop("_on")
    staff = employees.select("employee_id", "dept_name", "hire_date", "current_salary", "status")
    depts = dim_department.select("department_key", F.col("dept_name").alias("_dim_name"))
    staff = staff.join(
        depts, conformed("dept_name", collation) == conformed("_dim_name", collation), "left"
    ).drop("_dim_name")
    snapshot = attrition.withColumn("_in_snapshot", F.lit(True))
    return keys.join(staff, "employee_id", "left").join(snapshot, "employee_id", "left")


def project_lookup(projects: DataFrame, dim_project: DataFrame, collation: str | None = None) -> DataFrame:
    """project_id -> project_key through the project name (J4 + J8)."""
    names = dim_project.select("project_key", F.col("project_name").alias("_dim_name"))
    return projects.select("project_id", "project_name").join(
        names, conformed("project_name", collation) == conformed("_dim_name", collation), "left"
    ).drop("_dim_name")


def enriched_assignments(
    employees: DataFrame,
    projects: DataFrame,
    assignments: DataFrame,
    attrition: DataFrame,
    dim_employee: DataFrame,
    dim_department: DataFrame,
    dim_project: DataFrame,
    as_of: dt.date,
    collation: str | None = None,
    point_in_time: bool = False,
) -> DataFrame:
    """Assignment rows with every fact column plus their natural keys.

    By default employees have their current dimension row, whenever it starts;
    with ``point_in_time`` the one that covers ``as_of`` (D20).
    """
    profile = employee_profile(employees, attrition, dim_employee, dim_department, collation,
                               as_of if point_in_time else None)
    rows = (
        assignments.select("assignment_id", "employee_id", "project_id", "allocation_pct")
        .join(project_lookup(projects, dim_project, collation).hint("shuffle_hash"), "project_id", "left")
        .join(profile.hint("shuffle_hash"), "employee_id", "inner")
    )
    matched = F.col("_in_snapshot").isNotNull()

    def attr(name: str):
        return F.when(matched, F.col(name)).otherwise(F.lit(ATTRIBUTE_DEFAULTS[name]))

    terminated = F.coalesce(F.lower(F.col("status")) == F.lit("terminated"), F.lit(False))
    return rows.select(
        "assignment_id",
        "employee_id",
        "project_id",
        "dept_name",
        "project_name",
        *KEY_COLUMNS,
        F.lit(date_key_of(as_of)).alias("date_key"),
        money("current_salary").alias("salary"),
        money("allocation_pct", 5).alias("allocation_pct"),
        tenure_days(as_date_literal(as_of), "hire_date").alias("tenure_days"),
        F.when(matched, F.col("is_attrition_flag")).otherwise(terminated).alias(
            "is_attrition_flag"
        ),
        attr("job_satisfaction").alias("job_satisfaction"),
        attr("work_life_balance").alias("work_life_balance"),
        attr("overtime").alias("overtime"),
        attr("performance_rating").alias("performance_rating"),
        attr("distance_from_home").alias("distance_from_home"),
    )


def has_keys():
    """All three dimension keys were found."""
    ok = F.lit(True)
    for k in KEY_COLUMNS:
        ok = ok & F.col(k).isNotNull()
    return ok


def fact_from_enriched(enriched: DataFrame) -> DataFrame:
    """Rows with all three dimension keys, in the fact's column order."""
    return enriched.where(has_keys()).select(*FACT_COLUMNS)


def rejects_from_enriched(enriched: DataFrame) -> DataFrame:
    """Q6: rows the fact drops for a missing key, with the keys that are missing."""
    missing = F.concat_ws(
        ",", *[F.when(F.col(k).isNull(), F.lit(k)) for k in KEY_COLUMNS]
    )
    return enriched.where(~has_keys()).select(
        "assignment_id", "employee_id", "project_id", "dept_name", "project_name",
        missing.alias("missing_keys"),
    )


def build_fact(
    employees: DataFrame,
    projects: DataFrame,
    assignments: DataFrame,
    attrition: DataFrame,
    dim_employee: DataFrame,
    dim_department: DataFrame,
    dim_project: DataFrame,
    dim_date: DataFrame,
    as_of: dt.date,
) -> tuple[DataFrame, DataFrame]:
    """``(fact, rejects)`` for one snapshot; raises when the date key is absent."""
    require_snapshot_date(dim_date, as_of)
    enriched = enriched_assignments(
        employees, projects, assignments, attrition, dim_employee, dim_department,
        dim_project, as_of,
    )
    return fact_from_enriched(enriched), rejects_from_enriched(enriched)
