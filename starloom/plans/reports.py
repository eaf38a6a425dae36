"""Reports over the star schema and the operational tables.

Each report reduces the fact to the grain it needs (a partial aggregate
before any shuffle), then joins the dimensions, so the large fact is never
shuffled row by row for a report.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.dates import as_date_literal, month_end, month_label, month_start
from starloom.functions.values import employee_label, period_label
from starloom.operators.neighbors import rank_desc


def _current_keys(dim_employee: DataFrame) -> DataFrame:
    return dim_employee.where(F.col("is_current")).select("employee_key", "employee_id", "name")


def tenure_ranking(
    fact: DataFrame,
    dim_employee: DataFrame,
    dim_department: DataFrame,
    top_n: int | None = None,
) -> DataFrame:
    """``RANK()`` of tenure within each department; ``top_n`` keeps ties.

    Columns: ``employee_id, employee_name, dept_name, tenure_days, tenure_rank``.
    """
    grain = fact.select("employee_key", "department_key", "tenure_days").distinct()
    rows = (
        grain.join(_current_keys(dim_employee), "employee_key", "inner")
        .join(dim_department.select("department_key", "dept_name"), "department_key", "inner")
        .select(
            "employee_id", F.col("name").alias("employee_name"), "dept_name", "tenure_days"
        )
        .distinct()
    )
    ranked = rank_desc(rows, ["dept_name"], "tenure_days", "tenure_rank", max_rank=top_n)
    return ranked.select("employee_id", "employee_name", "dept_name", "tenure_days", "tenure_rank")


def _snapshot_attrition(fact: DataFrame, dim_employee: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Leavers per snapshot month: distinct employees flagged in that month."""
    grain = fact.select("employee_key", "date_key", "is_attrition_flag").distinct()
    snap = (
        grain.join(_current_keys(dim_employee).drop("name"), "employee_key", "inner")
        .join(dim_date.select("date_key", "year", "month"), "date_key", "inner")
        .select("employee_id", "year", "month", "is_attrition_flag")
        .distinct()
    )
    return snap.groupBy("year", "month").agg(
        F.count_if(F.col("is_attrition_flag")).alias("attrition_count")
    )


def _finish_attrition(headcount: DataFrame, attrition: DataFrame) -> DataFrame:
    joined = headcount.join(attrition, ["year", "month"], "left")
    count = F.coalesce(F.col("attrition_count"), F.lit(0)).cast("long")
    rate = F.round(
        F.expr("100.0") * count / F.nullif(F.col("active_headcount"), F.lit(0)), 2
    ).cast("decimal(12,2)")
    return joined.where(F.col("active_headcount") > 0).select(
        month_label(month_start("year", "month")).alias("report_month"),
        F.col("active_headcount").cast("long").alias("active_headcount"),
        count.alias("attrition_count"),
        rate.alias("monthly_attrition_rate_pct"),
    )


def monthly_headcount(dim_date: DataFrame, employees: DataFrame) -> DataFrame:
    """``year, month, month_end, active_headcount`` for every month of the calendar (the headcount part of R2).

    Headcount of a month = employees hired on or before its last day, never
    reduced by leavers (D10).  Instead of joining every employee to every
    month (``hire_date <= month_end``), hires are counted per month of each
    employee's earliest hire date and summed cumulatively over the month
    spine (dim_date months plus hire months).  The spine has one row per
    calendar month, so the window is small whatever the data size.  Counting
    each id once by its earliest hire keeps ``COUNT(DISTINCT employee_id)``
    exact even when an id repeats.
    """
    months = dim_date.select("year", "month").distinct()
    first_hire = employees.groupBy("employee_id").agg(F.min("hire_date").alias("_h"))
    hires = (
        first_hire.where(F.col("_h").isNotNull())
        .groupBy(F.year("_h").alias("year"), F.month("_h").alias("month"))
        .agg(F.count(F.lit(1)).alias("_hired"))
    )
    spine = months.withColumn("_reported", F.lit(True)).join(hires, ["year", "month"], "full_outer")
    upto = Window.orderBy("year", "month").rowsBetween(Window.unboundedPreceding, 0)
    return spine.select(
        "year", "month", month_end("year", "month").alias("month_end"), "_reported",
        F.sum(F.coalesce(F.col("_hired"), F.lit(0))).over(upto).alias("active_headcount"),
    ).where(F.col("_reported")).drop("_reported")


def monthly_attrition(
    fact: DataFrame, dim_employee: DataFrame, dim_date: DataFrame, employees: DataFrame
) -> DataFrame:
    """R2 in its scale form (R2b): leavers of the snapshot's month over the month's headcount."""
    headcount = monthly_headcount(dim_date, employees).drop("month_end")
    return _finish_attrition(headcount, _snapshot_attrition(fact, dim_employee, dim_date))


def headcount_by_department(
    fact: DataFrame, dim_department: DataFrame, dim_employee: DataFrame
) -> DataFrame:
    """Distinct current employees per department in the fact."""
    grain = fact.select("employee_key", "department_key").distinct()
    rows = grain.join(_current_keys(dim_employee).drop("name"), "employee_key", "inner").join(
        dim_department.select("department_key", "dept_name"), "department_key", "inner"
    )
    return rows.groupBy("dept_name").agg(F.count_distinct("employee_id").alias("headcount"))


def employee_salary_history(history: DataFrame, employee_id: int | None = None) -> DataFrame:
    """Role and salary versions with a period label (one employee or all)."""
    rows = history
    if employee_id is not None:
        rows = rows.where(F.col("employee_id") == F.lit(employee_id))
    return rows.select(
        "employee_id", "effective_start", "effective_end", "role", "salary", "is_current",
        period_label("effective_start", "effective_end").alias("period_label"),
    )


def department_salary_trend(
    history: DataFrame,
    employees: DataFrame,
    departments: DataFrame,
    dept_name: str | None = None,
) -> DataFrame:
    """Versions, average, min and max salary per department, month and role.

    ``dept_name=None`` answers every department in one pass.
    """
    depts = departments.select("dept_id", "dept_name")
    if dept_name is not None:
        depts = depts.where(F.col("dept_name") == F.lit(dept_name))
    # versions are reduced per (employee, month, role) before any shuffle, so a
    # burst of versions of one employee crosses the network as one row
    per_employee = history.groupBy(
        "employee_id", month_label("effective_start").alias("salary_month"), "role"
    ).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("salary").alias("_sum"),
        F.min("salary").alias("_min"),
        F.max("salary").alias("_max"),
    )
    rows = per_employee.join(employees.select("employee_id", "dept_id"), "employee_id", "inner").join(
        depts, "dept_id", "inner"
    )
    return rows.groupBy("dept_name", "salary_month", "role").agg(
        F.sum("_n").alias("employee_versions"),
        F.round(F.sum("_sum") / F.sum("_n"), 2).cast("decimal(12,2)").alias("avg_salary"),
        F.round(F.min("_min"), 2).cast("decimal(12,2)").alias("min_salary"),
        F.round(F.max("_max"), 2).cast("decimal(12,2)").alias("max_salary"),
    )


def picklists(departments: DataFrame, projects: DataFrame, employees: DataFrame) -> DataFrame:
    """Departments, projects and employees as ``(kind, item_id, label,
    start_date, end_date)``; the dates are the projects'."""
    undated = [F.lit(None).cast("date").alias(c) for c in ("start_date", "end_date")]
    return (
        departments.select(
            F.lit("department").alias("kind"), F.col("dept_id").cast("long").alias("item_id"),
            F.col("dept_name").alias("label"), *undated,
        )
        .unionByName(
            projects.select(
                F.lit("project").alias("kind"), F.col("project_id").cast("long").alias("item_id"),
                F.col("project_name").alias("label"), "start_date", "end_date",
            )
        )
        .unionByName(
            employees.select(
                F.lit("employee").alias("kind"), F.col("employee_id").cast("long").alias("item_id"),
                employee_label("name", "current_role").alias("label"), *undated,
            )
        )
    )


def active_projects(projects: DataFrame, as_of: dt.date) -> DataFrame:
    """Projects open on ``as_of``; all projects when none is open."""
    active = F.col("end_date").isNull() | (F.col("end_date") >= as_date_literal(as_of))
    none_active = ~projects.where(active).exists()
    return projects.where(active | none_active)


# Presentation order of each report (O1).  Reports are unordered DataFrames;
# a caller that shows one sorts it last, with a distributed range sort.
DISPLAY_ORDER: dict[str, tuple[str, ...]] = {
    "tenure_ranking": ("dept_name", "tenure_rank"),
    "monthly_attrition": ("report_month",),
    "headcount_by_department": ("dept_name",),
    "employee_salary_history": ("employee_id", "effective_start"),
    "department_salary_trend": ("dept_name", "salary_month", "role"),
    "picklists": ("kind", "label", "item_id"),
    "scd2_versions": ("employee_id", "effective_start"),
}


def for_display(df: DataFrame, report: str) -> DataFrame:
    """Sort a report the way it is presented (NULLs first, ascending)."""
    return df.orderBy(*DISPLAY_ORDER[report])
