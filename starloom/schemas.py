"""Table schemas and the constraints the operational and star schemas declare.

Spark enforces none of NOT NULL / PRIMARY KEY / UNIQUE / FOREIGN KEY / CHECK on
parquet, so they are kept here as data and evaluated by
``starloom.operators.quality``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


INT = T.IntegerType()
LONG = T.LongType()
STR = T.StringType()
DATE = T.DateType()
BOOL = T.BooleanType()
SALARY = T.DecimalType(12, 2)
BUDGET = T.DecimalType(14, 2)
PCT = T.DecimalType(5, 2)

# -- operational (current state + versioned history) -------------------------
DEPARTMENTS = _schema(("dept_id", INT, False), ("dept_name", STR, False))

EMPLOYEES = _schema(
    ("employee_id", LONG, False),
    ("name", STR, False),
    ("email", STR, False),
    ("dept_id", INT, False),
    ("hire_date", DATE, False),
    ("current_salary", SALARY, False),
    ("current_role", STR, False),
    ("status", STR, False),
)

PROJECTS = _schema(
    ("project_id", LONG, False),
    ("project_name", STR, False),
    ("start_date", DATE, False),
    ("end_date", DATE, True),
    ("budget", BUDGET, False),
)

ASSIGNMENTS = _schema(
    ("assignment_id", LONG, False),
    ("employee_id", LONG, False),
    ("project_id", LONG, False),
    ("allocation_pct", PCT, False),
    ("start_date", DATE, False),
    ("end_date", DATE, True),
)

EMPLOYEE_HISTORY = _schema(
    ("history_id", LONG, False),
    ("employee_id", LONG, False),
    ("role", STR, False),
    ("salary", SALARY, False),
    ("effective_start", DATE, False),
    ("effective_end", DATE, True),
    ("is_current", BOOL, False),
)

# The attribute snapshot file: the seven columns the warehouse reads (fixed values).
ATTRITION_CSV_COLUMNS = (
    "EmployeeNumber",
    "Attrition",
    "JobSatisfaction",
    "WorkLifeBalance",
    "OverTime",
    "PerformanceRating",
    "DistanceFromHome",
)

# The raw snapshot columns an ingest requires (fixed values).
RAW_REQUIRED_COLUMNS = (
    "EmployeeNumber",
    "Department",
    "JobRole",
    "MonthlyIncome",
    "Attrition",
    "YearsAtCompany",
    "YearsInCurrentRole",
    "YearsSinceLastPromotion",
    "PercentSalaryHike",
    "Gender",
)

# -- star schema ---------------------------------------------------------------
DIM_DATE = _schema(
    ("date_key", INT, False),
    ("full_date", DATE, False),
    ("month", INT, False),
    ("quarter", INT, False),
    ("year", INT, False),
)

DIM_DEPARTMENT = _schema(("department_key", LONG, False), ("dept_name", STR, False))

DIM_PROJECT = _schema(
    ("project_key", LONG, False), ("project_name", STR, False), ("budget", BUDGET, False)
)

DIM_EMPLOYEE = _schema(
    ("employee_key", LONG, False),
    ("employee_id", LONG, False),
    ("name", STR, False),
    ("role", STR, False),
    ("is_current", BOOL, False),
    ("effective_start", DATE, False),
    ("effective_end", DATE, True),
)

FACT_EMPLOYEE_PERFORMANCE = _schema(
    ("assignment_id", LONG, False),
    ("employee_key", LONG, False),
    ("department_key", LONG, False),
    ("project_key", LONG, False),
    ("date_key", INT, False),
    ("salary", SALARY, True),
    ("allocation_pct", PCT, True),
    ("tenure_days", INT, True),
    ("is_attrition_flag", BOOL, True),
    ("job_satisfaction", INT, True),
    ("work_life_balance", INT, True),
    ("overtime", BOOL, True),
    ("performance_rating", INT, True),
    ("distance_from_home", INT, True),
)

SCD2_CHANGES = _schema(
    ("employee_id", LONG, True),
    ("action", STR, False),
    ("employee_key", LONG, True),
    ("name", STR, True),
    ("role", STR, True),
    ("effective_start", DATE, True),
    ("close_date", DATE, True),
    ("reason", STR, True),
)

FACT_REJECTS = _schema(
    ("assignment_id", LONG, True),
    ("employee_id", LONG, True),
    ("project_id", LONG, True),
    ("dept_name", STR, True),
    ("project_name", STR, True),
    ("missing_keys", STR, True),
)

DIM_PROJECT_CHANGES = _schema(
    ("project_key", LONG, True),
    ("project_name", STR, True),
    ("budget", BUDGET, True),
    ("action", STR, False),
)

ROLE_CHANGE_REJECTS = _schema(
    ("change_id", LONG, True),
    ("employee_id", LONG, True),
    ("effective_start", DATE, True),
    ("reason", STR, True),
)

FACT_COLUMNS = tuple(f.name for f in FACT_EMPLOYEE_PERFORMANCE.fields)

SCHEMAS: dict[str, T.StructType] = {
    "departments": DEPARTMENTS,
    "employees": EMPLOYEES,
    "projects": PROJECTS,
    "assignments": ASSIGNMENTS,
    "employee_history": EMPLOYEE_HISTORY,
    "dim_date": DIM_DATE,
    "dim_department": DIM_DEPARTMENT,
    "dim_project": DIM_PROJECT,
    "dim_employee": DIM_EMPLOYEE,
    "fact_employee_performance": FACT_EMPLOYEE_PERFORMANCE,
}


# -- declared constraints (fixed values: columns, expressions and the names of
# CHECK rules as the DDL states them; the names of key rules, and of CHECKs
# that the DDL leaves unnamed, are built by ``operators.quality``) -----------
@dataclass(frozen=True)
class TableRules:
    primary_key: tuple[str, ...]
    not_null: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    # (columns, parent table, parent columns)
    foreign_keys: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = ()
    # (rule name, SQL boolean that must not be FALSE)
    checks: tuple[tuple[str, str], ...] = ()
    extra: dict = field(default_factory=dict)


RULES: dict[str, TableRules] = {
    "departments": TableRules(
        primary_key=("dept_id",),
        not_null=("dept_id", "dept_name"),
        unique=(("dept_name",),),
    ),
    "employees": TableRules(
        primary_key=("employee_id",),
        not_null=(
            "employee_id", "name", "email", "dept_id", "hire_date",
            "current_salary", "current_role", "status",
        ),
        unique=(("email",),),
        foreign_keys=((("dept_id",), "departments", ("dept_id",)),),
        checks=(("chk_employees_status", "status IN ('Active', 'Terminated')"),),
    ),
    "projects": TableRules(
        primary_key=("project_id",),
        not_null=("project_id", "project_name", "start_date", "budget"),
        checks=(
            ("chk_projects_dates", "end_date IS NULL OR end_date >= start_date"),
            ("chk_projects_budget", "budget >= 0"),
        ),
    ),
    "assignments": TableRules(
        primary_key=("assignment_id",),
        not_null=("assignment_id", "employee_id", "project_id", "allocation_pct", "start_date"),
        foreign_keys=(
            (("employee_id",), "employees", ("employee_id",)),
            (("project_id",), "projects", ("project_id",)),
        ),
        checks=(
            ("chk_assignments_allocation_pct", "allocation_pct > 0 AND allocation_pct <= 100"),
            ("chk_assignments_dates", "end_date IS NULL OR end_date >= start_date"),
        ),
    ),
    "employee_history": TableRules(
        primary_key=("history_id",),
        not_null=("history_id", "employee_id", "role", "salary", "effective_start", "is_current"),
        foreign_keys=((("employee_id",), "employees", ("employee_id",)),),
        checks=(
            ("chk_employee_history_dates", "effective_end IS NULL OR effective_end >= effective_start"),
            ("chk_employee_history_salary", "salary >= 0"),
        ),
    ),
    "dim_date": TableRules(
        primary_key=("date_key",),
        not_null=("date_key", "full_date", "month", "quarter", "year"),
        unique=(("full_date",),),
        checks=(
            ("chk_dim_date_month", "month >= 0"),
            ("chk_dim_date_quarter", "quarter >= 0"),
            ("chk_dim_date_year", "year >= 0"),
        ),
    ),
    "dim_department": TableRules(
        primary_key=("department_key",),
        not_null=("department_key", "dept_name"),
        unique=(("dept_name",),),
    ),
    "dim_project": TableRules(
        primary_key=("project_key",),
        not_null=("project_key", "project_name", "budget"),
        checks=(("chk_dim_project_budget", "budget >= 0"),),
    ),
    "dim_employee": TableRules(
        primary_key=("employee_key",),
        not_null=("employee_key", "employee_id", "name", "role", "is_current", "effective_start"),
        checks=(
            ("chk_dim_employee_dates", "effective_end IS NULL OR effective_end >= effective_start"),
        ),
    ),
    "fact_employee_performance": TableRules(
        primary_key=("assignment_id", "date_key"),
        not_null=FACT_COLUMNS,
        foreign_keys=(
            (("employee_key",), "dim_employee", ("employee_key",)),
            (("department_key",), "dim_department", ("department_key",)),
            (("project_key",), "dim_project", ("project_key",)),
            (("date_key",), "dim_date", ("date_key",)),
        ),
        checks=(
            ("chk_fact_salary", "salary >= 0"),
            ("chk_fact_allocation_pct", "allocation_pct > 0 AND allocation_pct <= 100"),
            ("chk_fact_tenure_days", "tenure_days >= 0"),
            ("chk_fact_job_satisfaction", "job_satisfaction BETWEEN 1 AND 4"),
            ("chk_fact_work_life_balance", "work_life_balance BETWEEN 1 AND 4"),
            ("chk_fact_performance_rating", "performance_rating BETWEEN 1 AND 4"),
            ("chk_fact_distance_from_home", "distance_from_home >= 0"),
        ),
    ),
}
