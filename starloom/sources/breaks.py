"""The staged tables with rows that break each declared rule.

For every constraint of a table a fixed share of its rows, picked by a residue
of their key, gets one column changed so that the rule fails.  The same CASE
expressions serve Spark and the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from starloom.schemas import RULES, SCHEMAS

#: What makes each CHECK fail: the column and its value.
BROKEN_CHECKS: dict[str, tuple[str, str]] = {
    "chk_employees_status": ("status", "'Gone'"),
    "chk_projects_dates": ("end_date", "start_date - 1"),
    "chk_projects_budget": ("budget", "-1"),
    "chk_assignments_allocation_pct": ("allocation_pct", "0"),
    "chk_assignments_dates": ("end_date", "start_date - 1"),
    "chk_employee_history_dates": ("effective_end", "effective_start - 1"),
    "chk_employee_history_salary": ("salary", "-1"),
    "chk_dim_date_month": ("month", "-1"),
    "chk_dim_date_quarter": ("quarter", "-1"),
    "chk_dim_date_year": ("year", "-1"),
    "chk_dim_project_budget": ("budget", "-1"),
    "chk_dim_employee_dates": ("effective_end", "effective_start - 1"),
    "chk_fact_salary": ("salary", "-1"),
    "chk_fact_allocation_pct": ("allocation_pct", "101"),
    "chk_fact_tenure_days": ("tenure_days", "-1"),
    "chk_fact_job_satisfaction": ("job_satisfaction", "9"),
    "chk_fact_work_life_balance": ("work_life_balance", "0"),
    "chk_fact_performance_rating": ("performance_rating", "9"),
    "chk_fact_distance_from_home": ("distance_from_home", "-1"),
}
#: A value that all rows of a broken key share, by the column's type.
SHARED = {"string": "'shared'", "date": "DATE '2030-01-01'"}


def breaks(table: str) -> list[tuple[str, str, str]]:
    """``(constraint, column, value)`` for every declared rule of the table."""
    rules = RULES[table]
    types = {f.name: f.dataType.simpleString() for f in SCHEMAS[table].fields}
    out = [(f"nn_{table}_{c}", c, "NULL") for c in rules.not_null]
    out += [(name, *BROKEN_CHECKS[name]) for name, _ in rules.checks]
    if rules.primary_key:
        out.append((f"pk_{table}", rules.primary_key[0], "-7"))
    out += [(f"uq_{table}_{cols[0]}", cols[0], SHARED[types[cols[0]]]) for cols in rules.unique]
    return out + [(f"fk_{table}_{cols[0]}", cols[0], "-5") for cols, _, _ in rules.foreign_keys]


def broken_columns(table: str) -> list[tuple[str, str]]:
    """``(column, SQL)`` of the table with its rules broken; over half of the rows stay as they are."""
    keys = RULES[table].primary_key
    found = breaks(table)
    row = f"(({' + '.join(keys)}) % {2 * len(found) + 1})"
    out = []
    for f in SCHEMAS[table].fields:
        cases = " ".join(f"WHEN {row} = {k} THEN {value}" for k, (_, column, value) in enumerate(found) if column == f.name)
        out.append((f.name, f"CASE {cases} ELSE {f.name} END" if cases else f.name))
    return out


def with_broken_rules(df: DataFrame, table: str) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in SCHEMAS[table].fields}
    return df.selectExpr(*[f"CAST({sql} AS {types[name]}) AS {name}" for name, sql in broken_columns(table)])
