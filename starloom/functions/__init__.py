"""Column expressions shared by the operators (all built-in, codegen-friendly)."""

from starloom.functions.dates import (
    calendar_columns,
    date_key,
    month_end,
    month_label,
    month_start,
)
from starloom.functions.values import (
    conformed,
    employee_label,
    money,
    period_label,
    tenure_days,
    yes_no_flag,
)

__all__ = [
    "calendar_columns",
    "conformed",
    "date_key",
    "employee_label",
    "money",
    "month_end",
    "month_label",
    "month_start",
    "period_label",
    "tenure_days",
    "yes_no_flag",
]
