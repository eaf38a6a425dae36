"""Readers: parquet or JDBC tables, the attribute snapshot CSV, staging views."""

from starloom.sources.csv import read_attrition_csv, read_raw_snapshot
from starloom.sources.tables import (
    TableSource,
    extract_all,
    read_or_empty,
    read_table,
    register_database,
    run_sql,
)

__all__ = [
    "TableSource",
    "extract_all",
    "read_attrition_csv",
    "read_or_empty",
    "read_raw_snapshot",
    "read_table",
    "register_database",
    "run_sql",
]
