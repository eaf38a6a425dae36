"""The attribute snapshot file.

The file is read with the header and every column as text (no inference);
only the named columns are kept, then cast.  With ANSI mode on, a malformed
number fails the cast instead of becoming NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.schemas import ATTRITION_CSV_COLUMNS, RAW_REQUIRED_COLUMNS

ATTRITION_TYPES = {
    "EmployeeNumber": "bigint",
    "Attrition": "string",
    "JobSatisfaction": "int",
    "WorkLifeBalance": "int",
    "OverTime": "string",
    "PerformanceRating": "int",
    "DistanceFromHome": "int",
}


def require_columns(df: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Fail fast (at plan time) when a required column is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"snapshot is missing required columns: {missing}")
    return df


def read_attrition_csv(spark: SparkSession, path: str) -> DataFrame:
    """The seven snapshot columns the fact uses, typed, with their file names."""
    raw = spark.read.option("header", True).csv(path)
    require_columns(raw, ATTRITION_CSV_COLUMNS)
    return raw.select(
        [F.trim(F.col(c)).cast(ATTRITION_TYPES[c]).alias(c) for c in ATTRITION_CSV_COLUMNS]
    )


def read_raw_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The full snapshot for ingest, all text, after the required-column check."""
    raw = spark.read.option("header", True).csv(path)
    return require_columns(raw, RAW_REQUIRED_COLUMNS)
