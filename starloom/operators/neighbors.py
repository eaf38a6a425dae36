"""Skew-safe rank over an ordered value.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task; if one
department holds a third of the rows, that task holds a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_desc(
    df: DataFrame,
    group_cols: Sequence[str],
    order_col: str,
    out: str = "rank",
    max_rank: int | None = None,
) -> DataFrame:
    """SQL ``RANK() OVER (PARTITION BY group ORDER BY order_col DESC)``.

    Rank = 1 + number of rows in the group with a larger value, computed on the
    per-(group, value) counts (bounded by the distinct values, e.g. days) and
    joined back, so no group is ever sorted whole in one task.  NULLs rank
    last, as ``DESC`` orders them.  ``max_rank`` keeps ranks ``<= max_rank``
    (top-N with ties) before the join.
    """
    group_cols = list(group_cols)
    counts = df.groupBy(*group_cols, order_col).agg(F.count(F.lit(1)).alias("_n"))
    w = (
        Window.partitionBy(*group_cols)
        .orderBy(F.col(order_col).desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = counts.select(
        *[F.col(c).alias(f"_r_{c}") for c in group_cols],
        F.col(order_col).alias(f"_r_{order_col}"),
        (F.coalesce(F.sum("_n").over(w), F.lit(0)) + 1).cast("int").alias(out),
    )
    if max_rank is not None:
        ranks = ranks.filter(F.col(out) <= max_rank)
    cond = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in [*group_cols, order_col]]
    joined = df.join(ranks, cond, "inner")
    return joined.drop(*[f"_r_{c}" for c in [*group_cols, order_col]])
