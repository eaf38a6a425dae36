"""Keep-first / keep-last per key as aggregates.

``min(struct(order..., rest...))`` picks the first row in a total order and
is computed with a partial (map-side) aggregate, so a key that holds a large
share of the rows is combined before the shuffle instead of landing whole in
one window partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: bool) -> DataFrame:
    keys = list(keys)
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.select(keys).distinct()
    if not rest and len(order) == 1:
        fn = F.min if first else F.max
        return df.groupBy(*keys).agg(fn(order[0]).alias(order[0])).select(df.columns)
    # the whole ordering (all columns) decides, so ties resolve the same way everywhere
    packed = F.struct(*[F.col(c) for c in order + rest])
    fn = F.min if first else F.max
    picked = df.groupBy(*keys).agg(fn(packed).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in order + rest]).select(
        df.columns
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order``, remaining columns break ties."""
    return _pick(df, keys, order, first=True)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the largest by ``order``, remaining columns break ties."""
    return _pick(df, keys, order, first=False)
