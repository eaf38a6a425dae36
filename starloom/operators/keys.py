"""Dense surrogate keys without a global sort.

A global ``row_number()`` runs in a single task.  Instead rows are spread over
a fixed number of buckets by a hash of the first order column (so ids that
share a stride spread as well as any), numbered inside each bucket, and shifted
by the running total of the smaller buckets.  A bucket is named by the first
three hex digits of an MD5, which SQL engines agree on; the offsets table has at
most 4,096 rows, so broadcasting it is bounded by construction.  Keys are dense (``base+1 .. base+n``), unique and
deterministic; the bucket count is a fixed constant so the same input always
receives the same keys, whatever the cluster size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DIGITS = 3  # hex digits: 4,096 buckets


def next_key_base(existing: DataFrame | None, key_col: str) -> Column:
    """``COALESCE(MAX(key), 0)`` of an existing table, as an in-plan scalar."""
    if existing is None:
        return F.lit(0).cast("long")
    return existing.select(F.coalesce(F.max(key_col), F.lit(0)).cast("long")).scalar()


def largest_key(df: DataFrame, key_col: str) -> int:
    """``COALESCE(MAX(key), 0)`` as a number (one small job)."""
    return df.agg(F.coalesce(F.max(key_col), F.lit(0)).cast("long")).first()[0]


def assign_dense_keys(
    df: DataFrame,
    order_cols: Sequence[str],
    key_col: str,
    base: Column | int = 0,
    spread: bool = False,
) -> DataFrame:
    """Add ``key_col`` numbered ``base + 1 ..`` in (bucket, ``order_cols``) order.

    The ``order_cols`` must be unique.  The bucket is a hash of the first one
    (near-unique: keys reproducible from the id alone), or with ``spread=True``
    of all of them, for inputs where one first-column value may repeat many
    times.
    """
    order_cols = list(order_cols)
    base_col = base if isinstance(base, Column) else F.lit(base)
    text = [F.col(c).cast("string") for c in (order_cols if spread else order_cols[:1])]
    d = df.withColumn("_kb", F.substring(F.md5(F.concat_ws("|", *text).cast("binary")), 1, BUCKET_DIGITS))
    counts = d.groupBy("_kb").agg(F.count(F.lit(1)).alias("_kc"))
    before = Window.orderBy("_kb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_kb", F.coalesce(F.sum("_kc").over(before), F.lit(0)).alias("_ko"))
    numbered = d.withColumn(
        "_kr", F.row_number().over(Window.partitionBy("_kb").orderBy(*order_cols))
    )
    keyed = numbered.join(F.broadcast(offsets), "_kb", "inner")
    return keyed.withColumn(
        key_col, (base_col + F.col("_ko") + F.col("_kr")).cast("long")
    ).drop("_kb", "_ko", "_kr")
