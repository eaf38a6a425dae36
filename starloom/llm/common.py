"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import checkpoint_dir

#: A table of at most this many narrow rows may be broadcast (a few MB);
#: beyond it the same join is a shuffle join.
BROADCAST_ROWS = 100_000


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, with its lineage cut.

    Rows, and the partition each of them lies in, stay as they are when a lost
    executor's tasks run again.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``limit`` rows (counted), else as it is."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def whole_text(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def retain(docs: DataFrame, keys: dict[str, Column], decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``decisions`` keeps, with their own columns only.

    ``keys`` names expressions over ``docs`` that identify a row up to exact
    repeats.  ``decisions`` has one row per key: the keys, ``n_rows`` (rows of
    ``docs`` with that key) and ``keep``.  Of repeated rows with a kept key one
    stays: the one whose JSON form is largest.  Keys match null-safely.
    """
    names = list(keys)
    inner = [f"_key{i}" for i in range(len(names))]
    rows = docs.select(F.struct(F.col("*")).alias("_row"),
                       *[keys[n].alias(k) for n, k in zip(names, inner, strict=True)])
    marks = decisions.select(*[F.col(n).alias(f"{k}d") for n, k in zip(names, inner, strict=True)],
                             "n_rows", "keep")
    match = None
    for k in inner:
        one = F.col(k).eqNullSafe(F.col(f"{k}d"))
        match = one if match is None else match & one
    dropped = small(marks.where(~F.col("keep")).drop("n_rows", "keep"))
    kept = rows.join(dropped, match, "left_anti")
    repeats = marks.where(F.col("keep") & (F.col("n_rows") > 1)).drop("n_rows", "keep")
    if repeats.isEmpty():
        return kept.select("_row.*")
    repeats = small(repeats)
    one_of = (kept.join(repeats, match, "left_semi").groupBy(*inner)
              .agg(F.max_by("_row", F.to_json("_row")).alias("_row")))
    return (kept.join(repeats, match, "left_anti").select("_row")
            .unionByName(one_of.select("_row")).select("_row.*"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of the undirected ``edges``: the smallest node it reaches.

    Large-star and small-star steps in turn, each a grouping and a join by
    node, until no edge changes; a node with very many edges is pre-aggregated
    and its join partition split by AQE.  Every step is settled, so a lost
    executor repeats one step only.  Nodes are non-null longs.
    """
    links = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where("u > v").distinct())
    links = settled(links)
    mark = _mark(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u > v")
        # each u is now the larger end of its edges, so its smallest neighbour is its minimum
        large = large.distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        step = large.join(lowest, "u")
        nxt = (step.select("u", F.col("m").alias("v"))
               .unionByName(step.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")))
               .distinct())
        nxt = settled(nxt)
        before, mark = mark, _mark(nxt)
        if mark == before:
            break
        links = nxt
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(
        roots.select(F.col("root").alias("node"), "root").distinct())


def _mark(links: DataFrame) -> tuple:
    """Row count and order-free checksum of an edge table."""
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                    F.sum(F.xxhash64("v", "u").cast("decimal(20,0)")).alias("s")).first()
    return tuple(row)
