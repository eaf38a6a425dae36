"""Embedding near-dedup with a pivot-permutation index.

1. *Classes*: identical unit vectors are collapsed and counted.
2. *Pivots*: a bounded sample of vectors (the smallest hashes) with its mean taken
   away, thinned so that no two directions are alike; their number grows with the
   square root of the classes, up to ``PIVOTS_MOST``.  They are the only data that
   every task holds.  Without the mean, vectors with a common direction (usual for
   sentence embeddings) are told apart as well as others.
3. *Balls*: each pivot's near vectors give a centre; all vectors within half the
   linking angle of their nearest centre are linked to each other by the triangle
   inequality, so a crowd of near copies becomes one unit, whatever its size.
4. *Index*: a vector is described by its nearest pivots in order.  An inverted
   list per pair of pivots holds the units that have both, with the places the two
   have in the unit's order.  Units that meet in a list count it if either
   pivot's places differ by at most ``slack``; k pivots shared in this way give
   k (k - 1) / 2 lists, and units that share fewer than ``shared`` are dropped.  A
   long list is dealt over tasks by blocks.
5. *Verification*: angles between units first, then between members wherever
   the units' radii leave it open, in double precision.

How many pivots describe a vector, and ``shared`` and ``slack``, are measured on
vectors of the sample that are no pivots: turned by just the linking angle they
must be found again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import components, settled, small

#: Vectors that pivots are drawn from, at least, and for each pivot.
PIVOT_SAMPLE, SAMPLE_EACH = 4096, 2
#: Pivots per square root of the classes, and at least and at most.
PIVOTS_EACH, PIVOTS_LEAST, PIVOTS_MOST = 16, 32, 16_384
#: Pivots' directions, without the mean, have pairwise cosines below this.
APART = 0.6
#: Vectors on which the description is measured, what it must find again, and the choices.
MEASURED, RECALL = 512, 0.96
PREFIXES, SHARED, SLACKS = (6, 8, 10, 12, 16), (2, 3, 4, 5), (2, 3, 4, 6, 16)
#: Units of an inverted list that one task joins with the list.
LIST = 4096
#: Radians that cover rounding in angles.
MARGIN = 1e-6


class Description(NamedTuple):
    """Nearest pivots that describe a vector, how many of them two must share, and by how many places they may differ."""

    prefix: int
    shared: int
    slack: int


def unit_vector(components) -> bytes | None:
    """The float64 bytes of the vector scaled to length 1; None if that is not defined."""
    if components is None:
        return None
    v = np.array([np.nan if x is None else x for x in components], np.float64)
    top = np.abs(v).max(initial=0.0)
    if not np.isfinite(top) or top == 0 or np.isnan(v).any():
        return None
    v = v / top
    return ((v / np.sqrt(v @ v)) + 0.0).tobytes()


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = [unit_vector(x.as_py() if x.is_valid else None) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.binary())], ["vec_id", "vec"])


def _matrix(column: pa.Array | list, dim: int) -> np.ndarray:
    """Vectors as rows of ``dim`` components, cut or padded with zeros."""
    out = np.zeros((len(column), dim))
    rows = column if isinstance(column, list) else column.to_pylist()
    if all(len(r) == dim * 8 for r in rows):
        return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), dim)
    for i, r in enumerate(rows):
        v = np.frombuffer(r, np.float64)[:dim]
        out[i, :len(v)] = v
    return out


def _directions(vectors: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Unit vectors without the mean, scaled to length 1 again (0 if nothing is left)."""
    rest = vectors - mean
    size = np.sqrt((rest * rest).sum(axis=1, keepdims=True))
    return np.divide(rest, size, out=np.zeros_like(rest), where=size > 1e-9)


def _thin(directions: np.ndarray, limit: int) -> np.ndarray:
    """Rows, in order, that are not alike to an earlier one that stays; at least one."""
    kept = np.empty((limit, directions.shape[1]))
    rows: list[int] = []
    for i, v in enumerate(directions):
        if len(rows) == limit:
            break
        if not rows or (v.any() and (kept[:len(rows)] @ v).max() < APART):
            kept[len(rows)] = v
            rows.append(i)
    return np.array(rows)


def _nearest(vectors: np.ndarray, pivots: np.ndarray, offset: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of the ``prefix`` nearest pivots of each vector, nearest first."""
    away = offset - vectors @ pivots.T
    if prefix >= away.shape[1]:
        return np.argsort(away, axis=1, kind="stable")
    some = np.sort(np.argpartition(away, prefix - 1, axis=1)[:, :prefix], axis=1)
    return np.take_along_axis(some, np.argsort(np.take_along_axis(away, some, axis=1), axis=1, kind="stable"), axis=1)


def _shared(a: np.ndarray, b: np.ndarray, slack: int) -> np.ndarray:
    """How many pivots descriptions share with places that differ by at most ``slack`` (broadcast over rows)."""
    n = a.shape[-1]
    found = np.zeros(np.broadcast_shapes(a.shape[:-1], b.shape[:-1]), np.int16)
    for i in range(n):
        for j in range(max(0, i - slack), min(n, i + slack + 1)):
            found += a[..., i] == b[..., j]
    return found


def measured(sample: np.ndarray, pivots: np.ndarray, offset: np.ndarray, threshold: float) -> Description:
    """The cheapest description that finds ``RECALL`` of the sample's vectors again when turned by the linking angle.

    The shortest prefix by which two shared pivots are enough; then the most
    shared pivots and the least slack that lose no more, by how many pairs of
    the sample they let through.
    """
    rng = np.random.default_rng(1)
    sample = sample[:MEASURED]
    turn = rng.normal(size=sample.shape)
    turn -= (turn * sample).sum(axis=1, keepdims=True) * sample
    size = np.sqrt((turn * turn).sum(axis=1, keepdims=True))
    turn = np.divide(turn, size, out=np.zeros_like(turn), where=size > 1e-9)
    turned = threshold * sample + math.sqrt(max(0.0, 1 - threshold * threshold)) * turn
    widths = [p for p in PREFIXES if p <= len(pivots)] or [len(pivots)]
    for prefix in widths:
        a, b = _nearest(sample, pivots, offset, prefix), _nearest(turned, pivots, offset, prefix)
        if (_shared(a, b, prefix) >= min(2, prefix)).mean() >= RECALL:
            break
    choices = []
    for slack in SLACKS:
        again, others = _shared(a, b, slack), _shared(a[:, None], a[None], slack)
        choices += [((others >= k).mean(), Description(prefix, k, slack)) for k in SHARED
                    if (again >= k).mean() >= RECALL]
    return min(choices)[1] if choices else Description(prefix, min(2, prefix), prefix)


def _centres(classes: DataFrame, pivots: np.ndarray, threshold: float) -> np.ndarray:
    """The mean direction of the classes that each pivot, as their nearest, would link to."""
    dim = pivots.shape[1]
    sent = classes.sparkSession.sparkContext.broadcast(pivots)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot = sent.value
        sums = np.zeros_like(pivot)
        for batch in batches:
            v = _matrix(batch.column(0), dim)
            likeness = v @ pivot.T
            best = likeness.argmax(axis=1)
            near = likeness[np.arange(len(v)), best] >= threshold
            np.add.at(sums, best[near], v[near])
        some = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array([sums[i].tobytes() for i in some], pa.binary())],
            ["pivot", "sums"])

    def total(parts: pd.DataFrame) -> pd.DataFrame:
        s = np.sum([np.frombuffer(x, np.float64) for x in parts["sums"]], axis=0)
        return pd.DataFrame({"pivot": [parts["pivot"].iloc[0]], "sums": [s.tobytes()]})

    sums = (classes.where(F.length("vec") == dim * 8).select("vec")
            .mapInArrow(partial, "pivot int, sums binary")
            .groupBy("pivot").applyInPandas(total, "pivot int, sums binary"))
    centres = pivots.copy()
    for row in sums.collect():  # at most one row per pivot
        s = np.frombuffer(row["sums"], np.float64)
        if s.any():
            centres[row["pivot"]] = s / np.sqrt(s @ s)
    return centres


def _described(classes: DataFrame, pivots: np.ndarray, offset: np.ndarray, centres: np.ndarray, half: float,
               prefix: int) -> DataFrame:
    """``classes`` with ``unit`` (the ball as -1 - number, or the class), ``keys``, its pivot pairs, and their ``places``."""
    dim, count = pivots.shape[1], len(pivots)
    sent = classes.sparkSession.sparkContext.broadcast((pivots, offset, centres))
    inside, prefix = math.cos(half), min(prefix, count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, away, centre = sent.value
        pairs = np.array(list(combinations(range(prefix), 2)) or [(0, 0)])  # one pivot: a single list
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                cls = part.column(0).to_numpy(zero_copy_only=False)
                raw = part.column(1).to_pylist()
                v = _matrix(raw, dim)
                order = _nearest(v, pivot, away, prefix)
                by_number = np.argsort(order, axis=1)  # places, in the order of the pivots' numbers
                near = np.take_along_axis(order, by_number, axis=1)
                likeness = v @ centre.T
                best = likeness.argmax(axis=1)
                ball = (likeness[np.arange(len(v)), best] >= inside) & (np.array([len(r) for r in raw]) == dim * 8)
                keys = near[:, pairs[:, 0]] * count + near[:, pairs[:, 1]]
                places = by_number[:, pairs[:, 0]] * 64 + by_number[:, pairs[:, 1]]
                ends = pa.array(np.arange(len(v) + 1) * len(pairs), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.where(ball, -1 - best, cls)),
                     pa.ListArray.from_arrays(ends, pa.array(keys.ravel().astype(np.int64))),
                     pa.ListArray.from_arrays(ends, pa.array(places.ravel().astype(np.int32)))],
                    ["cls", "unit", "keys", "places"])

    return classes.select("cls", "vec").mapInArrow(run, "cls long, unit long, keys array<long>, places array<int>")


def meeting(described: DataFrame, how: Description) -> DataFrame:
    """``(unit, other)``: units that share enough pivots in places that differ little enough.

    A ball has all the places that its members give a pivot.
    """
    one, two = F.floor(F.col("place") / 64).cast("int"), F.col("place") % 64
    lists = settled(
        described.select("unit", F.explode(F.arrays_zip(F.col("keys").alias("key"), F.col("places").alias("place"))).alias("x"))
        .select("unit", "x.key", "x.place").groupBy("unit", "key")
        .agg(F.min(one).alias("a0"), F.max(one).alias("a1"), F.min(two).alias("b0"), F.max(two).alias("b1")))
    long_lists = small(settled(lists.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > LIST)))
    lists = lists.join(long_lists, "key", "left").withColumn(
        "blocks", F.coalesce(F.ceil(F.col("n") / LIST), F.lit(1)).cast("int")).drop("n")
    left = lists.withColumn("block", F.pmod(F.xxhash64("unit"), "blocks").cast("int")).drop("blocks")
    right = lists.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "block", F.col("unit").alias("other"), *[F.col(c).alias(f"{c}_") for c in ("a0", "a1", "b0", "b1")])
    near = F.lit(True)
    for c in "ab":
        near = near & (F.col(f"{c}0") - F.col(f"{c}1_") <= how.slack) & (F.col(f"{c}0_") - F.col(f"{c}1") <= how.slack)
    return (left.join(right, ["key", "block"]).where(F.col("unit") < F.col("other")).where(near)
            .groupBy("unit", "other").agg(F.count("*").alias("lists"))
            .where(F.col("lists") >= how.shared * (how.shared - 1) // 2).select("unit", "other"))


def _with_cosine(pairs: DataFrame, *names: str) -> DataFrame:
    """``names`` and ``cosine`` of the vectors in columns ``left`` and ``right``; -2 where lengths differ."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (c.to_pylist() for c in batch.columns[-2:])
            found = np.full(batch.num_rows, -2.0)
            sizes = np.array([len(x) if len(x) == len(y) else -1 for x, y in zip(left, right, strict=True)])
            for size in set(sizes.tolist()) - {-1}:
                rows = np.flatnonzero(sizes == size)
                a, b = (np.frombuffer(b"".join([side[i] for i in rows]), np.float64).reshape(len(rows), -1)
                        for side in (left, right))
                found[rows] = np.einsum("ij,ij->i", a, b)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(found)], [*names, "cosine"])
    return pairs.select(*names, "left", "right").mapInArrow(
        run, ", ".join(f"{n} long" for n in names) + ", cosine double")


def embedding_dedup(vectors: DataFrame, threshold: float = 0.95, pivots: int | None = None,
                    how: Description | None = None) -> DataFrame:
    """One row per row of ``vectors(vec_id, embedding array, …)``: ``vec_id, n_links, component_id, kept``.

    Two rows are linked when the cosine of their embeddings, in double
    precision, is at least ``threshold``; identical vectors are.  Null, zero and
    non-finite vectors (or with such components) link with nothing, nor do
    vectors of different lengths with each other.  ``n_links`` counts the other
    rows linked directly (repeated rows count each); ``component_id`` is the
    smallest ``vec_id`` reachable, itself included (null only if all are null).
    Found links are exact; links whose vectors share too few pivots are missed
    (tests measure the recall).  ``pivots`` and ``how`` are chosen from the data
    unless given; ``pivots=1, how=Description(1, 1, 1)`` puts all vectors into one
    list and misses nothing, at the cost of comparing all pairs.  An empty table
    gives no rows; other columns are not read.
    """
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    rows = settled(vectors.select("vec_id", "embedding").mapInArrow(_units, f"vec_id {id_type}, vec binary")
                   .withColumn("key", F.sha2("vec", 256)))
    alone = rows.where(F.col("vec").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
        F.lit(True).alias("kept"))
    classes = settled(rows.where(F.col("vec").isNotNull()).groupBy("key")
                      .agg(F.first("vec").alias("vec"), F.count("*").alias("n"), F.min("vec_id").alias("low"))
                      .withColumn("cls", F.monotonically_increasing_id()))
    if pivots is None:
        pivots = min(PIVOTS_MOST, max(PIVOTS_LEAST, int(PIVOTS_EACH * math.sqrt(classes.count()))))
    drawn = max(PIVOT_SAMPLE, SAMPLE_EACH * pivots)
    sample = [r["vec"] for r in classes.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(drawn).collect()]
    if not sample:
        return alone
    dim = max(len(v) for v in sample) // 8
    sample = _matrix(sample, dim)
    mean = sample.mean(axis=0)
    directions = _directions(sample, mean)
    chosen = _thin(directions, pivots)
    pivot, offset = directions[chosen], directions[chosen] @ mean
    others = np.delete(sample, chosen, axis=0)
    how = how or measured(others if len(others) >= MEASURED else sample, pivot, offset, threshold)
    half = math.acos(threshold) / 2 - MARGIN
    centre = _centres(classes, sample[chosen], threshold)
    described = settled(_described(classes, pivot, offset, centre, half, how.prefix))
    meet = meeting(described, how)
    spark = vectors.sparkSession
    members = classes.join(described.select("cls", "unit"), "cls").select("unit", "cls", "vec", "n")
    used = described.where("unit < 0").select("unit").distinct()
    centres = spark.createDataFrame([(-1 - i, bytearray(c.tobytes())) for i, c in enumerate(centre)],
                                    "unit long, vec binary")
    shapes = settled(members.where("unit >= 0").select("unit", "vec").unionByName(centres.join(used, "unit", "left_semi")))
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("cosine"))))
    balls = (F.col("unit") < 0).cast("int") + (F.col("other") < 0).cast("int")
    met = settled(_with_cosine(
        meet.join(shapes.withColumnRenamed("vec", "left"), "unit")
        .join(shapes.select(F.col("unit").alias("other"), F.col("vec").alias("right")), "other"),
        "unit", "other"))
    singles = met.where((balls == 0) & (F.col("cosine") >= threshold)).select(
        F.col("unit").alias("a"), F.col("other").alias("b"))
    limit = math.acos(threshold)
    crowd = met.where((balls > 0) & (F.col("cosine") > -2) & (angle <= limit + balls * (half + MARGIN)))
    # all members of both units are linked
    sure = crowd.where(angle + balls * half <= limit - MARGIN)
    open_pairs = crowd.where(~(angle + balls * half <= limit - MARGIN))
    expanded = (open_pairs.select("unit", "other")
                .join(members.select("unit", F.col("cls").alias("a"), F.col("vec").alias("left")), "unit")
                .join(members.select(F.col("unit").alias("other"), F.col("cls").alias("b"),
                                     F.col("vec").alias("right")), "other"))
    checked = _with_cosine(expanded, "a", "b").where(F.col("cosine") >= threshold).select("a", "b")
    links = settled(singles.unionByName(checked))

    # links of a class: its own copies, its ball, units sure to be linked, and verified classes
    weight = classes.select("cls", "n")
    ball_size = members.groupBy("unit").agg(F.sum("n").alias("size"), F.min("cls").alias("head"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    direct = (both.join(weight.withColumnRenamed("cls", "b"), "b").groupBy(F.col("a").alias("cls"))
              .agg(F.sum("n").alias("direct")))
    sure_both = sure.select("unit", "other").unionByName(
        sure.select(F.col("other").alias("unit"), F.col("unit").alias("other")))
    by_unit = (sure_both.join(ball_size.select(F.col("unit").alias("other"), "size"), "other")
               .groupBy("unit").agg(F.sum("size").alias("sure")))
    per_class = (classes.join(described.select("cls", "unit"), "cls")
                 .join(ball_size, "unit").join(by_unit, "unit", "left").join(direct, "cls", "left")
                 .select("key", "cls", "low", (F.col("size") - 1 + F.coalesce("sure", F.lit(0))
                                               + F.coalesce("direct", F.lit(0))).alias("n_links")))
    heads = ball_size.select("unit", "head")
    edges = (links
             .unionByName(members.join(heads, "unit").where("cls != head").select(
                 F.col("cls").alias("a"), F.col("head").alias("b")))
             .unionByName(sure.select("unit", "other").join(heads.withColumnRenamed("head", "a"), "unit")
                          .join(heads.select(F.col("unit").alias("other"), F.col("head").alias("b")), "other")
                          .select("a", "b")))
    roots = components(edges)
    rooted = settled(per_class.join(roots, per_class.cls == roots.node, "left")
                     .select("key", "low", "n_links", F.coalesce("root", "cls").alias("root")))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    found = settled(rooted.join(lowest, "root").select("key", "n_links", "component_id"))
    return (rows.where(F.col("vec").isNotNull()).join(found, "key")
            .select("vec_id", "n_links", "component_id",
                    F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
            .unionByName(alone))
