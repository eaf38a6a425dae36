"""Skew-safe helpers agree with the plain window forms they replace."""

import datetime as dt
import random
from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators.dedup import keep_first, keep_last
from starloom.operators.keys import assign_dense_keys, next_key_base
from starloom.operators.neighbors import rank_desc


def _hot_key_rows(n=400, seed=7):
    rnd = random.Random(seed)
    base = dt.date(2020, 1, 1)
    rows = []
    seen = set()
    while len(rows) < n:
        # one key holds about a third of the rows
        k = 1 if rnd.random() < 0.34 else rnd.randint(2, 30)
        d = base + dt.timedelta(days=rnd.randint(0, 900))
        if (k, d) in seen:
            continue
        seen.add((k, d))
        end = None if rnd.random() < 0.1 else d + dt.timedelta(days=rnd.randint(-5, 60))
        rows.append((k, d, end, rnd.randint(0, 50)))
    return rows


def test_keep_first_and_last(spark):
    df = spark.createDataFrame(
        [("a", 2, 10), ("a", 1, 20), ("b", 5, 1), ("b", 5, 0)], "k string, o int, v int"
    )
    first = {r["k"]: (r["o"], r["v"]) for r in keep_first(df, ["k"], ["o"]).collect()}
    last = {r["k"]: (r["o"], r["v"]) for r in keep_last(df, ["k"], ["o"]).collect()}
    assert first == {"a": (1, 20), "b": (5, 0)}
    assert last == {"a": (2, 10), "b": (5, 1)}


def test_rank_desc_matches_rank_with_ties_and_nulls(spark):
    rows = [(g, v) for g, v in [("x", 9), ("x", 9), ("x", 8), ("x", None), ("y", 1)]]
    rows += [("z", random.Random(i).randint(0, 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, v int")
    got = rank_desc(df, ["g"], "v", "r")
    want = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v"))))
    assert Counter(tuple(r) for r in got.collect()) == Counter(tuple(r) for r in want.collect())
    top = {tuple(r) for r in rank_desc(df, ["g"], "v", "r", max_rank=1).collect() if r["g"] == "x"}
    assert top == {("x", 9, 1)}  # ties kept: two rows, same values


def test_dense_keys_are_dense_unique_and_stable(spark):
    df = spark.createDataFrame([(i * 7 - 100,) for i in range(500)], "id long")
    keyed = assign_dense_keys(df, ["id"], "key", base=10)
    keys = sorted(r["key"] for r in keyed.collect())
    assert keys == list(range(11, 511))
    again = {r["id"]: r["key"] for r in assign_dense_keys(df, ["id"], "key", 10, 16).collect()}
    assert again == {r["id"]: r["key"] for r in keyed.collect()}


def test_spread_keys_with_a_hot_first_column(spark):
    rows = [(1, d) for d in range(300)] + [(k, 0) for k in range(2, 50)]
    df = spark.createDataFrame(rows, "id long, seq int")
    keyed = assign_dense_keys(df, ["id", "seq"], "key", base=5, spread=True)
    assert sorted(r["key"] for r in keyed.collect()) == list(range(6, 6 + len(rows)))
    sizes = keyed.groupBy(F.pmod(F.xxhash64("id", "seq"), F.lit(16))).count().collect()
    assert max(r["count"] for r in sizes) < 100  # the 300 rows of id 1 are spread


def test_next_key_base_is_max_or_zero(spark):
    empty = spark.createDataFrame([], "k long")
    full = spark.createDataFrame([(3,), (9,)], "k long")
    row = spark.range(1).select(
        next_key_base(empty, "k").alias("a"), next_key_base(full, "k").alias("b")
    ).first()
    assert (row["a"], row["b"]) == (0, 9)


def test_keys_of_ids_with_a_stride_spread_over_buckets(spark):
    from starloom.operators.keys import assign_dense_keys

    ids = [i * 4096 for i in range(3000)]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    keyed = assign_dense_keys(df, ["id"], "key")
    assert sorted(r["key"] for r in keyed.collect()) == list(range(1, 3001))
    largest = (df.groupBy(F.substring(F.md5(F.col("id").cast("string").cast("binary")), 1, 3).alias("b"))
               .count().agg(F.max("count")).first()[0])
    assert largest < 20
