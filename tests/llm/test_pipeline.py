"""The pipeline's stages one by one, on dirty rows and against plain versions."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from starloom.llm import queries
from test_operators import SCHEMA, _plain_print, frame, prose


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_names_and_guard():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "SimHash near-dedup", "secret scans", "packing"]
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    assert set(queries.oracle_sql()) <= set(names)


def test_dedup_stages_keep_one_row_per_group(spark, tmpdir_path):
    rng = random.Random(12)
    base = prose(200, rng)
    pairs = [(1, base), (2, base), (2, base), (None, base), (3, None), (4, ""), (None, None), (None, "solo one"),
             (None, "another lonely text here"), (5, base + " end"), (6, prose(50, rng)), (6, prose(50, rng))]
    docs = frame(spark, pairs)
    exact = stage("exact dedup")(spark, docs, None)
    assert exact.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    kept = [(r["doc_id"], r["text"]) for r in exact.collect()]
    assert sorted(t or "" for _, t in kept) == sorted({t or "" for _, t in pairs})
    assert (2, base) in kept and (4, "") in kept
    near = [(r["doc_id"], r["text"]) for r in stage("SimHash near-dedup")(spark, docs, None).collect()]
    prints = [_plain_print(t) for _, t in pairs]
    groups = []
    for i, p in enumerate(prints):
        hit = [g for g in groups if any((p ^ prints[j]).bit_count() <= 4 for j in g)]
        groups = [g for g in groups if g not in hit] + [sum(hit, []) + [i]]
    assert len(near) == len(groups)
    for g in groups:
        ids = [pairs[i][0] for i in g if pairs[i][0] is not None]
        assert min(ids, default=None) in [i for i, _ in near]
    empty = docs.where("false")
    for name in ("exact dedup", "SimHash near-dedup", "secret scans", "packing"):
        assert stage(name)(spark, empty, None).count() == 0


def test_run_equals_the_stages_written_one_by_one(spark, tmpdir_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, docs, sf_dir).write.parquet(f"{tmpdir_path}/{k}")
        after = spark.read.parquet(f"{tmpdir_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns and 0 < after.count() <= docs.count()
        docs = after
    one = corpus_pipeline.run(spark, sf_dir)
    columns = ["doc_id", "doc_tokens"]

    def tokens(df):
        return sorted(tuple(r) for r in df.groupBy(*columns).agg(F.sum("length")).collect())

    assert tokens(one) == tokens(docs)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    first = {r["doc_id"] for r in spark.read.parquet(f"{tmpdir_path}/0").select("doc_id").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in first for i in good) >= 0.95 * len(good)
