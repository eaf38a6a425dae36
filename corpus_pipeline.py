"""Corpus pipeline: quality filter, exact dedup, near dedup, secret redaction, packing.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)``.  A stage's result is written as Parquet and read again as the next
one's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from uuid import uuid4

from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import retain, settled, table, whole_text
from starloom.llm.exact_dedup import exact_dedup
from starloom.llm.packing import ids_crc32, pack
from starloom.llm.quality import quality_model, score
from starloom.llm.secrets import redact
from starloom.llm.simhash import simhash_dedup
from starloom.session import checkpoint_dir, remove_folder

#: A document goes if its quality score is below this.
QUALITY = 0.7


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least ``QUALITY``, whatever their length; null texts count as empty ones.

    A score of exactly ``QUALITY`` stays.  Repeated rows stay or go together; an empty table gives no
    rows.  Columns of any name are carried through as they are.
    """
    kept = score(docs, quality_model(docs, table(spark, sf_dir, "labels"))).where(F.col("_score") >= QUALITY)
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal byte for byte, the document with the largest doc_id.

    Null and empty texts are one group; a null id stays only where all are null, and of rows with one id
    and text one.  Texts may have any length; an empty table gives no rows.  Columns of any name stay.
    """
    found = exact_dedup(docs).groupBy("doc_id", "text_sha256").agg(
        F.count("*").alias("n_rows"), F.max("kept").alias("keep"))
    return retain(docs, {"doc_id": F.col("doc_id"), "text_sha256": F.sha2(whole_text(), 256)}, settled(found))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by links of 4-word SimHash within 4 bits, the one with the smallest doc_id.

    Texts without words, null ones too, have fingerprint 0 and are one group; a null id stays only where
    all are null; of rows with one id the text with the smallest SHA-256 stays, and of repeated rows one.
    Texts may have any length; an empty table gives no rows.  Columns of any name stay.
    """
    found = simhash_dedup(docs, shingle_words=4, distance=4).groupBy("doc_id", "text_sha256").agg(
        F.count("*").alias("n_rows"), F.max("kept").alias("keep"))
    return retain(docs, {"doc_id": F.col("doc_id"), "text_sha256": F.sha2(whole_text(), 256)}, settled(found))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked and ``n_chars`` of those counted anew.

    Null texts stay null, repeated rows stay, an empty table gives no rows.  Overlapping spans become one
    mask.  Texts may have any length; all other columns stay as they are.
    """
    return redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids in sequences of 2048.

    Null and empty texts are the end id alone; repeated rows are packed one by one; texts of any length
    are cut into pieces; an empty table gives no rows.  Only ``doc_id`` and ``text`` are read.
    """
    pieces = pack(docs, vocabulary("word_bpe_49k.json"), capacity=2048, end_id=1,
                  slice_bytes=2 << 20, cache_words=400_000)  # the stages share Python workers
    return pieces.select("doc_id", "start", "length", ids_crc32(F.col("ids")).alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", near_stage),
    ("secret scans", secret_stage),
    ("packing", packing_stage),
]

#: Scores, fingerprints and tokens can't be said in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to the shared checkpoint folder.

    A stage's output goes once the next one's is written; the last one's input stays, as the result reads it.
    """
    docs, at = table(spark, sf_dir, "documents"), f"{checkpoint_dir(spark)}/pipeline-{uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{k}")
        docs = spark.read.parquet(f"{at}/{k}")
        if k:
            remove_folder(spark, f"{at}/{k - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
