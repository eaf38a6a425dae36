"""Exact dedup by an exchange of Golomb-coded fingerprints.

1. Every text gets a 64-bit fingerprint.  A partition sorts its distinct
   fingerprints and sends each *owner* (an even range of the fingerprint space)
   its share as Golomb-coded gaps: the quotients in unary, the remainders in a
   fixed number of bits, about two bits above the entropy of a random set.
2. An owner decodes what it received and answers every message with a bitmap:
   which of its fingerprints also came from elsewhere.
3. Only texts with a marked fingerprint are shuffled whole, grouped by their
   bytes, so equal fingerprints of different texts are told apart.

A group of copies sends one fingerprint per partition and block, and its texts
are combined before the shuffle, so a group may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import settled, small, whole_text

#: Fingerprints that a partition codes at a time (bounds its memory).
BLOCK_ROWS = 1 << 20

_MESSAGE = ("owner int, sender int, block int, n int, shift int, "
            "quotients binary, remainders binary, repeated binary")


def golomb_encode(values: np.ndarray, shift: int) -> tuple[bytes, bytes]:
    """Sorted distinct uint64 ``values`` as coded gaps with divisor ``2 ** shift``."""
    gaps = np.diff(values, prepend=np.uint64(0))
    quotients = (gaps >> np.uint64(shift)).astype(np.int64)
    ends = np.cumsum(quotients + 1)
    unary = np.ones(int(ends[-1]) if len(ends) else 0, np.uint8)
    unary[ends - 1] = 0
    places = np.arange(shift, dtype=np.uint64)
    rest = ((gaps[:, None] >> places) & np.uint64(1)).astype(np.uint8)
    return np.packbits(unary).tobytes(), np.packbits(rest.ravel()).tobytes()


def golomb_decode(n: int, shift: int, quotients: bytes, remainders: bytes) -> np.ndarray:
    """The ``n`` values that ``golomb_encode`` coded."""
    if not n:
        return np.empty(0, np.uint64)
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(quotients, np.uint8)) == 0)[:n]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(shift)
    if shift:
        bits = np.unpackbits(np.frombuffer(remainders, np.uint8), count=n * shift)
        places = np.uint64(1) << np.arange(shift, dtype=np.uint64)
        gaps += (bits.reshape(n, shift).astype(np.uint64) * places).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def _owner(values: np.ndarray, owners: int) -> np.ndarray:
    return ((values >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)


def _floor(owner: int, owners: int) -> int:
    """The smallest fingerprint of ``owner``."""
    return -(-(owner << 32) // owners) << 32


def _send(owners: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender, block, held, size = TaskContext.get().partitionId(), 0, [], 0

        def coded(held, block):
            prints = np.concatenate([h[0] for h in held])
            values, at = np.unique(prints, return_inverse=True)
            counts = np.bincount(at, np.concatenate([h[1] for h in held]))
            owner = _owner(values, owners)
            cuts = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
            rows = []
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                base = _floor(int(owner[lo]), owners)
                share = values[lo:hi] - np.uint64(base)
                mean = (1 << 64) // owners // int(hi - lo + 1)
                shift = max(0, (mean * 69 // 100).bit_length() - 1)
                q, r = golomb_encode(share, shift)
                rows.append((int(owner[lo]), sender, block, int(hi - lo), shift, q, r,
                             np.packbits(counts[lo:hi] > 1).tobytes()))
            names = [c.split()[0] for c in _MESSAGE.split(", ")]
            types = [pa.int32()] * 5 + [pa.binary()] * 3
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for batch in batches:
            if batch.num_rows:
                held.append((batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64),
                             batch.column(1).to_numpy(zero_copy_only=False)))
                size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield coded(held, block)
                held, size, block = [], 0, block + 1
        if size:
            yield coded(held, block)
    return send


def _answer(messages: pd.DataFrame) -> pd.DataFrame:
    """For every message of one owner: a bitmap of the fingerprints that come more than once."""
    parts = [golomb_decode(m.n, m.shift, m.quotients, m.remainders) for m in messages.itertuples()]
    values, counts = np.unique(np.concatenate(parts), return_counts=True)
    more = counts > 1
    bits = [np.packbits(more[np.searchsorted(values, p)]
                        | np.unpackbits(np.frombuffer(r, np.uint8), count=len(p)).astype(bool)).tobytes()
            for p, r in zip(parts, messages.repeated, strict=True)]
    return pd.DataFrame({"owner": messages.owner, "sender": messages.sender,
                         "block": messages.block, "bitmap": bits})


def _marked(owners: int):
    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.empty(0, np.int64)]
            for m in batch.to_pylist():
                values = golomb_decode(m["n"], m["shift"], m["quotients"], m["remainders"])
                on = np.unpackbits(np.frombuffer(m["bitmap"], np.uint8), count=m["n"]).astype(bool)
                found.append((values[on] + np.uint64(_floor(m["owner"], owners))).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], ["fp"])
    return marked


def suspects(prints: DataFrame, owners: int | None = None) -> DataFrame:
    """Distinct fingerprints ``fp`` of ``prints(fp long, n long)`` that stand for more than one row.

    ``prints`` must be settled: its partitions are the senders.
    """
    spark = prints.sparkSession
    owners = owners or int(spark.conf.get("spark.sql.shuffle.partitions"))
    messages = settled(prints.select("fp", "n").mapInArrow(_send(owners), _MESSAGE))
    answers = (messages.groupBy("owner")
               .applyInPandas(_answer, "owner int, sender int, block int, bitmap binary"))
    return (messages.join(answers, ["owner", "sender", "block"])
            .select("owner", "n", "shift", "quotients", "remainders", "bitmap")
            .mapInArrow(_marked(owners), "fp long").distinct())


def exact_dedup(docs: DataFrame, owners: int | None = None) -> DataFrame:
    """One row per row of ``docs(doc_id, text, …)``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows are copies when their texts are identical byte for byte; null counts
    as the empty text, so null and empty texts form one group.  Of a group the
    row with the largest ``doc_id`` stays (null ids only if all are null; of
    repeated rows with that id exactly one).  Texts may have any length: only
    suspects' texts are shuffled.  An empty table gives no rows.
    Other columns, whatever their names, are not read.
    """
    text = whole_text()
    rows = settled(docs.select("doc_id", F.xxhash64(text).alias("fp"), F.sha2(text, 256).alias("sha"))
                   .groupBy("doc_id", "fp", "sha").agg(F.count("*").alias("n")))
    marked = small(settled(suspects(rows, owners)))
    groups = (docs.select("doc_id", text.alias("text")).withColumn("fp", F.xxhash64("text"))
              .join(marked, "fp", "left_semi")
              .groupBy("fp", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("size"))
              .select("fp", F.sha2("text", 256).alias("sha"), "keep_id", "size"))
    grouped = F.col("size").isNotNull()
    return (rows.join(settled(groups), ["fp", "sha"], "left")
            .select("doc_id", F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
                    F.coalesce("size", "n").cast("long").alias("group_size"),
                    F.col("sha").alias("text_sha256"),
                    F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                    "text_sha256"))
