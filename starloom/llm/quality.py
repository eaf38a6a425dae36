"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal training.

Features of a text are hashed one- and two-word sequences, of the words
themselves and of their *shapes* (letter case, digits and punctuation with runs
squeezed), and a mark for a word that repeats the one before.  A feature's value
is its share of the text's features, so texts of any length compare.  A score
is the logistic of the sparse dot product of values and weights.

Training sees a bounded sample of labelled rows (``sample_rows``, the smallest
hashes of doc_id), one row at a time in a fixed order, in one task: per
coordinate it keeps the FTRL sums ``z`` and ``n``.  The model is ``2 ** bits``
weights, whatever the size of the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text that is turned to features at a time, and words a Python worker remembers.
BLOCK_BYTES = 1 << 20
CACHE_WORDS = 150_000
#: Shares are scaled so that typical weights are about 1.
SCALE = 16.0


class Ftrl(NamedTuple):
    """Hyperparameters of the training."""

    bits: int = 18
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.01
    l2: float = 0.01
    epochs: int = 3


_SQUEEZE = re.compile(r"(.)\1+", re.S)


def shape(word: str) -> str:
    """Case and digit classes of ``word`` with repeated classes squeezed: ``THE!!`` is ``X!!``-like ``X+!+``."""
    classes = "".join("X" if c.isupper() else "x" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return _SQUEEZE.sub(r"\1+", classes)


class NgramHasher:
    """Feature numbers of texts; remembers the hashes of the words it has seen."""

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - bits)
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.word, self.shape = np.empty(1 << 16, np.uint64), np.empty(1 << 16, np.uint64)

    def _learn(self, words: list[str]) -> None:
        for w in words:
            i = len(self.places)
            if i == len(self.word):
                self.word, self.shape = (np.concatenate([a, np.empty(i, np.uint64)]) for a in (self.word, self.shape))
            self.word[i] = xxhash.xxh64_intdigest(w.lower(), 1)
            self.shape[i] = xxhash.xxh64_intdigest(shape(w), 2)
            self.places[w] = i

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers of all texts one after another, repeats included, and how many each text has."""
        if len(self.places) > CACHE_WORDS:
            self._forget()
        lists = pc.utf8_split_whitespace(texts.cast(pa.large_string()))
        flat = lists.flatten()
        n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = flat.dictionary_encode()
        words = coded.dictionary.to_pylist()
        self._learn([w for w in words if w not in self.places])
        place = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        at = place[coded.indices.to_numpy(zero_copy_only=False)]
        word, form = self.word[at], self.shape[at]
        owner = np.repeat(np.arange(len(n)), n)
        pair = np.flatnonzero(owner[1:] == owner[:-1])
        mult, again = np.uint64(0x9E3779B97F4A7C15), at[pair] == at[pair + 1]
        hashes = np.concatenate([
            word, form, word[pair] * mult + word[pair + 1], form[pair] * mult + form[pair + 1],
            np.where(again, np.uint64(0x51ED27), np.uint64(0xA24BAED5))])
        owners = np.concatenate([owner, owner, owner[pair], owner[pair], owner[pair]])
        hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        order = np.argsort(owners, kind="stable")
        return (hashes >> self.shift).astype(np.int64)[order], np.bincount(owners, minlength=len(n))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, text in the last column, in slices of about BLOCK_BYTES."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(batch.num_columns - 1)).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < batch.num_rows:
            before = sizes[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(sizes, before + BLOCK_BYTES, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def fit(sample: DataFrame, how: Ftrl = Ftrl()) -> np.ndarray:
    """Weights (float32, the last one the bias) from ``sample(order long, label int, text)``.

    The sample must be bounded: one task trains on it, in the order of
    ``order``.  Without rows all weights are 0.
    """
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = NgramHasher(how.bits)
        for batch in _texts(batches):
            numbers, n = hasher(batch.column(2))
            for i, part in enumerate(np.split(numbers, np.cumsum(n)[:-1])):
                at, count = np.unique(part, return_counts=True)
                values = count * (SCALE / max(1, len(part)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1),
                     pa.array([at.astype(np.int32).tobytes()], pa.binary()),
                     pa.array([values.astype(np.float32).tobytes()], pa.binary())],
                    ["order", "label", "at", "value"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(((r["order"], r["label"], r["at"], r["value"]) for b in batches for r in b.to_pylist()))
        bias = 1 << how.bits
        z, n = np.zeros(bias + 1), np.zeros(bias + 1)

        def weights(at):
            return np.where(np.abs(z[at]) <= how.l1, 0.0, -(z[at] - np.sign(z[at]) * how.l1)
                            / ((how.beta + np.sqrt(n[at])) / how.alpha + how.l2))

        for _ in range(how.epochs):
            for _, label, at, value in rows:
                at = np.append(np.frombuffer(at, np.int32), bias)
                x = np.append(np.frombuffer(value, np.float32), 1.0)
                w = weights(at)
                g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
                z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / how.alpha * w
                n[at] += g * g
        model = weights(np.arange(bias + 1)).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([model.tobytes()], pa.binary())], ["model"])

    coded = sample.select("order", "label", "text").mapInArrow(
        features, "order long, label int, at binary, value binary")
    row = coded.repartition(1).mapInArrow(train, "model binary").first()
    if row is None:  # no rows, so no task
        return np.zeros((1 << how.bits) + 1, np.float32)
    return np.frombuffer(row["model"], np.float32)


def score(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """``docs`` as ``_row`` with ``_score``, the probability of label 1 (0 to 1).

    White space at an end of a text stands beside an empty word, and a null or
    empty text is one empty word.  Texts may have any length.  No column but
    ``text`` is read; repeated rows are scored one by one, an empty table gives
    no rows.
    """
    bits = (len(model) - 1).bit_length() - 1
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, hasher = sent.value, NgramHasher(bits)
        for batch in _texts(batches):
            numbers, n = hasher(batch.column(1))
            sums = np.zeros(len(n))
            some = np.flatnonzero(n)
            if len(some):
                starts = (np.cumsum(n) - n)[some]
                sums[some] = np.add.reduceat(weights[numbers].astype(np.float64), starts) * (SCALE / n[some])
            scores = 1 / (1 + np.exp(-np.clip(sums + weights[-1], -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["_row", "_score"])

    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return kept.mapInArrow(run, T.StructType([kept.schema["_row"], T.StructField("_score", T.DoubleType())]))


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of ``doc_id`` as text, modulo ``of``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, sample_rows: int) -> DataFrame:
    """``(order, label, text)`` of at most ``sample_rows`` labelled rows that ``usable(doc_id)`` admits.

    The ids are those with the smallest hashes among the labels, so the sample
    is the same whatever the partitioning.  Repeated labels of an id count once
    (the largest); rows without a label or id are not used.
    """
    ids = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & usable)
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
           .withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id").limit(sample_rows))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(ids), "doc_id").select("order", "label", "text")


#: Labelled rows that the classifier learns from, at most.
SAMPLE_ROWS = 6000


def quality_model(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, how: Ftrl = Ftrl()) -> np.ndarray:
    """Weights learned from ``labels(doc_id, quality)``, without the rows held out (remainder 2 of 4)."""
    usable = remainder(F.col("doc_id"), 4) != 2
    return fit(labelled_sample(docs, labels, "quality", usable, sample_rows), how)
