"""SimHash near-dedup with a Gray-order hierarchical index.

A text's fingerprint takes, bit by bit, the majority of its shingles' 64-bit
hashes.  Fingerprints within ``distance`` bits are linked:

* The 64 bits are cut into ``distance + k`` bands.  Two linked fingerprints
  agree in at least k bands, so each fingerprint is routed once per choice of k
  bands and meets every partner; no all-pairs step is needed.  k is 2 or grows
  with the number of fingerprints.  A key with a crowd is dealt anew, by pairs of
  blocks (``routed``).
* Where they meet, fingerprints are sorted by Gray rank, so neighbours differ
  in few bits, and runs of them hang under nodes.  A node holds the bits that
  all its leaves share and its parent doesn't hold yet.  A search adds up the
  differences on its way down and drops a whole group as soon as they exceed
  the distance.
* A routed group answers with a spanning forest of its links, not with all
  pairs, so a group of near copies costs as many rows as it has members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import components, settled, small, whole_text

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Children of an index node.
FANOUT = 8
#: Fingerprints of a key; of more, each pair of blocks of this size is a key of its own.
GROUP = 4096
#: Rows that a task indexes, and (query, node) pairs that it follows, at a time.
CHUNK_ROWS = 1 << 18
CHUNK_PAIRS = 1 << 21


def fingerprint(raw: bytes, shingle_words: int = 4) -> int:
    """64-bit SimHash of a UTF-8 text; 0 for a text without words.

    A-Z are lower-cased and words split at ASCII white space.  A shingle is
    ``shingle_words`` words joined by a space (the whole sequence if there are
    fewer), repeats included, hashed by XXH64 with seed 42.
    """
    words = raw.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[s:e], 42) for s, e in zip(starts, ends[shingle_words - 1:])]
                      or [digest(joined, 42)])
    n, ones = len(hashes) // 8, np.zeros(64, np.int64)
    rows = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(rows[at:at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = 4) -> DataFrame:
    """``(doc_id, text_sha256, fp long)`` of every row of ``docs``; a null text is empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, shingle_words)
                                 for t in (x.as_py() for x in batch.column(2))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))],
                                             ["doc_id", "text_sha256", "fp"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.sha2(whole_text(), 256).alias("text_sha256"),
                       whole_text().cast("binary").alias("raw")).mapInArrow(
        run, f"doc_id {kind}, text_sha256 string, fp long")


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each uint64 in the reflected Gray sequence."""
    rank = values.copy()
    for step in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(step)
    return rank


class GrayIndex:
    """Hierarchical index over fingerprints, one tree per ``group``.

    ``values`` must be sorted by (group, Gray rank).  Level 0 are the leaves;
    the last level has one root per group.
    """

    def __init__(self, group: np.ndarray, values: np.ndarray):
        _, self.tree = np.unique(group, return_inverse=True)
        tree, shared, value = self.tree, np.full(len(values), ~np.uint64(0)), values
        levels = [(shared, value, None)]
        while len(tree) > (tree[-1] + 1 if len(tree) else 0):
            first = np.flatnonzero(np.diff(tree, prepend=-1))
            inside = np.arange(len(tree)) - np.repeat(first, np.diff(first, append=len(tree)))
            heads = np.flatnonzero(inside % FANOUT == 0)
            ends = np.append(heads[1:], len(tree))
            up_value = value[heads]
            same = np.bitwise_and.reduceat(
                shared & ~(value ^ np.repeat(up_value, ends - heads)), heads)
            levels.append((same, up_value, (heads, ends)))
            tree, shared, value = tree[heads], same, up_value
        # a node keeps the bits that its parent doesn't hold
        self.levels = []
        for k, (shared, value, kids) in enumerate(levels):
            own = shared
            if k + 1 < len(levels):
                heads, ends = levels[k + 1][2]
                own = shared & ~np.repeat(levels[k + 1][0], ends - heads)
            self.levels.append((own, value, kids))

    def within(self, queries: np.ndarray, trees: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """``(query number, leaf)`` of all leaves within ``distance`` of each query in its tree."""
        query, node = np.arange(len(queries)), trees
        apart = np.zeros(len(queries), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            own, value, kids = self.levels[k]
            apart = apart + np.bitwise_count((queries[query] ^ value[node]) & own[node])
            near = apart <= distance
            query, node, apart = query[near], node[near], apart[near]
            if kids is not None:
                heads, ends = kids
                n = (ends - heads)[node]
                at = np.repeat(heads[node] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                query, node, apart = np.repeat(query, n), at, np.repeat(apart, n)
        return query, node


def _forest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest reachable number for each of ``n`` nodes with links ``a - b`` (and ``label`` so far)."""
    label = np.arange(n) if label is None else label
    while True:
        low = np.minimum(label[a], label[b])
        nxt = label.copy()
        np.minimum.at(nxt, label[a], low)
        np.minimum.at(nxt, label[b], low)
        nxt = nxt[nxt]
        while not np.array_equal(nxt, nxt[nxt]):
            nxt = nxt[nxt]
        if np.array_equal(nxt, label):
            return label
        label = nxt


def _links(key: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest, as pairs of fingerprints, of the links inside each group of equal ``key``."""
    _, at, n = np.unique(key, return_inverse=True, return_counts=True)
    many = n[at] > 1
    key, fp = key[many], fp[many]
    order = np.lexsort((gray_rank(fp), key))
    key, fp = key[order], fp[order]
    index = GrayIndex(key, fp)
    nodes, node = np.unique(fp, return_inverse=True)
    label = np.arange(len(nodes))
    cost = np.cumsum(np.bincount(index.tree)[index.tree]) if len(fp) else np.empty(0, int)
    lo = 0
    while lo < len(fp):
        hi = max(lo + 1, int(np.searchsorted(cost, cost[lo] + CHUNK_PAIRS)))
        query, leaf = index.within(fp[lo:hi], index.tree[lo:hi], distance)
        keep = leaf > query + lo
        label = _forest(len(nodes), node[query[keep] + lo], node[leaf[keep]], label)
        lo = hi
    linked = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[linked], nodes[label[linked]]


def agreeing_bands(rows: int, distance: int) -> int:
    """How many of ``distance`` + k bands a key takes (k), so that few of ``rows`` unrelated fingerprints share one."""
    k = 2
    while 64 * k // (distance + k) < min(rows.bit_length() - 4, 56):
        k += 1
    return k


def routed(prints: DataFrame, distance: int) -> DataFrame:
    """``(key, fp)``: two of the distinct ``prints(fp)`` within ``distance`` bits have a key in common.

    The 64 bits are cut into ``distance + k`` bands; a key is k of them, and the
    k grows with the number of fingerprints, so a key's unrelated ones stay few.
    A key that more than ``GROUP`` fingerprints have (a crowd around one text) is
    dealt anew: its fingerprints are cut into blocks by a hash, and each pair of
    blocks is a key of its own, with at most about two blocks' rows.
    """
    k = agreeing_bands(prints.count(), distance)
    edges = [64 * i // (distance + k) for i in range(distance + k + 1)]
    keys = []
    for i, chosen in enumerate(combinations(range(distance + k), k)):
        bits = [F.shiftrightunsigned("fp", edges[j]).bitwiseAND(F.lit((1 << edges[j + 1] - edges[j]) - 1)) for j in chosen]
        keys.append(F.xxhash64(F.lit(i), *bits))
    keyed = prints.select(F.explode(F.array(*keys)).alias("key"), "fp")
    crowds = settled(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > GROUP))
    if crowds.isEmpty():
        return keyed
    crowds = small(crowds)
    blocks = F.ceil(F.col("n") / GROUP).cast("int")
    dealt = (keyed.join(crowds, "key")
             .withColumn("own", F.pmod(F.xxhash64(F.lit(7), "fp"), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "fp"))
    return keyed.join(crowds.select("key"), "key", "left_anti").unionByName(dealt)


def linked_prints(prints: DataFrame, distance: int = 4) -> DataFrame:
    """Links ``(a, b)`` that join the same components as all pairs of the distinct
    ``prints(fp)`` within ``distance`` bits."""
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)

        def out(key, fp):
            a, b = _links(key, fp, distance)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if len(key) >= CHUNK_ROWS and key[0] != key[-1]:
                cut = int(np.searchsorted(key, key[-1]))  # the last key's rows may go on
                yield out(key[:cut], fp[:cut])
                key, fp = key[cut:], fp[cut:]
        if len(key):
            yield out(key, fp)

    return (routed(prints, distance).repartition(parts, "key").sortWithinPartitions("key")
            .mapInArrow(run, "a long, b long").distinct())


def simhash_dedup(docs: DataFrame, shingle_words: int = 4, distance: int = 4) -> DataFrame:
    """One row per row of ``docs(doc_id, text, …)``: ``doc_id, text_sha256, fp, component_id, kept``.

    Null and empty texts, and texts of white space only, have fingerprint 0 and
    are linked like any others.  ``component_id`` is the smallest ``doc_id``
    among all rows reachable by links (null only if all of them are null).
    ``kept`` marks the row with that id (of several with it, the smallest
    SHA-256 of the text; rows that repeat it are marked too).  Texts may have any
    length.  Repeated rows give repeated results; an empty table gives none; other columns are not read.
    """
    rows = settled(fingerprints(docs, shingle_words))
    # smallest id first, nulls after all ids
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_sha256")
    prints = settled(rows.groupBy("fp").agg(F.min(first).alias("low")))
    roots = components(linked_prints(prints, distance))
    of_print = settled(prints.join(roots, prints.fp == roots.node, "left").select("fp", "low", "root"))
    # one row per component of two or more, counted map-side; a component of any size is joined with it
    lowest = small(settled(of_print.where("root is not null").groupBy("root").agg(F.min("low").alias("lowest"))))
    labels = (of_print.where("root is not null").join(lowest, "root").select("fp", "lowest")
              .unionByName(of_print.where("root is null").select("fp", F.col("low").alias("lowest"))))
    return rows.join(settled(labels), "fp").select(
        "doc_id", "text_sha256", "fp", F.col("lowest.doc_id").alias("component_id"),
        first.eqNullSafe(F.col("lowest")).alias("kept"))
