"""Alignment of two tokenizers by sparse products of token-byte incidence matrices.

A text's tokens under the tokenizers A and B are rows over its bytes: entry
(i, k) is 1 if token i covers byte k.  ``A Bᵀ`` links the tokens that overlap,
with the number of bytes they share.  Bytes where a token of A and one of B both
end cut the tokens into groups; the products of the incidences of tokens and
groups link all tokens of a group.  All matrices are compressed sparse rows, and
a product is taken row by row (Gustavson): the rows of the right matrix that a
row of the left one names are laid out, and equal columns added up.

Neither tokenizer joins what stands before and after a space between two
characters that are no white space, so such a place always ends a group and texts
are cut there (``_Pair.pieces``).  A block of texts has few distinct pieces; they
alone are encoded and multiplied out.  With D the incidence of documents and
pieces and P that of pieces and id pairs, ``D P`` says which documents hold a
pair linked, and whatever is summed over a document's links is ``D (P v)``.

Documents are taken in blocks.  Spark adds up the pairs' document counts over all
blocks and brings back to each block the totals of its own pairs, so neither a
task nor the driver ever holds the pairs of the whole corpus.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm.bpe import blocks
from starloom.llm.common import settled

#: Text of a block; its distinct pieces and their links lie in a task's memory.
BLOCK_BYTES = 16 << 20
#: Distinct pieces encoded and multiplied out at a time, in bytes.
SLICE_BYTES = 1 << 18
#: Entries of a product laid out at a time; a row that has more is laid out whole.
LAID_OUT = 1 << 18
#: Values in one list of an output row.
LIST = 100_000

_CUT = re.compile(r"(?<=\S) (?=\S)")
_EDGE = re.compile(r"^ |\s | \s| $")
_STATS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")


class Csr(NamedTuple):
    """Compressed sparse rows: entries ``starts[i]`` to ``starts[i + 1]`` are row i."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def of(cls, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, height: int, width: int) -> Csr:
        """From entries sorted by row."""
        return cls(np.searchsorted(rows, np.arange(height + 1)), columns, values, width)

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        if (self.columns[1:] >= self.columns[:-1]).all():
            return Csr.of(self.columns, rows, self.values, self.width, len(self.starts) - 1)
        order = np.argsort(self.columns, kind="stable")
        return Csr.of(self.columns[order], rows[order], self.values[order], self.width, len(self.starts) - 1)

    def products(self, other: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(rows, columns, values)`` of ``self @ other``, sorted, some whole rows at a time."""
        n = np.diff(other.starts)[self.columns]  # entries that each own entry brings
        upto = np.concatenate([[0], np.cumsum(n)])[self.starts]
        lo, height = 0, len(self.starts) - 1
        while lo < height:
            hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + LAID_OUT, "right")) - 1)
            own = slice(self.starts[lo], self.starts[hi])
            many = n[own]
            rows = np.repeat(np.repeat(np.arange(lo, hi), np.diff(self.starts[lo:hi + 1])), many)
            ends = np.cumsum(many)
            at = np.arange(len(rows)) + np.repeat(other.starts[self.columns[own]] - (ends - many), many)
            columns, values = other.columns[at], np.repeat(self.values[own], many) * other.values[at]
            key = rows * other.width + columns
            if len(key) and (key[1:] < key[:-1]).any():
                order = np.argsort(key, kind="stable")
                key, values = key[order], values[order]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            if len(first):
                yield key[first] // other.width, key[first] % other.width, np.add.reduceat(values, first)
            lo = hi

    def times(self, vector: np.ndarray) -> np.ndarray:
        """``self @ vector``."""
        upto = np.concatenate([[0], np.cumsum(self.values * vector[self.columns])])
        return upto[self.starts[1:]] - upto[self.starts[:-1]]


def _byte_of() -> dict[str, int]:
    """The bytes behind the characters of a byte-level vocabulary: visible Latin-1 ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Pair:
    """The two tokenizers of a worker, and the bytes of their tokens."""

    _made: dict[tuple[str, str], _Pair] = {}

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of, vocabulary = _byte_of(), self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (1 + max(self.a.get_vocab(with_added_tokens=True).values()))
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(map(byte_of.__getitem__, token))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.sizes = [np.array(list(map(len, each)), np.int64) for each in (self.a_bytes, self.b_bytes)]
        self.names = [f"{i}{mark}" for mark in ",|;" for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        with open(a_path, encoding="utf-8") as file:
            made = json.load(file)
        split = made["pre_tokenizer"] or {}
        self.cuts = (made["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                     and not split["add_prefix_space"]
                     and not any("▁" in p.lstrip("▁") for p in pieces)
                     and self.b.normalize(" ﬁ  é ") == "▁▁ﬁ▁▁é▁")

    @classmethod
    def of(cls, a_path: str, b_path: str) -> _Pair:
        if (a_path, b_path) not in cls._made:
            cls._made[a_path, b_path] = cls(a_path, b_path)
        return cls._made[a_path, b_path]

    def pieces(self, text: str) -> list[str]:
        """``text`` in pieces, each to be read with a space before it.

        Cut at single spaces where both tokenizers always cut: A must be a plain
        byte-level BPE, B must not normalise and must have no token with a space
        after another character.  Other tokenizers get whole texts.
        """
        if not self.cuts:
            return [text]
        return _CUT.split(text) if _EDGE.search(text) else text.split(" ")


class _Block:
    """The texts of one block, as their distinct pieces."""

    def __init__(self, pair: _Pair):
        self.pair, self.ids, self.docs, self.bytes = pair, [], [], 0
        self.index: dict[str, int] = defaultdict()
        self.index.default_factory = self.index.__len__

    def add(self, doc_id, text: str) -> None:
        pieces = self.pair.pieces(text) if text else []
        self.ids.append(doc_id)
        self.docs.append(np.fromiter(map(self.index.__getitem__, pieces), np.int32, len(pieces)))
        self.bytes += len(text)

    def aligned(self) -> tuple[list[np.ndarray], list[str], np.ndarray, Csr, np.ndarray]:
        """Of each distinct piece the counts, the groups and whether it has tokens; pieces by pairs; the pairs."""
        pieces, stats, named, whole = list(self.index), [], [], []
        rows, keys, times, lo = [], [], [], 0
        while lo < len(pieces):
            hi, size = lo, 0
            while hi < len(pieces) and (hi == lo or size < SLICE_BYTES):
                size += len(pieces[hi])
                hi += 1
            found = align(self.pair, pieces[lo:hi])
            stats.append(found[0])
            named.extend(found[1])
            whole.append(found[2])
            for r, k, v in found[3]:
                rows.append(r + lo)
                keys.append(k)
                times.append(v)
            lo = hi
        self.index.clear()
        join = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (rows, keys, times)]
        pairs, column = np.unique(join[1], return_inverse=True)
        p = Csr.of(join[0], column.astype(np.int32), join[2], len(pieces), max(len(pairs), 1))
        return [np.concatenate(x) for x in zip(*stats, strict=True)], named, np.concatenate(whole), p, pairs


def align(pair: _Pair, pieces: list[str]) -> tuple[list[np.ndarray], list[str], np.ndarray, list[tuple]]:
    """Links of the tokens of some pieces, each read with a space before it.

    Returns, per piece, ``n_a, n_b, n_groups, n_links, n_overlaps``; the groups as text; whether it
    has tokens at all (the joined token bytes of A and of B are its own); and
    the linked id pairs as ``(piece, a id * size of B + b id, links)``.
    """
    texts = [(" " + p).encode() for p in pieces]
    ids = [[e.ids for e in pair.a.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)],
           pair.b.encode(pieces, num_threads=1)]
    counts = [np.array(list(map(len, side)), np.int64) for side in ids]
    flat = [np.fromiter(chain.from_iterable(side), np.int64, int(n.sum())) for side, n in zip(ids, counts, strict=True)]
    whole = np.ones(len(pieces), bool)
    for tokens, n, known in zip(flat, counts, (pair.a_bytes, pair.b_bytes), strict=True):
        whole &= _gives_back(list(map(known.__getitem__, tokens.tolist())), n, texts)
    if not whole.all():
        flat = [side[np.repeat(whole, n)] for side, n in zip(flat, counts, strict=True)]
        counts = [np.where(whole, n, 0) for n in counts]
    ends = [np.cumsum(pair.sizes[s][flat[s]]) for s in (0, 1)]
    n_bytes = int(ends[0][-1]) if len(ends[0]) else 0
    piece = [np.repeat(np.arange(len(pieces)), n) for n in counts]

    # tokens by bytes: A Bᵀ has an entry for each two tokens that overlap
    a, b = (Csr(np.concatenate([[0], e]), np.arange(n_bytes), np.ones(n_bytes, np.int64), n_bytes) for e in ends)
    overlaps = np.zeros(len(pieces), np.int64)
    for rows, _, _ in a.products(b.transposed()):
        overlaps += np.bincount(piece[0][rows], minlength=len(pieces))

    # tokens by groups; equal ids of a group are one row, or column, with a count
    cuts = np.intersect1d(*ends, assume_unique=True)
    group = [np.searchsorted(cuts, e) for e in ends]
    n_groups, width = len(cuts), (len(pair.a_bytes), len(pair.b_bytes))
    per = []
    for s in (0, 1):
        key, n = np.unique(group[s] * width[s] + flat[s], return_counts=True)
        per.append((key // width[s], key % width[s], n))
    of_group = np.empty(n_groups, np.int64)
    of_group[group[0]] = piece[0]
    by_group = Csr(np.arange(len(per[0][0]) + 1), per[0][0], per[0][2], n_groups)
    to_ids = Csr.of(per[1][0], per[1][1], per[1][2], n_groups, width[1])
    links, found = np.zeros(len(pieces), np.int64), []
    for rows, columns, values in by_group.products(to_ids):
        of = of_group[per[0][0][rows]]
        links += np.bincount(of, values, len(pieces)).astype(np.int64)
        key = of * (width[0] * width[1]) + per[0][1][rows] * width[1] + columns
        key, back = np.unique(key, return_inverse=True)
        found.append((key // (width[0] * width[1]), key % (width[0] * width[1]),
                      np.bincount(back, values).astype(np.int64)))
    stats = [*counts, np.bincount(of_group, minlength=len(pieces)), links, overlaps]
    return stats, _named(pair, flat, group, counts, n_groups), whole, found


def _gives_back(tokens: list[bytes], counts: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Whether each text is its tokens' bytes, one after another."""
    ends = np.cumsum(counts)
    upto = np.concatenate([[0], np.cumsum(np.array(list(map(len, tokens)), np.int64))])
    same = upto[ends] - upto[ends - counts] == np.array(list(map(len, texts)))
    if same.all() and b"".join(tokens) == b"".join(texts):
        return same
    spans = zip((ends - counts).tolist(), ends.tolist(), texts, strict=True)
    return np.array([b"".join(tokens[lo:hi]) == text for lo, hi, text in spans])


def _named(pair: _Pair, flat: list[np.ndarray], group: list[np.ndarray], counts: list[np.ndarray],
           n_groups: int) -> list[str]:
    """The groups of each piece: ids of A, a bar and ids of B, joined by commas; groups by semicolons."""
    kinds = len(pair.names) // 3
    size = [np.bincount(g, minlength=n_groups) for g in group]
    upto = [np.concatenate([[0], np.cumsum(n)]) for n in size]
    code = np.empty(len(flat[0]) + len(flat[1]), np.int64)
    for s, mark in ((0, 1), (1, 2)):
        place = np.arange(len(flat[s])) + upto[1 - s][group[s] + s]  # A's ids of a group stand before B's
        last = np.append(np.diff(group[s]) > 0, True)[:len(flat[s])]
        code[place] = flat[s] + kinds * np.where(last, mark, 0)
    names, total, at = list(map(pair.names.__getitem__, code.tolist())), np.cumsum(counts[0] + counts[1]).tolist(), 0
    out = []
    for end in total:
        out.append("".join(names[at:end])[:-1])
        at = end
    return out


def _packed(values: np.ndarray) -> bytes:
    """Numbers in as few bytes as the largest needs, behind a byte that says how many."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return bytes([kind.itemsize]) + values.astype(kind).tobytes()


def _unpacked(column: pa.ChunkedArray) -> np.ndarray:
    """The numbers of all rows, one row after another."""
    rows = [np.frombuffer(r, np.dtype(f"u{r[0]}"), offset=1) for r in column.to_pylist()]
    return np.concatenate(rows).astype(np.int64) if rows else np.empty(0, np.int64)


def _numbers(parts: list[np.ndarray]) -> pa.Array:
    """Lists of 32-bit numbers as binary."""
    ends = np.concatenate([[0], np.cumsum(list(map(len, parts)))]) * 4
    data = np.concatenate(parts).astype("<i4") if parts else np.empty(0, "<i4")
    return pa.Array.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _emit(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _block_rows(block: _Block, number: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of three kinds: a document with its pieces; pairs with their documents; rows of pieces by pairs."""
    n = len(block.ids)
    if not n:
        return
    if len(block.index):
        stats, named, whole, p, pairs = block.aligned()
    else:
        stats, named, whole = [np.zeros(1, np.int64)] * len(_STATS), [""], np.zeros(1, bool)
        p, pairs = Csr(np.zeros(2, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), 1), np.empty(0, np.int64)
    in_docs = np.zeros(len(pairs), np.int64)
    sizes = np.cumsum(list(map(len, block.docs)))
    lo = 0
    while lo < n:
        before = int(sizes[lo - 1]) if lo else 0
        hi = min(lo + 1000, max(lo + 1, int(np.searchsorted(sizes, before + LAID_OUT, "right"))))
        docs = [d if whole[d].all() else d[:0] for d in block.docs[lo:hi]]
        flat = np.concatenate(docs)
        held = Csr(np.concatenate([[0], np.cumsum(list(map(len, docs)))]), flat, np.ones(len(flat), np.int64), len(whole))
        for _, columns, _ in held.products(p):
            in_docs += np.bincount(columns, minlength=len(pairs))
        shown = [hashlib.sha256(";".join(map(named.__getitem__, d.tolist())).encode()).hexdigest() if len(d) else ""
                 for d in docs]
        yield _emit(schema, hi - lo, block=pa.array([number] * (hi - lo), pa.int64()),
                    doc_id=pa.array(block.ids[lo:hi], schema.field("doc_id").type),
                    groups_sha256=pa.array(shown), pieces=_numbers(docs),
                    **{name: pa.array(held.times(of)) for name, of in zip(_STATS, stats, strict=True)})
        lo = hi
    one = pa.array([number], pa.int64())
    for lo in range(0, len(pairs), LIST):
        at = slice(lo, lo + LIST)
        yield _emit(schema, 1, block=one, pair=pa.array([pairs[at]], pa.list_(pa.int64())),
                    n_docs=pa.array([in_docs[at]], pa.list_(pa.int32())))
    for lo in range(0, len(p.starts) - 1, LIST):
        starts = p.starts[lo:lo + LIST + 1]
        at = slice(starts[0], starts[-1])
        yield _emit(schema, 1, block=one, first=pa.array([lo], pa.int32()), **{
            name: pa.array([_packed(part)], pa.binary())
            for name, part in (("sizes", np.diff(starts)), ("columns", p.columns[at]), ("times", p.values[at]))})


def token_alignment(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Links of the tokens of A and B in every row of ``docs(doc_id, text, …)``.

    ``a_path``: a byte-level BPE for ``tokenizers``, which reads a space and the
    text; ``b_path``: a ``sentencepiece`` model, which adds that space itself.
    Both files lie on every node.  Special tokens in a text are plain text.
    Columns: ``doc_id, n_a, n_b`` (tokens), ``n_groups``, ``n_links`` (pairs of
    token occurrences in one group), ``n_overlaps`` (pairs that share a byte),
    ``n_best`` (links whose id pair's count is the highest of its A id),
    ``count_sum`` (counts summed over the links) and ``groups_sha256``.  The
    count of an id pair is the number of rows of ``docs`` that hold it linked.

    Null and empty texts, and texts that A's or B's tokens don't give back byte
    for byte, have no tokens: zeros and an empty string.  Repeated rows count,
    and are returned, one by one; a null doc_id is a row like others; an empty
    table gives no rows; other columns are not read.  Texts may have any length;
    a stretch without a space between visible characters is encoded whole.
    """
    kind = docs.schema["doc_id"].dataType
    numbers = "".join(f", {name} long" for name in _STATS)
    ddl = (f"block long, doc_id {kind.simpleString()}{numbers}, groups_sha256 string, pieces binary, "
           "pair array<long>, n_docs array<int>, first int, sizes binary, columns binary, times binary")
    doc_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]
    schema = pa.schema([("block", pa.int64()), ("doc_id", doc_type), *[(name, pa.int64()) for name in _STATS],
                        ("groups_sha256", pa.string()), ("pieces", pa.binary()), ("pair", pa.list_(pa.int64())),
                        ("n_docs", pa.list_(pa.int32())), ("first", pa.int32()),
                        *[(name, pa.binary()) for name in ("sizes", "columns", "times")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, number = _Pair.of(a_path, b_path), TaskContext.get().partitionId() << 32
        block = _Block(pair)
        for batch in blocks(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                block.add(doc_id, text)
                if block.bytes >= BLOCK_BYTES:
                    yield from _block_rows(block, number, schema)
                    block, number = _Block(pair), number + 1
        yield from _block_rows(block, number, schema)

    n_b = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    found = settled(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, ddl))
    own = found.where("pair is not null").select("block", F.explode(F.arrays_zip("pair", "n_docs")).alias("p")).select(
        "block", "p.pair", "p.n_docs")
    counts = own.groupBy("pair").agg(F.sum("n_docs").alias("count"))
    of_a = Window.partitionBy(F.expr(f"pair div {n_b}"))
    counts = counts.withColumn("best", F.col("count") == F.max("count").over(of_a))
    totals = own.select("block", "pair").join(counts, "pair").select(F.col("block").alias("of_block"), "pair", "count", "best")

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        """One block: its documents and pieces on the left, its pairs' totals on the right."""
        is_doc = pc.is_valid(left["pieces"])
        mine, entries = left.filter(is_doc), left.filter(pc.invert(is_doc))
        # a block's columns are its pairs in ascending order, and so are their totals
        at = np.argsort(right["pair"].to_numpy())[_unpacked(entries["columns"])]
        times, sizes = _unpacked(entries["times"]), _unpacked(entries["sizes"])
        pieces = [np.arange(lo, lo + (len(r) - 1) // r[0]) for lo, r in zip(
            entries["first"].to_pylist(), entries["sizes"].to_pylist(), strict=True)]
        piece = np.repeat(np.concatenate(pieces) if pieces else sizes, sizes)
        count, best = right["count"].to_numpy()[at], right["best"].to_numpy(zero_copy_only=False)[at].astype(np.int64)
        height = int(piece.max()) + 1 if len(piece) else 1
        of_piece = []
        for value in (best, count):
            sums = np.zeros(height, np.int64)
            np.add.at(sums, piece, times * value)
            of_piece.append(sums)
        lists = mine["pieces"].to_pylist()
        n = np.array(list(map(len, lists)), np.int64) // 4
        flat = np.frombuffer(b"".join(lists), "<i4")
        held = Csr(np.concatenate([[0], np.cumsum(n)]), flat, np.ones(len(flat), np.int64), height)
        shown = mine.select(["doc_id", *_STATS, "groups_sha256"])
        return shown.append_column("n_best", pa.array(held.times(of_piece[0]))).append_column(
            "count_sum", pa.array(held.times(of_piece[1])))

    kept = found.where("pair is null").drop("pair", "n_docs")
    return kept.groupBy("block").cogroup(totals.groupBy("of_block")).applyInArrow(
        summed, f"doc_id {kind.simpleString()}{numbers}, groups_sha256 string, n_best long, count_sum long")
