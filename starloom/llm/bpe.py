"""Byte-level BPE encoding by merge replay, and decoding.

A task takes its documents in blocks.  The distinct words (matches of the split
pattern) of a block that it doesn't know yet are laid out one after another as
one sequence of tokens, linked to their neighbours, and an inverted index lists,
for each rank, the positions whose pair merges to that rank.  The merges are
replayed in rank order, a band of ranks at a time: of each word the positions
of its lowest rank are merged, left to right, all words at once, and only the
pairs that touch a merged token are looked up and listed anew.  A pair of a rank
below the band's end comes up in the band's next round.  The ids of each word
are then copied to all its places.

Blocks are encoded apart, without a shuffle; a word has the same ids in each.
"""

from __future__ import annotations

import base64
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text that is encoded at a time.
BLOCK_BYTES = 4 << 20
#: Distinct pieces of text whose ids a Python worker remembers; beyond it those of the last block only.
CACHE_PIECES = 500_000
#: Positions that a band of ranks takes from the index, all of its last rank included.
BAND = 50_000

_CUT = re.compile(r"(?<=\S) (?=\S)")
_EDGE = re.compile(r"^ |\s | \s| $")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class MergeReplay:
    """Encoder for the ranks of one vocabulary."""

    _made: dict[tuple[str, str], MergeReplay] = {}

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.tokens = {r: t for t, r in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        #: Ranks whose merge can bring up a pair of a lower rank, which then goes first.
        self.turns_back = np.zeros(max(self.tokens) + 1, bool)
        for side in (self.pair_keys >> 32, self.pair_keys & 0xFFFFFFFF):
            self.turns_back[side[self.pair_ranks < side]] = True
        self.forget()

    def forget(self) -> None:
        """Empty the memory of pieces: each one's number, and by number where its ids lie in ``ids``."""
        self.slots: dict = defaultdict()
        self.slots.default_factory = self.slots.__len__
        self.starts, self.ids = np.zeros(1, np.int64), np.empty(0, np.int32)

    @classmethod
    def of(cls, path: str, pattern: str) -> MergeReplay:
        if (path, pattern) not in cls._made:
            cls._made[path, pattern] = cls(path, pattern)
        return cls._made[path, pattern]

    def lookup(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The rank that each pair of tokens merges to, or -1."""
        key = first << 32 | second
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all the non-empty ``words``, one after another, and how many each has."""
        whole = [self.ranks.get(w, -1) for w in words]  # a word that is a token needs no merge
        sizes = np.array([len(w) if rank < 0 else 1 for w, rank in zip(words, whole, strict=True)], np.int64)
        token = np.empty(int(sizes.sum()), np.int64)
        whole = np.array(whole, np.int64)
        known = np.repeat(whole >= 0, sizes)
        token[known] = whole[whole >= 0]
        rest = b"".join([w for w, rank in zip(words, whole.tolist(), strict=True) if rank < 0])
        token[~known] = self.single[np.frombuffer(rest, np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        self._merge(token, word)
        stays = token >= 0
        return token[stays].astype(np.int32), np.bincount(word[stays], minlength=len(words))

    def _merge(self, token: np.ndarray, word: np.ndarray) -> None:
        """Replay all merges within words; a token that its left neighbour takes up becomes -1."""
        n = len(token)
        left, right, pair = np.arange(-1, n - 1), np.arange(1, n + 1), np.full(n, -1)
        border = np.append(word[1:] != word[:-1], True)[:n]
        right[border] = -1
        left[np.append(0, np.flatnonzero(border)[:-1] + 1)[:n]] = -1
        inside = np.flatnonzero(right >= 0)
        pair[inside] = self.lookup(token[inside], token[right[inside]])
        spots = inside[pair[inside] >= 0]
        later = [(pair[spots], spots)]  # the index: ranks and their positions, out of date where ``pair`` says otherwise
        while later:
            rank, spots = (np.concatenate(x) for x in zip(*later, strict=True))
            current = pair[spots] == rank
            rank, spots = rank[current], spots[current]
            if not len(rank):
                return
            end = rank.max() if len(rank) <= BAND else np.partition(rank, BAND)[BAND]
            now = spots[rank <= end]
            later = [(rank[rank > end], spots[rank > end])]
            while len(now):
                now = distinct(now[(pair[now] >= 0) & (pair[now] <= end)])
                if not len(now):
                    break
                touched = self._round(now, token, word, left, right, pair)
                new = pair[touched]
                later.append((new[new > end], touched[new > end]))
                now = np.concatenate([now, touched[new >= 0]])

    def _round(self, spots: np.ndarray, token: np.ndarray, word: np.ndarray, left: np.ndarray, right: np.ndarray,
               pair: np.ndarray) -> np.ndarray:
        """Merge, in each word, the pairs of its lowest rank among ``spots`` (sorted); positions of the touched pairs."""
        rank, of = pair[spots], word[spots]
        first = np.append(True, of[1:] != of[:-1])
        lowest = np.minimum.reduceat(rank, np.flatnonzero(first))[np.cumsum(first) - 1]
        spots = spots[rank == lowest]
        # of positions in a row, each of which shares a token with the next, every other one
        joined = np.append(False, right[spots[:-1]] == spots[1:])
        at = np.arange(len(spots))
        spots = spots[(at - np.maximum.accumulate(np.where(joined, 0, at))) % 2 == 0]
        again = np.append(False, word[spots[1:]] == word[spots[:-1]]) & self.turns_back[pair[spots]]
        spots = spots[~again]  # what comes up may go before a word's further ones
        gone = right[spots]
        token[spots], token[gone] = pair[spots], -1
        pair[gone] = -1
        after = right[gone]
        right[spots] = after
        left[after[after >= 0]] = spots[after >= 0]
        before = left[spots]
        touched = distinct(np.concatenate([spots, before[before >= 0]]))
        last = right[touched] < 0
        pair[touched[last]] = -1
        touched = touched[~last]
        pair[touched] = self.lookup(token[touched], token[right[touched]])
        return touched

    def pieces(self, text: str) -> list:
        """``text`` cut before each space between two characters that are no white space.

        A match of the pattern never spans such a place, so pieces can be
        encoded, and remembered, one by one.  The first is a tuple of itself; the
        others stand without the space before them.
        """
        parts = _CUT.split(text) if _EDGE.search(text) else text.split(" ")
        parts[0] = (parts[0],)
        return parts

    def _learn(self, fresh: list) -> None:
        """Remember the ids of pieces that have got their numbers."""
        cut = [self.split(" " + p if isinstance(p, str) else p[0]) for p in fresh]
        number = {w: k for k, w in enumerate(set().union(*cut))}
        ids, sizes = self.replay([w.encode() for w in number])
        starts = np.cumsum(sizes) - sizes
        words = np.fromiter(map(number.__getitem__, chain.from_iterable(cut)), np.int64)
        n = np.array(list(map(len, cut)), np.int64)
        upto = np.concatenate([[0], np.cumsum(sizes[words])])
        ends = upto[np.cumsum(n)] + self.starts[-1]
        self.ids = np.concatenate([self.ids, ids[spans(starts[words], sizes[words])]])
        self.starts = np.concatenate([self.starts, ends])

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text's begin and the last end."""
        known, number = len(self.slots), self.slots.__getitem__
        found, n = [], []
        for text in texts:
            parts = self.pieces(text)
            n.append(len(parts))
            found.append(np.fromiter(map(number, parts), np.int32, len(parts)))
        if len(self.slots) > known:
            self._learn(list(islice(self.slots, known, None)))
        flat = np.concatenate(found)
        sizes = np.diff(self.starts)[flat]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(n)])]
        ids = self.ids[spans(self.starts[flat], sizes)]
        if len(self.slots) > CACHE_PIECES:
            self._keep(np.unique(flat))
        return ids, ends

    def _keep(self, used: np.ndarray) -> None:
        """Remember the pieces with these numbers only."""
        pieces, sizes = list(self.slots), np.diff(self.starts)[used]
        ids = self.ids[spans(self.starts[used], sizes)]
        self.forget()
        self.slots.update((pieces[k], i) for i, k in enumerate(used.tolist()))
        self.starts, self.ids = np.concatenate([[0], np.cumsum(sizes)]), ids


def distinct(places: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    places = np.sort(places)
    return places[np.append(True, places[1:] != places[:-1])] if len(places) else places


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of some spans, one span after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``size`` bytes of the last column, at least one row each."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(batch.num_columns - 1)).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < batch.num_rows:
            before = int(ends[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def _token_table(tokens: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All tokens' bytes, and where each id's begin and the last end."""
    each = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
    return np.frombuffer(b"".join(each), np.uint8), np.concatenate([[0], np.cumsum(list(map(len, each)))])


def _decoded(ids: np.ndarray, ends: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> pa.Array:
    """The bytes of each list of ids; list i ends where ``ends[i + 1]`` says."""
    data, starts = table
    sizes = np.diff(starts)[ids]
    stops = np.concatenate([[0], np.cumsum(sizes)])[ends]
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [
        None, pa.py_buffer(stops.astype(np.int64)), pa.py_buffer(data[spans(starts[ids], sizes)])]).cast(pa.binary())


def encode(docs: DataFrame, ranks: str, pattern: str, decoded: bool = False) -> DataFrame:
    """``(doc_id, ids array<int>)`` of every row of ``docs(doc_id, text, …)``.

    ``ranks`` is the path, on every node, of a vocabulary of base64 tokens and
    ranks.  Each match of ``pattern`` is encoded by itself; there are no special
    tokens.  Null and empty texts have no ids.  Repeated rows give repeated
    results; an empty table gives none; other columns are not read.  Texts may
    have any length: one that is longer than a block is a block of its own.
    ``pattern`` must not match across a space between two characters that are no
    white space.  With ``decoded`` a third column has the ids decoded again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, table = MergeReplay.of(ranks, pattern), None
        if decoded:
            table = _token_table(coder.tokens)
        for batch in blocks(batches):
            ids, ends = coder(batch.column(1).to_pylist())
            columns = [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))]
            if decoded:
                columns.append(_decoded(ids, ends, table))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][:len(columns)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids array<int>" + ", decoded binary" * decoded)


def decode(coded: DataFrame, ranks: str) -> DataFrame:
    """``(doc_id, ids, decoded binary)`` of rows ``(doc_id, ids)``; null ids decode to no bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _token_table({rank: token for token, rank in read_ranks(ranks).items()})
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n = pc.fill_null(pc.list_value_length(part.column(1)), 0).to_numpy(zero_copy_only=False)
                ids = part.column(1).flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), _decoded(ids, np.concatenate([[0], np.cumsum(n)]), table)],
                    ["doc_id", "ids", "decoded"])

    kind = coded.schema["doc_id"].dataType.simpleString()
    return coded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")
