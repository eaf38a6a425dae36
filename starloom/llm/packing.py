"""Packing into fixed windows by minimum bin slack.

A task tokenises its documents block by block.  Whole windows are cut off each
document; what remains is shorter than the window.  The multiset of remaining
lengths of the block is then packed: the longest length left is set, and a
subset-sum dynamic program over bitsets (a Python integer whose bit ``s`` says
that the sum ``s`` can be reached) finds the multiset of further lengths that
comes closest to the capacity.  Backtracking through the stored bitsets gives
the count of each length, and the pattern is used as often as the counts allow.

Blocks are packed apart, without any shuffle: a block holds thousands of
lengths, so only its last few sequences have slack.  A sequence with more than
``max_padding`` free ids is cut into sequences of powers of two, which need no
padding.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A block ends at this many documents or bytes of text.
BLOCK_DOCS = 8192
BLOCK_BYTES = 6 << 20
#: Text that is tokenised at a time.
SLICE_BYTES = BLOCK_BYTES
#: Distinct words whose ids a Python worker remembers.
CACHE_WORDS = 600_000


#: Texts with combining marks are tokenised as they are.
_MARKS = "[\\x{0300}-\\x{036F}]"
#: Commas and full stops that end a word.
_STOPS = "([a-z])([,.]+)(\\s|$)"


#: Words that tell what a tokenizer does with case, punctuation and white space.
_PROBES = ("the", "Paris", "zqx", "naive", "i", "I'm", "tokenizer", "don't", "x", "unquestionably")


def _room(array: np.ndarray, used: int, more: int) -> np.ndarray:
    """``array``, or a longer copy, with room for ``more`` after ``used``."""
    if used + more <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(more, len(array)), array.dtype)])


class WordTokenizer:
    """Ids of texts by a tokenizer whose words never span ASCII white space.

    Each distinct word of a block is tokenised once and its ids are copied to
    its places.  Where the tokenizer lower-cases and takes punctuation apart from
    letters, doing both beforehand leaves fewer distinct words.  Probes tell
    whether it does: one for which white space matters gets whole texts, one with
    cased tokens, or tokens of letters and punctuation, words as they are.
    """

    _made: dict[str, WordTokenizer] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.by_words = all(self._same(a + gap + b, a, b) for gap in (" ", "  ", "\t", "\n", " \r\n")
                            for a, b in zip(_PROBES, reversed(_PROBES), strict=True))
        self.folded = self.by_words and all(
            self._same(w.upper(), w.lower()) and self._same(w.title(), w.lower())
            and all(self._same(w.lower() + stop, w.lower(), stop) for stop in (".", ",", "...", ",.", ",,"))
            for w in _PROBES)
        self._forget()

    def _same(self, text: str, *parts: str) -> bool:
        """Whether a text has the ids of its parts, one part after another."""
        ids = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in (text, *parts)]
        return ids[0] == list(chain.from_iterable(ids[1:]))

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.ids, self.ends = np.empty(1 << 16, np.int32), np.zeros(1 << 14, np.int64)
        self.known = self.used = 0

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), 10_000):
            part = words[at:at + 10_000]
            found = [c.ids for c in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self.places.update(zip(part, range(self.known, self.known + len(part)), strict=True))
            self.ids = _room(self.ids, self.used, int(sizes.sum()))
            self.ids[self.used:self.used + int(sizes.sum())] = np.fromiter(
                chain.from_iterable(found), np.int32, int(sizes.sum()))
            self.ends = _room(self.ends, self.known + 1, len(part))
            self.ends[self.known + 1:self.known + 1 + len(part)] = self.used + np.cumsum(sizes)
            self.known += len(part)
            self.used += int(sizes.sum())

    @staticmethod
    def _fold(texts: pa.Array) -> pa.Array:
        """Lower-cased, with a space before what ends a word."""
        plain = pc.replace_substring_regex(pc.ascii_lower(texts), _STOPS, r"\1 \2\3")
        marked = pc.match_substring_regex(texts, _MARKS).to_pylist()
        if not any(marked):
            return plain
        return pa.array([t if m else p for t, m, p in zip(
            texts.to_pylist(), marked, plain.to_pylist(), strict=True)], pa.large_string())

    def __call__(self, texts: pa.Array, cache_words: int = CACHE_WORDS) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where each text's ids end."""
        if len(self.places) > cache_words:
            self._forget()
        texts = texts.cast(pa.large_string())
        texts = pa.concat_arrays([texts, texts.slice(0, 0)])  # a copy: ascii_lower misreads sliced arrays
        if self.by_words:
            lists = pc.ascii_split_whitespace(self._fold(texts) if self.folded else texts)
        else:
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1), pa.int32()), texts)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        self._learn([w for w in words if w not in self.places])
        place = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        ends = self.ends
        at = place[coded.indices.to_numpy(zero_copy_only=False)]
        lo, n = ends[at], ends[at + 1] - ends[at]
        upto = np.cumsum(n)
        take = np.repeat(lo - upto + n, n) + np.arange(int(upto[-1]) if len(upto) else 0)
        cuts = lists.offsets.to_numpy()[1:] - lists.offsets.to_numpy()[0]
        return self.ids[take], np.concatenate([[0], upto])[cuts]


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Multiset of ``counts`` with the largest sum up to ``capacity``, its longest length included.

    Lengths join the bitset program in descending order, each as binary parts
    of its count, until the capacity itself can be reached or all are in.
    """
    longest = max(counts)
    goal = capacity - longest
    mask, reach = (1 << (goal + 1)) - 1, 1
    layers = []
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == longest), goal // length)
        part = 1
        while left > 0 and not reach >> goal & 1:
            take = min(part, left)
            layers.append((length, take, reach))
            reach |= reach << (length * take) & mask
            left -= take
            part *= 2
        if reach >> goal & 1:
            break
    total, chosen = reach.bit_length() - 1, {longest: 1}
    for length, take, before in reversed(layers):
        if not before >> total & 1:
            total -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def plan(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Item numbers of each sequence; every item of ``lengths`` (1 to ``capacity``) in exactly one."""
    items: dict[int, list[int]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        items.setdefault(int(lengths[i]), []).append(i)
    counts = {n: len(x) for n, x in items.items()}
    out = []
    while counts:
        chosen = fill(counts, capacity)
        times = min(counts[n] // k for n, k in chosen.items())
        for _ in range(times):
            out.append([items[n].pop() for n, k in chosen.items() for _ in range(k)])
        for n, k in chosen.items():
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
    return out


def _pack_block(ends: np.ndarray, capacity: int, max_padding: int) -> tuple[np.ndarray, ...]:
    """Pieces ``(document, start, length, sequence, offset)`` of documents that end at ``ends``; sequences from 0."""
    sizes = np.diff(ends, prepend=0)
    whole, rest = sizes // capacity, sizes % capacity
    doc = np.repeat(np.arange(len(sizes)), whole)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole)) * capacity
    n = len(doc)
    pieces = [np.stack([doc, start, np.full(n, capacity), np.arange(n), np.zeros(n, np.int64)], axis=1)]
    left = np.flatnonzero(rest)
    rows, sequence = [], n
    for members in plan(rest[left], capacity):
        room = int(sum(rest[left[m]] for m in members))
        cuts = [capacity]
        if capacity - room > max_padding:
            cuts = [1 << b for b in range(room.bit_length() - 1, -1, -1) if room >> b & 1]
        at, cut = 0, 0
        for m in members:
            d = int(left[m])
            done, size = 0, int(rest[d])
            while done < size:
                if at == cuts[cut]:
                    at, cut, sequence = 0, cut + 1, sequence + 1
                take = min(size - done, cuts[cut] - at)
                rows.append((d, int(whole[d]) * capacity + done, take, sequence, at))
                done, at = done + take, at + take
        sequence += 1
    if rows:
        pieces.append(np.array(rows, np.int64))
    return tuple(np.concatenate(pieces).T)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1,
         max_padding: int = 32, slice_bytes: int = SLICE_BYTES, cache_words: int = CACHE_WORDS) -> DataFrame:
    """Pieces of all rows of ``docs(doc_id, text, …)``:
    ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``, ids as little-endian
    unsigned 32-bit numbers.

    ``tokenizer`` is the path, on every node, of a vocabulary of the tokenizers
    library; how it treats white space, case and punctuation is probed
    (``WordTokenizer``).  Texts may have any length; an empty table gives no rows
    and other columns are not read.  A document is its ids, without special tokens, and ``end_id``; null
    and empty texts are ``end_id`` alone.  Each id lies in one piece, and a
    sequence's offsets have no gap.  Sequences are meant to be padded to
    ``capacity`` unless their length is a power of two.  Repeated rows are
    separate documents.  Sequence ids are unique and follow from the input
    partition, the block and the place, so a repeated task gives them again.
    Smaller ``slice_bytes`` and ``cache_words`` take less memory and more time;
    the result is the same.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, block = WordTokenizer.of(tokenizer), TaskContext.get().partitionId(), 0

        def packed(ids_of_docs: list, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            keys = pa.concat_arrays(ids_of_docs)
            ids = np.concatenate(held) if held else np.empty(0, np.int32)
            ends = np.flatnonzero(ids == -1) + 1  # a mark that no vocabulary has
            ids[ends - 1] = end_id
            doc, start, length, sequence, offset = _pack_block(ends, capacity, max_padding)
            sizes = np.diff(ends, prepend=0)
            lo = (ends - sizes)[doc] + start
            for at in range(0, len(doc), 4096):
                cut = slice(at, at + 4096)
                upto = np.cumsum(length[cut])
                take = np.repeat(lo[cut] - upto + length[cut], length[cut]) + np.arange(int(upto[-1]))
                stops = np.concatenate([[0], upto * 4]).astype(np.int32)
                raw = pa.Array.from_buffers(pa.binary(), len(upto), [
                    None, pa.py_buffer(stops), pa.py_buffer(ids[take].astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(doc[cut])), pa.array(start[cut]), pa.array(length[cut]), raw,
                     pa.array(sizes[doc[cut]]), pa.array((part << 40) + (block << 24) + sequence[cut]),
                     pa.array(offset[cut])],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        keys, held, n_docs, n_bytes = [], [], 0, 0
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
            at = 0
            while at < batch.num_rows:
                room = np.cumsum(sizes[at:at + BLOCK_DOCS]) <= min(slice_bytes, BLOCK_BYTES - n_bytes)
                take = int(min(max(room.sum(), 1), BLOCK_DOCS - n_docs))
                ids, ends = tokens(batch.column(1).slice(at, take), cache_words)
                keys.append(batch.column(0).slice(at, take))
                held.append(np.insert(ids, ends, -1))
                n_docs, n_bytes, at = n_docs + take, n_bytes + int(sizes[at:at + take].sum()), at + take
                if n_docs >= BLOCK_DOCS or n_bytes >= BLOCK_BYTES:
                    yield from packed(keys, held)
                    keys, held, n_docs, n_bytes, block = [], [], 0, 0, block + 1
        if n_docs:
            yield from packed(keys, held)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, "
             "sequence_id long, offset long")


def ids_crc32(ids: Column) -> Column:
    """CRC-32 of a piece's ids, which are little-endian unsigned 32-bit numbers."""
    return F.crc32(ids)
