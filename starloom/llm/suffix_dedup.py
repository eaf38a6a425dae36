"""Removal of repeated byte strings, found in suffix arrays.

The texts' windows (all strings of ``width`` bytes) are first dealt out so that
equal windows meet, without shipping every suffix:

1. Each window is named by its smallest hashed ``GRAM``-byte substring
   (leftmost of equals).  Equal windows have equal names at equal places, and
   neighbouring windows mostly share theirs, so a text becomes short runs of
   windows.  A name that only one run of the corpus has can't hold a repeat.
   (Runs that are joined, see below, count one by one.)  In a periodic stretch the name comes again every period; windows that equal
   those one period before are repeats on the spot and go no further, and other
   neighbouring runs of one name are joined, so a stretch costs its own size.
2. The bytes of the other runs are dealt by name, identical ones combined and
   counted first.  A name with very many different runs (a passage that a third
   of the corpus holds, with different surroundings) is split further by the
   bytes that eight neighbouring windows have in common, and what is still
   crowded then, by the whole window, which leaves one run with a count.
3. A task concatenates the runs of its names and sorts their suffixes in two
   stages: only suffixes smaller than their successors are sorted directly, the
   others are induced by one scan over the buckets of first bytes.  Windows
   whose common prefix with a neighbour in the suffix array spans ``width``
   bytes, and windows of runs that occur more than once, are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import retain, settled, small, whole_text
from starloom.llm.exact_dedup import exact_dedup
from starloom.session import checkpoint_dir

GRAM = 32
#: Bytes of text scanned, and of runs sorted, at a time.
SCAN_BYTES, SORT_BYTES = 1 << 19, 1 << 20
#: A name with more different runs than this is split.
CROWDED = 4096
#: Windows that a split run keeps together.
TOGETHER = 8
_SEPARATOR = 0xFF  # in no UTF-8 text
_BASE = 0x9E3779B97F4A7C15


class Winnower:
    """Runs of windows by name."""

    def __init__(self, width: int, gram: int = GRAM):
        self.width, self.gram = width, gram
        self.powers, self.inverses = (np.full(SCAN_BYTES + 2 * width, base, np.uint64)
                                      for base in (_BASE, pow(_BASE, -1, 1 << 64)))
        for table in (self.powers, self.inverses):
            table[0] = 1
            np.cumprod(table, out=table)

    def _grams(self, sums: np.ndarray) -> np.ndarray:
        """Mixed hash of the gram at each place."""
        h = (sums[self.gram:] - sums[:-self.gram]) * self.inverses[:len(sums) - self.gram]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        return h

    def runs(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """``(text, name, place, first, last)``: windows ``first`` to ``last`` of a text are named by its gram at ``place``.

        In a run that joins several, ``place`` is of its first window and the gram comes again.
        A negative ``place`` marks windows that are repeats inside the text; the first
        of each kind is in a run, too.
        """
        return self.counted_runs(texts)[:5]

    def counted_runs(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """``runs`` and, as a sixth column, how many runs each of them joins."""
        found, part, size = [], [], 0
        for i, raw in enumerate(texts):
            if len(raw) < self.width:
                continue
            for at in range(0, len(raw) - self.width + 1, SCAN_BYTES):
                piece = raw[at:at + SCAN_BYTES + self.width - 1]
                if part and size + len(piece) > SCAN_BYTES + self.width:
                    found.append(self._scan(part))
                    part, size = [], 0
                part.append((i, at, piece))
                size += len(piece)
        if part:
            found.append(self._scan(part))
        if not found:
            return tuple(np.empty(0, np.int64) for _ in range(6))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def _scan(self, parts: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
        data = np.frombuffer(b"".join([p for _, _, p in parts]), np.uint8).astype(np.uint64)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(data * self.powers[:len(data)])])
        h = self._grams(sums)
        places = np.uint64((1 << 22) - 1)
        least = (h & ~places) | np.arange(len(h), dtype=np.uint64)
        span, wanted = 1, self.width - self.gram + 1
        while span * 2 <= wanted:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if wanted > span:
            least = np.minimum(least[:len(least) - (wanted - span)], least[wanted - span:])
        place = (least & places).astype(np.int64)
        sizes = np.array([len(p) for _, _, p in parts])
        ends = np.cumsum(sizes)
        n = sizes - self.width + 1  # windows of each part
        start = np.repeat(ends - sizes - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        owner = np.repeat(np.arange(len(parts)), n)
        at = place[start]
        cuts = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
        last = np.append(cuts[1:], len(at)) - 1
        part, name, place, first, last = owner[cuts], h[at[cuts]], at[cuts], start[cuts], start[last]
        again = self._again(data, sums, part, name, place, first, last)
        period = np.diff(place, prepend=0)
        # neighbouring runs that repeat what lies one period before, as one row of repeats
        spot = np.flatnonzero(again)
        fresh = np.flatnonzero((np.diff(spot, prepend=-2) != 1) | (np.diff(period[spot], prepend=-1) != 0))
        heads, hi = spot[fresh], last[spot[np.append(fresh[1:], len(spot)) - 1]] if len(spot) else spot
        repeats = (part[heads], name[heads], first[heads] - period[heads], hi)
        # other neighbouring runs of one name, joined in blocks of about width windows
        part, name, place, first, last = (x[~again] for x in (part, name, place, first, last))
        chain = ((np.diff(part, prepend=-1) != 0) | (name != np.append(name[:1], name[:-1]))
                 | (first != np.append(-1, last[:-1]) + 1))
        chain[:1] = True
        begin = first[np.maximum.accumulate(np.where(chain, np.arange(len(chain)), 0))]
        heads = np.flatnonzero(chain | (np.diff((first - begin) // self.width, prepend=0) != 0))
        joined = np.diff(np.append(heads, len(last)))
        last = last[np.append(heads[1:], len(last)) - 1]
        part, name, place, first = (x[heads] for x in (part, name, place, first))
        shift = np.array([a for _, a, _ in parts]) - (ends - sizes)
        texts = np.array([i for i, _, _ in parts])
        return tuple(np.concatenate(c) for c in (
            (texts[part], texts[repeats[0]]), (name.view(np.int64), repeats[1].view(np.int64)),
            (place + shift[part], np.full(len(hi), -1)), (first + shift[part], repeats[2] + shift[repeats[0]]),
            (last + shift[part], hi + shift[repeats[0]]), (joined, np.ones(len(hi), np.int64))))

    def _again(self, data: np.ndarray, sums: np.ndarray, part: np.ndarray, name: np.ndarray,
               place: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Which runs have all their windows once more, as far before as the run before has its gram."""
        period = np.diff(place, prepend=0)
        began = first[np.searchsorted(part, part)]  # first window of the same part
        at = np.flatnonzero((np.diff(part, prepend=-1) == 0) & (name == np.append(name[:1], name[:-1]))
                            & (first - period >= began))
        again = np.zeros(len(part), bool)
        lo, hi, back = first[at], last[at] + self.width, period[at]
        same = ((sums[hi] - sums[lo]) * self.inverses[lo]
                == (sums[hi - back] - sums[lo - back]) * self.inverses[lo - back])
        at, lo, hi, back = (x[same] for x in (at, lo, hi, back))
        # equal hashes are held against the bytes, neighbouring runs at a time
        heads = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(back, prepend=-1) != 0))
        for i, j in zip(heads.tolist(), [*heads[1:].tolist(), len(at)][:len(heads)], strict=True):
            a, b, p = lo[i], hi[j - 1], back[i]
            again[at[i:j]] = np.array_equal(data[a:b], data[a - p:b - p])
        return again


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes of ``data`` (uint8), sorted by their first ``depth`` bytes at least.

    Two stages: suffixes smaller than their successors are sorted by their first
    eight bytes, then by five at a time among those still equal; the others
    follow from one scan over the buckets of first bytes.
    """
    n = len(data)
    if n == 0:
        return np.empty(0, np.int64)
    step = np.sign(np.diff(data.astype(np.int16)))
    run_end = np.append(np.flatnonzero(step != 0), n - 1)
    rises = np.append(step[run_end[:-1]] > 0, False)  # the end counts as smaller than any byte
    small_type = np.repeat(rises, np.diff(run_end, prepend=-1))
    words = packed_words(data)
    order = _sorted_directly(np.flatnonzero(small_type), words, n, depth)
    first = data[order]
    cuts = np.searchsorted(first, np.arange(257))
    larger: list[list[np.ndarray]] = [[] for _ in range(256)]
    larger[int(data[-1])].append(np.array([n - 1]))  # its successor is the empty suffix, the smallest

    def induce(starts: np.ndarray, bucket: int) -> np.ndarray:
        """Hand the larger-type predecessors to their buckets; return those of this very bucket."""
        before = starts[starts > 0] - 1
        before = before[~small_type[before]]
        if not len(before):
            return before
        byte = data[before]
        by = np.argsort(byte, kind="stable")
        before, byte = before[by], byte[by]
        edges = np.flatnonzero(np.diff(byte.astype(np.int16), prepend=-1))
        same = before[:0]
        for lo, hi in zip(edges, np.append(edges[1:], len(byte)), strict=True):
            if byte[lo] == bucket:
                same = before[lo:hi]
            else:
                larger[byte[lo]].append(before[lo:hi])
        return same

    out = []
    for bucket in range(256):
        wave = np.concatenate(larger[bucket]) if larger[bucket] else order[:0]
        while len(wave):
            out.append(wave)
            wave = induce(wave, bucket)
        own = order[cuts[bucket]:cuts[bucket + 1]]
        if len(own):
            out.append(own)
            induce(own, bucket)
    return np.concatenate(out)


def packed_words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number, zeros beyond the end."""
    padded = np.concatenate([data, np.zeros(7, np.uint8)]).astype(np.uint64)
    out = padded[:len(data)].copy()
    for i in range(1, 8):
        out = out << np.uint64(8) | padded[i:len(data) + i]
    return out


def _sorted_directly(starts: np.ndarray, words: np.ndarray, n: int, depth: int) -> np.ndarray:
    """``starts`` ordered by the bytes that follow them."""
    order = starts[np.argsort(words[starts])]
    key = words[order]
    new = np.append(True, key[1:] != key[:-1]) if len(key) else np.empty(0, bool)
    for at in range(8, depth, 5):
        # places in runs of equal keys
        tied = ~new
        tied[:-1] |= ~new[1:]
        spot = np.flatnonzero(tied)
        if not len(spot):
            break
        rows = order[spot]
        follow = words[np.minimum(rows + at, n - 1)]
        follow[rows + at >= n] = 0
        # one sort by the run and the next five bytes
        key = np.cumsum(new[spot]).astype(np.uint64)
        if key[-1] >> np.uint64(24):
            raise ValueError("too many bytes to sort at a time")
        key = key << np.uint64(40) | follow >> np.uint64(24)
        by = np.argsort(key)
        order[spot] = rows[by]
        key = key[by]
        new[spot] |= np.append(True, key[1:] != key[:-1])
    return order


def repeated_windows(runs: list[bytes], counts: np.ndarray, width: int) -> list[np.ndarray]:
    """For each of the different ``runs``, which of its windows are repeats."""
    sizes = np.array([len(r) for r in runs])
    data = np.frombuffer(b"".join(r + bytes([_SEPARATOR]) for r in runs), np.uint8)
    ends = np.cumsum(sizes + 1)
    owner = np.repeat(np.arange(len(runs)), sizes + 1)
    inside = np.arange(len(data)) + width <= (ends - 1)[owner]
    order = suffix_array(data, width)
    order = order[inside[order]]
    words = packed_words(data)
    a, b = order[:-1], order[1:]
    near = np.arange(len(a))
    for at in range(0, width, 8):  # adjacent common prefixes, eight bytes at a time
        at = min(at, width - 8)
        near = near[words[a[near] + at] == words[b[near] + at]]
    marked = np.zeros(len(data), bool)
    marked[a[near]] = marked[b[near]] = True
    marked |= (counts > 1)[owner]
    return [m[:max(0, s - width + 1)] for m, s in zip(np.split(marked, ends[:-1]), sizes, strict=True)]


def spans_of(marks: np.ndarray, width: int) -> np.ndarray:
    """Maximal byte runs covered by windows ``first .. last`` (rows of ``marks``), as ``(start, end)`` rows."""
    marks = marks[np.argsort(marks[:, 0], kind="stable")]
    reach = np.maximum.accumulate(marks[:, 1] + width)
    fresh = np.append(True, marks[1:, 0] > reach[:-1])
    lo = np.flatnonzero(fresh)
    return np.stack([marks[lo, 0], reach[np.append(lo[1:], len(marks)) - 1]], axis=1)


_RUN = "struct<name:bigint,place:int,first:int,last:int>"


def _scan_runs(width: int, names_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnow = Winnower(width)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                text, name, place, first, last, joined = winnow.counted_runs(part.column(1).to_pylist())
                if names_only:
                    weight = part.column(0).to_numpy(zero_copy_only=False)[text] * joined
                    yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(weight)], ["name", "n"])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(text)), pa.array(name),
                         *[pa.array(x.astype(np.int32)) for x in (place, first, last)]],
                        ["key", "name", "place", "first", "last"])
    return run


def _cut(width: int):
    """The bytes of each listed run of a text; rows of repeats have their last window in ``place``, as ``-1 - last``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for k, n, t, runs in zip(*batch.columns, strict=True):
                k, n, t = k.as_py(), n.as_py(), t.as_py()
                fields = [f.to_numpy(zero_copy_only=False) for f in runs.values.flatten()]
                for at in range(0, len(runs), 4096):
                    for name, place, first, last in zip(*(f[at:at + 4096].tolist() for f in fields), strict=True):
                        rows.append((k, n, name, place, first, t[first:last + width]) if place >= 0
                                    else (k, n, name, -1 - last, first, None))
                        size += last + width - first if place >= 0 else 0
                        if size >= SCAN_BYTES or len(rows) >= 8192:
                            yield _rows(rows)
                            rows, size = [], 0
        yield _rows(rows)
    return run


_PIECE = "key binary, n long, name long, place int, first int, bytes binary"
_PIECE_TYPES = (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, _PIECE_TYPES, strict=True)],
        ["key", "n", "name", "place", "first", "bytes"])


def _split_crowded(width: int, together: int):
    """Runs cut into groups of ``together`` windows, renamed by the bytes that such a group has in common."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                raw, start, place = r["bytes"], r["first"], r["place"]
                first, end, gram = start, start + len(raw) - width, raw[place - start:place - start + GRAM]
                while first <= end:  # a joined run has its gram in several places
                    last = min(place, end)
                    for j in range((place - last) // together, (place - first) // together + 1):
                        lo = max(first, place - together * j - (together - 1))
                        hi = min(last, place - together * j)
                        core = place - together * j - start  # in every window of the group, from here …
                        common = raw[max(core, 0):core + width - together + 1]  # … to here
                        name = xxhash.xxh64_intdigest(common, r["name"] + j & (1 << 64) - 1)
                        rows.append((r["key"], r["n"], name - (1 << 63), place, lo, raw[lo - start:hi + width - start]))
                        if len(rows) >= 4096:
                            yield _rows(rows)
                            rows = []
                    found = raw.find(gram, place - start + 1)
                    first, place = last + 1, start + found if found >= 0 else end
            yield _rows(rows)
    return run


def _crowded(pieces: DataFrame) -> DataFrame:
    """Names with more than ``CROWDED`` different runs."""
    return small(settled(pieces.groupBy("name", "hash").count().groupBy("name").count()
                         .where(F.col("count") > CROWDED).select("name")))


def _renamed(pieces: DataFrame, names: DataFrame, width: int, together: int) -> DataFrame:
    """The runs of ``names``, split."""
    return (pieces.join(names, "name", "left_semi").select("key", "n", "name", "place", "first", "bytes")
            .mapInArrow(_split_crowded(width, together), _PIECE).withColumn("hash", F.xxhash64("bytes"))
            .select(*pieces.columns))


def _sort(width: int):
    """Windows, counted from the run's first, that are repeats: ``(name, hash, lo, hi)`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def marks(rows: list[tuple]) -> pa.RecordBatch:
            found = repeated_windows([r[2] for r in rows], np.array([r[3] for r in rows]), width)
            out = []
            for (name, mark, _, _), windows in zip(rows, found, strict=True):
                edges = np.flatnonzero(np.diff(np.concatenate([[0], windows.view(np.int8), [0]])))
                out += [(name, mark, int(lo), int(hi) - 1) for lo, hi in edges.reshape(-1, 2)]
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["name", "hash", "lo", "hi"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= SORT_BYTES and row[0] != held[-1][0]:
                    yield marks(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2]) + 1
        if held:
            yield marks(held)
    return run


def _without(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                removed, spans, digests, sizes, found = [], [], [], [], []
                for raw, marks in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    cut = spans_of(np.array([(m["lo"], m["hi"]) for m in marks]), width).tolist() if marks else []
                    kept, at = hashlib.sha256(), 0
                    for start, end in cut:
                        kept.update(raw[at:start])
                        at = end
                    kept.update(raw[at:])
                    sizes.append(len(raw))
                    removed.append(sum(e - s for s, e in cut))
                    spans.append(len(cut))
                    digests.append(kept.hexdigest())
                    found.append([{"start": s, "end": e} for s, e in cut])
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(x, pa.int64()) for x in (sizes, removed, spans)],
                     pa.array(digests, pa.string()), pa.array(found, kind)],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])
    return run


def repeated_strings(docs: DataFrame, width: int = 200) -> DataFrame:
    """One row per row of ``docs(doc_id, text, …)``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans``.

    Every byte that lies in a string of ``width`` UTF-8 bytes which also starts
    anywhere else, in the same text or another, is removed; strings are judged
    on the input.  ``spans`` has the maximal removed runs ``(start, end)`` and
    ``kept_sha256`` is of the remaining bytes.  Null and empty texts, and those
    shorter than ``width``, lose nothing; repeated rows are repeats of each
    other.  Texts may have any length: they are scanned in place, and runs of
    bounded length are sorted.  An empty table gives no rows; other columns are
    not read.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select("doc_id", whole_text().alias("text"))
    sha = F.sha2("text", 256)
    found = settled(exact_dedup(plain))
    one = retain(plain, {"doc_id": F.col("doc_id"), "sha": sha},
                 found.groupBy("doc_id", F.col("text_sha256").alias("sha")).agg(
                     F.count("*").alias("n_rows"), F.max("kept").alias("keep")))
    copies = small(settled(found.where("kept and group_size > 1").select(
        F.col("text_sha256").alias("sha"), F.col("group_size").alias("n"))))
    raw = F.col("text").cast("binary").alias("raw")
    key = F.substring(F.unhex(F.sha2("text", 256)), 1, 20).alias("key")  # no one can make two texts share it
    texts = (one.select("text", sha.alias("sha"), key).where(F.octet_length("text") >= width)
             .join(copies, "sha", "left").select("key", F.coalesce("n", F.lit(1)).cast("long").alias("n"), raw))

    shared = settled(texts.select("n", "raw").mapInArrow(_scan_runs(width, True), "name long, n long")
                     .groupBy("name").agg(F.sum("n").alias("n")).where("n > 1").select("name"))
    runs = (texts.select("key", "raw")
            .mapInArrow(_scan_runs(width, False), "key binary, name long, place int, first int, last int")
            .join(shared, "name").groupBy("key")
            .agg(F.collect_list(F.struct("name", "place", "first", "last")).alias("runs")))
    at = f"{checkpoint_dir(spark)}/runs-{uuid4().hex}"
    (texts.join(runs, "key").select("key", "n", "raw", "runs").mapInArrow(_cut(width), _PIECE)
     .withColumn("hash", F.xxhash64("bytes")).write.option("compression", "zstd").parquet(at))
    pieces = spark.read.parquet(at).where("place >= 0")
    inside = spark.read.parquet(at).where("place < 0").select(
        "key", F.struct(F.col("first").alias("lo"), (-1 - F.col("place")).alias("hi")).alias("mark"))
    crowded = _crowded(pieces)
    if not crowded.isEmpty():
        split = _renamed(pieces, crowded, width, TOGETHER)
        # what surrounds a passage may still differ in as many ways: equal windows alone are one run
        still = _crowded(split)
        if not still.isEmpty():
            split = split.join(still, "name", "left_anti").unionByName(_renamed(split, still, width, 1))
        pieces = pieces.join(crowded, "name", "left_anti").unionByName(split)
    different = pieces.groupBy("name", "hash", "bytes").agg(F.sum("n").alias("n"))
    repeats = (different.repartition(parts, "name").sortWithinPartitions("name")
               .select("name", "hash", "bytes", "n").mapInArrow(_sort(width), "name long, hash long, lo int, hi int"))
    marks = (pieces.select("key", "name", "hash", "first").join(settled(repeats), ["name", "hash"])
             .select("key", F.struct((F.col("first") + F.col("lo")).alias("lo"),
                                     (F.col("first") + F.col("hi")).alias("hi")).alias("mark"))
             .unionByName(inside).groupBy("key").agg(F.collect_list("mark").alias("marks")))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return (plain.select("doc_id", raw, key).join(settled(marks), "key", "left").select("doc_id", "raw", "marks")
            .mapInArrow(_without(width), f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, "
                                         "kept_sha256 string, spans array<struct<start:bigint,end:bigint>>"))
