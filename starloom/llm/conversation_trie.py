"""Prefix trie of conversations by range minima over sorted common prefixes.

Every conversation is a sequence of turn keys (SHA-256 of role and text) with a
word count for each turn.  The sequences are sorted over the whole cluster by
range, so a task holds a run of neighbours, and a group of equal conversations of
any size is dealt over tasks by its ids.  A task takes the common prefix lengths
of its neighbours, builds sparse tables for range minima over them, and finds for
each candidate prefix (a row and a depth that first shows there) how far it
reaches to the left and to the right, each by a binary search of its own.  The
members of a prefix are then an interval of rows, and everything asked of a node
is a sum, or a minimum, over that interval:

* leaves below: rows of which the next row is no equal and no continuation;
* children: rows that share exactly ``depth`` turns with the row before and go on;
* words saved below: what each row shares with the row before, less the words
  above the node.

A prefix that crosses a border between tasks has a partial row in each of them;
the partial rows add up.  No step depends on the depth of the trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import settled

#: Ids in one piece of the members that end at a node.
PIECE_IDS = 4096
#: Nodes in one Arrow batch.
BATCH = 20_000

_FIRST = hashlib.sha256().digest()
_PARTIAL = ("node binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, "
            "saved_tokens long, ends string, part int, seq int, piece string")


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turns array<struct<key binary, words int>>)`` of ``(conv_id, turn, role, text)``.

    Turns are ordered by ``turn``, null first; of equal ``turn`` by key.  Null
    roles and texts count as empty; repeated rows are turns of their own.  Rows
    without a ``conv_id`` belong to no conversation.  Other columns are not read.
    A conversation is held whole by one task, at about 40 bytes a turn, its
    texts not included; a text may have any length.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    turns = (conversations.where("conv_id is not null")
             .select(F.col("conv_id").cast("long").alias("conv_id"),
                     F.struct("turn", key.alias("key"), words.alias("words")).alias("t"))
             .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")))
    return turns.select("conv_id", F.transform("t", lambda t: F.struct(t["key"], t["words"])).alias("turns"))


def spliced(sequences: DataFrame, every: int, heads: int) -> DataFrame:
    """Each conversation c begins with the first h turns of conversation c - c % ``every``.

    h is the unsigned CRC-32 of the decimal c, modulo ``heads``.  They are all
    turns of that conversation if it has fewer, and none if it isn't there; c's
    own turns after its first h follow, if any.
    """
    first = sequences.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("_base"), F.slice("turns", 1, max(heads - 1, 1)).alias("_head"))
    own = sequences.select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("_base"), "turns",
                           (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int").alias("_h"))
    rest = F.slice("turns", F.col("_h") + 1, F.size("turns"))
    head = F.slice("_head", F.lit(1), F.col("_h"))
    return own.join(first, "_base", "left").select(
        "conv_id", F.when(F.col("_head").isNull(), rest).otherwise(F.concat(head, rest)).alias("turns"))


def minima(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: level k has the minimum of the 2**k values from each place."""
    levels, width = [values], 1
    while 2 * width <= len(values):
        last = levels[-1]
        levels.append(np.minimum(last[:-width], last[width:]))
        width *= 2
    return levels


def reach(levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row of each prefix: row ``at``, ``depth`` turns; ``levels`` of the common prefix lengths.

    Length i is that of the rows i - 1 and i.  Either end is searched by itself.
    """
    n, left, right = len(levels[0]), at.copy(), at.copy()
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        to = right + step
        fits = to < n
        fits[fits] = levels[k][right[fits] + 1] >= depth[fits]
        right[fits] += step
        fits = left - step >= 0
        fits[fits] = levels[k][left[fits] - step + 1] >= depth[fits]
        left[fits] -= step
    return left, right


def least(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The minimum over each interval, ends included."""
    out = np.empty(len(left), levels[0].dtype)
    k = np.frexp((right - left + 1).astype(float))[1] - 1
    for level in np.unique(k):
        mine = k == level
        out[mine] = np.minimum(levels[level][left[mine]], levels[level][right[mine] - (1 << level) + 1])
    return out


def common_lengths(keys: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Equal first keys of each row and the row before; row 0 has none before and gets 0."""
    out = np.zeros(len(sizes), np.int64)
    if len(sizes) < 2:
        return out
    both = np.minimum(sizes[1:], sizes[:-1])
    some = np.flatnonzero(both)
    if not len(some):
        return out
    n = both[some]
    ends = np.cumsum(n)
    step = np.arange(ends[-1]) - np.repeat(ends - n, n)
    same = (keys[np.repeat(starts[some], n) + step] == keys[np.repeat(starts[some + 1], n) + step]).all(axis=1)
    out[some + 1] = np.minimum.reduceat(np.where(same, np.repeat(n, n), step), ends - n)
    return out


def _table(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    found = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(found).combine_chunks() if found else None


def _flat(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """Values of a list column, and where each row's begin and the last end."""
    lists = column.chunk(0)
    offsets = lists.offsets.to_numpy()
    return lists.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]


def _key_rows(values: pa.Array) -> np.ndarray:
    """32-byte keys as rows of four numbers."""
    if not len(values):
        return np.empty((0, 4), np.uint64)
    fixed = values.cast(pa.binary(32))
    return np.frombuffer(fixed.buffers()[1], np.uint64)[fixed.offset * 4:(fixed.offset + len(fixed)) * 4].reshape(-1, 4)


def _partial(nodes: dict[str, list], pieces: list[tuple], part: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
                        ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                        ("saved_tokens", pa.int64()), ("ends", pa.string()), ("part", pa.int32()),
                        ("seq", pa.int32()), ("piece", pa.string())])
    n = len(nodes["node"])
    for lo in range(0, n, BATCH):
        hi = min(n, lo + BATCH)
        columns = [pa.array(nodes[f.name][lo:hi], f.type) if f.name in nodes else pa.nulls(hi - lo, f.type) for f in schema]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)
    for lo in range(0, len(pieces), 16):
        some = pieces[lo:lo + 16]
        own = {"node": [p[0] for p in some], "part": [part] * len(some), "seq": [p[1] for p in some],
               "piece": [p[2] for p in some]}
        columns = [pa.array(own[f.name], f.type) if f.name in own else pa.nulls(len(some), f.type) for f in schema]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def chunk_nodes(keys: np.ndarray, words: np.ndarray, starts: np.ndarray, convs: np.ndarray,
                before: int, after: int) -> tuple[dict[str, list], list[tuple]]:
    """Partial nodes of sorted rows, and the pieces of the ends that may cross a border.

    ``starts`` has one entry more than there are rows.  ``before`` and ``after``:
    turns shared with the row before the first and after the last, -1 if none.
    """
    n, sizes, starts = len(convs), np.diff(starts), starts[:-1]
    shared = common_lengths(keys, starts, sizes)
    shared[0] = before
    following = np.append(shared[1:], after)
    total = np.concatenate([[0], np.cumsum(words)])  # words of the turns before each place

    def words_above(row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        return total[starts[row] + depth] - total[starts[row]]

    counts = sizes - shared
    counts[0] = sizes[0] + 1  # all prefixes of the first row, also those that go on from the task before
    row = np.repeat(np.arange(n), counts)
    first = np.cumsum(counts) - counts
    depth = np.arange(len(row)) - np.repeat(first, counts) + np.repeat(np.append(0, shared[1:] + 1), counts)
    levels = minima(shared)
    left, right = reach(levels, row, depth)
    assert np.array_equal(left, row)  # a prefix first shows at its leftmost row
    opened = shared[left] < depth  # it begins in this task
    smallest = least(minima(convs), left, right)

    above = words_above(left, np.maximum(depth - 1, 0))
    run = np.cumsum(words_above(np.arange(n), np.maximum(shared, 0)))
    saved = run[right] - run[left] - (right - left) * above
    saved += np.where(opened, 0, words_above(left, np.maximum(shared[left], 0)) - above)
    childless = np.concatenate([[0], np.cumsum(following < sizes)])
    leaves = childless[right + 1] - childless[left]
    goes_on = np.flatnonzero(sizes > shared)
    place = np.sort(shared[goes_on] * (n + 1) + goes_on)
    children = (np.searchsorted(place, depth * (n + 1) + right, "right")
                - np.searchsorted(place, depth * (n + 1) + left, "right"))
    children += (sizes[left] > depth) & (shared[left] <= depth)

    node, parent, path = [], [], [_FIRST]
    ends: list[str | None] = [None] * len(row)
    pieces: list[tuple] = []
    raw = keys.tobytes()
    for i in range(n):
        old = 0 if i == 0 else int(shared[i]) + 1
        del path[max(old, 1):]
        for d in range(max(old, 1), int(sizes[i]) + 1):
            at = (int(starts[i]) + d - 1) * 32
            path.append(hashlib.sha256(path[-1] + raw[at:at + 32]).digest())
        for d in range(old, int(sizes[i]) + 1):
            node.append(path[d])
            parent.append(path[d - 1] if d else None)
    equal = (shared == sizes) & (np.append(-1, sizes[:-1]) == sizes)
    equal[0] = False
    begins = np.flatnonzero(~equal)
    stops = np.append(begins[1:], n)
    for lo, hi in zip(begins.tolist(), stops.tolist(), strict=True):
        mine = int(first[lo] + counts[lo] - 1)  # the candidate of the row's whole length
        ids = convs[lo:hi].astype(str).tolist()
        if (lo == 0 and before == sizes[0]) or (hi == n and after == sizes[n - 1]):
            pieces.extend((node[mine], k, ",".join(ids[k:k + PIECE_IDS])) for k in range(0, len(ids), PIECE_IDS))
        else:
            ends[mine] = hashlib.sha256(",".join(ids).encode()).hexdigest()
    return {"node": node, "parent": parent, "depth": depth, "conv_id": smallest, "n_convs": right - left + 1,
            "n_children": children, "n_leaves": leaves, "saved_tokens": saved, "ends": ends}, pieces


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last row's keys of each task."""
    first = last = None
    for batch in batches:
        if batch.num_rows:
            first = batch.slice(0, 1) if first is None else first
            last = batch.slice(batch.num_rows - 1, 1)
    if first is not None:
        yield pa.RecordBatch.from_arrays([first.column("part"), first.column("keys"), last.column("keys")],
                                         ["part", "first", "last"])


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row per distinct prefix of ``sequences(conv_id, turns)``, the empty one (the root) included.

    Columns: ``conv_id`` (the smallest member; members are the conversations
    that start with the prefix), ``depth``, ``parent_conv_id`` (null for the
    root), ``n_convs`` (members), ``n_children``, ``n_leaves`` (childless nodes
    in the subtree, its top included), ``saved_tokens`` (summed over the subtree:
    members less one, times the words of the node's last turn) and
    ``ends_sha256`` (hex SHA-256 of the ids of the members that end here,
    ascending, comma-joined; of the empty string if there are none).

    ``conv_id`` is unique and not null, as ``turn_sequences`` gives it.
    Conversations without turns are members of the root.  An empty table has no
    nodes.
    """
    spark = sequences.sparkSession
    rows = sequences.select("conv_id", F.transform("turns", lambda t: t["key"]).alias("keys"),
                            F.transform("turns", lambda t: t["words"]).alias("words"))
    rows = settled(rows.repartitionByRange("keys", "conv_id").sortWithinPartitions("keys", "conv_id")
                   .withColumn("part", F.spark_partition_id()))

    edges = rows.select("part", "keys").mapInArrow(_borders, "part int, first array<binary>, last array<binary>")
    # one row per task: (its number, turns its first row shares with the last row before)
    gap = F.array_position(F.zip_with("first", "prev", lambda a, b: F.coalesce(a == b, F.lit(False))), False)
    shared = edges.select("part", "first", F.lag("last").over(Window.orderBy("part")).alias("prev")).select(
        "part", F.when(F.col("prev").isNull(), -1).when(gap > 0, gap - 1).otherwise(F.size("first")).alias("shared"))
    before = {r["part"]: int(r["shared"]) for r in shared.collect()}
    order = sorted(before)
    after = {p: before[q] for p, q in zip(order, order[1:], strict=False)}

    def nodes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(batches)
        if table is None:
            return
        part = table["part"][0].as_py()
        keys, starts = _flat(table["keys"])
        words, _ = _flat(table["words"])
        nodes, pieces = chunk_nodes(_key_rows(keys), words.to_numpy(zero_copy_only=False).astype(np.int64),
                                    starts.astype(np.int64), table["conv_id"].to_numpy(), before[part], after.get(part, -1))
        yield from _partial(nodes, pieces, part)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ends that cross a border: the pieces of a node come one after another."""
        node, state = None, None
        for batch in batches:
            for key, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key == node:
                    state.update(b"," + piece.encode())
                    continue
                if node is not None:
                    yield _end(node, state)
                node, state = key, hashlib.sha256(piece.encode())
        if node is not None:
            yield _end(node, state)

    found = settled(rows.select("part", "conv_id", "keys", "words").mapInArrow(nodes_of, _PARTIAL))
    crossing = (found.where("piece is not null").select("node", "piece", "part", "seq")
                .repartition("node").sortWithinPartitions("node", "part", "seq")
                .select("node", "piece").mapInArrow(hashed, "node binary, ends string"))
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    least_of = ("parent", "depth", "conv_id")
    merged = (found.where("piece is null").select("node", *least_of, *sums, "ends")
              .unionByName(crossing, allowMissingColumns=True).groupBy("node")
              .agg(*[F.min(c).alias(c) for c in least_of], *[F.sum(c).alias(c) for c in sums], F.max("ends").alias("ends")))
    merged = settled(merged)
    parents = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return merged.join(parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", *sums,
        F.coalesce("ends", F.lit(_FIRST.hex())).alias("ends_sha256"))


def _end(node: bytes, state) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends"])
