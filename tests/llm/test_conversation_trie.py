"""The prefix trie against a plain one, in one task and over many borders."""

import hashlib
import random
import re
import zlib

import pytest

from starloom.llm.conversation_trie import prefix_trie, spliced, turn_sequences
from starloom.llm.queries import op13_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, keys string, words int, part int, node string, turns int"


def talk():
    rng, rows = random.Random(5), []
    said = ["", "yes", "yes yes\tno", "a b  c\n", "x" * 50, None]
    for c in [*range(0, 70), 100, 119, 140, 10**12 + 3]:
        for k in range(rng.choice([0, 1, 1, 2, 3, 5]) if c % 7 else 6):
            rows.append((c, k, rng.choice(["user", "bot", None]), rng.choice(said[:3] if k < 3 else said)))
    for c in range(200, 240):  # copies
        rows += [(c, k, "user", f"turn {k} of the copied one") for k in range(4)]
    rows += [(200, 9, "user", "goes on"), (211, 9, "user", "goes on")]
    rows += [(300, None, "user", "null turn first"), (300, 1, "user", "b"), (300, 1, "bot", "a"), (300, 1, "bot", "a")]
    rows += [(None, 0, "user", "lost"), (301, 0, "user", "word " * 20_000)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, "n", 3) for r in rows], SCHEMA)


def plain(rows, splice=True):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append((turn is not None, turn or 0, key, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    whole = own
    if splice:
        whole = {}
        for c, ts in own.items():
            h = zlib.crc32(str(c).encode()) % 4
            whole[c] = own.get(c - c % 20, [])[:h] + ts[h:]
    members = {}
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    below = {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves, saved = (0 if p in kids else 1), (len(members[p]) - 1) * words
        for k in kids.get(p, []):
            leaves, saved = leaves + below[k][0], saved + below[k][1]
        below[p] = leaves, saved
    out = []
    for p, ids in members.items():
        ends = sorted(c for c in ids if len(whole[c]) == len(p))
        out.append((min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), len(kids.get(p, [])), *below[p],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def got(df):
    assert tuple(df.columns) == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("tasks", [1, 40])
def test_prefix_trie(spark, tasks):
    rows, before = talk(), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        turns = turn_sequences(frame(spark, rows))
        assert got(prefix_trie(spliced(turns, every=20, heads=4))) == plain(rows)
        if tasks > 1:
            assert got(prefix_trie(turns)) == plain(rows, splice=False)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_no_conversations_and_turnless_ones(spark):
    empty = frame(spark, talk()).where("false")
    assert prefix_trie(turn_sequences(empty)).count() == 0
    # 21 begins with 20's turns, and 20 isn't there: h = 1 takes away its only turn
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4)
    rows = [(c, 0, "user", "only")]
    assert got(prefix_trie(spliced(turn_sequences(frame(spark, rows)), 20, 4))) == plain(rows)


def test_query(spark, tmpdir_path):
    rows = talk()
    frame(spark, rows).write.parquet(f"{tmpdir_path}/conversations.parquet")
    assert got(op13_prefix_trie(spark, tmpdir_path)) == plain(rows)
