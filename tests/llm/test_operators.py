"""Each operator against a plain version, and on nulls, empty and long texts, ties and empty tables."""

import base64
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pytest
import tiktoken
import xxhash
from public_tokenizers import PATTERN
from public_tokenizers import path as vocabulary
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm import bpe, exact_dedup, packing, quality, secrets, simhash, suffix_dedup, toxicity, url_filter
from starloom.llm import embedding_dedup as embedding_dedup_module
from starloom.llm.embedding_dedup import embedding_dedup

#: Columns whose names clash with those the operators use inside.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "fp long, sha string, _row int, key int, kept boolean, score double, name string")
RANDOM = random.Random(11)
WORDS = ["alpha", "beta,", "Gamma.", "delta", "ñandú", "straße", "eta", "theta!", "iota", "kappa", "x\ty"]


def prose(n, rng=RANDOM):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def frame(spark, pairs):
    rows = [(i, t, "en", "s", None if t is None else len(t), 1, "s", 2, 3, True, 0.5, "n") for i, t in pairs]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def pairs():
    shared, base = prose(60), prose(300)
    out = [(0, None), (1, ""), (2, "   \n"), (3, "one two"), (4, base), (5, base), (6, base + " tail"),
           (7, shared + prose(40)), (8, prose(30) + shared), (9, prose(20_000)), (10, "ab" * 400),
           (11, base), (11, base), (None, "lost"), (None, "lost"), (None, "found " + shared),
           (12, "é" * 150), (13, "ON " * 90), (14, prose(5)), (15, "ONE TWO")]
    return out + [(i, prose(RANDOM.randint(1, 400))) for i in range(20, 50)]


@pytest.fixture(scope="module")
def docs(spark, pairs):
    return frame(spark, pairs).repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return frame(spark, [(1, "x")]).where("false")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# -- exact dedup ---------------------------------------------------------------

def test_golomb_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 500):
        for shift in (0, 3, 60):
            top = 1 << (12 if shift == 0 else 63)
            values = np.unique(rng.integers(0, top, n).astype(np.uint64))
            if shift == 3:
                values = np.unique(values >> np.uint64(45))
            coded = exact_dedup.golomb_encode(values, shift)
            assert np.array_equal(exact_dedup.golomb_decode(len(values), shift, *coded), values)


def test_exact_dedup(docs, pairs, no_docs):
    want, left = [], {}
    for i, t in pairs:
        left.setdefault(t or "", []).append(i)
    for t, ids in left.items():
        known = [i for i in ids if i is not None]
        keep, taken = max(known, default=None), False
        for i in ids:
            kept = i == keep and not taken
            taken = taken or kept
            want.append((i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    got = rows(exact_dedup.exact_dedup(docs, owners=5), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == sorted(want, key=repr)
    assert exact_dedup.exact_dedup(no_docs).count() == 0


# -- SimHash -------------------------------------------------------------------

def _plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if ones[b] * 2 > len(shingles))


def _groups(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_simhash(docs, pairs, no_docs):
    prints = [_plain_print(t) for _, t in pairs]
    group = _groups(len(pairs), [(a, b) for a in range(len(pairs)) for b in range(a)
                                 if (prints[a] ^ prints[b]).bit_count() <= 4])
    lowest = {}
    for (i, _), g in zip(pairs, group, strict=True):
        if i is not None:
            lowest[g] = min(lowest.get(g, i), i)
    got = rows(simhash.simhash_dedup(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id"), "*")
    assert got == sorted(((i, f"{p:016x}", lowest.get(g)) for (i, _), p, g in zip(pairs, prints, group, strict=True)),
                         key=repr)
    assert simhash.simhash_dedup(no_docs).count() == 0


def test_links_between_random_and_crowded_prints(spark):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    prints = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for s in seeds for _ in range(25)}
    prints = sorted(prints)
    group = _groups(len(prints), [(a, b) for a in range(len(prints)) for b in range(a)
                                  if (prints[a] ^ prints[b]).bit_count() <= 4])
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.linked_prints(spark.createDataFrame([(s,) for s in signed], "fp long"), 4).collect()
    at = {s: i for i, s in enumerate(signed)}
    assert _groups(len(prints), [(at[r["a"]], at[r["b"]]) for r in links]) == group


# -- embeddings ----------------------------------------------------------------


def test_keys_take_more_bands_of_more_prints():
    assert [simhash.agreeing_bands(n, 4) for n in (0, 1000, 1 << 20, 1 << 27, 1 << 34)] == [2, 2, 2, 3, 4]
    for n in (1 << 30, 1 << 40):
        assert n / 2 ** (64 * simhash.agreeing_bands(n, 4) // (4 + simhash.agreeing_bands(n, 4))) < 32


@pytest.mark.parametrize("bands", [2, 3])
def test_a_crowd_of_near_prints_is_split_over_keys(spark, monkeypatch, bands):
    monkeypatch.setattr(simhash, "GROUP", 500)
    monkeypatch.setattr(simhash, "agreeing_bands", lambda rows, distance: bands)
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63)
    flips = np.array([np.bitwise_or.reduce(np.int64(1) << rng.choice(62, k, replace=False)) for k in rng.integers(0, 5, 6000)])
    near = np.unique(base ^ flips)
    far = rng.integers(0, 1 << 63, 3000)
    prints = spark.createDataFrame([(int(x),) for x in np.unique(np.concatenate([near, far]))], "fp long")
    sizes = [r["count"] for r in simhash.routed(prints, 4).groupBy("key").count().collect()]
    assert max(sizes) <= 2.6 * 500
    links = simhash.linked_prints(prints, 4).collect()
    number = {int(x): i for i, x in enumerate(near)}
    group = _groups(len(near), [(number[r["a"]], number[r["b"]]) for r in links if r["a"] in number and r["b"] in number])
    apart = np.bitwise_count(near[:, None] ^ near[None, :]) <= 4
    todo, seen = [0], {0}
    while todo:  # all that the first reaches by links of 4 bits
        for j in np.flatnonzero(apart[todo.pop()]).tolist():
            if j not in seen:
                seen.add(j)
                todo.append(j)
    assert {i for i, g in enumerate(group) if g == group[0]} == seen and len(seen) > 3000


def test_embedding_dedup(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 16))
    vectors = [c + rng.normal(size=16) * s for c in centres for s in (0.0, 0.05, 0.1, 0.25)]
    vectors += [centres[0] + rng.normal(size=16) * 0.03 for _ in range(150)] + [centres[1]] * 3
    table = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    odd = [(900, None), (901, [0.0] * 16), (902, [1.0] * 15 + [None]), (903, [float("nan")] * 16),
           (904, [float("inf")] * 16), (905, table[0][1][:8]), (None, [1.0] * 16), (906, [])]
    df = spark.createDataFrame(table + odd, "vec_id long, embedding array<double>").withColumn("cls", F.lit(1))
    got = {r["vec_id"]: r for r in embedding_dedup(df).collect()}
    unit = np.array(vectors) / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    n = linked.sum(axis=1) - 1
    mine = np.array([got[i]["n_links"] for i in range(len(vectors))])
    assert (mine <= n).all() and mine.sum() >= 0.9 * n.sum()
    group = _groups(len(vectors), np.argwhere(linked))
    same = np.mean([got[i]["component_id"] == g for i, g in enumerate(group)])
    assert same >= 0.9
    for i in (900, 901, 902, 903, 904, 905, 906):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert len(got) == len(vectors) + len(odd)
    assert embedding_dedup(df.where("false")).count() == 0
    assert embedding_dedup(df.where("vec_id = 900")).count() == 1


def _spread(n, dim, common, rng):
    """``n`` unit vectors with mean cosine ``common``, and turned copies of the first ones at cosines of 0.95 to 0.97."""
    x, axis = rng.normal(size=(n, dim)), rng.normal(size=dim)
    x = np.sqrt(1 - common) * x / np.linalg.norm(x, axis=1, keepdims=True) + np.sqrt(common) * axis / np.linalg.norm(axis)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x[:n // 10]
    turn = rng.normal(size=near.shape)
    turn -= (turn * near).sum(axis=1, keepdims=True) * near
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    cosine = rng.uniform(0.95, 0.97, (len(near), 1))
    return np.vstack([x, cosine * near + np.sqrt(1 - cosine ** 2) * turn])


def _vectors(spark, x):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")


@pytest.mark.parametrize("common", [0.0, 0.7])
def test_embeddings_with_a_common_direction_are_told_apart(spark, monkeypatch, common):
    rng, verified, plain = np.random.default_rng(4), [], embedding_dedup_module._with_cosine

    def counted(pairs, *names):
        found = embedding_dedup_module.settled(pairs)
        if names == ("unit", "other"):
            verified.append(found.count())
        return plain(found, *names)

    monkeypatch.setattr(embedding_dedup_module, "_with_cosine", counted)
    sizes = (800, 3200)
    for n in sizes:
        x = _spread(n, 48, common, rng)
        linked = np.triu(x @ x.T >= 0.95, 1)
        got = embedding_dedup(_vectors(spark, x)).agg(F.sum("n_links")).first()[0] / 2
        assert 0.95 * linked.sum() <= got <= linked.sum() and linked.sum() >= n // 10
    assert verified[1] <= 0.03 * (1.1 * sizes[1]) ** 2 / 2  # of all pairs
    assert all(pairs <= 30 * 1.1 * n for pairs, n in zip(verified, sizes, strict=True))  # a few for each vector


def test_long_lists_are_dealt_by_blocks_and_one_list_is_exact(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup_module, "LIST", 40)
    x = _spread(300, 8, 0.0, np.random.default_rng(6))
    linked = x @ x.T >= 0.95
    exact = embedding_dedup(_vectors(spark, x), pivots=1, how=embedding_dedup_module.Description(1, 1, 1)).collect()
    assert {r["vec_id"]: r["n_links"] for r in exact} == dict(enumerate((linked.sum(axis=1) - 1).tolist()))


# -- tokens --------------------------------------------------------------------

RANKS = vocabulary("byte_bpe_50k.tiktoken")


def test_bpe_equals_tiktoken_and_decodes(docs, pairs, no_docs):
    ranks = bpe.MergeReplay.of(RANKS, PATTERN).ranks
    other = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS)
    got = sorted(((r["doc_id"], list(r["ids"]), bytes(r["decoded"])) for r in coded.collect()), key=repr)
    assert got == sorted(((i, other.encode_ordinary(t or ""), (t or "").encode()) for i, t in pairs), key=repr)
    both = bpe.encode(docs, RANKS, PATTERN, decoded=True)
    assert sorted(((r["doc_id"], list(r["ids"]), bytes(r["decoded"])) for r in both.collect()), key=repr) == got
    assert bpe.encode(no_docs, RANKS, PATTERN, decoded=True).count() == 0


def encoded(coder, texts):
    ids, ends = coder(texts)
    return [part.tolist() for part in np.split(ids, ends[1:-1])]


@pytest.mark.parametrize("band", [1, 40, 50_000])
def test_bpe_on_awkward_strings(monkeypatch, band):
    monkeypatch.setattr(bpe, "BAND", band)
    coder = bpe.MergeReplay(RANKS, PATTERN)
    other = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    rng = random.Random(2)
    letters = "aaaab \n\tAé☃́\x1c\x85 01234..!'stre퟿𝔸<|endoftext|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["".join(map(chr, rng.choices(range(1, 0x2FF), k=50))) for _ in range(300)]
    texts += [c * n for c in "a=- 0é\n" for n in (1, 2, 3, 5, 64, 1000)] + ["abc" * 300, "\x00" * 70, " a  b " * 50]
    texts += ["".join(rng.choice("etaoinshrdlu") for _ in range(n)) for n in (300, 3000)]
    assert encoded(coder, texts) == [other.encode_ordinary(t) for t in texts]


def test_bpe_takes_the_lower_rank_that_a_merge_brings_up(tmp_path):
    # merging b+c (rank 260) before a second b+c brings up a+bc (rank 257): it must go first
    tokens = [bytes([b]) for b in range(256)] + [b"zz", b"abc", b"cab", b"zzz", b"bc", b"bcabc", b"bcbc"]
    path = tmp_path / "v.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for r, t in enumerate(tokens)))
    coder = bpe.MergeReplay(str(path), PATTERN)
    assert coder.turns_back.any()
    other = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcz") for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    assert encoded(coder, texts) == [other.encode_ordinary(t) for t in texts]


def test_bpe_forgets_pieces_without_harm(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 20)
    coder = bpe.MergeReplay(RANKS, PATTERN)
    other = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    for k in range(12):
        texts = [f"{prose(30)} word{k} é{k}", "", prose(5)]
        assert encoded(coder, texts) == [other.encode_ordinary(t) for t in texts]
        assert len(coder.slots) <= 20 + 40


def test_packing(docs, pairs, no_docs):
    path = vocabulary("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    want = sorted(tuple(plain.encode(t or "", add_special_tokens=False).ids) + (1,) for _, t in pairs)
    pieces = packing.pack(docs.repartition(2), path).withColumn("crc", packing.ids_crc32(F.col("ids"))).collect()
    sequences, found = {}, {}
    for p in pieces:
        ids = struct.unpack(f"<{p['length']}I", p["ids"])
        assert zlib.crc32(p["ids"]) == p["crc"]
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        found.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], ids))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and (2048 - at <= 32 or at & (at - 1) == 0)
    ids = {}
    for (doc, n), parts in found.items():
        ids.setdefault((doc, n), sum(len(x) for _, x in parts))
        assert ids[doc, n] % n == 0  # repeated rows give all their pieces again
    assert sum(ids.values()) == sum(map(len, want))
    single = {k: sum((x for _, x in sorted(v)), ()) for k, v in found.items() if ids[k] == k[1]}
    assert set(single.values()) <= set(want)
    assert packing.pack(no_docs, path).count() == 0


def test_tokenizer_words_equal_whole_texts():
    import pyarrow as pa

    path = vocabulary("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    rng = random.Random(4)
    letters = "abAB  \n\x85 ,.'sJ̌İé́ΣςK<|endoftext|>1!ß"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    ids, ends = packing.WordTokenizer.of(path)(pa.array(texts, pa.string()).slice(1))
    parts = np.split(ids, ends[:-1])
    assert [p.tolist() for p in parts] == [plain.encode(t, add_special_tokens=False).ids for t in texts[1:]]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_packing_takes_any_tokenizer(spark, docs, pairs, name):
    path = vocabulary(name)
    own = packing.WordTokenizer.of(path)
    assert own.folded == own.by_words == (name == "word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    cased = [(i, t) for i, t in pairs if i is not None and i not in (2, 11)] + [(900, "ABC, Abc. abc!  \n X."), (901, "A.\u0301")]
    found = {}
    for p in packing.pack(frame(spark, cased), path, end_id=1).collect():
        found.setdefault(p["doc_id"], []).append((p["start"], struct.unpack(f"<{p['length']}I", p["ids"])))
    for i, t in cased:
        assert sum((x for _, x in sorted(found[i])), ()) == (*plain.encode(t or "", add_special_tokens=False).ids, 1)


def test_fill_is_the_best_subset():
    rng = random.Random(6)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(1, 5))}
        sums = {0}
        items = [n for n, c in counts.items() for _ in range(c)]
        items.remove(max(items))
        for n in items:
            sums |= {s + n for s in sums if s + n + max(counts) <= 60}
        chosen = packing.fill(counts, 60)
        assert all(k <= counts[n] for n, k in chosen.items()) and chosen[max(counts)] >= 1
        assert sum(n * k for n, k in chosen.items()) == max(sums) + max(counts)


# -- repeated strings ------------------------------------------------------------

def test_suffix_array():
    rng = random.Random(3)
    for _ in range(200):
        data = bytes(rng.choice(b"abc\xff") for _ in range(rng.randint(0, 80)))
        got = suffix_dedup.suffix_array(np.frombuffer(data, np.uint8), 100).tolist()
        assert got == sorted(range(len(data)), key=lambda i: data[i:])


@pytest.mark.parametrize("crowded", [4096, 1])
def test_repeated_strings(docs, pairs, no_docs, monkeypatch, crowded):
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    raw = [(i, (t or "").encode()) for i, t in pairs]
    seen = {}
    for _, x in raw:
        for j in range(len(x) - 199):
            seen[x[j:j + 200]] = seen.get(x[j:j + 200], 0) + 1
    want = []
    for i, x in raw:
        gone = np.zeros(len(x), bool)
        for j in range(len(x) - 199):
            if seen[x[j:j + 200]] > 1:
                gone[j:j + 200] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
        kept = np.frombuffer(x, np.uint8)[~gone].tobytes()
        want.append((i, len(x), int(gone.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest()))
    got = rows(suffix_dedup.repeated_strings(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(want, key=repr)
    if crowded > 1:
        assert suffix_dedup.repeated_strings(no_docs).count() == 0


def _plain_spans(texts, width=200):
    seen = {}
    for t in texts:
        for j in range(len(t) - width + 1):
            seen[t[j:j + width]] = seen.get(t[j:j + width], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 2, np.int8)
        for j in range(len(t) - width + 1):
            if seen[t[j:j + width]] > 1:
                gone[j + 1:j + width + 1] = 1
        out.append([tuple(x) for x in np.flatnonzero(np.diff(gone)).reshape(-1, 2).tolist()])
    return out


def test_a_hot_passage_leaves_no_crowded_name(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWDED", 20)
    most, plain = spark.sparkContext.accumulator(0), suffix_dedup._sort

    def counted(width):
        def run(batches):
            names = {}

            def seen():
                for batch in batches:
                    for name in batch.column(0).to_pylist():
                        names[name] = names.get(name, 0) + 1
                    yield batch
            yield from plain(width)(seen())
            most.add(sum(n > 20 for n in names.values()))
        return run

    monkeypatch.setattr(suffix_dedup, "_sort", counted)
    rng = random.Random(21)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(230))
    texts = [f"{rng.getrandbits(600):x} {passage} {rng.getrandbits(600):x}" for _ in range(300)]
    got = {r["doc_id"]: [tuple(x) for x in r["spans"]]
           for r in suffix_dedup.repeated_strings(frame(spark, enumerate(texts))).collect()}
    assert [got[i] for i in range(len(texts))] == _plain_spans(texts)
    assert most.value == 0


@pytest.mark.parametrize("crowded", [4096, 1])
def test_periodic_stretches(spark, monkeypatch, crowded):
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    rng = random.Random(31)

    def noise(n):
        return "".join(rng.choice("bcdefghijk ") for _ in range(n))

    texts = ["-" * 540_000, noise(90) + "-" * 200 + noise(90)]  # one window that the first has often
    for period in (1, 2, 3, 7, 31, 50, 120, 168, 169, 190, 210):
        word = noise(period)
        for n in (199, 200, 200 + period // 2, 200 + period, 201 + period, 200 + 2 * period, 900):
            texts.append(noise(rng.randint(0, 250)) + (word * 900)[:n] + noise(rng.randint(0, 250)))
        texts.append((word[1:] + word[:1]) * (1 + 700 // period))
    texts += [("-" * 60 + noise(20)) * 8 for _ in range(4)] + ["-" * 230 + "=" * 230 + "-" * 230]
    rng.shuffle(texts)
    got = {r["doc_id"]: [tuple(x) for x in r["spans"]]
           for r in suffix_dedup.repeated_strings(frame(spark, enumerate(texts))).collect()}
    assert [got[i] for i in range(len(texts))] == _plain_spans(texts)


def test_a_periodic_stretch_costs_its_own_size():
    rng = random.Random(33)
    for word in ("-", "AB", "col | ", "".join(rng.choice("abcd") for _ in range(100))):
        raw = (word * (1 << 20))[:1 << 20].encode()
        runs = suffix_dedup.Winnower(200).runs([raw])
        sent = sum(last + 200 - first for place, first, last in zip(*runs[2:], strict=True) if place >= 0)
        assert sent <= 4 * len(raw) and len(runs[0]) < len(raw) // 50
    lines = "".join("-" * 80 + "".join(rng.choice("abcd ") for _ in range(80)) for _ in range(4000)).encode()
    runs = suffix_dedup.Winnower(200).runs([lines])
    assert sum(last + 200 - first for place, first, last in zip(*runs[2:], strict=True) if place >= 0) <= 6 * len(lines)


def test_repeats_close_together(spark):
    # periodic stretches of little over a width: all their windows are neighbours under one name
    rng = random.Random(5)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    texts = []
    for k in range(40):
        a, b, c = letters(40 + k % 30), letters(20 + k), letters(30)
        stretch = (a + b) * 4 if k % 2 else (a + b + a + c) * 3
        texts.append(letters(100) + stretch[:200 + len(a + b) + len(a + c) * (1 - k % 2) + k] + letters(100))
    want = [_plain_spans([t.encode()])[0] for t in texts]
    assert any(want)
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]]
           for r in suffix_dedup.repeated_strings(frame(spark, enumerate(texts))).collect()}
    assert [got[i] for i in range(len(texts))] == [[tuple(s) for s in spans] for spans in want]



# -- classifiers -----------------------------------------------------------------

def _labelled(spark, bad, good, column):
    rng = random.Random(9)
    texts = [(i, bad(rng) if i % 2 else good(rng)) for i in range(400)]
    labels = spark.createDataFrame(
        [(i, i % 2 if column == "toxic" else 1 - i % 2) for i, _ in texts] + [(0, None), (None, 1)],
        f"doc_id long, {column} int")
    return frame(spark, texts), labels


def test_quality_learns_and_scores_everything(spark, docs, pairs, no_docs):
    train, labels = _labelled(spark, lambda r: prose(40, r).upper(), lambda r: prose(40, r), "quality")
    model = quality.quality_model(train, labels)
    scored = {r["id"]: r["_score"] for r in quality.score(train, model).select(
        F.col("_row.doc_id").alias("id"), "_score").collect()}
    held = [i for i in scored if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(scored[i] >= 0.7) == (i % 2 == 0) for i in held]) > 0.95
    out = quality.score(docs, model)
    assert out.count() == len(pairs) and out.where("_score between 0 and 1").count() == len(pairs)
    assert out.select("_row.*").columns == docs.columns
    assert quality.score(no_docs, model).count() == 0
    nothing = quality.quality_model(no_docs, labels.where("false"))
    assert {r["_score"] for r in quality.score(docs, nothing).collect()} == {0.5}


def test_toxicity_learns_and_scores_everything(spark, docs, pairs, no_docs):
    rude = ["grobian", "scummer", "vilest"]
    train, labels = _labelled(spark, lambda r: f"{prose(r.randint(0, 60), r)} {r.choice(rude)} {prose(9, r)}",
                              lambda r: prose(r.randint(1, 70), r), "toxic")
    model = toxicity.toxicity_model(train, labels, toxic_rows=100, clean_rows=100)
    scored = {r["id"]: r["_score"] for r in toxicity.toxicity(train, model).select(
        F.col("_row.doc_id").alias("id"), "_score").collect()}
    held = [i for i in scored if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(scored[i] >= 0.7) == (i % 2 == 1) for i in held]) > 0.9
    out = toxicity.toxicity(docs, model)
    assert out.count() == len(pairs) and out.where("_score between 0 and 1").count() == len(pairs)
    assert {r["_score"] for r in out.where("coalesce(trim(_row.text), '') in ('', '\\n')").collect()} == {0.0}
    assert toxicity.toxicity(no_docs, model).count() == 0
    assert toxicity.toxicity(docs, toxicity.toxicity_model(no_docs, labels.where("false"))).count() == len(pairs)


def test_windows_cover_every_word():
    counts = np.array([0, 1, 23, 24, 25, 36, 37, 100])
    owner, start = toxicity.windows(counts)
    for i, n in enumerate(counts):
        seen = set()
        for s in start[owner == i]:
            assert 0 <= s <= max(0, n - toxicity.WINDOW)
            seen |= set(range(s, min(n, s + toxicity.WINDOW)))
        assert seen == set(range(n))


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(0)
    words = ["a", "bc", "def", "ghij"]
    net = toxicity.Network(np.array(sorted(toxicity._hash(w) for w in words[:3]), np.int64))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    table = toxicity.WordTable(net, words)
    grid = rng.integers(0, 4, (3, toxicity.WINDOW))
    mask = np.arange(toxicity.WINDOW) < np.array([[24], [5], [1]])
    label = np.array([1.0, 0.0, 1.0])

    def loss():
        per_word = net.gates(net.inputs(*table.part(np.arange(4))))
        logit = net.forward(lambda t, d: per_word[grid[:, t], d], mask)
        return np.mean(np.logaddexp(0, logit) - label * logit)

    grads = net.gradients(grid, mask, label, table)
    for k, p in net.p.items():
        spots = rng.integers(0, p.size, 4) if k not in ("words", "chars") else np.flatnonzero(grads[k])[:4]
        for i in spots:
            if k == "words" and i < toxicity.EMBED:
                continue
            flat = p.reshape(-1)
            old = flat[i]
            flat[i] = old + 1e-4
            up = loss()
            flat[i] = old - 1e-4
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-4 - grads[k].reshape(-1)[i]) < 1e-4, k


# -- URLs ------------------------------------------------------------------------

SITES = [url_filter.SiteRule("block", "net", "/"), url_filter.SiteRule("allow", "example.net", "/en/"),
         url_filter.SiteRule("block", "example.com", "/de/"), url_filter.SiteRule("allow", "org", "/fr/")]
GLOBS = [url_filter.GlobRule("block", "*spam*", "*"), url_filter.GlobRule("block", "*", "*.ex?"),
         url_filter.GlobRule("allow", "good.*", "*")]


def _judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), raw)
        path = re.match(r"[^?#]*", rest[len(raw):])[0]
    fits = [r for r in SITES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.name))
        return host, path, best.name, best.action

    def glob(g, s):
        return re.fullmatch("".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in g), s, re.S)

    hits = [g for g in GLOBS if glob(g.host, host) and glob(g.path, path)]
    return host, path, None, max(hits, key=lambda g: len(g.host + g.path)).action if hits else "allow"


def test_url_rules(spark):
    rng = random.Random(8)
    parts = ["net", "example.net", ".", "www.", "org", "com", "example.com", "/", "/en/", "/de/", "/fr/", "?", "#",
             "spam", "://", "A", ".exe", "good.", "x" * 70]
    urls = [None, "", "nothing", "http://", "HTTP://WWW.Example.NET/en/x?y#z", "http://a.com/x.net/y"]
    urls += ["http://" + "".join(rng.choice(parts) for _ in range(rng.randint(0, 7))) for _ in range(600)]
    urls += ["http://example.net/en/" + "y" * 20_000]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit(1))
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge_urls(df, SITES, GLOBS).collect()}
    assert [got[i] for i in range(len(urls))] == [_judge(u) for u in urls]
    assert url_filter.judge_urls(df.where("false"), SITES, GLOBS).count() == 0
    assert {r["verdict"] for r in url_filter.judge_urls(df, [], [], "block").collect()} == {"block"}


# -- secrets ---------------------------------------------------------------------

def _entropy_spans(text):
    out = []
    for m in re.finditer("[A-Za-z0-9+/_=]{20,}", text):
        if re.search("^[0-9]+$", m[0]):
            continue
        bits = next(b for _, p, b in secrets.CLASSES if not p or re.search(p, m[0]))
        edges = [0, *(x for k in re.finditer(secrets.ALLOW_PART, m[0]) for x in k.span()), len(m[0])]
        for a, b in zip(edges[::2], edges[1::2], strict=True):
            runs = []
            for i in range(a, b - secrets.WINDOW + 1):
                part = m[0][i:i + secrets.WINDOW]
                p = np.array([part.count(x) for x in set(part)]) / secrets.WINDOW
                if -(p * np.log2(p)).sum() >= bits - 1e-12:
                    if runs and runs[-1][1] >= m.start() + i:
                        runs[-1][1] = m.start() + i + secrets.WINDOW
                    else:
                        runs.append([m.start() + i, m.start() + i + secrets.WINDOW])
            out += [(x, 3, y, "entropy") for x, y in runs]
    return out


def _base_spans(text):
    out = []
    assign = r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return out


@pytest.fixture(scope="module")
def leaks():
    rng = random.Random(1)
    hexes, mixed = "0123456789abcdef", "ABCDEFGHIJabcdefghij0123456789+/"
    bits = ["password=", "Token: ", "api_key='", "APIKEY = \"", "AKIA", "é☃", "secret: secret: ", " ", "\n",
            "0123456789abcdef0123456789abcdef", "aaaaaaaaaaaaaaaaaaaaaaaa", "thisisaverylongplainwordindeed"]
    texts = [None, "", "token: secret: abcdefghijk", "𝔸 password=hunter2hunter2"]
    for _ in range(150):
        s = ""
        for _ in range(rng.randint(1, 9)):
            s += rng.choice([rng.choice(bits), "".join(rng.choice(hexes) for _ in range(rng.randint(1, 60))),
                             "".join(rng.choice(mixed) for _ in range(rng.randint(1, 60)))])
        texts.append(s)
    return texts + ["x " * 50_000 + "password=" + "9f" * 30]


def test_secret_spans(spark, leaks, no_docs):
    df = frame(spark, enumerate(leaks))
    got = {r["_row"]["doc_id"]: (r["_base"], r["_added"]) for r in secrets.secret_spans(df).collect()}
    for i, t in enumerate(leaks):
        base, added = ([tuple(s) for s in part] for part in got[i])
        assert base == sorted(_base_spans(t or "")), t
        assert added == sorted(_entropy_spans(t or "")), t
    assert secrets.secret_spans(no_docs).count() == 0


def test_redaction(spark, leaks, no_docs):
    df = frame(spark, enumerate(leaks))
    out = {r["doc_id"]: r for r in secrets.redact(df).collect()}
    assert secrets.redact(df).columns == df.columns and secrets.redact(no_docs).count() == 0
    for i, t in enumerate(leaks):
        want, at = "", 0
        for s, _, e, _ in sorted(_base_spans(t or "") + _entropy_spans(t or "")):
            if s >= at:
                want += t[at:s] + "[SECRET]"
            at = max(at, e)
        want = None if t is None else want + t[at:]
        assert out[i]["text"] == want
        assert out[i]["n_chars"] == (None if t is None else len(want))


def test_secrets_beside_allowed_strings(spark, leaks):
    rng = random.Random(41)
    key = "".join(rng.choice(secrets.ALPHABET[:62]) for _ in range(400))
    texts = ["see b3BlbnNzaC1rZXktdjEAAAAABG5vbmUAAAAEbm9uZQAAAAAAAAABAAAB" + key, "/sample/" + key[:40], key[:30] + "dummy",
             "sample_dummy_example", "123456789" * 4, key + "A" * 9 + key + "qwerty" + key[:19]] + [t or "" for t in leaks]
    df = frame(spark, enumerate(texts))
    got = {r["_row"]["doc_id"]: [tuple(s) for s in r["_added"]] for r in secrets.secret_spans(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == sorted(_entropy_spans(t)), t
    assert all(got[i] for i in (0, 1, 2, 5)) and not got[3] and not got[4]
    assert "Python" not in secrets.redact(df)._jdf.queryExecution().executedPlan().toString()
    from corpus_pipeline import secret_stage
    masked = {r["doc_id"]: r["text"] for r in secret_stage(spark, df, "").collect()}
    assert key[:40] not in masked[1] and key[200:240] not in masked[0]


def test_secret_scan_is_native(docs):
    plan = secrets.redact(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
