"""Every contract column of the queries against plain Python, on a small written folder."""

import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import tiktoken
import xxhash
from public_tokenizers import PATTERN
from public_tokenizers import path as vocabulary
from tokenizers import Tokenizer

import corpus_pipeline
from starloom.llm import bpe, packing, quality, queries, secrets, toxicity
from test_operators import _base_spans, _entropy_spans, _groups, _plain_print, _plain_spans, frame, prose

RUDE = ("grobian", "scummer", "vilest")


def corpus():
    rng = random.Random(21)
    shared, base = prose(60, rng), prose(120, rng)
    key = "".join(rng.choice(secrets.ALPHABET[:62]) for _ in range(64))
    out = [None, "", " \n\t", "one", base, base, base + " tail", shared + " x", "y " + shared, prose(20_000, rng),
           f'password = "hunter2hunter2" and AKIA{"Q" * 16} then {"0a" * 20}', f"token: {key} end", f"see {key}",
           "ON " * 90, "ñandú " * 40, "ab" * 400]
    for k in range(60):
        bad, rude = k % 2, k % 3 == 0
        text = prose(rng.randint(20, 60), rng)
        text = text.upper() if bad else text
        out.append(f"{text} {rng.choice(RUDE)} {prose(5, rng)}" if rude else text)
    rows, nobody = list(enumerate(out)), (None, "no id " + prose(20, rng))
    return [*rows, rows[4], nobody, nobody]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at, docs = str(tmp_path_factory.mktemp("corpus")), corpus()
    frame(spark, docs).repartition(3).write.parquet(f"{at}/documents.parquet")
    marks = [(i, k % 2 == 0, k % 3 == 0, "x", 1) for k, (i, _) in enumerate(docs[16:76])]
    spark.createDataFrame([(i, int(q), int(t), s, n) for i, q, t, s, n in marks] + [(None, 1, 1, "x", 1), (5, None, None, "x", 1)],
                          "doc_id long, quality int, toxic int, text string, _row int").write.parquet(f"{at}/labels.parquet")
    rng = np.random.default_rng(8)
    near = rng.normal(size=(30, 12))
    vectors = [[float(x) for x in c + rng.normal(size=12) * s] for c in near for s in (0, 0.02, 0.3)] + [None, [0.0] * 12]
    spark.createDataFrame([(i, v, "l", 2) for i, v in enumerate(vectors)],
                          "vec_id long, embedding array<double>, label string, unit int").write.parquet(f"{at}/embeddings.parquet")
    return at, docs, vectors


def found(spark, folder, name, *columns):
    df = queries.queries()[name](spark, folder)
    assert set(columns) <= set(df.columns)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def test_op1(spark, folder):
    at, docs, _ = folder
    ids = {}
    for i, t in docs:
        ids.setdefault(t or "", []).append(i)
    got = found(spark, at, "op1_exact_dedup", "doc_id", "keep_id", "group_size", "text_sha256")
    keep = {t: max((i for i in group if i is not None), default=None) for t, group in ids.items()}
    assert got == sorted(((i, keep[t or ""], len(ids[t or ""]), sha((t or "").encode())) for i, t in docs), key=repr)
    kept = found(spark, at, "op1_exact_dedup", "text_sha256", "kept")
    assert sum(k for _, k in kept) == len({s for s, _ in kept})


def test_op2(spark, folder):
    at, _, vectors = folder
    unit = np.array(vectors[:90]) / np.linalg.norm(vectors[:90], axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    group = _groups(90, np.argwhere(linked)) + [90, 91]
    links = [*(linked.sum(axis=1) - 1).tolist(), 0, 0]
    assert found(spark, at, "op2_embedding_dedup", "vec_id", "n_links", "component_id", "kept") == sorted(
        ((i, links[i], group[i], group[i] == i) for i in range(92)), key=repr)


def test_op3(spark, folder):
    at, docs, _ = folder
    other = tiktoken.Encoding("own", pat_str=PATTERN, special_tokens={},
                              mergeable_ranks=bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken")))
    want = []
    for i, t in docs:
        ids = other.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert found(spark, at, "op3_byte_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def plain_quality(text, model):
    """Score of a text, feature by feature."""
    mask, bits = (1 << 64) - 1, (len(model) - 1).bit_length() - 1
    words = pc.utf8_split_whitespace(pa.array([text or ""]))[0].as_py()  # with empty words at the ends
    lower = [xxhash.xxh64_intdigest(w.lower(), 1) for w in words]
    form = [xxhash.xxh64_intdigest(quality.shape(w), 2) for w in words]
    hashes = lower + form
    for k in range(len(words) - 1):
        for h in (lower, form):
            hashes.append(h[k] * 0x9E3779B97F4A7C15 + h[k + 1] & mask)
        hashes.append(0x51ED27 if words[k] == words[k + 1] else 0xA24BAED5)
    total = float(model[-1])
    for h in hashes:
        total += float(model[((h ^ h >> 29) * 0xBF58476D1CE4E5B9 & mask) >> 64 - bits]) * quality.SCALE / len(hashes)
    return 1 / (1 + np.exp(-total))


def test_op4(spark, folder):
    at, docs, _ = folder
    model = quality.quality_model(spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet"))
    assert np.count_nonzero(model) > 10
    got = found(spark, at, "op4_quality_classifier", "doc_id", "held_out", "score", "predicted")
    want = sorted(((i, zlib.crc32(str(i).encode() if i is not None else b"") % 4 == 2, plain_quality(t, model)) for i, t in docs), key=repr)
    for (i, held, score, predicted), (j, other, plain) in zip(got, want, strict=True):
        assert (i, held) == (j, other) and abs(score - plain) < 1e-6 and predicted == int(score >= 0.7)


def plain_toxicity(text, net):
    """Score of a text: every window read word by word, both ways."""
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = toxicity.words_of(text or "")
    if not words:
        return 0.0
    inputs = []
    for w in words:
        at = np.searchsorted(net.known, toxicity._hash(w))
        row = p["words"][at + 1] if at < len(net.known) and net.known[at] == toxicity._hash(w) else np.zeros(toxicity.EMBED)
        inputs.append(np.concatenate([row, p["chars"][toxicity._trigrams(w)].mean(axis=0)]))
    size, n = toxicity.HIDDEN, len(words)

    def read(part, d):
        h, out = np.zeros(size), []
        for x in part:
            g = x @ p["into"][d] + p["bias"][d]
            rz = 1 / (1 + np.exp(-(g[:2 * size] + h @ p["back"][d][:, :2 * size])))
            new = np.tanh(g[2 * size:] + rz[:size] * (h @ p["back"][d][:, 2 * size:]))
            h = new + rz[size:] * (h - new)
            out.append(h)
        return out

    starts = [0] if n <= toxicity.WINDOW else [*range(0, n - toxicity.WINDOW, toxicity.STRIDE), n - toxicity.WINDOW]
    best = 0.0
    for s in starts:
        part = inputs[s:s + toxicity.WINDOW]
        h = np.hstack([read(part, 0), read(part[::-1], 1)[::-1]])
        e = np.tanh(h @ p["look"] + p["look_bias"]) @ p["weigh"]
        a = np.exp(e - e.max())
        logit = (a / a.sum()) @ h @ p["out"] + p["out_bias"][0]
        best = max(best, 1 / (1 + np.exp(-logit)))
    return best


def test_op6(spark, folder):
    at, docs, _ = folder
    model = toxicity.toxicity_model(spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet"))
    got = found(spark, at, "op6_toxicity", "doc_id", "held_out", "score", "predicted")
    net = model if isinstance(model, toxicity.Network) else toxicity.Network.load(model)
    want = sorted(((i, zlib.crc32(str(i).encode() if i is not None else b"") % 3 == 1, plain_toxicity(t, net)) for i, t in docs), key=repr)
    for (i, held, score, predicted), (j, other, plain) in zip(got, want, strict=True):
        assert (i, held) == (j, other) and abs(score - plain) < 1e-3 and predicted == int(score >= 0.7)


def test_op5(spark, folder):
    at, docs, _ = folder
    texts = [(t or "").encode() for _, t in docs]
    want = []
    for (i, _), raw, spans in zip(docs, texts, _plain_spans(texts), strict=True):
        kept, last = b"", 0
        for a, b in spans:
            kept, last = kept + raw[last:a], b
        kept += raw[last:]
        want.append((i, len(raw), len(raw) - len(kept), len(spans), sha(kept)))
    assert found(spark, at, "op5_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(
        want, key=repr)


def test_op7(spark, folder):
    at, docs, _ = folder
    prints = [_plain_print(t) for _, t in docs]
    group = _groups(len(docs), [(a, b) for a in range(len(docs)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4])
    lowest = {}
    for (i, _), g in zip(docs, group, strict=True):
        if i is not None:
            lowest[g] = min(lowest.get(g, i), i)
    assert found(spark, at, "op7_simhash_dedup", "doc_id", "fingerprint", "component_id") == sorted(
        ((i, f"{p:016x}", lowest.get(g)) for (i, _), p, g in zip(docs, prints, group, strict=True)), key=repr)


def check_packed(rows, texts):
    """Pieces ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` of texts by id."""
    plain = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    plain.encode_special_tokens = True
    places = {}
    for _, _, length, _, _, sequence, offset in rows:
        places.setdefault(sequence, []).append((offset, length))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= 2048
    pieces = {}
    for doc, start, length, crc, total, _, _ in rows:
        pieces.setdefault(doc, []).append((start, length, crc, total))
    assert set(pieces) == set(texts)
    for doc, text in texts.items():
        ids, end = [*plain.encode(text or "", add_special_tokens=False).ids, 1], 0
        for start, length, crc, total in sorted(pieces[doc]):
            assert start == end and total == len(ids)
            end += length
            assert crc == zlib.crc32(struct.pack(f"<{length}I", *ids[start:end]))
        assert end == len(ids)


PIECE = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def test_op8(spark, folder, tmpdir_path):
    at, docs, _ = folder
    once = {i: t for i, t in docs if i is not None}
    frame(spark, once.items()).repartition(3).write.parquet(f"{tmpdir_path}/documents.parquet")
    check_packed(found(spark, tmpdir_path, "op8_packing", *PIECE), once)
    assert sum(r[2] for r in found(spark, at, "op8_packing", *PIECE)) > sum(
        r[2] for r in found(spark, tmpdir_path, "op8_packing", *PIECE))  # repeated rows are packed again


def test_op10(spark, folder):
    at, docs, _ = folder
    want = []
    for i, t in docs:
        base, more = sorted(_base_spans(t or "")), sorted(_entropy_spans(t or ""))

        def shown(spans):
            return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)

        want.append((i, *(sum(k == kind for *_, k in base) for kind in secrets.BASE_KINDS), sha(shown(base).encode()),
                     shown(sorted(base + more))))
    got = found(spark, at, "op10_secret_scan", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    assert got == sorted(want, key=repr) and any(r[1] for r in got) and any("entropy" in r[5] for r in got)


def masked(text):
    out, at = "", 0
    for a, _, b, _ in sorted(_base_spans(text) + _entropy_spans(text)):
        out, at = (out + text[at:a] + "[SECRET]", b) if a >= at else (out, max(at, b))
    return out + text[at:]


def test_pipeline(spark, folder):
    """All stages done again in plain Python, from the same model."""
    at, docs, _ = folder
    table = spark.read.parquet(f"{at}/documents.parquet")
    model = quality.quality_model(table, spark.read.parquet(f"{at}/labels.parquet"))
    kept = [(i, t) for i, t in docs if plain_quality(t, model) >= corpus_pipeline.QUALITY]
    assert 0 < len(kept) < len(docs)
    last = {}
    for i, t in kept:
        last[t or ""] = max([last.get(t or "", i), i], key=lambda x: (x is not None, x))
    kept = [(i, t) for t, i in last.items()]
    prints = [_plain_print(t) for _, t in kept]
    group = _groups(len(kept), [(a, b) for a in range(len(kept)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4])
    first = {}
    for (i, t), g in zip(kept, group, strict=True):
        if g not in first or (i is not None and (first[g][0] is None or i < first[g][0])):
            first[g] = (i, t)
    texts = {i: masked(t) for i, t in first.values()}
    out = corpus_pipeline.run(spark, at)
    check_packed([tuple(r) for r in out.select(*PIECE).collect()], texts)


def test_new_queries_are_tested_beside_their_operators():
    names = [re.match(r"op(\d+)_", n) for n in queries.queries()]
    assert sorted(int(m[1]) for m in names if m) == list(range(1, 14))


@pytest.mark.parametrize("name", ["quality classifier", "exact dedup", "SimHash near-dedup", "secret scans"])
def test_stages_carry_all_columns(spark, folder, name):
    at, _, _ = folder
    docs, stage = spark.read.parquet(f"{at}/documents.parquet"), dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, at)
    assert out.schema.simpleString() == docs.schema.simpleString()
    same = [c for c in docs.columns if name != "secret scans" or c not in ("text", "n_chars")]
    assert out.select(same).exceptAll(docs.select(same)).count() == 0 and out.count() > 0
    assert stage(spark, docs.where("false"), at).count() == 0
