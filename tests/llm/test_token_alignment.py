"""Token alignment against a plain one over whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path as vocabulary
from tokenizers import Tokenizer

from starloom.llm import token_alignment as ta
from starloom.llm.queries import op12_token_alignment

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, block long, pair long, pieces string, column int, best boolean"


def texts():
    rng = random.Random(3)
    words = ["alpha", "beta,", "Gamma.", "ñandú", "straße!", "日本語テキスト", "naïveté", "x\ty", "the", "of", "a\n\nb", "🙂", "…",
             "don't", "0x1234567890abcdef", "<|endoftext|>", "<0x41>", "é", " ", "\x1c", " ", "http://a.b/c?d=e"]
    out = [None, "", " ", "  ", "a", " a", "a ", "a  b", "\n", "a▁b", "a ▁ b", "▁", "x" * 3000, "ab" * 999,
           "a\x00b", "﻿z", " \n a \n\n  b\t c ", "one two", "one two", "ﬁ 　x", "<s> hello</s>"]
    out += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    out += ["".join(rng.choice([*words, " ", "  ", "\r\n"]) for _ in range(30)) for _ in range(40)]
    out.append(" ".join(rng.choice(words) for _ in range(20_000)))
    return out + ["".join(chr(rng.choice([*range(1, 0x250), *range(0x3040, 0x30FF), 0x1F600])) for _ in range(200)) for _ in range(10)]


def plain(pairs):
    pair, docs = ta._Pair(A, B), []
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    for i, text in pairs:
        text = text or ""
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        joined = [b"".join(map(t.__getitem__, x)) for t, x in zip((pair.a_bytes, pair.b_bytes), ids, strict=True)]
        if not text or any(j != (" " + text).encode() for j in joined):
            docs.append((i, None))
            continue
        groups, ends, shared = [([], [])], [], []
        for t, x in zip((pair.a_bytes, pair.b_bytes), ids, strict=True):
            ends.append(np.cumsum([len(t[k]) for k in x]).tolist())
        cuts = set(ends[0]) & set(ends[1])
        at = [0, 0]
        for cut in sorted(cuts):
            group = ([], [])
            for s in (0, 1):
                while at[s] < len(ids[s]) and ends[s][at[s]] <= cut:
                    group[s].append(ids[s][at[s]])
                    at[s] += 1
            groups.append(group)
        starts = [[0, *e[:-1]] for e in ends]
        k = 0
        for lo, hi in zip(starts[0], ends[0], strict=True):
            while ends[1][k] <= lo:
                k += 1
            j = k
            while j < len(ends[1]) and starts[1][j] < hi:
                shared.append(1)
                j += 1
        docs.append((i, (ids, groups[1:], Counter((x, y) for g in groups for x in g[0] for y in g[1]), len(shared))))
    count = Counter(p for _, d in docs if d for p in d[2])
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for i, d in docs:
        if d is None:
            out.append((i, 0, 0, 0, 0, 0, 0, "", 0))
            continue
        ids, groups, links, overlaps = d
        shown = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((i, len(ids[0]), len(ids[1]), len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if count[p] == best[p[0]]),
                    sum(n * count[p] for p, n in links.items()), hashlib.sha256(shown.encode()).hexdigest(), overlaps))
    return sorted(out, key=repr)


def test_products():
    rng = np.random.default_rng(0)
    left, right = rng.integers(0, 3, (30, 40)), rng.integers(0, 3, (40, 20))

    def csr(m):
        rows, columns = np.nonzero(m)
        return ta.Csr.of(rows, columns, m[rows, columns], *m.shape)

    for laid_out in (1, 50, 1 << 20):
        before, ta.LAID_OUT = ta.LAID_OUT, laid_out
        got = np.zeros((30, 20), int)
        for rows, columns, values in csr(left).products(csr(right)):
            got[rows, columns] += values
        ta.LAID_OUT = before
        assert np.array_equal(got, left @ right)
    assert np.array_equal(csr(left).times(np.arange(40)), left @ np.arange(40))
    back = csr(left).transposed().products(csr(np.eye(30, dtype=int)))
    assert sum(len(v) for _, _, v in back) == np.count_nonzero(left)


def test_pieces_are_whole_and_safe():
    pair = ta._Pair(A, B)
    assert pair.cuts
    for text in texts():
        assert not text or " ".join(pair.pieces(text)) == text


@pytest.mark.parametrize("block", [1, 24 << 20])
def test_query(spark, tmpdir_path, monkeypatch, block):
    monkeypatch.setattr(ta, "BLOCK_BYTES", block)
    monkeypatch.setattr(ta, "LIST", 100)
    pairs = [*enumerate(texts()), (17, "one two"), (None, "a null id"), (None, "a null id")]
    spark.createDataFrame([(i, t, 1, 2, "p", 3, True) for i, t in pairs], SCHEMA).repartition(3).write.parquet(
        f"{tmpdir_path}/documents.parquet")
    got = sorted((tuple(r) for r in op12_token_alignment(spark, tmpdir_path).collect()), key=repr)
    want = plain(pairs)
    assert [g for g, w in zip(got, want, strict=True) if g != w][:3] == [w for g, w in zip(got, want, strict=True) if g != w][:3]


def test_no_documents(spark):
    docs = spark.createDataFrame([(1, "x", 1, 2, "p", 3, True)], SCHEMA).where("false")
    assert ta.token_alignment(docs, A, B).count() == 0
