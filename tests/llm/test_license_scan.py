"""The license scan against plain loops over words."""

import math
import random
import re

import pytest

from starloom.llm import license_scan as ls
from starloom.llm.queries import op11_license_scan

SCHEMA = "doc_id long, text string, n_words long, places int, word string, n int, label boolean, start string"


def notice(label):
    return next(n.text for n in ls.NOTICES if n.label == label)


def damaged(text, rng, every):
    out = []
    for k, word in enumerate(text.split()):
        if k % every != every - 1:
            out.append(word)
        elif rng.random() < 0.5:
            out += [word, "inserted"]
    return " ".join(out)


def texts():
    rng = random.Random(9)
    words = "the of and to in is software License MIT license, ñandú 日本 a-b Apache General Public 3.0 copy free".split()

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    out = [None, "", " \n", "MIT", "Released under the MIT License.", "mit\nlicense mit LICENSE", "Mit Licenses", "mit licénse",
           "GNU GENERAL-PUBLIC/LICENSE apache license", "x" * 5000, "Licensed under CC BY-NC 4.0.", "apachelicense",
           "Released under the MIT License.", prose(20_000) + " " + notice("isc") + prose(50)]
    for n in ls.NOTICES:
        body = n.text.replace("\n", "\n * ")
        out += [body, prose(40) + "\n/* " + body.upper() + " */ " + prose(40), body + " " + prose(30) + " " + body,
                damaged(n.text, rng, 11), damaged(n.text, rng, 3), prose(20) + " ".join(reversed(n.text.split()))]
    return out + [prose(rng.randint(1, 200)) for _ in range(30)]


def plain(pairs):
    def cut(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    def at(words, phrase):
        return [i for i in range(len(words) - len(phrase) + 1) if words[i:i + len(phrase)] == phrase]

    names = [(n.label, cut(n.phrase)) for n in ls.NAMES]
    notices = [(n.label, cut(n.text), [cut(p) for p in n.phrases]) for n in ls.NOTICES]
    files = [cut(t) for _, t in pairs]
    sets = list(map(set, files))
    known = {w for _, ws in names for w in ws} | {w for _, ws, ps in notices for w in [*ws, *sum(ps, [])]}
    idf = {w: math.log((1 + len(files)) / (1 + sum(w in s for s in sets))) for w in known}
    out = []
    for (i, _), words in zip(pairs, files, strict=True):
        base = sorted((k, label) for label, phrase in names for k in at(words, phrase))
        found, score = {label for _, label in base}, 1.0 if base else 0.0
        for label, template, phrases in notices:
            here = sorted((w for w in set(template) if w in words), key=lambda w: (-idf[w], template.index(w)))[:ls.RARE]
            spots = {w: {p - q for p, x in enumerate(words) if x == w for q, y in enumerate(template) if y == w} for w in here}
            for s in set().union(*spots.values()) if spots else ():
                if sum(any(abs(x - s) <= ls.SLACK for x in spots[w]) for w in here) < min(ls.AGREE, len(set(template))):
                    continue
                lo, hi = s - ls.SLACK, s + len(template) + ls.SLACK
                if all(any(lo <= k <= hi for k in at(words, p)) for p in phrases):
                    found.add(label)
                    there = set(words[max(lo, 0):hi + 1])
                    total = sum(idf[w] for w in set(template))
                    score = max(score, min(1.0, sum(idf[w] for w in set(template) & there) / total))
        out.append((i, len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None,
                    ",".join(sorted({label for _, label in base})), ",".join(sorted(found)), round(score, 9)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("cut", [7, 4 << 20])
def test_query(spark, tmpdir_path, monkeypatch, cut):
    monkeypatch.setattr(ls, "SLICE_BYTES", cut)
    pairs = [*enumerate(texts()), (4, "Released under the MIT License."), (None, "apache license"), (None, "apache license")]
    frame = spark.createDataFrame([(i, t, 1, 2, "w", 3, True, "s") for i, t in pairs], SCHEMA)
    frame.repartition(3).write.parquet(f"{tmpdir_path}/documents.parquet")
    df = op11_license_scan(spark, tmpdir_path)
    assert df.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = sorted(((*r[:7], round(r[7], 9)) for r in df.collect()), key=repr)
    assert got == plain(pairs)


def test_whole_and_damaged_notices_are_found(spark):
    rng = random.Random(2)
    rows, want = [], []
    for n in ls.NOTICES:
        rows += [(len(rows), "intro words " + n.text), (len(rows) + 1, damaged(n.text, rng, 30))]
        want += [n.label, n.label]
    rows += [(1000 + k, f"clean text {k} of the permission to copy software") for k in range(50)]
    found = {r["doc_id"]: r for r in ls.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, label in enumerate(want):
        assert [p for p in found[i]["places"] if p["notice"] and p["label"] == label and p["score"] > 0.6], rows[i]
    assert not any(found[1000 + k]["places"] for k in range(50))
    assert [p["start"] for p in found[0]["places"] if p["notice"]] == [2]


def test_no_documents_and_no_words(spark):
    docs = spark.createDataFrame([(1, "x", 1, 2, "w", 3, True, "s")], SCHEMA)
    assert ls.license_scan(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        ls.Index([ls.Name("none", "...")], [])
