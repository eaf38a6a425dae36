"""License scan by a positional index of rare words.

The templates (licence names and licence notices) are indexed by word: each word
of theirs has its postings, the template and the place in it.  One pass over the
corpus counts in how many files each template word stands, which gives its
inverse document frequency (IDF).  A file's words are looked up rarest first: a
word at place p of the file and at place q of a template puts the template's
start at p - q.  A template stands where its words agree on the start.

* A *name* (a short phrase, such as "mit license") stands where all its words
  agree exactly: the starts of the rarest are cut down by those of the next.
* A *notice* (a paragraph) may have words put in or left out.  Of the ``RARE``
  rarest of its words that the file has, at least ``AGREE`` must put the start within
  ``SLACK`` words of one place; then each of its mandatory key phrases must stand
  word by word in the stretch, found as a name is.

Files are scanned apart, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.bpe import blocks

#: A file's rarest words of a notice that are looked up, and how many of them must agree on its place.
RARE, AGREE = 8, 5
#: Words by which a notice's parts may be off their place.
SLACK = 12
#: Bytes of a text that are cut into words at a time.
SLICE_BYTES = 4 << 20

_WORD = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
#: Lower-cases A-Z; all that is in no word becomes a space.
_FOLD = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _WORD or 0x41 <= b <= 0x5A else 32 for b in range(256))


class Name(NamedTuple):
    """A phrase whose words stand one after another."""

    label: str
    phrase: str


class Notice(NamedTuple):
    """A paragraph, with the phrases that it can't do without."""

    label: str
    text: str
    phrases: tuple[str, ...]


#: Fixed values of the contract.
NAMES = (
    Name("mit", "mit license"),
    Name("apache", "apache license"),
    Name("gpl", "general public license"),
)

#: Opening paragraphs of well-known licences and the notices they ask for.
NOTICES = (
    Notice("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files, to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software""",
           ("permission is hereby granted free of charge", "without restriction")),
    Notice("apache", """you may not use this file except in compliance with the License. You may obtain a copy of the
        License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS""",
           ("except in compliance with the license", "apache org licenses")),
    Notice("gpl", """you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or any later version""",
           ("redistribute it and or modify it under the terms", "free software foundation")),
    Notice("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer""",
           ("redistribution and use in source and binary forms", "are permitted provided that")),
    Notice("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
        fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
        copies""",
           ("permission to use copy modify", "with or without fee is hereby granted")),
    Notice("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
        the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/""",
           ("source code form is subject to the terms", "mozilla public license")),
    Notice("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to
        copy, modify, publish, use, compile, sell, or distribute this software""",
           ("free and unencumbered software", "public domain")),
    Notice("cc-by-nc", "Licensed under CC BY-NC 4.0", ("licensed under cc by nc",)),
    Notice("cc-by-nc", """This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International
        License""", ("creative commons attribution noncommercial",)),
)


def fold(text: str) -> bytes:
    return text.encode().translate(_FOLD)


def slices(data: bytes) -> Iterator[list[bytes]]:
    """The words of folded text, some at a time."""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE_BYTES)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


class Index:
    """Postings of the templates' words."""

    def __init__(self, names: Sequence[Name], notices: Sequence[Notice]):
        self.names, self.notices = names, notices
        self.numbers: dict[bytes, int] = {}
        self.name_words = [self._numbers(n.phrase) for n in names]
        self.words = [self._numbers(n.text) for n in notices]
        self.phrases = [[self._numbers(p) for p in n.phrases] for n in notices]
        if not all(map(len, [*self.name_words, *self.words, *(p for ps in self.phrases for p in ps)])):
            raise ValueError("a template without words stands nowhere")
        self.needs = [frozenset(w) for w in self.name_words]  # a file without one of these has no such template
        self.notice_needs = [frozenset(w for p in ps for w in p) for ps in self.phrases]
        self.postings: list[dict[int, np.ndarray]] = []  # of each notice: word -> its places there
        for words in self.words:
            here = np.array(words)
            self.postings.append({int(w): np.flatnonzero(here == w) for w in np.unique(here)})

    def _numbers(self, text: str) -> list[int]:
        return [self.numbers.setdefault(w, len(self.numbers)) for w in fold(text).split()]

    def find(self, text: str) -> tuple[int, np.ndarray, np.ndarray]:
        """How many words ``text`` has; places and numbers of those in templates, in order of place."""
        n, places, numbers, get = 0, [], [], self.numbers.get
        for words in slices(fold(text)):
            known = np.fromiter([get(w, -1) for w in words], np.int32, len(words))
            here = np.flatnonzero(known >= 0)
            places.append(here + n)
            numbers.append(known[here])
            n += len(words)
        if not places:
            return 0, np.empty(0, np.int64), np.empty(0, np.int32)
        return n, np.concatenate(places), np.concatenate(numbers)

    def scan(self, places: np.ndarray, numbers: np.ndarray, idf: Sequence[float]) -> list[tuple]:
        """``(label, notice, start, words, score)`` of all templates that stand in a file."""
        have = frozenset(np.unique(numbers).tolist())
        names = [i for i, need in enumerate(self.needs) if need <= have]
        notices = [i for i, need in enumerate(self.notice_needs) if need <= have]
        if not names and not notices:
            return []
        order = np.argsort(numbers, kind="stable")
        which, first = np.unique(numbers[order], return_index=True)
        where = dict(zip(which.tolist(), np.split(places[order], first[1:]), strict=True))
        out = []
        for i in names:
            words = self.name_words[i]
            out.extend((self.names[i].label, False, start, len(words), 1.0)
                       for start in stands(words, where, idf).tolist())
        for i in notices:
            starts, scores = self._notice(i, where, idf)
            out.extend((self.notices[i].label, True, start, len(self.words[i]), score)
                       for start, score in zip(starts.tolist(), scores.tolist(), strict=True))
        return out

    def _notice(self, i: int, where: Mapping[int, np.ndarray], idf: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
        """Starts and scores of a notice; of starts that lie within SLACK words one after another the best one."""
        post, size = self.postings[i], len(self.words[i])
        rare = sorted((w for w in post if w in where), key=lambda w: (-idf[w], int(post[w][0])))[:RARE]
        starts = [np.unique(np.subtract.outer(where[w], post[w])) for w in rare]  # where each word puts the start
        at = np.unique(np.concatenate(starts))
        agree = np.zeros(len(at), np.int64)
        for each in starts:
            agree += near(each, at - SLACK, at + SLACK)
        at = at[agree >= min(AGREE, len(post))]
        for phrase in self.phrases[i]:
            at = at[near(stands(phrase, where, idf), at - SLACK, at + size + SLACK)]
        if not len(at):
            return at, np.empty(0)
        total, score = 0.0, np.zeros(len(at))
        for w in sorted(post):
            total += idf[w]
            if w in where:
                score += idf[w] * near(where[w], at - SLACK, at + size + SLACK)
        score = np.minimum(score / total, 1.0) if total else np.ones(len(at))
        group = np.cumsum(np.diff(at, prepend=at[0]) > SLACK)
        best = np.lexsort((at, -score, group))
        best = best[np.flatnonzero(np.diff(group[best], prepend=-1))]
        return np.maximum(at[best], 0), score[best]


def near(sorted_places: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether one of the places lies in each interval, ends included."""
    return np.searchsorted(sorted_places, low, "left") < np.searchsorted(sorted_places, high, "right")


def stands(words: Sequence[int], where: Mapping[int, np.ndarray], idf: Sequence[float]) -> np.ndarray:
    """Places where ``words`` stand one after another: starts by the rarest word, cut down by the others."""
    order = sorted(range(len(words)), key=lambda q: (-idf[words[q]], q))
    starts = where.get(words[order[0]], np.empty(0, np.int64)) - order[0]
    for q in order[1:]:
        if not len(starts):
            break
        starts = np.intersect1d(starts, where.get(words[q], np.empty(0, np.int64)) - q, assume_unique=True)
    return starts


def word_weights(docs: DataFrame, index: Index) -> list[float]:
    """IDF of each template word over all rows of ``docs``: ``ln((1 + rows) / (1 + rows that hold it))``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, held = 0, np.zeros(len(index.numbers), np.int64)
        for batch in blocks(batches):
            n += batch.num_rows
            for text in batch.column(0).to_pylist():
                held[np.unique(index.find(text)[2])] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(held))), pa.array(np.append(n, held))], ["word", "n"])

    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    held = {r["word"]: r["n"] for r in rows}  # one row per template word
    return [math.log((1 + held.get(-1, 0)) / (1 + held.get(w, 0))) for w in range(len(index.numbers))]


def license_scan(docs: DataFrame, names: Sequence[Name] = NAMES, notices: Sequence[Notice] = NOTICES) -> DataFrame:
    """Where licences stand in every row of ``docs(doc_id, text, …)``.

    Returns ``(doc_id, n_words, places)``; ``places`` is an array of ``label,
    notice`` (else a name), ``start`` (words from 0), ``words`` (of the template) and ``score``: the
    share of the template's words, weighted by IDF, that stand in its stretch; 1
    for a name.  Words are runs of letters, digits and all characters beyond
    ASCII, with A-Z in lower case.

    Null and empty texts have no words and no places.  Words that are equally
    rare are taken in the template's order.  Repeated rows are scanned, and
    counted for the IDF, one by one; a null doc_id is a row like others; an empty
    table gives no rows; other columns are not read.  Texts may have any length:
    words are cut some at a time, and only places of template words are kept.
    """
    index = Index(names, notices)
    idf = word_weights(docs, index)
    kind = docs.schema["doc_id"].dataType.simpleString()
    place = pa.list_(pa.struct([("label", pa.string()), ("notice", pa.bool_()), ("start", pa.int64()),
                                ("words", pa.int32()), ("score", pa.float64())]))
    fields = ("label", "notice", "start", "words", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            sizes, found = [], []
            for text in batch.column(1).to_pylist():
                n, places, numbers = index.find(text)
                sizes.append(n)
                found.append([dict(zip(fields, p, strict=True)) for p in index.scan(places, numbers, idf)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, place)], ["doc_id", "n_words", "places"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_words long, "
             "places array<struct<label: string, notice: boolean, start: long, words: int, score: double>>")
