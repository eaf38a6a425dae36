"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as two vectors: its row of a learned vocabulary (zero for unknown
words) and the mean of its hashed character trigrams.  Two gated recurrent
layers read a window of ``WINDOW`` words in both directions, attention pools
their states, and a logistic unit scores the window.  A text is cut into windows
that overlap by half, its end included, and scores as its most toxic window.

Training sees a bounded sample of labelled rows in one task.  Labels belong to
whole texts, so each round picks the window of a toxic text that now scores
highest (at first the one with the word most typical of toxic texts), and of
clean texts the highest one and some at random.  The input part of the gates is
computed once per distinct word a worker meets, and remembered.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.quality import _texts, remainder

WINDOW, STRIDE = 24, 12
VOCABULARY = 20_000  # words of the sample with a row of their own, at most
TRIGRAMS = 1 << 13
EMBED, HIDDEN, ATTEND = 8, 8, 8
#: Labelled rows that the network learns from, at most, of each label.
SAMPLE_TOXIC, SAMPLE_CLEAN = 1500, 3000
ROUNDS, STEPS, BATCH, RATE = 8, 800, 128, 0.01
CACHE_WORDS = 300_000
_EDGES = re.compile(r"^\W+|\W+$")


def words_of(text: str) -> list[str]:
    """Lower-cased words between white space without punctuation at their ends."""
    return [w for w in (_EDGES.sub("", w) for w in text.lower().split()) if w]


def _trigrams(word: str) -> list[int]:
    padded = f"<{word}>"
    return [xxhash.xxh32_intdigest(padded[i:i + 3], 7) % TRIGRAMS for i in range(len(padded) - 2)]


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word, 11) >> 1


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and first word (inside its text) of every window of texts of ``counts`` words."""
    n = np.where(counts == 0, 0, 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE)))
    owner = np.repeat(np.arange(len(counts)), n)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    return owner, np.minimum(place * STRIDE, np.maximum(counts[owner] - WINDOW, 0))


def window_words(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, words (windows x WINDOW, 0 beyond the text) and mask of every window."""
    owner, start = windows(counts)
    at = start[:, None] + np.arange(WINDOW)
    mask = at < counts[owner][:, None]
    first = (np.cumsum(counts) - counts)[owner][:, None]
    return owner, np.where(mask, words[np.where(mask, first + at, 0)] if len(words) else 0, 0), mask


class Network:
    """Parameters, scores and gradients."""

    def __init__(self, known: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)

        def init(*shape, scale=0.3):
            return (rng.normal(size=shape) * scale).astype(np.float32)

        self.known = known  # sorted word hashes; row i + 1 of ``words`` is known[i]'s
        self.p = {
            "words": init(len(known) + 1, EMBED), "chars": init(TRIGRAMS, EMBED),
            "into": init(2, 2 * EMBED, 3 * HIDDEN), "bias": np.zeros((2, 3 * HIDDEN), np.float32),
            "back": init(2, HIDDEN, 3 * HIDDEN), "look": init(2 * HIDDEN, ATTEND),
            "look_bias": np.zeros(ATTEND, np.float32), "weigh": init(ATTEND),
            "out": init(2 * HIDDEN), "out_bias": np.full(1, -1.0, np.float32)}
        self.p["words"][0] = 0

    def save(self) -> bytes:
        to = io.BytesIO()
        np.savez(to, known=self.known, **self.p)
        return to.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Network:
        parts = dict(np.load(io.BytesIO(raw)))
        net = cls.__new__(cls)
        net.known = parts.pop("known")
        net.p = parts
        return net

    def rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vocabulary row, and trigrams with their counts, of each word."""
        hashes = np.array([_hash(w) for w in words], np.int64)
        at = np.searchsorted(self.known, hashes)
        hit = (at < len(self.known)) & (self.known[np.minimum(at, len(self.known) - 1)] == hashes) if len(
            self.known) else np.zeros(len(words), bool)
        grams = [_trigrams(w) for w in words]
        return (np.where(hit, at + 1, 0), np.array([g for x in grams for g in x], np.int64),
                np.array([len(x) for x in grams], np.int64))

    def inputs(self, row: np.ndarray, grams: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Input vectors of words."""
        starts = np.cumsum(n) - n
        chars = np.add.reduceat(self.p["chars"][grams], starts, axis=0) / n[:, None].astype(np.float32)
        return np.concatenate([self.p["words"][row], chars], axis=1)

    def gates(self, x: np.ndarray) -> np.ndarray:
        """Input part of the gates of both directions: (…, 2, 3 * HIDDEN)."""
        return np.stack([x @ self.p["into"][d] + self.p["bias"][d] for d in (0, 1)], axis=-2)

    def _layer(self, gates: list[np.ndarray], mask: np.ndarray | None, d: int, keep: list | None) -> list[np.ndarray]:
        """States after each step of ``gates``, in reading order."""
        u_rz, u_n = self.p["back"][d][:, :2 * HIDDEN], self.p["back"][d][:, 2 * HIDDEN:]
        h = np.zeros((len(gates[0]), HIDDEN), np.float32)
        out = []
        for t, g in enumerate(gates):
            rz = 0.5 + 0.5 * np.tanh(0.5 * (g[:, :2 * HIDDEN] + h @ u_rz))
            r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
            un = h @ u_n
            n = np.tanh(g[:, 2 * HIDDEN:] + r * un)
            new = n + z * (h - n)
            if mask is not None:
                new = np.where(mask[:, t, None], new, h)
            if keep is not None:
                keep.append((h, r, z, un, n))
            out.append(new)
            h = new
        return out

    def forward(self, gates, mask: np.ndarray | None, keep: dict | None = None) -> np.ndarray:
        """Logit of each window; ``gates(t, d)`` gives the input part of step ``t``, direction ``d``."""
        steps = range(WINDOW)
        k0, k1 = ([], []) if keep is not None else (None, None)
        there = self._layer([gates(t, 0) for t in steps], mask, 0, k0)
        back = self._layer([gates(t, 1) for t in reversed(steps)],
                           None if mask is None else mask[:, ::-1], 1, k1)[::-1]
        h = np.concatenate([np.stack(there, axis=1), np.stack(back, axis=1)], axis=2)
        s = np.tanh(h @ self.p["look"] + self.p["look_bias"])
        e = s @ self.p["weigh"]
        if mask is not None:
            e = np.where(mask, e, np.float32(-1e9))
        a = np.exp(e - e.max(axis=1, keepdims=True))
        a /= a.sum(axis=1, keepdims=True)
        pooled = np.einsum("bt,bth->bh", a, h)
        if keep is not None:
            keep |= {"k": (k0, k1), "h": h, "s": s, "a": a, "pooled": pooled}
        return pooled @ self.p["out"] + self.p["out_bias"]

    def gradients(self, words: np.ndarray, mask: np.ndarray, label: np.ndarray, table) -> dict[str, np.ndarray]:
        """Gradients of the mean log loss; ``table`` has the rows and trigrams of all words."""
        used, at = np.unique(words, return_inverse=True)
        at = at.reshape(words.shape)
        row, grams, n = table.part(used)
        x = self.inputs(row, grams, n)
        per_word = self.gates(x)
        kept: dict = {}
        logit = self.forward(lambda t, d: per_word[at[:, t], d], mask, kept)
        p, grad = self.p, {k: np.zeros_like(v) for k, v in self.p.items()}
        d_logit = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label) / len(label)).astype(np.float32)
        h, s, a, pooled = kept["h"], kept["s"], kept["a"], kept["pooled"]
        grad["out"], grad["out_bias"][0] = pooled.T @ d_logit, d_logit.sum()
        d_pool = d_logit[:, None] * p["out"]
        d_a = np.einsum("bth,bh->bt", h, d_pool)
        d_e = a * (d_a - (a * d_a).sum(axis=1, keepdims=True))
        d_s = d_e[:, :, None] * p["weigh"] * (1 - s * s)
        grad["weigh"] = np.einsum("btk,bt->k", s, d_e)
        grad["look"], grad["look_bias"] = np.einsum("bth,btk->hk", h, d_s), d_s.sum(axis=(0, 1))
        d_h = a[:, :, None] * d_pool[:, None] + d_s @ p["look"].T
        d_word = np.zeros_like(per_word)
        for d in (0, 1):
            order = range(WINDOW) if d == 0 else range(WINDOW - 1, -1, -1)
            u = p["back"][d]
            carry = np.zeros((len(label), HIDDEN), np.float32)
            for step, t in reversed(list(enumerate(order))):
                before, r, z, un, new = kept["k"][d][step]
                dh = carry + d_h[:, t, d * HIDDEN:(d + 1) * HIDDEN]
                on = mask[:, t, None]
                stay, dh = np.where(on, 0, dh), np.where(on, dh, 0)
                dn = dh * (1 - z) * (1 - new * new)
                dz = dh * (before - new) * z * (1 - z)
                dr = dn * un * r * (1 - r)
                dg = np.concatenate([dr, dz, dn], axis=1)
                du = np.concatenate([dr, dz, dn * r], axis=1)
                grad["back"][d] += before.T @ du
                carry = stay + dh * z + du @ u.T
                np.add.at(d_word[:, d], at[:, t], dg)
        d_x = np.zeros_like(x)
        for d in (0, 1):
            grad["into"][d], grad["bias"][d] = x.T @ d_word[:, d], d_word[:, d].sum(axis=0)
            d_x += d_word[:, d] @ p["into"][d].T
        np.add.at(grad["words"], row, d_x[:, :EMBED])
        grad["words"][0] = 0  # unknown words stay zero
        np.add.at(grad["chars"], grams, np.repeat(d_x[:, EMBED:] / n[:, None], n, axis=0))
        return grad


class WordTable:
    """Rows and trigrams of a list of words, for taking parts."""

    def __init__(self, net: Network, words: list[str]):
        self.row, self.grams, self.n = net.rows(words)
        self.start = np.cumsum(self.n) - self.n

    def part(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = self.n[at]
        take = np.repeat(self.start[at] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        return self.row[at], self.grams[take], n


def score_windows(net: Network, per_word: np.ndarray, words: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Logit of every window; ``per_word`` has the gates' input part of each word."""
    out = np.empty(len(words), np.float32)
    rows = per_word.reshape(-1, 3 * HIDDEN)  # two rows per word, one per direction
    for at in range(0, len(words), 2048):
        part, on = np.ascontiguousarray(words[at:at + 2048].T) * 2, mask[at:at + 2048]
        out[at:at + 2048] = net.forward(lambda t, d, part=part: rows.take(part[t] + d, axis=0),
                                        None if on.all() else on)
    return out


def train_network(texts: list[str], labels: np.ndarray, rounds: int = ROUNDS, seed: int = 5) -> Network:
    """A network fitted to ``texts`` in their order; without both labels an untrained one."""
    split = [words_of(t) for t in texts]
    vocabulary: dict[str, int] = {}
    words = np.array([vocabulary.setdefault(w, len(vocabulary)) for x in split for w in x], np.int64)
    counts = np.array([len(x) for x in split], np.int64)
    owner = np.repeat(np.arange(len(split)), counts)
    pairs = np.unique(np.stack([owner, words], axis=1), axis=0) if len(words) else np.empty((0, 2), np.int64)
    toxic = labels[pairs[:, 0]] == 1
    seen = np.bincount(pairs[:, 1], minlength=len(vocabulary))
    bad = np.bincount(pairs[toxic, 1], minlength=len(vocabulary))
    names = list(vocabulary)
    common = np.argsort(-seen, kind="stable")[:VOCABULARY]
    net = Network(np.array(sorted(_hash(names[i]) for i in common if seen[i] > 1), np.int64), seed)
    if not len(words) or labels.min() == labels.max():
        return net
    share = max(1, labels.sum()) / max(1, (1 - labels).sum())
    typical = np.log((bad + 0.3) / ((seen - bad) * share + 0.3))
    table = WordTable(net, names)
    of, grid, mask = window_words(words, counts)
    likely = np.where(mask, typical[grid], -np.inf).max(axis=1)
    rng = np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    everything = np.arange(len(names))
    # small samples take more rounds, so that there are steps enough
    rounds = max(rounds, min(100, -(-STEPS * BATCH // (5 * len(split)))))
    for turn in range(rounds):
        if turn:
            per_word = net.gates(net.inputs(*table.part(everything)))
            likely = score_windows(net, per_word, grid, mask)
        best = np.lexsort((-likely, of))
        best = best[np.flatnonzero(np.diff(of[best], prepend=-1))]  # the likeliest window of each text
        clean = np.flatnonzero(labels[of] == 0)
        some = rng.choice(clean, min(len(clean), 3 * len(split)), replace=False)
        chosen = np.concatenate([best[labels[of[best]] == 1]] * 2 + [best[labels[of[best]] == 0], some])
        rng.shuffle(chosen)
        for lo in range(0, len(chosen), BATCH):
            part = chosen[lo:lo + BATCH]
            grads = net.gradients(grid[part], mask[part], labels[of[part]].astype(np.float32), table)
            step += 1
            rate = RATE * (1 - (turn + lo / len(chosen)) / rounds) + 1e-4
            for k, g in grads.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                net.p[k] -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


class Scorer:
    """Scores texts; remembers the gates' input part of the words it has met."""

    def __init__(self, net: Network):
        self.net = net
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.per_word = np.empty((1 << 12, 2, 3 * HIDDEN), np.float32)

    def _learn(self, raw: list[str]) -> None:
        if not raw:
            return
        at = len(self.places)
        while at + len(raw) > len(self.per_word):
            self.per_word = np.concatenate([self.per_word, np.empty_like(self.per_word)])
        for lo in range(0, len(raw), 20_000):
            part = raw[lo:lo + 20_000]
            plain = [_EDGES.sub("", w) for w in part]
            self.per_word[at + lo:at + lo + len(part)] = self.net.gates(
                self.net.inputs(*self.net.rows([w or "-" for w in plain])))
            for w, p in zip(part, plain, strict=True):
                self.places[w] = len(self.places) * 2 + (not p)  # odd: no word at all

    def __call__(self, texts: pa.Array) -> np.ndarray:
        if len(self.places) > CACHE_WORDS:
            self._forget()
        lists = pc.utf8_split_whitespace(pc.utf8_lower(texts.cast(pa.large_string())))
        coded = lists.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self._learn([w for w in distinct if w not in self.places])
        place = np.fromiter(map(self.places.__getitem__, distinct), np.int64, len(distinct))
        at = place[coded.indices.to_numpy(zero_copy_only=False)]
        n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(len(n)), n)
        word = at % 2 == 0
        counts = np.bincount(owner[word], minlength=len(n))
        of, grid, mask = window_words(at[word] // 2, counts)
        logits = score_windows(self.net, self.per_word, grid, mask)
        top = np.full(len(n), -np.inf)
        np.maximum.at(top, of, logits)
        return np.where(np.isinf(top), 0.0, 1 / (1 + np.exp(-np.clip(top, -35, 35))))


def toxicity_model(docs: DataFrame, labels: DataFrame, usable: Column | None = None,
                   toxic_rows: int = SAMPLE_TOXIC, clean_rows: int = SAMPLE_CLEAN) -> bytes:
    """A trained network from ``labels(doc_id, toxic)``, without the rows held out (remainder 1 of 3).

    It learns from at most ``toxic_rows`` and ``clean_rows`` labelled rows, those
    with the smallest hashes of doc_id, in one task.
    """
    usable = remainder(F.col("doc_id"), 3) != 1 if usable is None else usable
    ids = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & usable)
           .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
           .withColumn("order", F.xxhash64("doc_id")))
    chosen = None
    for label, rows in ((1, toxic_rows), (0, clean_rows)):
        part = ids.where(F.col("label") == label).orderBy("order", "doc_id").limit(rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    sample = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
              .join(F.broadcast(chosen), "doc_id").select("order", "label", "text"))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["order"], r["label"], r["text"]) for b in batches for r in b.to_pylist())
        net = train_network([r[2] for r in rows], np.array([r[1] for r in rows], np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([net.save()], pa.binary())], ["model"])

    row = sample.repartition(1).mapInArrow(train, "model binary").first()
    return bytes(row["model"]) if row else Network(np.empty(0, np.int64)).save()


def toxicity(docs: DataFrame, model: bytes) -> DataFrame:
    """``docs`` as ``_row`` with ``_score``: the highest probability, over all windows, of being toxic.

    Null texts, and texts without words, score 0.  Texts may have any length: all
    their windows count, and those of one text are in memory together (some
    hundred bytes a word).  Repeated rows are scored one by one, an empty table
    gives no rows, and no column but ``text`` is read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Network.load(sent.value))
        for batch in _texts(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer(batch.column(1)))], ["_row", "_score"])

    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return kept.mapInArrow(run, T.StructType([kept.schema["_row"], T.StructField("_score", T.DoubleType())]))
