"""URL filter: a bit-parallel wildcard automaton over canonical URLs.

Every rule becomes one or two glob patterns over the canonical URL: the bytes of
the lower-cased host, a separator symbol, the bytes of the path.  All patterns
are packed side by side into 64-bit words, one bit per pattern position, and one
Shift-And step per symbol moves all patterns of all URLs of a batch at once:

    state = (state << 1 & accepts[symbol]) | (state & stays[symbol])

``stays`` keeps the positions that a ``*`` follows; no ``*`` passes the
separator, so a host pattern can't match inside a path.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SEP = 256
_ANY, _STAR = -1, -2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class SiteRule(NamedTuple):
    """Fits ``host`` and its subdomains where the URL's path starts with ``path``, taken literally."""

    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


class GlobRule(NamedTuple):
    """Fits URLs whose host and path match the two globs whole: ``*`` any run, ``?`` any one byte."""

    action: str
    host: str
    path: str


def _glob(text: str) -> list[int]:
    special = {ord("*"): _STAR, ord("?"): _ANY}
    return [special.get(b, b) for b in text.encode()]


def _patterns(rule: SiteRule | GlobRule) -> list[list[int]]:
    if isinstance(rule, GlobRule):
        return [[*_glob(rule.host), _SEP, *_glob(rule.path)]]
    tail = [*rule.host.encode(), _SEP, *rule.path.encode(), _STAR]
    return [tail, [_STAR, ord("."), *tail]]


class GlobAutomaton:
    """All patterns of ``rules`` in multiword Shift-And masks."""

    def __init__(self, rules: Sequence[SiteRule | GlobRule]):
        accepts, stays, first, self.finals = [], [], [], []
        for number, rule in enumerate(rules):
            for pattern in _patterns(rule):
                first.append(len(accepts))
                accepts.append(None)  # nothing read yet
                stays.append(False)
                for symbol in pattern:
                    if symbol == _STAR:
                        stays[-1] = True
                    else:
                        accepts.append(symbol)
                        stays.append(False)
                self.finals.append((len(accepts) - 1, number))
        self.words = max(1, -(-len(accepts) // 64))

        def pack(bits: list[int]) -> np.ndarray:
            out = np.zeros(self.words, np.uint64)
            for i in bits:
                out[i // 64] |= np.uint64(1) << np.uint64(i % 64)
            return out

        self.start = pack(first)
        self.accepts = np.stack([pack([i for i, a in enumerate(accepts)
                                       if a == s or (a == _ANY and s != _SEP)]) for s in range(257)])
        loop = pack([i for i, s in enumerate(stays) if s])
        self.stays = np.stack([loop if s != _SEP else np.zeros_like(loop) for s in range(257)])
        self.rules = len(rules)

    def match(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Boolean matrix, strings by rules, of the strings ``symbols[start:end]``."""
        order = np.argsort(starts - ends, kind="stable")  # longest first: the strings still running are a prefix
        at, n = starts[order], (ends - starts)[order]
        state = np.tile(self.start, (len(n), 1))
        one, top = np.uint64(1), np.uint64(63)
        running = len(n)
        for step in range(int(n[0]) if len(n) else 0):
            while running and n[running - 1] <= step:
                running -= 1
            symbol = symbols[at[:running] + step]
            now = state[:running]
            shifted = now << one
            shifted[:, 1:] |= now[:, :-1] >> top
            state[:running] = (shifted & self.accepts[symbol]) | (now & self.stays[symbol])
        found = np.zeros((len(n), self.rules), bool)
        for bit, rule in self.finals:
            found[:, rule] |= (state[:, bit // 64] >> np.uint64(bit % 64) & one).astype(bool)
        out = np.empty_like(found)
        out[order] = found
        return out


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_after(url), "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def judge_urls(pages: DataFrame, site_rules: Sequence[SiteRule], glob_rules: Sequence[GlobRule],
               default: str = "allow") -> DataFrame:
    """One row per row of ``pages(page_id, url, …)``: ``page_id, host, path, rule, verdict``.

    ``rule`` is the longest site rule that fits (host and path together; of
    equals the first listed) and gives the verdict.  Without one, the longest
    glob rule that matches does (of equals the first), else ``default``.  A null
    url, or one without ``://``, has empty host and path.  Repeated rows give
    repeated results; an empty table gives none; other columns are not read.
    """
    rules = [*sorted(site_rules, key=lambda r: -len(r.name)),
             *sorted(glob_rules, key=lambda r: -len(r.host + r.path))]
    automaton = GlobAutomaton(rules)
    names = np.array([r.name if isinstance(r, SiteRule) else None for r in rules] + [None], object)
    actions = np.array([r.action for r in rules] + [default], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, ends, n = [], [], 0
            for host, path in zip(*(c.cast(pa.binary()).to_pylist() for c in batch.columns[1:3]), strict=True):
                parts += [np.frombuffer(host, np.uint8), (_SEP,), np.frombuffer(path, np.uint8)]
                n += len(host) + 1 + len(path)
                ends.append(n)
            ends = np.array(ends, np.int64)
            symbols = np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)
            found = automaton.match(symbols, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends)
            won = np.where(found.any(axis=1), found.argmax(axis=1), len(rules)) if len(rules) else (
                np.full(len(ends), 0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names[won], pa.string()), pa.array(actions[won], pa.string())],
                ["page_id", "host", "path", "rule", "verdict"])

    kind = pages.schema["page_id"].dataType.simpleString()
    url = F.col("url")
    return (pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
            .mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string"))
