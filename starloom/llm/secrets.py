"""Secret scan: fixed patterns plus sliding-window entropy, in DataFrame expressions only.

Three base kinds are found by regular expressions.  Beside them, every
*candidate* (a run of token characters) is scanned by a window of fixed width:
the count of each character in the window is kept in an array, a step takes the
leaving character out and the entering one in, and the sum of ``c * log2(c)``
follows from those two counts alone.  A window whose Shannon entropy reaches the
threshold of the candidate's character class is flagged; flagged windows that
overlap or touch form one span.  Candidates that the allow-list knows (UUIDs,
digits only, counting or keyboard runs, placeholders) are suppressed; with
``parts``, as the queries scan, only the windows that overlap what it knows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = (r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
          r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
ACCESS = "AKIA[A-Z0-9]{12,}"  # a whole run of 16 characters or more
HEX = "[0-9a-f]{32,}"
#: Characters of a value in an assignment, at least.
ASSIGN_VALUE = 8
BASE_KINDS = ("assign", "access", "hex")
ENTROPY_KIND = "entropy"

_SPANS = "array<struct<start:int,ord:int,end:int,kind:string>>"
#: Characters of a candidate.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_="
CANDIDATE = "[A-Za-z0-9+/_=]{20,}"
WINDOW = 20
#: Character class of a candidate (first match), and the bits per character that flag a window.
CLASSES = (
    ("hex", "^[0-9a-f]+$|^[0-9A-F]+$", 3.0),
    ("letters of one case", "^[a-z/_=+]+$|^[A-Z/_=+]+$", 4.1),
    ("one case and digits", "^[a-z0-9]+$|^[A-Z0-9]+$", 3.6),
    ("mixed", "", 3.8),
)
#: Candidates that are all of one of these are no secrets; of the others only the
#: windows that overlap a match of ``ALLOW_PART`` (longest matches first) are left out.
ALLOW_WHOLE = ("^[0-9]+$",)
ALLOW_PART = "|".join(["(.)\\1{7,}", "(?i:example|placeholder|changeme|your_|dummy|sample|redacted)",
                       "0123456789|123456789|abcdefgh|ABCDEFGH|qwerty"])


def _spans(text: Column, pattern: str, hits: Column, kind: str, order: int) -> Column:
    """Array of ``(start, ord, end, kind)`` of each of ``hits``, the matches of ``pattern``.

    A match starts after the pieces and matches before it.
    """
    pieces = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["piece"])
        end = begin + F.length(pair["hit"])
        span = F.struct(begin.alias("start"), F.lit(order).alias("ord"), end.alias("end"), F.lit(kind).alias("kind"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    pairs = F.arrays_zip(F.slice(pieces, 1, F.size(hits)).alias("piece"), hits.alias("hit"))
    found = F.aggregate(pairs, start, step, lambda s: s["spans"])
    return F.when(F.size(hits) > 0, found).otherwise(F.array().cast(_SPANS))


def _flagged(candidate: Column, start: Column, threshold: Column, window: int) -> Column:
    """Spans of the runs of flagged windows of one candidate that starts at ``start``."""
    bits = F.array(*[F.lit(c * math.log2(c) if c > 1 else 0.0) for c in range(window + 1)])
    # entering and leaving character of each step, as places in the alphabet
    chars = F.transform(F.split(candidate, ""), lambda c: F.position(c, F.lit(ALPHABET)))
    steps = F.slice(F.arrays_zip(chars.alias("into"), F.concat(F.array_repeat(F.lit(-1), window), chars).alias("out")),
                    F.lit(1), F.length(candidate))
    begin = F.struct(
        F.lit(0).alias("i"), threshold.alias("threshold"),
        F.array_repeat(F.lit(0), len(ALPHABET) + 2).alias("counts"), F.lit(0.0).alias("sum"),
        F.array().cast(_SPANS).alias("spans"))

    def step(state: Column, pair: Column) -> Column:
        i, into, out = state["i"], pair["into"], pair["out"]
        gone = F.when(out >= 0, F.get(state["counts"], out)).otherwise(F.lit(0))
        less = F.when(out >= 0, F.get(bits, gone) - F.get(bits, gone - 1)).otherwise(F.lit(0.0))
        come = F.get(state["counts"], into) - F.when(into == out, F.lit(1)).otherwise(F.lit(0))
        total = state["sum"] - less + F.get(bits, come + 1) - F.get(bits, come)
        counts = F.transform(state["counts"], lambda v, k: v + (k == into).cast("int") - (k == out).cast("int"))
        entropy = F.lit(math.log2(window)) - total / window
        lo, hi = start + i - (window - 1), start + i + 1
        last = F.try_element_at(state["spans"], F.lit(-1))
        grown = F.concat(F.slice(state["spans"], 1, F.size(state["spans"]) - 1),
                         F.array(F.struct(last["start"].alias("start"), last["ord"].alias("ord"),
                                          hi.alias("end"), last["kind"].alias("kind"))))
        fresh = F.concat(state["spans"], F.array(F.struct(
            lo.alias("start"), F.lit(len(BASE_KINDS)).alias("ord"), hi.alias("end"),
            F.lit(ENTROPY_KIND).alias("kind"))))
        flagged = (i >= window - 1) & (entropy >= state["threshold"])
        spans = (F.when(~flagged, state["spans"])
                 .when(last["end"] >= lo, grown)
                 .otherwise(fresh))
        return F.struct((i + 1).alias("i"), state["threshold"].alias("threshold"), counts.alias("counts"),
                        total.alias("sum"), spans.alias("spans"))

    return F.aggregate(steps, begin, step, lambda s: s["spans"])


def _stretches(candidate: Column, start: Column, threshold: Column, window: int) -> Column:
    """``(string, start, threshold)`` of what lies between allow-list matches, where a window fits."""
    hits = F.regexp_extract_all(candidate, F.lit(ALLOW_PART), 0)
    pairs = F.arrays_zip(F.split(candidate, ALLOW_PART, -1).alias("piece"), hits.alias("hit"))
    begin = F.struct(start.alias("at"), threshold.alias("threshold"), F.array().cast(
        "array<struct<string:string,start:int,threshold:double>>").alias("found"))

    def step(state: Column, pair: Column) -> Column:
        end = state["at"] + F.length(pair["piece"])
        part = F.struct(pair["piece"].alias("string"), state["at"].alias("start"), state["threshold"].alias("threshold"))
        return F.struct(
            (end + F.coalesce(F.length(pair["hit"]), F.lit(0))).alias("at"), state["threshold"].alias("threshold"),
            F.when(F.length(pair["piece"]) >= window, F.concat(state["found"], F.array(part)))
            .otherwise(state["found"]).alias("found"))

    return F.aggregate(pairs, begin, step, lambda s: s["found"])


def _threshold(candidate: Column, allow: Sequence[str] = ALLOW_WHOLE) -> Column:
    """Bits per character that flag a window; null for an allowed candidate."""
    limit = None
    for pattern in allow:
        known = candidate.rlike(pattern)
        limit = F.when(known, F.lit(None).cast("double")) if limit is None else limit.when(
            known, F.lit(None).cast("double"))
    for _, pattern, bits in CLASSES:
        limit = limit.when(candidate.rlike(pattern), F.lit(bits)) if pattern else limit.otherwise(F.lit(bits))
    return limit


def secret_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` as ``_row`` with ``_base`` and ``_added``: arrays of spans ``(start, ord, end, kind)``.

    Positions count code points, ends are exclusive, and arrays are sorted.
    Null and empty texts have no spans.  ``_base`` has the three fixed kinds,
    leftmost and non-overlapping per kind; ``_added`` the entropy spans, which
    may overlap base ones: windows that overlap an allow-list match are left out,
    the rest is scored by the class of the candidate.  Texts may have any length.
    No column of ``docs`` but ``text`` is read, and all are kept inside ``_row``.
    """
    text = F.col("_text")
    rows = docs.select(F.struct(F.col("*")).alias("_row"), F.coalesce("text", F.lit("")).alias("_text"))
    hits = rows.select(
        "_row", "_text",
        F.regexp_extract_all(text, F.lit(ASSIGN), 1).alias("_assign"),
        F.regexp_extract_all(text, F.lit(ACCESS), 0).alias("_access"),
        F.regexp_extract_all(text, F.lit(HEX), 0).alias("_hex"),
        F.regexp_extract_all(text, F.lit(CANDIDATE), 0).alias("_candidates"))
    assign = F.when(F.size("_assign") > 0, F.filter(
        F.arrays_zip(_spans(text, ASSIGN, F.col("_assign"), "assign", 0).alias("span"),
                     F.regexp_extract_all(text, F.lit(ASSIGN), 2).alias("value")),
        lambda x: F.length(x["value"]) >= ASSIGN_VALUE)).otherwise(F.array())
    base = F.concat(F.when(F.size("_assign") > 0, F.transform(assign, lambda x: x["span"]))
                    .otherwise(F.array().cast(_SPANS)),
                    _spans(text, ACCESS, F.col("_access"), "access", 1),
                    _spans(text, HEX, F.col("_hex"), "hex", 2))
    candidates = F.arrays_zip(_spans(text, CANDIDATE, F.col("_candidates"), "", 0).alias("span"),
                              F.col("_candidates").alias("string"))
    scored = F.flatten(F.transform(
        F.filter(candidates, lambda c: _threshold(c["string"]).isNotNull()),
        lambda c: _stretches(c["string"], c["span"]["start"], _threshold(c["string"]), window)))
    added = F.when(F.size("_candidates") > 0, F.flatten(F.transform(
        scored, lambda c: _flagged(c["string"], c["start"], c["threshold"], window))))
    return hits.select("_row", F.array_sort(base).alias("_base"),
                       F.array_sort(F.coalesce(added, F.array().cast(_SPANS))).alias("_added"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, mask: str = "[SECRET]", window: int = WINDOW) -> DataFrame:
    """``docs`` with every span replaced by ``mask`` (overlapping spans by one), and ``n_chars``,
    where there is such a column, counted anew for the texts that change.

    All rows and columns stay; null texts stay null.
    """
    found = secret_spans(docs, window)
    spans = F.array_sort(F.concat("_base", "_added"))
    text = F.col("_row.text")

    def step(state: Column, s: Column) -> Column:
        apart = s["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(apart, F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]),
                                   F.lit(mask))).otherwise(state["out"]).alias("out"))

    clean = F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    marked = found.select("_row", F.when(F.size(spans) > 0, clean).alias("_clean"))
    new = {"text": F.coalesce("_clean", "_row.text"),
           "n_chars": F.when(F.col("_clean").isNotNull(), F.length("_clean")).otherwise(F.col("_row.n_chars"))
           .cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return marked.select(*[new[c].alias(c) if c in new else F.col("_row").getField(c).alias(c)
                           for c in docs.columns])
