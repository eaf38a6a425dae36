"""The registered queries of the subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from public_tokenizers import PATTERN
from public_tokenizers import path as vocabulary
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.bpe import encode
from starloom.llm.common import table
from starloom.llm.conversation_trie import prefix_trie, spliced, turn_sequences
from starloom.llm.embedding_dedup import embedding_dedup
from starloom.llm.exact_dedup import exact_dedup
from starloom.llm.license_scan import license_scan
from starloom.llm.packing import ids_crc32, pack
from starloom.llm.quality import quality_model, remainder, score
from starloom.llm.secrets import BASE_KINDS, secret_spans, spans_text
from starloom.llm.simhash import simhash_dedup
from starloom.llm.suffix_dedup import repeated_strings
from starloom.llm.token_alignment import token_alignment
from starloom.llm.toxicity import toxicity, toxicity_model
from starloom.llm.url_filter import GlobRule, SiteRule, judge_urls

THRESHOLD = 0.7

#: Fixed values of the contract.
SITE_RULES = (
    SiteRule("block", "net", "/"),
    SiteRule("allow", "example.net", "/en/"),
    SiteRule("block", "example.com", "/de/"),
    SiteRule("allow", "org", "/fr/"),
)
GLOB_RULES = (
    GlobRule("block", "*spam*", "*"),
    GlobRule("block", "*", "*/login*"),
    GlobRule("block", "*", "*.exe"),
    GlobRule("block", "ads.*", "*"),
)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    coded = encode(table(spark, sf_dir, "documents"), ranks, PATTERN, decoded=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, quality_model(docs, table(spark, sf_dir, "labels")))
    return scored.select("_row.doc_id", (remainder(F.col("_row.doc_id"), 4) == 2).alias("held_out"),
                         F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_strings(table(spark, sf_dir, "documents"), width=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    return scored.select("_row.doc_id", (remainder(F.col("_row.doc_id"), 3) == 1).alias("held_out"),
                         F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup(table(spark, sf_dir, "documents"), shingle_words=4, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), capacity=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", ids_crc32(F.col("ids")).alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), SITE_RULES, GLOB_RULES, default="allow")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("_row.doc_id", *map(count, BASE_KINDS), F.sha2(spans_text(F.col("_base")), 256).alias("base_sha256"),
                        spans_text(F.array_sort(F.concat("_base", "_added"))).alias("spans"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"))
    base = F.filter("places", lambda p: ~p["notice"])

    def labels(places: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    starts = F.transform(base, lambda p: p["start"])
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
                        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"),
                        F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)).alias("score"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_alignment(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                            vocabulary("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
                        "n_overlaps")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spliced(turn_sequences(table(spark, sf_dir, "conversations")), every=20, heads=4))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_embedding_dedup": op2_embedding_dedup,
        "op3_byte_bpe": op3_byte_bpe,
        "op4_quality_classifier": op4_quality_classifier,
        "op5_suffix_dedup": op5_suffix_dedup,
        "op6_toxicity": op6_toxicity,
        "op7_simhash_dedup": op7_simhash_dedup,
        "op8_packing": op8_packing,
        "op9_url_filter": op9_url_filter,
        "op10_secret_scan": op10_secret_scan,
        "op11_license_scan": op11_license_scan,
        "op12_token_alignment": op12_token_alignment,
        "op13_prefix_trie": op13_prefix_trie,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
                   doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
            FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
            WINDOW g AS (PARTITION BY t)""",
        "op9_url_filter": r"""
            WITH cut AS (
                SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest
                FROM pages),
            parts AS (
                SELECT page_id,
                       translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                       coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
                FROM cut),
            ruled AS (
                SELECT *, CASE
                    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/')
                        THEN 'example.net/en/'
                    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/')
                        THEN 'example.com/de/'
                    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
                FROM parts)
            SELECT page_id, host, path, rule, CASE
                WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
                WHEN rule IS NOT NULL THEN 'block'
                WHEN host LIKE '%spam%' OR path LIKE '%/login%' OR path LIKE '%.exe' OR host LIKE 'ads.%' THEN 'block'
                ELSE 'allow' END AS verdict
            FROM ruled""",
        "op13_prefix_trie": r"""
            WITH RECURSIVE turns AS (
                SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                           sha256(length(r)::VARCHAR || ':' || r || t)) AS k,
                       length(r)::VARCHAR || ':' || r || t AS said,
                       len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS words
                FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
                      WHERE conv_id IS NOT NULL)),
            convs AS (
                -- CRC-32 bit by bit over the decimal id
                SELECT c, xor(list_reduce(list_prepend(4294967295::UBIGINT,
                               list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::UBIGINT)),
                           lambda s, b: list_reduce(list_prepend(xor(s, b), list_transform(range(8), lambda i: 0::UBIGINT)),
                               lambda v, i: xor(v >> 1, (v & 1) * 3988292384::UBIGINT))), 4294967295::UBIGINT) % 4 AS h
                FROM (SELECT DISTINCT c FROM turns)),
            rebuilt AS (
                SELECT convs.c, t.k, t.said, t.words FROM convs
                JOIN turns t ON t.c = convs.c - convs.c % 20 AND t.k <= h
                UNION ALL
                SELECT convs.c, t.k + 10, t.said, t.words FROM convs JOIN turns t ON t.c = convs.c AND t.k > h),
            placed AS (
                SELECT c, row_number() OVER (PARTITION BY c ORDER BY k) AS d, said, words FROM rebuilt),
            prefixes AS (
                SELECT c, 0::BIGINT AS d, sha256('') AS node, NULL::VARCHAR AS parent, 0::BIGINT AS words FROM convs
                UNION ALL
                SELECT p.c, p.d, sha256(q.node || p.said), q.node, p.words FROM prefixes q
                JOIN placed p ON p.c = q.c AND p.d = q.d + 1),
            ended AS (
                SELECT node, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends
                FROM (SELECT c, max_by(node, d) AS node FROM prefixes GROUP BY c) GROUP BY node),
            nodes AS (
                SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(c) AS conv_id,
                       count(*) AS n_convs, any_value(words) AS words FROM prefixes GROUP BY node),
            kids AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
            below AS (
                SELECT node AS top, node FROM nodes
                UNION ALL
                SELECT b.top, n.node FROM below b JOIN nodes n ON n.parent = b.node),
            summed AS (
                SELECT b.top AS node, count(*) FILTER (k.n IS NULL) AS n_leaves,
                       sum((n.n_convs - 1) * n.words) AS saved_tokens
                FROM below b JOIN nodes n USING (node) LEFT JOIN kids k USING (node) GROUP BY b.top)
            SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
                   s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
            FROM nodes n JOIN summed s USING (node) LEFT JOIN nodes p ON p.node = n.parent
            LEFT JOIN kids k ON k.node = n.node LEFT JOIN ended e ON e.node = n.node""",
    }
