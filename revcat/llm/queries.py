"""One query per operator, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revcat.llm import (
    bpe, exact_dedup, filter_audit, html_text, jaccard, lexical_search, mixing, packing, quality_rules, quotations,
    repeated_bytes, toxicity, url_filter,
)
from revcat.llm.common import table


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.learn(docs, table(spark, sf_dir, "labels"))
    judged = quality_rules.judge(docs.select("doc_id", "text"), rules)
    counts = [F.col(f"quality_.{c}").alias(c) for c in quality_rules.BASE]
    return judged.select("doc_id", *counts, "quality_.base_failed", F.col("kept_").alias("kept"), F.col("rule_").alias("rule"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encoded_digests(spark, table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes.digests(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_groups(table(spark, sf_dir, "documents"))


RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op2_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = quotations.link(table(spark, sf_dir, "conversations"))
    body = F.sha2("body", 256).alias("body_sha256")
    return linked.select("conv_id", "turn", "role", "n_quotes", "reply_to", "root_turn", "depth", body)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {
    "op1_main_text": op1_main_text,
    "op2_quotation_linking": op2_quotation_linking,
    "op3_url_filter": op3_url_filter,
    "op8_toxicity": op8_toxicity,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op4_byte_bpe": op4_byte_bpe,
    "op9_mixing": op9_mixing,
    "op10_quality_rules": op10_quality_rules,
    "op5_exact_dedup": op5_exact_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_lexical_search": op12_lexical_search,
    "op13_packing": op13_packing,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)

ORACLES = {
    "op3_url_filter": f"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {_RULES}),
parts AS (
  SELECT row_number() OVER () AS n, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
best AS (
  SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (n)
""",
    "op5_exact_dedup": f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256({_LOWER}) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY {_LOWER})
""",
    "op11_filter_audit": r"""
WITH RECURSIVE orders AS (
  SELECT '' AS filter_order UNION ALL
  SELECT filter_order || l FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) letters(l) WHERE NOT contains(filter_order, l)),
steps AS (
  SELECT filter_order, step::INTEGER AS step, filter_order[step] AS own, filter_order[:step - 1] AS before
  FROM orders, range(1, 6) r(step) WHERE length(filter_order) = 5),
texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
said AS (SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id),
failing AS (
  SELECT part, doc_id,
    CASE WHEN len(words) < 50 THEN 'A' ELSE '' END ||
    CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END ||
    CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END ||
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END ||
    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM texts),
counted AS (
  SELECT part, fails, count(*) AS docs, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM failing LEFT JOIN said USING (doc_id) GROUP BY part, fails),
met AS (
  SELECT *, contains(fails, own) AS hit, length(translate(fails, before, '')) = length(fails) AS fresh FROM counted, steps),
stepwise AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(docs) FILTER (fresh AND NOT hit), 0)::BIGINT AS kept,
    coalesce(sum(docs) FILTER (fresh AND hit), 0)::BIGINT AS removed,
    coalesce(sum(docs) FILTER (hit AND NOT fresh), 0)::BIGINT AS redundant,
    coalesce(sum(docs) FILTER (fails = own), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (fresh AND hit), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (fresh AND hit), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM stepwise
""",
    "op12_lexical_search": rf"""
WITH found AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all({_LOWER}, '{lexical_search.TERM}') AS terms FROM documents),
counts AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM found) GROUP BY d, term),
sizes AS (SELECT d, doc_id, len(terms) AS n FROM found WHERE len(terms) > 0),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), whole),
asked AS (
  SELECT i, item_id, unnest(regexp_extract_all({_LOWER}, '{lexical_search.TERM}')) AS term
  FROM (SELECT row_number() OVER () AS i, * FROM benchmark)),
repeats AS (SELECT i, item_id, term, count(*) AS times FROM asked GROUP BY ALL),
scored AS (
  SELECT i, item_id, doc_id, d, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM repeats JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (d), whole GROUP BY i, item_id, doc_id, d),
ranked AS (
  SELECT item_id, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
""",
}
