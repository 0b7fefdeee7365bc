"""The registered queries of these operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm import (
    chat_format, conversation_repair, fingerprints, html_text, language_id, mixing, near_dedup, packing, quality_rules, ranked_search,
    secret_scan, token_counts, toxicity,
)
from almanac.llm.common import remainder, table
from almanac.sources.stage import stage

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = "word_bpe_49k.json"


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)))
    learnable = ~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull()
    counts = language_id.row_counts(docs, learnable)
    sample = language_id.training_sample(docs, learnable, counts)
    return language_id.predict(docs, language_id.train(sample, prior=counts), keep=("doc_id", "held_out"))


def op3_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.findings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "n_chars", F.sha2("value", 256).alias("value_sha256"), "probability", "accepted")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)))
    index = toxicity.build_index(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return toxicity.score(docs, index, keep=("doc_id", "held_out"))


def op6_pack_least_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op7_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.learn(pages))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op9_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stage(fingerprints.fingerprint_edits(table(spark, sf_dir, "documents")), "fingerprints")
    return fingerprints.near_counts(found, F.col("doc_id") % 20 == 0)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.learn_rules(docs, table(spark, sf_dir, "labels")))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.audit_damaged(table(spark, sf_dir, "conversations"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    both = F.array(*[F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"),
                              F.lit("</s>[INST] ok [/INST]").alias("text")) for i, role in enumerate(("user", "assistant"))])
    talks = talks.unionByName(spark.range(1).select(F.inline(both)))
    return chat_format.read_back(chat_format.format_conversations(talks))


QUERIES: dict[str, Query] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_language_id": op2_language_id,
    "op3_secret_forest": op3_secret_forest,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_toxicity_neighbours": op5_toxicity_neighbours,
    "op6_pack_least_squares": op6_pack_least_squares,
    "op7_html_main_text": op7_html_main_text,
    "op8_token_counts": op8_token_counts,
    "op9_simhash_fingerprints": op9_simhash_fingerprints,
    "op10_quality_rules": op10_quality_rules,
    "op11_ranked_search": op11_ranked_search,
    "op12_repair_conversations": op12_repair_conversations,
    "op13_chat_format": op13_chat_format,
}
#: What SQL can say; the others are learned or pseudorandom and are tested against brute force.
ORACLES: dict[str, str] = {
    "op4_minhash_near_dedup": r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM worded
),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
linked AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= 75 * (a.n + b.n - COUNT(*))
),
links AS (SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT reached.doc_id, links.y FROM reached JOIN links ON reached.other = links.x
),
named AS (SELECT doc_id, MIN(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN named USING (doc_id)""",
    "op11_ranked_search": r"""
WITH worded AS (
  SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
),
sized AS (SELECT place, doc_id, w, len(w)::BIGINT AS n FROM worded WHERE len(w) > 0),
whole AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sized),
asked AS (
  SELECT item_id, term, count(*)::BIGINT AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark)
  GROUP BY ALL
),
held AS (
  SELECT place, term, count(*)::BIGINT AS tf FROM (SELECT place, unnest(w) AS term FROM sized)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
),
weighed AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight
  FROM (SELECT term, count(*)::BIGINT AS df FROM held GROUP BY term), whole
),
parts AS (
  SELECT place, term, weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))) AS part
  FROM held JOIN sized USING (place) JOIN weighed USING (term), whole
),
scored AS (
  SELECT item_id, doc_id, place, sum(times * part)::BIGINT AS score FROM asked JOIN parts USING (term) JOIN sized USING (place) GROUP BY ALL
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op13_chat_format": r"""
WITH talks AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
measured AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
    CASE role WHEN 'system' THEN 19 WHEN 'user' THEN 16 WHEN 'assistant' THEN 8 ELSE 23 + length(role) END AS marks,
    -- one character more for each escape character and each control string
    length(regexp_replace(text, '\\|</?s>|\[/?INST\]|<</?SYS>>|\[/?ROLE\]|\[/TURN\]', '\0-', 'g')) AS escaped
  FROM talks
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(marks + escaped)::BIGINT AS formatted_chars,
  bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before = 'assistant' OR before = 'system' THEN role = 'user'
    WHEN before = 'user' THEN role = 'assistant' ELSE FALSE END)
    AND last(role ORDER BY turn NULLS FIRST, role, text) = 'assistant' AS valid
FROM measured GROUP BY conv_id""",
}
