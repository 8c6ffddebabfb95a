"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import documents, held_out, prepare
from shelfmark.llm.decontaminate import contamination
from shelfmark.llm.exact import dedup_files
from shelfmark.llm.language import identify_language
from shelfmark.llm.lines import dedup_report
from shelfmark.llm.mixing import mix
from shelfmark.llm.near import jaccard_join
from shelfmark.llm.negatives import hard_negatives
from shelfmark.llm.pii import digest, sanitise
from shelfmark.llm.repetition import with_repetition
from shelfmark.llm.sharding import shard_documents
from shelfmark.llm.spelling import SPOILED, corpus_words, spelling_groups
from shelfmark.llm.tokens import Vocabulary, materialise
from shelfmark.llm.toxicity import train, with_toxicity

TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
RANKS, END_MARK = "byte_bpe_multi_50k.tiktoken", 50256
SHARDS = 8


def op1_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(sanitise(documents(spark, sf_dir)))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return with_toxicity(rows, model).drop("text")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "lang", "text")
    return identify_language(docs).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return rows.drop("spans")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir)).drop("row_key", "has_words")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_report(documents(spark, sf_dir))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_documents(documents(spark, sf_dir), SHARDS)
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = Vocabulary.read(f"{TOKENIZERS}/{RANKS}", END_MARK)
    return materialise(documents(spark, sf_dir), vocabulary)


def op10_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_repetition(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    further = ["n_covered", "longest_repeat", "n_repeats"]
    return rows.select(*[c for c in rows.columns if c not in further], *further)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(corpus_words(documents(spark, sf_dir), every=SPOILED))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = prepare(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    return hard_negatives(
        rows.select(vec_id.alias("id"), F.col("embedding").alias("vector"), moved.alias("label"), (vec_id % 50 == 0).alias("is_anchor"))
    )


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_files(prepare(spark), f"{sf_dir}/documents.parquet")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sanitise": op1_sanitise,
    "op2_toxicity": op2_toxicity,
    "op3_language": op3_language,
    "op4_decontaminate": op4_decontaminate,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_line_dedup": op6_line_dedup,
    "op7_mixing": op7_mixing,
    "op8_sharding": op8_sharding,
    "op9_training_order": op9_training_order,
    "op10_repetition": op10_repetition,
    "op11_spelling": op11_spelling,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_exact_dedup": op13_exact_dedup,
}

# Closed form of the shared level: the largest over all prefixes of sources by cap per weight.
MIX_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, md5(concat_ws('|', 'mix', CAST(doc_id AS VARCHAR), text)) AS k,
         COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
totals AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighted AS (
  SELECT source, source_size, source_size * 3 AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM totals),
levels AS (
  SELECT *, CAST(SUM(source_size) OVER () - COALESCE(SUM(cap) OVER p, 0) AS DOUBLE)
          / CAST(SUM(w) OVER () - COALESCE(SUM(w) OVER p, 0) AS DOUBLE) AS level
  FROM weighted
  WINDOW p AS (ORDER BY CAST(cap AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, LEAST(CAST(cap AS DOUBLE), MAX(level) OVER () * w) AS target FROM levels),
plans AS (
  SELECT *, LEAST(CAST(FLOOR(target) AS BIGINT), source_size * 3) AS budget FROM targets),
grouped AS (
  SELECT source, k, CAST(SUM(size) AS BIGINT) AS s, COUNT(*) AS n FROM docs GROUP BY source, k),
running AS (
  SELECT *, COALESCE(SUM(s) OVER (PARTITION BY source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
  FROM grouped)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, p.source_size, p.target,
       CAST(CASE WHEN p.source_size = 0 THEN 0 ELSE
         (p.budget // p.source_size) * d.size
         + LEAST(d.size, GREATEST(0, LEAST(p.budget % p.source_size - r.b, r.s)) // r.n) END AS BIGINT) AS taken
FROM docs d
JOIN plans p ON d.source IS NOT DISTINCT FROM p.source
JOIN running r ON d.source IS NOT DISTINCT FROM r.source AND d.k = r.k
"""

NEGATIVES_SQL = """
WITH whole AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.id <> b.id AND a.id % 50 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT s.same
  AND 100 * s.score BETWEEN 50 * p.positive_score AND 95 * p.positive_score
QUALIFY rank <= 3
"""

EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(COALESCE(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY COALESCE(text, ''))
"""

ORACLES = {"op7_mixing": MIX_SQL, "op12_hard_negatives": NEGATIVES_SQL, "op13_exact_dedup": EXACT_SQL}
