"""The operators as queries over the given tables, and as SQL where SQL can state them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offer_engine.llm import alignment, chat, exact_dedup, language, mixing, near_duplicates, neighbours, packing, passages, pseudonyms, repair, repair_sql, sharding, toxicity

#: Stands in for a secret that a real job would be handed.
KEY = "key of the registered query"


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def op1_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(documents(spark, sf), columns=["doc_id"])


def op2_chat(spark: SparkSession, sf: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf}/conversations.parquet")
    return chat.linked_calls(chat.from_turns(conversations), chat.TURN_SCHEMAS)


def op3_packing(spark: SparkSession, sf: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.with_checksum(packing.pack(documents(spark, sf), vocabulary))


def op4_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    found = near_duplicates.near_classes(documents(spark, sf))
    return found.select(F.col("key").alias("doc_id"), "class_id", "links")


def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return toxicity.score(documents(spark, sf), labels, columns=["doc_id"])


def op6_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    return pseudonyms.pseudonymised(documents(spark, sf), KEY, columns=["doc_id"])


def op7_language(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(documents(spark, sf), columns=["doc_id"])


def op8_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    embeddings = spark.read.parquet(f"{sf}/embeddings.parquet")
    return neighbours.search(embeddings, F.col("vec_id") % 100 == 0)


def op9_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf), columns=["doc_id"])


def op10_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard(documents(spark, sf), columns=["doc_id"])


def op11_repair(spark: SparkSession, sf: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf}/conversations.parquet")
    return repair.repair_report(repair.damaged(conversations), conversations)


def op12_passages(spark: SparkSession, sf: str) -> DataFrame:
    return passages.without_repeats(documents(spark, sf), columns=["doc_id"]).drop("spans")


def op13_alignment(spark: SparkSession, sf: str) -> DataFrame:
    first = public_tokenizers.path("byte_bpe_50k.json")
    second = public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(documents(spark, sf), first, second, columns=["doc_id"])


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_chat": op2_chat,
    "op3_packing": op3_packing,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_toxicity": op5_toxicity,
    "op6_pseudonyms": op6_pseudonyms,
    "op7_language": op7_language,
    "op8_neighbours": op8_neighbours,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_sharding": op10_sharding,
    "op11_repair": op11_repair,
    "op12_passages": op12_passages,
    "op13_alignment": op13_alignment,
}

ORACLE = {
    "op12_passages": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words
  FROM documents
), w AS (
  SELECT r, doc_id, i, array_to_string(words[i : i + 49], ' ') AS span
  FROM (SELECT *, unnest(range(1, len(words) - 48)) AS i FROM d)
), f AS (
  SELECT r, i FROM w JOIN (SELECT span, min(doc_id) AS least FROM w GROUP BY span) USING (span) WHERE least < doc_id
), p AS (
  SELECT r, i, word, coalesce(max(hit) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM (SELECT r, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word FROM d) LEFT JOIN (SELECT *, 1 AS hit FROM f) USING (r, i)
), k AS (
  SELECT r, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM p GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
""",
    "op11_repair": repair_sql.SQL,
    "op1_mixing": r"""
WITH d AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT source, source_size, 2 * source_size AS lim, weight,
    (2 * source_size)::DOUBLE / weight AS reach
  FROM (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
        FROM s)
), l AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM w)::DOUBLE - coalesce(sum(lim) OVER (
      ORDER BY reach, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / (sum(weight) OVER (
      ORDER BY reach, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM w
), t AS (
  SELECT source, source_size, least(weight * (SELECT level FROM l WHERE level <= reach
      ORDER BY reach, source NULLS LAST LIMIT 1), lim::DOUBLE) AS target
  FROM l
), n AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole
  FROM t
), c AS (
  SELECT d.*, n.source_size, n.target, n.whole, n.target - n.whole * n.source_size AS need,
    sum(size) OVER (PARTITION BY d.source ORDER BY hash RANGE BETWEEN UNBOUNDED PRECEDING
      AND CURRENT ROW) AS through,
    sum(size) OVER (PARTITION BY d.source, hash) AS own
  FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source
)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN through <= need OR (through - own <= need
    AND 2 * (need - (through - own)) > own) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
""",
    "op9_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
""",
}
