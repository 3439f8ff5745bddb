"""The registered queries ``opN_<name>`` and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.llm import bpe, embed_dedup, license_scan, mixing, pii, quality, simhash, suffix_dedup, toxicity, warc
from loomtext.llm.common import table, word_count


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = mixing.mix(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    return out.select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS key
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rk
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 2 * source_size AS cap FROM totals),
stops AS (SELECT *, CAST(cap AS DOUBLE) / w AS stop_at FROM weighed),
levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
     - CAST(coalesce(sum(cap) OVER (ORDER BY stop_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
     / CAST(sum(w) OVER (ORDER BY stop_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM stops),
free AS (SELECT arg_min(level, stop_at) AS free_level FROM levels WHERE level < stop_at),
targets AS (
  SELECT source AS s, source_size,
         CASE WHEN free_level IS NULL OR stop_at <= free_level THEN CAST(cap AS DOUBLE) ELSE w * free_level END AS target
  FROM levels CROSS JOIN free),
placed AS (
  SELECT doc_id, size, source_size, target, CAST(round(target) AS BIGINT) AS budget,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized JOIN targets ON source IS NOT DISTINCT FROM s),
epochs AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS full_epochs FROM placed)
SELECT doc_id, size, source_size, target,
       CAST(full_epochs * size + least(greatest(budget - full_epochs * source_size - before, 0), size) AS BIGINT) AS taken
FROM epochs
"""


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op3_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, read = warc.archive(table(spark, sf_dir, "pages"), payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes >= 1000) END AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM q
"""


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op6_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"))


def op7_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/lang/doc_id``: the table has no paths of its own."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.col("doc_id").cast("string"))
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), path.alias("path"), "text")
    return license_scan.scan(files).withColumnRenamed("id", "doc_id")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_source_mixing": op1_source_mixing,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_warc_index_merge": op3_warc_index_merge,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_pii_pseudonyms": op6_pii_pseudonyms,
    "op7_quality_llr": op7_quality_llr,
    "op8_license_scan": op8_license_scan,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_toxicity_ftrl": op10_toxicity_ftrl,
}
SQL = {"op1_source_mixing": OP1_SQL, "op3_warc_index_merge": OP3_SQL}
