"""Registered queries and their SQL. Every query reads its tables whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.functions import text as X
from loomtext.functions.lexicon import LABELS, RATIO_SHENG, RATIO_SWAHILI, SHENG, SWAHILI
from loomtext.operators import clean, joins, packing, parsing, providers, rules, sampling, telemetry
from loomtext.plans import cascade
from loomtext.sources import jsonl, sinks
from loomtext.sources.tables import spread
from loomtext.streaming import labels as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spread(spark.read.parquet(f"{d}/documents.parquet"))


def _items(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select(F.col("doc_id").cast("string").alias("id"), "text")


def _turns(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/conversations.parquet")


def _events(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet")


def _marks(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/labels.parquet")


def _list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
TOKENS = "regexp_extract_all(lower({}), '[a-z'']+')"
WORDS = r"regexp_extract_all({}, '\S+')"
HASH_LABEL = f"list_extract({_list(LABELS)}, CAST(CAST('0x' || substr(md5({{}}), 1, 8) AS BIGINT) % 4 AS INTEGER) + 1)"


def _rule_sql(rows: str) -> str:
    """CTEs that end in ``ruled``: the columns of ``rows`` (one is text) with counts and the lexicon label."""
    return rf"""
base AS ({rows}),
tok AS (SELECT *, {TOKENS.format('text')} AS tokens, CAST(length(regexp_replace(text, '[^\p{{L}}]', '', 'g')) AS BIGINT) AS n_letters FROM base),
cnt AS (SELECT * EXCLUDE (tokens), CAST(len(tokens) AS BIGINT) AS n_tokens,
   CAST(len(list_intersect(tokens, {_list(SWAHILI)})) AS BIGINT) AS n_sw, CAST(len(list_intersect(tokens, {_list(SHENG)})) AS BIGINT) AS n_sh FROM tok),
ruled AS (SELECT *, CASE WHEN n_letters < 3 OR n_tokens = 0 THEN NULL WHEN n_sw = 0 AND n_sh = 0 AND n_tokens >= 4 THEN 'English'
   WHEN n_sw >= 3 AND n_sh = 0 THEN 'Swahili' WHEN n_sh >= 1 THEN 'Sheng' WHEN n_sw BETWEEN 1 AND 2 THEN 'English and Swahili' END AS label FROM cnt)"""


# cleaning, gates, scalars

_EXTRA = [("x1", "[Deleted]"), ("x2", " [removed] "), ("x3", "   "), ("x4", None), (None, " no id ")]
_EXTRA_SQL = "VALUES ('x1', '[Deleted]'), ('x2', ' [removed] '), ('x3', '   '), ('x4', NULL), (NULL, ' no id ')"
_RAW_SQL = f"SELECT CAST(doc_id AS VARCHAR) AS id, text AS body FROM documents UNION ALL SELECT * FROM ({_EXTRA_SQL}) v(id, body)"


def _raw(spark: SparkSession, d: str) -> DataFrame:
    """The documents, and rows of each kind that cleaning drops or repairs."""
    return _items(spark, d).withColumnRenamed("text", "body").unionByName(spark.createDataFrame(_EXTRA, "id string, body string"))


@_query(f"WITH raw AS ({_RAW_SQL}), s AS (SELECT coalesce(id, '') AS id, {STRIP.format('body')} AS body FROM raw) SELECT id, body FROM s WHERE body <> '' AND lower(body) NOT IN ('[deleted]', '[removed]')")
def clean_comments(spark, d):
    return clean.clean_comments(_raw(spark, d))


@_query(f"""WITH raw AS ({_RAW_SQL}), s AS (SELECT id, {STRIP.format('body')} AS t FROM raw)
SELECT CASE WHEN coalesce(id, '') = '' THEN 'missing_id' WHEN coalesce(t, '') = '' THEN 'blank_text' WHEN length(t) < 3 THEN 'too_short' ELSE 'kept' END AS reason, count(*) AS n FROM s GROUP BY 1""")
def skip_reason_counts(spark, d):
    return clean.skip_reasons(_raw(spark, d).withColumnRenamed("body", "text"))


@_query("SELECT doc_id, text FROM documents WHERE regexp_matches(text, '[''\"]')")
def quote_gate(spark, d):
    return _docs(spark, d).where(clean.quote_gate(F.col("text"))).select("doc_id", "text")


@_query(f"SELECT conv_id, turn, length({STRIP.format('text')}) >= 2 AS min2, length({STRIP.format('text')}) >= 3 AS min3, {STRIP.format('text')} <> '' AS not_blank FROM conversations")
def min_length_gate(spark, d):
    t = F.col("text")
    return _turns(spark, d).select("conv_id", "turn", clean.min_length(t, 2).alias("min2"), clean.min_length(t, 3).alias("min3"), clean.not_blank(t).alias("not_blank"))


@_query(f"""WITH w AS (SELECT doc_id, text, {WORDS.format('text')} AS words FROM documents)
SELECT doc_id, md5(CASE WHEN len(words) > 500 THEN array_to_string(words[1:500], ' ') ELSE text END) AS capped_md5, CAST(len(words) AS BIGINT) AS n_words FROM w""")
def word_cap_500(spark, d):
    t = F.col("text")
    return _docs(spark, d).select("doc_id", F.md5(X.word_cap(t)).alias("capped_md5"), F.size(X.words(t)).cast("long").alias("n_words"))


@_query("SELECT doc_id, md5(substr(text, 1, 800)) AS p800, md5(substr(text, 1, 1500)) AS p1500 FROM documents")
def char_prefixes(spark, d):
    t = F.col("text")
    return _docs(spark, d).select("doc_id", F.md5(X.prefix(t, 800)).alias("p800"), F.md5(X.prefix(t, 1500)).alias("p1500"))


@_query(f"""WITH w AS (SELECT doc_id, text, {WORDS.format('text')} AS words FROM documents),
e AS (SELECT *, greatest(CAST(len(words) AS BIGINT), CAST(length(text) AS BIGINT) * 32 // 100) AS tokens FROM w)
SELECT doc_id, tokens, md5(CASE WHEN tokens > 600 THEN array_to_string(words[1:2500], ' ') ELSE text END) AS capped_md5 FROM e""")
def token_estimate(spark, d):
    t = F.col("text")
    return _docs(spark, d).select("doc_id", X.token_estimate(t).alias("tokens"), F.md5(X.token_cap(t)).alias("capped_md5"))


@_query(f"SELECT CASE WHEN text <> '' THEN text ELSE coalesce(role, '') END AS picked, lower(replace(role, ' ', '_')) AS slug, conv_id, turn, CAST(length(regexp_replace(text, '[^\\p{{L}}]', '', 'g')) AS BIGINT) AS letters FROM conversations")
def falsy_and_slugs(spark, d):
    return _turns(spark, d).select(X.falsy_coalesce(F.col("text"), F.col("role")).alias("picked"), X.slug(F.col("role")).alias("slug"), "conv_id", "turn", X.letter_count(F.col("text")).cast("long").alias("letters"))


@_query("""WITH n AS (SELECT doc_id, CASE WHEN lang = 'en' THEN source END AS sid FROM documents),
r AS (SELECT doc_id, sid, sum(CASE WHEN sid IS NULL THEN 1 ELSE 0 END) OVER (ORDER BY doc_id) AS k, row_number() OVER (ORDER BY doc_id) AS a FROM n)
SELECT doc_id, coalesce(sid, 'auto_' || CAST(k AS BIGINT)) AS id_missing, coalesce(sid, 'auto_' || a) AS id_all FROM r""")
def synthetic_ids(spark, d):
    rows = _docs(spark, d).select("doc_id", F.when(F.col("lang") == "en", F.col("source")).alias("sid"))
    a = clean.numbered_ids(rows.withColumnRenamed("sid", "id_missing"), "doc_id", "id_missing")
    b = clean.numbered_ids(rows.withColumnRenamed("sid", "id_all"), "doc_id", "id_all", count_all=True)
    return a.join(b, "doc_id").select("doc_id", "id_missing", "id_all")


@_query("SELECT page_id, CASE WHEN url <> '' AND url LIKE 'https%' THEN url ELSE md5(html) END AS id FROM pages")
def content_hash_ids(spark, d):
    pages = spark.read.parquet(f"{d}/pages.parquet").withColumn("id", F.when(F.col("url").startswith("https"), F.col("url")))
    return clean.content_id(pages, "html").select("page_id", "id")


# rules


@_query("WITH " + _rule_sql("SELECT doc_id, text FROM documents") + " SELECT doc_id, n_letters, n_tokens, n_sw, n_sh, label FROM ruled")
def lexicon_label(spark, d):
    out = rules.lexicon_counts(_docs(spark, d).select("doc_id", "text")).withColumn("label", rules.lexicon_rule())
    return out.select("doc_id", *[F.col(c).cast("long").alias(c) for c in ("n_letters", "n_tokens", "n_sw", "n_sh")], "label")


@_query("WITH " + _rule_sql("SELECT doc_id, text FROM documents") + f", dom AS (SELECT unnest({_list((*LABELS, 'Unknown'))}) AS label) SELECT dom.label, count(ruled.doc_id) AS n FROM dom LEFT JOIN ruled ON dom.label = coalesce(ruled.label, 'Unknown') GROUP BY 1")
def lexicon_label_counts(spark, d):
    labelled = rules.lexicon_counts(_docs(spark, d).select("doc_id", "text")).select(rules.lexicon_rule().alias("label"))
    return joins.label_counts(labelled, F.col("label"), LABELS)


@_query("WITH " + _rule_sql("SELECT role, text FROM conversations") + " SELECT role, coalesce(label, 'Unknown') AS label, count(*) AS n FROM ruled GROUP BY 1, 2")
def lexicon_label_turns(spark, d):
    labelled = rules.lexicon_counts(_turns(spark, d).select("role", "text")).withColumn("label", F.coalesce(rules.lexicon_rule(), F.lit("Unknown")))
    return labelled.groupBy("role", "label").agg(F.count("*").alias("n"))


_SENTENCES = rf"""
wf AS (SELECT w, log10(count(*) * 1e9 / (SELECT count(*) FROM (SELECT unnest({TOKENS.format('text')}) FROM documents WHERE lang = 'en'))) AS zipf
  FROM (SELECT unnest({TOKENS.format('text')}) AS w FROM documents WHERE lang = 'en') GROUP BY w),
pieces AS (SELECT doc_id AS line_id, list_filter(list_transform(regexp_split_to_array(text, '[.!?]+'), lambda s: {STRIP.format('s')}), lambda s: s <> '') AS p FROM documents),
sent AS (SELECT line_id, unnest(p) AS text, unnest(range(1, len(p) + 1)) AS sent_id FROM pieces),
stok AS (SELECT *, {TOKENS.format('text')} AS tokens FROM sent),
words AS (SELECT line_id, sent_id, unnest(tokens) AS w FROM stok),
per AS (SELECT line_id, sent_id, count(*) AS total_tokens, CAST(sum(CASE WHEN zipf >= 5.5 THEN 1 ELSE 0 END) AS BIGINT) AS en_tokens FROM words LEFT JOIN wf USING (w) GROUP BY 1, 2),
shares AS (SELECT line_id, sent_id, CASE WHEN total_tokens < 3 THEN 'short' WHEN en_tokens / total_tokens >= 0.95 THEN 'English' WHEN en_tokens / total_tokens >= 0.80 THEN 'code_mix_light'
  WHEN en_tokens / total_tokens >= 0.50 THEN 'light_swahili' ELSE 'heavy_swahili' END AS label, total_tokens, en_tokens, round(en_tokens / total_tokens, 3) AS en_ratio, text FROM stok JOIN per USING (line_id, sent_id))"""


def _shares(spark, d):
    docs = _docs(spark, d)
    zipf = rules.word_zipf(docs.where("lang = 'en'").select("text"))
    return rules.sentence_shares(docs.select(F.col("doc_id").alias("line_id"), "text"), zipf, 5.5)


@_query("WITH " + _SENTENCES + " SELECT line_id, sent_id, label, total_tokens, en_tokens, en_ratio, text FROM shares")
def sentence_english_ratio(spark, d):
    return _shares(spark, d)


@_query("WITH " + _SENTENCES + " SELECT label, count(*) AS n FROM shares GROUP BY 1")
def sentence_label_counts(spark, d):
    return _shares(spark, d).groupBy("label").agg(F.count("*").alias("n"))


# A stand-in for a word language model: the language in which a word is most frequent (Spanish stands for Swahili).
_LID = f"""
occ AS (SELECT doc_id, lang, unnest({TOKENS.format('text')}) AS word FROM documents),
wl AS (SELECT word, lang, count(*) AS n FROM occ GROUP BY 1, 2),
lid AS (SELECT word, CASE arg_min(lang, struct_pack(a := -n, b := lang)) WHEN 'es' THEN 'sw' ELSE arg_min(lang, struct_pack(a := -n, b := lang)) END AS lang, max(n) / sum(n) AS prob FROM wl GROUP BY 1),
tags AS (SELECT occ.doc_id AS doc_id, word, CASE WHEN list_contains({_list(RATIO_SHENG)}, word) THEN 'Sheng' WHEN list_contains({_list(RATIO_SWAHILI)}, word) THEN 'Swahili'
  WHEN prob > 0.7 AND lid.lang = 'en' THEN 'English' WHEN prob > 0.7 AND lid.lang = 'sw' THEN 'Swahili' ELSE 'Unknown' END AS tag FROM occ JOIN lid USING (word))"""


def _word_lid(docs: DataFrame) -> DataFrame:
    lid = providers.corpus_word_lid(docs.select("text", "lang"), X.tokens(F.col("text")))
    return lid.withColumn("lang", F.when(F.col("lang") == "es", "sw").otherwise(F.col("lang")))


@_query("WITH " + _LID + " SELECT tag, count(*) AS n_tokens, count(DISTINCT word) AS n_words FROM tags GROUP BY 1")
def token_tag_counts(spark, d):
    docs = _docs(spark, d)
    tags = rules.token_tags(docs.select(F.col("doc_id").alias("id"), "text"), _word_lid(docs))
    by_word = tags.groupBy("tag", "word").agg(F.count("*").alias("n"))
    return by_word.groupBy("tag").agg(F.sum("n").alias("n_tokens"), F.count("*").alias("n_words"))


@_query("WITH " + _LID + """,
sums AS (SELECT doc_id, count(*) AS n, sum(CASE WHEN tag = 'English' THEN 1 ELSE 0 END) AS en, sum(CASE WHEN tag = 'Swahili' THEN 1 ELSE 0 END) AS sw, sum(CASE WHEN tag = 'Sheng' THEN 1 ELSE 0 END) AS sh FROM tags GROUP BY 1),
r AS (SELECT d.doc_id AS doc_id, coalesce(n, 0) AS n_tokens, coalesce(CAST(en AS DOUBLE) / n, 0.0::DOUBLE) AS en_ratio, coalesce(CAST(sw AS DOUBLE) / n, 0.0::DOUBLE) AS sw_ratio, coalesce(CAST(sh AS DOUBLE) / n, 0.0::DOUBLE) AS sh_ratio FROM documents d LEFT JOIN sums USING (doc_id))
SELECT doc_id, n_tokens, en_ratio, sw_ratio, sh_ratio, CASE WHEN sh_ratio > 0.2 AND sh_ratio > sw_ratio AND sh_ratio > en_ratio THEN 'Sheng' WHEN sw_ratio > 0.7 AND sw_ratio > sh_ratio THEN 'Swahili'
  WHEN en_ratio > 0.8 AND sw_ratio < 0.1 THEN 'English' WHEN sw_ratio > 0.2 AND sw_ratio < 0.6 AND en_ratio > 0.2 THEN 'English and Swahili' END AS label FROM r""")
def ratio_label(spark, d):
    docs = _docs(spark, d)
    r = rules.token_ratios(docs.select(F.col("doc_id").alias("id"), "text"), _word_lid(docs))
    label = rules.ratio_rule(F.col("en_ratio"), F.col("sw_ratio"), F.col("sh_ratio"))
    return r.select(F.col("id").alias("doc_id"), "n_tokens", "en_ratio", "sw_ratio", "sh_ratio", label.alias("label"))


# keys, joins, caches, merges


@_query("SELECT md5(text) AS h, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def text_hash_dups(spark, d):
    return joins.hash_groups(_docs(spark, d))


@_query("SELECT md5(text) AS h, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def first_per_hash(spark, d):
    return joins.first_of_hash(_docs(spark, d).select("doc_id", "text"), "doc_id").select("h", "doc_id")


@_query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def resume_anti_join(spark, d):
    return joins.unprocessed(_docs(spark, d).select("doc_id", "lang"), _marks(spark, d), "doc_id")


# Labels as a language: quality and toxicity give one of the four, so that merges have something to merge.
_LANG_SQL = "CASE WHEN toxic = 1 THEN 'Sheng' WHEN quality = 1 THEN 'English' WHEN quality = 0 THEN 'Swahili' END"


def _language() -> Column:
    return F.when(F.col("toxic") == 1, "Sheng").when(F.col("quality") == 1, "English").when(F.col("quality") == 0, "Swahili")


_CACHE_SQL = f"cache AS (SELECT md5(text) AS h, max_by({_LANG_SQL}, doc_id) AS label FROM documents JOIN labels USING (doc_id) GROUP BY 1)"


def _cache(spark, d):
    keys = _docs(spark, d).select("doc_id", X.hash_key(F.col("text")).alias("h"))  # before the join, which may deal its rows: no texts
    rows = keys.join(_marks(spark, d), "doc_id").select("doc_id", "h", _language().alias("label"))
    return joins.last_wins(rows, "h", "label", "doc_id")


@_query(f"WITH {_CACHE_SQL} SELECT doc_id, md5(text) AS h, label FROM documents LEFT JOIN cache ON md5(text) = h")
def cache_probe(spark, d):
    return joins.probe_cache(_docs(spark, d).select("doc_id", "text"), _cache(spark, d)).select("doc_id", "h", "label")


@_query(f"""WITH {_CACHE_SQL}, fresh AS (SELECT md5(text) AS h, max_by(lang, doc_id) AS label FROM documents WHERE lang <> 'en' GROUP BY 1)
SELECT h, label FROM fresh UNION ALL SELECT h, label FROM cache WHERE h NOT IN (SELECT h FROM fresh)""")
def cache_upsert(spark, d):
    new = _docs(spark, d).where("lang <> 'en'").select(X.hash_key(F.col("text")).alias("h"), F.col("lang").alias("label"), "doc_id")
    return joins.upsert_cache(_cache(spark, d), new, "doc_id")


@_query(f"WITH {_CACHE_SQL} SELECT h, label FROM cache WHERE h NOT IN (SELECT md5(text) FROM documents WHERE lang = 'fr')")
def cache_delete(spark, d):
    return joins.delete_from_cache(_cache(spark, d), _docs(spark, d).where("lang = 'fr'").select(X.hash_key(F.col("text")).alias("h")))


_MERGE_SQL = f"""
lab AS (SELECT CAST(doc_id AS VARCHAR) AS id, {_LANG_SQL} AS language FROM labels),
merged AS (SELECT CAST(d.doc_id AS VARCHAR) AS id, d.text AS body, lab.language AS language FROM documents d LEFT JOIN lab ON CAST(d.doc_id AS VARCHAR) = lab.id WHERE {STRIP.format('d.text')} <> '')"""


def _merged(spark, d):
    labels = _marks(spark, d).select(F.col("doc_id").cast("string").alias("id"), _language().alias("language"), "doc_id")
    return joins.merge_labels(_items(spark, d).withColumnRenamed("text", "body"), labels, "doc_id")


@_query("WITH " + _MERGE_SQL + " SELECT id, body, language, CASE WHEN language IS NULL THEN 'unknown' ELSE lower(replace(language, ' ', '_')) END AS slug FROM merged")
def merge_labels(spark, d):
    return _merged(spark, d)


@_query("WITH " + _MERGE_SQL + " SELECT (SELECT count(*) FROM documents) AS total, count(language) AS matched FROM merged")
def merge_match_counts(spark, d):
    total = _docs(spark, d).agg(F.count("*").alias("total"))
    return total.join(_merged(spark, d).agg(F.count("language").alias("matched")), F.lit(True))


@_query("WITH " + _rule_sql("SELECT doc_id, text FROM documents") + " SELECT doc_id, label, lower(replace(label, ' ', '_')) AS slug, CASE label WHEN 'English and Swahili' THEN 'mixed' WHEN 'Swahili' THEN 'swahili' WHEN 'Sheng' THEN 'sheng' WHEN 'English' THEN 'english' END AS short_slug FROM ruled")
def label_split_slug(spark, d):
    out = rules.lexicon_counts(_docs(spark, d).select("doc_id", "text")).withColumn("label", rules.lexicon_rule())
    return out.select("doc_id", "label", X.slug(F.col("label")).alias("slug"), X.short_slug(F.col("label")).alias("short_slug"))


@_query("SELECT lang AS label, count(*) AS n FROM documents GROUP BY 1")
def open_label_counts(spark, d):
    return joins.label_counts(_docs(spark, d), F.col("lang"))


@_query("SELECT l.label, count(d.doc_id) AS n FROM (VALUES ('en'), ('sw'), ('unexpected_label')) l(label) LEFT JOIN documents d ON l.label = CASE WHEN d.lang IN ('en', 'sw') THEN d.lang ELSE 'unexpected_label' END GROUP BY 1")
def closed_label_counts(spark, d):
    return joins.label_counts(_docs(spark, d), F.col("lang"), ("en", "sw"), "unexpected_label")


@_query("SELECT count(DISTINCT doc_id) AS n_done, (SELECT count(*) FROM documents) AS n_all, round(count(DISTINCT doc_id) * 100.0 / (SELECT count(*) FROM documents), 6) AS percent FROM labels")
def checkpoint_progress(spark, d):
    done = _marks(spark, d).agg(F.count_distinct("doc_id").alias("n_done"))
    both = done.join(_docs(spark, d).agg(F.count("*").alias("n_all")), F.lit(True))
    return both.withColumn("percent", F.round(X.percent_done(F.col("n_done"), F.col("n_all")), 6))


@_query("SELECT * FROM (SELECT role, conv_id, turn, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS r FROM conversations) WHERE r = 1".replace("*", "conv_id, role, turn, text", 1))
def first_wins_by_role(spark, d):
    key = F.concat_ws("/", F.col("conv_id").cast("string"), "role")
    first = joins.first_wins(_turns(spark, d).withColumn("k", key), "k", "turn")
    return first.select("conv_id", "role", "turn", "text")


@_query(f"""WITH res AS (SELECT doc_id AS id, CASE WHEN quality = 1 THEN '' ELSE 'kept' END AS text, {_LANG_SQL} AS language FROM labels)
SELECT res.id AS id, CASE WHEN res.text <> '' THEN res.text ELSE coalesce(d.text, '') END AS text, language FROM res LEFT JOIN documents d ON d.doc_id = res.id""")
def align_results(spark, d):
    res = _marks(spark, d).select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "").otherwise("kept").alias("text"), _language().alias("language"))
    return joins.align_results(res, _docs(spark, d).select(F.col("doc_id").alias("id"), "text"))


@_query("SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents WHERE CAST(doc_id AS VARCHAR) NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE quality = 1)")
def missing_from_batch(spark, d):
    results = _marks(spark, d).select(F.col("doc_id").cast("string").alias("id"), F.when(F.col("quality") == 1, "English").alias("language"))
    return joins.missing_from_results(_items(spark, d), results)


@_query(f"""WITH told AS (SELECT doc_id, CASE WHEN quality = 1 THEN {HASH_LABEL.format('text')} END AS language FROM labels JOIN documents USING (doc_id)),
e AS (SELECT doc_id, {HASH_LABEL.format("text || lang")} AS expected FROM documents)
SELECT CASE WHEN language IS NULL THEN 'missing' WHEN language = expected THEN 'match' ELSE 'mismatch' END AS outcome, count(*) AS n FROM e LEFT JOIN told USING (doc_id) GROUP BY 1""")
def recheck_outcomes(spark, d):
    docs = _docs(spark, d)
    expected = docs.select(F.col("doc_id").alias("recheck_id"), providers.hash_label(F.concat("text", "lang")).alias("expected"))
    told = docs.join(_marks(spark, d).where("quality = 1").select("doc_id"), "doc_id").select(F.col("doc_id").alias("recheck_id"), providers.hash_label(F.col("text")).alias("language"))
    return joins.recheck_outcomes(expected, told).groupBy("outcome").agg(F.count("*").alias("n"))


# batches and samples


def _sized(spark, d):
    docs = _docs(spark, d).select("doc_id", X.token_estimate(F.col("text")).alias("tokens"))
    return docs.withColumn("shard", packing.shard_of(F.col("doc_id")))


@_query("SELECT conv_id, turn, CAST(floor((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) / 4) AS BIGINT) AS batch FROM conversations")
def fixed_batches(spark, d):
    return packing.fixed_batches(_turns(spark, d), "turn", 4, "conv_id").select("conv_id", "turn", "batch")


def _pack_sql(carry: str) -> str:
    return rf"""WITH RECURSIVE w AS (SELECT doc_id, doc_id // 1000 AS shard, greatest(CAST(len({WORDS.format('text')}) AS BIGINT), CAST(length(text) AS BIGINT) * 32 // 100) AS tokens FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY doc_id) AS k FROM w),
f AS (SELECT shard, doc_id, tokens, k, {carry.format(b='CAST(0 AS BIGINT)', s='CAST(0 AS BIGINT)', c='CAST(0 AS BIGINT)', t='tokens')} FROM n WHERE k = 1
  UNION ALL SELECT n.shard, n.doc_id, n.tokens, n.k, {carry.format(b='f.b', s='f.s', c='f.c', t='n.tokens')} FROM f JOIN n ON n.shard = f.shard AND n.k = f.k + 1)
SELECT shard, doc_id, tokens, batch FROM f"""


_GREEDY = "(({c}) > 0 AND (({s}) + {t} > 2500 OR ({c}) >= 15))"
_SUM_OVER = "(({s}) + {t} > 7000 OR ({c}) + 1 >= 40)"


@_query(_pack_sql(f"CAST(({{b}}) + CASE WHEN {_GREEDY} THEN 1 ELSE 0 END AS BIGINT) AS batch, CAST(({{b}}) + CASE WHEN {_GREEDY} THEN 1 ELSE 0 END AS BIGINT) AS b, CAST(CASE WHEN {_GREEDY} THEN 0 ELSE ({{s}}) END + {{t}} AS BIGINT) AS s, CAST(CASE WHEN {_GREEDY} THEN 0 ELSE ({{c}}) END + 1 AS BIGINT) AS c"))
def budget_batches(spark, d):
    return packing.budget_batches(_sized(spark, d), "shard", "doc_id", "tokens")


@_query(_pack_sql(f"CAST(({{b}}) AS BIGINT) AS batch, CAST(({{b}}) + CASE WHEN {_SUM_OVER} THEN 1 ELSE 0 END AS BIGINT) AS b, CAST(CASE WHEN {_SUM_OVER} THEN 0 ELSE ({{s}}) + {{t}} END AS BIGINT) AS s, CAST(CASE WHEN {_SUM_OVER} THEN 0 ELSE ({{c}}) + 1 END AS BIGINT) AS c"))
def flush_batches(spark, d):
    return packing.flush_batches(_sized(spark, d), "shard", "doc_id", "tokens")


@_query("SELECT doc_id, lang FROM documents ORDER BY md5('s7' || doc_id), doc_id LIMIT 100")
def seeded_sample(spark, d):
    return sampling.sample_n(_docs(spark, d).select("doc_id", "lang"), 100, "s7", "doc_id")


@_query("SELECT doc_id, 'cache' AS origin FROM documents WHERE CAST('0x' || substr(md5('c1' || doc_id), 1, 8) AS BIGINT) < CAST(floor(0.02 * 4294967296) AS BIGINT) UNION ALL SELECT doc_id, 'rule' FROM documents WHERE CAST('0x' || substr(md5('r1' || doc_id), 1, 8) AS BIGINT) < CAST(floor(0.08 * 4294967296) AS BIGINT)")
def bernoulli_recheck_sample(spark, d):
    docs = _docs(spark, d).select("doc_id")
    return sampling.bernoulli(docs, 0.02, "c1", "doc_id").withColumn("origin", F.lit("cache")).unionByName(sampling.bernoulli(docs, 0.08, "r1", "doc_id").withColumn("origin", F.lit("rule")))


# parsing


@_query("SELECT event_id, json_extract_string(props, '$.k') AS k, json_type(props) = 'OBJECT' AS is_object FROM events")
def parse_json_field(spark, d):
    return _events(spark, d).select("event_id", F.get_json_object("props", "$.k").alias("k"), parsing.is_object(F.col("props")).alias("is_object"))


@_query("SELECT event_id, event_type AS language FROM events")
def salvage_json_array(spark, d):
    body = F.to_json(F.array(F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("language"))))
    rows = _events(spark, d).select(parsing.salvaged_array(F.concat(F.lit("Sure: "), body, F.lit(" done"))).alias("r"))
    return rows.select(F.explode("r").alias("r")).select(F.col("r.id").cast("long").alias("event_id"), F.col("r.language").alias("language"))


@_query("SELECT event_id, event_type AS language, CAST(0 AS INTEGER) AS invalid FROM events")
def lenient_responses(spark, d):
    body = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("language")))
    rows = _events(spark, d).select(parsing.lenient(F.concat(F.lit("- "), body, F.lit(" ;\n\n"))).alias("r"))
    return rows.select(F.explode("r.results").alias("x"), F.col("r.invalid").alias("invalid")).select(F.col("x.id").cast("long").alias("event_id"), F.col("x.language").alias("language"), "invalid")


# telemetry


def _log(spark, d):
    cents = _events(spark, d).select("event_id", "user_id", "ts", "event_type", F.round(F.col("value") * 100).cast("long").alias("cents"))
    return telemetry.running_total(cents, "user_id", "ts", "cents").withColumnRenamed("running_total", "total")


_LOG_SQL = "log AS (SELECT event_id, user_id, ts, event_type, CAST(round(value * 100) AS BIGINT) AS cents, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM events)"


@_query(f"WITH {_LOG_SQL} SELECT event_id, user_id, total FROM log")
def running_totals(spark, d):
    return _log(spark, d).select("event_id", "user_id", "total")


@_query(f"""WITH {_LOG_SQL}, w AS (SELECT event_id, epoch_us(ts) - first(epoch_us(ts)) OVER f AS span, total - first(total) OVER f AS grown FROM log
  WINDOW f AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 1800000000 PRECEDING AND CURRENT ROW))
SELECT event_id, CASE WHEN span > 0 THEN round(grown * 1e6 / span, 6) END AS rate FROM w""")
def trailing_rate_30m(spark, d):
    return telemetry.trailing_rate(_log(spark, d), "user_id", "ts", "total").select("event_id", F.round("rate", 6).alias("rate"))


@_query(f"""WITH {_LOG_SQL}, w AS (SELECT event_id, epoch_us(ts) - lag(epoch_us(ts)) OVER f AS span, total - lag(total) OVER f AS grown FROM log WINDOW f AS (PARTITION BY user_id ORDER BY ts))
SELECT event_id, CASE WHEN span > 0 THEN round(grown * 1e6 / span, 6) END AS rate FROM w""")
def delta_rate(spark, d):
    return telemetry.delta_rate(_log(spark, d), "user_id", "ts", "total").select("event_id", F.round("rate", 6).alias("rate"))


@_query("""WITH RECURSIVE e AS (SELECT user_id, CAST(ts AS DATE) AS day, value, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, value) AS k FROM events),
f AS (SELECT user_id, day, k, CASE WHEN value > 0 THEN value END AS ema FROM e WHERE k = 1
  UNION ALL SELECT e.user_id, e.day, e.k, CASE WHEN e.value <= 0 THEN f.ema WHEN f.ema IS NULL THEN e.value ELSE 0.2::DOUBLE * e.value + 0.8::DOUBLE * f.ema END FROM f JOIN e ON e.user_id = f.user_id AND e.day = f.day AND e.k = f.k + 1)
SELECT user_id, day, round(arg_max(ema, k), 6) AS ema FROM f GROUP BY 1, 2""")
def ema_value(spark, d):
    runs = _events(spark, d).withColumn("day", F.to_date("ts"))
    return telemetry.ema_by_run(runs, ["user_id", "day"], "ts", "value").select("user_id", "day", F.round("ema", 6).alias("ema"))


@_query("""WITH e AS (SELECT event_id, user_id, ts, event_type <> 'error' AS success FROM events),
g AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts) - row_number() OVER (PARTITION BY user_id, success ORDER BY ts) AS g FROM e)
SELECT event_id, success, CAST(row_number() OVER (PARTITION BY user_id, success, g ORDER BY ts) AS INTEGER) AS streak FROM g""")
def outcome_streaks(spark, d):
    return telemetry.streaks(_events(spark, d), "user_id", "ts", F.col("event_type") != "error").select("event_id", "success", "streak")


@_query("""SELECT user_id, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS tokens, round(avg(value), 6) AS mean_latency, round(count(*) * 1e6 / (max(epoch_us(ts)) - min(epoch_us(ts))), 9) AS rows_per_s FROM events GROUP BY 1 HAVING max(epoch_us(ts)) > min(epoch_us(ts))""")
def throughput(spark, d):
    log = _events(spark, d).select("user_id", "ts", F.lit(1).alias("n_rows"), F.col("event_id").alias("n_tokens"), F.col("value").alias("latency"))
    out = telemetry.throughput(log, "user_id").where("rows_per_s IS NOT NULL")
    return out.select("user_id", "rows", "tokens", F.round("mean_latency", 6).alias("mean_latency"), F.round("rows_per_s", 9).alias("rows_per_s"))


@_query()
def tuner_states(spark, d):
    log = _events(spark, d).select(
        F.col("user_id").alias("run"), telemetry.micros("ts").alias("seq"), (telemetry.micros("ts") / 1e6).alias("t"), (F.col("event_type") != "error").alias("success"),
        F.col("value").alias("rate"), (F.col("value") * 2).alias("latency"), (F.col("value") * 10).alias("tokens"),
    )
    return telemetry.tune(log)


# whole plans


@_query(f"WITH {_CACHE_SQL}, " + _rule_sql("SELECT doc_id, text, md5(text) AS h FROM documents WHERE length(text) >= 2 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)").strip() + f"""
SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(cache.label, ruled.label, {HASH_LABEL.format("text")}) AS label, CASE WHEN cache.label IS NOT NULL THEN 'cache' WHEN ruled.label IS NOT NULL THEN 'rule' ELSE 'model' END AS origin
FROM ruled LEFT JOIN cache USING (h)""")
def cascade_labels(spark, d):
    done = _marks(spark, d).where("toxic = 1").select(F.col("doc_id").cast("string").alias("id"))
    preset = cascade.Preset(token_cap=False)
    return cascade.run_cascade(_items(spark, d), preset, done, _cache(spark, d)).select("id", "label", "origin")


@_query("WITH " + _rule_sql("SELECT doc_id, text FROM documents WHERE length(text) >= 2") + f", l AS (SELECT coalesce(label, {HASH_LABEL.format('text')}) AS label FROM ruled) SELECT label, count(*) AS n FROM l GROUP BY 1")
def cascade_label_counts(spark, d):
    out = cascade.run_cascade(_items(spark, d), cascade.Preset(token_cap=False))
    return out.groupBy("label").agg(F.count("*").alias("n"))


@_query(f"""WITH w AS (SELECT doc_id, text, {WORDS.format('text')} AS words FROM documents WHERE length({STRIP.format('text')}) >= 3),
c AS (SELECT doc_id, text, CASE WHEN len(words) > 500 THEN array_to_string(words[1:500], ' ') ELSE text END AS sent FROM w)
SELECT CAST(doc_id AS VARCHAR) AS id, {HASH_LABEL.format('sent')} AS label FROM c""")
def model_only_labels(spark, d):
    return cascade.run_cascade(_items(spark, d), cascade.PRESETS["v8"]).select("id", "label")


# files and streams


def _folder(spark: SparkSession, name: str) -> str:
    """A new place under the folder that driver and executors share."""
    return f"{cascade.shared_folder(spark)}/loomtext-{name}-{uuid.uuid4().hex}"


@_query("SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents WHERE text IS NOT NULL")
def jsonl_roundtrip(spark, d):
    """Documents written as JSON lines in rolling parts and read back by the tolerant reader."""
    path = _folder(spark, "jsonl")
    sinks.write_jsonl(_items(spark, d), path, part_rows=300, compression="gzip")
    return jsonl.read_jsonl(spark, path).select("id", "text")


@_query("WITH " + _rule_sql("SELECT doc_id, text FROM documents") + " SELECT CAST(doc_id AS VARCHAR) AS id, CASE label WHEN 'English and Swahili' THEN 'mixed' ELSE lower(label) END AS slug FROM ruled WHERE label IS NOT NULL")
def split_by_label_roundtrip(spark, d):
    """Labelled rows written to a folder for each label; unlabelled ones aren't written."""
    path = _folder(spark, "split")
    labelled = rules.ruled(_items(spark, d)).withColumnRenamed("label", "language")
    sinks.write_by_label(labelled, path)
    return spark.read.schema("id string, text string, language string, slug string").json(path).select("id", "slug")


@_query("SELECT CAST(doc_id AS VARCHAR) AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def checkpoint_roundtrip(spark, d):
    """Labelled ids as a checkpoint file, read back, and what a resumed run still has to do."""
    path = _folder(spark, "done")
    sinks.write_checkpoint(_marks(spark, d).select(F.col("doc_id").cast("string").alias("id")), path)
    return joins.unprocessed(_items(spark, d), jsonl.read_checkpoint(spark, path)).select("id")


@_query(f"WITH lab AS (SELECT doc_id, max({_LANG_SQL}) AS language FROM labels GROUP BY 1) SELECT CAST(doc_id AS VARCHAR) AS id, language FROM lab")
def label_files_last_wins(spark, d):
    """Label files read by name order, temporary ones left out, the last label of an id kept."""
    path = _folder(spark, "labels")
    rows = _marks(spark, d).select(F.col("doc_id").cast("string").alias("id"), _language().alias("language"))
    sinks.write_jsonl(rows, path)
    return joins.last_wins(jsonl.read_label_files(spark, path), "id", "language", "file", "language")


@_query("SELECT 'malformed_json' AS reason, 2 * count(*) AS n FROM conversations")
def malformed_line_counts(spark, d):
    """Turns as plain and as bracketed lines: none of them is a JSON object."""
    t = _turns(spark, d)
    lines = t.select(F.concat(F.lit("- "), "role").alias("value")).unionByName(t.select(F.concat(F.lit("["), "role").alias("value")))
    return jsonl.parse_records(lines).where("problem IS NOT NULL").groupBy(F.col("problem").alias("reason")).agg(F.count("*").alias("n"))


@_query(f"SELECT conv_id, turn, nullif({STRIP.format('text')}, '') AS object_text, nullif({STRIP.format('text')}, '') AS string_text FROM conversations")
def extract_line_texts(spark, d):
    """Texts out of JSON objects (the first usable key) and out of JSON strings."""
    t = F.col("text")
    obj = F.to_json(F.struct(F.lit(" ").alias("body"), t.alias("comment")))
    quoted = F.regexp_extract(F.to_json(F.struct(t.alias("x"))), r"(?s)^\{\"x\":(.*)\}$", 1)
    return _turns(spark, d).select("conv_id", "turn", jsonl.extract_text(obj).alias("object_text"), jsonl.extract_text(quoted).alias("string_text"))


@_query(f"SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN text = '' THEN NULL ELSE {HASH_LABEL.format('text')} END AS label, CAST(NULL AS VARCHAR) AS failure FROM documents WHERE text <> ''")
def provider_labels(spark, d):
    """The model boundary itself, with the stand-in provider."""
    return providers.label_batches(_items(spark, d).where("text <> ''"), providers.HashProvider())


@_query("""SELECT 'sample' AS run, CAST(sum(n) AS BIGINT) AS total, '{' || string_agg('"' || lang || '":' || n, ',' ORDER BY lang) || '}' AS language_counts
FROM (SELECT lang, count(*) AS n FROM documents GROUP BY 1)""")
def run_metadata(spark, d):
    meta = sinks.run_metadata(joins.label_counts(_docs(spark, d), F.col("lang")), run="sample")
    return meta.withColumn("language_counts", F.to_json("language_counts"))


@_query("WITH " + _rule_sql("SELECT doc_id, text FROM documents WHERE length(text) >= 2") + " SELECT coalesce(label, 'Unknown') AS label, count(*) AS n FROM ruled GROUP BY 1")
def stream_label_counts(spark, d):
    """The documents' files as a stream through the lexicon rule, written and counted."""
    path, mark = _folder(spark, "stream"), _folder(spark, "mark")
    schema = spark.read.parquet(f"{d}/documents.parquet").schema
    items = spark.readStream.schema(schema).parquet(_watched(d, "documents")).select(F.col("doc_id").cast("string").alias("id"), "text")
    q = streams.stream_rule_labels(items).writeStream.format("parquet").option("path", path).option("checkpointLocation", mark).trigger(availableNow=True).start()
    q.awaitTermination()
    return joins.label_counts(spark.read.schema("id string, text string, label string").parquet(path), F.col("label"))


def _watched(d: str, name: str) -> str:
    """A file source takes a folder or a glob; a table may be a file or a folder."""
    return f"{d}/{name}.parque[t]"


@_query("SELECT count(DISTINCT text) AS n FROM documents")
def stream_distinct_texts(spark, d):
    """Content dedup across a stream."""
    path, mark = _folder(spark, "stream"), _folder(spark, "mark")
    schema = spark.read.parquet(f"{d}/documents.parquet").schema
    items = spark.readStream.schema(schema).parquet(_watched(d, "documents")).select("text")
    q = streams.distinct_texts(items).select("h").writeStream.format("parquet").option("path", path).option("checkpointLocation", mark).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema("h string").parquet(path).agg(F.count("*").alias("n"))


# responses, gates and files of every shape


@_query("SELECT conv_id, turn FROM conversations WHERE turn % 4 <> 3")
def null_text_gate(spark, d):
    """An empty text falls through to an empty body and stays; a null body goes."""
    n = F.col("turn") % 4
    t = _turns(spark, d).withColumn("t", F.when(n == 0, F.lit("x")).when(n == 1, F.lit(""))).withColumn("b", F.when(n < 3, F.lit("")))
    return t.where(clean.has_text(F.col("t"), F.col("b"))).select("conv_id", "turn")


_PAIR = "struct_pack(i := event_id, l := event_type)"


def _answers(spark, d, response) -> DataFrame:
    """Events with a made-up response of one of six shapes: an array with metadata, one inside prose, two lines, an object without a label, a nested array, nothing."""
    row = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("language"), F.lit(3).alias("_tokens")))
    k = F.col("event_id") % 6
    text = (
        F.when(k == 0, F.concat(F.lit("["), row, F.lit("]"))).when(k == 1, F.concat(F.lit("Sure: ["), row, F.lit("] ok"))).when(k == 2, F.concat(row, F.lit("\n> "), row, F.lit(" ;\n\n")))
        .when(k == 3, F.lit('{"id":"a"}')).when(k == 4, F.concat(F.lit("[["), row, F.lit("], ["), row, F.lit("]]"))).otherwise(F.lit("no answer"))
    )
    rows = _events(spark, d).select("event_id", response(text).alias("r"))
    return rows


def _told(rows: DataFrame) -> DataFrame:
    return rows.select("event_id", F.explode("r").alias("x")).select("event_id", F.col("x.id").cast("long").alias("id"), F.col("x.language").alias("language"))


@_query("SELECT event_id, event_id AS id, event_type AS language FROM events WHERE event_id % 6 = 0")
def strict_responses(spark, d):
    return _told(_answers(spark, d, lambda t: parsing.good_rows(parsing.strict_array(t))))


@_query("SELECT event_id, event_id AS id, event_type AS language FROM events WHERE event_id % 6 <= 1")
def salvaged_responses(spark, d):
    return _told(_answers(spark, d, lambda t: parsing.good_rows(parsing.salvaged_array(t))))


@_query("SELECT event_id, event_id AS id, event_type AS language FROM events, range(2) r(k) WHERE event_id % 6 IN (0, 1, 2, 4) AND (event_id % 6 = 2 OR k = 0)")
def json_line_responses(spark, d):
    return _told(_answers(spark, d, parsing.json_lines))


@_query("""SELECT event_id, CAST(CASE event_id % 6 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 4 THEN 2 ELSE 0 END AS INTEGER) AS n_results,
CAST(CASE WHEN event_id % 6 IN (3, 5) THEN 1 ELSE 0 END AS INTEGER) AS invalid FROM events""")
def lenient_shapes(spark, d):
    out = _answers(spark, d, parsing.lenient)
    return out.select("event_id", F.size("r.results").alias("n_results"), F.col("r.invalid").alias("invalid"))


@_query("SELECT conv_id, CAST(turn AS VARCHAR) AS id, text FROM conversations")
def request_roundtrip(spark, d):
    """The array that a model is sent for each conversation, parsed again."""
    sent = _turns(spark, d).groupBy("conv_id").agg(parsing.request(F.collect_list(F.struct(F.col("turn").cast("string").alias("id"), "text"))).alias("r"))
    return sent.select("conv_id", F.explode(F.from_json("r", "array<struct<id:string,text:string>>")).alias("x")).select("conv_id", "x.id", "x.text")


_LINES_SQL = f"SELECT row_number() OVER (ORDER BY conv_id, turn) AS line_id, turn, regexp_replace(text, '\\s+', ' ', 'g') AS t FROM conversations"


@_query(f"WITH l AS ({_LINES_SQL}) SELECT line_id, {STRIP.format('t')} AS text FROM l WHERE turn % 4 <> 3 AND {STRIP.format('t')} <> ''")
def detector_lines(spark, d):
    """Turns as lines of one file, as objects, strings, plain text and numbers; physical line numbers over splits of it."""
    path = _folder(spark, "lines")
    t, n = F.regexp_replace("text", r"\s+", " "), F.col("turn") % 4
    quoted = F.regexp_extract(F.to_json(F.struct(t.alias("x"))), r"(?s)^\{\"x\":(.*)\}$", 1)
    line = F.when(n == 0, F.to_json(F.struct(F.lit(" ").alias("body"), t.alias("text")))).when(n == 1, quoted).when(n == 2, t).otherwise(F.lit("123"))
    _turns(spark, d).repartition(1).sortWithinPartitions("conv_id", "turn").select(line.alias("value")).write.text(path)
    return jsonl.detector_lines(spark, path)


@_query("SELECT conv_id || '/' || turn AS id, text FROM conversations WHERE text IS NOT NULL")
def json_array_files(spark, d):
    """Whole-file arrays with elements that are no objects."""
    path = _folder(spark, "arrays")
    row = F.to_json(F.struct(F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), F.col("text").alias("body")))
    made = _turns(spark, d).groupBy(F.floor(F.col("conv_id") / 20).alias("file")).agg(F.concat(F.lit(" [1, "), F.array_join(F.collect_list(row), ",\n"), F.lit(", null]")).alias("value"))
    made.write.partitionBy("file").text(path)
    return jsonl.read_json_array(spark, path)


@_query("SELECT CAST(doc_id AS VARCHAR) AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def checkpoint_split_on_space(spark, d):
    """Several ids a line."""
    path = _folder(spark, "done")
    ids = _marks(spark, d).groupBy(F.col("doc_id") % 50).agg(F.array_join(F.collect_list(F.col("doc_id").cast("string")), " \t ").alias("value")).select("value")
    ids.write.text(path)
    return joins.unprocessed(_items(spark, d), jsonl.read_checkpoint(spark, path, split_on_space=True)).select("id")


@_query(f"SELECT conv_id, turn, {STRIP.format(chr(39) + 'x' + chr(39) + ' || text')} AS value FROM (SELECT conv_id, turn, regexp_replace(text, '\\s+', ' ', 'g') AS text FROM conversations)")
def undecodable_bytes(spark, d):
    """Replacement marks of undecodable bytes are dropped from lines."""
    path = _folder(spark, "bytes")
    t = _turns(spark, d)
    t.select(F.concat_ws("|", F.col("conv_id").cast("string"), F.col("turn").cast("string"), F.concat(F.lit("x\ufffd"), F.regexp_replace("text", r"\s+", " "), F.lit("\ufffd"))).alias("value")).write.text(path)
    parts = F.split("value", r"\|", 3)
    return jsonl.lines(spark, path).select(parts[0].cast("long").alias("conv_id"), parts[1].cast("long").alias("turn"), parts[2].alias("value"))


@_query("SELECT CAST(doc_id AS VARCHAR) AS id, lang AS text FROM documents")
def jsonl_overwrite(spark, d):
    path = _folder(spark, "jsonl")
    sinks.write_jsonl(_items(spark, d), path)
    sinks.write_jsonl(_docs(spark, d).select(F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("text")), path, mode="overwrite")
    return jsonl.read_jsonl(spark, path).select("id", "text")


@_query(f"SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 3 = 0 THEN 'English' ELSE max({_LANG_SQL}) END AS language FROM labels GROUP BY doc_id")
def label_files_repeated_ids(spark, d):
    """Ids that come in several label files: the last file in name order counts."""
    path = _folder(spark, "labels")
    rows = _marks(spark, d).groupBy("doc_id").agg(F.max(_language()).alias("language"))
    sinks.write_jsonl(rows.select(F.col("doc_id").cast("string").alias("id"), "language"), f"{path}/a")
    sinks.write_jsonl(rows.where("doc_id % 3 = 0").select(F.col("doc_id").cast("string").alias("id"), F.lit("English").alias("language")), f"{path}/b")
    return joins.last_wins(jsonl.read_label_files(spark, [f"{path}/a", f"{path}/b"]), "id", "language", "file")


@_query("WITH " + _MERGE_SQL + " SELECT id, body, CASE WHEN language IS NULL THEN 'unknown' ELSE lower(replace(language, ' ', '_')) END AS slug FROM merged")
def split_with_unknown(spark, d):
    """Merged originals written by slug, those without a label under ``unknown``, and read back with minimal fields."""
    path = _folder(spark, "split")
    sinks.write_by_label(_merged(spark, d).withColumnRenamed("slug", "s"), path, F.coalesce("s", F.lit("unknown")), ("id", "body"))
    return spark.read.schema("id string, body string, slug string").json(path)


@_query("SELECT h, doc_id FROM (SELECT md5(text) AS h, min(doc_id) AS doc_id FROM documents GROUP BY 1)")
def combined_results(spark, d):
    """The combined file: one result for each text, the first, written and read back."""
    path = _folder(spark, "combined")
    sinks.write_jsonl(joins.first_of_hash(_docs(spark, d).select("doc_id", "text"), "doc_id").select("h", "doc_id"), path, mode="overwrite")
    return spark.read.schema("h string, doc_id long").json(path)


@_query(_pack_sql(f"CAST(({{b}}) + CASE WHEN {_GREEDY} THEN 1 ELSE 0 END AS BIGINT) AS batch, CAST(({{b}}) + CASE WHEN {_GREEDY} THEN 1 ELSE 0 END AS BIGINT) AS b, CAST(CASE WHEN {_GREEDY} THEN 0 ELSE ({{s}}) END + {{t}} AS BIGINT) AS s, CAST(CASE WHEN {_GREEDY} THEN 0 ELSE ({{c}}) END + 1 AS BIGINT) AS c").replace("SELECT shard, doc_id, tokens, batch FROM f", "SELECT shard, batch, count(*) AS n_items, CAST(sum(tokens) AS BIGINT) AS batch_tokens FROM f GROUP BY 1, 2"))
def batch_token_sums(spark, d):
    return packing.batch_totals(packing.budget_batches(_sized(spark, d), "shard", "doc_id", "tokens"), "shard", "tokens")


@_query("""WITH t AS (SELECT user_id, count(*) AS rows, count(*) * 1e6 / (max(epoch_us(ts)) - min(epoch_us(ts))) AS r FROM events GROUP BY 1 HAVING max(epoch_us(ts)) > min(epoch_us(ts)))
SELECT user_id, round((100000 - rows) / r / 3600, 3) AS eta FROM t""")
def eta(spark, d):
    """Hours left for 100,000 rows at each run's rate."""
    log = _events(spark, d).select("user_id", "ts", F.lit(1).alias("n_rows"), F.lit(1).alias("n_tokens"), F.col("value").alias("latency"))
    out = telemetry.throughput(log, "user_id").where("rows_per_s IS NOT NULL")
    return out.select("user_id", F.round(telemetry.eta_hours(F.lit(100000) - F.col("rows"), F.col("rows_per_s")), 3).alias("eta"))


@_query("""WITH c AS (SELECT (SELECT count(DISTINCT doc_id) FROM labels) AS done, (SELECT count(*) FROM documents) AS total)
SELECT near, CASE WHEN total > 0 AND done >= total - near THEN 'restart' ELSE 'resume' END AS action FROM c, (VALUES (0), (1000000)) v(near)""")
def checkpoint_policy(spark, d):
    """What a run does about a checkpoint that covers (nearly) the whole input: strict, and with a wide margin."""
    done, total = _marks(spark, d).select("doc_id").distinct().count(), _docs(spark, d).count()
    return spark.createDataFrame([(n, cascade.checkpoint_policy(done, total, n)) for n in (0, 1000000)], "near int, action string")


_PICKED = f"(SELECT doc_id, text, label FROM ruled WHERE label IS NOT NULL AND CAST('0x' || substr(md5('recheck' || doc_id), 1, 8) AS BIGINT) < CAST(floor(0.5 * 4294967296) AS BIGINT))"


@_query(f"WITH {_CACHE_SQL}, " + _rule_sql("SELECT doc_id, text FROM documents").strip() + f""",
wrong AS (SELECT DISTINCT md5(text) AS h, {HASH_LABEL.format('text')} AS label FROM {_PICKED} p WHERE label <> {HASH_LABEL.format('text')})
SELECT h, label FROM wrong UNION ALL SELECT h, label FROM cache WHERE h NOT IN (SELECT h FROM wrong)""")
def drift_recheck(spark, d):
    """Half of the rule's labels asked again; the cache with the answers that differ."""
    labelled = rules.ruled(_items(spark, d)).withColumn("origin", F.lit("rule"))
    return cascade.recheck(labelled, _cache(spark, d), providers.HashProvider(), rule_share=0.5)[1]


@_query("WITH " + _LID + """,
sums AS (SELECT doc_id, count(*) AS n, sum(CASE WHEN tag = 'English' THEN 1 ELSE 0 END) AS en, sum(CASE WHEN tag = 'Swahili' THEN 1 ELSE 0 END) AS sw, sum(CASE WHEN tag = 'Sheng' THEN 1 ELSE 0 END) AS sh FROM tags GROUP BY 1),
r AS (SELECT d.doc_id AS doc_id, coalesce(CAST(en AS DOUBLE) / n, 0.0::DOUBLE) AS en, coalesce(CAST(sw AS DOUBLE) / n, 0.0::DOUBLE) AS sw, coalesce(CAST(sh AS DOUBLE) / n, 0.0::DOUBLE) AS sh FROM documents d LEFT JOIN sums USING (doc_id))
SELECT doc_id, NOT ((sh > 0.2 AND sh > sw AND sh > en) OR (sw > 0.7 AND sw > sh) OR (en > 0.8 AND sw < 0.1) OR (sw > 0.2 AND sw < 0.6 AND en > 0.2)) AS hinted FROM r""")
def hinted_items(spark, d):
    """Texts that the ratio rule leaves to a model go with a hint of their ratios, and only those."""
    docs = _docs(spark, d)
    out = cascade.ratio_labels(docs.select(F.col("doc_id").alias("id"), "text"), _word_lid(docs))
    return out.select(F.col("id").alias("doc_id"), F.coalesce(F.col("hint").rlike(r"^en=\d\.\d\d sw=\d\.\d\d sh=\d\.\d\d$"), F.lit(False)).alias("hinted"))
