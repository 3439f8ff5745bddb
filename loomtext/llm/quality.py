"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

DataFrame functions only. Words and neighbouring pairs hash into ``BUCKETS`` buckets; two smoothed
multinomials over them, one of trusted documents and one of the whole corpus, give each bucket a
weight log(p_target / p_raw). A document's verdict is its mean weight against a fixed threshold;
no draw is involved. The trusted side is a bounded sample of labelled rows; the raw side counts every document.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import words

BUCKETS = 1 << 14
SAMPLE = 20_000
#: Mean log ratio under which a document goes.
THRESHOLD = -0.05
MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
SPACE_CHARS = " \t\n\x0b\f\r"


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, and ``hashes`` (a 64-bit hash of each word, lower-cased) of every row.

    Repeated windows are told by 64-bit hashes of their words' hashes.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    a = docs.select(
        "doc_id",
        (_without(text, SPACE_CHARS)).cast("long").alias("word_chars"),
        (F.length(text) - _without(text, SYMBOLS)).cast("long").alias("n_symbols"),
        F.transform(lines, lambda x: F.xxhash64(x)).alias("lines"),
        words(text).alias("words"),
    )
    b = a.select(
        "doc_id", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("exact"),
        F.transform("words", lambda w: F.xxhash64(F.lower(w))).alias("hashes"),
    )
    n = F.size("exact")
    at = lambda x, i: F.get(F.col(x), i)
    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(at("exact", i), at("exact", i + 1), at("exact", i + 2)))
    c = b.select("doc_id", "word_chars", "n_symbols", "n_dup_lines", n.cast("long").alias("n_words"), "hashes", F.when(n >= 3, windows).otherwise(F.array().cast("array<bigint>")).alias("windows"))
    # Only texts in which some window comes back are sorted by window.
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    d = c.select("*", F.when(again, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("sorted")).drop("windows")
    h = lambda j: F.get(F.col("sorted"), j)["h"]
    twice = lambda x, j: (h(j - 1) == x["h"]) | (h(j + 1) == x["h"])
    starts = F.sort_array(F.transform(F.filter("sorted", lambda x, j: F.coalesce(twice(x, j), F.lit(False))), lambda x: x["i"]))
    e = d.select("*", starts.alias("starts")).drop("sorted")
    covered = F.aggregate(F.transform("starts", lambda s, j: F.least(F.lit(3), F.coalesce(F.get(F.col("starts"), j + 1) - s, F.lit(3)))), F.lit(0), lambda acc, x: acc + x)
    return e.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), "hashes")


def buckets(hashes: str) -> Column:
    """The buckets of all words and of all neighbouring pairs."""
    h = F.col(hashes)
    one = F.transform(h, lambda x: F.pmod(x, F.lit(BUCKETS)).cast("int"))
    two = F.transform(F.sequence(F.lit(0), F.size(h) - 2), lambda i: F.pmod(F.xxhash64(F.get(h, i), F.get(h, i + 1)), F.lit(BUCKETS)).cast("int"))
    return F.when(F.size(h) >= 2, F.concat(one, two)).otherwise(one)


def _counts(texts: DataFrame) -> dict[int, int]:
    """Counts by bucket: at most ``BUCKETS`` rows reach the driver, whatever the corpus."""
    hashed = texts.select(F.transform(words(F.col("text")), lambda w: F.xxhash64(F.lower(w))).alias("hashes"))
    rows = hashed.select(F.explode(buckets("hashes")).alias("b")).groupBy("b").count().collect()
    return {r["b"]: r["count"] for r in rows}


def weights(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[float]:
    """log(p_target / p_raw) of each bucket, both with one added to every count.

    Trusted are labelled rows with ``quality = 1``: all of them, or about ``sample`` drawn by a hash
    of the id. Without any, all weights are 0.
    """
    good = labels.where("doc_id IS NOT NULL AND quality = 1").select("doc_id").distinct()
    rate = min(1.0, sample / max(1, good.count()))
    # Uniform hashes: about `sample` ids whatever the table's size, so they may be broadcast.
    drawn = good.where(F.xxhash64("doc_id", F.lit(11)) <= F.lit(min(2**63 - 1, int(-(2**63) + rate * 2**64))))
    target = _counts(docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id", "left_semi"))
    if not target:
        return [0.0] * BUCKETS
    raw = _counts(docs.select("text"))
    all_t, all_r = sum(target.values()) + BUCKETS, sum(raw.values()) + BUCKETS
    return [math.log((target.get(i, 0) + 1) / all_t) - math.log((raw.get(i, 0) + 1) / all_r) for i in range(BUCKETS)]


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, base counts, ``base_failed``, ``score`` (mean log ratio) and ``kept``; a row for each of ``docs``.

    Null texts count as empty: no words, base_failed. Repeated rows come out alike. Other columns of
    ``docs`` are ignored. An empty table gives no rows; an empty label table keeps what the base keeps.
    """
    w = F.from_json(F.lit(json.dumps(weights(docs, labels))), "array<double>")
    m = measures(docs).withColumn("grams", buckets("hashes"))
    total = F.aggregate("grams", F.lit(0.0), lambda acc, b: acc + F.get(w, b))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    scored = m.select("*", failed.alias("base_failed"), F.when(F.size("grams") > 0, total / F.size("grams")).alias("score"))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("score"), F.lit(0.0)) >= threshold)
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "score")
