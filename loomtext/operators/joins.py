"""Joins around checkpoints, caches, model results and label files, and keyed last-wins or first-wins maps.

Spark picks broadcast or sort-merge from sizes at run time; no side is forced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.functions import text as X


def unprocessed(items: DataFrame, done: DataFrame, id_col: str = "id") -> DataFrame:
    """Items whose id isn't among the done ones. Items without an id always pass."""
    return items.join(done.select(id_col).where(F.col(id_col).isNotNull()).distinct(), id_col, "left_anti").select(*items.columns)


def last_wins(rows: DataFrame, key: str, value: str, *order: str) -> DataFrame:
    """One row a key: the value that comes last in ``order``. Aggregated before the shuffle, so hot keys are light."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def first_wins(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key that isn't empty after stripping."""
    kept = rows.withColumn(key, X.strip(F.col(key))).where(F.col(key) != "")
    first = kept.groupBy(key).agg(F.min_by(F.struct(*[c for c in kept.columns if c != key]), F.struct(*order)).alias("_r"))
    return first.select(key, "_r.*").select(*rows.columns)


def probe_cache(items: DataFrame, cache: DataFrame) -> DataFrame:
    """``items`` (with ``text``) with ``h`` and the cached ``label``, null where the cache has none."""
    return items.withColumn("h", X.hash_key(F.col("text"))).join(cache.select("h", "label"), "h", "left")


def upsert_cache(cache: DataFrame, new: DataFrame, *order: str) -> DataFrame:
    """Both ``(h, label)``, ``new`` with an order besides; new labels replace old ones, later new ones earlier ones."""
    return last_wins(new, "h", "label", *order).unionByName(cache.select("h", "label").join(new.select("h").distinct(), "h", "left_anti"))


def delete_from_cache(cache: DataFrame, gone: DataFrame) -> DataFrame:
    return cache.join(gone.select("h").distinct(), "h", "left_anti").select("h", "label")


def align_results(results: DataFrame, batch: DataFrame) -> DataFrame:
    """Model results ``(id, text, language)`` with missing texts filled from the batch's ``(id, text)``."""
    originals = batch.select("id", F.col("text").alias("_o"))
    return results.join(originals, "id", "left").select("id", X.falsy_coalesce(F.col("text"), F.col("_o")).alias("text"), "language")


def missing_from_results(batch: DataFrame, results: DataFrame) -> DataFrame:
    """Batch items that no result with an id and a language answers."""
    good = results.where(F.coalesce((F.col("id") != "") & (F.col("language") != ""), F.lit(False))).select("id").distinct()
    return batch.join(good, "id", "left_anti").select(*batch.columns)


def merge_labels(originals: DataFrame, labels: DataFrame, *order: str) -> DataFrame:
    """``(id, body)`` of every valid original with its last ``language`` and the ``slug`` of its file.

    Originals that repeat an id all stay. No label, or one outside the domain: slug ``unknown``.
    """
    last = last_wins(labels, "id", "language", *order)
    valid = originals.where(F.coalesce(F.col("id") != "", F.lit(False)) & F.coalesce(X.strip(F.col("body")) != "", F.lit(False)))
    joined = valid.join(last, "id", "left")
    return joined.select("id", "body", "language", F.when(X.known_label(F.col("language")), X.slug(F.col("language"))).otherwise("unknown").alias("slug"))


def recheck_outcome() -> Column:
    """Of ``expected`` and ``language``: match, mismatch or missing."""
    return F.when(F.col("language").isNull(), "missing").when(F.col("language") == F.col("expected"), "match").otherwise("mismatch")


def recheck_outcomes(expected: DataFrame, results: DataFrame) -> DataFrame:
    """``(recheck_id, expected)`` against ``(recheck_id, language)``: match, mismatch or missing, a row each."""
    got = results.groupBy("recheck_id").agg(F.max("language").alias("language"))
    return expected.join(got, "recheck_id", "left").select("recheck_id", "expected", "language", recheck_outcome().alias("outcome"))


def first_of_hash(items: DataFrame, order: str) -> DataFrame:
    """One item for each distinct text, the first in order: only it pays for a model call."""
    keyed = items.withColumn("h", X.hash_key(F.col("text")))
    return keyed.groupBy("h").agg(F.min_by(F.struct(*items.columns), F.col(order)).alias("_r")).select("h", "_r.*")


def labels_to_all(items: DataFrame, labelled: DataFrame) -> DataFrame:
    """Labels of first items, ``(h, label)``, to every item with the same text."""
    return items.withColumn("h", X.hash_key(F.col("text"))).join(labelled, "h", "left").drop("h")


def label_counts(rows: DataFrame, label: Column, domain: tuple[str, ...] | None = None, other: str = "Unknown") -> DataFrame:
    """``label, n``. With a domain: closed, zero-filled, and everything else under ``other``."""
    if domain is None:
        return rows.groupBy(F.coalesce(label, F.lit(other)).alias("label")).agg(F.count("*").alias("n"))
    counts = rows.groupBy(F.when(label.isin(*domain), label).otherwise(other).alias("label")).agg(F.count("*").alias("n"))
    spark = rows.sparkSession
    # Zeros are added, not joined: a join would infer a filter on the label and push it, rule and all, down to the scan.
    zeros = spark.range(1).select(F.explode(F.array(*map(F.lit, (*domain, other)))).alias("label"), F.lit(0).cast("long").alias("n"))
    return counts.unionByName(zeros).groupBy("label").agg(F.sum("n").alias("n"))


def hash_groups(items: DataFrame) -> DataFrame:
    """Texts that occur more than once: ``h, n``."""
    return items.groupBy(X.hash_key(F.col("text")).alias("h")).agg(F.count("*").alias("n")).where("n > 1")


def ordinals(df: DataFrame, order: str, *partition: str) -> Column:
    return F.row_number().over(Window.partitionBy(*partition).orderBy(order))
