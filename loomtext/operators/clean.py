"""Filters and projections that make work items of raw records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.functions import text as X

DELETED = ("[deleted]", "[removed]")


def is_comment(body: Column) -> Column:
    """Neither blank nor a deletion mark."""
    s = X.strip(body)
    return F.coalesce((s != "") & ~F.lower(s).isin(*DELETED), F.lit(False))


def clean_comments(raw: DataFrame) -> DataFrame:
    """``(id, body)`` to stripped bodies of real comments; a missing id becomes an empty one."""
    return raw.where(is_comment(F.col("body"))).select(F.coalesce("id", F.lit("")).alias("id"), X.strip(F.col("body")).alias("body"))


def not_blank(text: Column) -> Column:
    return F.coalesce(X.strip(text) != "", F.lit(False))


def quote_gate(text: Column) -> Column:
    """Keeps only texts with a quote mark. An option; most texts don't pass."""
    return F.coalesce(text.rlike("['\"]"), F.lit(False))


def min_length(text: Column, least: int = 2) -> Column:
    return F.coalesce(F.length(X.strip(text)) >= least, F.lit(False))


def has_id(id_: Column) -> Column:
    return F.coalesce(id_ != "", F.lit(False))


def has_text(text: Column, body: Column) -> Column:
    """Keeps an empty string and drops null only: what falls through an empty text is the body, null or not."""
    return F.when(text.isNotNull() & (text != ""), True).otherwise(body.isNotNull())


def known_or(label: Column, other: str = "Unknown") -> Column:
    return F.when(X.known_label(label), label).otherwise(other)


def numbered_ids(df: DataFrame, order: str, id_col: str = "id", count_all: bool = False) -> DataFrame:
    """``auto_<n>`` for rows without an id, n over such rows, or over all rows with ``count_all``.

    Numbers come from counts by block of ``order`` and a running sum over blocks, so no task sees all rows.
    """
    missing = ~has_id(F.col(id_col))
    counted = F.lit(1) if count_all else missing.cast("int")
    rows = df.withColumn("_c", counted).withColumn("_block", F.floor(F.col(order) / 4096))
    blocks = rows.groupBy("_block").agg(F.sum("_c").alias("_n"))
    before = blocks.select("_block", F.coalesce(F.sum("_n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inner = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    n = F.sum("_c").over(inner) + F.col("_before")
    out = rows.join(before, "_block").withColumn("_k", n)
    return out.withColumn(id_col, F.when(missing, F.concat(F.lit("auto_"), F.col("_k").cast("string"))).otherwise(F.col(id_col))).drop("_c", "_block", "_before", "_k")


def content_id(df: DataFrame, line: str, id_col: str = "id") -> DataFrame:
    """The MD5 of the raw line where a row has no id: stable across resumed runs."""
    return df.withColumn(id_col, F.when(has_id(F.col(id_col)), F.col(id_col)).otherwise(F.md5(F.col(line))))


def skip_reasons(items: DataFrame, least: int = 3) -> DataFrame:
    """``(id, text)`` to counts by ``reason``: missing_id, blank_text, too_short, or kept."""
    reason = F.when(~has_id(F.col("id")), "missing_id").when(~not_blank(F.col("text")), "blank_text").when(~min_length(F.col("text"), least), "too_short").otherwise("kept")
    return items.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))
