"""Mixing sources to target weights.

Rows get hash-random keys; each source's rows are laid out in key order over key ranges; range
totals give distributed prefix sums; each source is cut at its exact word budget, whole epochs first.

A hot source is no hot task: its keys are uniform, so equal-width key ranges hold about
``RANGE_ROWS`` rows each, and only a row per range meets in the running sum over ranges. Rows with equal
id, source and size (null ids above all) share a key; they are counted before the windows and dealt out again after them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.llm.common import columns, free_name, stored, word_count

SEED = "mix-1"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
#: Rows that a key range holds on average; the number of ranges follows the source's rows.
RANGE_ROWS = 2048
KEY_BITS = 60


def random_key(doc_id: Column, seed: str = SEED) -> Column:
    """60 uniform bits from the id; equal ids get equal keys on every run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``(source, size, n)``, n rows of that size, to a row a source: ``source, source_size, source_rows, target``.

    Targets are weight x level, stopped at ``epochs`` x size. The level at which they add up to
    ``share`` x all sizes is found exactly: by rising cap/weight, a source is stopped while the
    level that would hold without it stopped is at or above its cap/weight. This table has a row a source.
    """
    total = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("source_rows"))
    ranked = total.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("cap", F.col("source_size") * epochs).withColumn("stop_at", F.col("cap").cast("double") / F.col("w"))
    rising = Window.orderBy(F.col("stop_at"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    ranked = (
        ranked.withColumn("all_size", F.sum("source_size").over(every))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("w_left", F.sum("w").over(rising.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("all_size") * F.lit(float(share)) - F.col("cap_before")) / F.col("w_left"))
        .withColumn("free_level", F.min(F.when(F.col("level") < F.col("stop_at"), F.struct("stop_at", "level"))).over(every)["level"])
    )
    capped = F.col("free_level").isNull() | (F.col("stop_at") <= F.col("free_level"))
    return ranked.select("source", "source_size", "source_rows", F.when(capped, F.col("cap").cast("double")).otherwise(F.col("w") * F.col("free_level")).alias("target"))


def mix(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """``(doc_id, source, size)`` to ``doc_id, source, size, source_size, target, taken``; a row each.

    ``taken`` counts words, repeats included: ``floor(target / source_size)`` whole epochs, then the
    documents in key order up to the budget that is left (rounded to words); the one at the cut
    gives its first words only. So a source's taken words are its target to half a word, and no
    document exceeds ``epochs`` times its size.

    Empty texts take 0. A null source is a source of its own. Null ids share one key. Rows that
    repeat an id tie on the key and are ordered by size; equal ones are interchangeable. An empty
    table gives no rows.
    """
    counted = sizes.groupBy("doc_id", "source", F.col("size").cast("long").alias("size")).agg(F.count("*").alias("n"))
    keyed = stored(counted.withColumn("key", random_key(F.col("doc_id"), seed)), "mix")
    targets = stored(source_targets(keyed, weights, share, epochs), "targets")
    # Bits for the range number grow with the source's rows.
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("source_rows") / F.lit(RANGE_ROWS)))).cast("int")
    plan = targets.withColumn("shift", F.lit(KEY_BITS) - bits).drop("source_rows").withColumnRenamed("source", "s")
    # A row a source; as many rows as the corpus has sources. Spark's own size threshold decides on a broadcast.
    laid = keyed.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("range", F.expr("shiftright(key, shift)"))
    ranges = laid.groupBy("source", "range").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = ranges.select(F.col("source").alias("bs"), F.col("range").alias("br"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = laid.withColumn("within", F.coalesce(F.sum(F.col("size") * F.col("n")).over(inside), F.lit(0)))
    placed = placed.join(base, F.col("source").eqNullSafe(F.col("bs")) & (F.col("range") == F.col("br")))
    budget = F.round("target").cast("long")
    full = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(F.lit(0))
    placed = placed.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    left = budget - full * F.col("source_size") - F.col("base") - F.col("within") - F.col("i") * F.col("size")
    taken = full * F.col("size") + F.least(F.greatest(left, F.lit(0)), F.col("size"))
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The columns of ``docs`` (``doc_id, text, source`` and any others), a row for each copy that the mix takes.

    Whole copies first, then the cut document's first words. Documents of which nothing is taken,
    empty ones among them, are not in the mix. Rows that repeat an id within a source are told
    apart by their size and, if that is equal too, share the decisions made for them.
    """
    k, size, rank, copy, got_name = (free_name(docs, x) for x in ("mix_key", "mix_size", "mix_rank", "mix_copy", "mix_taken"))
    sized = docs.withColumn(size, word_count(F.col("text"))).withColumn(k, _row_key(F.col("doc_id"), F.col("source"), F.col(size)))
    taken = mix(sized.select("doc_id", "source", F.col(size).alias("size")), **options)
    taken = taken.select(_row_key(F.col("doc_id"), F.col("source"), F.col("size")).alias(k), F.col("taken").alias(got_name))
    # Both sides are dealt by the key alone, so the join on key and rank moves nothing again.
    taken = taken.withColumn(rank, F.row_number().over(Window.partitionBy(k).orderBy(F.col(got_name).desc()))).where(F.col(got_name) > 0)
    ranked = sized.withColumn(rank, F.row_number().over(Window.partitionBy(k).orderBy("text")))
    joined = ranked.join(taken, [k, rank])
    n, got = F.col(size), F.col(got_name)
    cut = joined.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(got / n).cast("long"))))
    rest = got - (F.col(copy) - 1) * n
    # Pieces end where a word ends, so the first `rest` pieces keep the white space between words.
    pieces = F.split(F.col("text"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", (rest + 1).cast("int"))
    first = F.array_join(F.slice(pieces, F.lit(1), rest.cast("int")), "")
    return cut.withColumn("text", F.when(rest >= n, F.col("text")).otherwise(first)).select(*columns(docs))


def _row_key(doc_id: Column, source: Column, size: Column) -> Column:
    return F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("-")), size.cast("string"), F.coalesce(F.concat(F.lit("="), source), F.lit("-")))
