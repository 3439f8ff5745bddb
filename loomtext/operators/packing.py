"""Batches for model calls: by count, by greedy token budget, and flush-after-add.

Budgets fold over items in order, so they run inside shards of bounded size (blocks of consecutive
ids); a shard's items are one array and the fold is a JVM expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD = 1000


def shard_of(order: Column, size: int = SHARD) -> Column:
    return F.floor(order / size).cast("long")


def fixed_batches(df: DataFrame, order: str, size: int, *shard: str) -> DataFrame:
    """``df`` with ``batch``: positions in order, from 0, divided by ``size``, within each shard."""
    n = F.row_number().over(Window.partitionBy(*shard).orderBy(order))
    return df.withColumn("batch", F.floor((n - 1) / size).cast("long"))


def _fold(df: DataFrame, shard: str, order: str, tokens: str, step) -> DataFrame:
    """``shard, order, tokens, batch`` of every row, from a fold that keeps (batch, sum, length)."""
    start = F.struct(F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("n"), F.array().cast("array<bigint>").alias("out"))
    items = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(tokens).cast("long").alias("t"))))
    grouped = df.groupBy(shard).agg(items.alias("items"))
    done = grouped.withColumn("batches", F.aggregate("items", start, step)["out"])
    z = done.select(shard, F.explode(F.arrays_zip("items", "batches")).alias("z"))
    return z.select(shard, F.col("z.items.o").alias(order), F.col("z.items.t").alias(tokens), F.col("z.batches").alias("batch"))


def budget_batches(df: DataFrame, shard: str, order: str, tokens: str, budget: int = 2500, most: int = 15) -> DataFrame:
    """Greedy: an item opens a new batch if the current one isn't empty and would pass ``budget`` or has ``most`` items."""

    def step(acc: Column, x: Column) -> Column:
        new = (acc["n"] > 0) & ((acc["s"] + x["t"] > budget) | (acc["n"] >= most))
        b = acc["b"] + F.when(new, F.lit(1)).otherwise(F.lit(0)).cast("long")
        return F.struct(b.alias("b"), (F.when(new, F.lit(0).cast("long")).otherwise(acc["s"]) + x["t"]).alias("s"), (F.when(new, F.lit(0).cast("long")).otherwise(acc["n"]) + F.lit(1).cast("long")).alias("n"), F.concat(acc["out"], F.array(b)).alias("out"))

    return _fold(df, shard, order, tokens, step)


def flush_batches(df: DataFrame, shard: str, order: str, tokens: str, over: int = 7000, size: int = 40) -> DataFrame:
    """An item is added first; the batch then closes if its sum passes ``over`` or it has ``size`` items."""

    def step(acc: Column, x: Column) -> Column:
        s, n = acc["s"] + x["t"], acc["n"] + F.lit(1).cast("long")
        flush = (s > over) | (n >= size)
        zero = F.lit(0).cast("long")
        return F.struct((acc["b"] + F.when(flush, F.lit(1)).otherwise(F.lit(0)).cast("long")).alias("b"), F.when(flush, zero).otherwise(s).alias("s"), F.when(flush, zero).otherwise(n).alias("n"), F.concat(acc["out"], F.array(acc["b"])).alias("out"))

    return _fold(df, shard, order, tokens, step)


def batch_totals(batched: DataFrame, shard: str, tokens: str) -> DataFrame:
    return batched.groupBy(shard, "batch").agg(F.count("*").alias("n_items"), F.sum(tokens).alias("batch_tokens"))
