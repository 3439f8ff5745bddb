"""Seeded samples: a hash of seed and id orders or selects rows, the same on every run and engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def draw(seed: str, id_: Column) -> Column:
    """32 uniform bits."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), id_.cast("string"))), 1, 8), 16, 10).cast("long")


def sample_n(df: DataFrame, n: int, seed: str, id_col: str = "id") -> DataFrame:
    """``n`` rows without replacement; all of them if there are fewer. Each task keeps its first n only."""
    return df.orderBy(F.md5(F.concat(F.lit(seed), F.col(id_col).cast("string"))), id_col).limit(n)


def bernoulli(df: DataFrame, share: float, seed: str, id_col: str = "id") -> DataFrame:
    return df.where(draw(seed, F.col(id_col)) < int(share * 2**32))
