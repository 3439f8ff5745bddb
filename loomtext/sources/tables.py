"""How scans are laid out over cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its files make fewer partitions than those, for work that is heavy beside its rows.

    A large table has a partition for each 128 MB and comes back as it is: nothing is dealt.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
