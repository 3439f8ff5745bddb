"""Writers: JSON lines, rolling parts, files by label, checkpoints, caches, run metadata. Spark's committer makes them whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions import text as X

PART_ROWS = 100_000


def write_jsonl(df: DataFrame, path: str, mode: str = "append", part_rows: int = PART_ROWS, compression: str = "none") -> None:
    """Non-ASCII text stays literal; a part has ``part_rows`` lines at most."""
    df.write.mode(mode).option("maxRecordsPerFile", part_rows).option("compression", compression).option("ignoreNullFields", "false").json(path)


def write_checkpoint(df: DataFrame, path: str, id_col: str = "id") -> None:
    """The written rows' ids, one a line."""
    df.select(F.col(id_col).cast("string")).where(F.col(id_col).isNotNull()).write.mode("append").text(path)


def write_by_label(df: DataFrame, path: str, slug: Column | None = None, columns: tuple[str, ...] = ("id", "text", "language"), mode: str = "overwrite", spread: int = 8) -> None:
    """A folder for each label's slug. Rows whose slug is null aren't written.

    Labels are few and one may hold most rows, so rows are dealt by slug and a salt: each label has ``spread`` files or fewer.
    """
    slug = X.short_slug(F.col("language")) if slug is None else slug
    rows = df.select(slug.alias("slug"), *columns).where("slug IS NOT NULL")
    dealt = rows.repartition(F.col("slug"), F.pmod(F.xxhash64(*columns), F.lit(spread)))
    dealt.write.mode(mode).partitionBy("slug").option("maxRecordsPerFile", PART_ROWS).json(path)


def run_metadata(counts: DataFrame, **facts: str) -> DataFrame:
    """One row: given facts and ``language_counts`` (a map) of ``label, n``."""
    total = counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "n")))).alias("language_counts"), F.sum("n").alias("total"))
    return total.select(*[F.lit(v).alias(k) for k, v in facts.items()], "total", "language_counts")
