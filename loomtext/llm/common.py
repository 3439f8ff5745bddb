"""Shared pieces: table access, ASCII-whitespace words, and lineage cuts in shared storage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
#: Measured size up to which ``lookup`` broadcasts a table.
BROADCAST_BYTES = 8 << 20
SALTS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session, as a full URI.

    Only where Spark runs in one process (``local[n]``, as in tests) and names none, a temporary
    folder is made and set. Elsewhere a missing setting is an error: a machine's own folder would lose rows.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = f"file://{tempfile.mkdtemp(prefix='loomtext-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    system, path = _hadoop(spark, where)
    return system.makeQualified(path).toString().rstrip("/")


def _hadoop(spark: SparkSession, where: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def scratch(spark: SparkSession, name: str) -> str:
    """A new path for intermediate data, in this application's part of the shared folder.

    That part is deleted when the application ends; ``discard`` deletes what is done with earlier.
    """
    top = f"{shared_dir(spark)}/loomtext-{spark.sparkContext.applicationId}"
    system, path = _hadoop(spark, top)
    if not system.exists(path):
        system.mkdirs(path)
        system.deleteOnExit(path)
    return f"{top}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate data that nothing reads any more."""
    for p in paths:
        system, path = _hadoop(spark, p)
        system.delete(path, True)


def arrow_fs(where: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system for a URI and the path in it; an error where pyarrow knows none."""
    if where.startswith("file:/") and not where.startswith("file://"):
        where = f"file://{where.removeprefix('file:')}"
    return fs.FileSystem.from_uri(f"s3{where.removeprefix('s3a')}" if where.startswith("s3a://") else where)


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, what a write has shuffled is deleted as soon as the write is done. For writes only: nothing else reads their shuffles."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def bound_batches(spark: SparkSession, size: str = "8m") -> None:
    """Have texts cross to Python in Arrow batches of ``size`` bytes; sets the session's
    ``spark.sql.execution.arrow.maxBytesPerBatch``, whose default of 64 MB a worker can't afford several times over."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def stored(df: DataFrame, name: str = "cut", paths: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back; the path is added to ``paths``.

    This cuts the lineage with files that outlive executors, and keeps an input from being
    evaluated once for each of its uses.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    with freeing_shuffles(spark):
        df.write.parquet(path)
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def lookup(rows: DataFrame, few: DataFrame, key: str, salt: Column, how: str = "left") -> DataFrame:
    """``rows`` with the columns of ``few`` (stored, a row a key at most) at equal ``key``s.

    ``few`` is broadcast if it measures ``BROADCAST_BYTES`` at most. Otherwise both sides are dealt by the key and one of ``SALTS``
    numbers drawn from ``salt``, for each of which ``few`` is repeated, so that a hot key is no single task's.
    """
    width = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(c.cast("string")), F.lit(0)) + 8 for c in columns(few)])
    if (few.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(few), key, how)
    name = free_name(rows, "salt")
    spread = few.withColumn(name, F.explode(F.array(*map(F.lit, range(SALTS)))))
    return rows.withColumn(name, F.pmod(F.xxhash64(salt), F.lit(SALTS)).cast("int")).join(spread, [key, name], how).drop(name)


def columns(df: DataFrame, *names: str) -> list[Column]:
    """The named columns, or all; names may hold dots and back-quotes."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in (names or df.columns)]


def word_count(text: Column) -> Column:
    """Number of words; null counts as an empty text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a variant of it that no column of ``df`` has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = wanted
    while name.lower() in taken:
        name = f"_{name}"
    return name
