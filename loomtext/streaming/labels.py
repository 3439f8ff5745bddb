"""The cascade over a stream of files: resumable by Spark's checkpoint, deduplicated by content, written once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomtext.functions import text as X
from loomtext.operators import clean, rules
from loomtext.plans.cascade import PRESETS, Preset, run_cascade
from loomtext.sources.jsonl import parse_records


def stream_items(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """``id, text`` of new JSON lines under a folder."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    raw = reader.load(path).where(X.strip(F.col("value")) != "")
    return parse_records(raw).where("problem IS NULL").select("id", "text")


def stream_rule_labels(items: DataFrame) -> DataFrame:
    """Stateless lexicon labels of a stream of items."""
    gated = items.where(clean.has_id(F.col("id")) & clean.min_length(F.col("text")))
    return rules.lexicon_counts(gated).select("id", "text", rules.lexicon_rule().alias("label"))


def distinct_texts(items: DataFrame, time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """The first item of each text over the stream. With an event time, state is dropped after ``delay``; without, it grows with the texts."""
    keyed = items.withColumn("h", X.hash_key(F.col("text")))
    if time is None:
        return keyed.dropDuplicates(["h"])
    return keyed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["h"])


def run_stream(items: DataFrame, out: str, checkpoint: str, preset: Preset = PRESETS["cascade"], provider=None, cache: Callable[[], DataFrame] | None = None) -> StreamingQuery:
    """Label a stream in micro-batches: each batch's files go to its own folder, overwritten if the batch runs again."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()  # the cascade reads its items twice; a micro-batch is small
        labelled = run_cascade(batch, preset, cache=cache() if cache else None, provider=provider)
        labelled.write.mode("overwrite").parquet(f"{out}/batch={number}")
        batch.unpersist()

    return items.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def progress(query: StreamingQuery) -> DataFrame:
    """``batch, ts, rows, rows_per_s`` of the query's latest micro-batches, for rates and remaining time."""
    rows = [(p["batchId"], p["timestamp"], int(p["numInputRows"]), float(p.get("processedRowsPerSecond") or 0.0)) for p in query.recentProgress]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "batch long, ts string, rows long, rows_per_s double").withColumn("ts", F.to_timestamp("ts"))
