"""Tolerant readers: JSON lines, JSON arrays, plain lines, checkpoints, label files. Gzip is read by its suffix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomtext.functions import text as X
from loomtext.operators.parsing import is_object

#: Keys whose values are texts, in the order of each reader.
BODY_FIRST, TEXT_FIRST = ("body", "text"), ("text", "body")
DETECTOR = tuple("body text content comment message".split())
IDS = ("id", "_id", "cid")


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value, file``: stripped, non-blank lines without undecodable bytes (replacement marks go, genuine ones too)."""
    raw = spark.read.text(path).select(F.regexp_replace("value", "�", "").alias("value"), F.col("_metadata.file_path").alias("file"))
    return raw.select(X.strip(F.col("value")).alias("value"), "file").where("value <> ''")


def field(value: Column, name: str) -> Column:
    """A key's value as a string; null where it is missing, null, or no JSON object."""
    return F.get_json_object(value, f"$.{name}")


def parse_records(raw: DataFrame, ids: tuple[str, ...] = IDS, texts: tuple[str, ...] = BODY_FIRST) -> DataFrame:
    """``value`` lines to ``id, text, problem``: problem is ``malformed_json`` for lines that are no object, else null.

    Keys are tried in order and empty values fall through; JSON 0 and false count as texts here.
    """
    good = is_object(F.col("value"))
    pick = lambda keys: X.falsy_coalesce(*[field(F.col("value"), k) for k in keys])
    keep = [c for c in raw.columns if c != "value"]
    return raw.select(*keep, F.when(good, pick(ids)).alias("id"), F.when(good, pick(texts)).alias("text"), F.when(~good, "malformed_json").alias("problem"))


def read_jsonl(spark: SparkSession, path: str | list[str], **keys) -> DataFrame:
    """``id, text`` of the lines that are objects; the others are skipped."""
    return parse_records(lines(spark, path), **keys).where("problem IS NULL").drop("problem")


def skipped(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``reason, n`` of the lines that ``read_jsonl`` skips."""
    return parse_records(lines(spark, path)).where("problem IS NOT NULL").groupBy(F.col("problem").alias("reason")).agg(F.count("*").alias("n"))


def read_json_array(spark: SparkSession, path: str | list[str], ids: tuple[str, ...] = IDS, texts: tuple[str, ...] = BODY_FIRST) -> DataFrame:
    """``id, text`` of the objects of whole-file arrays. Elements that are no objects go; a file that
    doesn't parse gives no rows. A file is one value, so this is for documents that fit in a task."""
    whole = spark.read.text(path, wholetext=True).where(F.col("value").rlike(r"^\s*\["))
    items = whole.where(F.try_parse_json("value").isNotNull()).select(F.explode(F.from_json("value", "array<string>")).alias("value"))
    return parse_records(items, ids, texts).where("problem IS NULL").drop("problem")


def extract_text(value: Column) -> Column:
    """The text of a line that may be a JSON object, a JSON string, or plain text; null for other JSON and blanks."""
    v = F.try_parse_json(value)
    kind = F.schema_of_variant(v)
    strings = [F.when(F.schema_of_variant(F.try_variant_get(v, f"$.{k}", "variant")) == "STRING", F.try_variant_get(v, f"$.{k}", "string")) for k in DETECTOR]
    text = F.when(v.isNull(), X.strip(value)).when(kind.startswith("OBJECT"), X.first_text(*strings)).when(kind == "STRING", F.try_variant_get(v, "$", "string"))
    return F.nullif(X.strip(text), F.lit(""))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_id, value`` with physical line numbers from 1, by file; blank lines count.

    Files may be split: lines are numbered within a split in the order in which it is read, and splits by running counts of their
    lines. Only a row for each split meets in a window, one window a file.
    """
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start")]
    raw = spark.read.text(path).select("value", *place, F.monotonically_increasing_id().alias("_n"))
    splits = raw.groupBy("file", "_start").agg(F.min("_n").alias("_first"), F.count("*").alias("_lines"))
    before = F.coalesce(F.sum("_lines").over(Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = splits.select("file", "_start", "_first", before.alias("_before"))
    return raw.join(begins, ["file", "_start"]).select("file", (F.col("_n") - F.col("_first") + F.col("_before") + 1).alias("line_id"), "value")


def detector_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line_id, text`` of the lines that hold a text; others keep their numbers to themselves."""
    return numbered_lines(spark, path).select("line_id", extract_text(F.col("value")).alias("text")).where("text IS NOT NULL")


def read_checkpoint(spark: SparkSession, path: str | list[str], split_on_space: bool = False) -> DataFrame:
    """Distinct ``id``s, one a line; or separated by any white space."""
    value = F.explode(F.split("value", r"\s+")) if split_on_space else F.trim("value")
    return spark.read.text(path).select(value.alias("id")).where("id <> ''").distinct()


def read_label_files(spark: SparkSession, path: str | list[str], exclude: str = r"temp|completed_ids") -> DataFrame:
    """``id, language, file`` of label files; names that match ``exclude`` are left out. Order by file for last-wins."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"))
    kept = raw.where(~F.col("name").rlike(exclude) & is_object(F.col("value")))
    return kept.select(field(F.col("value"), "id").alias("id"), field(F.col("value"), "language").alias("language"), "file")


def label_of(value: Column) -> Column:
    """``language``, ``Language`` or ``label`` of a JSON line, else Unknown."""
    return F.coalesce(*[F.nullif(field(value, k), F.lit("")) for k in ("language", "Language", "label")], F.lit("Unknown"))
