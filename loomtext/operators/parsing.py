"""Parsers of model responses: strict arrays, salvaged arrays, JSON lines, and a lenient mix."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROW = "struct<id:string,language:string>"
ROWS = f"array<{ROW}>"


def strict_array(response: Column) -> Column:
    """The rows of a response that is a JSON array; null for anything else."""
    return F.when(F.try_parse_json(response).isNotNull() & response.rlike(r"(?s)^\s*\[.*\]\s*$"), F.from_json(response, ROWS))


def salvaged_array(response: Column) -> Column:
    """The rows between the first [ and the last ]; null without a valid array there."""
    return strict_array(F.nullif(F.regexp_extract(response, r"(?s)\[.*\]", 0), F.lit("")))


def json_lines(response: Column) -> Column:
    """An object a line; a line that isn't one gives its first {...}. Rows without both keys go."""
    lines = F.filter(F.transform(F.split(response, r"\r?\n"), lambda x: F.regexp_extract(x, r"\{.*?\}", 0)), lambda x: (x != "") & F.try_parse_json(x).isNotNull())
    return good_rows(F.transform(lines, lambda x: F.from_json(x, ROW)))


def good_rows(rows: Column) -> Column:
    """Rows with an id and a language that aren't empty."""
    return F.filter(rows, lambda r: F.coalesce((r["id"] != "") & (r["language"] != ""), F.lit(False)))


def lenient(response: Column) -> Column:
    """A struct of ``results`` and ``invalid``: an array (of objects, or of arrays of them), salvaged if need be, else objects line by line
    with text around the braces trimmed. ``invalid`` counts non-blank lines or rows that gave nothing."""
    cut = F.regexp_extract(response, r"(?s)\[.*\]", 0)
    nested = F.when(F.try_parse_json(cut).isNotNull() & cut.rlike(r"\A\[\s*\["), F.flatten(F.from_json(cut, f"array<{ROWS}>")))
    array = F.coalesce(nested, salvaged_array(response))
    lines = F.filter(F.split(response, r"\r?\n"), lambda x: F.trim(x) != "")
    parsed = F.transform(lines, lambda x: F.from_json(F.when(F.try_parse_json(F.regexp_extract(x, r"\{.*\}", 0)).isNotNull(), F.regexp_extract(x, r"\{.*\}", 0)), ROW))
    rows = F.coalesce(array, parsed)
    kept = good_rows(F.filter(rows, lambda r: r.isNotNull()))
    return F.when(response.isNotNull(), F.struct(kept.alias("results"), (F.size(rows) - F.size(kept)).alias("invalid")))


def is_object(line: Column) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(line)).startswith("OBJECT"), F.lit(False))


def request(items: Column) -> Column:
    """The JSON array that a model is sent: ``array<struct<id,text>>``, null fields kept."""
    return F.to_json(items, {"ignoreNullFields": "false"})
