"""The model boundary: batches of texts in, labels out, failures told apart.

A provider is any object with ``label(items) -> list of {id, language}``; it may answer in part, out of
order, twice, or with ids that were never sent, and it may raise. Retries stay inside a task.
No provider here uses a network.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.functions.lexicon import LABELS


class LabelProvider(Protocol):
    def label(self, items: list[dict]) -> list[dict]: ...


class HashProvider:
    """Labels by the text's MD5: the same answer in SQL."""

    def label(self, items: list[dict]) -> list[dict]:
        return [{"id": x["id"], "language": LABELS[int(hashlib.md5(x["text"].encode()).hexdigest()[:8], 16) % 4]} for x in items]


def hash_label(text: Column) -> Column:
    """What ``HashProvider`` says, as an expression."""
    i = (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 4).cast("int")
    return F.element_at(F.array(*map(F.lit, LABELS)), i + 1)


@dataclass(frozen=True)
class Retry:
    """Attempts for a batch, then for each item that is still missing; seconds to wait after a failure."""

    batch: int = 3
    item: int = 3
    wait: float = 0.0


def _ask(provider: LabelProvider, items: list[dict], attempts: int, wait: float) -> tuple[dict[str, str], str]:
    why = "empty_response"
    for k in range(attempts):
        try:
            known = {x["id"] for x in items}
            got: dict[str, str] = {}
            for r in provider.label(items) or []:
                if r.get("id") in known and r.get("language"):
                    got.setdefault(r["id"], r["language"])
            if got:
                return got, ""
        except Exception as e:  # a provider may fail in any way; the rows carry the reason
            text = str(e).lower()
            why = "content_filter" if "content" in text and "risk" in text else "rate_limit" if "429" in text or "rate limit" in text else "provider_error"
            if why == "content_filter":
                break
        if wait and k + 1 < attempts:
            time.sleep(wait)
    return {}, why


#: Bytes of texts that cross to a worker at once: what its memory follows, whatever the rows' number and length.
ARROW_BYTES = "8m"


def _in_whole_batches(frames: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in frames of a multiple of ``size`` rows, but for the last: a provider's batches don't end where a frame does."""
    held = None
    for f in frames:
        if f.num_rows == 0:
            continue
        held = f if held is None or held.num_rows == 0 else pa.Table.from_batches([held, f]).combine_chunks().to_batches()[0]
        whole = held.num_rows - held.num_rows % size
        if whole:
            yield held.slice(0, whole)
            held = held.slice(whole)
    if held is not None and held.num_rows:
        yield held


def label_batches(items: DataFrame, provider: LabelProvider, retry: Retry = Retry(), batch: int = 40, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id string, text string)`` to ``id, label, failure``: every row comes back, with a label or a reason.

    With a ``hint`` column its value goes to the provider as the item's ``hint``. The columns named in ``keep``
    come back with their rows, so that nothing has to be joined to the answers or evaluated again.

    Items missing from a batch's answer are asked for one by one. Labels outside the domain fail
    as ``unknown_label``. Ids within a batch should be distinct; rows that repeat one get the same label.
    Sets the session's ``spark.sql.execution.arrow.maxBytesPerBatch``.
    """
    items.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    names = ["id", "text", *["hint"] * ("hint" in items.columns)]
    sent = items.select(*names, *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)])
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "label", "failure")] + [T.StructField(c, items.schema[c].dataType) for c in keep])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in _in_whole_batches(frames, batch):
            out = []
            for at in range(0, f.num_rows, batch):
                part = [{**x, "text": x["text"] or ""} for x in f.slice(at, batch).select(names).to_pylist()]
                got, why = _ask(provider, part, retry.batch, retry.wait)
                for x in part:
                    label, reason = got.get(x["id"]), why
                    if label is None:
                        alone, reason = _ask(provider, [x], retry.item, retry.wait)
                        label = alone.get(x["id"])
                    if label is None:
                        out.append((x["id"], None, reason or "missing_from_response"))
                    elif label not in LABELS:
                        out.append((x["id"], None, "unknown_label"))
                    else:
                        out.append((x["id"], label, None))
            told = [pa.array([r[i] for r in out], pa.string()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(told + f.columns[len(names) :], names=schema.names)

    return sent.mapInArrow(run, schema)


def bpe_token_count(text: Column, encoding) -> Column:
    """Exact token counts by a given tokenizer (an object with ``encode``); a quarter of the characters where it fails."""

    @F.pandas_udf("long")
    def count(s: pd.Series) -> pd.Series:
        def one(t: str | None) -> int:
            if not t:
                return 0
            try:
                return len(encoding.encode(t))
            except Exception:
                return max(1, len(t) // 4)

        return s.map(one, na_action=None).astype("int64")

    return count(text)


def corpus_word_lid(texts: DataFrame, tokens: Column) -> DataFrame:
    """``(text, lang)`` to ``word, lang, prob, n``: each word's most frequent language, its share, and occurrences in all. Ties go to the first name."""
    # The filter holds for all tokens. Joins would infer it, and a plan that reads this twice would count the words twice.
    n = texts.select(F.explode(tokens).alias("word"), "lang").where("word IS NOT NULL").groupBy("word", "lang").agg(F.count("*").alias("n"))
    best = n.groupBy("word").agg(F.sum("n").alias("total"), F.min_by(F.struct("lang", "n"), F.struct(-F.col("n"), "lang")).alias("b"))
    return best.select("word", F.col("b.lang").alias("lang"), (F.col("b.n") / F.col("total")).alias("prob"), F.col("total").alias("n"))
