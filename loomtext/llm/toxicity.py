"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of: words, word beginnings of four and five bytes (compounding languages
put one stem in many words), pairs of neighbours, and pairs that skip a word, all hashed to
``2 ** BITS`` coordinates. Per-coordinate rates and L1 sparsity leave few weights; ``2 ** BITS``
bounds them whatever the corpus, so they may be broadcast.

The fit sees a bounded sample: about ``SAMPLE`` labelled rows, drawn by a hash of the id. Scores
cover every word of every text.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import columns, free_name, stored

BITS = 20
SAMPLE = 20_000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 2.0, 0.0
REJECT = 0.7
BIAS = 0
_TABLE = bytes(32 if chr(c) in string.punctuation else c for c in range(256))
_WORD, _PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def features(text: str | None) -> np.ndarray:
    """Coordinates of a text, repeats possible; none for null and wordless texts. 0 is the bias's own."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").translate(_TABLE).split()
    if not words:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(crc32, words), np.uint64, len(words))
    once = set(words)
    stems = [crc32(x, 4) for x in {w[:4] for w in once if len(w) > 4}] + [crc32(x, 5) for x in {w[:5] for w in once if len(w) > 5}]
    with np.errstate(over="ignore"):
        mixed = np.concatenate([h * _WORD, np.array(stems, np.uint64) * _WORD, (h[:-1] * _PAIR + h[1:]) * _WORD, (h[:-2] * _SKIP + h[2:]) * _WORD])
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64) | (mixed >> np.uint64(64 - BITS) == 0)


def ftrl(rows: list[np.ndarray], labels: list[int], epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> np.ndarray:
    """Weights of all coordinates; each row's coordinates are distinct and count 1. The bias isn't penalised."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    penalty = np.full(1 << BITS, l1)
    penalty[BIAS] = 0.0

    def at(i: np.ndarray | slice) -> np.ndarray:
        kept = np.maximum(np.abs(z[i]) - penalty[i], 0.0)
        return -np.sign(z[i]) * kept / ((beta + np.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for x, y in zip(rows, labels):
            i = np.concatenate([[BIAS], x])
            w = at(i)
            g = _sigmoid(w.sum()) - y
            grown = n[i] + g * g
            z[i] += g - (np.sqrt(grown) - np.sqrt(n[i])) / alpha * w
            n[i] = grown
    return at(slice(None))


def _sigmoid(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0))))


def training_side(doc_id: Column) -> Column:
    """Rows that the fit may see: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``) to coordinates and weights other than 0.

    Rows with a null id or label are left out. No labelled text: no weights, and every score is 0.5.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & training_side(F.col("doc_id")))
    usable = usable.select("doc_id", F.col("toxic").cast("int").alias("y"), F.xxhash64("doc_id", F.lit(7)).alias("h"))
    rate = min(1.0, sample / max(1, usable.count()))
    # Uniform hashes: about `sample` rows whatever the table's size, so this side may be broadcast.
    drawn = usable.where(F.col("h") <= F.lit(min(2**63 - 1, int(-(2**63) + rate * 2**64))))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"h": b["h"], "y": b["y"], "x": [np.unique(features(t)).astype(np.int32) for t in b["text"]]})

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, ys = [], []
        for b in batches:
            rows += [np.asarray(x) for x in b["x"]]
            ys += b["y"].tolist()
        if rows:
            w = ftrl(rows, ys)
            i = np.flatnonzero(w)
            yield pd.DataFrame({"i": i, "w": w[i]})

    seen = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("h", "y", "text").mapInPandas(extract, "h long, y int, x array<int>")
    # Many tasks write the sample's features; one, of bounded size, learns from them.
    one = stored(seen, "features").repartition(1).sortWithinPartitions("h", "y", "x")
    got = one.mapInPandas(learn, "i int, w double").toPandas()
    order = np.argsort(got["i"].to_numpy())
    return got["i"].to_numpy()[order], got["w"].to_numpy()[order]


def scores(docs: DataFrame, weights: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``docs`` with ``score`` (double, 0 to 1) and ``predicted`` (int) appended; its own columns of these names go.

    Null and wordless texts get the bias's score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        i, w = shared.value
        dense = np.zeros(1 << BITS)
        dense[i] = w
        weighed = dense != 0

        def score(text: str | None) -> float:
            x = features(text)
            return _sigmoid(dense[BIAS] + dense[np.unique(x[weighed[x]])].sum())

        for b in batches:
            yield pd.Series(np.fromiter(map(score, b), float, len(b)))

    out = docs.withColumn("score", scored(F.col("text")))
    return out.withColumn("predicted", (F.col("score") >= REJECT).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Only labels of rows that aren't held out are learned from. A null id is not held out. Repeated
    rows score alike. An empty table gives no rows; an empty label table gives 0.5 throughout.
    """
    held = F.coalesce(~training_side(F.col("doc_id")), F.lit(False)).alias("held_out")
    return scores(docs.select("doc_id", "text"), fit(docs, labels)).select("doc_id", held, "score", "predicted")


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, in its own columns, that score under ``REJECT``."""
    text = free_name(docs, "scored_text")
    seen = docs.select(F.struct(*columns(docs)).alias(text), F.col("text"))
    return scores(seen, fit(docs, labels)).where("predicted = 0").select(f"{text}.*")
