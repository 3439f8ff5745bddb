"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits. The vector of segment bit counts, in
{0, 1, 2}^32, is kept as a 64-bit thermometer code (0 -> 00, 1 -> 01, 2 -> 11), so that the Manhattan
distance of two vectors is the bit count of the XOR of their codes. It never exceeds the Hamming
distance of the fingerprints.

Grid range-join: the 32 coordinates form six blocks (more for very many fingerprints). Vectors within
Manhattan distance 3 differ in three blocks at most, so they agree on all the others and meet in one of
20 grids, whose cells are the coordinates of three blocks. In each cell the Manhattan bound drops pairs, then the fingerprints decide.

Only distinct fingerprints enter. A cell gives a spanning forest of its links, never its pairs; a
cell of more than ``CELL`` members is dealt out again in pairs of chunks, so no task holds it.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import columns, discard, free_name, stored
from loomtext.llm.components import connected_components

SHINGLE = 3
SEED = 42
MAX_BITS = 3
BLOCKS = 6
CELL = 1024
#: Shingles whose hashes are held at a time; longer texts are summed in pieces.
PIECE = 1 << 16
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint; null counts as empty. A bit is 1 if set in over half the hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    k = min(shingle, len(words))
    n = len(words) - k + 1
    a, b, digest = starts[:n].tolist(), ends[k - 1 :].tolist(), xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for i in range(0, n, PIECE):
        h = np.fromiter((digest(joined[x:y], SEED) for x, y in zip(a[i : i + PIECE], b[i : i + PIECE])), np.uint64)
        counts += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp long)`` of every row. Ids pass through Arrow untouched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter(map(fingerprint, b.column(1).to_pylist()), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def blocks_for(fingerprints: int) -> int:
    """Blocks for a number of distinct fingerprints: cells tell some 48 * (blocks - 3) / blocks bits apart,
    and hold a few dozen unrelated members at most. All of them find every link; more blocks mean more, smaller cells."""
    need = math.log2(max(2, fingerprints)) - 4
    return next((b for b in range(BLOCKS, 12) if 48 * (b - MAX_BITS) / b >= need), 12)


def grid_masks(blocks: int = BLOCKS, most: int = MAX_BITS) -> list[int]:
    """Signed masks over thermometer codes: for each grid, the coordinates of ``blocks - most`` blocks."""
    edges = [round(i * 32 / blocks) * 2 for i in range(blocks + 1)]
    whole = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    masks = [sum(x) for x in itertools.combinations(whole, blocks - most)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def thermometer(fp):
    """The code of the segment counts, as a column of the same type."""
    odd = F.lit(0x5555555555555555)
    low, high = fp.bitwiseAND(odd), F.shiftrightunsigned(fp, 1).bitwiseAND(odd)
    return F.shiftleft(low.bitwiseAND(high), 1).bitwiseOR(low.bitwiseOR(high))


def forest(node: np.ndarray, code: np.ndarray, fp: np.ndarray, most: int = MAX_BITS) -> list[tuple[int, int]]:
    """A spanning forest of the links among members of a cell: (member, smallest node of its tree)."""
    order = np.argsort(node, kind="stable")
    node, code, fp = node[order], code[order].view(np.uint64), fp[order].view(np.uint64)
    out, left = [], np.ones(len(node), bool)
    for seed in range(len(node)):
        if not left[seed]:
            continue
        left[seed] = False
        front = [seed]
        while front:
            at = front.pop()
            rest = np.flatnonzero(left)
            rest = rest[np.bitwise_count(code[rest] ^ code[at]) <= most]  # the lower bound
            rest = rest[np.bitwise_count(fp[rest] ^ fp[at]) <= most]
            left[rest] = False
            front += rest.tolist()
            out += [(int(node[x]), int(node[seed])) for x in rest]
    return out


def _cells(batches: Iterator[pd.DataFrame], limit: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by (grid, cell, part) to links (kind 0), or to the rows of cells over ``limit`` (kind 1, b: chunk)."""
    keys = ["grid", "cell", "part"]
    held: pd.DataFrame | None = None
    large: tuple | None = None  # the key of a cell that is passed through, and its rows so far
    passed = 0
    empty = {"a": np.int64, "b": np.int64, "kind": np.int32, "grid": np.int32, "cell": np.int64, "fp": np.int64, "code": np.int64}

    def done(x: pd.DataFrame) -> pd.DataFrame:
        links: list[tuple[int, int]] = []
        k = x[keys].to_numpy()
        starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(1)]) if len(x) else np.zeros(0, int)
        ends = np.r_[starts[1:], len(x)]
        node, code, fp = x["node"].to_numpy(), x["code"].to_numpy(), x["fp"].to_numpy()
        for i, j in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
            links += forest(node[i:j], code[i:j], fp[i:j])
        links = np.array(sorted(set(links)), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": links[:, 0], "b": links[:, 1], "kind": 0, "grid": 0, "cell": 0, "fp": 0, "code": 0}).astype(empty)

    def deferred(x: pd.DataFrame) -> pd.DataFrame:
        nonlocal passed
        at = (passed + np.arange(len(x))) // (limit // 2)
        passed += len(x)
        return pd.DataFrame({"a": x["node"], "b": at, "kind": 1, "grid": x["grid"], "cell": x["cell"], "fp": x["fp"], "code": x["code"]}).astype(empty)

    for b in batches:
        if not len(b):
            continue
        x = b if held is None else pd.concat([held, b], ignore_index=True)
        held = None
        if large is not None:
            same = (x[keys].to_numpy() == np.array(large)).all(1)
            if same.any():
                yield deferred(x[same])
                x = x[~same]
            if not len(x):
                continue
            large, passed = None, 0
        last = (x[keys].to_numpy() == x[keys].iloc[-1].to_numpy()).all(1)
        held, ready = x[last], x[~last]
        size = ready.groupby(keys, sort=False)["node"].transform("size")
        for _, g in ready[size > limit].groupby(keys, sort=False):
            passed = 0
            yield deferred(g)
        yield done(ready[size <= limit])
        passed = 0
        if len(held) > limit:
            large = tuple(held[keys].iloc[-1].tolist())
            yield deferred(held)
            held = None
    if held is not None and len(held):
        yield done(held)


LINKS = "a long, b long, kind int, grid int, cell long, fp long, code long"


def fingerprint_links(nodes: DataFrame, blocks: int = BLOCKS, limit: int = CELL, paths: list[str] | None = None) -> DataFrame:
    """``(node long, fp long)``, fps distinct, to links ``(a, b)`` whose components are those of all links.

    ``paths`` gets the intermediate data that the result reads."""
    code = nodes.select("node", "fp", thermometer(F.col("fp")).alias("code"))
    grids = F.explode(F.array(*[F.struct(F.lit(i).alias("grid"), F.col("code").bitwiseAND(F.lit(m)).alias("cell")) for i, m in enumerate(grid_masks(blocks))]))
    rows = code.select("node", "fp", "code", grids.alias("g")).select("node", "fp", "code", "g.grid", "g.cell", F.lit(0).cast("long").alias("part"))
    first = _in_cells(rows, limit)
    found = stored(first, "cells", paths)
    big = found.where("kind = 1").select(F.col("a").alias("node"), "fp", "code", "grid", "cell", F.col("b").alias("chunk"))
    chunks = big.groupBy("grid", "cell").agg((F.max("chunk") + 1).alias("n"))
    # Every pair of chunks meets in one part: chunk c is in parts (min, max) for each other chunk.
    parts = big.join(chunks, ["grid", "cell"]).withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    one = (F.col("n") == 1) | (F.col("o") != F.col("chunk"))
    parts = parts.where(one).withColumn("part", (F.least("o", "chunk") * F.col("n") + F.greatest("o", "chunk")))
    second = _in_cells(parts.select("node", "fp", "code", "grid", "cell", "part"), limit)
    return found.where("kind = 0").select("a", "b").unionByName(second.where("kind = 0").select("a", "b"))


def _in_cells(rows: DataFrame, limit: int) -> DataFrame:
    dealt = rows.repartition("grid", "cell", "part").sortWithinPartitions("grid", "cell", "part")
    return dealt.mapInPandas(lambda it: _cells(it, limit), LINKS)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs`` (``doc_id, text``; other columns are ignored).

    Fingerprints link at ``MAX_BITS`` or fewer differing bits; component_id is the smallest doc_id
    reachable. Null and wordless texts have fingerprint zero, linked like any other. A row with a
    null id links others, but gives the component no name: null if no row of it has an
    id. Rows that repeat an id are returned as often. An empty table gives no rows.
    """
    spark, paths = docs.sparkSession, []
    fps = stored(fingerprints(docs), "fps")
    named = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    # The fingerprint itself is the node, so ids of any value, and none, are alike.
    links = fingerprint_links(named.select(F.col("fp").alias("node"), "fp"), blocks_for(named.count()), paths=paths)
    found = connected_components(links, "a", "b")
    rooted = named.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component_id", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = stored(rooted.join(names, "root").select("fp", "component_id"), "components")
    discard(spark, *paths)
    return fps.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row for each group of near duplicates: that with the smallest doc_id.

    Rows that repeat an id are one document: of those that are their group's, the one with the
    first text in order stays. Rows with a null id name no group and all stay.
    """
    comp = near_duplicates(docs)
    kept = comp.where("doc_id = component_id").select("doc_id").distinct()
    row = free_name(docs, "kept_row")
    one = docs.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*columns(docs)), F.struct("text")).alias(row)).select(f"{row}.*")
    return one.unionByName(docs.where(F.col("doc_id").isNull()))
