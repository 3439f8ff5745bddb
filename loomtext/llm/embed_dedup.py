"""Embedding near-duplicates by randomised-rotation binary codes with stored correction factors.

Each unit vector x is rotated at random several times; the signs of the rotated coordinates are its code,
packed to bits and stored once with two correction factors. Half A and half B of the rotations each give a
reconstruction r = (mean of the turned-back signs); with f = <r, x>, the stored factor, r / f is x plus noise at right
angles to x. The halves are independent, so <r_A(x) / f_A(x), r_B(y) / f_B(y)> is an unbiased estimate of <x, y>, and so
is its mean with x and y exchanged. The error is bounded with confidence by ``SIGMAS`` standard deviations, which follow from
the norms of the reconstructions. Pairs whose upper bound is under the threshold are settled by their codes; all others are
recomputed from the vectors in double precision, so no link is below the threshold.

Pairs are met in cells: each of several tables takes ``bits`` of the code's own bits as a cell. The
bits grow with log2 of the number of vectors, so cells keep their size; the number of tables
follows from them by the chance that a pair at the threshold agrees on all signs of a table. A pair
that shares several tables counts in the first one alone.

Only ids, codes and factors are dealt to the cells. Members that have an undecided pair in a cell then fetch their
vectors, and the cell's pairs are recomputed among them. Only counts and spanning forests leave a
cell, never its pairs; a cell of more than ``CELL`` members is dealt out again in pairs of chunks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import discard, stored
from loomtext.llm.components import connected_components

THRESHOLD = 0.9
#: Chance of meeting a pair exactly at the threshold in some table; closer pairs are met more surely.
RECALL = 0.98
SIGMAS = 4.0
#: Standard deviation of the mean of a pair's two estimates over that of one (0.71 if they were independent; 0.75 measured).
AVERAGED = 0.77
SEED = 20240
CELL = 1024
#: Unrelated vectors in a cell, as a power of two.
CELL_BITS = 7
#: Under so many dimensions the error's bound doesn't hold; codes settle nothing then.
LEAST_DIM = 16
KEYS = ["grid", "cell", "part"]
CELLS = "grid int, cell long, part long, node long, dim int, code binary, fa float, fb float"
PART = "grid int, cell long, part long, node long, chunk long, home boolean"
FOUND = "kind int, chunk long, " + CELLS

_ROTATIONS: dict[tuple[int, int, int], np.ndarray] = {}


def rotation(dim: int, which: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same on every machine; made once in a process."""
    key = (dim, which, seed)
    if key not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.default_rng([seed, dim, which]).standard_normal((dim, dim)))
        _ROTATIONS[key] = q * np.sign(np.diag(r))
    return _ROTATIONS[key]


def table_plan(vectors: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for a number of distinct vectors."""
    bits = max(4, min(30, round(math.log2(max(2, vectors))) - CELL_BITS))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def rotations(dim: int, plan: tuple[int, int]) -> int:
    """How many: an even number that has a bit for each table's bits."""
    return 2 * max(1, math.ceil(plan[0] * plan[1] / dim / 2))


def packed(x) -> bytes | None:
    """The components' bytes, in single precision where that loses nothing; None where the vector can't link:
    null, empty, zero, or a component null or not finite."""
    if x is None or len(x) == 0:
        return None
    v = np.array([np.nan if c is None else c for c in x] if isinstance(x, list) else x, dtype=np.float64) + 0.0
    if not np.isfinite(v).all() or not v.any():
        return None
    with np.errstate(over="ignore", under="ignore"):
        short = v.astype(np.float32)
    return short.tobytes() if (short == v).all() else v.tobytes()


def units(vecs, dim: int) -> np.ndarray:
    """Unit vectors in double precision from packed ones of one length."""
    if {len(x) for x in vecs} == {4 * dim}:
        v = np.frombuffer(b"".join(vecs), np.float32).reshape(-1, dim).astype(np.float64)
    else:
        v = np.stack([np.frombuffer(x, np.float32 if len(x) == 4 * dim else np.float64).astype(np.float64) for x in vecs])
    v /= np.abs(v).max(1, keepdims=True)
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def codes(unit: np.ndarray, plan: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign codes (a row of bytes each), and the correction factors of both halves."""
    dim = unit.shape[1]
    n = rotations(dim, plan)
    turned = [unit @ rotation(dim, k).T for k in range(n)]
    factor = [np.abs(t).sum(1) / math.sqrt(dim) for t in turned]
    signs = np.packbits(np.concatenate(turned, axis=1) > 0, axis=1, bitorder="little")
    return signs, np.mean(factor[: n // 2], axis=0).astype(np.float32), np.mean(factor[n // 2 :], axis=0).astype(np.float32)


def signs_of(code: np.ndarray, dim: int, plan: tuple[int, int]) -> np.ndarray:
    """The code's bits, a row for each vector."""
    return np.unpackbits(code, axis=1, bitorder="little", count=rotations(dim, plan) * dim)


def table_keys(signs: np.ndarray, plan: tuple[int, int]) -> np.ndarray:
    """The cell of each vector in each table, as int32."""
    bits, tables = plan
    return (signs[:, : bits * tables].reshape(len(signs), tables, bits).astype(np.int32) << np.arange(bits, dtype=np.int32)).sum(2, dtype=np.int32)


def estimates(signs: np.ndarray, fa: np.ndarray, fb: np.ndarray, dim: int, plan: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Both halves' reconstructions over their factors, and the squared norms of their noise."""
    half = rotations(dim, plan) // 2
    pm = signs.astype(np.float32) * 2 - 1
    out = []
    for at, f in ((0, fa), (half, fb)):
        back = np.concatenate([rotation(dim, at + k) for k in range(half)]).astype(np.float32) / (half * math.sqrt(dim))
        out.append(pm[:, at * dim : (at + half) * dim] @ back / f[:, None])
    a, b = out
    noise = [np.maximum(np.einsum("ij,ij->i", x, x) - 1, 0) for x in out]
    return a, b, noise[0], noise[1]


def undecided(signs: np.ndarray, keys: np.ndarray, fa: np.ndarray, fb: np.ndarray, dim: int, plan: tuple[int, int], grid: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of a cell that their codes don't settle and that share no table before ``grid``, chunk by chunk."""
    n = len(signs)
    if dim >= LEAST_DIM:
        a, b, na, nb = estimates(signs, fa, fb, dim, plan)
        rest = 1 - threshold**2
    for lo in range(0, n, 256):
        hi = min(n, lo + 256)
        if dim >= LEAST_DIM:
            variance = na[lo:hi, None] * (rest + nb) + nb * rest + na * (rest + nb[lo:hi, None]) + nb[lo:hi, None] * rest
            near = (a[lo:hi] @ b.T + b[lo:hi] @ a.T) / 2 + SIGMAS * AVERAGED * np.sqrt(variance / (2 * (dim - 1))) >= threshold - 1e-5
        else:
            near = np.ones((hi - lo, n), bool)
        i, j = np.nonzero(near)
        i += lo
        i, j = i[i < j], j[i < j]
        yield from _first_met(i, j, keys, grid)


def _first_met(i: np.ndarray, j: np.ndarray, keys: np.ndarray, grid: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs whose keys differ in all tables before ``grid``, in pieces of bounded size."""
    for at in range(0, len(i), 1 << 15):
        a, b = i[at : at + (1 << 15)], j[at : at + (1 << 15)]
        if grid:
            new = ~(keys[a, :grid] == keys[b, :grid]).any(1)
            a, b = a[new], b[new]
        if len(a):
            yield a, b


def linked_pairs(unit: np.ndarray, keys: np.ndarray, grid: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of a cell that link, in double precision, and share no table before ``grid``."""
    out_i, out_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo in range(0, len(unit), 256):
        i, j = np.nonzero(unit[lo : lo + 256] @ unit.T >= threshold - 1e-9)
        i += lo
        i, j = i[i < j], j[i < j]
        for a, b in _first_met(i, j, keys, grid):
            near = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
            out_i.append(a[near])
            out_j.append(b[near])
    return np.concatenate(out_i), np.concatenate(out_j)


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index of each one's tree."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _groups(x: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, int, np.ndarray, np.ndarray]]:
    """Rows that stand cell by cell, by length of vector: those of a length, and where its cells of several rows begin and end."""
    for dim, g in x.groupby("dim", sort=False):
        cell = g[KEYS].to_numpy()
        starts = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]).any(1)])
        ends = np.r_[starts[1:], len(g)]
        several = ends - starts > 1
        if several.any():
            yield g, int(dim), starts[several], ends[several]


def _codes_of(g: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(g["code"]), np.uint8).reshape(len(g), -1)


def _open_members(x: pd.DataFrame, plan: tuple[int, int], threshold: float) -> pd.DataFrame:
    """The rows of ``x`` that have an undecided pair in their cell. Pairs inside a chunk count where ``home`` says so."""
    out = [x.iloc[:0]]
    for g, dim, starts, ends in _groups(x):
        signs = signs_of(_codes_of(g), dim, plan)
        keys, fa, fb, grid = table_keys(signs, plan), g["fa"].to_numpy(), g["fb"].to_numpy(), g["grid"].to_numpy()
        parts = (g["chunk"].to_numpy(), g["home"].to_numpy()) if "chunk" in g else None
        hit = np.zeros(len(g), bool)
        for lo, hi in zip(starts.tolist(), ends.tolist()):
            at = slice(lo, hi)
            for i, j in undecided(signs[at], keys[at], fa[at], fb[at], dim, plan, int(grid[lo]), threshold):
                if parts is not None:
                    keep = (parts[0][at][i] != parts[0][at][j]) | parts[1][at][i]
                    i, j = i[keep], j[keep]
                hit[lo + i] = hit[lo + j] = True
        out.append(g[hit])
    return pd.concat(out)


def _settle(x: pd.DataFrame, plan: tuple[int, int], threshold: float) -> pd.DataFrame:
    """Weights linked to each node (kind 0: a, b), and a forest of the links (kind 1), of all cells in ``x``."""
    counts: dict[int, int] = {}
    links: set[tuple[int, int]] = set()
    for g, dim, starts, ends in _groups(x):
        node, weight, grid = g["node"].to_numpy(), g["weight"].to_numpy(), g["grid"].to_numpy()
        unit, keys = units(g["vec"].to_numpy(), dim), table_keys(signs_of(_codes_of(g), dim, plan), plan)
        chunks, homes = g["chunk"].to_numpy(), g["home"].to_numpy()
        for lo, hi in zip(starts.tolist(), ends.tolist()):
            at = slice(lo, hi)
            i, j = linked_pairs(unit[at], keys[at], int(grid[lo]), threshold)
            keep = (chunks[at][i] != chunks[at][j]) | homes[at][i]
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            n, w = node[at], weight[at]
            got = np.bincount(i, w[j], hi - lo) + np.bincount(j, w[i], hi - lo)
            root = _forest(hi - lo, i, j)
            for k in np.flatnonzero(got).tolist():
                counts[int(n[k])] = counts.get(int(n[k]), 0) + int(got[k])
                if root[k] != k:
                    links.add((int(n[k]), int(n[root[k]])))
    return pd.DataFrame([(0, n, w) for n, w in counts.items()] + [(1, a, b) for a, b in sorted(links)], columns=["kind", "a", "b"])


def _whole_cells(batches: Iterator[pd.DataFrame], done: Callable[[pd.DataFrame], pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of rows sorted by cell, cut so that ``done`` sees whole cells."""
    held = None
    for b in batches:
        x = b if held is None else pd.concat([held, b], ignore_index=True)
        if not len(x):
            continue
        last = (x[KEYS].to_numpy() == x[KEYS].iloc[-1].to_numpy()).all(1)
        held, ready = x[last], x[~last]
        if len(ready):
            yield done(ready)
    if held is not None:
        yield done(held)


def _cells(batches: Iterator[pd.DataFrame], plan: tuple[int, int], limit: int, threshold: float) -> Iterator[pd.DataFrame]:
    """Rows sorted by cell to those with an undecided pair (kind 1), or to all rows of a cell over ``limit`` (kind 2, with a chunk)."""
    held: pd.DataFrame | None = None
    large, passed = None, 0
    names = [c.split()[0] for c in FOUND.split(", ")]

    def done(x: pd.DataFrame) -> pd.DataFrame:
        return _open_members(x, plan, threshold).assign(kind=1, chunk=0, code=b"")[names]

    def deferred(x: pd.DataFrame) -> pd.DataFrame:
        nonlocal passed
        at = (passed + np.arange(len(x))) // (limit // 2)
        passed += len(x)
        return x.assign(kind=2, chunk=at)[names]

    for b in batches:
        if not len(b):
            continue
        x = b if held is None else pd.concat([held, b], ignore_index=True)
        held = None
        if large is not None:
            same = (x[KEYS].to_numpy() == np.array(large)).all(1)
            if same.any():
                yield deferred(x[same])
                x = x[~same]
            if not len(x):
                continue
            large, passed = None, 0
        last = (x[KEYS].to_numpy() == x[KEYS].iloc[-1].to_numpy()).all(1)
        held, ready = x[last], x[~last]
        size = ready.groupby(KEYS, sort=False)["node"].transform("size")
        for _, g in ready[size > limit].groupby(KEYS, sort=False):
            passed = 0
            yield deferred(g)
        yield done(ready[size <= limit])
        passed = 0
        if len(held) > limit:
            large = tuple(held[KEYS].iloc[-1].tolist())
            yield deferred(held)
            held = None
    if held is not None and len(held):
        yield done(held)


def coded(nodes: DataFrame, plan: tuple[int, int]) -> DataFrame:
    """``nodes`` (``node, weight, vec, dim`` and any others but for null values) with ``code, fa, fb``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, g in b.groupby("dim"):
                for at in range(0, len(g), 500):
                    p = g.iloc[at : at + 500]
                    code, fa, fb = codes(units(p["vec"], dim), plan)
                    yield p.assign(code=[x.tobytes() for x in code], fa=fa, fb=fb)

    return nodes.select("node", "weight", "vec", "dim").mapInPandas(run, "node long, weight long, vec binary, dim int, code binary, fa float, fb float")


def near_links(nodes: DataFrame, plan: tuple[int, int], threshold: float = THRESHOLD, limit: int = CELL, paths: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``coded`` nodes, their vectors distinct, to ``(node, linked)`` sums and ``(a, b)`` links.

    ``paths`` gets the intermediate data that the results read."""
    tables = plan[1]

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, g in b.groupby("dim"):
                for at in range(0, len(g), 1000):
                    p = g.iloc[at : at + 1000]
                    cells = table_keys(signs_of(_codes_of(p), dim, plan), plan)
                    out = p.loc[p.index.repeat(tables)]
                    # Vectors of other lengths are in other cells: the length is folded into the cell's number.
                    yield out.assign(grid=np.tile(np.arange(tables), len(p)), cell=cells.astype(np.int64).ravel() + (int(dim) << 31), part=0)[[c.split()[0] for c in CELLS.split(", ")]]

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _cells(batches, plan, limit, threshold)

    def second(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _whole_cells(batches, lambda x: _open_members(x, plan, threshold)[[c.split()[0] for c in PART.split(", ")]])

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _whole_cells(batches, lambda x: _settle(x, plan, threshold))

    rows = nodes.select("node", "dim", "code", "fa", "fb").mapInPandas(deal, CELLS)
    dealt = rows.repartition("grid", "cell").sortWithinPartitions("grid", "cell", "part")
    found = stored(dealt.mapInPandas(first, FOUND), "cells", paths)
    big = found.where("kind = 2").drop("kind")
    chunks = big.groupBy("grid", "cell").agg((F.max("chunk") + 1).alias("n"))
    parts = big.join(chunks, ["grid", "cell"]).withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    parts = parts.where((F.col("n") == 1) | (F.col("o") != F.col("chunk")))
    # A chunk's own pairs count in one part: with the next chunk, or the one before for the last.
    home = (F.col("n") == 1) | (F.col("o") == F.when(F.col("chunk") + 1 < F.col("n"), F.col("chunk") + 1).otherwise(F.col("chunk") - 1))
    parts = parts.withColumn("home", home).withColumn("part", F.least("o", "chunk") * F.col("n") + F.greatest("o", "chunk")).drop("n", "o")
    again = parts.repartition("grid", "cell", "part").sortWithinPartitions("grid", "cell", "part").mapInPandas(second, PART)
    whole = found.where("kind = 1").select("grid", "cell", "part", "node", "chunk", F.lit(True).alias("home"))
    fetched = whole.unionByName(again).join(nodes, "node").repartition("grid", "cell", "part").sortWithinPartitions("grid", "cell", "part")
    both = stored(fetched.mapInPandas(exact, "kind int, a long, b long"), "links", paths)
    return both.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("linked")), both.where("kind = 1").select("a", "b")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id, embedding``; other columns are ignored).

    Null, empty and zero vectors and those with a component that is null or not finite link with
    nothing; vectors of other lengths don't link. Equal vectors are linked and count each other;
    rows that repeat an id count as other vectors. A row with a null id counts as a link of others,
    but names no component: it has its group's name, or null. An empty table gives no rows.
    """
    spark, paths = vectors.sparkSession, []

    def prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).to_pylist()
            columns = [b.column(0), pa.array(list(map(packed, x)), pa.binary()), pa.array([len(v or ()) for v in x], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "vec", "dim"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(prepared, "vec_id long, vec binary, dim int")
    rows = stored(rows.withColumn("same", F.when(F.col("vec").isNotNull(), F.concat_ws("-", F.md5("vec"), "dim"))), "vectors")
    groups = rows.where("vec IS NOT NULL").groupBy("same").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"), F.first("vec").alias("vec"), F.first("dim").alias("dim"))
    # Groups without an id go by a 64-bit hash of their vector.
    groups = stored(groups.withColumn("node", F.coalesce("least", F.xxhash64("same"))), "groups")
    plan = table_plan(groups.count(), threshold, recall)
    nodes = stored(coded(groups, plan), "codes", paths)
    counts, links = near_links(nodes, plan, threshold, paths=paths)
    comp = connected_components(links, "a", "b")
    rooted = groups.select("same", "node", "least", "weight").join(comp, "node", "left").withColumn("root", F.coalesce("component_id", "node")).drop("component_id")
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").join(counts, "node", "left").select("same", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"), "component_id")
    named = stored(named, "named")
    discard(spark, *paths)
    out = rows.select("vec_id", "same").join(named, "same", "left")
    component = F.when(F.col("same").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
