"""Byte-level BPE encoding and decoding by merge replay.

An inverted index maps each mergeable pair, named by the rank of what it merges to, to its positions in a vocabulary of
distinct words; merges are applied in rank order to all their positions at once, and only
the neighbours they touch are looked up and indexed again. Each occurrence then takes its word's ids.

``encode_corpus`` has one vocabulary for the corpus: blocks of documents (``BLOCK_CHARS`` characters) are numbered by their own
distinct words; the words are dealt by word, so each is replayed in one task, in portions of ``REPLAY_BYTES``; their ids go back to the
blocks, ahead of the blocks' documents. The most frequent word is a row for each block.

``encode`` replays the vocabulary of each block by itself. Ids of a word depend on nothing but its bytes, so the result is the same and
nothing is dealt. The queries use it: the README has the figures of both.

The rank table has a fixed size (some 50,000 entries) and is broadcast.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.llm.common import bound_batches, free_name, stored

BLOCK_CHARS = 8 << 20
#: Bytes of distinct words that a task replays together.
REPLAY_BYTES = 4 << 20
NONE = np.int32(2**31 - 1)


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line for each token, base64 bytes and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Merges:
    """What replay needs of the ranks: single bytes' ids, and the rank of each pair of ids that merges."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.base = max(ranks.values()) + 1
        self.bytes_id = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        pairs = [(ranks[t[:i]] * self.base + ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.keys, self.values = table[:, 0].copy(), table[:, 1].astype(np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.base + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def word(self, word: bytes) -> list[int]:
        """One word by the definition: merge the leftmost pair of the lowest rank until none is left."""
        n = len(word)
        parts: list[bytes | None] = [bytes([c]) for c in word]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def enter(i: int, j: int) -> None:
            if (r := self.ranks.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (r, i, len(parts[i]) + len(parts[j])))

        for i in range(n - 1):
            enter(i, i + 1)
        while heap:
            r, i, size = heapq.heappop(heap)
            j = after[i]
            # Parts only grow, so a pair of this length at this place is the one that was entered.
            if parts[i] is None or j >= n or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                enter(i, k)
            if before[i] >= 0:
                enter(before[i], i)
        return [self.ranks[p] for p in parts if p is not None]


def replay(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after the other, and where each word's begin (with a last offset)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    n = int(lengths.sum())
    if not n:
        return np.zeros(0, np.int32), np.zeros(len(words) + 1, np.int64)
    ends = np.cumsum(lengths)
    ids = merges.bytes_id[np.frombuffer(b"".join(words), np.uint8)]
    after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    full = lengths > 0
    after[ends[full] - 1] = -1
    before[(ends - lengths)[full]] = -1
    live = np.ones(n, bool)
    rank = np.full(n, NONE, np.int32)
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []
    odd: set[int] = set()  # positions whose words need the definition

    def enter(at: np.ndarray) -> None:
        """Index the pairs that begin at these positions."""
        r = rank[at]
        at, r = at[r != NONE], r[r != NONE]
        order = np.argsort(r, kind="stable")
        at, r = at[order], r[order]
        cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
        for part, value in zip(np.split(at, cuts), r[np.r_[0, cuts]].tolist() if len(r) else []):
            if value in index:
                index[value].append(part)
            else:
                index[value] = [part]
                heapq.heappush(heap, value)

    pairs = np.flatnonzero(after >= 0).astype(np.int32)
    rank[pairs] = merges.rank(ids[pairs], ids[after[pairs]])
    enter(pairs)
    while heap:
        r = heapq.heappop(heap)
        parts = index.pop(r)
        at = parts[0] if len(parts) == 1 else np.concatenate(parts)
        at = at[rank[at] == r]
        if not len(at):
            continue
        if len(parts) > 1:
            at = np.unique(at)
        # Runs of overlapping pairs: every second one from the left merges.
        if len(at) > 1:
            apart = np.r_[True, after[at[:-1]] != at[1:]]
            if not apart.all():
                i = np.arange(len(at))
                at = at[(i - np.maximum.accumulate(np.where(apart, i, 0))) % 2 == 0]
        gone = after[at]
        beyond = after[gone]
        ids[at], live[gone], rank[gone] = r, False, NONE
        after[at] = beyond
        inner = beyond >= 0
        before[beyond[inner]] = at[inner]
        left = before[at]
        touched = np.concatenate([at, left[left >= 0]])
        if len(touched) > 1:
            touched = np.unique(touched)
        last = after[touched] < 0
        rank[touched[last]] = NONE
        touched = touched[~last]
        now = merges.rank(ids[touched], ids[after[touched]])
        rank[touched] = now
        if (early := now < r).any():  # not in rank order: the definition decides for these words
            odd.update(touched[early].tolist())
        enter(touched)
    which = np.repeat(np.arange(len(words)), lengths)
    sizes = np.bincount(which[live], minlength=len(words))
    flat, offsets = ids[live], np.r_[0, np.cumsum(sizes)]
    if odd:
        per = np.split(flat, offsets[1:-1])
        for w in set(which[list(odd)].tolist()):
            per[w] = np.array(merges.word(words[w]), np.int32)
        flat, offsets = np.concatenate(per), np.r_[0, np.cumsum([len(x) for x in per])]
    return flat.astype(np.int32), offsets


def joined(ids: np.ndarray, tokens: dict[int, bytes]) -> bytes:
    """The bytes of ids."""
    return b"".join(map(tokens.__getitem__, ids.tolist()))


def _encoded(batches: Iterator[pa.RecordBatch], column: int, merges: Merges, pattern: str, block: int, names: list[str], decoded: bool) -> Iterator[pa.RecordBatch]:
    find = regex.compile(pattern).findall
    tokens = {r: t for t, r in merges.ranks.items()} if decoded else {}
    vocabulary: defaultdict[str, int] = defaultdict(count().__next__)
    held: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        flat, offsets = replay([w.encode("utf-8") for w in vocabulary], merges)
        sizes = np.diff(offsets)
        for batch, occurrences, per_doc in held:
            n = sizes[occurrences]
            ends = np.cumsum(n)
            ids = flat[np.repeat(offsets[occurrences] - (ends - n), n) + np.arange(int(n.sum()))]
            bounds = np.r_[0, ends][np.r_[0, np.cumsum(per_doc)]]
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            more = [pa.array([joined(ids[a:b], tokens) for a, b in zip(bounds.tolist(), bounds[1:].tolist())], pa.binary())] if decoded else []
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, *more], names=names)
        held.clear()
        vocabulary.clear()

    for batch in batches:
        for i in range(0, batch.num_rows, 1000):
            piece = batch.slice(i, 1000)
            occurrences, per_doc = [], []
            for text in piece.column(column).to_pylist():
                found = [vocabulary[w] for w in find(text)] if text else []
                size += len(text or "")
                per_doc.append(len(found))
                occurrences.append(np.array(found, np.int32))
            held.append((piece, np.concatenate(occurrences), np.array(per_doc, np.int64)))
            if size >= block:
                yield from flush()
                vocabulary = defaultdict(count().__next__)
                size = 0
    if held:
        yield from flush()


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids", block: int = BLOCK_CHARS, decoded: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` (array of int) appended under a free name; text isn't changed. Vocabularies are those of blocks of documents.

    Every match of ``pattern`` is encoded by itself, special tokens are plain text. Null and empty
    texts have no ids. Repeated rows encode alike; an empty table gives no rows. Characters outside
    every match of the pattern have no ids (the public patterns match all). With ``decoded`` the bytes that the ids decode to
    are appended too, made in the same worker: a worker for decoding beside each would cost memory.
    """
    name = free_name(docs, ids)
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    at = docs.columns.index(text)
    more = [T.StructField(free_name(docs, decoded), T.BinaryType())] if decoded else []
    out = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType(), False), True), *more])
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _encoded(batches, at, Merges(shared.value), pattern, block, names, bool(more))

    return docs.mapInArrow(run, out)


def _numbered(batches: Iterator[pa.RecordBatch], column: int, keep: list[int], pattern: str, block: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of each block: its documents with the numbers of their words, then one row with the words in order of their numbers."""
    from pyspark import TaskContext

    find = regex.compile(pattern).findall
    t = TaskContext.get().partitionId() << 32
    vocabulary: defaultdict[str, int] = defaultdict(count().__next__)
    size, types = 0, []

    def words() -> pa.RecordBatch:
        lists = pa.array([list(vocabulary)], pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([pa.array([t], pa.int64()), lists, *(pa.nulls(1, x) for x in types), pa.nulls(1, pa.list_(pa.int32()))], names=names)

    for batch in batches:
        types = [batch.schema.types[i] for i in keep]
        for i in range(0, batch.num_rows, 1000):
            piece = batch.slice(i, 1000)
            found = []
            for text in piece.column(column).to_pylist():
                found.append(np.array([vocabulary[w] for w in find(text)] if text else [], np.int32))
                size += len(text or "")
            n = len(found)
            numbers = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(x) for x in found])], pa.int32()), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, t)), pa.nulls(n, pa.list_(pa.string())), *(piece.column(k) for k in keep), numbers], names=names)
            if size >= block:
                yield words()
                vocabulary, size, t = defaultdict(count().__next__), 0, t + 1
    if vocabulary:
        yield words()


def _replayed(batches: Iterator[pa.RecordBatch], merges: Merges) -> Iterator[pa.RecordBatch]:
    """``(word, t, k)`` sorted by word to ``t, k, ids``."""
    held: list[pa.RecordBatch] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(held).combine_chunks()
        coded = whole.column(0).chunk(0).dictionary_encode()
        flat, offsets = replay([w.encode("utf-8") for w in coded.dictionary.to_pylist()], merges)
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
        for i in range(0, len(whole), 1 << 16):
            at = coded.indices.slice(i, 1 << 16)
            yield pa.RecordBatch.from_arrays([whole.column(1).chunk(0).slice(i, 1 << 16), whole.column(2).chunk(0).slice(i, 1 << 16), lists.take(at)], names=["t", "k", "ids"])

    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        size += b.column(0).nbytes
        if size >= REPLAY_BYTES:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


def _assembled(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """``(t, k, ids, columns of the documents, numbers)``, each block's words in order before its documents, to the documents with ids."""
    block, parts, table = None, [], None
    for b in batches:
        t, word = b.column(0).to_numpy(), b.column(1).is_valid().to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((t[1:] != t[:-1]) | (word[1:] != word[:-1])) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(t)]):
            if lo == hi:
                continue
            piece = b.slice(lo, hi - lo)
            if t[lo] != block:
                block, parts, table = t[lo], [], None
            if word[lo]:
                parts.append(piece.column(2))
                continue
            if table is None:
                ids = pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))
                sizes = ids.value_lengths().to_numpy()
                table, parts = (ids.flatten().to_numpy(), np.r_[0, np.cumsum(sizes)][:-1], sizes), []
            flat, starts, sizes = table
            numbers = piece.column(piece.num_columns - 1)
            at, per_doc = numbers.flatten().to_numpy(), numbers.value_lengths().to_numpy()
            n = sizes[at]
            ends = np.cumsum(n)
            ids = flat[np.repeat(starts[at] - (ends - n), n) + np.arange(int(n.sum()))]
            bounds = np.r_[0, ends][np.r_[0, np.cumsum(per_doc)]]
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*piece.columns[3:-1], lists], names=names)


def encode_corpus(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids", block: int = BLOCK_CHARS, keep_text: bool = True) -> DataFrame:
    """What ``encode`` gives, by one vocabulary of the whole corpus; ``keep_text`` false leaves the text out.

    Intermediate data: the numbers of the texts' words twice, and each block's distinct words and their ids once.
    """
    spark, name = docs.sparkSession, free_name(docs, ids)
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(ranks)
    at = docs.columns.index(text)
    kept = [i for i in range(len(docs.columns)) if keep_text or i != at]
    fields = [docs.schema.fields[i] for i in kept]
    nullable = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)]
    numbers = T.StructField("numbers", T.ArrayType(T.IntegerType()))
    numbered = T.StructType([T.StructField("t", T.LongType()), T.StructField("words", T.ArrayType(T.StringType())), *nullable, numbers])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _numbered(batches, at, kept, pattern, block, numbered.names)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _replayed(batches, Merges(shared.value))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _assembled(batches, [*(f.name for f in fields), name])

    cut = stored(docs.mapInArrow(number, numbered), "words")
    words = cut.where("words IS NOT NULL").select("t", F.posexplode("words").alias("k", "word")).select("word", "t", "k")
    # A partition for each block: texts, or their numbers, are what is dealt.
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), cut.where("words IS NOT NULL").count())
    coded = words.repartition(n, "word").sortWithinPartitions("word").mapInArrow(code, "t long, k int, ids array<int>")
    none = lambda f: F.lit(None).cast(f.dataType).alias(f.name)
    both = coded.select("t", "k", "ids", *map(none, [*nullable, numbers])).unionByName(
        cut.where("words IS NULL").select("t", F.lit(None).cast("int").alias("k"), F.lit(None).cast("array<int>").alias("ids"), *(f.name for f in nullable), "numbers")
    )
    dealt = both.repartition(n, "t").sortWithinPartitions("t", F.col("k").asc_nulls_last())
    return dealt.mapInArrow(assemble, T.StructType([*fields, T.StructField(name, T.ArrayType(T.IntegerType(), False), True)]))


def decode(spark: SparkSession, ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of an array of ids; null for null."""
    shared = spark.sparkContext.broadcast(ranks)

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = {r: t for t, r in shared.value.items()}
        for b in batches:
            yield pd.Series([None if x is None else joined(np.asarray(x), table) for x in b], dtype=object)

    return run(ids)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row."""
    coded = encode(docs.select("doc_id", "text"), load_ranks(path), pattern, decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
