"""Exact removal of repeated passages: shard Burrows-Wheeler transforms merged by interleave refinement.

A byte goes if a 50-byte string that covers it also starts in a document with a smaller doc_id.

1. Winnowing cuts the work without losing a match. Each 50-byte window names the 26-byte gram of lowest hash in
   it as its anchor; equal windows have equal anchors at the same place. Windows of one anchor
   are a run, and the bytes they span (74 at most) are a segment. Anchors seen in one document only are
   dropped: no window of theirs can repeat.
2. The segments that are left are dealt by anchor, one row for each block of documents and distinct
   segment, so a passage in a third of all documents is a row a block. Where the segments of an anchor differ,
   they are cut into shards; each shard's suffixes are sorted and give its transform. The merge never sorts
   all suffixes again: it refines the interleave of the shards by one symbol in each of 50 rounds, and
   the round that parts two neighbours is their common prefix. What 50 rounds don't part
   is a repeated interval; its smallest doc_id settles each of its windows.
   The segments of a gram with over ``HOT`` rows are cut into their windows, which are dealt by
   their own bytes, so no task has more of an anchor than that. Copies of a segment in a block are one row, however many they are.
3. Each block of documents reads the verdicts on its segments and removes bytes.

Blocks are written once, so their numbers hold whatever becomes of a task. Verdicts are read from the
shared folder through pyarrow's file systems; each block has a file there even if it has no verdict, so a missing one is an error.
They are named by two 64-bit hashes, of the segment and of its anchor.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import arrow_fs, freeing_shuffles, scratch

LENGTH = 50
GRAM = 26
SPAN = LENGTH - GRAM + 1
#: Bytes of texts that are hashed at a time, so that arrays stay in a processor cache; positions within take the low bits of a key.
PIECE_BYTES = 1 << 15
PIECE_BITS = 20
#: Bytes of segments in a shard, and in a portion of whole anchors; merges that fit a processor cache are twice as fast.
SHARD_BYTES = 1 << 17
MERGE_BYTES = 1 << 19
#: Text bytes whose anchors a task counts together, and whose segments it gathers together.
GATHER_BYTES = 48 << 20
#: Low bits of hashes that a first look-up compares.
FILTER_BITS = 22
#: Text bytes that are cleaned together.
CUT_BYTES = 4 << 20
#: Segments of an anchor, distinct in a portion of a block, above which its windows are dealt one by one.
HOT = 20_000
#: Occurrences of an anchor in a portion above which its distinct segments are counted; up to it, each counts.
OFTEN = 8
LAST = np.iinfo(np.int64).max
#: Parts of the anchors for each task that takes them, so that tasks get about as much.
FINE = 16
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93)]


def runs(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hashes, and first and last window, of all runs of a text; none under 50 bytes."""
    return runs_of(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[:3]


def runs_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hashes, first and last window (places in ``data``) and number of the text, of all runs of several texts.

    Text ``k`` is ``data[offsets[k]:offsets[k + 1]]``. Short texts are hashed together, long ones in pieces that begin at fixed
    places of the text, so a text's runs do not depend on the texts beside it.
    """
    n, step = len(offsets) - 1, PIECE_BYTES
    found, i = [], 0
    while i < n:
        at, end = int(offsets[i]), int(offsets[i + 1])
        if end - at > step:
            for k in range(at, end - LENGTH + 1, step):
                h, first, last = _runs(data[k : min(end, k + step + LENGTH - 1)], k, ())
                found.append((h, first, last, np.full(len(h), i)))
            i += 1
        else:
            j = max(i + 1, int(np.searchsorted(offsets, at + step, side="right")) - 1)
            if offsets[j] - at >= LENGTH:
                h, first, last = _runs(data[at : offsets[j]], at, (offsets[i + 1 : j] - at).tolist())
                found.append((h, first, last, i + np.searchsorted(offsets[i : j + 1], first, side="right") - 1))
            i = j
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _words(text: np.ndarray, size: int) -> np.ndarray:
    """The little-endian number of ``size`` bytes at each place of a text."""
    text = np.ascontiguousarray(text)
    return np.ndarray((len(text) - size + 1,), f"<u{size}", text, strides=(1,)).copy()


def _runs(text: np.ndarray, at: int, inner: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of texts that stand one after another, begun at ``inner`` but for the first; no window lies in two of them."""
    n = len(text)
    grams, windows = n - GRAM + 1, n - LENGTH + 1
    with np.errstate(over="ignore"):
        w8, w2 = _words(text, 8), _words(text, 2)
        h = w8[:grams] * _K[0]
        h ^= h >> np.uint64(31)
        h += w8[8 : 8 + grams] * _K[1]
        h ^= h >> np.uint64(29)
        h += w8[16 : 16 + grams] * _K[2]
        h ^= h >> np.uint64(32)
        h += w2[24 : 24 + grams].astype(np.uint64)
        h *= _K[4]
        h ^= h >> np.uint64(32)
    low = np.uint64((1 << PIECE_BITS) - 1)
    m = (h & ~low) | np.arange(grams, dtype=np.uint64)
    for k in (1, 2, 4, 8):
        m = np.minimum(m[:-k], m[k:])
    m = np.minimum(m[:windows], m[SPAN - 16 : SPAN - 16 + windows])
    anchor = (m & low).astype(np.int64)
    for k in inner:
        anchor[max(0, k - LENGTH + 1) : k] = -1
    first = np.r_[0, np.flatnonzero(anchor[1:] != anchor[:-1]) + 1]
    last = np.r_[first[1:] - 1, windows - 1]
    if inner:
        inside = anchor[first] >= 0
        first, last = first[inside], last[inside]
    return h[anchor[first]], first + at, last + at


def sorted_suffixes(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array of the segments, each closed by a separator of its own that sorts first; their transform, and the symbols before its symbols.

    Symbols are byte + 1, separators 0.
    """
    sizes = np.fromiter(map(len, segments), np.int64, len(segments)) + 1
    text = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8).astype(np.int64) + 1
    ends = np.cumsum(sizes)
    text[ends - 1] = 0
    n, longest = len(text), int(sizes.max())
    # Symbols beyond a segment's end count as 0; suffixes that are equal up to their separators keep the order of their segments.
    left = np.repeat(ends, sizes) - np.arange(n)
    rank = np.zeros(n, np.int64)
    k = max(1, (63 - n.bit_length()) // 9)
    for i in range(min(k, n)):
        rank <<= 9
        rank[: n - i] |= np.where(left[: n - i] > i, text[i:], 0)
    bits = 9 * k
    while True:
        order, sorted_rank = _sorted(rank, bits)
        new = np.r_[0, np.cumsum(sorted_rank[1:] != sorted_rank[:-1])]
        if new[-1] == n - 1 or k >= longest:
            return order, text[order - 1].astype(np.uint16), text[order - 2].astype(np.uint16)
        rank[order] = new + 1
        beyond = np.zeros(n, np.int64)
        beyond[: n - k] = np.where(left[: n - k] > k, rank[k:], 0)
        bits = 2 * n.bit_length()
        rank = rank << n.bit_length() | beyond
        k *= 2


def _sorted(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of keys below 2 ** bits, and the keys in it. Sorting them with their places is faster than sorting places."""
    b = len(keys).bit_length()
    if bits + b > 63:
        order = np.argsort(keys, kind="stable")
        return order, keys[order]
    both = np.sort(keys << b | np.arange(len(keys)))
    return both & ((1 << b) - 1), both >> b


def merge_shards(transforms: list[np.ndarray], rounds: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of shards (a shard number for each merged suffix), and the common prefix of each with
    the one before, counted up to ``rounds``.

    After round h suffixes stand in the order of their first h symbols. A round deals the
    interleave by the symbols before the suffixes, stably; separators keep the order of shards.
    """
    sizes = [len(t) for t in transforms]
    flat = np.concatenate(transforms)
    kind = np.uint8 if len(sizes) < 256 else np.uint16
    z = np.repeat(np.arange(len(sizes)), sizes).astype(kind)
    n = len(z)
    prefix = np.full(n, rounds, np.int16)
    prefix[0] = 0
    block = np.zeros(n, np.int32)
    parted = np.zeros(n, bool)
    parted[0] = True
    for h in range(rounds):
        symbols = np.empty(n, flat.dtype)
        symbols[np.argsort(z, kind="stable")] = flat
        deal = np.argsort(symbols, kind="stable")
        ends = int(np.searchsorted(symbols[deal], 1))
        deal[:ends] = deal[:ends][np.argsort(z[deal[:ends]], kind="stable")]
        z, symbols, block = z[deal], symbols[deal], block[deal]
        now = np.r_[True, (symbols[1:] != symbols[:-1]) | (block[1:] != block[:-1])]
        now[: ends + 1] = True
        prefix[now & ~parted] = h
        parted = now
        block = np.cumsum(now, dtype=np.int32)
        if now.all():
            break
    return z, prefix


def merge_pairs(transforms: list[np.ndarray], base: int, rounds: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """``merge_shards`` by two symbols a round; common prefixes are rounded down to even numbers.

    A transform's entries are the pair of symbols before a suffix, the farther one times ``base``.
    """
    sizes = [len(t) for t in transforms]
    flat = np.concatenate(transforms)
    z = np.repeat(np.arange(len(sizes)), sizes).astype(np.uint8 if len(sizes) < 256 else np.uint16)
    n = len(z)
    prefix = np.full(n, rounds, np.int16)
    prefix[0] = 0
    block = np.zeros(n, np.int32)
    parted = np.zeros(n, bool)
    parted[0] = True
    single = np.arange(base * base) % base == 0
    for h in range(0, rounds, 2):
        pairs = np.empty(n, flat.dtype)
        pairs[np.argsort(z, kind="stable")] = flat
        deal = np.argsort(pairs, kind="stable")
        dealt = pairs[deal]
        # Separators keep the order of shards, as the first symbol of a pair or the second.
        ends = int(np.searchsorted(dealt, base))
        deal[:ends] = deal[:ends][np.argsort(z[deal[:ends]], kind="stable")]
        last = ends + np.flatnonzero(single[dealt[ends:]])
        some = deal[last]
        deal[last] = some[np.lexsort((z[some], dealt[last]))]
        z, block = z[deal], block[deal]
        now = np.r_[True, (dealt[1:] != dealt[:-1]) | (block[1:] != block[:-1])]
        now[: ends + 1] = True
        now[last] = True
        now[last[last < n - 1] + 1] = True
        prefix[now & ~parted] = h
        parted = now
        block = np.cumsum(now, dtype=np.int32)
        if now.all():
            break
    return z, prefix


def window_minima(segments: list[bytes], keys: np.ndarray) -> list[np.ndarray]:
    """For each 50-byte window of each segment, the smallest key of any segment with that window."""
    shards, size = [[]], 0
    for i, s in enumerate(segments):
        if size > SHARD_BYTES:
            shards.append([])
            size = 0
        shards[-1].append(i)
        size += len(s) + 1
    lengths = np.fromiter(map(len, segments), np.int64, len(segments))
    owner, offset, transforms = [], [], []
    for ids in shards:
        order, one, two = sorted_suffixes([segments[i] for i in ids])
        ends = np.cumsum(lengths[ids] + 1)
        which = np.searchsorted(ends, order, side="right")
        owner.append(np.asarray(ids)[which])
        offset.append(order - (ends - lengths[ids] - 1)[which])
        transforms.append((one, two))
    # Few alphabets use all byte values; pairs of others fit 16 bits.
    seen = np.zeros(257, bool)
    for one, _ in transforms:
        seen[one] = True
    base = int(seen.sum())
    if base <= 256:
        number = (np.cumsum(seen) - 1).astype(np.uint16)
        z, prefix = merge_pairs([number[two] * np.uint16(base) + number[one] for one, two in transforms], base)
    else:
        z, prefix = merge_shards([one for one, _ in transforms])
    place = np.argsort(z, kind="stable")
    who, where = np.empty(len(z), np.int64), np.empty(len(z), np.int64)
    who[place], where[place] = np.concatenate(owner), np.concatenate(offset)
    is_window = where + LENGTH <= lengths[who]
    value = np.where(is_window, keys[who], LAST)
    starts = np.flatnonzero(prefix < LENGTH)
    least = np.repeat(np.minimum.reduceat(value, starts), np.diff(np.r_[starts, len(z)]))
    windows = lengths - LENGTH + 1
    at = np.r_[0, np.cumsum(windows)]
    out = np.empty(at[-1], np.int64)
    out[at[who[is_window]] + where[is_window]] = least[is_window]
    return np.split(out, at[1:-1])


def shared_windows(text: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether a segment, of those that stand one after another in ``text``, has a window whose hash another segment's window has too: no others need the merge."""
    with np.errstate(over="ignore"):
        w8, w2 = _words(text, 8), _words(text, 2)
        n = len(text) - LENGTH + 1
        h = w2[48 : 48 + n].astype(np.uint64) * _K[4]
        for at in range(0, 48, 8):
            h = (h ^ (h >> np.uint64(29))) * _K[at // 8 % 4] + w8[at : at + n]
        h = (h ^ (h >> np.uint64(32))) * _K[0]
    windows = lengths - LENGTH + 1
    owner = np.repeat(np.arange(len(lengths)), windows)
    h = h[_ranges(np.cumsum(lengths) - lengths, windows)]
    order = np.argsort(h)
    h, owner = h[order], owner[order]
    starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    mixed = np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts)
    out = np.zeros(len(lengths), bool)
    out[owner[np.repeat(mixed, np.diff(np.r_[starts, len(h)]))]] = True
    return out


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Numbers of the ranges of ``sizes`` from ``begins``, one range after another."""
    return np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _names(text: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(text[i:j]) for i, j in zip(begins.tolist(), ends.tolist())), np.uint64, len(begins))


class Rows(NamedTuple):
    """Segments of anchors ``h`` in blocks ``t``, their smallest and largest doc_id there; ``seg`` has their bytes one after another."""

    t: np.ndarray
    h: np.ndarray
    least: np.ndarray
    most: np.ndarray
    size: np.ndarray
    seg: np.ndarray


def _settled(r: Rows) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows of whole anchors to verdicts (t, h, segment, first, last, doc), a portion of anchors at a time: windows first..last of a segment of block t also start in ``doc``.

    An anchor's only distinct segment, and one whose windows' hashes no other segment has, are intervals of their own: differing hashes
    prove that windows differ. Where distinct segments may share a window, the merge decides, never a hash.
    """
    order = np.argsort(r.h, kind="stable")
    begins = (np.cumsum(r.size) - r.size)[order]
    t, h, least, most, size = (x[order] for x in r[:5])
    sizes = np.cumsum(size)
    anchors = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    # A portion ends with the anchor that reaches its bytes.
    cuts = anchors[np.r_[True, np.diff((sizes - size)[anchors] // MERGE_BYTES) > 0]]
    for a, b in zip(cuts, np.r_[cuts[1:], len(h)]):
        at = slice(a, b)
        yield from _portion(Rows(t[at], h[at], least[at], most[at], size[at], r.seg[_ranges(begins[at], size[at])]))


def _portion(r: Rows) -> Iterator[tuple[np.ndarray, ...]]:
    text = r.seg.tobytes()
    ends = np.cumsum(r.size)
    numbers: dict[bytes, int] = {}
    code = np.fromiter((numbers.setdefault(text[i:j], len(numbers)) for i, j in zip((ends - r.size).tolist(), ends.tolist())), np.int64, len(ends))
    segments = list(numbers)
    del numbers
    least = np.full(len(segments), LAST)
    np.minimum.at(least, code, r.least)
    anchor = np.empty(len(segments), np.int64)
    anchor[code] = r.h
    # Rows come by anchors, so distinct segments do.
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    n = np.diff(np.r_[starts, len(anchor)])
    alone = np.repeat(n == 1, n)
    sizes = np.fromiter(map(len, segments), np.int64, len(segments)) - LENGTH + 1
    # Verdicts on distinct segments: pieces of windows that have the same smallest key.
    several = np.flatnonzero(~alone)
    if len(several):
        alone[several] = ~shared_windows(np.frombuffer(b"".join([segments[i] for i in several]), np.uint8), sizes[several] + LENGTH - 1)
        several = np.flatnonzero(~alone)
    whose, first, last, doc = [np.flatnonzero(alone)], [np.zeros(int(alone.sum()), np.int64)], [sizes[alone] - 1], [least[alone]]
    if len(several):
        minima = window_minima([segments[i] for i in several], least[several])
        flat = np.concatenate(minima)
        owner = np.repeat(several, sizes[several])
        begin = np.repeat(np.r_[0, np.cumsum(sizes[several])[:-1]], sizes[several])
        cut = np.flatnonzero(np.r_[True, (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])])
        whose.append(owner[cut])
        first.append(cut - begin[cut])
        last.append(np.r_[cut[1:], len(flat)] - 1 - begin[cut])
        doc.append(flat[cut])
    whose, first, last, doc = (np.concatenate(x) for x in (whose, first, last, doc))
    # The verdicts of each row's segment.
    order = np.argsort(whose, kind="stable")
    count = np.bincount(whose, minlength=len(segments))
    v = order[_ranges((np.cumsum(count) - count)[code], count[code])]
    row = np.repeat(np.arange(len(code)), count[code])
    keep = doc[v] < r.most[row]
    v, row = v[keep], row[keep]
    if len(v):
        names = np.fromiter(map(xxhash.xxh64_intdigest, segments), np.uint64, len(segments))
        yield r.t[row], r.h[row], names[code[row]], first[v].astype(np.uint8), last[v].astype(np.uint8), doc[v]


def _column(x: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary column without nulls."""
    kind = np.int64 if pa.types.is_large_binary(x.type) else np.int32
    _, offsets, data = x.buffers()
    if not len(x):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(offsets, kind)[x.offset : x.offset + len(x) + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return offsets - offsets[0], data


def _packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """A binary row for each range between two cuts."""
    offsets = np.ascontiguousarray(cuts * values.itemsize, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, bool, pa.Array, np.ndarray, np.ndarray]]:
    """Rows (t, doc_id, text) to portions of a block: its number, whether they are its first, their ids, and the offsets and bytes of their texts."""
    block, fresh, held, size = None, True, [], 0

    def flush() -> tuple[int, bool, pa.Array, np.ndarray, np.ndarray]:
        ids = pa.concat_arrays([x[0] for x in held])
        sizes = np.concatenate([np.diff(x[1]) for x in held])
        return block, fresh, ids, np.r_[0, np.cumsum(sizes)], np.concatenate([x[2] for x in held])

    for b in batches:
        t = b.column(0).to_numpy(zero_copy_only=False)
        offsets, data = _column(b.column(2))
        i = 0
        while i < len(t):
            if t[i] != block or size >= most:
                if held:
                    yield flush()
                block, fresh, held, size = int(t[i]), t[i] != block, [], 0
            others = np.flatnonzero(t[i:] != block)
            j = min(int(i + others[0]) if len(others) else len(t), max(i + 1, int(np.searchsorted(offsets, offsets[i] + most - size, side="right"))))
            j = min(j, len(t))
            held.append((b.column(1).slice(i, j - i), offsets[i : j + 1], data[offsets[i] : offsets[j]]))
            size += int(offsets[j] - offsets[i])
            i = j
    if held:
        yield flush()


def _keys(ids: pa.Array) -> np.ndarray:
    return ids.fill_null(LAST).to_numpy(zero_copy_only=False)


def _in(values: np.ndarray, sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the values (hashes) that occur among the sorted ones, and their places there."""
    if not len(sorted_):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Most values are none of them, and a table of low bits shows that sooner than a search.
    low = values.dtype.type((1 << FILTER_BITS) - 1)
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[sorted_ & low] = True
    hit = np.flatnonzero(seen[values & low])
    at = np.minimum(np.searchsorted(sorted_, values[hit]), len(sorted_) - 1)
    same = sorted_[at] == values[hit]
    return hit[same], at[same]


def _part(folder: str, t: int, columns: list[str]) -> pa.Table:
    """What was written for a block of documents; an error if nothing was."""
    system, path = arrow_fs(folder)
    files = [f.path for f in system.get_file_info(fs.FileSelector(f"{path}/t={t}")) if f.path.endswith(".parquet")]
    return pa.concat_tables([pq.read_table(f, filesystem=system, columns=columns, partitioning=None) for f in files])


def _unpacked(table: pa.Table, column: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(table[column].to_pylist()), kind)


def _by_block(df: DataFrame, folder: str) -> None:
    with freeing_shuffles(df.sparkSession):
        df.repartition("t").sortWithinPartitions("t").write.partitionBy("t").option("compression", "zstd").parquet(folder)


def _window_keys(names: np.ndarray) -> np.ndarray:
    """What windows of hot anchors, named like segments, are dealt by."""
    with np.errstate(over="ignore"):
        k = names * _K[1]
        return ((k ^ k >> np.uint64(31)) * _K[2]).view(np.int64)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, kept`` (binary: the bytes that stay), ``n_bytes, n_removed, n_spans``; a row for each of ``docs`` (``doc_id, text``).

    Null texts count as empty. Rows with equal ids don't remove from each other; a null id counts
    as larger than any other. Matches are judged on the input and never cross documents. Texts
    under 50 bytes stay whole. Other columns are ignored; an empty table gives no rows.
    """
    spark, most = docs.sparkSession, HOT
    base = scratch(spark, "repeats")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        t = TaskContext.get().partitionId()
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, t, np.int32)), b.column(0), b.column(1)], names=["t", "doc_id", "text"])

    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    numbered.mapInArrow(number, "t int, doc_id long, text binary").write.option("compression", "zstd").parquet(f"{base}/blocks")
    blocks = spark.read.schema("t int, doc_id long, text binary").parquet(f"{base}/blocks")

    # A task of this exchange holds its anchors as arrays of 16 bytes each: one for about 13 bytes of text.
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + int((blocks.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // (32 << 20)))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each block and part that an anchor's hash falls in: its anchors there, and in how many contexts they stand (shifted) and whether in several documents."""

        def rows(block: int, part: np.ndarray, h: pa.Array, mark: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(np.full(len(part), block, np.int32)), h, mark], names=["part", "t", "h", "mark"])

        for block, fresh, _, offsets, data in _gathered(batches, GATHER_BYTES):
            if fresh:  # so that every block has a row
                yield rows(block, [block % (FINE * n_parts)], pa.array([b""]), pa.array([b""]))
            h, first, last, doc = runs_of(data, offsets)
            if not len(h):
                continue
            order = np.argsort(h)
            h, doc = h[order], doc[order]
            starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            times = np.diff(np.r_[starts, len(h)])
            several = np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
            # Few anchors stand often; contexts of the others count as often as they stand.
            often = np.flatnonzero(times > OFTEN)
            if len(often):
                at = order[_ranges(starts[often], times[often])]
                whose, name = np.repeat(often, times[often]), _names(data.tobytes(), first[at], last[at] + LENGTH)
                by = np.lexsort((name, whose))
                whose, name = whose[by], name[by]
                new = np.r_[True, (whose[1:] != whose[:-1]) | (name[1:] != name[:-1])]
                times[often] = np.bincount(whose[new], minlength=len(times))[often]
            h, mark = h[starts], (np.minimum(times, 1 << 29) << 1 | several).astype(np.int32)
            part = (h % np.uint64(FINE * n_parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            part, h, mark = part[order], h[order], mark[order]
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
            out = rows(block, part[cuts[:-1]], _packed(h, cuts), _packed(mark, cuts))
            for i in range(0, out.num_rows, 512):
                yield out.slice(i, 512)

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each block that comes, the anchors that stand in several documents, and which are hot."""
        parts = [x for b in batches for x in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist())]
        if not parts:
            return
        h, mark = np.frombuffer(b"".join(x[1] for x in parts), np.int64), np.frombuffer(b"".join(x[2] for x in parts), np.int32)
        t = np.repeat(np.array([x[0] for x in parts], np.int32), [len(x[1]) // 8 for x in parts])
        every = sorted({x[0] for x in parts})
        del parts
        order = np.argsort(h)
        h, t, mark = h[order], t[order], mark[order]
        starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
        n = np.diff(np.r_[starts, len(h)])
        if len(h):
            keep = np.repeat((n > 1) | np.logical_or.reduceat(mark & 1 > 0, starts), n)
            hot = np.repeat(np.add.reduceat(mark >> 1, starts, dtype=np.int64) > most, n)[keep]
            h, t = h[keep], t[keep]
        else:
            hot = np.zeros(0, bool)
        order = np.argsort(t, kind="stable")
        h, t, hot = h[order], t[order], hot[order]
        for block in every:
            at = slice(*np.searchsorted(t, [block, block + 1]))
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([h[at].tobytes()], pa.binary()), pa.array([hot[at].tobytes()], pa.binary())], names=["t", "h", "hot"])

    seen = blocks.mapInArrow(anchors, "part int, t int, h binary, mark binary").repartition(n_parts, "part").mapInArrow(repeated, "t int, h binary, hot binary")
    _by_block(seen, f"{base}/anchors")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each block and part that an anchor's hash falls in: the distinct segments of its repeated anchors there."""
        columns = ["h", "least", "most", "size", "seg"]
        for block, fresh, ids, offsets, data in _gathered(batches, GATHER_BYTES):
            if fresh:  # so that every block has a row
                wanted, hot = _anchors(base, block)
                yield pa.RecordBatch.from_arrays([pa.array([block % (FINE * n_parts)], pa.int32()), pa.array([block], pa.int32()), *[pa.array([b""])] * 5], names=["part", "t", *columns])
            h, first, last, doc = runs_of(data, offsets)
            hit, at = _in(h.view(np.int64), wanted)
            if not len(hit):
                continue
            h, first, size, split, key = h[hit].view(np.int64), first[hit], last[hit] - first[hit] + LENGTH, hot[at], _keys(ids)[doc[hit]]
            del last, doc, hit, at
            text = data.tobytes()
            least, most, one = _distinct(h, _names(text, first, first + size), key, key)
            h, first, size, split = h[one], first[one], size[one], split[one]
            if split.any():
                x = np.flatnonzero(split)
                n = size[x] - LENGTH + 1
                begin = _ranges(first[x], n)
                name = _names(text, begin, begin + LENGTH)
                low, high, one = _distinct(np.repeat(h[x], n), name, np.repeat(least[x], n), np.repeat(most[x], n))
                h, first = np.r_[h[~split], _window_keys(name[one])], np.r_[first[~split], begin[one]]
                least, most, size = np.r_[least[~split], low], np.r_[most[~split], high], np.r_[size[~split], np.full(len(one), LENGTH)]
            del text
            part = (h.view(np.uint64) % np.uint64(FINE * n_parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            part, h, least, most, first, size = (x[order] for x in (part, h, least, most, first, size))
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
            ends = np.r_[0, np.cumsum(size)]
            i = 0
            while i < len(cuts) - 1:
                j = max(i + 1, int(np.searchsorted(ends[cuts], ends[cuts[i]] + MERGE_BYTES)) - 1)
                at, some = slice(cuts[i], cuts[j]), cuts[i : j + 1] - cuts[i]
                arrays = [_packed(x[at], some) for x in (h, least, most, size.astype(np.uint8))]
                seg = _packed(data[_ranges(first[at], size[at])], ends[cuts[i : j + 1]] - ends[cuts[i]])
                yield pa.RecordBatch.from_arrays([pa.array(part[cuts[i:j]], pa.int32()), pa.array(np.full(j - i, block, np.int32)), *arrays, seg], names=["part", "t", *columns])
                i = j

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each block that comes: the verdicts on its segments."""
        got, every = [], set()
        for b in batches:
            t = b.column(1).to_numpy(zero_copy_only=False)
            every.update(t.tolist())
            (n, h), *rest = (_column(b.column(i)) for i in range(2, 7))
            least, most, size, seg = (x[1] for x in rest)
            got.append(Rows(np.repeat(t, np.diff(n) // 8), h.view(np.int64), least.view(np.int64), most.view(np.int64), size.astype(np.int64), seg))
        if not got:
            return
        r = Rows(*(np.concatenate(x) for x in zip(*got)))
        del got
        out = list(_settled(r)) if len(r.h) else []
        del r
        empty = [np.zeros(0, k) for k in (np.int32, np.int64, np.uint64, np.uint8, np.uint8, np.int64)]
        t, *verdicts = (np.concatenate(x) for x in zip(empty, *out))
        del out
        order = np.argsort(t, kind="stable")
        blocks = np.array(sorted(every), np.int32)
        cuts = np.r_[np.searchsorted(t[order], blocks), len(t)]
        done = pa.RecordBatch.from_arrays([pa.array(blocks), *(_packed(x[order], cuts) for x in verdicts)], names=["t", "h", "segment", "first", "last", "doc"])
        for i in range(0, done.num_rows, 64):
            yield done.slice(i, 64)

    dealt = blocks.mapInArrow(segments, "part int, t int, h binary, least binary, most binary, size binary, seg binary").repartition(n_parts, "part")
    _by_block(dealt.mapInArrow(settle, "t int, h binary, segment binary, first binary, last binary, doc binary"), f"{base}/verdicts")

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, fresh, ids, offsets, data in _gathered(batches, CUT_BYTES):
            if fresh:
                table = _part(f"{base}/verdicts", block, ["h", "segment", "first", "last", "doc"])
                verdicts = Verdicts(*(_unpacked(table, *x) for x in (("segment", np.uint64), ("h", np.int64), ("first", np.uint8), ("last", np.uint8), ("doc", np.int64)))).ordered()
                anchors, split = _anchors(base, block)
                hot = anchors[split]
                wanted = np.unique(np.r_[verdicts.h, hot])
            kept, counts = _kept(data, offsets, _keys(ids), wanted, hot, verdicts)
            yield pa.RecordBatch.from_arrays([ids, kept, *map(pa.array, counts)], names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return blocks.mapInArrow(cleaned, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def _distinct(h: np.ndarray, name: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each pair (h, name): smallest and largest key, and the place of one."""
    order = np.lexsort((name, h))
    h, name = h[order], name[order]
    starts = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (name[1:] != name[:-1])])
    return np.minimum.reduceat(least[order], starts), np.maximum.reduceat(most[order], starts), order[starts]


def _anchors(base: str, t: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's anchors that repeat, in order, and whether each is hot."""
    table = _part(f"{base}/anchors", t, ["h", "hot"])
    h, hot = np.frombuffer(b"".join(table["h"].to_pylist()), np.int64), np.frombuffer(b"".join(table["hot"].to_pylist()), bool)
    order = np.argsort(h)
    return h[order], hot[order]


class Verdicts(NamedTuple):
    """Windows first..last of the segment of that name, dealt by ``h``, also start in ``doc``."""

    segment: np.ndarray
    h: np.ndarray
    first: np.ndarray
    last: np.ndarray
    doc: np.ndarray

    def ordered(self) -> Verdicts:
        order = np.argsort(self.segment)
        return Verdicts(*(x[order] for x in self))


def _kept(data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, wanted: np.ndarray, hot: np.ndarray, verdicts: Verdicts) -> tuple[pa.Array, tuple[np.ndarray, ...]]:
    """The bytes of each text that stay; their sizes, the bytes that go, and the number of their runs. ``verdicts`` in the order of names."""
    h, first, last, doc = runs_of(data, offsets)
    h = h.view(np.int64)
    hit, _ = _in(h, wanted)
    h, first, size, key = h[hit], first[hit], last[hit] - first[hit] + LENGTH, keys[doc[hit]]
    text = data.tobytes()
    split = np.isin(h, hot) if len(hot) else np.zeros(len(h), bool)
    name = _names(text, first[~split], (first + size)[~split])
    if split.any():
        n = size[split] - LENGTH + 1
        begin = _ranges(first[split], n)
        windows = _names(text, begin, begin + LENGTH)
        h, name = np.r_[h[~split], _window_keys(windows)], np.r_[name, windows]
        first, key = np.r_[first[~split], begin], np.r_[key[~split], np.repeat(key[split], n)]
    starts = np.flatnonzero(np.r_[True, verdicts.segment[1:] != verdicts.segment[:-1]][: len(verdicts.segment)])
    of, at = _in(name, verdicts.segment[starts])
    n = np.diff(np.r_[starts, len(verdicts.segment)])[at]
    v, of = _ranges(starts[at], n), np.repeat(of, n)
    held = (verdicts.h[v] == h[of]) & (verdicts.doc[v] < key[of])
    v, of = v[held], of[held]
    change = np.bincount(first[of] + verdicts.first[v], minlength=len(data) + 1) - np.bincount(first[of] + verdicts.last[v] + LENGTH, minlength=len(data) + 1)
    gone = np.cumsum(change[: len(data)]) > 0
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    at = offsets[:-1][np.diff(offsets) > 0]
    begins[at] = gone[at]  # runs end with their text
    sizes = np.diff(offsets)
    removed = np.diff(np.r_[0, np.cumsum(gone)][offsets])
    return _packed(data[~gone], np.r_[0, np.cumsum(sizes - removed)]), (sizes, removed, np.diff(np.r_[0, np.cumsum(begins)][offsets]))


def _cut(text: bytes, key: int, wanted: np.ndarray, hot: np.ndarray, verdicts: dict) -> tuple[bytes, int, int, int]:
    """``_kept`` of one text, by the verdicts (h, first, last, doc) of each name."""
    rows = [(s, *v) for s, said in verdicts.items() for v in said]
    found = Verdicts(*(np.array(x, k) for x, k in zip(zip(*rows), (np.uint64, np.int64, np.uint8, np.uint8, np.int64)))).ordered()
    kept, counts = _kept(np.frombuffer(text, np.uint8), np.array([0, len(text)]), np.array([key]), wanted, hot, found)
    return (kept[0].as_py(), *(int(x[0]) for x in counts))


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    out = remove_repeats(docs)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
