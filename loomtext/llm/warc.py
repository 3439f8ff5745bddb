"""WARC archives with an external index merge.

Writing: each task writes one archive (a gzip member for each record) and keeps the index lines of
its records as a run sorted by URL key and time. Merging: runs are dealt by key range, and each
range merges its slices of the runs with a loser tree, so the ranges in order are the global
capture history. Reading: the history names each record's file, offset and length; lines are dealt by file and place,
so a task reads its part of an archive from front to back, and each record must agree with its line.

Files go through pyarrow's file systems (local and mounted folders, HDFS, S3, GCS, Azure); another kind of shared folder is an error. A file is
written under a name of its attempt and renamed when it is whole: tasks may run again. Rows cross to Python as Arrow, so ids stay whole.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from collections import namedtuple
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import arrow_fs, lookup, scratch, stored

#: Payloads under this many bytes never become revisits.
MIN_REVISIT = 1000
#: Lines that a range of the merged index has on average, at most.
RANGE_LINES = 200_000
#: Archives are read in pieces of this size.
CHUNK = 1 << 20
#: Bytes of an archive that a task reads by the index, at most.
SLICE = 64 << 20
EPOCH = datetime(2020, 1, 1, tzinfo=timezone.utc)
INDEX = "urlkey string, ts string, page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, file string, offset long, length long, run long, seq long"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, ts string, payload binary"
Line = namedtuple("Line", [x.split()[0] for x in INDEX.split(", ")])
_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows as Arrow, with nulls as nulls."""
    fields = [x.split() for x in schema.split(", ")]
    cols = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, (_, t) in zip(cols, fields)], names=[n for n, _ in fields])


def url_key(url: str | None) -> str:
    """Host labels reversed, without scheme, a leading www, port or fragment: ``com,example)/path?query``; null gives ``)``."""
    try:
        u = urlsplit((url or "").strip().lower())
        host = u.hostname or ""
    except ValueError:
        return f")/{(url or '').strip().lower()}"
    host = host.removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + (u.path or ("/" if host else "")) + (f"?{u.query}" if u.query else "")


def capture_time(page_id: int | None) -> str:
    """Pages have no times; a capture's is a second for each id after the start of 2020."""
    at = EPOCH if page_id is None else EPOCH + timedelta(seconds=int(page_id) % 10**9)
    return at.strftime("%Y-%m-%dT%H:%M:%SZ")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, uncompressed. A revisit has no payload; its headers carry the payload's size and digest."""
    kind = "response" if refers_to is None else "revisit"
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {capture_time(page_id)}",
        f"WARC-Target-URI: {' '.join((url or '').split())}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
    ]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    block = b"" if refers_to is not None else payload
    lines += ["Content-Type: text/html", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class LoserTree:
    """K-way merge of sorted iterators: one comparison a level for each row that comes out."""

    def __init__(self, runs: list[Iterator], key) -> None:
        self.runs, self.key, self.k = [iter(r) for r in runs], key, len(runs)
        self.rows: list = [next(r, None) for r in self.runs]
        self.keys = [None if x is None else (key(x), i) for i, x in enumerate(self.rows)]
        self.losers = [-1] * max(1, self.k)
        if self.k:
            self.losers[0] = self._play(1)

    def _beats(self, a: int, b: int) -> bool:
        return self.keys[b] is None or (self.keys[a] is not None and self.keys[a] < self.keys[b])

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        win, lose = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = lose
        return win

    def __iter__(self) -> Iterator:
        while self.k and self.keys[win := self.losers[0]] is not None:
            yield self.rows[win]
            row = next(self.runs[win], None)
            self.rows[win] = row
            self.keys[win] = None if row is None else (self.key(row), win)
            node = (win + self.k) // 2
            while node:
                if self._beats(self.losers[node], win):
                    self.losers[node], win = win, self.losers[node]
                node //= 2
            self.losers[0] = win


def index_key(x) -> tuple:
    known = x.page_id is not None
    return (x.urlkey, x.ts, known, x.page_id if known else 0, x.file, x.offset)


def mark_revisits(pages: DataFrame, least: int = MIN_REVISIT) -> DataFrame:
    """``page_id, url, payload, payload_digest, refers_to`` of every row.

    Rows whose payloads (null: empty) are equal and of ``least`` bytes or more refer to the largest
    page_id among them, but for rows with that id. Where no id is known, none refers.
    Payloads stay where they are while the digests that come back are few enough to broadcast (``common.lookup``).
    Beyond that rows are dealt by digest and a salt, so a page in a third of the crawl is no single task's.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"), F.sha1(payload).alias("payload_digest"))
    again = rows.where(F.octet_length("payload") >= least).groupBy("payload_digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    last = stored(again.where("n > 1 AND last IS NOT NULL").drop("n"), "again")
    joined = lookup(rows, last, "payload_digest", F.concat_ws(" ", F.col("page_id").cast("string"), "url"))
    return joined.select("page_id", "url", "payload", "payload_digest", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``mark_revisits`` rows under ``folder`` (a URI); gives the index lines, a sorted run for each archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        part = task.partitionId()
        system, path = arrow_fs(folder)
        system.create_dir(path, recursive=True)
        name = f"part-{part:06d}.warc.gz"
        attempt = f"{path}/.part-{part:06d}-{task.taskAttemptId()}"
        lines, offset = [], 0
        with system.open_output_stream(attempt, compression=None) as out:
            for b in batches:
                for page, url, payload, digest, refers in zip(*(c.to_pylist() for c in b.columns)):
                    member = gzip.compress(record(page, url, payload, digest, refers), 6, mtime=0)
                    out.write(member)
                    kind = "response" if refers is None else "revisit"
                    lines.append((url_key(url), capture_time(page), page, url, kind, digest, len(payload), refers, f"{folder}/{name}", offset, len(member), part))
                    offset += len(member)
        system.move(attempt, f"{path}/{name}")
        lines.sort(key=lambda x: (x[0], x[1], x[2] is not None, x[2] or 0, x[9]))
        for i in range(0, len(lines), 10_000):
            yield _batch([(*x, i + k) for k, x in enumerate(lines[i : i + 10_000])], INDEX)

    return pages.mapInArrow(run, INDEX)


def merge_index(runs: DataFrame, parts: int | None = None) -> DataFrame:
    """Sorted runs to one capture history; ``part`` and ``at`` number its rows in global order.

    Ranges are cut on the whole key, so one URL or host may span many. A task holds its range's
    lines, which shrink with more partitions.
    """
    keys = ["urlkey", "ts", "page_id", "file", "offset"]
    n = parts or max(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + runs.count() // RANGE_LINES)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        slices: dict[int, list] = {}
        for b in batches:
            for r in map(Line, *(c.to_pylist() for c in b.columns)):
                slices.setdefault(r.run, []).append(r)
        # A run's slice mostly arrives whole and in order; where it came in pieces, its lines' numbers put them in order again.
        for s in slices.values():
            if any(a.seq > b.seq for a, b in zip(s, s[1:])):
                s.sort(key=lambda r: r.seq)
        tree = iter(LoserTree([s for _, s in sorted(slices.items())], index_key))
        while rows := [r for _, r in zip(range(10_000), tree)]:
            yield _batch([(*r, part, at + k) for k, r in enumerate(rows)], f"{INDEX}, part int, at long")
            at += len(rows)

    return runs.repartitionByRange(n, *keys).mapInArrow(merge, f"{INDEX}, part int, at long")


def _parsed(whole: io.BytesIO, name: str) -> tuple[dict[str, str], bytes]:
    """Headers and block of one uncompressed record."""
    if not whole.readline().startswith(b"WARC/"):
        raise ValueError(f"{name}: not a WARC record")
    heads = {}
    while (line := whole.readline()) not in (b"\r\n", b""):
        k, _, v = line.decode().rstrip("\r\n").partition(": ")
        heads[k] = v
    return heads, whole.read(int(heads["Content-Length"]))


def _row(heads: dict[str, str], body: bytes, name: str) -> tuple:
    """A ``READ`` row. A response's size and digest are computed from its payload and must agree with its headers."""
    digest, told, kind = heads["WARC-Payload-Digest"].removeprefix("sha1:"), int(heads["X-Payload-Length"]), heads["WARC-Type"]
    if kind == "response" and (len(body), hashlib.sha1(body).hexdigest()) != (told, digest):
        raise ValueError(f"{name}: a payload differs from its digest")
    page, refers = (int(x) if x else None for x in (heads["X-Page-ID"], heads.get("X-Refers-To-Page")))
    return page, told, digest, kind, refers, heads["WARC-Target-URI"], heads["WARC-Date"], body


def read_history(history: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that ``merge_index`` lines point to, with the lines' ``part`` and ``at``: in their order they are the capture history.

    A record that isn't where its line says, or that differs from it, is an error.
    """
    spark, schema = history.sparkSession, f"{READ}, part int, at long"
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + int((history.agg(F.sum("length")).first()[0] or 0) // SLICE))
    lines = history.select("file", "offset", "length", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "part", "at")
    dealt = lines.repartition(n, "file", F.floor(F.col("offset") / SLICE)).sortWithinPartitions("file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        at, data = 0, b""
        for b in batches:
            rows, size = [], 0
            for file, offset, length, *line, part, place in zip(*(c.to_pylist() for c in b.columns)):
                if file != name:
                    if source is not None:
                        source.close()
                    system, path = arrow_fs(file)
                    name, source, data = file, system.open_input_file(path), b""
                if not at <= offset <= offset + length <= at + len(data):
                    source.seek(offset)
                    at, data = offset, source.read(max(length, CHUNK))
                row = _row(*_parsed(io.BytesIO(gzip.decompress(data[offset - at : offset - at + length])), file), file)
                if list(row[:5]) != line:
                    raise ValueError(f"{file}: the record at {offset} isn't the one of the index")
                rows.append((*row[:7], row[7] if payloads else None, part, place))
                size += len(row[7]) if payloads else 0
                if size > 16 << 20:
                    yield _batch(rows, schema)
                    rows, size = [], 0
            yield _batch(rows, schema)
        if source is not None:
            source.close()

    return dealt.mapInArrow(run, schema)


def _records(system: fs.FileSystem, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of an archive, one gzip member after the other; memory holds one record."""
    with system.open_input_stream(name, compression=None) as raw:
        rest = b""
        while True:
            unpack, parts = zlib.decompressobj(31), []
            while not unpack.eof:
                data = rest or raw.read(CHUNK)
                rest = b""
                if not data:
                    if parts:
                        raise EOFError(f"{name} ends within a record")
                    return
                parts.append(unpack.decompress(data))
                rest = unpack.unused_data
            yield _parsed(io.BytesIO(b"".join(parts)), name)


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives named in ``files`` (column ``file``, URIs), read from front to back without an index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name in (x for b in batches for x in b.column(0).to_pylist()):
            rows, size = [], 0
            for heads, body in _records(*arrow_fs(name)):
                row = _row(heads, body, name)
                rows.append(row if payloads else (*row[:7], None))
                size += len(body) if payloads else 0
                if len(rows) >= 5000 or size > 16 << 20:
                    yield _batch(rows, READ)
                    rows, size = [], 0
            yield _batch(rows, READ)

    return files.select("file").mapInArrow(run, READ)


def archive(pages: DataFrame, folder: str | None = None, payloads: bool = True) -> tuple[DataFrame, DataFrame]:
    """Write all ``pages`` (``page_id, url, html``): the merged index, and the records read back.

    Null html is an empty payload, a null URL an empty target. Null ids stay null. Repeated rows have
    a record each. An empty table gives an empty index. Other columns are ignored.
    """
    folder = folder or scratch(pages.sparkSession, "warc")
    runs = stored(write_archives(mark_revisits(pages), folder), "runs")
    history = stored(merge_index(runs), "history")
    return history, read_history(history, payloads)
