"""WARC archives: a writer of gzip members and a reader that splits files by byte ranges.

A task of the reader gets a range of a file. It scans the range for gzip magic, decodes the
member found there, and takes it for a record if it begins with a WARC header, holds the length
that the header states and ends with a right gzip trailer. It owns the records that start in its
range, also the last one, which may end beyond it. So files of any size are read by many tasks.

Where neither another member nor the file's end follows, a candidate may be a record before
damage or bytes inside another record. Within a chain of records it is the former. Before the
first record of a range that is settled by reading on from an earlier range.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm.common import shared_path, small_batches, written

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a file that a task reads.
RANGE_BYTES = 8 << 20
#: Bytes that are read at once, and of these the first that a member is decoded from.
READ_BYTES = 1 << 20
FIRST_BYTES = 1 << 13
#: Groups of equal payloads are joined in so many parts.
SALTS = 32
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary, digest_ok boolean"


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A record as a gzip member. A revisit has the HTTP header, but not the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = HTTP.format(len(payload)).encode() + (b"" if revisit else payload)
    named = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", "2000-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        named.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        named += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{'' if refers_to is None else refers_to}>")]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in named) + "\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(head.encode() + block + b"\r\n\r\n") + z.flush()


def parsed(record: bytes) -> dict | None:
    """The fields of a record, or None if its header is not that of a WARC record, or states more than it holds."""
    if not record.startswith(b"WARC/1."):
        return None
    head, _, rest = record.partition(b"\r\n\r\n")
    named = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        k, colon, v = line.partition(":")
        if colon:
            named[k.strip().lower()] = v.strip()
    if "warc-type" not in named or not named.get("content-length", "").isdigit():
        return None
    block = rest[: int(named["content-length"])]
    return named | {"block": block} if len(block) == int(named["content-length"]) else None


def _page(uri: str | None) -> int | None:
    digits = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits.lstrip("-").isdigit() else None


def _row(r: dict) -> tuple:
    revisit = r["warc-type"] == "revisit"
    head, _, payload = r["block"].partition(b"\r\n\r\n")
    stated = r.get("warc-payload-digest", "").removeprefix("sha1:")
    if revisit:
        size = next((int(v) for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")) if k.lower() == b"content-length"), None)
        return (_page(r.get("warc-record-id")), size, stated, "revisit", _page(r.get("warc-refers-to")), r.get("warc-target-uri"), None, None)
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return (_page(r.get("warc-record-id")), len(payload), digest, r["warc-type"], None, r.get("warc-target-uri"), payload, digest == stated)


class _Bytes:
    """A file's bytes through one window that slides forward. upto: what lies beyond is read only as
    it is needed. taken: the bytes read so far."""

    def __init__(self, path: str, upto: int):
        system, name = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(name)
        self.size, self.upto = self.file.size(), upto
        self.base, self.held, self.taken = 0, b"", 0

    def at(self, start: int, n: int) -> memoryview:
        end = min(start + n, self.size)
        if start < self.base or start > self.base + len(self.held):
            self.base, self.held = start, b""
        have = self.base + len(self.held)
        if end > have:
            more = max(end - have, min(READ_BYTES, self.upto - have))
            got = self.file.read_at(min(more, self.size - have), have)
            self.taken += len(got)
            self.base, self.held = start, self.held[start - self.base :] + got
        return memoryview(self.held)[start - self.base : max(start, end) - self.base]

    def find(self, what: bytes, start: int, end: int) -> int:
        """Where `what` first begins in [start, end), or -1."""
        n = len(what)
        while start < end:
            got = -1 if len(self.at(start, n)) < n else self.held.find(what, start - self.base, end - self.base + n - 1)
            if got >= 0:
                return self.base + got
            start = max(start + 1, self.base + len(self.held) - n + 1)
        return -1


def _member_at(source: _Bytes, start: int) -> tuple[dict, int] | None:
    """The record whose member starts there, and where it ends; None if there is none that is whole."""
    z, at, out, size = zlib.decompressobj(31), start, [], FIRST_BYTES
    try:
        while not z.eof:
            chunk = source.at(at, size)
            if not len(chunk):
                return None
            out.append(z.decompress(chunk))
            at += len(chunk)
            size = min(2 * size, READ_BYTES)
            if len(out) > 1 and len(out[0]) < 7:
                out = [b"".join(out)]
            if len(out[0]) >= 7 and not out[0].startswith(b"WARC/1."):
                return None
    except zlib.error:
        return None
    record = parsed(b"".join(out))
    return (record, at - len(z.unused_data)) if record is not None else None


def _members(source: _Bytes, at: int, end: int) -> Iterator[tuple[int, int, dict]]:
    """(start, end, record) of the members that start in [at, end) of a file."""
    first = at
    chained = at == 0
    while (hit := source.find(MAGIC, at, end)) >= 0:
        got = _member_at(source, hit)
        if got is None:
            at = hit + 1
            continue
        record, after = got
        if not chained and bytes(source.at(after, len(MAGIC))) not in (b"", MAGIC):
            # Whether it is inside another record shows from where the records before it end.
            covering = [e for s, e, _ in _members(source, max(0, first - RANGE_BYTES), first) if s < hit < e]
            if covering:
                at, chained = covering[-1], True
                continue
        chained = True
        yield hit, after, record
        at = after


def records_of(path: str, start: int, end: int) -> Iterator[dict]:
    """The records whose members start in [start, end) of a file."""
    source = _Bytes(path, end)
    for _, _, record in _members(source, start, min(end, source.size)):
        yield record


def with_originals(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to, revisit) of pages (page_id, url, html).

    A null html is an empty payload. Of equal payloads of min_bytes or more, the rows with the
    smallest page_id are responses and the others revisit it; smaller payloads are responses
    all. Rows without a page_id revisit too, unless no row of the group has one.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    long_enough = F.octet_length("html") >= min_bytes
    first = rows.where(long_enough).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    first = first.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    other = long_enough & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return salted.join(first, ["digest", "salt"], "left").select("page_id", "url", "html", F.when(other, F.col("first")).alias("refers_to"), F.coalesce(other, F.lit(False)).alias("revisit"))


def write(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Writes the pages as WARC files under path, a file a task. Returns (path, bytes) of the files.

    path: a URI that pyarrow can write to from every executor. A file is written under
    another name and then renamed, so a task that runs again leaves whole files only.
    """
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        system, folder = fs.FileSystem.from_uri(path)
        system.create_dir(folder, recursive=True)
        name = f"{folder}/part-{task.partitionId():05d}"
        scratch = f"{name}.{task.taskAttemptId()}.tmp"
        size = 0
        with system.open_output_stream(scratch, compression=None) as out:
            for b in batches:
                for page_id, url, html, refers_to, revisit in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    raw = member(page_id, url, html.encode("utf-8", "replace"), refers_to, revisit)
                    out.write(raw)
                    size += len(raw)
        system.move(scratch, f"{name}-{task.taskAttemptId()}.warc.gz")
        uri = f"{path}/part-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz"
        yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([size], pa.int64())], ["path", "bytes"])

    files = with_originals(pages, min_bytes).mapInArrow(run, "path string, bytes long")
    return written(files, "warc-files")


def read(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of files (path, bytes), see RECORDS; a task a range. Empty files give no rows."""
    small_batches(files.sparkSession)
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.where("bytes > 0").select("path", start.alias("start"))
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORDS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.bool_()]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        rows: list[tuple] = []
        for b in batches:
            for path, at in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for r in records_of(path, at, at + range_bytes):
                    rows.append(_row(r))
                    if len(rows) >= 256:
                        yield out(rows)
                        rows = []
        if rows:
            yield out(rows)

    return ranges.repartition(parts, "path", "start").mapInArrow(run, RECORDS)


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes the pages to the shared folder and reads the archives back."""
    return read(write(pages, shared_path(spark, "warc"), min_bytes))
