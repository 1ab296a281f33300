"""WARC archives: a writer with revisit records and a salvage reader.

The writer puts each record in a gzip member of its own and starts a new archive
file beyond ``max_bytes``.  Records with equal payloads are told apart by SHA-1
and length, aggregated before the shuffle: the one with the smallest page id is
a ``response``, the others are ``revisit`` records that refer to it and carry no
payload, only its digest and length.

The salvage reader reads an archive from end to end through a window that holds
no more than the record at hand.  A header may be of any length: it goes on as
long as its lines have the form of headers.  Before a plain record is read, the
archive's size and the bytes where its content length says it ends are looked at,
so that a damaged length costs no memory.  Where a member or a record fails its checks (compressed data, CRC,
version line, header syntax, content length, payload digest), the reader looks
for the next gzip member that opens with a version line, or the next version
line in plain archives, goes on there, and logs the bytes between as a
quarantined gap with the reason.

Defined results: a null html is an empty payload; rows that repeat the smallest
page id of a payload are the same record and are all responses; null page ids
come last, so that they refer to a record with an id if there is one; an empty
table gives no archives and no rows; payloads of any length are kept whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import AtomicFile, Scratch, open_fs, table

VERSION = b"WARC/1.1"
MAX_BYTES = 64 << 20
#: Bytes read at a time.
WINDOW = 1 << 20
#: Bytes of a header line's name; what goes on longer without a colon is no header.
NAME_BYTES = 256
_DATE = "1970-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    start: int = 0
    end: int = 0

    @property
    def kind(self) -> str:
        return self.headers.get("warc-type", "")

    @property
    def payload(self) -> bytes:
        if self.kind != "response":
            return self.block
        head, gap, body = self.block.partition(b"\r\n\r\n")
        return body if gap else self.block


@dataclass
class Gap:
    start: int
    end: int
    reason: str


def _clean(value: str) -> str:
    return re.sub(r"[\r\n]+", " ", value)


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {_clean(v)}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, first: int | None, is_first: bool) -> bytes:
    digest = payload_digest(payload)
    urn = f"urn:page:{page_id}"
    headers = [
        ("WARC-Type", "response" if is_first else "revisit"),
        ("WARC-Record-ID", f"<{urn}>"),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", url or ""),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if is_first:
        block += payload
    else:
        headers += [("WARC-Refers-To", f"<urn:page:{first}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return record_bytes(headers, block)


class _Window:
    """The bytes of a file from some offset on, read as they are asked for."""

    def __init__(self, file):
        self.file, self.data, self.at, self.over = file, bytearray(), 0, False

    def fill(self, n: int) -> bool:
        """Has n bytes at hand, or all that are left."""
        while len(self.data) < n and not self.over:
            more = self.file.read(max(WINDOW, n - len(self.data)))
            self.over = not more
            self.data += more
        return len(self.data) >= n

    def skip(self, n: int) -> None:
        del self.data[:n]
        self.at += n

    def peek(self, at: int, n: int) -> bytes:
        """Up to n bytes from an offset of the window on, without holding those between if the file can seek."""
        if at + n <= len(self.data) or not self.file.seekable():
            self.fill(at + n)
            return bytes(self.data[at : at + n])
        back = self.file.tell()
        self.file.seek(self.at + at)
        found = bytes(self.file.read(n))
        self.file.seek(back)
        return found


class Damaged(ValueError):
    pass


def parse_headers(head: bytes) -> dict[str, str]:
    lines = head.split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise Damaged("no version line")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise Damaged("a header line without a colon")
        try:
            headers[name.strip().decode("ascii").lower()] = value.strip().decode()
        except UnicodeDecodeError:
            raise Damaged("a header that is not text") from None
    if not re.fullmatch(r"\d+", headers.get("content-length", "")):
        raise Damaged("no content length")
    return headers


def _checked(headers: dict[str, str], block: bytes) -> Record:
    record = Record(headers, block)
    stated = headers.get("warc-payload-digest", "")
    if record.kind == "response" and stated.startswith("sha1:") and stated[5:] != payload_digest(record.payload):
        raise Damaged("the payload does not match its digest")
    return record


#: A beginning of a header: whole lines, then a line that may still become one.
_HEADER_SO_FAR = re.compile(rb"(?:[^\r\n:]{1,%d}:[^\r\n]*\r\n)*(?:[^\r\n:]{0,%d}|[^\r\n:]{1,%d}:[^\r\n]*)\r?" % ((NAME_BYTES,) * 3))


class _Header:
    """Looks for a header's end in bytes that grow; each byte is tested once."""

    def __init__(self):
        self.line = 0  # begin of the first line that is not known to be whole

    def end(self, data) -> int:
        """Offset of the blank line after the header, -1 if it is still to come."""
        if self.line == 0 and len(data) >= 10:
            if not re.match(rb"WARC/1\.[01]\r\n", data):
                raise Damaged("no version line")
            self.line = 10
        if not self.line:
            return -1
        end = data.find(b"\r\n\r\n", self.line - 2)
        stop = len(data) if end < 0 else end + 2
        if not _HEADER_SO_FAR.fullmatch(bytes(data[self.line : stop])):
            raise Damaged("a header line without a colon")
        self.line = max(self.line, data.rfind(b"\r\n", self.line, stop) + 2)
        return end


def _plain_record(w: _Window) -> tuple[Record, int]:
    """The record that the window begins with, and its length."""
    header, end, size = _Header(), -1, 4096
    while end < 0:
        whole = w.fill(size)
        end = header.end(w.data)
        if end < 0 and not whole:
            raise Damaged("a header without end")
        size = 2 * len(w.data)
    headers = parse_headers(bytes(w.data[:end]))
    total = end + 4 + int(headers["content-length"]) + 4
    tail = w.peek(total - 4, 4)
    if len(tail) < 4:
        raise Damaged("the archive ends within a record")
    if tail != b"\r\n\r\n":
        raise Damaged("no record end where the content length says")
    w.fill(total)
    return _checked(headers, bytes(w.data[end + 4 : total - 4])), total


def _member_record(w: _Window) -> tuple[Record, int]:
    """The record in the gzip member that the window begins with, and the member's length.

    A member grows no further than its own header says.
    """
    z, out, used, size = zlib.decompressobj(31), bytearray(), 0, 1 << 14
    header, end, total = _Header(), -1, 0
    while not z.eof:
        whole = w.fill(used + size)
        piece = bytes(w.data[used : used + size])
        if not piece:
            raise Damaged("the archive ends within a member")
        try:
            out += z.decompress(piece)
        except zlib.error as e:
            raise Damaged(f"compressed data: {str(e)[:60]}") from None
        used += len(piece) - len(z.unused_data)
        if end < 0:
            end = header.end(out)
            if end >= 0:
                headers = parse_headers(bytes(out[:end]))
                total = end + 4 + int(headers["content-length"]) + 4
        if end >= 0 and len(out) > total:
            raise Damaged("no record end where the content length says")
        if not z.eof and not whole and used >= len(w.data):
            raise Damaged("the archive ends within a member")
        size = 1 << 16
    if end < 0:
        raise Damaged("a header without end")
    if len(out) != total or out[-4:] != b"\r\n\r\n":
        raise Damaged("no record end where the content length says")
    return _checked(headers, bytes(out[end + 4 : -4])), used


_STARTS = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")


def _opens(w: _Window, at: int) -> bool:
    """Whether a version line, plain or compressed, begins at an offset of the window."""
    if w.data[at : at + 3] != b"\x1f\x8b\x08":
        return True
    w.fill(at + 512)
    try:
        return zlib.decompressobj(31).decompress(bytes(w.data[at : at + 512]), 7).startswith(b"WARC/1.")
    except zlib.error:
        return False


def _next_start(w: _Window) -> int | None:
    """Offset of the first record start in the window; each search ends before the window may grow."""
    at = 0
    while m := _STARTS.search(w.data, at):
        if _opens(w, m.start()):
            return m.start()
        at = m.start() + 1
    return None


def salvage(file) -> Iterator[Record | Gap]:
    """All records that can be read, and the gaps between them, in order."""
    w = _Window(file)
    bad_from, reason = None, ""
    while w.fill(1):
        w.fill(16)
        try:
            if w.data[:3] == b"\x1f\x8b\x08":
                record, used = _member_record(w)
            elif w.data[:5] == b"WARC/":
                record, used = _plain_record(w)
            else:
                raise Damaged("neither a member nor a version line")
        except Damaged as e:
            if bad_from is None:
                bad_from, reason = w.at, str(e)
            w.skip(1)
            while w.fill(1):
                w.fill(WINDOW)
                found = _next_start(w)
                if found is not None:
                    w.skip(found)
                    break
                # a start may lie across the window's edge
                w.skip(len(w.data) if w.over else max(1, len(w.data) - 16))
            continue
        if bad_from is not None:
            yield Gap(bad_from, w.at, reason)
            bad_from = None
        record.start, record.end = w.at, w.at + used
        w.skip(used)
        yield record
    if bad_from is not None:
        yield Gap(bad_from, w.at, reason)


def _write_archives(folder: str, max_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, out, done = TaskContext.get().partitionId(), 0, None, []
        try:
            for batch in batches:
                for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "first", "is_first"))):
                    page_id, url, html, first, is_first = row
                    if out is None:
                        out = AtomicFile(f"{folder}/part-{part:05d}-{number:04d}.warc.gz")
                        number += 1
                        out.write(member(record_bytes([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:archive:{part}-{number}>"), ("WARC-Date", _DATE)], b"format: WARC File Format 1.1\r\n")))
                    out.write(member(page_record(page_id, url, (html or "").encode(), first, is_first)))
                    if out.size > max_bytes:
                        out.__exit__(None, None, None)
                        done.append((out.at, out.size))
                        out = None
        except BaseException as e:
            if out is not None:
                out.__exit__(type(e), e, None)
            raise
        if out is not None:
            out.__exit__(None, None, None)
            done.append((out.at, out.size))
        names = [at.rpartition("/")[2] for at, _ in done]
        yield pa.RecordBatch.from_pydict({"path": pa.array([f"{folder}/{n}" for n in names], pa.string()), "bytes": pa.array([s for _, s in done], pa.int64())})

    return write


def write_archives(pages: DataFrame, folder: str, *, min_bytes: int = 0, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as archives in ``folder``; returns path and bytes of each.

    Payloads below ``min_bytes`` are never revisited.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    keyed = keyed.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html"))
    seen = scratch.table(keyed.where(F.col("size") >= min_bytes).groupBy("digest", "size", "page_id").agg(F.count(F.lit(1)).alias("n")), "seen")
    first = seen.groupBy("digest", "size").agg(F.min("page_id").alias("first"), F.sum("n").alias("n")).where("n > 1").drop("n")
    first = scratch.table(first.withColumnsRenamed({"digest": "d", "size": "s"}), "first")
    # digests meet digests; payloads are dealt by page, so that no common payload goes to one task
    later = seen.join(first, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s"))).where(~F.col("page_id").eqNullSafe(F.col("first")))
    later = scratch.table(later.select(F.col("page_id").alias("p"), "d", "s", "first"), "later")
    told = keyed.join(later, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s")), "left")
    told = told.withColumn("is_first", F.col("d").isNull()).select("page_id", "url", "html", "first", "is_first")
    return scratch.table(told.mapInArrow(_write_archives(folder, max_bytes), "path string, bytes long"), "manifest")


RECORD_COLUMNS = "path string, start long, stop long, type string, id string, refers_to string, digest string, payload_bytes long, gap string"


def _read_archives(with_payload: bool):
    names = [c.split()[0] for c in RECORD_COLUMNS.split(", ")] + ["payload"] * with_payload
    kinds = [pa.int64() if c.split()[1] == "long" else pa.string() for c in RECORD_COLUMNS.split(", ")] + [pa.binary()] * with_payload

    def rows(path: str) -> Iterator[tuple]:
        fs, at = open_fs(path)
        with fs.open_input_file(at) as file:
            for x in salvage(file):
                if isinstance(x, Gap):
                    yield (path, x.start, x.end, "gap", None, None, None, None, x.reason) + (None,) * with_payload
                    continue
                h = x.headers
                full = x.kind == "response"
                digest = payload_digest(x.payload) if full else h.get("warc-payload-digest", "").removeprefix("sha1:") or None
                size = len(x.payload) if full else int(h["x-payload-length"]) if h.get("x-payload-length", "").isdigit() else None
                refers = h.get("warc-refers-to")
                yield (path, x.start, x.end, x.kind, h.get("warc-record-id"), refers, digest, size, None) + ((x.payload if full else None),) * with_payload

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        weight = 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for row in rows(path):
                    held.append(row)
                    weight += 200 + (len(row[-1] or b"") if with_payload else 0)
                    if weight > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
                        held, weight = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)

    return read


def read_archives(manifest: DataFrame, *, with_payload: bool = False) -> DataFrame:
    """Every record and gap of the archives in ``manifest`` (path); one task reads an archive."""
    n = max(1, manifest.count())
    schema = RECORD_COLUMNS + (", payload binary" if with_payload else "")
    return manifest.select("path").repartition(n).mapInArrow(_read_archives(with_payload), schema)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "archives")
    records = read_archives(write_archives(table(spark, sf_dir, "pages"), scratch.folder("files")))

    def page(c: str):
        return F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")

    return records.where(F.col("type").isin("response", "revisit")).select(
        page("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
        F.when(F.col("type") == "revisit", page("refers_to")).alias("refers_to"),
    )


#: Base32 of the SHA-1: every 5 hex digits are 20 bits, which are 4 characters.
OP8_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS h FROM p
), b AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest FROM d
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM b
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM f
"""
