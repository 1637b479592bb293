"""WARC archives: written with revisit records, read back with salvage around damaged bytes."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.words import written
from tablesync.storage import shared_dir

#: Payloads of fewer bytes are always stored.
LEAST_REVISITED = 1000
#: An archive is closed once it has so many bytes.
ARCHIVE_BYTES = 1 << 24
#: One payload's rows are spread over so many groups before they meet the record they revisit.
SALTS = 256

# Fixed values of the WARC/1.1, gzip and HTTP formats.
VERSION = b"WARC/1.1"
GZIP_MAGIC = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END_OF_RECORD = b"\r\n\r\n"
#: A gzip member without content: what Spark's text writer puts after an archive's last record.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")

_VERSION_LINE = re.compile(rb"WARC/[0-9]\.[0-9]\r?\n")
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


# --- one record ----------------------------------------------------------------------------


def digest_text(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    """A whole record; the block's digest and length are put in."""
    lines = {**headers, "WARC-Block-Digest": digest_text(block), "Content-Length": str(len(block))}
    head = "".join(f"{k}: {v}\r\n" for k, v in lines.items())
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + END_OF_RECORD


def gzip_member(data: bytes, level: int = 6) -> bytes:
    deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


@dataclass
class Record:
    """A verified record. ``offset`` and ``length`` are those of its member or, in plain archives, its own."""

    offset: int
    length: int
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        """What follows the HTTP head; the whole block of other records."""
        if not self.headers.get("content-type", "").startswith("application/http"):
            return self.block
        head, found, body = self.block.partition(b"\r\n\r\n")
        return body if found else b""

    @property
    def payload_length(self) -> int | None:
        """The full payload's bytes, also for a revisit record, whose HTTP head has them."""
        if self.headers["warc-type"] != "revisit":
            return len(self.payload)
        found = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t]*\r?$", self.block.partition(b"\r\n\r\n")[0])
        return int(found[1]) if found else None


@dataclass
class Gap:
    """Bytes of an archive that belong to no valid record. ``inside`` is the offset in the inflated member."""

    offset: int
    length: int
    reason: str
    inside: int | None = None


def parse_record(data: bytes, start: int) -> tuple[dict[str, str], bytes, int] | str:
    """Headers, block and end of the record at ``start``, or what is wrong with it."""
    if not (line := _VERSION_LINE.match(data, start)):
        return "no version line"
    head_end = data.find(b"\r\n\r\n", line.end() - 2)
    if head_end < 0:
        return "headers do not end"
    headers: dict[str, str] = {}
    name = ""
    for raw in data[line.end() : head_end].split(b"\r\n") if head_end > line.end() else []:
        text = raw.decode("utf-8", "replace")
        if text[:1] in " \t" and name:  # a folded line
            headers[name] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        name = name.strip().lower()
        if not colon or not name:
            return "a header line has no name"
        headers[name] = value.strip()
    missing = [n for n in ("warc-type", "warc-record-id", "content-length") if n not in headers]
    if missing:
        return f"no {missing[0]}"
    if not re.fullmatch("[0-9]{1,18}", headers["content-length"]):
        return "content-length is no number"
    first = head_end + 4
    last = first + int(headers["content-length"])
    if last + len(END_OF_RECORD) > len(data):
        return "record is cut off"
    if data[last : last + len(END_OF_RECORD)] != END_OF_RECORD:
        return "no line breaks after the block"
    block = data[first:last]
    if not digest_matches(headers.get("warc-block-digest"), block):
        return "block digest differs"
    return headers, block, last + len(END_OF_RECORD)


def digest_matches(stated: str | None, data: bytes) -> bool:
    """Whether a stated digest is that of the data; one that is absent or of an unknown kind says nothing."""
    kind, _, value = (stated or "").partition(":")
    if kind.lower() not in ("sha1", "sha256", "md5"):
        return True
    found = hashlib.new(kind.lower(), data).digest()
    return value.strip().upper().rstrip("=") in (base64.b32encode(found).decode().rstrip("="), found.hex().upper())


# --- salvage -------------------------------------------------------------------------------


def plain_records(data: bytes) -> Iterator[Record | Gap]:
    """Records of uncompressed bytes. After a failed check the next version line at which a valid record stands is searched."""
    at = 0
    while at < len(data):
        found = parse_record(data, at)
        if isinstance(found, str):
            reason, start, at = found, at, _next_valid(data, at + 1)
            yield Gap(start, at - start, reason)
        else:
            headers, block, end = found
            yield Record(at, end - at, headers, block)
            at = end


def _next_valid(data: bytes, start: int) -> int:
    for line in _VERSION_LINE.finditer(data, start):
        if not isinstance(parse_record(data, line.start()), str):
            return line.start()
    return len(data)


def inflate(data: bytes, start: int) -> tuple[bytes, int, str | None]:
    """What the gzip member at ``start`` holds, where it ends, and what is wrong with it.

    Of a damaged member the bytes come back that were inflated before the damage.
    """
    stream, out, at = zlib.decompressobj(31), [], start
    try:
        while at < len(data) and not stream.eof:
            before, chunk = stream.copy(), data[at : at + (1 << 16)]
            out.append(stream.decompress(chunk))
            at += len(chunk)
    except zlib.error as error:
        reason, stream = f"damaged member ({str(error)[:60]})", before
        try:  # byte by byte up to the damage
            for at in range(at, len(data)):
                out.append(stream.decompress(data[at : at + 1]))
        except zlib.error:
            pass
        return b"".join(out), at, reason
    if not stream.eof:
        return b"".join(out), at, "member is cut off"
    return b"".join(out), at - len(stream.unused_data), None


def gzip_records(data: bytes) -> Iterator[Record | Gap]:
    """Records of compressed bytes. After a failed check the next valid member is searched.

    A member may hold several records. Those it holds beside damaged ones, and those inflated whole before
    a member breaks off, are kept if their block digest confirms them; the damaged ones are gaps inside the member.
    """
    at = 0
    while at < len(data):
        if data.startswith(GZIP_MAGIC, at):
            inflated, end, wrong = inflate(data, at)
            if wrong is None:
                yield from _member_records(inflated, at, end, confirmed=False)
                at = end
                continue
            yield from (x for x in _member_records(inflated, at, end, confirmed=True) if isinstance(x, Record))
        else:
            wrong = "no gzip member"
        start, at = at, _next_member(data, at + 1)
        yield Gap(start, at - start, wrong)


def _member_records(inflated: bytes, offset: int, end: int, confirmed: bool) -> Iterator[Record | Gap]:
    for found in plain_records(inflated):
        if isinstance(found, Gap):
            yield Gap(offset, end - offset, found.reason, found.offset)
        elif not confirmed or "warc-block-digest" in found.headers:
            yield Record(offset, end - offset, found.headers, found.block)


def _next_member(data: bytes, start: int) -> int:
    """Where the next member with a valid record begins, else the end."""
    while (start := data.find(GZIP_MAGIC, start)) >= 0:
        inflated, _, wrong = inflate(data, start)
        if wrong is None and (not inflated or any(isinstance(x, Record) for x in plain_records(inflated))):
            return start
        start += 1
    return len(data)


def archive_records(data: bytes) -> Iterator[Record | Gap]:
    """The verified records of an archive, compressed by record or plain, and the gaps between them.

    Its first bytes say which it is; if they are damaged it is read in the way that recovers more records.
    """
    if data.startswith(GZIP_MAGIC):
        return gzip_records(data)
    if _VERSION_LINE.match(data):
        return plain_records(data)
    both = [list(gzip_records(data)), list(plain_records(data))]
    return iter(max(both, key=lambda found: sum(isinstance(x, Record) for x in found)))


# --- writing -------------------------------------------------------------------------------


def _clean(value: str | None) -> str:
    """A header value on one line; white space and controls as percent escapes."""
    return _CONTROL.sub(lambda c: f"%{ord(c[0]):02X}", value or "")


def _record_id(row: int) -> str:
    name = hashlib.sha1(b"record %d" % row).hexdigest()
    return f"<urn:uuid:{name[:8]}-{name[8:12]}-5{name[13:16]}-8{name[17:20]}-{name[20:32]}>"


def _headers(kind: str, row: int, page_id: int | None, url: str | None, date: str, payload_digest: str) -> dict[str, str]:
    page = {} if page_id is None else {"X-Page-Id": str(page_id)}
    target = _clean(url) or f"urn:page:{page_id}"
    return {
        "WARC-Type": kind,
        "WARC-Record-ID": _record_id(row),
        "WARC-Date": date,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": payload_digest,
        "Content-Type": "application/http; msgtype=response",
        **page,
    }


@dataclass(frozen=True)
class Archives:
    """How archives are written: compressed by record or plain, and what a record's date is."""

    compressed: bool = True
    archive_bytes: int = ARCHIVE_BYTES
    least_revisited: int = LEAST_REVISITED
    date: str = "1970-01-01T00:00:00Z"
    level: int = field(default=6)

    def stored(self, record: bytes) -> bytes:
        return gzip_member(record, self.level) if self.compressed else record


def capture(spark: SparkSession, pages: DataFrame, how: Archives) -> DataFrame:
    """Each page as a stored response record with its digest, written with a ``row`` number of its own."""
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for values in zip(*batch.columns, strict=True):
                row, page_id, url, html = (x.as_py() for x in values)
                payload = (html or "").encode()
                headers = _headers("response", row, page_id, url, how.date, digest_text(payload))
                member = how.stored(record_bytes(headers, http_head(len(payload)) + payload))
                out.append((row, page_id, url, len(payload), hashlib.sha1(payload).digest(), member))
                size += len(member)
                if size > 1 << 22 or len(out) >= 1000:
                    yield _batch(out, batch)
                    out, size = [], 0
            yield _batch(out, batch)

    def _batch(rows: list[tuple], like: pa.RecordBatch) -> pa.RecordBatch:
        types = [pa.int64(), like.column(1).type, pa.string(), pa.int64(), pa.binary(), pa.binary()]
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        names = ["row", "page_id", "url", "payload_bytes", "payload_sha1", "record"]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    rows = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", "html")
    schema = f"row long, page_id {kind}, url string, payload_bytes long, payload_sha1 binary, record binary"
    return written(spark, rows.mapInArrow(run, schema), "warc-captured")


def revisits(captured: DataFrame, least: int = LEAST_REVISITED) -> DataFrame:
    """``row`` of every record whose payload another record stores, and that record's row, page and url.

    Of equal payloads that of the largest page_id is stored, among equal ids that of the last row; a null id is less than any.
    Equal means equal in SHA-1 and length. The leader of a payload is found from one row per task; it comes back to the payload's rows
    in ``SALTS`` groups, so that a payload that a third of all pages share is no task's alone.
    """
    slim = captured.where(F.col("payload_bytes") >= least).select(
        "payload_sha1",
        "payload_bytes",
        F.pmod(F.xxhash64("row"), F.lit(SALTS)).alias("salt"),
        "row",
        F.struct(F.col("page_id").isNotNull().alias("has_id"), "page_id", "row", "url").alias("who"),
    )
    by = ["payload_sha1", "payload_bytes"]
    parts = slim.groupBy(*by, "salt").agg(F.max("who").alias("who"), F.count("*").alias("n"))
    shared = parts.groupBy(*by).agg(F.max("who").alias("leader"), F.sum("n").alias("n")).where("n > 1").drop("n")
    leaders = parts.select(*by, "salt").join(shared, by)
    found = slim.select(*by, "salt", "row").join(leaders, [*by, "salt"]).where("row <> leader.row")
    return found.select(
        "row",
        F.col("leader.row").alias("of_row"),
        F.col("leader.page_id").alias("of_page"),
        F.col("leader.url").alias("of_url"),
    )


def write_archives(spark: SparkSession, pages: DataFrame, path: str, how: Archives | None = None) -> None:
    """Write a record per page into archives of about ``archive_bytes`` under ``path``.

    Equal payloads of ``least_revisited`` bytes or more are stored once, the others are revisit records that
    name the record and page they repeat. Pages need page_id, url and html; a null html is an empty payload, a null url becomes
    a urn, a null page_id is left out of the headers. Repeated rows are a record each. Other columns are not looked at.

    Files are written by Spark's own text writer, one archive per row of bytes, so they appear only once a task is committed and on
    any file system Spark can write. It ends each file with a separator: the last line break of a plain archive, an empty gzip member otherwise.
    """
    how = how or Archives()
    captured = capture(spark, pages, how)
    # written first: Spark then knows their size, and only where they are many are the records shuffled to them
    repeated = written(spark, revisits(captured, how.least_revisited), "warc-revisits")
    joined = captured.join(repeated, "row", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                r = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                parts.append(r["record"] if r["of_row"] is None else _revisit(r, how))
                size += len(parts[-1])
                if size >= how.archive_bytes:
                    yield _archive(parts)
                    parts, size = [], 0
        if parts:
            yield _archive(parts)

    def _archive(parts: list[bytes]) -> pa.RecordBatch:
        data = b"".join(parts)
        return pa.RecordBatch.from_arrays([pa.array([data if how.compressed else data[:-2]], pa.binary())], ["archive"])

    archives = joined.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
    writer = archives.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1")
    writer.option("lineSep", EMPTY_MEMBER.decode("latin-1") if how.compressed else "\r\n").text(path)


def _revisit(r: dict, how: Archives) -> bytes:
    payload_digest = "sha1:" + base64.b32encode(r["payload_sha1"]).decode()
    headers = _headers("revisit", r["row"], r["page_id"], r["url"], how.date, payload_digest)
    headers |= {
        "WARC-Profile": REVISIT_PROFILE,
        "WARC-Refers-To": _record_id(r["of_row"]),
        "WARC-Refers-To-Target-URI": _clean(r["of_url"]) or f"urn:page:{r['of_page']}",
        "WARC-Refers-To-Date": how.date,
    }
    if r["of_page"] is not None:
        headers["X-Refers-To-Page-Id"] = str(r["of_page"])
    return how.stored(record_bytes(headers, http_head(r["payload_bytes"])))


# --- reading -------------------------------------------------------------------------------

_READ_SCHEMA = """file string, offset long, length long, inside long, reason string, headers map<string,string>,
payload_bytes long, payload_sha1 string, payload binary"""


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All verified records of the archives under ``path``, and the quarantined gaps.

    A record has ``headers`` (names in lower case), ``payload_bytes`` of its full payload and ``payload_sha1`` in hex: computed for stored
    payloads (and compared with the stated digest: if they differ the record is a gap), as stated for revisits. A gap has null headers and a
    ``reason``; its ``inside`` is where it begins in the inflated member. Every byte of every archive is in a record's or a gap's range.

    An archive is one task's, up to 2 GB as Spark reads files; a member is inflated whole. Empty archives give no rows.
    ``payloads=False`` leaves the payloads where they are read.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    names = ["file", "offset", "length", "inside", "reason", "headers", "payload_bytes", "payload_sha1", "payload"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string())]
    types += [pa.int64(), pa.string(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file, rows, size = batch.column(0)[i].as_py(), [], 0
                for found in archive_records(batch.column(1)[i].as_py()):
                    rows.append(_row(file, found, payloads))
                    size += len(rows[-1][-1] or b"")
                    if size > 1 << 22 or len(rows) >= 1000:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return files.mapInArrow(run, _READ_SCHEMA)


def _row(file: str, found: Record | Gap, payloads: bool) -> tuple:
    if isinstance(found, Gap):
        return (file, found.offset, found.length, found.inside, found.reason, None, None, None, None)
    stated = found.headers.get("warc-payload-digest")
    if found.headers["warc-type"] == "revisit":
        sha1 = _stated_sha1(stated)
    else:
        payload = found.payload
        if not digest_matches(stated, payload):
            return (file, found.offset, found.length, None, "payload digest differs", None, None, None, None)
        sha1 = hashlib.sha1(payload).hexdigest()
    kept = found.payload if payloads else None
    headers = list(found.headers.items())
    return (file, found.offset, found.length, None, None, headers, found.payload_length, sha1, kept)


def _stated_sha1(stated: str | None) -> str | None:
    kind, _, value = (stated or "").partition(":")
    if kind.lower() != "sha1":
        return None
    if re.fullmatch("[0-9a-fA-F]{40}", value):
        return value.lower()
    return base64.b32decode(value.upper()).hex() if re.fullmatch("[A-Za-z2-7]{32}", value) else None


def records(read: DataFrame) -> DataFrame:
    return read.where("headers IS NOT NULL").drop("reason", "inside")


def gaps(read: DataFrame) -> DataFrame:
    """The quarantine log: file, offset, length, inside, reason."""
    return read.where("headers IS NULL").select("file", "offset", "length", "inside", "reason")


def op12_warc(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """All pages written as archives and read back, a row per record; an empty table gives no rows."""
    path = shared_dir(spark, "warc")
    write_archives(spark, pages, path)
    kind = pages.schema["page_id"].dataType.simpleString()
    h = F.col("headers")
    return records(read_archives(spark, path, payloads=False)).select(
        h["x-page-id"].cast(kind).alias("page_id"),
        "payload_bytes",
        F.col("payload_sha1").alias("payload_digest"),
        h["warc-type"].alias("record_type"),
        h["x-refers-to-page-id"].cast(kind).alias("refers_to"),
    )


#: A window over equal payloads; rows that share an id and a payload are told apart by their number.
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, row_number() OVER () AS nr FROM pages),
g AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
  row_number() OVER w AS place, first_value(page_id) OVER w AS leader FROM p
  WINDOW w AS (PARTITION BY html ORDER BY page_id DESC NULLS LAST, nr))
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes < 1000 OR place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN payload_bytes < 1000 OR place = 1 THEN NULL ELSE leader END AS refers_to FROM g
"""
