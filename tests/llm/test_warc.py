"""WARC archives: written, read back, damaged in every way, and salvaged."""

from __future__ import annotations

import gzip
import hashlib
import random
from pathlib import Path

import pytest

from tablesync.llm import warc
from tablesync.llm.warc import Archives, Gap, Record, archive_records, record_bytes

LONG = "<p>shared</p>" * 100
PAGES = [
    (1, "http://a/1", LONG, "x", 1),
    (5, "http://a/5", LONG, "x", 1),
    (5, "http://a/5", LONG, "x", 1),  # a row repeated in full
    (None, "http://a/null", LONG, "x", 1),
    (2, "http://a/2", "short", "x", 1),
    (3, "http://a/3", "short", "x", 1),
    (4, None, None, None, None),
    (6, "http://a/6\r\nWARC-Type: evil", "", "x", 1),
    (7, "http://ü/7 x", "WARC/1.1\r\nWARC-Type: response\r\n\r\n☃" + "y" * 200_000, "x", 1),
    (8, "http://a/8", "y" * 999, "x", 1),
    (9, "http://a/9", "y" * 999, "x", 1),
    (10, "http://a/10", "ü" * 500, "x", 1),
    (11, "http://a/11", "ü" * 500, "x", 1),
    (None, "http://b", "z" * 1000, "x", 1),
    (None, "http://b", "z" * 1000, "x", 1),
]
SCHEMA = "page_id long, url string, html string, payload string, `row` long"


def brute(pages):
    groups, out = {}, []
    for i, (page_id, _, html, *_) in enumerate(pages):
        groups.setdefault(html or "", []).append((page_id is not None, page_id or 0, i))
    for i, (page_id, _, html, *_) in enumerate(pages):
        data = (html or "").encode()
        leader = max(groups[html or ""])
        base = (page_id, len(data), hashlib.sha1(data).hexdigest())
        if len(data) < 1000 or leader[2] == i:
            out.append((*base, "response", None))
        else:
            out.append((*base, "revisit", leader[1] if leader[0] else None))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    assert rows_of(warc.op12_warc(spark, pages)) == brute(PAGES)
    assert warc.op12_warc(spark, spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("compressed", [True, False])
def test_files(spark, tmp_path, compressed):
    """Standard files: gunzip and a plain parse of them give every record; payloads come back whole."""
    path = str(tmp_path / "archives")
    how = Archives(compressed=compressed, archive_bytes=3000)
    warc.write_archives(spark, spark.createDataFrame(PAGES, SCHEMA).coalesce(1), path, how)
    files = sorted(Path(path).glob("part-*"))
    assert len(files) > 1
    whole = b"".join(gzip.decompress(f.read_bytes()) if compressed else f.read_bytes() for f in files)
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == len(PAGES) + 1  # one page quotes the line
    read = warc.read_archives(spark, path)
    assert warc.gaps(read).count() == 0
    stored = {r.headers["warc-record-id"]: r for r in warc.records(read).collect()}
    assert len(stored) == len(PAGES)
    found = []
    for r in stored.values():
        of = stored[r.headers["warc-refers-to"]] if r.headers["warc-type"] == "revisit" else r
        found.append((r.headers.get("x-page-id"), of.payload.decode()))
        assert r.headers.get("x-refers-to-page-id") == (of.headers.get("x-page-id") if of is not r else None)
    assert sorted(found, key=repr) == sorted(((None if p[0] is None else str(p[0]), p[2] or "") for p in PAGES), key=repr)


def sample(i, size=300):
    headers = {"WARC-Type": "resource", "WARC-Record-ID": f"<urn:x:{i}>"}
    return record_bytes(headers, random.Random(i).randbytes(size // 2).hex().encode())


def ids(found):
    return [x.headers["warc-record-id"][7:-1] for x in found if isinstance(x, Record)]


def spans(found):
    return [(x.offset, x.length) for x in found if isinstance(x, Gap)]


@pytest.mark.parametrize("compressed", [True, False])
def test_any_flipped_byte_costs_one_record(compressed):
    parts = [sample(i) if not compressed else warc.gzip_member(sample(i)) for i in range(4)]
    data, start, end = b"".join(parts), len(parts[0]), len(parts[0] + parts[1])
    assert ids(archive_records(data)) == ["0", "1", "2", "3"]
    for at in range(start, end):
        broken = bytearray(data)
        broken[at] ^= 0x41
        found = list(archive_records(bytes(broken)))
        assert [i for i in ids(found) if i in "023"] == ["0", "2", "3"], at
        # a flip in a header's name or a gzip header's time does no harm; else the bytes are logged
        assert spans(found) == [(start, end - start)] or len(ids(found)) == 4, at


@pytest.mark.parametrize("compressed", [True, False])
def test_cut_inserted_and_missing_bytes(compressed):
    parts = [sample(i) if not compressed else warc.gzip_member(sample(i)) for i in range(4)]
    whole = b"".join(parts)
    for cut in (1, 50, len(parts[0]) - 1):
        found = list(archive_records(whole[cut:]))  # the first record lost its beginning
        assert ids(found) == ["1", "2", "3"] and spans(found) == [(0, len(parts[0]) - cut)]
        found = list(archive_records(whole[:-cut]))
        # a member without the end of its checksum still holds a record that its own digest confirms
        assert ids(found) == ["0", "1", "2", *(["3"] if compressed and cut == 1 else [])]
        last = len(whole) - len(parts[3])
        assert spans(found) == [(last, len(parts[3]) - cut)]
    junk = b"WARC/1.1\r\n\x1f\x8b\x08 junk \r\n\r\n" * 3
    found = list(archive_records(parts[0] + junk + parts[1]))
    assert ids(found) == ["0", "1"] and spans(found) == [(len(parts[0]), len(junk))]
    assert list(archive_records(b"")) == []
    assert spans(archive_records(b"nothing here")) == [(0, 12)]


def test_wrong_length_does_not_swallow_records():
    """A content length that is too large takes the next records only into its own gap's search."""
    first = sample(0).replace(b"Content-Length: 300", b"Content-Length: 900")
    found = list(archive_records(first + sample(1) + sample(2)))
    assert ids(found) == ["1", "2"] and spans(found) == [(0, len(first))]


def test_one_member_for_a_whole_file():
    plain = b"".join(sample(i, 5000) for i in range(20))
    member = warc.gzip_member(plain)
    assert ids(archive_records(member)) == [str(i) for i in range(20)]
    kept = ids(archive_records(member[: len(member) // 2]))  # the file is cut off: what was inflated is kept
    assert kept == [str(i) for i in range(len(kept))] and 7 <= len(kept) <= 10
    broken = bytearray(plain)
    broken[7000] ^= 1
    found = list(archive_records(warc.gzip_member(bytes(broken))))
    assert ids(found) == [str(i) for i in range(20) if i != 1]
    assert [x.inside for x in found if isinstance(x, Gap)] == [len(sample(0, 5000))]


def test_damaged_files_in_spark(spark, tmp_path):
    parts = [warc.gzip_member(sample(i)) for i in range(3)]
    broken = bytearray(b"".join(parts))
    broken[len(parts[0]) + 60] ^= 255
    (tmp_path / "a.warc.gz").write_bytes(bytes(broken))
    (tmp_path / "b.warc").write_bytes(sample(7) + sample(8))
    (tmp_path / "c.warc.gz").write_bytes(b"")
    read = warc.read_archives(spark, str(tmp_path))
    assert sorted(r.headers["warc-record-id"] for r in warc.records(read).collect()) == [f"<urn:x:{i}>" for i in (0, 2, 7, 8)]
    logged = warc.gaps(read).collect()
    assert [(r.offset, r.length, r.file[-9:]) for r in logged] == [(len(parts[0]), len(parts[1]), "a.warc.gz")]
