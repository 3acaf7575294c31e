"""WARC archives: round trip, revisits, and damage that must be noticed."""

import hashlib
import struct

import pytest
import zstandard

from gridzone.llm import warc


def rows_of(records):
    return sorted((r.record_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, r.payload) for r in records.collect())


def test_edge_cases(spark):
    big, sha = "é" * 60, lambda s: hashlib.sha256(s.encode()).hexdigest()
    pages = [(1, "http://a/ b\r\nX: y", None), (2, None, ""), (5, "u", big), (3, "u", big), (3, "u", big), (7, "u", "short"), (8, "u", "short"), (None, "u", big), (9, "u", "x" * 3_000_000)]
    df = spark.createDataFrame([(p, u, h, "z") for p, u, h in pages], "page_id long, url string, html string, digest string")
    got = [r[:5] for r in rows_of(warc.round_trip(spark, df))]
    want = []
    for p, _, h in pages:
        first = "urn:page:3" if h == big and p != 3 else None
        want.append((f"urn:page:{'null' if p is None else p}" if p is not None else None, "revisit" if first else "response", first, len((h or "").encode()), sha(h or "")))
    key = lambda r: (str(r[0]), str(r[1:]))
    assert sorted(((None if r[0] == "urn:page:null" else r[0], *r[1:]) for r in got), key=key) == sorted(want, key=key)
    assert warc.round_trip(spark, df.limit(0)).collect() == []


def test_payloads_come_back(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    html = {f"urn:page:{r.page_id}": r.html or "" for r in pages.collect()}
    records = warc.round_trip(spark, pages).collect()
    assert len(records) == len(html)
    for r in records:
        assert r.payload_digest == hashlib.sha256(html[r.record_id].encode()).hexdigest()
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload).decode() == html[r.record_id]


def _archive(n=60):
    records = [warc.record(f"urn:page:{i}", "u", (f"<p>page {i} " + "text of a page " * 20).encode(), hashlib.sha256((f"<p>page {i} " + "text of a page " * 20).encode()).hexdigest(), None, "1970-01-01T00:00:00Z") for i in range(n)]
    return records, warc.archive(records, warc._dictionary(records * 8))


def test_dictionary_is_in_the_leading_skippable_frame():
    records, data = _archive()
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D
    assert [c for _, c in warc.frames(data)] == records
    raw = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    plain = data[:4] + struct.pack("<I", len(raw)) + raw + data[8 + size :]  # the dictionary may also stand uncompressed
    assert [c for _, c in warc.frames(plain)] == records
    with pytest.raises(warc.MalformedArchive):
        list(warc.frames(data[8 + size :]))
    note = struct.pack("<II", 0x184D2A53, 3) + b"xyz"
    assert [c for _, c in warc.frames(data + note)] == records
    assert list(warc.frames(b"")) == []


def test_damage_is_noticed():
    records, data = _archive(5)
    for cut in (len(data) - 1, len(data) - 30, 11):
        with pytest.raises(warc.MalformedArchive):
            list(warc.frames(data[:cut]))
    flipped = bytearray(data)
    flipped[-10] ^= 255
    with pytest.raises(warc.MalformedArchive):
        list(warc.frames(bytes(flipped)))
    good = records[0]
    for old, new in [(b"WARC/1.1", b"WARC/9.9"), (b"WARC-Date: ", b"WARC-Daze: "), (b"sha256:", b"sha256:0"), (b"<p>page", b"<p>pagE"), (b"<p>page", b"<p>pages"), (b"WARC-Type: response", b"WARC-Type response")]:
        with pytest.raises(warc.MalformedArchive):
            warc.parse(good.replace(old, new))
    with pytest.raises(warc.MalformedArchive):
        warc.parse(good[:-1])
    assert warc.parse(good)["record_type"] == "response"


def test_damaged_file_is_named(spark, tmp_path):
    records, data = _archive(3)
    (tmp_path / "a.warc.zst").write_bytes(data)
    files = spark.read.format("binaryFile").load(str(tmp_path))
    assert warc.read_archives(files).count() == 3
    (tmp_path / "b.warc.zst").write_bytes(data[:-2])
    with pytest.raises(Exception, match="b.warc.zst"):
        warc.read_archives(spark.read.format("binaryFile").load(str(tmp_path))).collect()


def test_a_second_attempt_that_cuts_otherwise_adds_nothing(spark, tmp_path, monkeypatch):
    """Two attempts at one task: other row order, other cuts. Only the files of the attempt that counts are read."""
    pages = [(i, "u", f"<p>page {i}</p> " * 40) for i in range(20)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    root = f"file://{tmp_path}/w"
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4000)
    first = warc.write_archives(df, root)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 9000)
    second = warc.write_archives(df.orderBy(-df.page_id).coalesce(1), root)
    for written in (first, second):
        records = warc.read_written(spark, root, written).collect()
        assert sorted(r.record_id for r in records) == sorted(f"urn:page:{i}" for i in range(20))
    assert first.count() != second.count()


def test_missing_and_short_archives_are_noticed(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", f"page {i}" * 30) for i in range(9)], "page_id long, url string, html string").coalesce(1)
    root = f"file://{tmp_path}/w"
    written = warc.write_archives(df, root)
    with pytest.raises(Exception, match="records where"):
        warc.read_written(spark, root, written.withColumn("records", written.records + 1)).collect()
    other = written.selectExpr("concat(file, 'x') as file", "records")
    with pytest.raises(warc.MalformedArchive, match="is gone"):
        warc.read_written(spark, root, other)
