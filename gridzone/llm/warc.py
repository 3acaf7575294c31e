"""WARC archives, one Zstandard frame per record, with the dictionary in a leading skippable frame.

Writing: every task turns its rows into archives of about ``ARCHIVE_BYTES``
below a shared folder; a file is written under another name and then moved, and
its name depends on the task alone, so a task that runs again replaces its own files.
Reading: Spark reads the files (``binaryFile``, so any store it knows), and
each archive is decoded frame by frame; magic numbers, versions, header
fields, record and payload lengths and digests are checked.

Revisits are found on (id, digest, length) rows; payloads with equal digests
never meet in one task.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzone.llm.common import scratch_path, stored
from gridzone.operators.joins import sized_broadcast

#: Formats' fixed values: frame magic numbers (little-endian) and the profile of a revisit.
FRAME, SKIPPABLE, DICTIONARY = 0xFD2FB528, 0x184D2A50, 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVE_BYTES, MAX_RECORD_BYTES = 8_000_000, 1 << 30
#: A dictionary is trained on the first records of a task, up to these.
DICTIONARY_BYTES, SAMPLES = 16_384, 400
MIN_REVISIT = 100
RECORDS = "archive string, frame_offset long, record_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"


class MalformedArchive(ValueError):
    pass


def record(record_id: str, uri: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """A response with its payload, or a revisit with the response's HTTP headers alone."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    kind = "response" if refers_to is None else "revisit"
    if refers_to is None:
        block += payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(uri or '', safe=''.join(map(chr, range(33, 127))))}",
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"] if refers_to is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """Trained on the samples; none where they are too few or too alike to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return None


def archive(records: list[bytes], dictionary: zstandard.ZstdCompressionDict | None) -> bytes:
    """The bytes of one archive."""
    parts = []
    if dictionary is not None:
        packed = zstandard.ZstdCompressor().compress(dictionary.as_bytes())
        parts.append(struct.pack("<II", DICTIONARY, len(packed)) + packed)
    compressor = zstandard.ZstdCompressor(dict_data=dictionary, write_checksum=True)
    return b"".join([*parts, *map(compressor.compress, records)])


def _frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that begins at ``at`` ends, from its block headers."""
    try:
        head = bytes(data[at : at + 18])
        end = at + zstandard.frame_header_size(head)
        checksum = 4 * zstandard.get_frame_parameters(head).has_checksum
    except zstandard.ZstdError as e:
        raise MalformedArchive(f"frame header at byte {at}: {e}") from e
    last = False
    while not last:
        if end + 3 > len(data):
            raise MalformedArchive(f"frame at byte {at} is cut off")
        block = int.from_bytes(data[end : end + 3], "little")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        if kind == 3:
            raise MalformedArchive(f"reserved block type in the frame at byte {at}")
        end += 3 + (1 if kind == 1 else size)
    if end + checksum > len(data):
        raise MalformedArchive(f"frame at byte {at} is cut off")
    return end + checksum


def frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of every frame of an archive, under the dictionary of its leading skippable frame."""
    view, at, dictionary, content = memoryview(data), 0, None, False
    decompressor = zstandard.ZstdDecompressor()
    while at < len(data):
        if at + 8 > len(data):
            raise MalformedArchive(f"{len(data) - at} stray bytes at the end")
        magic, size = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 == SKIPPABLE:
            if at + 8 + size > len(data):
                raise MalformedArchive(f"skippable frame at byte {at} is cut off")
            if magic == DICTIONARY:
                if content or dictionary is not None:
                    raise MalformedArchive(f"dictionary at byte {at} is not the leading frame")
                raw = bytes(view[at + 8 : at + 8 + size])
                if raw[:4] == struct.pack("<I", FRAME):
                    raw = decompressor.decompress(raw, max_output_size=1 << 27)
                dictionary = zstandard.ZstdCompressionDict(raw)
                decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
            at += 8 + size
        elif magic == FRAME:
            end = _frame_end(view, at)
            size = zstandard.frame_content_size(view[at:end])
            if size > MAX_RECORD_BYTES:
                raise MalformedArchive(f"record of {size} bytes at byte {at}")
            try:
                yield at, decompressor.decompress(view[at:end], max_output_size=MAX_RECORD_BYTES if size < 0 else 0)
            except zstandard.ZstdError as e:
                raise MalformedArchive(f"frame at byte {at}: {e}") from e
            at, content = end, True
        else:
            raise MalformedArchive(f"no frame at byte {at}")


def _headers(block: bytes, what: str) -> tuple[str, dict[str, str], int]:
    """First line, fields by lower-case name, and where the rest begins."""
    end = block.find(b"\r\n\r\n")
    if end < 0:
        raise MalformedArchive(f"{what}: headers do not end")
    first, *lines = block[:end].decode("utf-8").split("\r\n")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise MalformedArchive(f"{what}: {line[:80]!r} is no header")
        fields[name.lower()] = value.strip()
    return first, fields, end + 4


def _length(fields: dict[str, str], what: str) -> int:
    value = fields.get("content-length", "")
    if not re.fullmatch("[0-9]+", value):
        raise MalformedArchive(f"{what}: Content-Length {value!r}")
    return int(value)


def parse(data: bytes) -> dict:
    """The checked fields of one record."""
    first, fields, at = _headers(data, "record")
    if not re.fullmatch(r"WARC/1\.[01]", first):
        raise MalformedArchive(f"{first[:40]!r} is no WARC version")
    if missing := {"warc-type", "warc-record-id", "warc-date", "content-length"} - fields.keys():
        raise MalformedArchive(f"record without {', '.join(sorted(missing))}")
    length = _length(fields, "record")
    if data[at + length :] != b"\r\n\r\n":
        raise MalformedArchive(f"record of {len(data) - at - 4} bytes says {length}")
    kind, block = fields["warc-type"], data[at : at + length]
    bare = lambda name: fields[name].removeprefix("<").removesuffix(">") if name in fields else None
    out = {"record_type": kind, "record_id": bare("warc-record-id"), "target_uri": fields.get("warc-target-uri"), "refers_to": bare("warc-refers-to")}
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    payload, size = block, length
    if fields.get("content-type", "").startswith("application/http"):
        status, http, body = _headers(block, "HTTP block")
        if not status.startswith("HTTP/"):
            raise MalformedArchive(f"{status[:40]!r} is no HTTP status")
        payload, size = block[body:], _length(http, "HTTP block")
    if kind == "revisit":
        if not out["refers_to"] or not digest or payload:
            raise MalformedArchive("revisit without its response or digest, or with a payload")
        return out | {"payload_digest": digest, "payload_bytes": size, "payload": None}
    if len(payload) != size:
        raise MalformedArchive(f"payload of {len(payload)} bytes says {size}")
    own = hashlib.sha256(payload).hexdigest()
    if digest and digest != own:
        raise MalformedArchive(f"payload digest {own} is not {digest}")
    return out | {"payload_digest": own, "payload_bytes": size, "payload": payload}


def write_archives(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = MIN_REVISIT, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes the archives below ``root``; (file, records) of each, as a table in the shared folder.

    Among pages with equal payloads of at least ``min_revisit`` bytes, those with
    the smallest id are responses and the others revisit it. A null payload is an
    empty one. Repeated rows are records of their own. Null ids come after all
    others; a group of null ids alone is all responses. An empty table writes no file.
    A task that is run again writes files of its own name, and the table has those of the attempt that counted: read these alone.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("name"), F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("html"), F.sha2(payload, 256).alias("digest"))
    large = rows.where(F.octet_length("html") >= min_revisit).select("id", "digest")
    first = large.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n")
    again = large.join(first, "digest").where(~F.col("id").eqNullSafe(F.col("first"))).select(F.col("id").alias("own"), F.col("digest").alias("same"), F.col("first").cast("string").alias("first")).distinct()
    marked = rows.join(again, F.col("id").eqNullSafe(F.col("own")) & (F.col("digest") == F.col("same")), "left").select("name", "url", "html", "digest", "first")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(root)
        store.create_dir(folder, recursive=True)
        task, files, dictionary, trained = TaskContext.get(), [], None, False
        held, size = [], 0

        def flush():
            nonlocal dictionary, trained, held, size
            if not trained:
                dictionary, trained = _dictionary(held[:SAMPLES]), True
            name, temporary = f"{folder}/{task.partitionId():06d}-{task.taskAttemptId()}-{len(files):06d}-{uuid.uuid4().hex[:8]}.warc.zst", f"{folder}/.{uuid.uuid4().hex}"
            with store.open_output_stream(temporary) as out:
                out.write(archive(held, dictionary))
            store.move(temporary, name)
            files.append((name, len(held)))
            held, size = [], 0

        for batch in batches:
            for name, url, html, digest, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(record(f"urn:page:{name}", url, html.encode(), digest, None if first is None else f"urn:page:{first}", date))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    flush()
        if held:
            flush()
        yield pa.RecordBatch.from_pydict({"file": [f for f, _ in files], "records": [n for _, n in files]}, schema=pa.schema([("file", pa.string()), ("records", pa.int64())]))

    return stored(marked.mapInArrow(write, "file string, records long"), "warc-files")


def read_archives(files: DataFrame) -> DataFrame:
    """Records of archives given as (path, content) rows, as the ``binaryFile`` source gives them.

    A damaged archive fails the read and names the file, as does one that has not as many records as its column
    ``records`` says, if there is one. Empty archives have no records.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORDS.split(", ")]
        types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(f.split()[0], types[f.split()[1]]) for f in RECORDS.split(", ")])
        for batch in batches:
            for path, content, expected in zip(*(batch.column(c) for c in ("path", "content", "records")), strict=True):
                rows, size, n = [], 0, 0
                try:
                    for at, data in frames(content.as_py()):
                        rows.append(parse(data) | {"archive": path.as_py(), "frame_offset": at})
                        size, n = size + len(data), n + 1
                        if size >= ARCHIVE_BYTES:
                            yield pa.RecordBatch.from_pydict({n: [r[n] for r in rows] for n in names}, schema=schema)
                            rows, size = [], 0
                    if expected.is_valid and n != expected.as_py():
                        raise MalformedArchive(f"{n} records where {expected.as_py()} were written")
                except MalformedArchive as e:
                    raise MalformedArchive(f"{path.as_py()}: {e}") from e
                if rows:
                    yield pa.RecordBatch.from_pydict({n: [r[n] for r in rows] for n in names}, schema=schema)

    counts = F.col("records").cast("long") if "records" in files.columns else F.lit(None).cast("long")
    return files.select("path", "content", counts.alias("records")).mapInArrow(decode, RECORDS)


def read_written(spark: SparkSession, root: str, written: DataFrame) -> DataFrame:
    """Records of exactly the archives of ``written`` (file, records), the result of ``write_archives``; all of them must be there."""
    name = lambda c: F.substring_index(c, "/", -1)
    own = written.select(name("file").alias("name"), "records")
    if not own.limit(1).count():
        return spark.createDataFrame([], RECORDS)
    there = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(root)
    if missing := own.join(there.select(name("path").alias("name")), "name", "left_anti").limit(1).collect():
        raise MalformedArchive(f"archive {missing[0]['name']} is gone")
    return read_archives(there.withColumn("name", name("path")).join(sized_broadcast(own)[0], "name"))


def round_trip(spark: SparkSession, pages: DataFrame, **columns) -> DataFrame:
    """Writes ``pages`` as archives into the shared folder and reads the records back."""
    root = scratch_path(spark, "warc")
    root = root if "://" in root or root.startswith("file:") else f"file://{root}"
    return read_written(spark, root, write_archives(pages, root, **columns))
