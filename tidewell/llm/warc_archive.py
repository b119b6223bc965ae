"""WARC archives compressed record by record with a Zstandard dictionary.

The dictionary is built from records of the archive as they are stored, responses with payload and revisits without (those of
:data:`SAMPLE_ROWS` pages with the smallest hash of their id and URL, of at most :data:`SAMPLE_BYTES` bytes) and stands in a skippable frame at the head of every file, so each file can be read on its own. Every
record is a frame of its own: any record can be read from its offset with the dictionary alone.

Records with equal payloads of at least :data:`LEAST_BYTES` bytes are stored once: that of the smallest ``page_id`` is the response, the others
are revisits that name it. Payloads are grouped by digest, with counts combined before the shuffle; adaptive execution splits a
digest that very many pages share, and only one narrow row of it is on the other side.

Tasks write files under names of their own and hand on one row a file, which Spark writes; files of lost or repeated tasks are
never read.

Defined results: a null html is an empty payload. Null ids are ordered last; if no page of a group has an id all its pages are responses.
Rows that repeat the smallest id and its payload are responses each. A null URL is written as ``about:blank``; control characters and blanks in URLs
are percent-encoded in headers. Other columns are ignored, whatever their names. An empty table gives no records.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.files import create, locate, new_folder
from tidewell.session import materialize

LEAST_BYTES = 100
SAMPLE_ROWS = 400
SAMPLE_BYTES = 1 << 17
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
#: The skippable frame that holds the dictionary of a WARC file.
DICTIONARY_FRAME = 0x184D2A5D
_URL_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response with the payload, or a revisit with its HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    target = _URL_UNSAFE.sub(lambda x: f"%{ord(x[0]):02X}", url) if url else "about:blank"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(refers_to)),
            ("X-Refers-To-Page", str(refers_to)),
        ]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def with_digests(pages: DataFrame) -> DataFrame:
    html = F.coalesce(pages["html"].cast("string"), F.lit(""))
    return pages.select(
        pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest"),
        F.octet_length(html).alias("payload_bytes"),
    )


def with_roles(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``html``, ``digest``, ``payload_bytes`` and ``refers_to`` (null for responses)."""
    rows = with_digests(pages)
    repeated = rows.where(F.col("payload_bytes") >= LEAST_BYTES).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("pages"))
    known = rows.join(repeated.where("pages > 1").select("digest", "first_id"), "digest", "left")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to")
    return known.select("page_id", "url", "html", "digest", "payload_bytes", refers_to)


def sample_records(pages: DataFrame) -> list[bytes]:
    """Some records, as they are stored. Payloads are read for them alone; the rows that are shuffled for their roles have none."""
    place = F.xxhash64("page_id", "url").alias("place")
    rows = with_roles(pages).where(F.col("payload_bytes") <= SAMPLE_BYTES).select(place, "page_id", "url", "digest", "refers_to")
    chosen = rows.orderBy("place", "page_id", "url", "digest").limit(SAMPLE_ROWS).toArrow().to_pylist()
    if not chosen:
        return []
    same = with_digests(pages).select("html", "digest", place)
    same = same.where(F.col("place").isin([x["place"] for x in chosen]) & F.col("digest").isin([x["digest"] for x in chosen]))
    html = same.groupBy("digest").agg(F.first("html").alias("html")).toArrow().to_pylist()  # 50 MB at most
    payloads = {x["digest"]: x["html"].encode() for x in html}
    return [record(x["page_id"], x["url"], payloads[x["digest"]], x["digest"], x["refers_to"]) for x in chosen]


def build_dictionary(pages: DataFrame) -> bytes:
    """A dictionary of some records; empty if there are too few to build one."""
    records = sample_records(pages)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records).as_bytes()
    except zstandard.ZstdError:
        return b""


class ArchiveWriter:
    def __init__(self, stream, dictionary: bytes) -> None:
        self.stream, self.records = stream, 0
        if dictionary:
            stream.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
        loaded = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=loaded)

    def add(self, data: bytes) -> None:
        self.stream.write(self.compressor.compress(data))
        self.records += 1


def read_archive(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an open file."""
    head = stream.read(8)
    loaded = None
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_FRAME:
        loaded, head = zstandard.ZstdCompressionDict(stream.read(struct.unpack("<I", head[4:])[0])), b""
    source = _After(head, stream)
    text = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=loaded).stream_reader(source, read_across_frames=True), 1 << 18)
    while line := text.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"a record was expected, not {line[:40]!r}")
        fields = {}
        while (line := text.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            fields[name.strip()] = value.strip()
        block = text.read(int(fields["Content-Length"]))
        if text.read(4) != b"\r\n\r\n":
            raise ValueError("a record has no end")
        yield fields, block


class _After:
    """A stream that begins with bytes already read."""

    def __init__(self, head: bytes, stream) -> None:
        self.head, self.stream = head, stream

    def read(self, size: int = -1) -> bytes:
        if self.head:
            head, self.head = self.head, b""
            return head
        return self.stream.read(size)


def write_archives(pages: DataFrame) -> DataFrame:
    """Write all pages; one row a file: ``path`` and ``records``."""
    folder = new_folder(pages.sparkSession, "warc")
    dictionary = build_dictionary(pages)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = path = None
        for batch in batches:
            columns = [batch.column(x).to_pylist() for x in ("page_id", "url", "html", "digest", "refers_to")]
            for page_id, url, html, digest, refers_to in zip(*columns, strict=True):
                if writer is None:
                    path, stream = create(folder, f"part-{TaskContext.get().partitionId():06d}.warc.zst")
                    writer = ArchiveWriter(stream, dictionary)
                writer.add(record(page_id, url, html.encode(), digest, refers_to))
        if writer:
            writer.stream.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([writer.records])], ["path", "records"])

    return materialize(with_roles(pages).drop("payload_bytes").mapInArrow(task, "path string, records long"), "manifest")


ROWS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, payload binary"


def read_archives(manifest: DataFrame) -> DataFrame:
    """Each record of the files; ``payload`` is null for revisits, whose length and digest are those of the full payload."""
    names = [x.strip().split(" ")[0] for x in ROWS.split(",")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def rows_of(uri: str) -> Iterator[tuple]:
        system, path = locate(uri)
        with system.open_input_stream(path) as stream:
            for fields, block in read_archive(stream):
                head, _, payload = block.partition(b"\r\n\r\n")
                page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page")
                digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                length = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
                kind = fields["WARC-Type"]
                if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
                    raise ValueError(f"the payload of page {page} differs from its digest")
                yield (
                    int(page) if page else None,
                    length,
                    digest,
                    kind,
                    int(refers) if refers else None,
                    fields["WARC-Target-URI"],
                    payload if kind == "response" else None,
                )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                held, size = [], 0
                for row in rows_of(uri):
                    held.append(row)
                    size += len(row[-1] or b"")
                    if size > 1 << 22:
                        yield as_batch(held)
                        held, size = [], 0
                if held:
                    yield as_batch(held)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    files = max(1, manifest.count())
    return manifest.select("path").repartitionByRange(files, "path").mapInArrow(task, ROWS)
