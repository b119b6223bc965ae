"""Archives written and read back."""

from __future__ import annotations

import hashlib
import io
import struct
from collections import Counter

import zstandard

from tidewell.llm import warc_archive

PAGES = "page_id long, url string, html string, digest string, refers_to string"


def plain(rows):
    first = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if page_id is not None and len(data) >= 100:
            first[data] = min(first.get(data, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        refers = first.get(data)
        refers = None if refers == page_id else refers
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=repr)


def ours(df):
    rows = warc_archive.read_archives(warc_archive.write_archives(df)).collect()
    for row in rows:
        assert (row.payload is None) == (row.record_type == "revisit")
        assert row.payload is None or hashlib.sha256(row.payload).hexdigest() == row.payload_digest
    return sorted((tuple(row)[:5] for row in rows), key=repr)


def test_pages(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert ours(df) == plain([tuple(row) for row in df.select("page_id", "url", "html").collect()])


def test_awkward_rows(spark):
    page = "<p>é" + "x" * 200
    rows = [
        (5, "http://a/1", page), (3, "http://a/2", page), (3, "http://a/2", page), (9, None, page), (None, "http://a/3", page),
        (1, "http://a/4", None), (2, "http://a/4", ""), (4, "http://a/ \r\n5", "small"), (6, "http://é/", "small"),
        (7, "u", "WARC/1.1\r\n\r\n" * 20), (8, "u", "y" * 3_000_000), (None, "u", "z" * 150), (None, "u", "z" * 150),
        (10, "u", "\r\n\r\n" + "HTTP/1.1 \r\nContent-Length: 7\r\n" * 9),
    ]
    df = spark.createDataFrame([(*row, "c", "c") for row in rows], PAGES)
    assert ours(df) == plain(rows)
    assert ours(df.where("false")) == []


def test_one_page_held_by_a_third_of_the_rows(spark):
    rows = [(i, f"http://a/{i}", ("hot " * 40) if i % 3 == 0 else f"page {i} " * 20) for i in range(900)]
    found = ours(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert found == plain(rows) and Counter(row[3] for row in found) == {"response": 601, "revisit": 299}


def test_dictionary_stands_in_a_skippable_frame_and_records_in_frames_of_their_own(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    manifest = warc_archive.write_archives(df).collect()
    assert sum(row.records for row in manifest) == df.count()
    data = open(manifest[0].path.removeprefix("file://"), "rb").read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc_archive.DICTIONARY_FRAME and size > 1000
    dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    rest, frames = data[8 + size :], 0
    while rest:
        reader = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        assert reader.decompress(rest).startswith(b"WARC/1.1\r\nWARC-Type: ")
        rest, frames = reader.unused_data, frames + 1
    assert frames == manifest[0].records
    records = [block for _, block in warc_archive.read_archive(io.BytesIO(data))]
    bare = sum(len(zstandard.ZstdCompressor(level=3).compress(block)) for block in records)
    assert len(data) - size < bare  # the dictionary helps


def test_dictionary_is_built_from_records_as_stored(spark, monkeypatch):
    """A payload that a third of the rows share is in the sample once at most; its other rows are revisits there."""
    rows = [(i, f"http://a/{i}", ("hot " * 40) if i % 3 == 0 else f"page {i} " * 20) for i in range(900)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    given = []
    monkeypatch.setattr(warc_archive.zstandard, "train_dictionary", lambda size, records: given.extend(records) or zstandard.ZstdCompressionDict(b""))
    warc_archive.build_dictionary(df)
    roles = {row.page_id: row for row in warc_archive.with_roles(df).collect()}
    stored = {warc_archive.record(x.page_id, x.url, x.html.encode(), x.digest, x.refers_to) for x in roles.values()}
    assert len(given) == warc_archive.SAMPLE_ROWS and stored.issuperset(given)
    revisits = [x for x in given if b"WARC-Type: revisit" in x]
    assert len(revisits) > 80 and sum(b"hot hot" in x for x in given) <= 1
