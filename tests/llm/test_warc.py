"""Archives: exact round trips, segments, framing, and what happens to broken ones."""

import base64
import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, warc
from tidemark.session import run_dir

SCHEMA = "page_id long, url string, html string"


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def expected(rows):
    largest = {}
    for page_id, _, html in rows:
        key = html or ""
        known = largest.get(key, page_id)
        largest[key] = page_id if known is None else known if page_id is None else max(known, page_id)
    out = []
    for page_id, url, html in rows:
        text, top = html or "", largest[html or ""]
        response = page_id == top
        out.append((page_id, url, "response" if response else "revisit", None if response else top,
                    len(text.encode()), digest(text)))
    return sorted(out, key=str)


def read(df):
    kept = df.select("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest")
    return sorted((tuple(r) for r in kept.collect()), key=str)


ROWS = [
    (1, "http://a/x", "<p>one</p>"), (2, "http://a/y", "<p>one</p>"), (3, None, None), (4, "http://b/", ""),
    (5, "u\r\nX: 1 %41 é", "WARC/1.1\r\n\r\n\r\nWARC-Type: response\r\n\r\n0\r\n\r\n"),
    (6, "http://c/", "é中\U0001f600" * 30_000), (7, "http://c/2", "é中\U0001f600" * 30_000),
    (8, "", "x" * warc.SEGMENT_BYTES), (9, " blank ", "\n" * 100), (None, "http://d/", "only"),
    (10, "http://e/", "twice"), (10, "http://e/", "twice"), (None, "http://f/", "<p>one</p>"),
]


def test_round_trip(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA).withColumns(
        {c: F.lit(1) for c in ("digest", "first", "row", "segment", "block", "origin")}
    )
    found = warc.read_archive(spark, warc.archive(pages))
    assert read(found) == expected(ROWS)
    payloads = {r.page_id: bytes(r.payload).decode() for r in found.collect() if r.payload is not None}
    assert payloads[6 + 1] == "é中\U0001f600" * 30_000
    assert payloads[5] == ROWS[4][2]


def test_empty_table(spark):
    pages = spark.createDataFrame([], SCHEMA)
    assert warc.read_archive(spark, warc.archive(pages)).count() == 0


@pytest.mark.parametrize("size", [0, 1, 8191, 8192, 8193, 20_000])
def test_chunked_framing(size):
    payload = os.urandom(size)
    assert warc.dechunked(warc.chunked(payload)) == payload


@pytest.mark.parametrize("body", [b"", b"5\r\nabc", b"zz\r\n", b"3\r\nabcX\r\n0\r\n\r\n", b"-1\r\n"])
def test_broken_framing(body):
    assert warc.dechunked(body) is None


def test_foreign_framing():
    assert warc.dechunked(b"3;name=value\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"


def segments():
    payload = bytes(range(256)) * 400
    return payload, [r + b"\n" for r in warc.page_records("<urn:x-page:1:0>", 1, "u", payload, None)]


def archived(spark, records):
    folder = run_dir(spark, "foreign")
    os.makedirs(folder)
    # one file per record, the later ones first, each its own gzip member or two
    for n, record in enumerate(reversed(records)):
        with open(f"{folder}/{n}.warc.gz", "wb") as file:
            file.write(gzip.compress(record[:40]) + gzip.compress(record[40:]))
    return warc.read_archive(spark, folder).collect()


def test_segments_of_several_files(spark):
    payload, records = segments()
    assert len(records) == 4
    (page,) = archived(spark, records)
    assert page.complete and bytes(page.payload) == payload


def test_a_lost_segment_or_a_wrong_total(spark):
    _, records = segments()
    (page,) = archived(spark, [*records[:1], *records[2:]])
    assert not page.complete and page.payload is None
    wrong = records[-1].replace(b"Total-Length: 1", b"Total-Length: 9")
    (page,) = archived(spark, [*records[:-1], wrong])
    assert not page.complete
    (page,) = archived(spark, records[:-1])
    assert not page.complete


def test_a_cut_archive_fails(spark):
    with pytest.raises(ValueError):
        list(warc.parse(gzip.compress(segments()[1][0][:-9])))
    with pytest.raises(ValueError):
        list(warc.parse(gzip.compress(segments()[1][0])[:-20]))


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect()
    told = sorted((p, b, d, k, r) for p, _, k, r, b, d in expected([tuple(p) for p in pages]))
    assert sorted(tuple(r) for r in queries.warc_query(spark, folder).collect()) == told


def test_headers_of_foreign_archives():
    record = (
        b"WARC/1.0\r\nwarc-type: response\r\nWARC-Filename:\r\nWARC-RECORD-ID:<urn:1>\r\n"
        b"WARC-Target-URI: http://a/\r\n b\r\ncontent-length: 3\r\n\r\nabc\r\n\r\n"
    )
    (first, second) = warc.parse(record * 2)
    assert first == second and first["block"] == b"abc"
    assert first["headers"] == {
        "WARC-Type": "response", "WARC-Filename": "", "WARC-Record-ID": "<urn:1>",
        "WARC-Target-URI": "http://a/ b", "Content-Length": "3",
    }
