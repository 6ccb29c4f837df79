"""WARC archives of pages: writing, and reading back with segment reassembly.

Writing: each page is a record whose payload is its HTML in UTF-8. Of the pages with one payload that
with the largest page_id is a ``response``, the others are ``revisit`` records that refer to it and
carry no payload. A response is an HTTP message in chunked transfer framing; one longer than
``SEGMENT_BYTES`` is cut into a first record and ``continuation`` records that name its id as origin,
count their segment numbers from 1, and give the total length in the last one. Archives are gzip
files of at most ``RECORDS_PER_FILE`` records, so a file unpacks to a bounded size.

Reading: files are parsed record by record by their Content-Length. Whole records pass on; segments
are grouped by origin id, ordered by number, checked against gaps and the total length, joined, and
taken out of the chunked framing. Payload length and digest come from the bytes read; a revisit takes
them from the record that it refers to.

A NULL html is an empty payload. Repeated rows are records of their own: rows with the largest page_id
are all responses. NULL page_ids and urls are written as such; among equal payloads a NULL id is the
smallest. Segments whose numbers, total or framing do not agree come back with ``complete`` false and
no payload. Further columns are not read; an empty table gives an empty archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.spark import bound_batches
from tidemark.session import run_dir

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
RECORDS_PER_FILE = 1_000
#: The date is a parameter of the writer, so that equal tables make equal archives.
DATE = "2020-01-01T00:00:00Z"
_HTTP = (
    b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes) -> bytes:
    """A payload in chunked transfer framing."""
    out = []
    for at in range(0, len(payload), CHUNK_BYTES):
        part = payload[at : at + CHUNK_BYTES]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes | None:
    """The payload of a chunked body, or None if its framing is broken."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            return None
        try:
            size = int(body[at:line].split(b";")[0].strip(), 16)
        except ValueError:
            return None
        begin, at = line + 2, line + 2 + size + 2
        if size < 0 or body[at - 2 : at] != b"\r\n" and size:
            return None
        if not size:
            return b"".join(out)
        out.append(body[begin : begin + size])


def _line(value: str) -> str:
    """A header value on one line; percent signs, control characters and blanks at its ends are coded."""
    if value.isprintable() and "%" not in value and value == value.strip():
        return value
    coded = "".join(
        "".join(f"%{b:02X}" for b in c.encode()) if c == "%" or not c.isprintable() or c == " " else c
        for c in value
    )
    return coded


def _unline(value: str) -> str:
    out, at = [], 0
    raw = value.encode()
    while at < len(raw):
        if raw[at] == 37:
            out.append(int(raw[at + 1 : at + 3], 16))
            at += 3
        else:
            out.append(raw[at])
            at += 1
    return bytes(out).decode()


def record(headers: dict[str, str | None], block: bytes) -> bytes:
    """One record without its last line feed, which the file writer adds."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items() if v is not None)]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode()
    return head + block + b"\r\n\r"


def page_records(
    name: str, page_id: int | None, url: str | None, payload: bytes, refers_to: str | None
) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response with its continuations."""
    common = {
        "WARC-Record-ID": name,
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else _line(url),
        "X-Page-ID": None if page_id is None else str(page_id),
        "WARC-Payload-Digest": "sha1:" + payload_digest(payload),
    }
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        extra = {"WARC-Type": "revisit", "WARC-Profile": profile, "WARC-Refers-To": refers_to}
        yield record(extra | common, b"")
        return
    block = _HTTP + chunked(payload)
    parts = [block[at : at + SEGMENT_BYTES] for at in range(0, len(block), SEGMENT_BYTES)]
    kind = {"WARC-Type": "response", "Content-Type": "application/http; msgtype=response"}
    if len(parts) > 1:
        kind["WARC-Segment-Number"] = "1"
    yield record(kind | common, parts[0])
    for number, part in enumerate(parts[1:], 2):
        yield record(
            {
                "WARC-Type": "continuation",
                "WARC-Record-ID": f"{name[:-1]}:{number}>",
                "WARC-Date": DATE,
                "WARC-Segment-Origin-ID": name,
                "WARC-Segment-Number": str(number),
                "WARC-Segment-Total-Length": str(len(block)) if number == len(parts) else None,
            },
            part,
        )


def name_of(page_id):
    """The record id of the first row of a page: what revisits refer to."""
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def write_archive(pages: DataFrame, path: str) -> None:
    """Write a page table as gzip WARC files into a folder."""
    bound_batches(pages.sparkSession)
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("digest", F.unhex(F.sha1(F.col("html").cast("binary"))))
    first = pages.groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("rows"))
    shared = first.where("rows > 1").drop("rows")
    marked = pages.join(shared, "digest", "left").select(
        "page_id",
        "url",
        "html",
        F.when(
            F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")),
            name_of(F.col("first")),
        ).alias("refers_to"),
        F.monotonically_increasing_id().alias("row"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                page = "none" if row["page_id"] is None else row["page_id"]
                name = f"<urn:x-page:{page}:{row['row']}>"
                payload = row["html"].encode()
                made += page_records(name, row["page_id"], row["url"], payload, row["refers_to"])
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["record"])

    # the text writer puts a string's bytes out as they are; its line feed ends the record
    marked.mapInArrow(run, "record binary").select(F.col("record").cast("string")).write.option(
        "maxRecordsPerFile", RECORDS_PER_FILE
    ).option("compression", "gzip").text(path)


def parse(data: bytes) -> Iterator[dict]:
    """Records of one archive file, gzip or plain, one at a time."""
    buffer, at = b"", 0
    source = _unpacked(data)
    while True:
        while (end := buffer.find(b"\r\n\r\n", at)) < 0:
            more = next(source, None)
            if more is None:
                if buffer[at:].strip():
                    raise ValueError("an archive ends inside a record")
                return
            buffer, at = buffer[at:] + more, 0
        headers = _headers(buffer[at:end].decode(errors="replace").lstrip("\r\n"))
        begin, size = end + 4, int(headers["Content-Length"])
        while len(buffer) < begin + size + 4:
            more = next(source, None)
            if more is None:
                raise ValueError("an archive ends inside a record")
            buffer += more
        yield {"headers": headers, "block": buffer[begin : begin + size]}
        at = begin + size + 4


#: The names that are read, by their lower-case form: names of headers have no case.
NAMES = {
    name.lower(): name
    for name in (
        "Content-Length WARC-Record-ID WARC-Type WARC-Target-URI WARC-Refers-To WARC-Payload-Digest X-Page-ID"
        " WARC-Segment-Number WARC-Segment-Origin-ID WARC-Segment-Total-Length"
    ).split()
}


def _headers(head: str) -> dict[str, str]:
    """Headers of a record; values may be empty, and go on in lines that begin with white space."""
    out: dict[str, str] = {}
    last = ""
    for line in head.split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] = f"{out[last]} {line.strip()}".strip()
            continue
        name, _, value = line.partition(":")
        last = NAMES.get(name.strip().lower(), name.strip())
        out[last] = value.strip(" \t")
    return out


def _unpacked(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    if data[:2] != b"\x1f\x8b":
        yield from (data[at : at + step] for at in range(0, len(data), step))
        return
    while data:
        stream = zlib.decompressobj(31)
        rest = data
        while rest and not stream.eof:
            yield stream.decompress(rest, step)
            rest = stream.unconsumed_tail
        if not stream.eof:
            raise ValueError("an archive's gzip member is cut short")
        data = stream.unused_data


def reassemble(parts: list[tuple[int, bytes]], total: int | None) -> bytes | None:
    """The block of a segmented record, or None if a number or the total does not fit."""
    parts = sorted(parts)
    block = b"".join(part for _, part in parts)
    whole = [number for number, _ in parts] == list(range(1, len(parts) + 1))
    return block if whole and len(block) == total else None


def payload_of(block: bytes | None) -> bytes | None:
    """The payload of an HTTP response, out of its chunked framing if it has one."""
    head = -1 if block is None else block.find(b"\r\n\r\n")
    if head < 0:
        return None
    body = block[head + 4 :]
    return dechunked(body) if b"transfer-encoding: chunked" in block[:head].lower() else body


def _rows(item: dict) -> tuple:
    head = item["headers"]
    page_id, url = head.get("X-Page-ID"), head.get("WARC-Target-URI")
    refers = head.get("WARC-Refers-To", "").removeprefix("<urn:x-page:").removesuffix(">")
    return (
        head["WARC-Record-ID"],
        head["WARC-Type"],
        None if page_id is None else int(page_id),
        _unline(url) if url is not None and "%" in url else url,
        int(refers) if refers not in ("", "none") else None,
        head.get("WARC-Payload-Digest", "").removeprefix("sha1:"),
    )


def _batches(rows: Iterator[tuple], names: list[str], kinds: list) -> Iterator[pa.RecordBatch]:
    """Batches of rows whose last value is bytes, bounded by those bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 1024 + len(row[-1] or b"")
        if size > 4 << 20:
            yield _batch(held, names, kinds)
            held, size = [], 0
    if held:
        yield _batch(held, names, kinds)


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


_HEAD = "record_id string, record_type string, page_id long, url string, refers_to long, named_digest string"
_KINDS = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]


def _read(files: DataFrame, schema: str, kinds: list, rows) -> DataFrame:
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                yield from _batches(rows(content.as_py()), names, kinds)

    return files.mapInArrow(run, schema)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Pages of the archives in a folder: page_id, url, record_type, refers_to (a page_id), complete,
    payload (NULL for revisits), and payload_bytes and payload_digest of the full payload."""
    bound_batches(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    files = files.select("content")

    def finished(keep_payload: bool):
        def rows(data: bytes) -> Iterator[tuple]:
            for item in parse(data):
                head = item["headers"]
                if head["WARC-Type"] == "response" and "WARC-Segment-Number" not in head:
                    told = _told(payload_of(item["block"]))
                    yield (*_rows(item), *told[:3], told[3] if keep_payload else None)

        return rows

    def revisited(data: bytes) -> Iterator[tuple]:
        for item in parse(data):
            if item["headers"]["WARC-Type"] == "revisit":
                yield (*_rows(item), None, None, None, None)

    def segments(data: bytes) -> Iterator[tuple]:
        for item in parse(data):
            head = item["headers"]
            if head["WARC-Type"] in ("response", "continuation") and "WARC-Segment-Number" in head:
                total = head.get("WARC-Segment-Total-Length")
                origin = head.get("WARC-Segment-Origin-ID", head["WARC-Record-ID"])
                yield (
                    *_rows(item),
                    origin,
                    int(head["WARC-Segment-Number"]),
                    None if total is None else int(total),
                    item["block"],
                )

    told = "complete boolean, payload_bytes long, payload_digest string, payload binary"
    told_kinds = [pa.bool_(), pa.int64(), pa.string(), pa.binary()]
    # each reading takes out of a file only what it is for
    whole, sizes, revisits = (
        _read(files, f"{_HEAD}, {told}", _KINDS + told_kinds, rows)
        for rows in (finished(True), finished(False), revisited)
    )
    part_kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary()]
    parts = _read(
        files, f"{_HEAD}, origin string, segment int, total long, block binary", _KINDS + part_kinds, segments
    )
    first = F.when(F.col("segment") == 1, F.struct("record_type", "page_id", "url", "refers_to", "named_digest"))
    grouped = parts.groupBy("origin").agg(
        F.max(first).alias("head"),
        F.collect_list(F.struct("segment", "block")).alias("parts"),
        F.max("total").alias("total"),
    )
    grouped = grouped.select(F.col("origin").alias("record_id"), "head.*", "parts", "total")

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [batch.column(n) for n in batch.schema.names[:6]]
            for n, row in enumerate(batch.select(["parts", "total"]).to_pylist()):
                own = [(p["segment"], p["block"]) for p in row["parts"]]
                made = _told(payload_of(reassemble(own, row["total"])))
                yield pa.RecordBatch.from_arrays(
                    [c.slice(n, 1) for c in kept]
                    + [pa.array([v], k) for v, k in zip(made, told_kinds, strict=True)],
                    names=[part.split()[0] for part in f"{_HEAD}, {told}".split(", ")],
                )

    joined = grouped.mapInArrow(join_up, f"{_HEAD}, {told}")
    known = (
        sizes.unionAll(joined)
        .where("complete")
        .groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("named_digest"))
        .agg(F.max("payload_bytes").alias("known_bytes"))
    )
    full = ["page_id", "url", "record_type", "refers_to", "complete"]
    revisits = revisits.drop("payload_digest").join(known, ["refers_to", "named_digest"], "left")
    return whole.unionAll(joined).select(
        *full, "payload", "payload_bytes", "payload_digest"
    ).unionAll(
        revisits.withColumn("complete", F.col("known_bytes").isNotNull()).select(
            *full,
            "payload",
            F.col("known_bytes").alias("payload_bytes"),
            F.col("named_digest").alias("payload_digest"),
        )
    )


def _told(payload: bytes | None) -> tuple:
    if payload is None:
        return False, None, None, None
    return True, len(payload), payload_digest(payload), payload


def archive(pages: DataFrame) -> str:
    """Write the pages into a fresh folder of the shared one, and name it."""
    path = run_dir(pages.sparkSession, "warc")
    write_archive(pages, path)
    return path
