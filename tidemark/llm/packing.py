"""Best-fit packing of tokenised documents, planned on counts of lengths.

Documents are tokenised in tasks and cut into pieces. Of the pieces only the histogram of lengths, at
most ``capacity`` rows, goes to the driver. There best-fit-decreasing runs over counts: bins with equal
history are one group, so placing a length touches groups, not bins. The plan says which ranks of a
length go to which bins; pieces get a rank within their length (ranked in hashed parts, each started
from the parts before) and take their slot by joining on length and rank. Every bin's room at least
halves whenever pieces are added to it, so a plan has at most ``capacity * log2(capacity)`` times a
small constant rows, whatever the data, and may be broadcast.

A NULL text is empty; an empty document is its closing id alone. Only documents longer than the
capacity are cut. Repeated rows, also of one id, are packed each by itself; further columns are not
read. An empty table packs into no rows.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import byte_symbols
from tidemark.llm.spark import bound_batches, partitions, stored, whole

CAPACITY = 2048
END_ID = 0
#: Chunks and words a worker remembers; beyond them each is encoded when it is met.
CHUNK_LIMIT = 300_000
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLAN = "length long, from_rank long, to_rank long, each long, bin long, at long"
#: Text whose classes and lower case are the same in every Unicode version: printable Latin-1.
_SETTLED = re.compile("[!-~¡-¬®-ÿ]+")
#: The tokenizer's published word pattern, written out for lower-case Latin-1 (fixed value).
_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\\sa-zªµºß-öø-ÿ0-9²³¹¼-¾]+")
#: Separators to Python but not to the tokenizer; such texts are encoded whole.
_ODD = re.compile("[\x1c-\x1f]")


class ChunkEncoder:
    """Ids of texts by the tokenizers library, remembering the ids of chunks between white space.

    The tokenizer never joins across white space, so a text's ids are its chunks' ids in order.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()

        def by_library(text: str) -> bytes:
            ids = library.encode(text, add_special_tokens=False).ids
            return b"".join(i.to_bytes(4, "little") for i in ids)

        model, symbols = library.model, {b: c for c, b in byte_symbols().items()}

        def by_model(word: str) -> bytes:
            # a settled word needs no normalising or splitting, only its bytes as the model's symbols
            spelled = word if word.isascii() else word.encode().decode("latin-1").translate(symbols)
            return b"".join([t.id.to_bytes(4, "little") for t in model.tokenize(spelled)])

        class Known(dict):
            def __init__(self, make) -> None:
                self.make = make

            def __missing__(self, key: str) -> bytes:
                ids = self.make(key)
                if len(self) < CHUNK_LIMIT and len(key) < 64:
                    self[key] = ids
                return ids

        words = Known(by_model)

        def by_words(chunk: str) -> bytes:
            if _SETTLED.fullmatch(chunk) is None or "<|" in chunk:
                return by_library(chunk)
            return b"".join(map(words.__getitem__, _WORDS.findall(chunk.lower())))

        self.chunks, self.by_library = Known(by_words), by_library

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if _ODD.search(text):
            return self.by_library(text)
        return b"".join(map(self.chunks.__getitem__, text.split()))


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenise and cut: one row per piece, with the CRC-32 of its ids."""
    end, size = end_id.to_bytes(4, "little"), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = batch.column("text").to_pylist()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                ids = encoder(path).encode(text) + end
                for n, at in enumerate(range(0, len(ids), size)):
                    part = ids[at : at + size]
                    rows.append((doc_id, n, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    bound_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
    return source.mapInArrow(run, PIECE)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, ...]]:
    """Best-fit-decreasing over counts.

    Rows (length, from_rank, to_rank, each, bin, at): pieces of that length with ranks in
    [from_rank, to_rank) go ``each`` to a bin, from that bin number on, from place ``at`` in it.
    """
    groups: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    out, bins = [], 0

    def keep(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in groups:
                groups[room] = []
                bisect.insort(rooms, room)
            groups[room].append((first, count))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, count = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, first = capacity, bins
                count = -(-left // (capacity // length))
                bins += count
            each = room // length
            used = min(count, -(-left // each))
            taken = min(left, used * each)
            out.append((length, rank, rank + taken, each, first, capacity - room))
            full, rest = divmod(taken, each)
            keep(room - each * length, first, full)
            if rest:
                keep(room - rest * length, first + full, 1)
            keep(room, first + used, count - used)
            rank, left = rank + taken, left - taken
    return out


def ranked(cut: DataFrame, parts: int) -> DataFrame:
    """Number the pieces of each length from 0, in hashed parts of the length."""
    from pyspark.sql import Window

    order = ["doc_id", "piece", "ids_crc32"]
    cut = cut.withColumn("part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # at most capacity * parts rows
    offsets = cut.groupBy("length", "part").count().select(
        "length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier")
    )
    inside = Window.partitionBy("length", "part").orderBy(*order)
    return (
        cut.withColumn("rank", F.row_number().over(inside) - 1)
        .join(offsets, ["length", "part"])
        .withColumn("rank", F.col("rank") + F.col("earlier"))
        .drop("part", "earlier")
    )


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pack whole documents into few sequences: one row per piece with its sequence and place."""
    spark = docs.sparkSession
    cut = stored(pieces(docs, path, capacity, end_id), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    slots = spark.createDataFrame(plan(histogram, capacity), PLAN)
    numbered = ranked(cut, max(16, partitions(spark)))
    place = F.col("rank") - F.col("from_rank")
    return (
        numbered.join(
            F.broadcast(slots),
            (numbered["length"] == slots["length"])
            & (F.col("rank") >= F.col("from_rank"))
            & (F.col("rank") < F.col("to_rank")),
        )
        .select(
            "doc_id",
            "piece",
            "start",
            numbered["length"],
            "ids_crc32",
            (F.col("bin") + (place / F.col("each")).cast("long")).alias("sequence_id"),
            (F.col("at") + place % F.col("each") * numbered["length"]).alias("offset"),
        )
    )
