"""Removal of repeated runs of lines around boundaries that a rolling hash chooses.

Lines without words only separate. A run counts from two lines and ``MIN_WORDS`` words, or ``LONG_LINE`` words
passed. A rolling hash over two line hashes slides over a text; in every least run that counts, the place
where it is least is a boundary. That place depends on the run's own lines alone, so copies of a passage
have the same boundaries wherever they stand, and every run that counts holds one. A line of more than
``LONG_LINE`` words is a boundary by itself.

The lines at a boundary, with ``MIN_WORDS`` words on both sides, are its chunk. Boundaries are counted by a
128-bit hash of their own lines over the whole corpus. The first chunk (least doc_id, then place) of each
repeated hash stays; the others are matched with it line by line outwards from the boundary, by line hashes. What
is equal and counts as a run is joined with the document's other matches, and its text is compared byte by
byte with that of the chunk that stays; the lines of equal texts are removed. A line that is removed
has an equal one in an earlier place, which stays or has one in its turn.

Only hashes are shuffled to find what repeats, 64 bits of them at first; then texts move once, keyed by
document, and that exchange serves the comparison and the removal. Each line is compared with one text
at most, however many chunks it is in. A boundary that makes up much of the corpus is counted map-side first,
and its matches are a join that adaptive execution may split.

A NULL text is empty; texts of one short line are never changed; a text may become empty, its row stays.
Rows equal in id and text count as one document, all keep the same chunks. Repeats inside one text are
removed too. Further columns pass through (``n_chars`` is set anew if there); an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, islice

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.spark import bound_batches, stored, whole

MIN_LINES = 2
MIN_WORDS = 20
LONG_LINE = 50
BATCH_ROWS = 4_096
#: Bytes that tell a line of a chunk: a hash of it and the gap towards the boundary, and its words.
RECORD = 6
_WORD = (1 << 64) - 1
_FACTOR = 0x9E3779B97F4A7C15


def counts(lines: int, words: int) -> bool:
    """Whether a run is long enough to be removed."""
    return words > LONG_LINE or (lines >= MIN_LINES and words >= MIN_WORDS)


class Lines:
    """The lines of a text that have words: where they stand and how many words each has."""

    def __init__(self, text: str) -> None:
        self.all = text.split("\n")
        words = [len(line.split()) for line in self.all]
        self.places = [n for n, own in enumerate(words) if own]
        self.words = [own for own in words if own]
        self.upto = [0, *accumulate(self.words)]

    def text(self, first: int, count: int) -> str:
        """A run of lines with words (those there are), and what lies between them."""
        run = self.places[first : first + count]
        return "\n".join(self.all[run[0] : run[-1] + 1]) if run else ""

    def boundaries(self) -> list[tuple[int, int]]:
        """(first line, lines) of every boundary, in order."""
        size = len(self.words)
        hashes = [xxhash.xxh64_intdigest(self.all[n]) for n in self.places]
        rolled = [(a * _FACTOR + b) & _WORD for a, b in zip(hashes, hashes[1:])]
        found = {(n, 1) for n, own in enumerate(self.words) if own > LONG_LINE}

        def least(first: int, last: int) -> None:
            where = min(range(first, last), key=rolled.__getitem__)
            found.add((where, 2))

        # the shortest run that counts from each line, and to each line
        last = 0
        for first in range(size - 1):
            last = max(last, first + 1)
            while last < size and self.upto[last + 1] - self.upto[first] < MIN_WORDS:
                last += 1
            if last == size:
                break
            least(first, last)
        first = 0
        for last in range(1, size):
            while first + 1 < last and self.upto[last + 1] - self.upto[first + 1] >= MIN_WORDS:
                first += 1
            if self.upto[last + 1] - self.upto[first] >= MIN_WORDS:
                least(first, last)
        return sorted(found)

    def sides(self, first: int, count: int) -> tuple[bytes, bytes]:
        """Records of the lines before and after a boundary, outwards, until they have ``MIN_WORDS`` words."""
        left, right, words, n = [], [], 0, first
        while n > 0 and words < MIN_WORDS:
            left.append(self._record(n - 1, n))
            n -= 1
            words += self.words[n]
        words, n = 0, first + count - 1
        while n + 1 < len(self.words) and words < MIN_WORDS:
            right.append(self._record(n + 1, n))
            n += 1
            words += self.words[n]
        return b"".join(left), b"".join(right)

    def _record(self, line: int, inner: int) -> bytes:
        low, high = sorted((self.places[line], self.places[inner]))
        told = "\n".join([self.all[self.places[line]], *self.all[low + 1 : high]])
        return xxhash.xxh64_digest(told)[: RECORD - 1] + bytes([min(self.words[line], 255)])


def digest(lines: str) -> bytes:
    return xxhash.xxh3_128_digest(lines)


def chunks(text: str) -> Iterator[tuple[int, int, int, bytes, bytes, bytes]]:
    """Chunks of a text: the boundary's first line, its lines and words, its hash, the records of both sides."""
    lines = Lines(text)
    for first, count in lines.boundaries():
        words = sum(lines.words[first : first + count])
        yield first, count, words, digest(lines.text(first, count)), *lines.sides(first, count)


def grown(left: bytes, right: bytes, kept_left: bytes, kept_right: bytes) -> tuple[int, int, int]:
    """Equal lines before and after a boundary, and their words."""
    sizes, words = [], 0
    for own, other in ((left, kept_left), (right, kept_right)):
        size = 0
        while (part := own[size * RECORD : (size + 1) * RECORD]) and part == other[size * RECORD : (size + 1) * RECORD]:
            words += part[-1]
            size += 1
        sizes.append(size)
    return *sizes, words


def merged(matches: list[dict]) -> Iterator[tuple[int, int, bytes, int]]:
    """Matches (first, lines, kept_key, kept_first) of a text as pieces without common lines."""
    done, piece = 0, None
    for m in sorted(matches, key=lambda m: (m["first"], -m["lines"], m["kept_key"], m["kept_first"])):
        first, after = max(m["first"], done), m["first"] + m["lines"]
        if after <= first:
            continue
        kept = m["kept_first"] + first - m["first"]
        if piece and piece[2] == m["kept_key"] and (first, kept) == (piece[0] + piece[1], piece[3] + piece[1]):
            piece = (piece[0], after - piece[0], *piece[2:])
        else:
            if piece:
                yield piece
            piece = (first, after - first, m["kept_key"], kept)
        done = after
    if piece:
        yield piece


def without(text: str, cut: list[tuple[int, int]]) -> tuple[str, int]:
    """A text without runs (first line, lines) of lines with words, and how many lines went."""
    if not cut:
        return text, 0
    lines = Lines(text)
    gone = {n for first, count in cut for n in range(lines.places[first], lines.places[first + count - 1] + 1)}
    return "\n".join(line for n, line in enumerate(lines.all) if n not in gone), len(gone)


def _mapped(df: DataFrame, schema: str, kinds: list, rows) -> DataFrame:
    """Rows made from each input row (a function of a dict), batch by batch."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = (out for row in batch.to_pylist() for out in rows(row))
            while part := list(islice(made, BATCH_ROWS)):
                columns = zip(*part, strict=True)
                arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, schema)


def keyed(docs: DataFrame) -> DataFrame:
    """The table with a key of id and text, and NULL texts empty."""
    docs = docs.withColumn("text", whole("text"))
    told = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), "text")
    key = F.unhex(F.substring(F.sha2(told.cast("binary"), 256), 1, 32))
    # a key that cannot be NULL gets no filter before any join, so the joins share an exchange
    return docs.withColumn("__key", F.coalesce(key, F.lit(b"")))


def repeated(docs: DataFrame) -> DataFrame:
    """__key and pieces of the documents that hold repeated lines (``copy``) or those compared with them."""

    def places(row: dict) -> Iterator[tuple]:
        for first, count, words, hashed, left, right in chunks(row["text"]):
            yield row["__key"], row["doc_id"], first, count, words, hashed, left, right

    schema = "__key binary, doc_id long, first int, lines int, words int, hash binary, left binary, right binary"
    kinds = [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    own = docs.select("__key", F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = stored(_mapped(own, schema, kinds, places), "chunks")
    # repeated rows have equal places, so what repeats is in two of them
    short, where = F.xxhash64("hash").alias("short"), F.xxhash64("__key", "first").alias("where")
    twice = every.select(short, where).groupBy("short").agg(F.min("where").alias("a"), F.max("where").alias("b"))
    twice = twice.where("a <> b").select("short")
    found = stored(every.join(twice, F.xxhash64("hash") == F.col("short"), "left_semi"), "found")
    place = F.struct("doc_id", "__key", "first", "left", "right")
    often = found.groupBy("hash").agg(F.min(place).alias("keep"))
    other = F.struct("__key", "first") != F.struct("keep.__key", "keep.first")
    pairs = found.join(often, "hash").where(other)

    def matches(row: dict) -> Iterator[tuple]:
        keep = row["keep"]
        before, after, words = grown(row["left"], row["right"], keep["left"], keep["right"])
        lines = before + row["lines"] + after
        if counts(lines, words + row["words"]):
            yield row["__key"], row["first"] - before, lines, keep["__key"], keep["first"] - before

    schema = "__key binary, first int, lines int, kept_key binary, kept_first int"
    kinds = [pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.int32()]
    match = F.struct("first", "lines", "kept_key", "kept_first")
    by_copy = _mapped(pairs, schema, kinds, matches).groupBy("__key").agg(F.collect_set(match).alias("matches"))

    def pieces(row: dict) -> Iterator[tuple]:
        for piece in merged(row["matches"]):
            yield row["__key"], *piece

    copies = stored(_mapped(by_copy, schema, kinds, pieces), "pieces")
    keeps = copies.select(F.col("kept_key").alias("__key"), F.col("kept_first").alias("first"), "lines", "kept_key", "kept_first")
    both = copies.withColumn("copy", F.lit(True)).unionByName(keeps.distinct().withColumn("copy", F.lit(False)))
    piece = F.struct("first", "lines", "kept_key", "kept_first", "copy")
    return both.groupBy("__key").agg(F.collect_set(piece).alias("__pieces"))


def dedup(docs: DataFrame) -> DataFrame:
    """The table with repeated runs of lines removed from its texts, and ``removed_lines``."""
    bound_batches(docs.sparkSession)
    kept = [f for f in docs.schema if f.name != "removed_lines"]
    docs = keyed(docs.select(*(F.col(f"`{f.name}`") for f in kept)))
    held = stored(repeated(docs), "repeated")

    def texts(copy: bool):
        def rows(row: dict) -> Iterator[tuple]:
            lines = Lines(row["text"])
            for p in row["__pieces"]:
                if p["copy"] == copy:
                    text = lines.text(p["first"], p["lines"])
                    yield p["kept_key"], p["kept_first"], p["lines"], row["__key"], p["first"], text

        return rows

    kinds = [pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.string()]
    # no columns are pruned here, so all three uses of the keyed table share one exchange
    marked = docs.join(held, "__key")
    originals, others = (
        _mapped(marked, f"kept_key binary, kept_first int, lines int, __key binary, first int, {name} string", kinds, texts(c))
        for name, c in (("kept_text", False), ("own_text", True))
    )
    piece = ["kept_key", "kept_first", "lines"]
    originals = originals.select(*piece, "kept_text").dropDuplicates(piece)
    equal = others.join(originals, piece).where(F.col("own_text") == F.col("kept_text"))
    cuts = equal.groupBy("__key").agg(F.collect_set(F.struct("first", "lines")).alias("__cuts"))

    names = [f.name for f in kept]
    schema = T.StructType([*kept, T.StructField("removed_lines", T.LongType())])
    resized = "n_chars" in names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources, found = (batch.column(n).to_pylist() for n in ("text", "__cuts"))
            cut = [[(c["first"], c["lines"]) for c in one or ()] for one in found]
            made, gone = zip(*map(without, sources, cut), strict=True) if sources else ((), ())
            columns = {n: batch.column(n) for n in names}
            columns["text"] = pa.array(made, pa.string())
            if resized:
                columns["n_chars"] = pa.array(map(len, made), pa.int64()).cast(batch.schema.field("n_chars").type)
            columns["removed_lines"] = pa.array(gone, pa.int64())
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return docs.join(cuts, "__key", "left").mapInArrow(run, schema)
