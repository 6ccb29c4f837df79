"""Near-duplicate classes by BagMinHash signatures, banding and verified multiset overlap.

A text's bag holds its runs of five words with their counts. Two texts are linked if the sum of the
smaller counts is at least 0.8 of the sum of the larger ones; a class is a connected component of links.

Signatures: the counts of a term fill the unit steps from 0 up, and steps are grouped into the intervals
[0, 1), [1, 2), [2, 4), [4, 8), ... Each interval of a term is a Poisson process over all registers, with
its length as rate, made from the term's hash in ascending time; a point's place in its interval is found
by successive halving (the leading bits of its hash), and points above the term's count are left out. So a
larger count only adds points, and two registers agree with the probability of the weighted Jaccard
similarity. Points are made up to the time by which every register is expected to be filled, and beyond
it only if one is not; most terms of a long text have none, so cost per term is about one hash.

Candidates: signatures are cut into 32 bands of four registers; a pair at 0.8 meets in a band except with
probability 5e-8. Inside a bucket, nodes are linked whose 128 registers agree in ``AGREEMENT`` or more, seven
standard deviations under 0.8, so texts that share boilerplate and a band by chance stay apart. Such links,
directly or through others, form a family. A family is dealt into blocks of bounded size, and each pair of
blocks is one group of a task: an index over one block's terms gives the exact overlap with each text of the
other in one pass, and only the links that join parts of the group are put out. So every pair of a family
is compared on whole texts, no pair is a row, and a family of any size is spread over many groups; its
cost grows with the square of its size, as exact comparison of texts near the bar must. Buckets are dealt into
blocks in the same way, with a byte for each register in place of the text.

Equal texts are one node throughout. Texts without words are one class. NULL texts are empty. The class
id is the least doc_id of the class (NULL only if all are); repeated rows stay, each with its class;
further columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.spark import bound_batches, stored, whole
from tidemark.llm.text import bag, mix, shingles, word_blocks

REGISTERS = 128
BAND = 4
SIMILARITY = 0.8
#: Share of equal registers from which nodes of a bucket are surely linked; nodes within ``RADIUS`` of one that
#: was compared with all are not compared again: what is near them was linked to it at ``AGREEMENT - RADIUS``.
AGREEMENT, RADIUS = 0.55, 0.1
BUCKET_NODES = 4096
#: Nodes and bytes of text that one block of a family holds.
BLOCK_NODES = 1024
BLOCK_BYTES = 4 << 20
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_PLACE = _U(0xD1B54A32D192ED03)


def _unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1)."""
    return ((x >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53


def sketch(terms: np.ndarray, counts: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The name of the first point in each register; ``terms`` must not be empty."""
    seeds, lows, limits = [terms], [np.zeros(len(terms), np.int64)], [counts]
    low = 1
    while (above := counts > low).any():
        seeds.append(mix(terms[above] + _U(low * int(_PLACE) % (1 << 64))))
        lows.append(np.full(above.sum(), low))
        limits.append(counts[above])
        low *= 2
    seed, low, limit = np.concatenate(seeds), np.concatenate(lows), np.concatenate(limits)
    length = np.maximum(low, 1)
    rate = registers * length.astype(np.float64)
    horizon = (np.log(registers) + 2) / counts.sum()
    first = -np.log(_unit(mix(seed + _STEP))) / rate
    while True:
        live = np.flatnonzero(first <= horizon)
        names, register, time = _points(seed[live], low[live], length[live], limit[live], rate[live], horizon, registers)
        order = np.argsort(-time, kind="stable")
        out, filled = np.zeros(registers, np.uint64), np.zeros(registers, bool)
        out[register[order]] = names[order]
        filled[register] = True
        if filled.all():
            return out
        horizon *= 2


def _points(seed, low, length, limit, rate, horizon, registers):
    """Names, registers and times of the points up to the horizon."""
    expected = rate.max(initial=1.0) * horizon
    many = int(expected + 4 * expected**0.5 + 8)
    while True:
        steps = np.arange(1, many + 1, dtype=np.uint64) * _STEP
        made = mix(seed[:, None] + steps)
        time = np.cumsum(-np.log(_unit(made)), axis=1) / rate[:, None]
        if not len(seed) or time[:, -1].min() > horizon:
            break
        many *= 2
    row, column = np.nonzero(time <= horizon)
    name = mix(made[row, column] ^ _PLACE)
    place = low[row] + length[row] * _unit(mix(name + _PLACE))
    inside = np.floor(place) < limit[row]
    name = name[inside]
    return name, (name % _U(registers)).astype(np.int64), time[row, column][inside]


def bands(signature: np.ndarray, band: int = BAND) -> np.ndarray:
    """One hash per band of registers, different between bands."""
    rows = signature.reshape(-1, band)
    out = np.arange(len(rows), dtype=np.uint64)
    for column in rows.T:
        out = mix(out * _STEP + column)
    return out


def bags(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The bag of each text of a column."""
    for block in word_blocks(texts):
        hashes, bounds = shingles(block)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield bag(hashes[a:b])


def with_node_column() -> Column:
    """16 bytes of the text's SHA-256, one value for all texts without words."""
    text = whole("text")
    digest = F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32))
    wordless = ~text.rlike(r"[^\t\n\x0b\f\r\x1c-\x20]")
    return F.when(wordless, F.lit(b"\0" * 16)).otherwise(digest)


def with_node(docs: DataFrame) -> DataFrame:
    """doc_id, text, node."""
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(doc_id, whole("text").alias("text"), with_node_column().alias("node"))


def signatures(docs: DataFrame) -> DataFrame:
    """node, keys (one per band) and marks (a byte per register) of every row with words, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, marks = [], []
            for terms, counts in bags(batch.column("text")):
                made = sketch(terms, counts) if len(terms) else np.empty(0, np.uint64)
                keys.append(bands(made).view(np.int64) if len(terms) else [])
                marks.append((made >> _U(56)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(keys, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                names=["node", "keys", "marks"],
            )

    made = docs.select("node", "text").mapInArrow(run, "node binary, keys array<long>, marks binary")
    return stored(made, "signatures")


def buckets(signed: DataFrame) -> DataFrame:
    """(key, node, nodes) of the nodes that share a band with another node, and how many share it."""
    rows = stored(signed.select(F.explode("keys").alias("key"), "node").distinct(), "bands")
    shared = rows.groupBy("key").agg(F.count("*").alias("nodes")).where("nodes > 1")
    return rows.join(shared, "key")


def similar(nodes: list[bytes], marks: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
    """Links that join what all links of ``AGREEMENT`` join, and none under ``AGREEMENT - RADIUS``."""
    open_ = np.ones(len(nodes), bool)
    joined = np.arange(len(nodes))
    for n in range(len(nodes)):
        if not open_[n]:
            continue
        agree = (marks == marks[n]).mean(axis=1)
        open_[agree >= 1 - RADIUS] = False
        hits = np.flatnonzero(agree >= AGREEMENT - RADIUS)
        names, first = np.unique(joined[hits], return_index=True)
        for name, hit in zip(names, hits[first], strict=True):
            if name != joined[n]:
                yield nodes[n], nodes[hit]
                joined[joined == name] = joined[n]


def bucket_links(rows: DataFrame, signed: DataFrame, bucket_nodes: int = BUCKET_NODES) -> DataFrame:
    """(a, b): links of similar nodes inside each bucket; ``rows`` is a result of ``buckets``."""
    marks = signed.select("node", "marks").dropDuplicates(["node"])
    blocks = F.ceil(F.col("nodes") / bucket_nodes)
    dealt = (
        rows.withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .join(marks, "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", "marks")
    )
    group = ["key", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        nodes: list[bytes] = []
        held: list[bytes] = []

        def links() -> list[tuple[bytes, bytes]]:
            marks = np.frombuffer(b"".join(held), np.uint8).reshape(-1, REGISTERS)
            return list(similar(nodes, marks))

        for batch in batches:
            found: list[tuple[bytes, bytes]] = []
            keys = zip(*(batch.column(c).to_pylist() for c in group), strict=True)
            for key, node, mark in zip(keys, batch.column("node").to_pylist(), batch.column("marks").to_pylist(), strict=True):
                if key != now:
                    found += links()
                    now, nodes, held = key, [], []
                nodes.append(node)
                held.append(mark)
            yield _edges(found)
        if nodes:
            yield _edges(links())

    ordered = dealt.repartition(*group).sortWithinPartitions(*group, "node")
    return ordered.mapInArrow(run, "a binary, b binary")


class Blocks:
    """Bags of one or two blocks, and which of them links have joined so far."""

    def __init__(self, similarity: float) -> None:
        self.similarity = similarity
        self.nodes: list[bytes] = []
        self.bags: list[tuple[np.ndarray, np.ndarray]] = []
        self.sides: list[int] = []

    def add(self, node: bytes, terms: tuple[np.ndarray, np.ndarray], side: int) -> None:
        self.nodes.append(node)
        self.bags.append(terms)
        self.sides.append(side)

    def links(self) -> Iterator[tuple[bytes, bytes]]:
        """Links that join all that any link between the two sides (or within the only one) joins."""
        side = np.array(self.sides)
        two = side.min() != side.max()
        left, right = (np.flatnonzero(side == s) for s in (side.min(), side.max()))
        terms = np.concatenate([self.bags[n][0] for n in right])
        owner = np.repeat(right, [len(self.bags[n][0]) for n in right])
        order = np.argsort(terms, kind="stable")
        terms, owner = terms[order], owner[order]
        count = np.concatenate([self.bags[n][1] for n in right])[order]
        size = np.array([c.sum() for _, c in self.bags])
        joined = np.arange(len(side))
        for n in left:
            own, own_count = self.bags[n]
            low, high = (np.searchsorted(terms, own, side=s) for s in ("left", "right"))
            runs = high - low
            at = np.repeat(high - np.cumsum(runs), runs) + np.arange(runs.sum())
            shared = np.minimum(np.repeat(own_count, runs), count[at])
            both = np.bincount(owner[at], shared, len(side))
            near = both >= self.similarity * (size[n] + size - both)
            near[n] = False
            if not two:
                near[n + 1 :] = False
            hits = np.flatnonzero(near)
            names, first = np.unique(joined[hits], return_index=True)
            for name, hit in zip(names, hits[first], strict=True):
                if name != joined[n]:
                    yield self.nodes[n], self.nodes[hit]
                    joined[joined == name] = joined[n]


def family_links(
    families: DataFrame,
    texts: DataFrame,
    similarity: float = SIMILARITY,
    block_nodes: int = BLOCK_NODES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(a, b): links that join what all links within each family join.

    ``families`` has node and comp, ``texts`` node and text.
    """
    sizes = texts.select("node", F.octet_length("text").alias("bytes")).join(families, "node")
    blocks = sizes.groupBy("comp").agg(
        F.greatest(F.ceil(F.count("*") / block_nodes), F.ceil(F.sum("bytes") / block_bytes)).alias("blocks")
    )
    # blocks meet nodes before texts do, so a large family's texts never pass through one task
    placed = families.join(blocks, "comp").select(
        "node", "comp", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("own")
    )
    dealt = (
        texts.join(placed, "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "comp",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            "own",
            "node",
            "text",
        )
    )
    group = ["comp", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, Blocks(similarity)
        for batch in batches:
            found: list[tuple[bytes, bytes]] = []
            keys = zip(*(batch.column(c).to_pylist() for c in group), strict=True)
            rows = zip(keys, batch.column("node").to_pylist(), batch.column("own").to_pylist(), strict=True)
            for (key, node, side), terms in zip(rows, bags(batch.column("text")), strict=True):
                if key != now:
                    if held.nodes:
                        found += held.links()
                    now, held = key, Blocks(similarity)
                held.add(node, terms, side)
            yield _edges(found)
        if held.nodes:
            yield _edges(list(held.links()))

    ordered = dealt.repartition(*group).sortWithinPartitions(*group, "own", "node")
    return ordered.mapInArrow(run, "a binary, b binary")


def _edges(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    sides = [pa.array([pair[n] for pair in found], pa.binary()) for n in (0, 1)]
    return pa.RecordBatch.from_arrays(sides, names=["a", "b"])


def grouped(
    docs: DataFrame, similarity: float = SIMILARITY, bucket_nodes: int = BUCKET_NODES, **blocks: int
) -> DataFrame:
    """doc_id, node and comp of every row: rows of one class share comp."""
    bound_batches(docs.sparkSession)
    docs = with_node(docs)
    members = stored(docs.select("doc_id", "node"), "members")
    signed = signatures(docs)
    near = stored(bucket_links(buckets(signed), signed, bucket_nodes).distinct(), "near")
    nodes = stored(near.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    families = components(nodes, near)
    # one row per node: that of its least id
    first = members.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("first"))
    texts = stored(
        docs.join(first, "node")
        .where(F.col("doc_id").eqNullSafe(F.col("first")))
        .dropDuplicates(["node"])
        .select("node", "text"),
        "texts",
    )
    labels = components(nodes, family_links(families, texts, similarity, **blocks))
    comp = F.coalesce("comp", "node")
    return members.join(labels, "node", "left").select("doc_id", "node", comp.alias("comp"))


def classes(docs: DataFrame, similarity: float = SIMILARITY, **blocks: int) -> DataFrame:
    """doc_id and class_id of every row, with the number of rows in its class."""
    named = stored(grouped(docs, similarity, **blocks), "classes")
    least = named.groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_rows"))
    return named.join(least, "comp").select("doc_id", "class_id", "class_rows")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, **blocks: int) -> DataFrame:
    """One row of each class: that of the least doc_id, then of the least text hash."""
    named = grouped(docs, similarity, **blocks)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    kept = named.groupBy("comp").agg(F.min(order).alias("kept")).select("kept.doc_id", "kept.node")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    own = docs.select(*columns, _row_key(with_node_column()).alias("__key"))
    wanted = kept.select(_row_key(F.col("node")).alias("__key"))
    return own.join(wanted, "__key", "left_semi").dropDuplicates(["__key"]).select(*columns)


def _row_key(node: Column) -> Column:
    """One value per doc_id and node."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.sha2(F.concat(name.cast("binary"), F.lit(b":"), node), 256)
