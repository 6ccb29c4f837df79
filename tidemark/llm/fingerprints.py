"""Fingerprints by consistent weighted sampling, and each text against its successor.

The terms of a text are its runs of five words, weighted by how often they occur. Sample k of a term
of weight s takes r ~ Gamma(2, 1), c ~ Gamma(2, 1) and b ~ Uniform(0, 1) from the term's hash alone,
steps ln(s) down to the grid r * (t - b), and scores ln(c) - r * (t - b) - r; the term with the least
score is the sample, kept with its t. Two texts share a sample with the probability of their
generalised Jaccard similarity (sum of minimum weights over sum of maximum weights).

Gamma(2, 1) is a sum of two exponentials, so each is read from two quantile tables by two parts of
the term's hash; the uniform is the fraction of two uniforms.

A NULL text is empty; an empty text has the empty fingerprint, alike (1.0) to empty ones only. Texts of
under five words have one term of all their words. Equal texts have equal fingerprints. Rows of equal
id follow each other by text, NULL ids come last; with one row the next row is the row itself. Further
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.spark import bound_batches, partitions, whole
from tidemark.llm.text import bag, mix, shingles, word_blocks

SAMPLES = 64
_BITS = 12
_CHUNK = 2048
OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


@lru_cache(maxsize=1)
def _tables(samples: int) -> tuple[np.ndarray, ...]:
    """Four tables of exponential quantiles and two of uniform ones, each column shuffled."""
    rng = np.random.default_rng(64)
    size = 1 << _BITS
    even = (np.arange(size) + 0.5) / size
    uniform = lambda: np.stack([rng.permutation(even) for _ in range(samples)], axis=1)
    exponential = [-np.log(uniform()) for _ in range(4)]
    return tuple(x.astype(np.float32) for x in (*exponential, uniform(), uniform()))


def signature(terms: np.ndarray, weights: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """One 16-bit value per sample; no values for a text without terms."""
    if not len(terms):
        return np.empty(0, np.uint16)
    r1, r2, c1, c2, b1, b2 = _tables(samples)
    best = np.full(samples, np.inf, np.float32)
    kept = np.zeros(samples, np.uint64)
    columns = np.arange(samples)
    mask = np.uint64((1 << _BITS) - 1)
    for at in range(0, len(terms), _CHUNK):
        part = terms[at : at + _CHUNK]
        count = weights[at : at + _CHUNK]
        i, j = (part & mask).astype(np.intp), (part >> np.uint64(_BITS) & mask).astype(np.intp)
        r = r1[i] + r2[j]
        b = b1[i] + b2[j]
        b -= np.floor(b)
        heavy = np.flatnonzero(count > 1)
        step = np.zeros((len(heavy), samples), np.float32)
        if len(heavy):
            logs = np.log(count[heavy]).astype(np.float32)[:, None]
            step = np.floor(logs / r[heavy] + b[heavy])
            b[heavy] -= step
        score = np.log(c1[i] + c2[j])
        b -= 1
        b *= r
        score += b
        low = score.argmin(axis=0)
        least = score[low, columns]
        won = least < best
        best[won] = least[won]
        steps = np.zeros(samples, np.uint64)
        if len(heavy):
            row = np.full(len(part), -1)
            row[heavy] = np.arange(len(heavy))
            picked = row[low]
            steps[picked >= 0] = step[picked[picked >= 0], columns[picked >= 0]].astype(np.uint64)
        kept[won] = (part[low] + steps * np.uint64(0x9E3779B97F4A7C15))[won]
    return (mix(kept) >> np.uint64(48)).astype(np.uint16)


def signatures(texts: pa.Array) -> list[np.ndarray]:
    """The signature of each text of a column."""
    out = []
    for block in word_blocks(texts):
        hashes, bounds = shingles(block)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            out.append(signature(*bag(hashes[a:b])))
    return out


def to_text(values: np.ndarray) -> str:
    return values.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal samples: the estimate of the generalised Jaccard similarity."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return float((a == b).mean())


def fingerprint(df: DataFrame, column: str = "text", into: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of a text column."""
    schema = T.StructType(
        [f for f in df.schema if f.name != into] + [T.StructField(into, T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([to_text(s) for s in signatures(batch.column(column))], pa.string())
            kept = [n for n in batch.schema.names if n != into]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in kept] + [made], names=[*kept, into]
            )

    bound_batches(df.sparkSession)
    return df.withColumn(column, whole(column)).mapInArrow(run, schema)


def with_successors(docs: DataFrame) -> DataFrame:
    """Lay rows out by descending id in numbered ranges, each range closed by a copy of the first
    row of the next one (``extra``), so that every row's successor follows it in its partition.

    Range bounds come from quantiles of the ids; there are as many ranges as shuffle partitions, and
    one row of (range, first id) each goes through the driver.
    """
    spark = docs.sparkSession
    ranges = partitions(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
    shares = [i / ranges for i in range(1, ranges)]
    found = docs.approxQuantile("doc_id", shares, 0.2 / ranges) if shares else []
    bounds = sorted({int(x) for x in found}, reverse=True)
    # bounds descend: the number of bounds above an id is the number of its range
    above = F.expr(
        f"cast({len(bounds)} - array_size(filter(array({', '.join(f'{b}L' for b in bounds)}), "
        "x -> x <= doc_id)) as int)"
        if bounds
        else "0"
    )
    placed = docs.withColumn(
        "range", F.when(F.col("doc_id").isNull(), F.lit(len(bounds))).otherwise(above)
    )
    firsts = [
        (r["range"], r["first"])
        for r in placed.groupBy("range").agg(F.max("doc_id").alias("first")).orderBy("range").collect()
    ]
    heads = spark.createDataFrame(
        [(n, first, firsts[i - 1][0]) for i, (n, first) in enumerate(firsts)],
        "head_range int, head long, before int",
    )
    copies = F.array_compact(F.array(F.struct("range", F.lit(False).alias("extra")), F.when(
        F.col("before").isNotNull(), F.struct(F.col("before").alias("range"), F.lit(True).alias("extra"))
    )))
    return (
        placed.join(
            F.broadcast(heads),
            (F.col("range") == F.col("head_range")) & F.col("doc_id").eqNullSafe(F.col("head")),
            "left",
        )
        .select("doc_id", "text", F.inline(copies))
        .repartitionById(len(bounds) + 1, "range")
        .sortWithinPartitions("range", "extra", F.desc_nulls_last("doc_id"), "text")
    )


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprint each text, the text edited by its successor's beginning, and the successor."""
    ordered = with_successors(docs)
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            signs = signatures(batch.column("text"))
            columns = [batch.column(n).to_pylist() for n in ("range", "extra", "doc_id", "text")]
            pairs = []
            for number, extra, doc_id, text, sign in zip(*columns, signs, strict=True):
                if waiting is not None and waiting[0] == number:
                    pairs.append((waiting, (doc_id, text, sign)))
                    waiting = None
                if not extra:
                    waiting = (number, doc_id, text, sign)
            if pairs:
                yield _compared(pairs)

    return ordered.mapInArrow(run, OUT)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the beginning of the following text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _compared(pairs: list) -> pa.RecordBatch:
    texts = [edited(own[2], after[1]) for own, after in pairs]
    signs = signatures(pa.array(texts, pa.large_string()))
    columns = [
        pa.array([own[1] for own, _ in pairs], pa.int64()),
        pa.array([len(own[2]) for own, _ in pairs], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
        pa.array([to_text(own[3]) for own, _ in pairs], pa.string()),
        pa.array([to_text(s) for s in signs], pa.string()),
        pa.array([likeness(own[3], s) for (own, _), s in zip(pairs, signs, strict=True)], pa.float64()),
        pa.array([likeness(own[3], after[2]) for own, after in pairs], pa.float64()),
    ]
    names = [part.split()[0] for part in OUT.split(", ")]
    return pa.RecordBatch.from_arrays(columns, names=names)
