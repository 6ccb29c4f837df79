"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its lower-cased words and the first 5 to 8 bytes of longer words, hashed into
``BUCKETS``; a text has a term or not. The machine adds to the linear weights a product of factor vectors
for each pair of terms, so an insult next to a group's name may weigh more than both alone.

Training reads labelled rows only: at most ``MAX_ROWS`` distinct ones (doc_id and text), those with the
smallest hash. Reduced to their buckets they go to the driver, where the machine is fitted by mini-batches that
touch only the buckets of their rows. Every bucket of a row counts: its input is between ``LEAST`` and one, more the
more the fitted rows with it differ from the others in label (likelihood ratio), so a bucket that tells something
only beside another one is still learnt from. A row's inputs have the length ``LENGTH``. Rows and buckets bound
what the driver holds, whatever the size of the tables.

A row's label is the largest of its labels; NULL labels and ids are left out. A NULL text is empty; an
empty text gets the score of the bias alone. Without any labelled row all scores are one half. Texts are
scored whole, repeated rows alike; further columns are kept by ``score`` and never read as terms.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.spark import bound_batches, stored, whole
from tidemark.llm.text import prefix_hashes, word_blocks

BUCKETS = 1 << 20
PREFIXES = (5, 6, 7, 8)
MAX_ROWS = 20_000
FACTORS = 4
EPOCHS = 6
BATCH = 128
RATE = 0.1
DECAY = 1e-3
#: Least input of a bucket, the likelihood ratio of a medium one, and the length of a row's inputs.
LEAST = 0.05
MEDIUM = 20.0
LENGTH = 5.0
#: Buckets whose inputs are made at a time, and parts in which the fitted rows come to the driver.
STRETCH = 1 << 17
SLICES = 16
THRESHOLD = 0.3


def buckets(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per block of texts: its first text, how many, and (text, bucket) of every term."""
    mask = np.uint64(BUCKETS - 1)
    for block in word_blocks(texts, letters=True):
        count = len(block.bounds) - 1
        owner = np.repeat(np.arange(count), np.diff(block.bounds))
        found = [(owner, block.hashes)]
        if len(block.hashes):
            for size in PREFIXES:
                hashes, words = prefix_hashes(block, size)
                found.append((owner[words], hashes))
        yield (
            block.first,
            count,
            np.concatenate([o for o, _ in found]),
            (np.concatenate([h for _, h in found]) & mask).astype(np.int64),
        )


@dataclass(frozen=True)
class Machine:
    """A fitted machine: bias, and by bucket the input, the linear weight and the factors.

    With ``place``, these are kept by place, and that of a bucket is looked up there.
    """

    bias: float
    inputs: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    place: np.ndarray | None = None

    def packed(self) -> Machine:
        """The same machine without the buckets that no fitted row has; smaller to send and to hold."""
        held = np.flatnonzero(self.inputs > 0)
        place = np.zeros(BUCKETS, np.int32)
        place[held] = np.arange(1, len(held) + 1)
        # place 0 is that of all other buckets, with the input 0
        parts = (np.concatenate([np.zeros_like(a[:1]), a[held]]) for a in (self.inputs, self.weights, self.factors))
        return Machine(self.bias, *parts, place)

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability of label 1 for each text."""
        out = np.full(len(texts), self.bias)
        for first, count, owner, bucket in buckets(texts):
            known = self.inputs[bucket if self.place is None else self.place[bucket]] > 0
            pairs = np.unique(owner[known] * BUCKETS + bucket[known])
            text, bucket = pairs // BUCKETS, pairs % BUCKETS
            bucket = bucket if self.place is None else self.place[bucket]
            x = scaled(self.inputs[bucket], text, count)
            total = np.bincount(text, self.weights[bucket] * x, count).astype(np.float64)
            for f in range(self.factors.shape[1]):
                part = self.factors[bucket, f] * x
                total += 0.5 * np.bincount(text, part, count) ** 2
                total -= 0.5 * np.bincount(text, part * part, count)
            out[first : first + count] += total
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def scaled(inputs: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """Inputs of rows brought to one length; ``owner`` is the row of each."""
    length = np.sqrt(np.bincount(owner, inputs.astype(np.float64) ** 2, count))
    return inputs * (LENGTH / np.maximum(length, 1e-9))[owner]


def bucket_inputs(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """The input of every bucket, from the likelihood ratio of label and bucket; 0 where no row has it."""
    counts = np.zeros((2, BUCKETS), np.int32)
    for at in range(0, len(rows), BATCH):
        part, truth = rows[at : at + BATCH], y[at : at + BATCH] > 0
        for label in (0, 1):
            held = [r for r, own in zip(part, truth, strict=True) if own == label]
            if held:
                counts[label] += np.bincount(np.concatenate(held), minlength=BUCKETS).astype(np.int32)
    n1, n = y.sum(), len(y)
    share = n1 / max(n, 1)

    def cell(seen: np.ndarray, want: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(want, 1e-12)), 0.0)

    out = np.zeros(BUCKETS, np.float32)
    for at in range(0, BUCKETS, STRETCH):
        ones = counts[1, at : at + STRETCH].astype(np.float64)
        every = ones + counts[0, at : at + STRETCH]
        ratio = cell(ones, every * share) + cell(every - ones, every * (1 - share))
        ratio += cell(n1 - ones, (n - every) * share) + cell(n - n1 - every + ones, (n - every) * (1 - share))
        above = np.maximum(2 * ratio - 1, 0) ** 2
        out[at : at + STRETCH] = np.where(every > 0, LEAST + (1 - LEAST) * above / (above + MEDIUM**2), 0.0)
    return out


def fit(rows: list[np.ndarray], labels: list[int], seed: int = 3) -> Machine:
    """Fit by mini-batches with adaptive steps on the logistic loss; ``rows`` hold distinct buckets.

    The rows are taken over: the list is empty afterwards.
    """
    y = np.asarray(labels, np.float64)
    prior = (y.sum() + 1) / (len(y) + 2)
    rng = np.random.default_rng(seed)
    bias, bias_seen = np.log(prior / (1 - prior)), 1.0
    inputs = bucket_inputs(rows, y)
    # per bucket the linear weight, then the factors
    value = np.concatenate([np.zeros((BUCKETS, 1)), rng.normal(0, 0.01, (BUCKETS, FACTORS))], axis=1, dtype=np.float32)
    seen = np.ones_like(value)
    order, batches = rng.permutation(len(y)), []
    for at in range(0, len(order), BATCH):
        part = order[at : at + BATCH]
        touched, entry = np.unique(np.concatenate([rows[n] for n in part]), return_inverse=True)
        # what is kept of a batch is small: a number per term, of two bytes where they suffice
        entry = entry.astype(np.uint16 if len(touched) <= 1 << 16 else np.int32)
        batches.append((y[part], [len(rows[n]) for n in part], touched, entry))
    rows.clear()
    for _ in range(EPOCHS):
        for n in rng.permutation(len(batches)):
            truth, sizes, touched, entry = batches[n]
            owner = np.repeat(np.arange(len(truth)), sizes)
            x = scaled(inputs[touched][entry], owner, len(truth)).astype(np.float32)
            own = value[touched][entry] * x[:, None]
            sums = np.stack([np.bincount(owner, own[:, f], len(truth)) for f in range(FACTORS + 1)], axis=1)
            squares = np.bincount(owner, (own[:, 1:] ** 2).sum(axis=1), len(truth))
            margin = bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(axis=1) - squares)
            error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - truth
            slope = sums[owner] - own
            slope[:, 0] = 1
            slope *= (error[owner] * x)[:, None]
            total = np.stack([np.bincount(entry, slope[:, f], len(touched)) for f in range(FACTORS + 1)], axis=1)
            total += DECAY * value[touched]
            seen[touched] += total**2
            value[touched] -= RATE * total / np.sqrt(seen[touched])
            bias_seen += error.sum() ** 2
            bias -= RATE * error.sum() / bias_seen**0.5
    return Machine(float(bias), inputs, value[:, 0].copy(), value[:, 1:].copy())


def train(docs: DataFrame, labels: DataFrame, column: str = "toxic") -> Machine:
    """Fit a machine on labelled documents: labels has doc_id and a 0/1 column."""
    bound_batches(docs.sparkSession)
    chosen = (
        labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max((F.col(column) > 0).cast("int")).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(MAX_ROWS)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[list[int]] = []
            for _, count, owner, bucket in buckets(batch.column("text")):
                pairs = np.unique(owner * BUCKETS + bucket)
                cuts = np.searchsorted(pairs, np.arange(1, count) * BUCKETS)
                made += [(p % BUCKETS).astype(np.int32) for p in np.split(pairs, cuts)]
            terms = pa.array(made, pa.list_(pa.int32()))
            columns = [batch.column("name"), batch.column("label"), terms]
            yield pa.RecordBatch.from_arrays(columns, names=["name", "label", "terms"])

    # an id may have several texts and rows, so the rows are bounded again
    named = docs.select("doc_id", whole("text").alias("text")).join(F.broadcast(chosen), "doc_id")
    named = named.select(F.xxhash64("doc_id", "text").alias("name"), "label", "text")
    made = named.mapInArrow(run, "name long, label int, terms array<int>").dropDuplicates(["name"])
    rows = stored(made, "terms")
    last = rows.select("name").orderBy("name").limit(MAX_ROWS).agg(F.max("name")).first()[0]
    found: list[tuple[int, int, np.ndarray]] = []
    for n in range(SLICES if last is not None else 0):
        part = rows.where((F.col("name") <= last) & (F.pmod("name", F.lit(SLICES)) == n)).toArrow()
        terms = part.column("terms").combine_chunks()
        flat, cuts = terms.flatten().to_numpy().copy(), np.diff(terms.offsets.to_numpy()).cumsum()[:-1]
        columns = (part.column(c).to_pylist() for c in ("name", "label"))
        found += zip(*columns, np.split(flat, cuts) if len(part) else [], strict=True)
    found.sort(key=lambda row: row[0])
    held, labels = [terms for *_, terms in found], [label for _, label, _ in found]
    found.clear()
    return fit(held, labels)


def score(docs: DataFrame, machine: Machine, column: str = "text") -> DataFrame:
    """Add score (0 to 1) and predicted (1 from ``THRESHOLD`` on)."""
    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    names = [f.name for f in added]
    kept = [f for f in docs.schema if f.name not in names]
    machine = machine.packed()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(column)
            scores = machine.scores(texts.fill_null("") if texts.null_count else texts)
            made = [pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + made, names=[*(f.name for f in kept), *names]
            )

    bound_batches(docs.sparkSession)
    return docs.mapInArrow(run, T.StructType(kept + added))


def in_training(doc_id: str = "doc_id"):
    """Whether a row may be learnt from: the remainder 2 of its id's CRC-32 by 4 is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 != 2, F.lit(False))


def train_open(docs: DataFrame, labels: DataFrame) -> Machine:
    """Fit on the rows that are not held out."""
    return train(docs, labels.where(in_training()))
