"""Secret scan by patterns and a character convolutional network.

Three patterns give the base findings, leftmost and non-overlapping each: ``assign`` (a key word, a separator and
a value of 6 characters or more), ``access`` (key ids) and ``hex`` (24 hexadecimal digits or more). Candidates
beside them are all runs of ``RUN`` characters or more that keys are made of. One pass over the texts writes, per
document, each finding with its windows: 24 bytes before, 64 of its own, 24 after; a longer finding has a window
for every 64 bytes, none is cut.

The network (byte embedding, one convolution, pooling over the three regions, a hidden layer) learns from
labelled findings: all distinct windows, those of base findings against those of other candidates. So that a
value counts without its key word, each finding is repeated with another window's surroundings and with its
letters and digits drawn anew. A quarter of the windows, by hash, is not learnt from: on all of it scores are
calibrated (Platt) and the threshold is set, the one of best precision among those that keep ``RECALL`` of the
labelled findings and of their repeats. Some of the other candidates are secrets without a label, so there are two
networks: the second is not told of candidates that the first takes for secrets.

Windows are dealt by hash into parts of about ``PART``. In every epoch each part goes on from the same network, in
mini-batches, and the networks of all parts are averaged, weighted by rows, as whole numbers, so that the sum does not
depend on its order. Log odds are rounded to 1/``GRID``; held-out windows are counted by them, so calibration and
threshold see every one through a table of bounded size. The driver holds one network and that table.

Every candidate is then scored, a long one by its best window. Base findings stay whatever their score; other
candidates at or above the threshold become findings of kind ``net``. Without windows of both labels in both
parts nothing is added, and scores are 0.5.

A NULL text is empty; an empty text has no findings. Rows are independent: repeated rows and ids, NULL
ids included, give a row each; an empty table gives none. Positions are code points, ends exclusive. Further columns
are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.spark import bound_batches, stored, whole

KINDS = ("assign", "access", "hex", "net")
NET = len(KINDS) - 1
RUN = 16
AROUND = 24
BODY = 64
WINDOW = 2 * AROUND + BODY
#: Windows of a part; steps of the log odds per unit and their largest value; binary places of an averaged number.
PART = 8_192
GRID = 1_024
ODDS = 60
PLACES = 44
RECALL = 0.98
EPOCHS = 6
BATCH = 128
RATE = 0.003
EMBED, REACH, FILTERS, HIDDEN = 8, 5, 24, 16
#: Windows that the network scores at a time.
SCORED = 1_024

_ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
_WORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(rb"[0-9a-f]{24,}")
_RUNS = re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % RUN)
_DIGITS, _UPPER, _LOWER = b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
#: What keys are drawn from: hexadecimal digits, one case, both.
_DRAWN = (_DIGITS + _UPPER[:6], _DIGITS + _LOWER[:6], _DIGITS + _UPPER, _DIGITS + _LOWER, _DIGITS + _UPPER + _LOWER)
#: Byte classes: ASCII as it is, then lead and continuation bytes of other characters.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[128:192], _CLASS[192:] = 129, 128
CLASSES = 130

FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("windows", T.ArrayType(T.BinaryType())),
        ]
    )
)


def windows(text: bytes, start: int, end: int) -> list[bytes]:
    """Windows of a value: bytes before (aligned right), its own, bytes after; NUL where there are none."""
    out = []
    for at in range(start, end, BODY):
        stop = min(at + BODY, end)
        before = text[max(0, at - AROUND) : at].rjust(AROUND, b"\0")
        after = text[stop : stop + AROUND].ljust(AROUND, b"\0")
        out.append(before + text[at:stop].ljust(BODY, b"\0") + after)
    return out


def matches(text: bytes) -> list[tuple[int, int, int, int, int]]:
    """Base findings and other candidates: (start, kind, end, and the value's start and end), in bytes."""
    out = []
    low = text.lower()
    if any(word in low for word in _WORDS):
        # a match whose value is too short is dropped after matching: what it took is not matched again
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                out.append((m.start(), 0, m.end(), m.start(2), m.end(2)))
    runs = [m.span() for m in _RUNS.finditer(text)]
    # both are long runs of characters that candidates may have, so they lie inside one
    for kind, pattern in ((1, _ACCESS), (2, _HEX)):
        for start, end in runs:
            out += [(m.start(), kind, m.end(), *m.span()) for m in pattern.finditer(text, start, end)]
    taken = sorted((s, e) for s, _, e, _, _ in out)
    at, reach = 0, 0
    for start, end in runs:
        while at < len(taken) and taken[at][0] < end:
            reach = max(reach, taken[at][1])
            at += 1
        if reach <= start:
            out.append((start, NET, end, start, end))
    return sorted(out)


def places(text: bytes, at: list[int]) -> list[int]:
    """Code points before each byte position."""
    if text.isascii():
        return at
    begins = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(begins)])[at].tolist()


def scan(text: bytes) -> list[dict]:
    """Findings and candidates of a text with their windows."""
    found = matches(text)
    if not found:
        return []
    starts, ends = places(text, [f[0] for f in found]), places(text, [f[2] for f in found])
    return [
        {"kind": kind, "start": s, "end": e, "windows": windows(text, low, high)}
        for (_, kind, _, low, high), s, e in zip(found, starts, ends, strict=True)
    ]


def candidates(docs: DataFrame) -> DataFrame:
    """Per row: doc_id and all findings and candidates with their windows, written once."""
    rows = docs.select("doc_id", whole("text").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("found", FOUND)])
    kind = pa.list_(
        pa.struct(
            [("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("windows", pa.list_(pa.binary()))]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([scan(t.as_py()) for t in batch.column("text").cast(pa.binary())], kind)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], names=schema.names)

    return stored(rows.mapInArrow(run, schema), "candidates")


def _ramp(x: np.ndarray) -> np.ndarray:
    return np.maximum(x, 0)


def _chance(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Net:
    """Byte embedding, convolution, pooling by region, a hidden layer, one output."""

    def __init__(self, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        normal = lambda *shape, by: rng.normal(0, by, shape).astype(np.float32)
        self.parts = [
            normal(CLASSES, EMBED, by=0.5),
            normal(REACH * EMBED, FILTERS, by=(2 / (REACH * EMBED)) ** 0.5),
            np.zeros(FILTERS, np.float32),
            normal(4 * FILTERS, HIDDEN, by=(2 / (4 * FILTERS)) ** 0.5),
            np.zeros(HIDDEN, np.float32),
            normal(HIDDEN, by=HIDDEN**-0.5),
            np.zeros(1, np.float32),
        ]

    def _columns(self, x: np.ndarray) -> np.ndarray:
        wide = np.pad(self.parts[0][x], ((0, 0), (REACH // 2, REACH // 2), (0, 0)))
        return np.concatenate([wide[:, k : k + WINDOW] for k in range(REACH)], axis=2)

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Outputs (log odds) of windows of byte classes, and what ``slopes`` needs."""
        _, kernel, lift, dense, shift, last, bias = self.parts
        columns = self._columns(x)
        maps = _ramp(columns @ kernel + lift)
        own = (x[:, AROUND : AROUND + BODY] > 0)[..., None]
        body = maps[:, AROUND : AROUND + BODY] * own
        count = own.sum(axis=1)
        pools = [body.max(axis=1), body.sum(axis=1) / count]
        pools += [maps[:, :AROUND].max(axis=1), maps[:, AROUND + BODY :].max(axis=1)]
        pooled = np.concatenate(pools, axis=1)
        hidden = _ramp(pooled @ dense + shift)
        return hidden @ last + bias[0], (x, columns, maps, own, count, body, pooled, hidden)

    def slopes(self, error: np.ndarray, kept: tuple) -> list[np.ndarray]:
        """Slopes of the loss in every part, from its slopes in the outputs."""
        x, columns, maps, own, count, body, pooled, hidden = kept
        _, kernel, _, dense, _, last, _ = self.parts
        to_hidden = error[:, None] * last * (hidden > 0)
        to_pooled = to_hidden @ dense.T
        top, mean, left, right = np.split(to_pooled, 4, axis=1)
        to_maps = np.zeros_like(maps)
        rows, filters = np.arange(len(x))[:, None], np.arange(FILTERS)[None, :]
        to_maps[:, AROUND : AROUND + BODY] = (mean / count)[:, None] * own
        for first, region, slope in (
            (AROUND, body, top),
            (0, maps[:, :AROUND], left),
            (AROUND + BODY, maps[:, AROUND + BODY :], right),
        ):
            to_maps[rows, first + region.argmax(axis=1), filters] += slope
        to_maps *= maps > 0
        flat = to_maps.reshape(-1, FILTERS)
        to_columns = (flat @ kernel.T).reshape(len(x), WINDOW, REACH, EMBED)
        wide = np.zeros((len(x), WINDOW + REACH - 1, EMBED), np.float32)
        for k in range(REACH):
            wide[:, k : k + WINDOW] += to_columns[:, :, k]
        to_bytes = np.zeros_like(self.parts[0])
        np.add.at(to_bytes, x, wide[:, REACH // 2 : REACH // 2 + WINDOW])
        return [
            to_bytes,
            columns.reshape(-1, REACH * EMBED).T @ flat,
            flat.sum(axis=0),
            pooled.T @ to_hidden,
            to_hidden.sum(axis=0),
            hidden.T @ error,
            error.sum(keepdims=True),
        ]

    def epoch(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, moments: list, step: int, seed: list[int]) -> None:
        """One pass of Adam on the logistic loss after ``step`` steps; ``moments`` (mean, square) go on too."""
        order = np.random.default_rng(seed).permutation(len(y))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            out, kept = self.forward(x[part])
            error = ((_chance(out) - y[part]) * weight[part] / len(part)).astype(np.float32)
            step += 1
            for value, slope, (mean, square) in zip(self.parts, self.slopes(error, kept), moments, strict=True):
                mean += 0.1 * (slope - mean)
                square += 0.001 * (slope**2 - square)
                value -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-7)

    def packed(self, moments: list) -> np.ndarray:
        """Parts and moments as one vector."""
        arrays = [*self.parts, *(m for m, _ in moments), *(q for _, q in moments)]
        return np.concatenate([a.ravel() for a in arrays])

    def unpack(self, vector: np.ndarray) -> list:
        """Take over the parts of a vector; returns its moments."""
        shapes = [p.shape for p in self.parts] * 3
        cuts = np.cumsum([int(np.prod(shape)) for shape in shapes])[:-1]
        arrays = [a.astype(np.float32).reshape(s) for a, s in zip(np.split(vector, cuts), shapes, strict=True)]
        n = len(self.parts)
        self.parts = arrays[:n]
        return list(zip(arrays[n : 2 * n], arrays[2 * n :], strict=True))


def _classes(held: list[bytes]) -> np.ndarray:
    return _CLASS[np.frombuffer(b"".join(held), np.uint8).reshape(-1, WINDOW)]


@dataclass(frozen=True)
class Scanner:
    """A fitted network, its calibration (log odds to log odds) and its threshold; no network: 0.5 for all."""

    net: Net | None = None
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 1.0

    def odds(self, held: list[bytes]) -> np.ndarray:
        """The network's outputs on their grid, some windows at a time."""
        out = [self.net.forward(_classes(held[at : at + SCORED]))[0] for at in range(0, len(held), SCORED)]
        if not out:
            return np.empty(0)
        return np.clip(np.rint(np.concatenate(out).astype(np.float64) * GRID) / GRID, -ODDS, ODDS)

    def scores(self, held: list[bytes]) -> np.ndarray:
        """Calibrated chance of each window to be a secret."""
        if self.net is None or not held:
            return np.full(len(held), 0.5)
        return _chance(self.slope * self.odds(held) + self.shift)


def calibrate(out: np.ndarray, y: np.ndarray, rows: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and shift of the log odds that fit held-out labels (Platt's targets, Newton steps); ``rows`` of each."""
    rows = np.ones(len(y)) if rows is None else rows
    ones = rows[y > 0].sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (rows.sum() - ones + 2))
    at = np.array([1.0, 0.0])
    design = np.stack([out, np.ones_like(out)], axis=1)
    for _ in range(100):
        chance = _chance(design @ at)
        slope = design.T @ (rows * (chance - target)) + 1e-3 * (at - [1.0, 0.0])
        bend = (design * (rows * chance * (1 - chance))[:, None]).T @ design + 1e-3 * np.eye(2)
        move = np.linalg.solve(bend, slope)
        at = at - move * min(1.0, 1.0 / np.abs(move).max(initial=1e-12))
        if np.abs(move).max() < 1e-9:
            break
    return (float(at[0]), float(at[1])) if at[0] > 0 else (1.0, 0.0)


def choose_threshold(
    scores: np.ndarray, y: np.ndarray, recall: float = RECALL, rows: np.ndarray | None = None
) -> float:
    """The threshold of best precision among those that keep the recall; of equals, the highest; ``rows`` of each."""
    rows = np.ones(len(y)) if rows is None else rows
    order = np.argsort(-scores, kind="stable")
    scores, hits, every = scores[order], np.cumsum((rows * (y > 0))[order]), np.cumsum(rows[order])
    last = np.append(scores[1:] != scores[:-1], True)
    enough = last & (hits >= recall * hits[-1])
    precision = np.where(enough, hits / every, -1.0)
    return float(scores[precision.argmax()])


def varied(held: list[bytes], others: list[bytes], seed: int = 13) -> list[bytes]:
    """Each window in another window's surroundings, and there with its letters and digits drawn anew."""
    rng = np.random.default_rng(seed)
    others, out = others or held, []
    for window in held:
        body = window[AROUND : AROUND + BODY]
        letters = _DRAWN[rng.integers(len(_DRAWN))]
        drawn = rng.integers(len(letters), size=BODY)
        anew = bytes(letters[n] if chr(c).isalnum() else c for c, n in zip(body, drawn, strict=True))
        for value in (body, anew):
            frame = others[rng.integers(len(others))]
            out.append(frame[:AROUND] + value + frame[AROUND + BODY :])
    return out


def _each(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes], list[bytes], list[bytes]]]:
    """Part, findings, others and plain ones of every row of a batch of parts."""
    yield from zip(*(batch.column(c).to_pylist() for c in ("part", "found", "others", "plain")), strict=True)


def _fitted(parts: DataFrame, found: int, plain: int, count: int) -> Net:
    """A network learnt from all windows of ``count`` parts: the findings and their repeats against the plain ones."""
    total = 3 * found + plain
    for_found, for_plain = 0.5 * total / (3 * found), 0.5 * total / plain
    net, steps = Net(), 0
    vector = net.packed([(np.zeros_like(p), np.zeros_like(p)) for p in net.parts])

    def passed(epoch: int, step: int, vector: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, ones, others, zeros in _each(batch):
                    ours = ones + varied(ones, others)
                    y = np.repeat([1.0, 0.0], [len(ours), len(zeros)])
                    if not len(y):
                        continue
                    own = Net()
                    moments = own.unpack(vector)
                    weight = np.where(y > 0, for_found, for_plain)
                    own.epoch(_classes(ours + zeros), y, weight, moments, step, [12, epoch, part])
                    share = own.packed(moments).astype(np.float64) * (len(y) / total)
                    columns = [pa.array(np.arange(len(share), dtype=np.int32)), pa.array(np.rint(share * 2.0**PLACES).astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names=["place", "value"])

        return run

    for epoch in range(EPOCHS):
        made = parts.mapInArrow(passed(epoch, steps, vector), "place int, value long")
        mean = made.groupBy("place").agg(F.sum("value").alias("value")).toPandas().sort_values("place")
        vector = mean["value"].to_numpy().astype(np.float64) / 2.0**PLACES
        steps += -(-total // (count * BATCH))
    net.unpack(vector)
    return net


def _judged(net: Net, parts: DataFrame) -> Scanner:
    """The network calibrated, with its threshold, on all windows of the held-out parts."""
    bare = Scanner(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, ones, others, plain in _each(batch):
                for label, held in ((1, ones + varied(ones, others, seed=14)), (0, plain)):
                    cells, rows = np.unique(np.rint(bare.odds(held) * GRID).astype(np.int32), return_counts=True)
                    columns = [pa.array(np.full(len(cells), label, np.int32)), pa.array(cells), pa.array(rows.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names=["label", "cell", "rows"])

    counted = parts.mapInArrow(run, "label int, cell int, rows long").groupBy("label", "cell").agg(F.sum("rows").alias("rows"))
    told = counted.toPandas().sort_values(["label", "cell"])
    out, truth, rows = (told[c].to_numpy().astype(np.float64) for c in ("cell", "label", "rows"))
    out /= GRID
    slope, shift = calibrate(out, truth, rows)
    return Scanner(net, slope, shift, choose_threshold(_chance(slope * out + shift), truth, rows=rows))


def _without(parts: DataFrame, scanner: Scanner) -> DataFrame:
    """The parts, their plain windows without those that the scanner takes for secrets."""
    names = parts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [
                [w for w, s in zip(others, scanner.scores(others), strict=True) if s < 0.5]
                for _, _, others, _ in _each(batch)
            ]
            plain = pa.array(kept, pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], plain], names=names)

    return stored(parts.mapInArrow(run, parts.schema), "plain")


def train(held: DataFrame) -> Scanner:
    """A scanner from all labelled findings of a candidate table."""
    labelled = (
        held.select(F.explode("found").alias("f"))
        .select((F.col("f.kind") != NET).cast("int").alias("label"), F.explode("f.windows").alias("window"))
        .groupBy("window")
        .agg(F.max("label").alias("label"))
        .select("label", F.struct(F.xxhash64("window").alias("name"), "window").alias("w"))
    )
    rows = stored(labelled.withColumn("held", F.pmod("w.name", F.lit(4)) == 3), "windows")
    sizes = {(r.held, r.label): r["count"] for r in rows.groupBy("held", "label").count().collect()}
    if len(sizes) < 4:
        return Scanner()
    count = -(-(sizes[False, 1] + sizes[False, 0]) // PART)

    def of(label: int):
        ordered = F.sort_array(F.collect_list(F.when(F.col("label") == label, F.col("w"))))
        return F.transform(ordered, lambda w: w["window"])

    dealt = rows.withColumn("part", F.pmod(F.shiftright("w.name", 2), F.lit(count)).cast("int"))
    dealt = dealt.repartition(count, "held", "part").groupBy("held", "part")
    parts = stored(dealt.agg(of(1).alias("found"), of(0).alias("others")).withColumn("plain", F.col("others")), "parts")
    learnt, apart = parts.where(~F.col("held")), parts.where("held")
    first = _judged(_fitted(learnt, sizes[False, 1], sizes[False, 0], count), apart)
    parts = _without(parts, first)
    plain = {r.held: r.n for r in parts.groupBy("held").agg(F.sum(F.size("plain")).alias("n")).collect()}
    if not (plain[False] and plain[True]):
        return first
    learnt, apart = parts.where(~F.col("held")), parts.where("held")
    return _judged(_fitted(learnt, sizes[False, 1], plain[False], count), apart)


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per row: doc_id and findings (kind, start, end, score), by start and kind."""
    bound_batches(docs.sparkSession)
    held = candidates(docs)
    scanner = train(held)
    schema = T.StructType(
        [
            held.schema["doc_id"],
            T.StructField(
                "findings",
                T.ArrayType(
                    T.StructType(
                        [
                            T.StructField("kind", T.StringType()),
                            T.StructField("start", T.LongType()),
                            T.StructField("end", T.LongType()),
                            T.StructField("score", T.DoubleType()),
                        ]
                    )
                ),
            ),
        ]
    )
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("found").to_pylist()
            flat = [f for found in rows for f in found]
            begins = np.cumsum([0, *(len(f["windows"]) for f in flat)])[:-1]
            scores = scanner.scores([w for f in flat for w in f["windows"]])
            best = iter(np.maximum.reduceat(scores, begins).tolist() if flat else [])
            out = []
            for found in rows:
                scored = [(f, next(best)) for f in found]
                out.append(
                    [
                        {"kind": KINDS[f["kind"]], "start": f["start"], "end": f["end"], "score": score}
                        for f, score in scored
                        if f["kind"] != NET or score >= scanner.threshold
                    ]
                )
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], names=schema.names)

    return held.mapInArrow(run, schema)
