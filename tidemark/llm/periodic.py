"""Periodic runs of words by an online sparse dynamic programme over diagonals.

A run is a stretch of words with smallest period q that is at least ``SHORTEST`` words and two periods long
and that no neighbouring word extends. On the diagonal of lag q it is a stretch of at least q words, each
equal to the word q before it.

Words are read from left to right, some thousands at a time. Each word's earlier occurrences increment the
match lengths of their lags; a lag that is not incremented ends, and emits its run at once if the matches
suffice (``Diagonals``). Three facts keep the programme sparse without losing a run:

* Lags under ``CONTEXT`` need no lookup: a word is compared with the eleven words before it.
* A run of lag q needs q matches in a row. So for lags from K to 2 K - 1, for K = 12, 24, 48, ...,
  only earlier occurrences count whose last K words agree. They are found by sorting names of K words,
  made by doubling; a word whose last K words occur once leaves all longer levels.
* Occurrences that follow each other at one distance under K make the stretch periodic with that distance,
  so lags between them are multiples of a shorter period and not looked at. One word repeated a
  million times costs no pair.

Names are 64-bit hashes of exact word numbers; every emitted run is compared word by word, and a block with a
collision is named again. A task holds a block of texts of about ``BLOCK_BYTES``, or one longer text, and
``PAIRS`` matches at a time.

Words are separated by ASCII space and the characters 9 to 13. A NULL or empty text has no words and no runs;
its collapsed text is empty. Rows are independent of one another: repeated rows and ids, NULL ids included, give
a row each; an empty table gives none. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.spark import bound_batches, whole
from tidemark.llm.text import mix

SHORTEST = 12
#: Words of the first context.
CONTEXT = 12
BLOCK_BYTES = 1 << 20
PAIRS = 1 << 20
#: Of each shorter lag, the parts that a smaller period would divide.
_PARTS = {q: [q // r for r in (2, 3, 5, 7, 11) if q % r == 0] for q in range(1, CONTEXT)}
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


class Diagonals:
    """Match lengths of the active lags while words are read from left to right."""

    def __init__(self, context: int) -> None:
        #: a match at a word stands for matches of this many words up to it
        self.context = context
        self.lags = self.firsts = np.empty(0, np.int64)
        self.read = -1
        self.runs: list[Runs] = []

    def advance(self, lags: np.ndarray, places: np.ndarray, read: int) -> None:
        """Take all matches (lag, place) of the words after the last one read, up to ``read``."""
        order = np.lexsort((places, lags))
        lags, places = lags[order], places[order]
        opens = np.ones(len(lags), bool)
        opens[1:] = (lags[1:] != lags[:-1]) | (places[1:] != places[:-1] + 1)
        at = np.flatnonzero(opens)
        lag, first = lags[at], places[at].copy()
        last = places[np.append(at[1:], len(places)) - 1] if len(at) else first
        # a stretch that begins at the next word goes on with an active lag
        joins = np.flatnonzero(first == self.read + 1)
        where = np.searchsorted(self.lags, lag[joins])
        same = where < len(self.lags)
        same[same] = self.lags[where[same]] == lag[joins[same]]
        first[joins[same]] = self.firsts[where[same]]
        stopped = np.ones(len(self.lags), bool)
        stopped[where[same]] = False
        self._emit(self.lags[stopped], self.firsts[stopped], np.full(int(stopped.sum()), self.read))
        active = last == read
        self._emit(lag[~active], first[~active], last[~active])
        self.lags, self.firsts, self.read = lag[active], first[active], read

    def close(self) -> list[Runs]:
        """End all lags."""
        self._emit(self.lags, self.firsts, np.full(len(self.lags), self.read))
        self.lags = self.firsts = np.empty(0, np.int64)
        return self.runs

    def _emit(self, lag: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        matches = last - first + self.context
        enough = matches >= np.maximum(lag, SHORTEST - lag)
        if enough.any():
            lag, first, matches = lag[enough], first[enough], matches[enough]
            self.runs.append((first - self.context + 1 - lag, matches + lag, lag))


def _near(ids: np.ndarray, begins: np.ndarray) -> list[Runs]:
    """Runs of lags under ``CONTEXT``, by comparison with the words just before."""
    n = len(ids)
    place = np.arange(n)
    same = {}
    found = []
    for lag in range(1, min(CONTEXT, n)):
        match = np.zeros(n, bool)
        match[lag:] = ids[lag:] == ids[:-lag]
        match &= place - begins >= lag
        same[lag] = match
        at = np.flatnonzero(match)
        diagonals = Diagonals(1)
        diagonals.advance(np.full(len(at), lag), at, n)
        for start, length, period in diagonals.close():
            # with two periods or more, a smaller period divides the lag
            whole_part = np.zeros(len(start), bool)
            for part in _PARTS[lag]:
                total = np.concatenate([[0], np.cumsum(same[part])])
                whole_part |= total[start + length] - total[start + part] == length - part
            found.append((start[~whole_part], length[~whole_part], period[~whole_part]))
    return found


def _far(ids: np.ndarray, begins: np.ndarray, salt: int) -> Iterator[Runs]:
    """Runs of lags from ``CONTEXT`` on, a doubling of the context at a time."""
    n = len(ids)

    def joined(names: np.ndarray, back: int) -> np.ndarray:
        out = names * _FACTOR
        out[back:] += names[: n - back] if back < n else 0
        return mix(out)

    with np.errstate(over="ignore"):
        names = mix(ids.astype(np.uint64) + np.uint64(salt << 40))
        # three words, six, twelve
        names = mix(joined(names, 1) * _FACTOR + np.roll(names, 2))
        names = joined(joined(names, 3), 6)
        of_text = mix(begins.astype(np.uint64) + np.uint64(1))
        context = CONTEXT
        places = np.arange(n)
        while True:
            places = places[places - begins[places] >= context - 1]
            order = np.argsort(names[places] ^ of_text[places], kind="stable")
            at = places[order]
            name = names[at] ^ of_text[at]
            again = name[1:] == name[:-1]
            repeated = np.zeros(len(at), bool)
            repeated[1:] |= again
            repeated[:-1] |= again
            at, name = at[repeated], name[repeated]
            if not len(at):
                return
            yield from _level(at, name, context, n)
            places = np.sort(at)
            names = joined(names, context)
            context *= 2


def _level(at: np.ndarray, name: np.ndarray, context: int, n: int) -> list[Runs]:
    """Runs of lags from ``context`` to twice that, from places sorted by name and place."""
    size = len(at)
    number = np.arange(size)
    opens = np.ones(size, bool)
    opens[1:] = name[1:] != name[:-1]
    key = np.cumsum(opens) * (n + 1) + at
    low = np.searchsorted(key, key - np.minimum(at, 2 * context - 1))
    high = np.searchsorted(key, key - context, side="right")
    # places at one distance under the context make a chain: its lags have a shorter period
    step = np.full(size, -1)
    step[1:] = np.where(opens[1:], -1, at[1:] - at[:-1])
    block = np.ones(size, bool)
    block[1:] = opens[1:] | (step[1:] != step[:-1])
    chain = np.maximum.accumulate(np.where(block, number, 0)) - 1
    chain = np.where((step > 0) & (step < context), chain, number)
    partners = np.maximum(np.minimum(high, chain) - low, 0)
    order = np.argsort(at, kind="stable")
    order = order[partners[order] > 0]
    diagonals = Diagonals(context)
    total = np.cumsum(partners[order])
    done = 0
    while done < len(order):
        before = total[done - 1] if done else 0
        stop = max(done + 1, int(np.searchsorted(total, before + PAIRS, side="right")))
        part = order[done:stop]
        many = partners[part]
        word = np.repeat(part, many)
        earlier = low[word] + np.arange(len(word)) - np.repeat(np.cumsum(many) - many, many)
        diagonals.advance(at[word] - at[earlier], at[word], int(at[part[-1]]))
        done = stop
    return diagonals.close()


def word_runs(ids: np.ndarray, bounds: np.ndarray) -> Runs:
    """All runs of texts that follow each other: start in ``ids``, length, period, by start and period.

    ``ids`` are word numbers; text t has those from ``bounds[t]`` to ``bounds[t + 1]``.
    """
    begins = np.repeat(bounds[:-1], np.diff(bounds))
    near = _near(ids, begins)
    for salt in count():
        far = list(_far(ids, begins, salt))
        if all(
            np.array_equal(ids[s + q : s + length], ids[s : s + length - q])
            for starts, lengths, periods in far
            for s, length, q in zip(starts, lengths, periods, strict=True)
        ):
            break
    parts = near + far
    if not parts:
        none = np.empty(0, np.int64)
        return none, none, none
    start, length, period = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def scan(texts: list[bytes]) -> tuple[np.ndarray, Runs, list[bytes]]:
    """Of a block of texts: where each text's runs begin, the runs, the collapsed texts."""
    split = [text.split() for text in texts]
    bounds = np.concatenate([[0], np.cumsum([len(words) for words in split])])
    flat = pa.array([word for words in split for word in words], pa.binary())
    ids = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    start, length, period = word_runs(ids, bounds)
    gone = np.zeros(len(ids), bool)
    for s, n, q in zip(start, length, period, strict=True):
        gone[s + q : s + n] = True
    cuts = np.searchsorted(start, bounds)
    collapsed = []
    for t, words in enumerate(split):
        if cuts[t] < cuts[t + 1]:
            kept = ~gone[bounds[t] : bounds[t + 1]]
            words = [words[i] for i in np.flatnonzero(kept)]
        collapsed.append(b" ".join(words))
    owner = np.repeat(bounds[:-1], np.diff(cuts))
    return cuts, (start - owner, length, period), collapsed


def _blocks(texts: pa.Array) -> Iterator[list[bytes]]:
    block: list[bytes] = []
    held = 0
    for text in texts.cast(pa.binary()):
        block.append(text.as_py())
        held += len(block[-1])
        if held >= BLOCK_BYTES:
            yield block
            block, held = [], 0
    if block:
        yield block


def find_runs(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, runs (start, length, period; by start and period) and the collapsed text.

    A word is left out of the collapsed text if a run contains it after the run's first period; the words
    kept are joined by one space.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select("doc_id", whole("text").alias("text"))
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("runs", T.ArrayType(_RUN)),
            T.StructField("collapsed", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for block in _blocks(batch.column("text")):
                cuts, found, collapsed = scan(block)
                runs = pa.StructArray.from_arrays([pa.array(c) for c in found], list(_RUN.names))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(block)),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), runs),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=schema.names,
                )
                first += len(block)

    return rows.mapInArrow(run, schema)


def repeat_tails(docs: DataFrame) -> DataFrame:
    """Every tenth row (by the CRC-32 h of its id) with its tail made periodic: doc_id, text.

    Of n words, each word i from a = g % n on (g = h div 10) becomes word a + (i - a) % p, where
    p = 1 + (n - a) div (3 + g % 8). Rows without id stay as they are.
    """
    chosen = F.coalesce(F.col("h") % 10 == 0, F.lit(False))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    tail = F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    times = F.expr("CAST((n - a) DIV p + 1 AS INT)")
    woven = F.concat(F.slice("words", 1, F.col("a").cast("int")), F.flatten(F.array_repeat(tail, times)))
    return (
        docs.select("doc_id", whole("text").alias("text"))
        .withColumn("h", F.crc32(F.col("doc_id").cast("string")))
        .withColumn("words", F.when(chosen, words))
        .withColumn("n", F.size("words").cast("long"))
        .withColumn("a", F.expr("CASE WHEN n > 0 THEN (h DIV 10) % n END"))
        .withColumn("p", F.expr("1 + (n - a) DIV (3 + (h DIV 10) % 8)"))
        .select(
            "doc_id",
            F.when(F.col("a").isNotNull(), F.array_join(F.slice(woven, 1, F.col("n").cast("int")), " "))
            .otherwise(F.col("text"))
            .alias("text"),
        )
    )
