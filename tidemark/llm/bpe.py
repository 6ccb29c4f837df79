"""Byte-level BPE by a deterministic tokenization automaton.

``Automaton`` compiles the merges one by one. It starts as one state that loops on every byte. The
gadget of a merge (u, v) -> w clones the state that u leads to, takes the v arc off the clone, leads
all u arcs to the clone, and gives every state with a u arc a w arc to where v led. All arcs with one
label lead to one state, so a state is stored as (label that leads to it, merge number) and its arcs
are looked up instead of copied. Paths of the finished automaton are exactly the correct tokenizations.

Words are encoded by table: subsets of (state, bytes read since) are made deterministic over bytes
as they are met; each table entry holds the next subset and the one token that ends there.

Texts are split into words as the tokenizer file's ByteLevel rule does; special tokens in a text
become their ids. NULL texts count as empty, empty texts have no ids, any length is read whole,
repeated rows are encoded each by itself, and further columns pass through untouched.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.spark import bound_batches, whole

#: Table entries and words a worker keeps; beyond them each is worked out when it is met.
TABLE_LIMIT = 150_000
WORD_LIMIT = 400_000
#: The published pre-tokenization pattern of byte-level BPE (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same pattern written out for printable Latin-1, which the standard module splits faster.
_LETTERS, _DIGITS = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾"
_LATIN = re.compile(
    f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[{_DIGITS}]+"
    f"| ?[^\\t\\n\\r {_LETTERS}{_DIGITS}]+|[\\t\\n\\r ]+(?![^\\t\\n\\r ])|[\\t\\n\\r ]+"
)
_NOT_LATIN = re.compile("[^\t\n\r -~¡-¬®-ÿ]")
#: Code points whose classes no Unicode version has changed since; others are split by the library.
_UNSETTLED = re.compile("[^\x00-՗]")


def byte_symbols() -> dict[str, int]:
    """Printable symbol of each byte: itself if printable Latin-1, else the next from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """Tokenization automaton of (left, right, merged) ids in merge order over 256 byte tokens."""

    def __init__(self, byte_ids: list[int], merges: list[tuple[int, int, int]]) -> None:
        size = max([*byte_ids, *(w for *_, w in merges)]) + 1
        self.labels: list[bytes] = [b""] * size
        self.left = [-1] * size
        self.made = [-1] * size
        self.live = [False] * size
        self.owner, self.born = [-1], [-1]
        self.target = [0] * size
        self.start = [0] * size
        self.taken: dict[int, int] = {}
        for byte, token in enumerate(byte_ids):
            self.labels[token] = bytes([byte])
            self.live[token] = True
        for i, (u, v, w) in enumerate(merges):
            if self.labels[w]:
                raise ValueError(f"two merges make token {w}")
            self.labels[w] = self.labels[u] + self.labels[v]
            self.left[w], self.made[w] = u, i
            if not (self.live[u] and self.live[v] and self.has(self.target[u], v)):
                continue
            self.live[w] = True
            self.start[w] = self.target[w] = self.target[v]
            self.taken[u << 32 | v] = i
            self.target[u] = len(self.owner)
            self.owner.append(u)
            self.born.append(i)
        self._trie()
        self.room = TABLE_LIMIT
        self.first = (((0, 0),), {})
        self.subsets = {self.first[0]: self.first}

    def has(self, state: int, token: int) -> bool:
        """Whether the state has an arc with this label.

        A state is a clone made for its owner's merge number ``born``: the owner's first state
        without the arcs that the owner's merges up to then took off. An arc that came after the
        state stands or falls with the arc of its left part.
        """
        if not self.live[token]:
            return False
        if not state:
            return True
        made, left, taken = self.made, self.left, self.taken
        owner, time = self.owner[state], self.born[state]
        while True:
            off = taken.get(owner << 32 | token)
            if off is not None and off <= time:
                return False
            came = made[token]
            if came < made[owner]:
                state = self.start[owner]
                if not state:
                    return True
                owner, time = self.owner[state], self.born[state]
            elif came < 0:
                return True
            else:
                time = min(time, came)
                token = left[token]

    def _trie(self) -> None:
        self.child: dict[int, int] = {}
        self.token_at = [-1]
        self.grows = [False]
        for token, label in enumerate(self.labels):
            if not label or not self.live[token]:
                continue
            node = 0
            for byte in label:
                key = node << 8 | byte
                below = self.child.get(key)
                if below is None:
                    below = self.child[key] = len(self.token_at)
                    self.token_at.append(-1)
                    self.grows.append(False)
                    self.grows[node] = True
                node = below
            self.token_at[node] = token

    def _step(self, subset: tuple, byte: int) -> tuple:
        """The table entry of a subset and a byte; kept while there is room in the table."""
        ending, kept = -1, []
        for state, node in subset[0]:
            below = self.child.get(node << 8 | byte)
            if below is None:
                continue
            token = self.token_at[below]
            if token >= 0 and self.has(state, token):
                ending = token
            if self.grows[below]:
                kept.append((state, below))
        kept.append((self.target[ending], 0))
        key = tuple(kept)
        after = self.subsets.get(key)
        if after is None:
            after = (key, {})
            if self.room > 0:
                self.subsets[key] = after
        entry = (after, ending)
        if self.room > 0:
            self.room -= 1
            subset[1][byte] = entry
        return entry

    def encode(self, word: bytes) -> list[int]:
        """Ids of one word: read the tables forward, then follow the token lengths back."""
        subset, ends = self.first, []
        for byte in word:
            subset, token = subset[1].get(byte) or self._step(subset, byte)
            ends.append(token)
        out, at, labels = [], len(word), self.labels
        while at:
            token = ends[at - 1]
            out.append(token)
            at -= len(labels[token])
        out.reverse()
        return out


class Codec:
    """Encoder and decoder of a byte-level tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splitter = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] or splitter["type"] != "ByteLevel" or splitter["add_prefix_space"]:
            raise ValueError("not a plain byte-level tokenizer")
        vocabulary, symbols = model["vocab"], byte_symbols()
        byte_ids = [0] * 256
        for symbol, byte in symbols.items():
            byte_ids[byte] = vocabulary[symbol]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        merges = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs]
        self.automaton = Automaton(byte_ids, merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = dict(enumerate(self.automaton.labels))
        self.labels |= {i: content.encode() for content, i in self.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.marks = re.compile("|".join(map(re.escape, longest_first)) or "(?!)")
        self.pattern = regex.compile(PATTERN)
        self.path, self._library = path, None
        codec = self

        class Words(dict):
            def __missing__(self, word: str) -> bytes:
                ids = np.array(codec.automaton.encode(word.encode()), "<u4").tobytes()
                if len(self) < WORD_LIMIT and len(word) < 64:
                    self[word] = ids
                return ids

        self.words = Words()

    def split(self, text: str) -> list[str]:
        """Words of a text; rare scripts are split by the library's own rule."""
        if _NOT_LATIN.search(text) is None:
            return _LATIN.findall(text)
        if _UNSETTLED.search(text) is None:
            return self.pattern.findall(text)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        word = self.words.__getitem__
        out, at = [], 0
        for mark in self.marks.finditer(text):
            out.extend(map(word, self.split(text[at : mark.start()])))
            out.append(self.special[mark[0]].to_bytes(4, "little"))
            at = mark.end()
        out.extend(map(word, self.split(text[at:] if at else text)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        labels = map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist())
        return b"".join(labels).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker process and tokenizer file."""
    return Codec(path)


def _mapped(df: DataFrame, source: str, made: dict[str, tuple[T.DataType, pa.DataType]], make) -> DataFrame:
    """Add columns that ``make`` computes from each value of another."""
    kept = [f for f in df.schema if f.name not in made]
    schema = T.StructType(kept + [T.StructField(n, kind) for n, (kind, _) in made.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [make(v) for v in batch.column(source).to_pylist()]
            columns = zip(*rows, strict=True) if rows else [[]] * len(made)
            arrays = [pa.array(c, a) for c, (_, a) in zip(columns, made.values(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + arrays, names=schema.names
            )

    bound_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


_IDS = (T.BinaryType(), pa.binary())
_TEXT = (T.StringType(), pa.string())


def encode(df: DataFrame, path: str, column: str = "text", into: str = "ids") -> DataFrame:
    """Add the ids of a text column, as little-endian unsigned 32-bit integers in a binary."""
    df = df.withColumn(column, whole(column))
    return _mapped(df, column, {into: _IDS}, lambda text: (codec(path).encode(text),))


def decode(df: DataFrame, path: str, column: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the text of a column of ids; NULL ids count as none."""
    df = df.withColumn(column, F.coalesce(F.col(column), F.lit(b"")))
    return _mapped(df, column, {into: _TEXT}, lambda ids: (codec(path).decode(ids),))


def round_trip(df: DataFrame, path: str, column: str = "text") -> DataFrame:
    """Add the ids of a text column and the text they decode to, by one worker per task."""

    def both(text: str) -> tuple[bytes, str]:
        ids = codec(path).encode(text)
        return ids, codec(path).decode(ids)

    df = df.withColumn(column, whole(column))
    return _mapped(df, column, {"ids": _IDS, "decoded": _TEXT}, both)
