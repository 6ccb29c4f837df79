"""Words and shingles of whole texts, hashed in blocks over Arrow buffers.

A word is a maximal run of bytes other than ASCII white space (or, for ``letters``, of ASCII
letters and non-ASCII bytes, lower-cased). Word hashes come from prefix sums of
``T[byte] * B^position`` modulo 2^64, so a block of texts needs a fixed number of NumPy passes.
Every word of every text counts; a text longer than a block makes a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
WIDTH = 5
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.ones(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = False
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """B^i and B^-i modulo 2^64, grown to the longest block seen."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES)
            inverse = pow(_BASE, -1, 1 << 64)
            steps = np.empty((2, size + 1), np.uint64)
            steps[0], steps[1] = _BASE, inverse
            steps[:, 0] = 1
            with np.errstate(over="ignore"):
                self.up, self.down = np.cumprod(steps, axis=1, dtype=np.uint64)
        return self.up, self.down


_POWERS = _Powers()


@dataclass
class Block:
    """Words of some texts: hashes, and where each text's words begin (length texts + 1)."""

    first: int
    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    sums: np.ndarray


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column without NULLs."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return starts, np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)


def word_blocks(column: pa.Array, letters: bool = False) -> Iterator[Block]:
    """Hashed words of each text of a column, a block of texts at a time."""
    if not len(column):
        return
    offsets, data = text_buffers(column)
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        begin = offsets[first]
        yield _hash_words(first, data[begin : offsets[last]], offsets[first : last + 1] - begin, letters)
        first = last


def _hash_words(first: int, data: np.ndarray, offsets: np.ndarray, letters: bool) -> Block:
    inside = (_LETTER if letters else _SPACE)[data]
    n = len(data)
    if not n:
        none = np.empty(0, np.int64)
        return Block(first, none.astype(np.uint64), np.zeros(len(offsets), np.int64), none, none, none)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    edges = offsets[1:-1]
    before[edges[edges < n]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    up, down = _POWERS.upto(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTES[_LOWER[data] if letters else data] * up[:n], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * down[starts])
    return Block(first, hashes, np.searchsorted(starts, offsets), starts, ends, sums)


def prefix_hashes(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``size`` bytes of the longer words, and those words' numbers."""
    long = np.flatnonzero(block.ends - block.starts > size)
    starts = block.starts[long]
    _, down = _POWERS.upto(1)
    with np.errstate(over="ignore"):
        part = (block.sums[starts + size] - block.sums[starts]) * down[starts]
        return mix(part + _U(size)), long


def shingles(block: Block, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside each text, with bounds by text.

    A text of fewer words has one shingle of all its words; a text without words has none.
    """
    words, bounds = block.hashes, block.bounds
    counts = np.diff(bounds)
    made = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(made)])
    factors = [_U(pow(_BASE, k, 1 << 64)) for k in range(1, width + 1)]
    with np.errstate(over="ignore"):
        runs = len(words) - width + 1
        if runs > 0:
            rolled = words[:runs] * factors[0]
            for k in range(1, width):
                rolled += words[k : runs + k] * factors[k]
        texts = np.flatnonzero(counts >= width)
        out = np.empty(out_bounds[-1], np.uint64)
        inner = np.repeat(bounds[texts] - out_bounds[texts], made[texts])
        is_full = np.repeat(counts >= width, made)
        at = np.flatnonzero(is_full)
        if len(at):
            out[at] = mix(rolled[at + inner])
        for t in np.flatnonzero((counts > 0) & (counts < width)):
            own = words[bounds[t] : bounds[t + 1]]
            out[out_bounds[t]] = mix(
                np.array([sum(int(w) * int(f) for w, f in zip(own, factors, strict=False)) % (1 << 64) ^ len(own)], np.uint64)
            )[0]
    return out, out_bounds


def bag(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in ascending order, and how often each occurs."""
    return np.unique(hashes, return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags: sum of minima over sum of maxima.

    Two empty bags are alike (1.0).
    """
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 1.0
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    both = a[0][at] == b[0]
    shared = int(np.minimum(a[1][at[both]], b[1][both]).sum())
    return shared / (total - shared)
