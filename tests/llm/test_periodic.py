"""Periodic runs against a search of all stretches and lags."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from tests.llm.helpers import AWKWARD, clashing, documents
from tidemark.llm import periodic, queries


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if all(a == b for a, b in zip(words, words[q:])))


def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            first = i
            while i < n and words[i] == words[i - q]:
                i += 1
            start, length = first - q, i - first + q
            if length >= max(12, 2 * q) and smallest_period(words[start : start + length]) == q:
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_words(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_row(doc_id, text):
    words = brute_words(doc_id, text)
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(((-n, s, q) for s, n, q in runs), default=None)
    longest = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    told = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *longest, sha(told), sha(kept))


def runs_of(*texts):
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    ids = np.array([w for t in texts for w in t], np.int64)
    return [tuple(map(int, r)) for r in zip(*periodic.word_runs(ids, bounds), strict=True)]


def expected(*texts):
    out, at = [], 0
    for text in texts:
        out += [(s + at, n, q) for s, n, q in brute_runs(list(text))]
        at += len(text)
    return out


def woven(rng, n):
    """Words with repeats of repeats, of a few letters."""
    text = [rng.randrange(4) for _ in range(rng.randrange(1, 6))]
    while len(text) < n:
        kind = rng.randrange(4)
        if kind == 0:
            text += [rng.randrange(6) for _ in range(rng.randrange(1, 9))]
        elif kind == 1:
            text += text[-rng.randrange(1, len(text) + 1) :] * rng.randrange(1, 4)
        elif kind == 2:
            text += [rng.randrange(3)] * rng.randrange(1, 40)
        else:
            text += text[: rng.randrange(1, len(text) + 1)]
    return text[:n]


@pytest.mark.parametrize("seed", range(60))
def test_repeats_of_repeats(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(periodic, "PAIRS", rng.choice([1, 7, 100, 1 << 20]))
    texts = [woven(rng, rng.choice([0, 1, 13, 60, 150, 300])) for _ in range(rng.randrange(1, 4))]
    assert runs_of(*texts) == expected(*texts)


def test_thue_morse_and_fibonacci_words():
    morse = [bin(i).count("1") % 2 for i in range(512)]
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    assert runs_of(morse, b, b + morse) == expected(morse, b, b + morse)


def test_texts_do_not_run_into_each_other():
    assert runs_of([1] * 11, [1] * 11) == []
    assert runs_of([1] * 12, [1] * 12) == [(0, 12, 1), (12, 12, 1)]


def test_long_texts_of_few_words_stay_cheap():
    begin = time.process_time()
    n = 300_000
    assert runs_of([7] * n) == [(0, n, 1)]
    assert runs_of([1, 2, 3] * (n // 3)) == [(0, n, 3)]
    rng = random.Random(5)
    block = [rng.randrange(1000) for _ in range(n // 3)]
    assert (0, n, n // 3) in runs_of(block * 3)
    runs_of([rng.randrange(2) for _ in range(n)])
    assert time.process_time() - begin < 60


def test_query_against_brute_force(spark):
    rng = random.Random(9)
    prose = [" ".join(rng.choice(["a", "b", "the", "x\x1fy", "é"]) for _ in range(rng.randrange(0, 90))) for _ in range(150)]
    texts = [t for t in AWKWARD if len(t or "") < 10_000] + prose + ["a\tb\x0bc\x0cd\re \x1c f\xa0g " * 9]
    docs = clashing(documents(spark, texts))
    got = {r.doc_id: tuple(r) for r in queries.periodic_rows(docs).collect()}
    want = {i: brute_row(i, t) for i, t in enumerate(texts, 1)}
    assert got == want
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and t for i, t in enumerate(texts, 1))
    assert any(r[1] for r in want.values())


def test_awkward_rows(spark):
    docs = spark.createDataFrame([(None, "w " * 20), (None, "w " * 20), (1, None)], "doc_id long, text string")
    rows = sorted(tuple(r) for r in periodic.find_runs(docs).select("runs", "collapsed").collect())
    assert rows == [([], ""), ([(0, 20, 1)], "w"), ([(0, 20, 1)], "w")]
    assert queries.periodic_rows(docs.limit(0)).count() == 0
    assert queries.periodic_rows(docs).count() == 3
