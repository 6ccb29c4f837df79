"""Fingerprints: collision rates against generalised Jaccard, neighbours against a loop."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import AWKWARD, clashing, documents
from tidemark.llm import fingerprints as fp
from tidemark.llm import queries, text


def python_bag(words):
    if len(words) >= 5:
        return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    return Counter([tuple(words)]) if words else Counter()


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_weighted_collision_rate():
    rng = np.random.default_rng(5)
    errors = []
    for _ in range(400):
        terms = rng.integers(1, 1 << 63, 50, dtype=np.uint64)
        x, y = rng.integers(0, 9, 50), rng.integers(0, 9, 50)
        a, b = fp.signature(terms[x > 0], x[x > 0]), fp.signature(terms[y > 0], y[y > 0])
        errors.append(fp.likeness(a, b) - np.minimum(x, y).sum() / np.maximum(x, y).sum())
    assert abs(np.mean(errors)) < 4 * np.std(errors) / 20
    assert np.std(errors) < 1.3 * 0.5 / fp.SAMPLES**0.5


def test_shingles_are_runs_of_five_words():
    texts = ["a b c d e f a b c d e", "x", "", "a b", "b a", "a b c d e", " a\tb\nc  d e "]
    found = []
    for block in text.word_blocks(pa.array(texts)):
        hashes, bounds = text.shingles(block)
        found += [text.bag(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for one, bag in zip(texts, found, strict=True):
        assert sorted(bag[1].tolist()) == sorted(python_bag(one.split()).values())
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            expected = jaccard(python_bag(a.split()), python_bag(b.split()))
            assert text.overlap(found[i], found[j]) == (expected if a.strip() or b.strip() else 1.0)


def test_blocks_do_not_change_hashes(monkeypatch):
    texts = pa.array([t or "" for t in AWKWARD])
    whole = [s.tolist() for s in fp.signatures(texts)]
    monkeypatch.setattr(text, "BLOCK_BYTES", 7)
    assert [s.tolist() for s in fp.signatures(texts)] == whole
    assert [s.tolist() for s in fp.signatures(texts.slice(3))] == whole[3:]


def compared(rows):
    """What the query returns, row by row; rows are (doc_id, text) in descending order."""
    out = {}
    for i, (doc_id, own) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        third = len(own) // 3
        changed = own[: len(own) - third] + after[:third]
        signs = [fp.signatures(pa.array([t]))[0] for t in (own, changed, after)]
        out[doc_id] = (
            len(own),
            hashlib.sha256(changed.encode()).hexdigest(),
            fp.to_text(signs[0]),
            fp.to_text(signs[1]),
            fp.likeness(signs[0], signs[1]),
            fp.likeness(signs[0], signs[2]),
        )
    return out


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_neighbours(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        docs = clashing(documents(spark, AWKWARD))
        found = fp.compare_neighbours(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = [(i + 1, t or "") for i, t in reversed(list(enumerate(AWKWARD)))]
    assert {r[0]: tuple(r)[1:] for r in found} == compared(rows)


def test_one_row_repeated_ids_and_none(spark):
    (alone,) = fp.compare_neighbours(documents(spark, ["a b c d e f"])).collect()
    assert alone.near_next == 1.0
    docs = documents(spark, ["a b c d e f g h i", "x"]).selectExpr("cast(null as long) doc_id", "text")
    assert len(fp.compare_neighbours(docs.unionAll(docs)).collect()) == 4
    assert fp.compare_neighbours(docs.limit(0)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted(((r.doc_id, r.text) for r in docs), reverse=True)
    found = queries.fingerprint_query(spark, folder).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == compared(rows)
    long = [r for r in found if r.n_chars > 600]
    assert np.mean([r.near_edited - r.near_next for r in long]) > 0.3
