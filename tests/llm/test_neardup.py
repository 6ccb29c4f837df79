"""BagMinHash: unbiased signatures, and classes equal to those of all pairs."""

import random

import numpy as np
import pytest

from tests.llm import brute
from tests.llm.helpers import AWKWARD, clashing, documents
from tidemark.llm import components, neardup, queries


def test_weighted_collision_rate():
    rng = np.random.default_rng(5)
    errors = []
    for _ in range(400):
        terms = rng.integers(1, 1 << 63, 50, dtype=np.uint64)
        x, y = rng.integers(0, 20, 50), rng.integers(0, 20, 50)
        a, b = neardup.sketch(terms[x > 0], x[x > 0]), neardup.sketch(terms[y > 0], y[y > 0])
        errors.append((a == b).mean() - np.minimum(x, y).sum() / np.maximum(x, y).sum())
    assert abs(np.mean(errors)) < 4 * np.std(errors) / 20
    assert np.std(errors) < 1.3 * 0.5 / neardup.REGISTERS**0.5


def test_signatures_do_not_depend_on_the_horizon(monkeypatch):
    rng = np.random.default_rng(1)
    terms, counts = rng.integers(1, 1 << 63, 300, dtype=np.uint64), rng.integers(1, 40, 300)
    plain = neardup.sketch(terms, counts)
    shuffled = rng.permutation(300)
    assert (neardup.sketch(terms[shuffled], counts[shuffled]) == plain).all()
    log = np.log
    monkeypatch.setattr(neardup.np, "log", lambda x: log(x) + 20 if np.isscalar(x) else log(x))
    assert (neardup.sketch(terms, counts) == plain).all()


def edited(rng, words, share):
    return [rng.choice("pqrs") * 3 if rng.random() < share else w for w in words]


def corpus(seed):
    rng = random.Random(seed)
    texts = list(AWKWARD)
    for group in range(8):
        base = [f"g{group}w{rng.randint(0, 400)}" for _ in range(rng.choice([12, 80, 300]))]
        for _ in range(rng.choice([1, 2, 30])):
            texts.append(" ".join(edited(rng, base, rng.choice([0, 0.002, 0.01, 0.02, 0.05]))))
    # a chain whose ends are not alike, only each with the next
    chain = [f"c{i}" for i in range(200)]
    for step in range(12):
        texts.append(" ".join(f"x{i}" if i < step * 12 else w for i, w in enumerate(chain)))
    texts += [texts[12]] * 40
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("nodes, size, bucket", [(1, 10**6, 2), (4, 10**6, 4096), (1024, 5_000, 5), (1024, 10**7, 4096)])
def test_classes_equal_all_pairs(spark, nodes, size, bucket):
    texts = corpus(nodes)
    docs = clashing(documents(spark, texts))
    found = neardup.classes(docs, bucket_nodes=bucket, block_nodes=nodes, block_bytes=size).collect()
    assert {r.doc_id: r.class_id for r in found} == {
        i + 1: c + 1 for i, c in enumerate(brute.classes(texts))
    }


def test_one_document_of_each_class_stays(spark):
    texts = corpus(7)
    docs = clashing(documents(spark, texts))
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    expected = {c + 1 for c in brute.classes(texts)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    docs = documents(spark, ["a b c d e f", "a b c d e f", "other words here"])
    docs = docs.unionAll(docs).unionAll(docs.selectExpr("null", "text", "lang", "source", "n_chars"))
    found = neardup.classes(docs).collect()
    assert len(found) == 9
    assert sorted((r.class_id, r.class_rows) for r in found) == [(1, 6)] * 6 + [(3, 3)] * 3
    assert sorted(r.doc_id for r in neardup.keep_one(docs).collect()) == [1, 3]
    assert neardup.classes(docs.limit(0)).count() == neardup.keep_one(docs.limit(0)).count() == 0


def test_shared_boilerplate_makes_no_families(spark):
    """Pages with 130 of 330 words in common are far from near copies and are hardly ever compared."""
    rng = random.Random(8)
    shared = [f"menu{i}" for i in range(130)]
    texts = [" ".join(shared + [f"w{rng.randint(0, 10**6)}" for _ in range(200)]) for _ in range(800)]
    docs = neardup.with_node(documents(spark, texts + texts[:1]))
    signed = neardup.signatures(docs)
    rows = neardup.buckets(signed)
    assert rows.select("node").distinct().count() > 400
    links = neardup.bucket_links(rows, signed)
    nodes = links.selectExpr("explode(array(a, b)) node").distinct()
    sizes = [r["count"] for r in components.components(nodes, links).groupBy("comp").count().collect()]
    assert sum(n * (n - 1) // 2 for n in sizes) < 0.01 * 800 * 799 / 2


def test_similar_nodes_are_linked_and_others_apart():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 256, (5, 128))
    marks = np.concatenate([np.where(rng.random((40, 128)) < 0.2, rng.integers(0, 256, (40, 128)), b) for b in base])
    nodes = [bytes([n]) for n in range(len(marks))]
    joined = {n: {n} for n in nodes}
    for a, b in neardup.similar(nodes, marks.astype(np.uint8)):
        both = joined[a] | joined[b]
        for n in both:
            joined[n] = both
    agree = (marks[:, None] == marks[None]).mean(axis=2)
    for i, j in zip(*np.nonzero(agree >= neardup.AGREEMENT), strict=True):
        assert nodes[j] in joined[nodes[i]]
    assert sorted(len(s) for s in {frozenset(s) for s in joined.values()}) == [40] * 5


def test_components(spark):
    rng = random.Random(2)
    names = [rng.randbytes(16) for _ in range(300)]
    edges = [(names[i], names[i + 1]) for i in range(150) if i != 70] + [(names[200], names[i]) for i in range(200, 260)]
    nodes = spark.createDataFrame([(bytearray(n),) for n in names], "node binary")
    links = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in edges], "a binary, b binary")
    groups = {}
    for r in components.components(nodes, links.unionAll(links)).collect():
        groups.setdefault(bytes(r.comp), set()).add(bytes(r.node))
    sizes = sorted(map(len, groups.values()))
    assert sizes == [1] * (300 - 151 - 60) + [60, 71, 80]
    assert set(names[:71]) in groups.values()


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    expected = {docs[i].doc_id: docs[c].doc_id for i, c in enumerate(brute.classes([d.text for d in docs]))}
    assert {r.doc_id: r.class_id for r in queries.neardup_query(spark, folder).collect()} == expected
