"""The factorization machine: its scores, what it may learn from, and held-out accuracy."""

import zlib

import numpy as np
import pyarrow as pa

from tests.llm.helpers import AWKWARD, clashing, documents
from tidemark.llm import queries, toxicity


def test_scores_are_the_formula():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(40)]
    of = lambda text: {int(b) for _, _, _, bs in toxicity.buckets(pa.array([text])) for b in bs}
    known = np.array(sorted(of(" ".join(words))))
    inputs, weights = np.zeros(toxicity.BUCKETS), np.zeros(toxicity.BUCKETS)
    factors = np.zeros((toxicity.BUCKETS, 4))
    inputs[known], weights[known] = rng.random(len(known)), rng.normal(0, 1, len(known))
    factors[known] = rng.normal(0, 1, (len(known), 4))
    machine = toxicity.Machine(-0.3, inputs, weights, factors)
    texts = [" ".join(rng.choice(words, rng.integers(0, 15))) for _ in range(30)] + ["", "W1, w1! unknown"]
    for text, score in zip(texts, machine.scores(pa.array(texts)), strict=True):
        on = [b for b in of(text) if inputs[b]]
        length = sum(inputs[b] ** 2 for b in on) ** 0.5
        x = {b: toxicity.LENGTH * inputs[b] / length for b in on}
        total = machine.bias + sum(weights[b] * x[b] for b in on)
        total += sum(factors[a] @ factors[b] * x[a] * x[b] for n, a in enumerate(on) for b in on[:n])
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-9


def test_pairs_are_learnt(spark):
    """Toxic only where an insult meets a group: no sum of single weights can tell that."""
    rng = np.random.default_rng(0)
    filler = [f"filler{i}" for i in range(20)]

    def made(n):
        texts, labels = [], []
        for _ in range(n):
            insult, group = rng.integers(0, 2, 2)
            words = [*rng.choice(filler, 5), *["insult"] * insult, *["group"] * group]
            rng.shuffle(words)
            texts.append(" ".join(words))
            # neither word alone, nor their number beyond one, decides
            labels.append(int(insult and group))
        return texts, labels

    texts, labels = made(1500)
    docs = documents(spark, texts)
    marks = spark.createDataFrame(list(enumerate(labels, 1)), "doc_id long, toxic int")
    machine = toxicity.train(docs, marks)
    fresh, truth = made(300)
    predicted = machine.scores(pa.array(fresh)) >= 0.5
    assert (predicted == np.array(truth)).mean() > 0.97


def test_words_that_tell_only_in_pairs_are_learnt_among_many(spark):
    """Toxic where exactly one of two words is there: alone, each of them says nothing; 100,000 others are noise."""
    rng = np.random.default_rng(5)

    def made(n):
        one, two = rng.integers(0, 2, n), rng.integers(0, 2, n)
        texts = [
            " ".join([*(f"n{w}" for w in rng.integers(0, 100_000, 12)), *["alpha"] * a, *["omega"] * b])
            for a, b in zip(one, two, strict=True)
        ]
        return texts, (one ^ two).tolist()

    texts, labels = made(6000)
    marks = spark.createDataFrame(list(enumerate(labels, 1)), "doc_id long, toxic int")
    machine = toxicity.train(documents(spark, texts), marks)
    fresh, truth = made(500)
    assert ((machine.scores(pa.array(fresh)) >= 0.5) == np.array(truth)).mean() > 0.9


def test_repeated_rows_do_not_weigh_or_pass_the_bound(spark, monkeypatch):
    docs = documents(spark, [f"word{i} text {i % 7}" for i in range(40)])
    marks = spark.createDataFrame([(i, i % 2) for i in range(1, 41)], "doc_id long, toxic int")
    many = docs.unionByName(docs.where("doc_id = 3").crossJoin(spark.range(500)).drop("id"))
    one, other = toxicity.train(docs, marks), toxicity.train(many, marks)
    assert one.bias == other.bias and (one.weights == other.weights).all()
    texts = spark.range(300).selectExpr("1L doc_id", "concat('text ', id) text")
    sizes = []
    monkeypatch.setattr(toxicity, "MAX_ROWS", 50)
    monkeypatch.setattr(toxicity, "fit", lambda rows, labels: sizes.append(len(rows)))
    toxicity.train(texts, marks)
    assert sizes == [50]


def test_awkward_rows_and_no_labels(spark):
    docs = clashing(documents(spark, AWKWARD)).unionByName(clashing(documents(spark, AWKWARD)))
    none = spark.createDataFrame([(None, 1), (1, None), (999, 1)], "doc_id long, toxic int")
    machine = toxicity.train(docs, none)
    rows = toxicity.score(docs, machine).collect()
    assert len(rows) == 2 * len(AWKWARD) and {r.score for r in rows} == {0.5}
    assert {r.predicted for r in rows} == {1}
    assert toxicity.score(docs.limit(0), machine).count() == 0
    assert toxicity.train(docs.limit(0), none).bias == 0.0


def test_held_out_labels_do_not_matter(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    flipped = labels.selectExpr(
        "doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - toxic, toxic) as toxic"
    )
    texts = pa.array([r.text for r in docs.collect()])
    one, other = (toxicity.train_open(docs, marks).scores(texts) for marks in (labels, flipped))
    assert (one == other).all()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    found = queries.toxicity_query(spark, folder).toPandas()
    assert len(found) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert found.score.between(0, 1).all() and (found.predicted == (found.score >= 0.3)).all()
    held = found.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)
    assert (held == found.held_out).all()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    known = found[found.held_out].merge(labels, on="doc_id")
    ranks, toxic = known.score.rank(), known.toxic == 1
    n1, n0 = toxic.sum(), (~toxic).sum()
    assert (ranks[toxic].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.95
    assert known.predicted[toxic].mean() > 0.75 and known.predicted[~toxic].mean() < 0.03


def test_a_packed_machine_scores_the_same():
    """Workers get the buckets of the fitted rows alone, not all there could be."""
    texts = [f"word{n % 7} other{n % 5} {n}" for n in range(200)]
    rows = [np.unique(bucket[owner == n]).astype(np.int32) for _, c, owner, bucket in toxicity.buckets(pa.array(texts)) for n in range(c)]
    held = len(np.unique(np.concatenate(rows)))
    machine = toxicity.fit(rows, [n % 7 == 0 for n in range(200)])
    packed = machine.packed()
    assert len(packed.inputs) == len(packed.weights) == len(packed.factors) == held + 1
    shown = pa.array([*texts, "", "unknown strange word3"])
    assert (machine.scores(shown) == packed.scores(shown)).all()
