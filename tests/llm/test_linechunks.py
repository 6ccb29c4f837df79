"""Line chunks against a loop over documents in order of id."""

import random

from tests.llm import brute
from tests.llm.helpers import AWKWARD, clashing, documents
from tidemark.llm import linechunks as lc
from tidemark.llm import queries


def line(rng, words):
    return " ".join(f"w{rng.randint(0, 9999)}" for _ in range(words))


def test_every_run_that_counts_holds_a_boundary():
    rng = random.Random(3)
    for _ in range(200):
        lines = lc.Lines("\n".join(line(rng, rng.choice([0, 1, 4, 8, 25, 60])) for _ in range(rng.randint(0, 40))))
        found = lines.boundaries()
        for first in range(len(lines.words)):
            for count in range(1, len(lines.words) - first + 1):
                if lc.counts(count, sum(lines.words[first : first + count])):
                    assert any(first <= f and f + c <= first + count for f, c in found)


def test_boundaries_depend_on_near_lines_only():
    rng = random.Random(1)
    passage = [line(rng, 6) for _ in range(40)]

    def inside(before, after):
        at = len(before)
        found = lc.Lines("\n".join(before + passage + after)).boundaries()
        # those that a least run within the passage chose
        return {(f - at, c) for f, c in found if at <= f and f + c <= at + len(passage)}

    plain = inside([], [])
    for _ in range(20):
        moved = inside([line(rng, 5) for _ in range(rng.randint(1, 9))], [line(rng, 7) for _ in range(3)])
        assert plain <= moved and len(moved - plain) <= 4


def test_chunks_are_no_longer_than_their_texts():
    rng = random.Random(2)
    for words, share in ((3, 1.4), (5, 1.1), (9, 0.6), (30, 0.3)):
        text = "\n".join(line(rng, words) for _ in range(2000))
        held = sum(len(left) + len(right) for *_, left, right in lc.chunks(text))
        assert held < share * len(text)


def corpus():
    rng = random.Random(5)
    passage = "\n".join(line(rng, 30) for _ in range(4))
    long = line(rng, 80)
    texts = list(AWKWARD)
    for n in range(60):
        own = [line(rng, rng.choice([5, 20])) for _ in range(rng.randint(1, 8))]
        if n % 3 == 0:
            own.insert(rng.randint(0, len(own)), passage)
        if n % 4 == 0:
            own.insert(rng.randint(0, len(own)), long)
        texts.append("\n".join(own))
    texts += [texts[-1]] * 5 + [f"{passage}\n{passage}"]
    return texts, long


def test_repeats_go_and_the_first_stays(spark):
    texts, long = corpus()
    docs = clashing(documents(spark, texts)).drop("hash").withColumnRenamed("key", "hash")
    rows = {r.doc_id: r for r in lc.dedup(docs).collect()}
    expected = brute.without_repeats([(i, t or "") for i, t in enumerate(texts, 1)])
    assert {i: r.text for i, r in rows.items()} == expected
    assert all(r.n_chars == len(r.text) for r in rows.values())
    assert sum(long in r.text for r in rows.values()) == 1
    # texts without repeated chunks are untouched
    assert all(rows[i].text == (t or "") for i, t in enumerate(texts, 1) if not rows[i].removed_lines)


def test_equal_hashes_are_compared_byte_by_byte(spark, monkeypatch):
    from pyspark import cloudpickle

    import tidemark.llm.linechunks as module

    texts, _ = corpus()
    constant = lambda size: (lambda *_: b"\0" * size)
    monkeypatch.setattr(module, "digest", constant(16))
    monkeypatch.setattr(module.Lines, "_record", constant(module.RECORD))
    cloudpickle.register_pickle_by_value(module)
    try:
        rows = lc.dedup(documents(spark, texts)).collect()
    finally:
        cloudpickle.unregister_pickle_by_value(module)
    # with all hashes equal everything is matched with the first chunk, and only what is equal goes
    expected = brute.without_repeats([(i, t or "") for i, t in enumerate(texts, 1)])
    for r in rows:
        text = (texts[r.doc_id - 1] or "").split("\n")
        assert len(text) >= len(r.text.split("\n")) >= len(expected[r.doc_id].split("\n"))


def test_repeated_rows_null_ids_and_empty_tables(spark):
    text = "\n".join(f"some line of ten words number {i} a b c" for i in range(12))
    docs = documents(spark, [text, text])
    docs = docs.unionAll(docs).unionAll(docs.selectExpr("null", "text", "lang", "source", "n_chars"))
    found = lc.dedup(docs).collect()
    assert len(found) == 6
    kept = {(r.doc_id, r.text == text) for r in found}
    assert kept == {(None, True), (1, False), (2, False)}
    assert lc.dedup(docs.limit(0)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r.text for r in queries.linechunk_query(spark, folder).collect()}
    assert found == brute.without_repeats([tuple(d) for d in docs])


def test_planted_passages_go_whole(spark):
    """Short passages of several lines, each among other lines every time: all lines of later copies go."""
    rng = random.Random(11)
    shapes = [(2, 28), (3, 25), (4, 30), (12, 5), (2, 10), (1, 51)]
    passages = [[line(rng, words) for _ in range(count)] for count, words in shapes * 3]
    texts = []
    for copy in range(4):
        for passage in passages:
            own = [line(rng, rng.choice([3, 9, 30])) for _ in range(rng.randint(2, 9))]
            at = rng.randint(0, len(own))
            texts.append("\n".join(own[:at] + passage + own[at:]))
    rows = list(enumerate(texts, 1))
    gone = brute.repeated_lines(rows)
    assert sum(map(len, gone.values())) == 3 * sum(map(len, passages))
    found = {r.doc_id: r for r in lc.dedup(documents(spark, texts)).collect()}
    for i, text in rows:
        kept = [x for n, x in enumerate(text.split("\n")) if n not in gone[i]]
        assert found[i].text == "\n".join(kept)
        assert found[i].removed_lines == len(gone[i])


def test_chunks_stay_few_among_empty_lines():
    words = "\n".join(f"word{n}" for n in range(30))
    assert len(list(lc.chunks(words + "\n" * 20_000 + words + "\n" * 20_000))) < 200
