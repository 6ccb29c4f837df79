"""Packing: pieces against the library, plans against best-fit one document at a time."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.helpers import AWKWARD, clashing, documents
from tidemark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def pieces_of(text, capacity):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [0]
    data = np.array(ids, "<u4").tobytes()
    return [
        (n, at, min(capacity, len(ids) - at), zlib.crc32(data[4 * at : 4 * (at + capacity)]))
        for n, at in enumerate(range(0, len(ids), capacity))
    ]


def one_by_one(lengths, capacity):
    """Best-fit-decreasing, bin by bin."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [(room, i) for i, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting)[1]] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


def test_plan_equals_best_fit_by_document():
    for seed in range(60):
        rng = random.Random(seed)
        capacity = rng.choice([7, 20, 100])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 300))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        plan = packing.plan(counts, capacity)
        filled, taken = {}, {n: 0 for n in counts}
        for length, low, high, each, first, at in plan:
            assert low == taken[length]
            taken[length] = high
            for rank in range(high - low):
                filled.setdefault(first + rank // each, []).append((at + rank % each * length, length))
        assert taken == counts
        for places in filled.values():
            end = 0
            for offset, length in sorted(places):
                assert offset == end
                end += length
            assert end <= capacity
        assert len(filled) == one_by_one(lengths, capacity)


def test_plan_size_does_not_follow_counts():
    small = packing.plan({n: 1 + n % 7 for n in range(1, 2049)})
    large = packing.plan({n: (1 + n % 7) * 10**9 for n in range(1, 2049)})
    assert len(large) < 4 * len(small) < 2048 * 11 * 4


def check(found, texts, capacity):
    by_doc = {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    assert {d: sorted(p) for d, p in by_doc.items()} == {
        i: pieces_of(t, capacity) for i, t in enumerate(texts, 1)
    }
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(bins) == one_by_one([r.length for r in found], capacity)


def test_awkward_rows(spark):
    texts = AWKWARD + ["a\x1cb c", "İΣ <|endoftext|> x", "\x85 \xa0 x's DON'T ½²"]
    docs = clashing(documents(spark, texts))
    for capacity in (8, 2048):
        check(packing.pack(docs, PATH, capacity).collect(), texts, capacity)
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_repeated_rows_and_ids(spark):
    docs = documents(spark, ["one two three", "one two three"]).withColumnRenamed("doc_id", "x")
    docs = docs.selectExpr("cast(null as long) as doc_id", "text")
    found = packing.pack(docs.unionAll(docs), PATH).collect()
    assert len(found) == 4
    assert sorted((r.sequence_id, r.offset) for r in found) == [(0, 4 * i) for i in range(4)]


def test_known_chunks_are_the_librarys():
    encoder, rng = packing.encoder(PATH), random.Random(2)
    parts = ["a", "B", "ing", " ", "é", "É", "中", "\n", "1", "½", "!", "'s", "'S", "<|endoftext|>", "<|startoftext|>",
             "\x1c", "\x1f", "\x85", "\xa0", "᠎", "\xad", "ÀØ", "×", "µ", "ª", "ſ", "K", "Σ", "İ", "\x00"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))
        expected = LIBRARY.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == expected, text
