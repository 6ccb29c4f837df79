"""Automaton encoding against the tokenizers library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import AWKWARD, clashing, documents
from tidemark.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
CODEC = bpe.codec(PATH)
PIECES = ["a", "b", "aa", " ", "  ", "the", "ing", "é", "中", "\n", "1", "½", "!", "'s", "'S", "\x1c", "\x85",
          "\xa0", "՘", "࢏", "<|endoftext|>", "<|endof", "\U0001f600", "ation", "\t", "ª", "µ"]


def theirs(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def ours(text):
    return np.frombuffer(CODEC.encode(text), "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(PIECES), max_size=40).map("".join)))
def test_ids_and_text_are_the_librarys(text):
    assert ours(text) == theirs(text)
    assert CODEC.decode(CODEC.encode(text)) == LIBRARY.decode(theirs(text), skip_special_tokens=False)


def test_tables_may_be_full():
    codec = bpe.Codec(PATH)
    codec.automaton.room = 50
    for word in ("internationalisation", " unbelievably", "aaaaaaaaaaaaaaaaaaa", " éèê"):
        assert codec.automaton.encode(word.encode()) == theirs(word)


def test_gadgets_of_a_toy_vocabulary():
    # bytes a, b (0, 1 here) and the merges aa, ab: "aab" is aa b, "abab" is ab ab
    ids = [0] * 256
    ids[97], ids[98] = 0, 1
    for byte in range(256):
        if byte not in (97, 98):
            ids[byte] = byte + 10
    machine = bpe.Automaton(ids, [(0, 0, 2), (0, 1, 3)])
    assert [machine.encode(w) for w in (b"aab", b"abab", b"aaa", b"aaab")] == [[2, 1], [3, 3], [2, 0], [2, 3]]


def test_awkward_rows(spark):
    docs = clashing(documents(spark, AWKWARD))
    found = {r.doc_id: r for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    assert len(found) == len(AWKWARD)
    for i, text in enumerate(AWKWARD, 1):
        assert np.frombuffer(bytes(found[i].ids), "<u4").tolist() == theirs(text or "")
        assert found[i].decoded == (text or "")
    assert bpe.encode(docs.limit(0), PATH).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    found = queries.bpe_query(spark, folder).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = theirs(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
