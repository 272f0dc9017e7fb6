"""Token counts against the library."""

from __future__ import annotations

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from visitloom.llm import token_counts

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
SCHEMA = "doc_id long, text string"
TEXTS = [
    "", " ", "Hello, wörld's 123 WE'LL!!", "<|endoftext|>", "a<|startoftext|><|endoftext|>b <|END|>", "ΣΑΣ ΌΣΟΣ", "İstanbul ǅ ﬁ",
    "e\u0301 \u1100\u1161", "漢字かな \U0001f600\u200d\U0001f600", "\x00\x1c\x1d\x85\u00a0\u2028x", "a" * 5000, "½²Ⅷ٣", "it''s 'S's", "\u0345\u0390ŉ",
]
COUNTERS = {f: (token_counts.text_counter(public_tokenizers.path(f)), Tokenizer.from_file(public_tokenizers.path(f))) for f in FILES}


def library_count(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("file", FILES)
def test_chosen_texts(file):
    count, library = COUNTERS[file]
    assert [count(t) for t in TEXTS] == [library_count(library, t) for t in TEXTS]


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8", max_codepoint=0x2FF) | st.sampled_from(" 'sS\n"), max_size=60))
def test_any_latin_text(text):
    count, library = COUNTERS[FILES[0]]
    assert count(text) == library_count(library, text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_any_text(text):
    for count, library in COUNTERS.values():
        assert count(text) == library_count(library, text)


def test_query_on_test_documents(spark):
    path = public_tokenizers.path(FILES[0])
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    library = COUNTERS[FILES[0]][1]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in token_counts.count_tokens(docs, path).collect():
        assert r["n_tokens"] == library_count(library, texts[r["doc_id"]])
        assert r["n_bytes"] == len(texts[r["doc_id"]].encode())


def test_odd_rows(spark):
    path = public_tokenizers.path(FILES[0])
    docs = spark.createDataFrame([(1, None, 7), (None, "a b", 7), (2, "x", 7), (2, "x", 7)], SCHEMA + ", n_tokens long")
    found = sorted(map(tuple, token_counts.count_tokens(docs, path, 1).collect()), key=str)
    assert found == sorted([(1, 0, 0, False), (None, 3, 2, True), (2, 1, 1, False), (2, 1, 1, False)], key=str)
    assert token_counts.count_tokens(spark.createDataFrame([], SCHEMA), path).count() == 0


def test_merged_length_by_hand():
    # ab (rank 0) merges before bb (rank 1); equal pairs from the left.
    merges = {1 << 32 | 2: (0, 3), 2 << 32 | 2: (1, 4), 3 << 32 | 4: (2, 5)}
    assert token_counts.merged_length([1, 2, 2, 2], merges) == 1
    assert token_counts.merged_length([2, 2, 2], merges) == 2
    assert token_counts.merged_length([9], merges) == 1
