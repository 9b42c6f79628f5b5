"""Token counts equal the library's."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tagwave.llm import token_counts as TC

PATH = public_tokenizers.path(TC.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)
BPE = TC.RaggedBPE(PATH)


def library(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aAbeth's \n\t\x1c\x85 　.!?01²é日\U0001f642<|endoftext>", max_size=40), min_size=1))
def test_equal_to_library(texts):
    assert BPE.count(texts) == library(texts)


@pytest.mark.parametrize("text", ["", "a" * 20_000, "ab" * 9_999, "<|endoftext|>", " <|endoftext|> x", "  x", "x  ",
                                  "'s'T're", "<|endoftext", "\n\n\n \n"])
def test_special_cases(text):
    assert BPE.count([text]) == library([text])


def test_overlapping_pairs_merge_left_to_right():
    words = [b"a" * k for k in range(1, 40)]
    assert BPE.merge(words).tolist() == library([w.decode() for w in words])


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(TC, "CACHE_SIZE", 50)
    bpe = TC.RaggedBPE(PATH)
    texts = [f"word{k} other{k * 7}" for k in range(300)]
    got = [n for k in range(0, 300, 10) for n in bpe.count(texts[k:k + 10])]
    assert got == library(texts) and len(bpe.cache) <= 60


def test_long_texts_are_read_in_blocks(monkeypatch):
    monkeypatch.setattr(TC, "BLOCK", 7)
    texts = ["some words and 12 more, " * 20, "short"]
    assert TC.RaggedBPE(PATH).count(texts) == library(texts)


def test_query_shape_and_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    got = sorted(TC.token_counts(docs).collect(), key=str)
    want = sorted(((i, len((t or "").encode()), n, n > 512) for (i, t), n in
                   zip(odd_rows, library([t or "" for _, t in odd_rows]))), key=lambda r: str(r))
    assert sorted(map(tuple, got), key=str) == want
    assert TC.token_counts(docs.limit(0)).count() == 0
