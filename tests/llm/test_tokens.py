import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
import pytest

from matchlake.llm import token_counts, word_ids

ODD = [
    "", " ", "  ", "a  b", "\n\n x", "x \n y", " lead", "trail ", "<|endoftext|>", "a<|endoftext|> b<|startoftext|>", "<|endof text|>",
    "日本語 テキスト。 です", "It's we'll DON'T", "a" * 5000, "\t\ta", "🎉🎉 ok", "x\x1cy \x85 z", "½ ² ⅷ १२ é É", "ΑΣ σίγμαΣ",
    "İstanbul ǅ ß ŉ", "\0", "a\0b c", "x \0", "a　b", "\r\n\r\n", "a​b",
]
EVERY = [f"x{chr(i)}y {chr(i)} z" for i in range(0x3000)]
SPACES = st.text(alphabet=" \n\t\0ab'<|é .1", max_size=24)


@pytest.fixture(scope="module")
def byte_bpe(tokenizer):
    path = tokenizer("byte_bpe_50k.json")
    return token_counts.counter(path), token_counts.library(path)


@pytest.fixture(scope="module")
def word_bpe(tokenizer):
    path = tokenizer("word_bpe_49k.json")
    return word_ids.word_ids(path), word_ids.library(path)


def same_ids(ours, library, texts):
    ids, lengths = ours(texts)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [p.tolist() for p in np.split(ids, np.cumsum(lengths)[:-1])] == want


def same_counts(ours, library, texts):
    assert ours(texts).tolist() == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_of_odd_texts(byte_bpe):
    same_counts(*byte_bpe, ODD + EVERY)


def test_counts_of_the_corpus(byte_bpe, corpus):
    same_counts(*byte_bpe, [t for _, t in corpus])


def test_ids_of_odd_texts(word_bpe):
    same_ids(*word_bpe, ODD + EVERY)


def test_ids_of_the_corpus(word_bpe, corpus):
    same_ids(*word_bpe, [t for _, t in corpus])


def test_forgotten_words_are_learned_again(word_bpe, byte_bpe, corpus, monkeypatch):
    monkeypatch.setattr(word_ids, "REMEMBERED", 50)
    monkeypatch.setattr(token_counts, "REMEMBERED", 50)
    for k in range(0, 40, 4):
        same_ids(*word_bpe, [t for _, t in corpus[k : k + 4]])
        same_counts(*byte_bpe, [t for _, t in corpus[k : k + 4]])


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.one_of(SPACES, st.text(max_size=20)), min_size=1, max_size=4))
def test_any_texts(texts):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    same_counts(token_counts.counter(path), token_counts.library(path), texts)
    path = public.path("word_bpe_49k.json")
    same_ids(word_ids.word_ids(path), word_ids.library(path), texts)


def test_count_tokens_on_spark(spark, docs, tokenizer):
    pairs = [(1, None), (None, ""), (2, "one two"), (2, "one two"), (3, "é " * 600)]
    counted = token_counts.count_tokens(docs(pairs), tokenizer("byte_bpe_50k.json"))
    library = token_counts.library(tokenizer("byte_bpe_50k.json"))
    want = sorted(((i, len((t or "").encode()), len(library.encode(t or "").ids)) for i, t in pairs), key=repr)
    rows = counted.collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in rows), key=repr) == want
    assert {r.doc_id for r in rows if r.over_limit} == {3}
    assert token_counts.count_tokens(docs([]), tokenizer("byte_bpe_50k.json")).collect() == []
