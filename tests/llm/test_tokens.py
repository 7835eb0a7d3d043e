"""Operator 2 against the library it must equal."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adloom.llm import bpe
from adloom.llm.queries import tokenizer_path
from tests.conftest import SF

PATH = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def coder():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Coder(bpe.vocabulary(f.read()))


def agree(library, coder, texts):
    for text, raw, shown in zip(texts, *coder.code(texts), strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(raw, "<u4").tolist() == ids, text
        assert shown == library.decode(ids, skip_special_tokens=False), text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abcdefghinorst 'ÀéßΣσςİ\x1c\x85　漢12½!?<|>\n\0")), max_size=8))
def test_random_texts(library, coder, texts):
    agree(library, coder, texts)


def test_special_tokens_and_runs(library, coder):
    agree(library, coder, ["", " ", "a<|endoftext|>B", "<|startoftext|>", "a" * 5000, "it's we'll THEÅngström", "x́é" * 50])


def test_every_document(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in bpe.digest(docs, PATH).collect()}
    assert len(got) == docs.count()
    for r in docs.collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_forgetting_words_changes_nothing(monkeypatch, coder, library):
    monkeypatch.setattr(bpe, "MEMORY_WORDS", 3)
    monkeypatch.setattr(bpe, "MEMORY_PAIRS", 2)
    for _ in range(2):
        agree(library, bpe.Coder(coder.vocab), ["one two three four five", "two six seven", "one"])


def test_odd_rows(spark, make, odd, library):
    out = bpe.encode(make(odd), PATH).collect()
    assert len(out) == len(odd)
    assert {tuple(r.ids) for r in out if r.doc_id in (1, 2)} == {()}
    assert bpe.encode(make(odd).limit(0), PATH).count() == 0
    assert [r.ids for r in out if r.doc_id == 5] == [library.encode(odd[5][1], add_special_tokens=False).ids]


def test_decode_of_ids(coder, library):
    ids = library.encode("some words <|endoftext|>", add_special_tokens=False).ids
    assert bpe.decode(ids, coder.vocab) == library.decode(ids, skip_special_tokens=False)


def test_ids_beside_their_digests(make, library):
    rows = bpe.digest(make([(1, "some words"), (2, None)]), PATH, ids=True).collect()
    assert {r.doc_id: list(r.ids) for r in rows} == {1: library.encode("some words", add_special_tokens=False).ids, 2: []}
    assert all(r.n_tokens == len(r.ids) for r in rows)
