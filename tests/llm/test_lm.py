"""Operator 5 against counts in plain code, and its sequences against sorted arrays."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adloom.llm import lm
from adloom.llm.elias_fano import EliasFano, Trie, quantise, restore


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1 << 30), max_size=80), st.integers(1, 1 << 20))
def test_sequence_equals_sorted_array(values, extra):
    values = np.sort(np.array(values, np.uint64))
    universe = int(values[-1]) + extra if len(values) else extra
    seq = EliasFano.load(EliasFano.of(values, universe).dump())
    assert np.array_equal(seq.access(np.arange(len(values))), values)
    x = np.unique(np.r_[values, values[values > 0] - np.uint64(1), np.array([0, universe - 1], np.uint64)]).astype(np.uint64)
    assert np.array_equal(seq.successor(x), np.searchsorted(values, x))
    assert np.array_equal(seq.find(x) >= 0, np.isin(x, values))


def test_trie_finds_pairs_and_only_them():
    rng = np.random.default_rng(2)
    pairs = np.unique(rng.integers(0, 60, (400, 2)).astype(np.uint64) * np.uint64(1 << 40), axis=0)
    trie = Trie.of(pairs[:, 0], pairs[:, 1], -np.arange(len(pairs)) / 100, 48)
    assert np.array_equal(trie.find(pairs[:, 0], pairs[:, 1]), np.arange(len(pairs)))
    every = np.array([(a, b) for a in range(61) for b in range(61)], np.uint64) * np.uint64(1 << 40)
    known = {tuple(p) for p in pairs.tolist()}
    assert ((trie.find(every[:, 0], every[:, 1]) >= 0) == [tuple(p) in known for p in every.tolist()]).all()
    assert np.abs(restore(quantise(np.array([-0.5, -15.0, 0.0]))) + [0.5, 15.0, 0.0]).max() < 2e-4
    assert (Trie.of(*[np.zeros(0, np.uint64)] * 2, np.zeros(0), 48).find(pairs[:, 0], pairs[:, 1]) == -1).all()


def plain(rows):
    """Scores by the definition: (id, tokens, known, N, base, score)."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) for _, t, _ in rows]
    c, b, s = Counter(), Counter(), Counter()
    for (_, _, train), w in zip(rows, words, strict=True):
        if train:
            c.update([*w, None])
            b.update(zip([None, *w], [*w, None], strict=True))
    for u, _ in b:
        s[u] += 1
    n, v = sum(c.values()), len(c)
    p = lambda w: (c[w] - lm.D) / n if c[w] else (lm.D * v / n if n else 1)
    out = []
    for (k, _, _), w in zip(rows, words, strict=True):
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in [*w, None])
        score = 0.0
        for u, x in zip([None, *w], [*w, None], strict=True):
            score += math.log10((b[u, x] - lm.D) / c[u] if b[u, x] else (lm.D * s[u] / c[u] if c[u] else 1) * p(x))
        out.append((k, len(w) + 1, sum(c[x] > 0 for x in [*w, None]), n, base, score))
    return out


def agree(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(3)
    out = lm.score(df, "train", keep=["doc_id"]).collect()
    key = lambda r: (str(r[0]), r[1], round(r[4], 4))
    got, want = (sorted(x, key=key) for x in ([tuple(r) for r in out], plain(rows)))
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], abs=1e-9) and g[5] == pytest.approx(w[5], abs=3e-4 * w[1])


def test_equals_counts(spark, odd, monkeypatch):
    texts = ["the cat sat", "The cat ran", "the the the", "a dog sat the cat", "", None, "NEW words only", "the\tcat\x0bsat é\x1cb"] * 4
    rows = [(i, t, i % 3 != 0) for i, t in enumerate(texts)] + [(i, t, (i or 0) % 2 == 0) for i, t in odd]
    agree(spark, rows)
    # Small slices, and every common word spread over the shards.
    monkeypatch.setattr(lm, "SLICE_ROWS", 3)
    monkeypatch.setattr(lm, "hot_words", lambda docs, shards: np.unique(np.array([lm.MARK, *(lm.Hashes()[w] for w in (b"the", b"cat", b"none"))], np.uint64)))
    agree(spark, rows)


def test_nothing_to_learn_from(spark):
    agree(spark, [(1, "a b", False), (2, None, None)])
    empty = spark.createDataFrame([], "doc_id long, text string, train boolean")
    assert lm.score(empty, "train", keep=["doc_id"]).count() == 0


def test_passes_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "a b", True, "x", [1])], "doc_id long, text string, train boolean, kind string, shard array<int>")
    out = lm.score(df, "train")
    assert out.columns[:4] == ["doc_id", "train", "kind", "shard"] and out.first().shard == [1]
