"""Operator 3 against all pairs, and the components it uses."""

import random
from collections import Counter

import numpy as np

from adloom.llm import ngram_join as nj
from adloom.llm.components import components


def brute(rows):
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root, links = list(range(len(rows))), Counter()
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] | sets[j])
            if not both or len(sets[i] & sets[j]) / both >= 0.8:
                links[i] += 1
                links[j] += 1
                a, b = root[i], root[j]
                root = [a if r == b else r for r in root]
    least = {}
    for i, r in enumerate(root):
        least[r] = min(least.get(r, 10**9), rows[i][0])
    return sorted((rows[i][0], least[root[i]], links[i]) for i in range(len(rows)))


def corpus(seed, groups, size):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(60)]
        for _ in range(rng.randint(1, size)):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(60)] = word()
            rows.append((len(rows), " ".join(text)))
    return rows


def test_equals_all_pairs(spark, make, monkeypatch):
    for block in (1024, 4):
        monkeypatch.setattr(nj, "BLOCK", block)
        rows = corpus(3, 12, 14) + [(900, ""), (901, None), (902, "A b"), (903, "a  b"), (904, "c"), (905, None)]
        got = sorted((r.doc_id, r.class_id, r.n_links) for r in nj.join(make(rows)).collect())
        assert got == brute(rows)


def test_repeated_rows_and_null_ids(spark, make):
    text = "alpha beta gamma delta epsilon zeta"
    out = nj.join(make([(5, text), (5, text), (9, text.upper()), (None, text), (5, "quite another text of many words")])).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links, r.copies) for r in out if r.doc_id is not None) == [(5, 5, 0, 1), (5, 5, 2, 3), (5, 5, 2, 3), (9, 5, 2, 3)]
    assert [(r.class_id, r.n_links) for r in out if r.doc_id is None] == [(None, 0)]
    kept = nj.keep_one(make([(5, text), (5, text), (9, text.upper()), (None, text), (5, "quite another text of many words")]))
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(5, text), (None, text), (5, "quite another text of many words")])


def test_empty_table(spark, make):
    assert nj.join(make([(1, "a")]).limit(0)).count() == 0
    assert nj.keep_one(make([(1, "a")]).limit(0)).count() == 0


def test_pruning_keeps_likely_pairs():
    least = nj.least_matches(32)
    assert all(least[n] <= least[n + nj.STEP] for n in range(nj.STEP, nj.HASHES, nj.STEP))
    rng = np.random.default_rng(1)
    # Matches of pairs of likeness 0.8 after each step stay at or above the bound nearly always.
    draws = (rng.random((20000, nj.HASHES)) < 0.8).cumsum(1)
    lost = np.zeros(20000, bool)
    for n in range(nj.STEP, nj.HASHES + 1, nj.STEP):
        lost |= draws[:, n - 1] < least[n]
    assert lost.mean() < 1e-3
    assert least[nj.HASHES] > 0.5 * nj.HASHES


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(80)] + [(2000, 2001 + i) for i in range(50)]
    root = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(400):
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == root
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_roots():
    a, b = np.array([5, 4, 3, 2, 8]), np.array([4, 3, 2, 1, 9])
    assert nj.roots(11, a, b).tolist() == [0, 1, 1, 1, 1, 1, 6, 7, 8, 8, 10]


def test_pairs_of_unlike_sizes_only():
    sets = [np.arange(10, dtype=np.uint64), np.arange(30, dtype=np.uint64)]
    assert nj.exact_links(sets, np.array([0]), np.array([1])).tolist() == [False]
