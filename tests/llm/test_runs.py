"""Operator 11 against a plain search over all periods."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adloom.llm import runs
from adloom.llm.queries import QUERIES
from tests.conftest import SF


def plain(words):
    """(start, length, period) of all runs: for every period, the stretches that agree with themselves that far on."""
    w, found = np.array(words, object), {}
    for q in range(1, len(w) // 4 + 1):
        equal = np.r_[False, w[:-q] == w[q:], False].astype(int)
        for a, b in zip(np.flatnonzero(np.diff(equal) == 1), np.flatnonzero(np.diff(equal) == -1)):
            if b - a + q >= max(6, 4 * q):
                found.setdefault((int(a), int(b - a + q)), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def of(texts):
    """Runs of texts handled together."""
    ids = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    sizes = np.array([len(t) for t in texts])
    begin, end, period = runs.runs_of(np.array([ids[w] for t in texts for w in t], np.int64), sizes)
    offset, out = np.r_[0, np.cumsum(sizes)], []
    for a, b in zip(offset[:-1], offset[1:]):
        out.append([(int(s - a), int(e - s), int(q)) for s, e, q in zip(begin, end, period) if a <= s < b])
    return out


texts = st.lists(st.one_of(
    st.lists(st.sampled_from("ab"), max_size=60), st.lists(st.sampled_from("abcdefgh"), max_size=60),
    st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(3, 9), st.lists(st.sampled_from("ab"), max_size=5)).map(lambda t: t[2] + t[0] * t[1] + t[2]),
), min_size=1, max_size=4)


@settings(max_examples=400, deadline=None)
@given(texts, st.booleans())
def test_random_words(some, twice):
    some = some * 2 if twice else some
    assert of(some) == [plain(t) for t in some]


def test_words_that_make_grammars_deep():
    a, b = ["a"], ["a", "b"]
    while len(b) < 3000:
        a, b = b, b + a
    marked = [w for i in range(400) for w in ("a", "b", "c", "d", str(i))]
    for words in (b, marked, ["x"] * 5000, [str(i) for i in range(1500)] * 3, [str(i) for i in range(700)] * 5, (["x"] * 40 + ["y"]) * 50):
        assert of([words]) == [plain(words)]


def test_fingerprints_that_lie(monkeypatch):
    """Every test of fingerprints says yes: what is kept is still compared word by word."""
    monkeypatch.setattr(runs.Prefixes, "same", lambda self, i, k, n: np.ones(np.broadcast(i, k, n).shape, bool))
    for words in ("a b a b a b a b a c d e f a a a a a a g".split(), "a b c d e f g h a b c d i j".split()):
        assert set(of([words])[0]) >= set(plain(words))
        assert all((s, n, q) in plain(words) for s, n, q in of([words])[0])


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain(words)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    most = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *most, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(plain_collapsed(words, found)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def compare(spark, sf):
    key = lambda r: tuple((x is not None, x or 0) if not isinstance(x, str) else x for x in r)
    out = QUERIES["op11_runs"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, out.select(COLUMNS).collect()), key=key) == sorted((expected(*r) for r in docs), key=key)
    return out


def test_every_document(spark):
    assert compare(spark, SF).where("n_runs > 0").count() > 5


def test_odd_rows(spark, make, odd, tmp_path):
    rows = [r for r in odd if r[0] != 5] + [(None, None), (7, " \t\x0b a b \x1c " * 9), (8, "w " * 4000), (9, "\n"), (10, "x y " * 6 + "z " * 6)]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    compare(spark, str(tmp_path))


def test_other_columns_and_long_texts(make, odd):
    out = runs.find(make(odd)).collect()
    assert len(out) == len(odd) and {"score", "hash", "lang"} <= set(out[0].asDict())
    long = next(r for r in out if r.doc_id == 5)
    words = odd[5][1].split()
    assert long.collapsed == plain_collapsed(words, [(r.start, r.length, r.period) for r in long.runs])
    assert runs.find(make(odd).limit(0)).count() == 0


@pytest.mark.parametrize("size", [1, 7])
def test_cuts_of_the_tests_change_nothing(monkeypatch, size):
    words = (["x", "y"] * 20 + ["z"]) * 6
    monkeypatch.setattr(runs, "TESTS", size)
    assert of([words, words[3:]]) == [plain(words), plain(words[3:])]
