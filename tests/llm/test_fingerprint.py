"""Operator 1 against plain sets."""

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from adloom.llm import fingerprint as fp


def jaccard(a, b):
    x, y = set(fp.digests(a).tolist()), set(fp.digests(b).tolist())
    return len(x & y) / len(x | y) if x | y else 1.0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab .\n", max_size=400), min_size=2, max_size=6))
def test_likeness_is_exact(texts):
    sets = fp.Sets([fp.digests(t) for t in texts])
    first = np.arange(len(texts) - 1)
    assert np.allclose(fp.likeness(sets, first, first + 1), [jaccard(a, b) for a, b in zip(texts, texts[1:])])


def test_large_difference_retries_larger():
    a, b = (". ".join(f"{p} sentence number {i}" for i in range(3000)) for p in "xy")
    sets = fp.Sets([fp.digests(a), fp.digests(b), fp.digests(a + ". tail")])
    assert fp.likeness(sets, np.array([0, 0]), np.array([1, 2])).tolist() == [jaccard(a, b), jaccard(a, a + ". tail")]


def test_difference_peels_from_the_fingerprints_alone():
    a, b = fp.digests("one. two. three. four. five."), fp.digests("one. two. three. four. six.")
    sets = fp.Sets([a, b])
    x, y = (fp.sketch(*sets.take(np.array([k])), 1, fp.CELLS) for k in (0, 1))
    only_a, only_b, stuck = fp.peel(x[0] - y[0], x[1] - y[1], 1, fp.CELLS)
    assert (only_a[0], only_b[0], stuck[0]) == (1, 1, False)


def test_rows_follow_in_descending_order(spark, make, odd):
    rows = [r for r in odd if r != (4, odd[3][1])] + [(4, "other text of four"), (40, "x. y. z."), (41, "x. y. z.")]
    out = fp.compare(make(rows)).collect()
    assert len(out) == len(rows)
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(10**18)), r[1] or ""))
    want = []
    for i, (k, t) in enumerate(order):
        t, n = t or "", order[(i + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 3] + n[: len(t) // 3]
        want.append((k, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(jaccard(t, edited), 9), round(jaccard(t, n), 9)))
    got = [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in out]
    key = lambda r: (str(r[0]), r[2])
    assert sorted(got, key=key) == sorted(want, key=key)
    prints = {r.doc_id: r.fingerprint for r in out}
    assert prints[40] == prints[41] and prints[1] == prints[2] != prints[3]


def test_one_row_and_none(spark, make):
    (r,) = fp.compare(make([(7, "abc def ghi")])).collect()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"abc def abc").hexdigest()
    assert fp.compare(make([(7, "a")]).limit(0)).count() == 0
