"""Operator 6: segments against brute force, and accuracy on held-out documents."""

import itertools

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from adloom.llm import toxicity as tox
from adloom.llm.queries import op6_toxicity
from tests.conftest import SF


def all_maximal(scores):
    """Segments by the definition: recursively the contiguous part of highest sum, then left and right of it."""

    def cut(lo, hi):
        best = max(((sum(scores[i:j]), -(j - i), -i) for i in range(lo, hi) for j in range(i + 1, hi + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return []
        i, j = -best[2], -best[2] - best[1]
        return [*cut(lo, i), (i, j - 1, best[0]), *cut(j, hi)]

    return cut(0, len(scores))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=14))
def test_segments_are_maximal(scores):
    values = np.array([s * 1.0 + (0.001 * 3**-i) for i, s in enumerate(scores)])
    at = np.flatnonzero(values > 0)
    base = (np.cumsum(values) - values)[at] if len(at) else np.zeros(0)
    got = [(int(at[a]), int(at[b]), round(s, 9)) for a, b, s in tox.segments(at, values[at] if len(at) else np.zeros(0), base)]
    assert got == [(a, b, round(s, 9)) for a, b, s in all_maximal(values.tolist())]


def test_equals_labels_on_held_out_rows(spark):
    sf = SF.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    out = op6_toxicity(spark, sf).join(labels, "doc_id").where("held_out").select("predicted", "toxic").collect()
    right = sum(r.predicted == r.toxic for r in out) / len(out)
    caught = [r.predicted for r in out if r.toxic == 1]
    assert right > 0.97 and sum(caught) / len(caught) > 0.85


def model(spark, make):
    docs = [(i, f"plain words number {i} are fine here") for i in range(40)] + [(100 + i, f"you awful vermin number {i} vermin awful") for i in range(40)]
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in docs] + [(None, 1), (5, None)], "doc_id long, toxic int")
    return tox.fit(make(docs), labels)


def test_odd_rows(spark, make, odd):
    fitted = model(spark, make)
    rows = [*odd, (50, "such awful vermin vermin awful"), (51, "plain words")]
    out = tox.score(make(rows), fitted).collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == len(rows) and got[50].predicted == 1 and got[51].predicted == 0
    assert got[1].score == got[2].score == 0.0 and got[50].passages[0].first == 1
    assert all(0 <= r.score <= 1 for r in out)
    assert tox.score(make(rows).limit(0), fitted).count() == 0


def test_nothing_to_learn_from(spark, make, odd):
    fitted = tox.fit(make(odd), spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.predicted for r in tox.score(make(odd), fitted).collect()} == {0}


def test_ties_keep_one_parting():
    fitted = tox.calibrate({"x": 1.0}, np.array([0.0, 0.0, 5.0, 5.0]), np.array([10.0] * 4), np.array([0, 0, 1, 1]))
    assert tox.chance(fitted, 5.0, 10) > 0.5 > tox.chance(fitted, 0.0, 10)
    assert all(a <= b for a, b in itertools.pairwise(tox.chance(fitted, s, 10) for s in (1.0, 2.0, 3.0, 6.0)))
