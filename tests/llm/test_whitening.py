"""Operator 12 against exact sums and a plain decomposition."""

from fractions import Fraction

import numpy as np
import pytest

from adloom.llm import whitening
from adloom.llm.queries import QUERIES
from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<float>, label int, n int, x string"


def make(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in vectors], SCHEMA).repartition(3)


def exact(vectors):
    """Distinct integer vectors, their sums, and the covariance in fractions."""
    x = sorted({tuple(int(np.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in v) for v in vectors})
    n, d = len(x), len(x[0])
    sums = [sum(v[i] for v in x) for i in range(d)]
    cov = np.array([[float(Fraction(sum((n * v[i] - sums[i]) * (n * v[j] - sums[j]) for v in x), n**3)) for j in range(d)] for i in range(d)])
    return x, n, sums, cov


def test_every_embedding(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    vectors = {r.vec_id: r.embedding for r in table.collect()}
    rows = whitening.whiten(table).collect()
    assert len(rows) == len(vectors)
    x, n, sums, cov = exact(list(vectors.values()))
    model = whitening.fit(whitening.usable(table, "vec_id", "embedding"))
    assert (model.n, model.sums) == (n, sums)
    values, vecs = np.linalg.eigh(cov)
    assert np.allclose(model.values, values[::-1][:16], rtol=1e-10)
    residual = cov @ model.vectors - model.vectors * model.values
    assert np.abs(residual).max() < 1e-11 * np.abs(cov).max()
    assert all(r.n == n and r.identity_error < 1e-8 for r in rows)
    for r in rows[:50]:
        ints = [int(np.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in vectors[r.vec_id]]
        assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(ints, sums))
        want = (np.array([float(Fraction(n * a - s, n)) for a, s in zip(ints, sums)]) @ model.vectors) / np.sqrt(model.values)
        assert np.allclose(r.whitened, want, rtol=1e-9, atol=1e-10)


def test_query_has_a_row_for_every_component(spark):
    out = QUERIES["op12_whitening"](spark, SF)
    assert set(out.columns) >= {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    rows = out.collect()
    assert sorted({r.component for r in rows}) == list(range(1, 17))
    assert len(rows) == 16 * spark.read.parquet(f"{SF}/embeddings.parquet").count()
    first = {r.component: r.explained for r in rows}
    assert all(first[k] >= first[k + 1] for k in range(1, 16))
    # The whitened rows of the distinct vectors have the identity as covariance, as told.
    table = {r.vec_id: tuple(r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    z = {}
    for r in rows:
        z.setdefault(table[r.vec_id], np.zeros(16))[r.component - 1] = r.whitened
    assert np.allclose(np.cov(np.array(list(z.values())).T, bias=True), np.eye(16), atol=1e-3)


def orthogonal(d, seed):
    """An orthogonal matrix to extended precision: a product of reflections."""
    q = np.eye(d, dtype=np.longdouble)
    for v in np.random.default_rng(seed).normal(size=(3, d)).astype(np.longdouble):
        q = q - 2 * np.outer(q @ v, v) / (v @ v)
    return q


@pytest.mark.parametrize("values", [
    [9, 5, 3, 2, 1, 0.5], [5, 5 - 1e-9, 5 - 3e-9, 2, 1, 0.1], [7, 1 + 1e-12, 1, 1 - 2e-12, 1 - 1e-7, 0.3], [4, 4, 4, 2, 2, 1], [1e8, 1, 1 - 1e-6, 1e-3, 1e-3 - 1e-9, 1e-9], [1, 1, 1, 1, 1, 1],
    [3, 1, 0, 0, 0, 0], [0] * 6,
])
def test_clusters_of_eigenvalues(values):
    d, want = len(values), np.array(values, np.longdouble)
    q = orthogonal(d, 1)
    a = (q * want) @ q.T
    a = (a + a.T) / 2
    got, x = whitening.refined(a)
    top = max(np.abs(want).max(), np.longdouble(1e-300))
    assert np.abs(got - want).max() <= 1e-17 * top
    assert np.abs(x.T @ x - np.eye(d)).max() < 1e-17
    assert np.abs(a @ x - x * got).max() <= 1e-17 * top
    for i in range(d):
        gap = np.abs(np.delete(want, i) - want[i]).min()
        if gap > 1e-15 * top:  # An eigenvector is known to the noise over its gap.
            assert 1 - abs(float(x[:, i] @ q[:, i])) < 1e-12
            assert min(np.abs(x[:, i] - q[:, i]).max(), np.abs(x[:, i] + q[:, i]).max()) < 1e-17 * float(top / gap) + 1e-17


def test_dropped_rows_copies_and_wide_values(spark):
    rng = np.random.default_rng(2)
    good = [(i, [float(x) for x in rng.normal(size=3)]) for i in range(40)]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [float("nan"), 1.0, 1.0]), (104, [float("inf"), 1.0, 1.0]), (105, [1.0, 2.0])]
    more = [*good, good[0], (200, good[0][1]), (None, good[1][1])]
    out = whitening.whiten(make(spark, [*more, *odd]), components=5).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in out) == sorted((i is None, i or 0) for i, _ in more)
    assert {r.n for r in out} == {40} and {len(r.whitened) for r in out} == {3}
    assert len({(tuple(r.whitened), r.deviation) for r in out if r.vec_id in (0, 200)}) == 1
    assert abs(sum(out[0].explained) - 1) < 1e-12 and out[0].identity_error < 1e-12


def test_degenerate_tables(spark):
    assert whitening.whiten(make(spark, [])).count() == 0
    assert whitening.whiten(make(spark, [(1, None)])).count() == 0
    one = whitening.whiten(make(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, [None, None], [None, None], None)] * 2
    line = whitening.whiten(make(spark, [(i, [float(i), float(i)]) for i in range(4)])).collect()
    assert all(r.whitened[1] is None and r.whitened[0] is not None for r in line) and line[0].explained[0] == 1.0
    huge = whitening.whiten(make(spark, [(1, [3e38, 1.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])])).collect()
    assert len(huge) == 3 and all(r.deviation is None for r in huge if r.vec_id < 3)


def test_products_of_wide_integers():
    y = np.array([[1 << 40, -(1 << 50)], [3, -7], [-(1 << 61), 5]], object)
    assert (whitening.products(y) == y.T @ y).all()
    small = np.array([[1, -2], [3, 4]])
    assert (whitening.products(small) == small.T @ small).all()
