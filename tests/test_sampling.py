"""Splits are disjoint, complete and of exact size; samples are reproducible."""

import pytest
from pyspark.sql import functions as F

from adloom.operators import clean, sampling
from adloom.operators.profile import equal_width_histogram, safe_corr
from adloom.plans import submission


@pytest.fixture(scope="module")
def ten(spark):
    return spark.range(10).select("id", (F.col("id") % 2).alias("y"))


def sizes(df):
    return {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}


def test_sequential(ten):
    out = sampling.sequential_split(ten, ["id"], valid_size=0.25, test_size=0.25)
    assert {r["id"]: r["split"] for r in out.collect()} == {i: "test" if i > 7 else "valid" if i > 5 else "train" for i in range(10)}
    assert sizes(sampling.sequential_split(ten, ["id"], test_size=3)) == {"train": 7, "test": 3}
    assert sizes(sampling.sequential_split(ten, ["id"])) == {"train": 10}


@pytest.mark.parametrize("n", [1, 8])
def test_random_is_the_same_under_any_partitioning(spark, partitions, n):
    partitions(n)
    df = spark.range(1000).repartition(n)
    out = sampling.random_split(df, "id", 0.1, 200)
    assert sizes(out) == {"train": 700, "valid": 100, "test": 200}
    first = sorted(r["id"] for r in out.where("split = 'valid'").collect())[:3]
    assert first == sorted(r["id"] for r in sampling.random_split(spark.range(1000), "id", 0.1, 200).where("split = 'valid'").collect())[:3]


def test_stratified_sizes_are_floors(spark):
    df = spark.range(1003).select("id", F.when(F.col("id") % 50 == 0, 1).otherwise(0).alias("y"))
    out = sampling.stratified_split(df, "id", "y")
    got = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert got == {(1, "train"): 15, (1, "valid"): 3, (1, "test"): 3, (0, "train"): 688, (0, "valid"): 147, (0, "test"): 147}


def test_exact_sample_beyond_the_heap(spark, monkeypatch):
    df = spark.range(500)
    want = {r["id"] for r in sampling.hash_sample(df, "id", 40).collect()}
    monkeypatch.setattr(sampling, "HEAP_ROWS", 10)
    got = {r["id"] for r in sampling.hash_sample(df, "id", 40).collect()}
    assert got == want and len(got) == 40
    assert sampling.first_rows(df, ["id"], 123).count() == 123
    assert sampling.first_rows(df, ["id"], 9999).count() == 500


def test_shuffle_keeps_rows(ten):
    a = [r["id"] for r in sampling.shuffle_rows(ten, "id", 0).collect()]
    b = [r["id"] for r in sampling.shuffle_rows(ten, "id", 1).collect()]
    assert sorted(a) == sorted(b) == list(range(10)) and a != b


def test_class_threshold(spark):
    raw = spark.createDataFrame([(-1.0,), (3.0,)], "s double")
    assert [r["c"] for r in clean.class_from_score(raw, "s", "c").collect()] == [0.0, 1.0]
    prob = spark.createDataFrame([(0.2,), (0.9,)], "s double")
    assert [r["c"] for r in clean.class_from_score(prob, "s", "c").collect()] == [0.2, 0.9]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (None, None), (1.0, "b")], "x double, t string")
    assert [tuple(r) for r in clean.fill_missing(df, {"x": 0.0, "t": ""}).collect()] == [(0.0, "a"), (0.0, ""), (1.0, "b")]


def test_constant_inputs(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "a double, b double")
    assert df.agg(safe_corr("a", "b")).first()[0] is None
    h = equal_width_histogram(df, "a").collect()
    assert sum(r["cnt"] for r in h) == 2 and min(r["low"] for r in h) == 1.5 and max(r["high"] for r in h) == 2.5


def test_bad_submission_is_not_written(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.5), (2, None)], "ID int, clicked double")
    got = {r["check"]: r["passed"] for r in submission.validate(df).collect()}
    assert got == {"columns": 1, "rows": 1, "nulls": 0, "range": 0}
    path = tmp_path / "out"
    with pytest.raises(ValueError, match="failed checks"):
        submission.submit(df, str(path))
    assert not path.exists()
    assert submission.validate(df.drop("clicked")).first()["passed"] == 0


def test_wide_correlation_equals_narrow(spark, monkeypatch):
    from adloom.operators import profile

    df = spark.range(50).select(*[((F.col("id") * (i + 3)) % 11).cast("double").alias(f"c{i}") for i in range(4)], F.lit(1.0).alias("k"))
    cols = ["c0", "c1", "c2", "c3", "k"]
    want = {(r["a"], r["b"]): r["corr"] for r in profile.correlation_matrix(df, cols).collect()}
    monkeypatch.setattr(profile, "WIDE_PAIRS", 3)
    got = {(r["a"], r["b"]): r["corr"] for r in profile.correlation_matrix(df, cols).collect()}
    assert got.keys() == want.keys() and len(got) == 25
    for key, value in want.items():
        assert got[key] == (None if value is None else pytest.approx(value))
