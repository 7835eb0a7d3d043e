"""Lookups in tables too large to broadcast: hot and null keys, one narrow pass for many columns, softmax ranges."""

import math
import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from adloom.operators import joins
from adloom.operators import vectors as vec
from adloom.plans import encoder as plan


@pytest.fixture
def no_broadcast(spark):
    """No broadcast but those asked for, and shuffle partitions as they are rather than merged for being small."""
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture
def skewed(spark):
    """80 000 rows: one key holds half of them, 1 in 16 is null, the others have keys of their own."""
    key = F.when(F.col("id") % 2 == 0, F.lit(-1)).when(F.col("id") % 16 != 1, F.col("id"))
    return spark.range(0, 80_000, 1, 8).select("id", key.alias("k"))


def test_hot_hashes(spark, skewed):
    assert joins.hot_hashes(skewed, ["k"]) == [spark.range(1).select(F.xxhash64(F.lit(-1).cast("long"))).first()[0]]
    assert joins.hot_hashes(skewed.limit(0), ["k"]) == []
    assert joins.hot_hashes(spark.range(1000).select(F.lit(None).cast("long").alias("k")), ["k"]) == []


@pytest.mark.parametrize("how", ["left", "inner"])
def test_no_task_gets_the_hot_key(spark, skewed, no_broadcast, how):
    table = spark.range(-1, 60_000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    out = joins.cut_join(skewed, table, ["k"], how)
    rows = out.select("id", "k", "v", F.spark_partition_id().alias("p")).collect()
    want = {i: (-10 if i % 2 == 0 else i * 10 if i % 16 != 1 and i < 60_000 else None) for i in range(80_000)}
    if how == "inner":
        want = {i: v for i, v in want.items() if v is not None}
    assert {r.id: r.v for r in rows} == want and len(rows) == len(want)
    per_task = sorted(Counter(r.p for r in rows).values())
    assert per_task[-1] <= 2 * per_task[len(per_task) // 2]


def test_null_safe_and_repeated_entries(spark, no_broadcast):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("z", 4)], "k string, i int")
    table = spark.createDataFrame([(None, 7), ("a", 8), ("a", 9)], "k string, v int")
    got = sorted((r.i, r.v) for r in joins.cut_join(df, table, ["k"], "inner", null_safe=True).collect())
    assert got == [(1, 7), (2, 7), (3, 8), (3, 9)]
    assert sorted((r.i, r.v) for r in joins.cut_join(df, table, ["k"], "inner").collect()) == [(3, 8), (3, 9)]
    with pytest.raises(ValueError, match="how must be"):
        joins.cut_join(df, table, ["k"], "full")


def test_entries_too_large_to_broadcast_are_shuffled(spark, skewed, no_broadcast, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    table = spark.range(-1, 10).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    assert joins.cut_join(skewed, table, ["k"]).where("v = 1").count() == 40_000 + len([3, 5, 7, 9])


SPEC = [
    {"name": ["a", "b"], "type": "categorical", "dtype": "str"},
    {"name": "s", "type": "sequence", "dtype": "str", "splitter": ",", "max_len": 3},
    {"name": "t", "type": "sequence", "dtype": "str", "splitter": "|", "max_len": 4, "padding": "post", "share_embedding": "s"},
]


@pytest.fixture
def table(spark):
    rows = [(1, "x", None, "p,q,r,s", "p|q", "w1"), (2, "y", "m", "", None, "w2"), (3, None, "n", "q,,zz", "r", None), (2, "x", "m", "p", "s|", "w2")]
    return spark.createDataFrame(rows, "id int, a string, b string, s string, t string, payload string")


@pytest.mark.parametrize("tokens", [200_000, 2_000_000])
def test_many_large_columns_equal_small_ones(spark, table, no_broadcast, tokens):
    table = table.withColumn("row", F.monotonically_increasing_id())
    small = plan.fit(table, SPEC, [])
    large = replace(small, stats={k: replace(v, tokens=tokens) for k, v in small.stats.items()})
    want = sorted(map(str, small.transform(table, keep=["id", "payload"]).collect()))
    assert sorted(map(str, large.transform(table, keep=["id", "payload"]).collect())) == want
    assert large.transform(table.limit(0), keep=["id"]).count() == 0
    out = large.transform(table.withColumn("id", F.col("row").cast("int")), keep=["id", "payload"], id_col="id")
    assert out.columns == small.transform(table, keep=["id", "payload"]).columns


def test_wide_row_is_shuffled_once(spark, no_broadcast):
    df = spark.range(100).select("id", *[F.col("id").cast("string").alias(c) for c in ("a", "b", "s", "t")], F.lit("w").alias("payload"))
    fitted = plan.fit(df, SPEC, [])
    fitted = replace(fitted, stats={k: replace(v, tokens=2_000_000) for k, v in fitted.stats.items()})
    out = fitted.transform(df.withColumn("payload", F.concat("payload", F.rand().cast("string"))), keep=["id", "payload"], id_col="id")
    text = out._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    blocks = re.findall(r"^\(\d+\) Exchange\nInput[^\n]*", text, re.M)
    assert sum("payload" in b for b in blocks) == 1


@pytest.mark.parametrize("limit", [None, 0])
def test_softmax_over_a_wide_span_of_scores(spark, monkeypatch, limit, no_broadcast):
    if limit is not None:
        monkeypatch.setattr(joins, "BROADCAST_ROWS", limit)
    values = [-2000.0, -3.0, 0.0, 255.9, 256.1, 700.0, 700.5, 699.0]
    items = spark.createDataFrame([(e, [v, 1.0]) for e in ("hot", None) for v in values], "e string, v array<double>")
    targets = spark.createDataFrame([("hot", [1.0, 0.0]), (None, [-1.0, 0.0]), ("none", [1.0, 1.0])], "e string, t array<double>")
    got = {(r.e, r.dim): r.value for r in vec.target_attention(items, targets, "e", "v", "t", use_scale=False).collect()}
    for e, sign in (("hot", 1), (None, -1)):
        top = max(sign * v for v in values)
        w = [math.exp(sign * v - top) for v in values]
        assert got[e, 0] == pytest.approx(sum(a * b for a, b in zip(w, values)) / sum(w), rel=1e-12)
        assert got[e, 1] == pytest.approx(1.0)
    assert len(got) == 4
