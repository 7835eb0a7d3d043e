"""Distributed order statistics: exactness under any partitioning, ties, hot groups, plan shape."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adloom.operators import quantiles as qt
from adloom.operators.quantiles import interpolated_quantiles, weighted_values
from adloom.operators.ranking import keys_at_ranks, running_totals, with_bucket, with_rank, with_row_index


@pytest.fixture(scope="module")
def hot(spark):
    """3 000 rows; one group holds a third of them, the others are small."""
    rng = random.Random(5)
    rows = [(i, "hot" if i % 3 == 0 else f"g{rng.randrange(200)}", rng.randrange(-50, 50)) for i in range(3000)]
    return spark.createDataFrame(rows, "id int, g string, x int").cache(), rows


@pytest.mark.parametrize("n", [1, 3, 8])
def test_rank_matches_sorting(hot, partitions, n):
    partitions(n)
    df, rows = hot
    got = {r["id"]: r["rank"] for r in with_rank(df, ["x", "id"], ["g"]).collect()}
    want, seen = {}, {}
    for i, g, x in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        seen[g] = seen.get(g, 0) + 1
        want[i] = seen[g]
    assert got == want


@pytest.mark.parametrize("buckets", [1, 2, 7, 500])
def test_row_index_is_dense_for_any_bucket_count(hot, buckets):
    df, rows = hot
    got = with_rank(df, ["x", "id"], buckets=buckets).orderBy("x", "id").collect()
    assert [r["rank"] for r in got] == list(range(1, len(rows) + 1))


def test_row_index_starts_at_zero(hot):
    df, rows = hot
    r = with_row_index(df, ["id"]).agg(F.min("row_idx"), F.max("row_idx"), F.countDistinct("row_idx")).first()
    assert tuple(r) == (0, len(rows) - 1, len(rows))


def test_running_totals(hot):
    df, rows = hot
    got = {r["id"]: r["t"] for r in running_totals(df, ["id"], {"t": "x"}).collect()}
    total, want = 0, {}
    for i, _, x in rows:
        total += x
        want[i] = total
    assert got == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "id int, g string")
    assert with_rank(df, ["id"], ["g"]).count() == 0
    assert keys_at_ranks(df, ["id"], {"a": F.lit(1)}, ["g"]).count() == 0


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, g string")
    got = {r["id"]: r["rank"] for r in with_rank(df, ["id"], ["g"]).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_hot_group_spreads_over_buckets(hot):
    df, rows = hot
    sizes = with_bucket(df, ["g", "x", "id"], 16).groupBy("_bucket").count().collect()
    assert max(r["count"] for r in sizes) < len(rows) / 4


def test_keys_at_ranks(hot):
    df, rows = hot
    got = keys_at_ranks(df, ["x", "id"], {"first": F.lit(1), "last": F.col("_total"), "none": F.col("_total") + 1}, ["g"]).collect()
    for r in got:
        mine = sorted((x, i) for i, g, x in rows if g == r["g"])
        assert tuple(r["first"]) == mine[0] and tuple(r["last"]) == mine[-1] and r["none"] is None


def test_quantiles_with_dominant_value(spark):
    values = [0.0] * 400 + [float(i) for i in range(1, 601)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = interpolated_quantiles(weighted_values(df, ["v"]), {"a": 0.1, "b": 0.5, "c": 0.995}).first()
    import numpy as np

    assert [got["a"], got["b"], got["c"]] == pytest.approx(list(np.quantile(values, [0.1, 0.5, 0.995])))


def test_only_bucket_totals_meet_in_one_partition(hot):
    df, _ = hot
    plan = with_rank(df, ["x", "id"])._jdf.queryExecution().executedPlan().toString()
    for part in plan.split("Exchange SinglePartition")[1:]:
        below = part.split("\n")[1]
        bounded = ("HashAggregate(keys=[_bucket", "collect_list", "TakeOrdered", "partial_approx_count_distinct")
        assert any(b in below for b in bounded), below


def test_wide_table(spark):
    """More columns than Spark generates code for."""
    df = spark.range(300).select("id", *[(F.col("id") * i % 7).alias(f"c{i}") for i in range(150)])
    got = with_row_index(df, ["c3", "id"]).orderBy("c3", "id").select("row_idx").collect()
    assert [r[0] for r in got] == list(range(300))


def test_release_deletes_only_own_tables(spark):
    import os

    from adloom.session import materialize, release, session_dir, shared_dir

    df = materialize(spark.range(3))
    assert df.count() == 3 and os.path.isdir(session_dir(spark))
    release(spark)
    assert not os.path.exists(session_dir(spark)) and os.path.isdir(shared_dir(spark))


NAMES = {"a": 0.1, "b": 0.5, "c": 0.995, "d": 0.0, "e": 1.0}


def spread(spark, n=20_000):
    """Distinct values, a hot value in half of the rows, few values with gaps, and a column without numbers."""
    x = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / 7.0
    return spark.range(n).select(
        x.alias("wide"), F.when(F.col("id") % 2 == 0, 5.0).otherwise(x).alias("hot"),
        F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 5).alias("few"), F.lit(None).cast("int").alias("none"),
    )


@pytest.mark.parametrize("cell_values", [1 << 21, 10])
@pytest.mark.parametrize("cells", [2, 64])
def test_column_quantiles_are_exact(spark, monkeypatch, cells, cell_values):
    monkeypatch.setattr(qt, "CELLS", cells)
    monkeypatch.setattr(qt, "CELL_VALUES", cell_values)
    df = spread(spark, 3000)
    got = {r.feature: r.asDict() for r in qt.column_quantiles(df, df.columns, NAMES).collect()}
    assert set(got) == {"wide", "hot", "few"}
    local = df.toPandas().astype(float)
    for c, row in got.items():
        want = np.quantile(local[c].dropna(), list(NAMES.values()))
        assert np.allclose([row[n] for n in NAMES], want, rtol=1e-12), c
    assert qt.column_quantiles(df.limit(0), df.columns, NAMES).count() == 0


def test_few_values_move(spark):
    """What is grouped by value are the cells of the wanted ranks; the rest is counted where it is read."""
    df = spread(spark)
    cells = 128
    frame = qt.in_cells(df, ["wide"], qt.cell_boundaries(df, ["wide"], cells), cells)
    counts = frame.groupBy("feature", "_cell").count().withColumnRenamed("count", "_n")
    targets = qt.rank_targets(counts, {"m": F.lit(10_000)}, ["feature"])
    assert counts.count() <= cells and qt.values_in_cells(frame, targets).count() < 20_000 * 6 / cells
