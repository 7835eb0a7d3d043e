"""Micro goldens computed by hand, ties, single-class inputs and brute-force comparison."""

import math
import random

import pytest
from pyspark.sql import functions as F

from adloom.operators import metrics as m

ROWS = [("A", 1, 0.9), ("A", 0, 0.8), ("A", 1, 0.3), ("A", 0, 0.1), ("B", 0, 0.7), ("B", 1, 0.6), ("C", 0, 0.5), ("C", 0, 0.4)]


@pytest.fixture(scope="module")
def preds(spark):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], "id int, g string, y int, p double")


def one(df):
    return df.first()[0]


def test_goldens(preds):
    assert one(m.auc(preds, "y", "p")) == pytest.approx(0.6)
    assert one(m.gauc(preds, "g", "y", "p")) == pytest.approx(0.5)
    assert one(m.avg_auc(preds, "g", "y", "p")) == pytest.approx(0.375)
    assert one(m.mrr(preds, "g", "y", "p", "id")) == pytest.approx(0.388889, abs=1e-6)
    assert one(m.ndcg(preds, "g", "y", "p", "id", 2)) == pytest.approx(0.414692, abs=1e-6)
    assert one(m.log_loss(preds, "y", "p")) == pytest.approx(0.742863, abs=1e-6)
    assert one(m.weighted_log_loss(preds, "y", "p")) == pytest.approx(0.715634, abs=1e-6)
    assert one(m.average_precision(preds, "y", "p")) == pytest.approx(0.642857, abs=1e-6)
    assert m.composite_score(preds, "y", "p").first()["final_score"] == pytest.approx(0.612866, abs=1e-6)


def test_per_group(preds):
    got = {r["g"]: r["auc"] for r in m.group_auc_table(preds, "g", "y", "p").collect()}
    assert got == {"A": pytest.approx(0.75), "B": pytest.approx(0.0)}
    mrr = {r["g"]: r["mrr"] for r in m.mrr_table(preds, "g", "y", "p", "id").collect()}
    assert mrr == {"A": pytest.approx(0.666667, abs=1e-6), "B": pytest.approx(0.5), "C": 0}


def test_ties(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.2), (0, 0.1)], "y int, p double")
    r = m.curve_metrics(df, "y", "p").first()
    assert r["ap"] == pytest.approx(0.583333, abs=1e-6) and r["auc"] == pytest.approx(0.625)


def test_single_class_is_null(spark):
    df = spark.createDataFrame([(0, 0.5), (0, 0.2)], "y int, p double")
    r = m.curve_metrics(df, "y", "p").first()
    assert r["auc"] is None and r["ap"] is None
    assert one(m.gauc(df.withColumn("g", F.lit(1)), "g", "y", "p")) is None
    assert one(m.weighted_log_loss(df, "y", "p")) == pytest.approx((math.log(2) - math.log(0.8)) / 2)


def test_extreme_scores_are_clipped(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 1.0)], "y int, p double")
    assert one(m.log_loss(df, "y", "p")) == pytest.approx(-math.log(1e-15), rel=1e-2)


@pytest.mark.parametrize("n", [1, 8])
def test_brute_force_with_hot_group(spark, partitions, n):
    partitions(n)
    rng = random.Random(11)
    rows = [(i, "hot" if i % 3 == 0 else f"u{i % 37}", int(rng.random() < 0.2), round(rng.random(), 2)) for i in range(1500)]
    df = spark.createDataFrame(rows, "id int, g string, y int, p double")

    def auc(rs):
        pos, neg = [r[3] for r in rs if r[2]], [r[3] for r in rs if not r[2]]
        return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))

    assert one(m.auc(df, "y", "p")) == pytest.approx(auc(rows))
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    both = [rs for rs in groups.values() if 0 < sum(r[2] for r in rs) < len(rs)]
    assert one(m.gauc(df, "g", "y", "p")) == pytest.approx(sum(auc(rs) * len(rs) for rs in both) / sum(map(len, both)))

    def ndcg(rs, k):
        best = sorted(rs, key=lambda r: (-r[3], r[0]))[:k]
        ideal = sorted((r[2] for r in rs), reverse=True)[:k]
        dcg = sum((2 ** r[2] - 1) / math.log2(i + 2) for i, r in enumerate(best))
        return dcg / (sum((2 ** y - 1) / math.log2(i + 2) for i, y in enumerate(ideal)) + 1e-12)

    want = sum(ndcg(rs, 5) for rs in groups.values()) / len(groups)
    assert one(m.ndcg(df, "g", "y", "p", "id", 5)) == pytest.approx(want)
    # A k beyond the pre-shuffle limit takes the distributed order and must agree.
    full = m.ndcg(df, "g", "y", "p", "id", m.GROUP_LIMIT + 500)
    assert one(full) == pytest.approx(sum(ndcg(rs, 10_000) for rs in groups.values()) / len(groups))


def test_evaluate_refuses(preds):
    with pytest.raises(ValueError, match="not supported"):
        m.evaluate(preds, ["F1"], "y", "p")
    with pytest.raises(ValueError, match="group"):
        m.evaluate(preds, ["gAUC"], "y", "p")
    with pytest.raises(ValueError, match="tie"):
        m.evaluate(preds, ["MRR"], "y", "p", "g")


def test_evaluate_table(preds):
    got = m.evaluate(preds, ["NDCG(k=2)", "AUC", "binary_crossentropy", "gAUC"], "y", "p", "g", "id").orderBy("position").collect()
    assert [r["metric"] for r in got] == ["NDCG(k=2)", "AUC", "binary_crossentropy", "gAUC"]
    assert [r["value"] for r in got] == pytest.approx([0.414692, 0.6, 0.742863, 0.5], abs=1e-6)


def test_compare_models(preds):
    both = preds.withColumn("model", F.lit("a")).unionAll(preds.withColumn("p", 1 - F.col("p")).withColumn("model", F.lit("b")))
    got = {r["model"]: r for r in m.compare_models(both, "model", "y", "p").collect()}
    best = max(got, key=lambda k: got[k]["final_score"])
    assert [k for k in got if got[k]["is_best"]] == [best]


def test_no_python_in_builtin_metrics(preds):
    plan = m.evaluate(preds, ["AUC", "gAUC", "MRR", "NDCG(k=2)"], "y", "p", "g", "id")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_top_k_prunes_before_the_shuffle(preds):
    plan = m.top_k(preds, ["g"], ["p", "id"], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_tasks_share_a_pass_and_ideal_gains_count_labels(spark, preds):
    """Tasks as keys of the cells equal one evaluation each; ranked metrics from one ranking equal one table each."""
    both = preds.withColumn("q", 1 - F.col("p")).withColumn("none", F.lit(None).cast("double"))
    tasks = [("a", "y", "p"), ("b", "y", "q"), ("c", "y", "none")]
    got = {r["name"]: r["value"] for r in m.multitask(both, tasks, ["AUC", "logloss"]).collect()}
    want = {f"{n}_{r['metric']}": r["value"] for n, y, p in tasks for r in m.evaluate(both, ["AUC", "logloss"], y, p).collect()}
    for k, v in want.items():
        assert got[k] is None if v is None else got[k] == pytest.approx(v, abs=1e-12)
    assert got["AUC"] == pytest.approx((got["a_AUC"] + got["b_AUC"]) / 2)
    for with_mrr in (True, False):
        one = m.ranked_metrics(preds, "g", "y", "p", "id", [1, 2, 5], with_mrr).first()
        for k in (1, 2, 5):
            assert one[f"ndcg_{k}"] == pytest.approx(m.ndcg(preds, "g", "y", "p", "id", k).first()["ndcg"], abs=1e-12)
    assert m.ranked_metrics(preds, "g", "y", "p", "id", []).first()["mrr"] == pytest.approx(m.mrr(preds, "g", "y", "p", "id").first()["mrr"])
