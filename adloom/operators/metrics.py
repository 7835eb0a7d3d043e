"""Ranking and calibration metrics over a prediction table (group, label, score, id).

Rows with equal scores are combined before anything is ordered, and orders are distributed
(:mod:`adloom.operators.ranking`), so neither the table nor one group has to fit a task.
Undefined values (one class only, no rows) are null.

Rows whose label or score is null or NaN take no part in any metric; :func:`unscored` counts them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from adloom.functions.scalars import clip
from adloom.operators.joins import null_safe_join
from adloom.operators.ranking import running_totals, with_rank

# Fixed value: probabilities are kept this far from 0 and 1 before a logarithm.
EPS = 1e-15
# Fixed value: guards the division of per-group gains.
TINY = 1e-12
# Spark prunes row_number() <= k before the shuffle up to this k, unless the session says otherwise.
GROUP_LIMIT = 1000
GROUP_LIMIT_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den != 0, num / den)


def _known(*columns: str) -> Column:
    """Rows on which all of these are numbers."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns])


def unscored(df: DataFrame, label: str, score: str) -> DataFrame:
    """Number of rows that the metrics leave out."""
    return df.agg(F.count_if(~_known(label, score)).alias("n_unscored"))


def pointwise_loss(label: str, score: str) -> Column:
    y, p = F.col(label).cast("double"), clip(F.col(score).cast("double"), EPS, 1 - EPS)
    return -(y * F.log(p) + (1 - y) * F.log(1 - p))


def log_loss(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.where(_known(label, score)).agg(F.avg(pointwise_loss(label, score)).alias("logloss"))


# ---- threshold curve: AUC and AP ---------------------------------------------------------------


def score_cells(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score: its negative, sum of labels, rows, and rows with label 1. Cells add up over parts of a table."""
    rows = df.where(_known(label, score)).select(*by, (-F.col(score).cast("double") + F.lit(0.0)).alias("_neg"), F.col(label).cast("double").alias("_y"))
    ones = F.sum(F.when(F.col("_y") == 1, 1.0).otherwise(0.0))
    return rows.groupBy(*by, "_neg").agg(F.sum("_y").alias("pos"), F.count(F.lit(1)).cast("double").alias("n"), ones.alias("ones"))


def score_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score, highest first: pos, n and their inclusive running sums."""
    return running_totals(score_cells(df, label, score, by), ["_neg"], {"cum_pos": "pos", "cum_n": "n"}, by)


def _curve_terms() -> list[Column]:
    pos, neg = F.col("pos"), F.col("n") - F.col("pos")
    neg_above = (F.col("cum_n") - F.col("cum_pos")) - neg
    return [
        # Positives beat every negative with a lower score and tie with those at the same score.
        F.sum(pos * (neg_above + neg / 2)).alias("_lost"),
        F.sum(pos * F.col("cum_pos") / F.col("cum_n")).alias("_prec"),
        F.sum(pos).alias("n_pos"),
        F.sum(neg).alias("n_neg"),
    ]


def _cell_losses() -> list[Column]:
    """Loss sums, all of them linear in the labels, over cells."""
    p = clip(-F.col("_neg"), EPS, 1 - EPS)
    loss = lambda y, n: -(y * F.log(p) + (n - y) * F.log(1 - p))
    pos, n, ones = F.col("pos"), F.col("n"), F.col("ones")
    return [
        F.sum(loss(pos, n)).alias("_loss"), F.sum(n).alias("_rows"),
        F.sum(loss(ones, ones)).alias("_lp"), F.sum(loss(pos - ones, n - ones)).alias("_ln"), F.sum(ones).alias("_np"), F.sum(n - ones).alias("_nn"),
    ]


def cell_metrics(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by…, auc, ap, logloss, wll, n_pos, n_neg) from cells as :func:`score_cells` makes them, in one ordered pass."""
    curve = running_totals(cells, ["_neg"], {"cum_pos": "pos", "cum_n": "n"}, by)
    terms = [*_curve_terms(), *_cell_losses()]
    sums = curve.groupBy(*by).agg(*terms) if by else curve.agg(*terms)
    return sums.select(
        *by,
        (1 - _ratio(F.col("_lost"), F.col("n_pos") * F.col("n_neg"))).alias("auc"),
        _ratio(F.col("_prec"), F.col("n_pos")).alias("ap"),
        _ratio(F.col("_loss"), F.col("_rows")).alias("logloss"),
        _wll(None).alias("wll"),
        "n_pos",
        "n_neg",
    )


def curve_metrics(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """AUC and average precision (ties share a threshold), overall or per group, from one pass."""
    return cell_metrics(score_cells(df, label, score, by), by).select(*by, "auc", "ap", "n_pos", "n_neg")


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    return curve_metrics(df, label, score).select("auc")


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    return curve_metrics(df, label, score).select("ap")


# ---- weighted log loss and the composite score --------------------------------------------------


def _wll_terms(label: str, score: str) -> list[Column]:
    loss, y = pointwise_loss(label, score), F.col(label).cast("double")
    return [
        F.sum(F.when(y == 1, loss)).alias("_lp"),
        F.sum(F.when(y != 1, loss)).alias("_ln"),
        F.sum(F.when(y == 1, 1.0).otherwise(0.0)).alias("_np"),
        F.sum(F.when(y != 1, 1.0).otherwise(0.0)).alias("_nn"),
    ]


def _wll(weights: tuple[float, float] | None) -> Column:
    lp, ln = F.coalesce("_lp", F.lit(0.0)), F.coalesce("_ln", F.lit(0.0))
    n_pos, n_neg = F.col("_np"), F.col("_nn")
    if weights is None:
        # Each class carries half of the weight; a class without rows carries none.
        w_pos = F.when(n_pos > 0, 0.5 / n_pos).otherwise(0.0)
        w_neg = F.when(n_neg > 0, 0.5 / n_neg).otherwise(0.0)
    else:
        w_neg, w_pos = F.lit(float(weights[0])), F.lit(float(weights[1]))
    return _ratio(w_pos * lp + w_neg * ln, w_pos * n_pos + w_neg * n_neg)


def weighted_log_loss(
    df: DataFrame, label: str, score: str, class_weights: tuple[float, float] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Log loss with classes balanced 50:50, or weighted (negative, positive)."""
    terms = _wll_terms(label, score)
    df = df.where(_known(label, score))
    sums = df.groupBy(*by).agg(*terms) if by else df.agg(*terms)
    return sums.select(*by, _wll(class_weights).alias("wll"))


def composite_score(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """AP, WLL, its bounded form 1/(1+WLL) and the mean of AP and that form."""
    both = cell_metrics(score_cells(df, label, score, by), by)
    part = 1 / (1 + F.col("wll"))
    return both.select(
        *by, "ap", "wll", part.alias("wll_component"), (0.5 * F.col("ap") + 0.5 * part).alias("final_score")
    )


def compare_models(df: DataFrame, model: str, label: str, score: str) -> DataFrame:
    """Composite score per model, with the best one marked (ties: smallest name)."""
    table = composite_score(df, label, score, [model])
    best = table.agg(F.min_by(model, F.struct(-F.col("final_score"), F.col(model)))).scalar()
    return table.withColumn("is_best", F.when(F.col(model) == best, 1).otherwise(0))


# ---- group metrics -----------------------------------------------------------------------------


def group_auc_table(df: DataFrame, group: str, label: str, score: str) -> DataFrame:
    """(group, auc, weight) of the groups that have both classes."""
    per = curve_metrics(df, label, score, [group])
    return per.where((F.col("n_pos") > 0) & (F.col("n_neg") > 0)).select(
        group, "auc", (F.col("n_pos") + F.col("n_neg")).alias("weight")
    )


def _group_auc_summary(df: DataFrame, group: str, label: str, score: str) -> DataFrame:
    return group_auc_table(df, group, label, score).agg(
        _ratio(F.sum(F.col("auc") * F.col("weight")), F.sum("weight")).alias("gAUC"),
        F.avg("auc").alias("avgAUC"),
    )


def gauc(df: DataFrame, group: str, label: str, score: str) -> DataFrame:
    """Group AUC weighted by group size."""
    return _group_auc_summary(df, group, label, score).select(F.col("gAUC").alias("gauc"))


def avg_auc(df: DataFrame, group: str, label: str, score: str) -> DataFrame:
    return _group_auc_summary(df, group, label, score).select(F.col("avgAUC").alias("avgauc"))


def _best_first(df: DataFrame, group: str, label: str, score: str, tie: str) -> DataFrame:
    return df.where(_known(label, score)).select(
        F.col(group).alias("_g"), F.col(label).cast("double").alias("_y"),
        (-F.col(score).cast("double") + F.lit(0.0)).alias("_neg"), F.col(tie).alias("_id"),
    )


def mrr_table(df: DataFrame, group: str, label: str, score: str, tie: str) -> DataFrame:
    """(group, mrr): label-weighted mean of reciprocal ranks; 0 without positives. Ties go by id."""
    ranked = with_rank(_best_first(df, group, label, score, tie), ["_neg", "_id"], ["_g"], "_rk")
    return ranked.groupBy(F.col("_g").alias(group)).agg(
        (F.sum(F.col("_y") / F.col("_rk")) / (F.sum("_y") + TINY)).alias("mrr")
    )


def mrr(df: DataFrame, group: str, label: str, score: str, tie: str) -> DataFrame:
    return mrr_table(df, group, label, score, tie).agg(F.avg("mrr").alias("mrr"))


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[str], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of every group with their rank.

    For usual k Spark drops losing rows before the shuffle, so a hot group sends at most k rows per
    task; beyond that the order itself is distributed.
    """
    if k <= int(df.sparkSession.conf.get(GROUP_LIMIT_SETTING, str(GROUP_LIMIT))):
        w = W.partitionBy(*by).orderBy(*order)
        return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
    return with_rank(df, order, by, name).where(F.col(name) <= k)


def ndcg_table(df: DataFrame, group: str, label: str, score: str, tie: str, k: int) -> DataFrame:
    """(group, ndcg) with gain 2^label − 1 and discount log2(rank + 1) over the first k rows."""
    base = _best_first(df, group, label, score, tie)
    gain = (F.pow(F.lit(2.0), F.col("_y")) - 1) / F.log2(F.col("_rk") + 1)

    def dcg(order: Sequence[str], out: str) -> DataFrame:
        return top_k(base.withColumn("_ny", -F.col("_y")), ["_g"], order, k, "_rk").groupBy("_g").agg(F.sum(gain).alias(out))

    both = null_safe_join(dcg(["_neg", "_id"], "_dcg"), dcg(["_ny", "_id"], "_idcg"), ["_g"], "inner")
    return both.select(F.col("_g").alias(group), (F.col("_dcg") / (F.col("_idcg") + TINY)).alias("ndcg"))


def ndcg(df: DataFrame, group: str, label: str, score: str, tie: str, k: int) -> DataFrame:
    return ndcg_table(df, group, label, score, tie, k).agg(F.avg("ndcg").alias("ndcg"))


def ideal_gains(base: DataFrame, ks: Sequence[int]) -> DataFrame:
    """(_g, _idcg_k…): the best possible gains, from the number of rows of each label in a group."""
    above = W.partitionBy("_g").orderBy(F.desc("_y")).rowsBetween(W.unboundedPreceding, 0)
    runs = base.groupBy("_g", "_y").agg(F.count(F.lit(1)).alias("_n")).withColumn("_last", F.sum("_n").over(above))
    first = F.col("_last") - F.col("_n") + 1

    def discounts(k: int) -> Column:
        last = F.least(F.col("_last"), F.lit(k).cast("bigint"))
        places = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
        return F.aggregate(places, F.lit(0.0), lambda a, r: a + 1 / F.log2(r.cast("double") + 1))

    return runs.groupBy("_g").agg(*[F.sum((F.pow(F.lit(2.0), F.col("_y")) - 1) * discounts(k)).alias(f"_idcg_{k}") for k in ks])


def ranked_metrics(df: DataFrame, group: str, label: str, score: str, tie: str, ks: Sequence[int], with_mrr: bool = True) -> DataFrame:
    """One row: ``mrr`` (if asked) and ``ndcg_k`` for every k, the group means, from one ranking of the rows."""
    base = _best_first(df, group, label, score, tie)
    if with_mrr:
        ranked = with_rank(base, ["_neg", "_id"], ["_g"], "_rk")
    else:
        ranked = top_k(base, ["_g"], ["_neg", "_id"], max(ks), "_rk")
    gain = (F.pow(F.lit(2.0), F.col("_y")) - 1) / F.log2(F.col("_rk") + 1)
    sums = [F.sum(F.when(F.col("_rk") <= k, gain).otherwise(0.0)).alias(f"_dcg_{k}") for k in ks]
    if with_mrr:
        sums.append((F.sum(F.col("_y") / F.col("_rk")) / (F.sum("_y") + TINY)).alias("mrr"))
    per = ranked.groupBy("_g").agg(*sums)
    if ks:
        per = null_safe_join(per, ideal_gains(base, ks), ["_g"], "inner")
    means = [F.avg(F.col(f"_dcg_{k}") / (F.col(f"_idcg_{k}") + TINY)).alias(f"ndcg_{k}") for k in ks]
    return per.agg(*means, *([F.avg("mrr").alias("mrr")] if with_mrr else []))


# ---- dispatch ------------------------------------------------------------------------------------

# NDCG() is NDCG(k=1).
_NDCG = re.compile(r"NDCG\(\s*(?:(?:k\s*=\s*)?(\d+)\s*)?\)")
_LOSS_NAMES = ("logloss", "binary_crossentropy")
_GROUP_AUC = ("gAUC", "avgAUC")


def evaluate(
    df: DataFrame, metrics: Sequence[str], label: str, score: str, group: str | None = None, tie: str | None = None
) -> DataFrame:
    """(metric, value) for each requested name, in one lazy plan.

    Names: logloss, binary_crossentropy, AUC, gAUC, avgAUC, MRR, NDCG(k=…), NDCG(). ``tie`` is the id column
    that settles equal scores in MRR and NDCG.
    """
    grouped = [m for m in metrics if m in (*_GROUP_AUC, "MRR") or _NDCG.fullmatch(m)]
    for m in metrics:
        if m not in (*_LOSS_NAMES, "AUC") and m not in grouped:
            raise ValueError(f"metric {m!r} is not supported")
    if grouped and group is None:
        raise ValueError(f"{grouped} need a group column")
    if tie is None and any(m == "MRR" or _NDCG.fullmatch(m) for m in grouped):
        raise ValueError("MRR and NDCG need a tie-breaking id column")
    if not metrics:
        raise ValueError("no metric asked for")
    place = {m: i for i, m in enumerate(metrics)}

    def rows(table: DataFrame, columns: dict[str, str]) -> DataFrame:
        """One output row per metric from a one-row table."""
        cells = [
            F.struct(F.lit(place[m]).alias("position"), F.lit(m).alias("metric"), F.col(c).cast("double").alias("value"))
            for m, c in columns.items()
        ]
        return table.select(F.explode(F.array(*cells)).alias("r")).select("r.*")

    parts = []
    losses = [m for m in place if m in _LOSS_NAMES]
    if "AUC" in place:
        whole = cell_metrics(score_cells(df, label, score))
        parts.append(rows(whole, {"AUC": "auc", **dict.fromkeys(losses, "logloss")}))
    elif losses:
        parts.append(rows(log_loss(df, label, score), dict.fromkeys(losses, "logloss")))
    group_aucs = [m for m in place if m in _GROUP_AUC]
    if group_aucs:
        parts.append(rows(_group_auc_summary(df, group, label, score), {m: m for m in group_aucs}))
    cutoffs = {m: int(_NDCG.fullmatch(m).group(1) or 1) for m in place if _NDCG.fullmatch(m)}
    if cutoffs or "MRR" in place:
        ranked = ranked_metrics(df, group, label, score, tie, sorted(set(cutoffs.values())), "MRR" in place)
        parts.append(rows(ranked, {**({"MRR": "mrr"} if "MRR" in place else {}), **{m: f"ndcg_{k}" for m, k in cutoffs.items()}}))
    return reduce(DataFrame.unionByName, parts)


def weighted_combination(df: DataFrame, value: str, weight: str) -> DataFrame:
    """Σ value / Σ weight over groups; null when no group carries weight."""
    return df.agg(_ratio(F.sum(value), F.sum(weight)).alias("value"))


def custom_group_metric(
    df: DataFrame, group: str, label: str, score: str, tie: str, value: Column, weight: Column | None = None
) -> DataFrame:
    """(group, value, weight) of a user's own metric, for :func:`weighted_combination`.

    The metric is an aggregate over the columns ``label``, ``score`` and ``rank`` (exact position by
    descending score), so Spark combines it map-side and no group is ever handed over whole.
    """
    ranked = with_rank(_best_first(df, group, label, score, tie), ["_neg", "_id"], ["_g"], "rank")
    rows = ranked.select(F.col("_g").alias(group), F.col("_y").alias("label"), (-F.col("_neg")).alias("score"), "rank")
    return rows.groupBy(group).agg(
        value.cast("double").alias("value"), (F.lit(1.0) if weight is None else weight.cast("double")).alias("weight")
    )


def multitask(df: DataFrame, tasks: Sequence[tuple[str, str, str]], metrics: Sequence[str], group: str | None = None, tie: str | None = None) -> DataFrame:
    """Each metric per task (name, label, score) as ``name_metric``, plus its mean over tasks."""
    if metrics and not set(metrics) - {*_LOSS_NAMES, "AUC"}:
        # The task is a key of the cells: one pass for all of them.
        rows = F.array(*[F.struct(F.lit(n).alias("_task"), F.col(y).cast("double").alias("_label"), F.col(p).cast("double").alias("_score")) for n, y, p in tasks])
        melted = df.select(F.inline(rows))
        if "AUC" in metrics:
            found = cell_metrics(score_cells(melted, "_label", "_score", ["_task"]), ["_task"])
        else:
            # Losses alone need no order.
            found = melted.where(_known("_label", "_score")).groupBy("_task").agg(F.avg(pointwise_loss("_label", "_score")).alias("logloss"))
        values = [F.struct(F.lit(m).alias("metric"), F.col("auc" if m == "AUC" else "logloss").alias("value")) for m in metrics]
        scored = found.select("_task", F.inline(F.array(*values)))
        # A task without a usable row has a row of nulls.
        every = df.sparkSession.createDataFrame([(n, m) for n, _, _ in tasks for m in metrics], "_task string, metric string")
        per_task = every.join(scored, ["_task", "metric"], "left").select(F.concat_ws("_", "_task", "metric").alias("name"), "metric", "value")
    else:
        parts = []
        for name, label, score in tasks:
            one = evaluate(df, metrics, label, score, group, tie)
            parts.append(one.select(F.concat(F.lit(name + "_"), "metric").alias("name"), "metric", "value"))
        per_task = reduce(DataFrame.unionByName, parts)
    mean = per_task.groupBy("metric").agg(F.avg("value").alias("value"))
    return per_task.select("name", "value").unionByName(mean.select(F.col("metric").alias("name"), "value"))
