"""Profiling reports and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.functions.scalars import hash_unit
from adloom.operators import metrics as met
from adloom.operators import profile as prof
from adloom.operators.clean import value_counts
from adloom.suite.common import DOC_TOKENS, IMP, STRIP, hash_unit_sql, impressions, query, r6, s6, table, tokens_sql

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
EV_TEXT = ["event_type", "hour", "dow"]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


# ---- counts and rates ---------------------------------------------------------------------------


@query("agg_value_counts", "SELECT l_returnflag, count(*) AS cnt FROM lineitem GROUP BY 1")
def _(spark, sf):
    return value_counts(table(spark, sf, "lineitem"), "l_returnflag")


@query("agg_value_ratios", f"SELECT l_returnflag, count(*) AS cnt, {s6('count(*) / (SELECT count(*) FROM lineitem)')} AS ratio FROM lineitem GROUP BY 1")
def _(spark, sf):
    return prof.value_ratios(table(spark, sf, "lineitem"), "l_returnflag").withColumn("ratio", r6("ratio"))


@query("agg_ctr", f"WITH {IMP} SELECT hour, {s6('avg(clicked)')} AS ctr, count(*) AS cnt FROM imp WHERE hour IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return prof.click_rate(impressions(spark, sf), "hour", "clicked").withColumn("ctr", r6("ctr"))


@query("agg_cat_summary", f"""
WITH {IMP}, c AS (SELECT nullif(hour, '7') AS hour, clicked FROM imp)
SELECT hour, count(*) AS cnt, {s6('count(*) / (SELECT count(*) FROM c)')} AS ratio, {s6('CASE WHEN hour IS NULL THEN NULL ELSE avg(clicked) END')} AS ctr
FROM c GROUP BY hour ORDER BY cnt DESC, hour NULLS LAST LIMIT 20
""")
def _(spark, sf):
    c = impressions(spark, sf).withColumn("hour", F.nullif("hour", F.lit("7")))
    return prof.categorical_summary(c, "hour", "clicked", 20).withColumns({"ratio": r6("ratio"), "ctr": r6("ctr")})


@query("agg_nunique", _union([f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique FROM lineitem" for c in ["l_partkey", "l_suppkey", *LI_NUM, "l_returnflag"]]))
def _(spark, sf):
    return prof.distinct_counts(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey", *LI_NUM, "l_returnflag"])


@query("agg_nunique_approx", _union([f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS exact, 1 AS within_tenth FROM lineitem" for c in ("l_partkey", "l_suppkey", "l_returnflag")]))
def _(spark, sf):
    """The estimate lies within a tenth of the exact number."""
    names, li = ["l_partkey", "l_suppkey", "l_returnflag"], table(spark, sf, "lineitem")
    exact = prof.distinct_counts(li, names).withColumnRenamed("n_unique", "exact")
    near = F.abs(F.col("n_unique") - F.col("exact")) <= 0.1 * F.col("exact")
    return exact.join(prof.distinct_counts(li, names, approx=True), "column").select("column", "exact", near.cast("int").alias("within_tenth"))


@query("agg_missing", _union([
    f"SELECT '{c}' AS \"column\", {s6(f'avg(CASE WHEN {e} IS NULL THEN 1.0 ELSE 0.0 END)')} AS missing_ratio FROM events"
    for c, e in [("event_type", "nullif(event_type, 'view')"), ("value", "nullif(value, round(value))"), ("user_id", "user_id")]
]))
def _(spark, sf):
    ev = table(spark, sf, "events").select(
        F.nullif("event_type", F.lit("view")).alias("event_type"),
        F.when(F.col("value") != F.round("value"), F.col("value")).otherwise(F.lit(float("nan"))).alias("value"), "user_id",
    )
    return prof.missing_ratio(ev, ["event_type", "value", "user_id"]).withColumn("missing_ratio", r6("missing_ratio"))


@query("agg_zero_ratio", _union([f"SELECT '{c}' AS \"column\", {s6(f'avg(CASE WHEN {c} = 0 THEN 1.0 ELSE 0.0 END)')} AS zero_ratio FROM lineitem" for c in LI_NUM]))
def _(spark, sf):
    return prof.zero_ratio(table(spark, sf, "lineitem"), LI_NUM).withColumn("zero_ratio", r6("zero_ratio"))


@query("agg_describe", _union([f"""SELECT '{c}' AS "column", count({c}) AS count, {s6(f'avg({c})', 4)} AS mean, {s6(f'stddev_samp({c})', 4)} AS std, {s6(f'min({c})')} AS min,
  {s6(f'quantile_cont({c}, 0.25)')} AS p25, {s6(f'quantile_cont({c}, 0.5)')} AS p50, {s6(f'quantile_cont({c}, 0.75)')} AS p75, {s6(f'max({c})')} AS max FROM lineitem""" for c in LI_NUM]))
def _(spark, sf):
    d = prof.describe_numeric(table(spark, sf, "lineitem"), LI_NUM)
    return d.select("column", "count", r6("mean", 4).alias("mean"), r6("std", 4).alias("std"), *[r6(c).alias(c) for c in ("min", "p25", "p50", "p75", "max")])


@query("agg_object_describe", f"WITH {IMP}" + _union([f"""
SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique", arg_min(v, (-n, v)) AS top, max(n) AS freq
FROM (SELECT {c} AS v, count(*) AS n FROM imp GROUP BY 1)""" for c in EV_TEXT]))
def _(spark, sf):
    return prof.describe_text(impressions(spark, sf), EV_TEXT)


@query("agg_info", _union([f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null FROM orders" for i, (c, t) in enumerate([
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")])]))
def _(spark, sf):
    return prof.schema_report(table(spark, sf, "orders"))


@query("agg_corr_matrix", _union([f"SELECT '{a}' AS a, '{b}' AS b, {s6(f'corr({a}, {b})')} AS corr FROM lineitem" for a in LI_NUM for b in LI_NUM]))
def _(spark, sf):
    return prof.correlation_matrix(table(spark, sf, "lineitem"), LI_NUM).withColumn("corr", r6("corr"))


@query("agg_corr_label", f"WITH {IMP} " + _union([f"SELECT '{c}' AS \"column\", {s6(f'corr({c}, clicked)')} AS corr FROM imp" for c in ("value", "k", "score")] + ["SELECT 'constant', NULL"]))
def _(spark, sf):
    imp = impressions(spark, sf).withColumn("constant", F.lit(1.0))
    return prof.label_correlation(imp, ["value", "k", "score", "constant"], "clicked").withColumn("corr", r6("corr"))


@query("agg_seq_stats", f"""
WITH l AS (SELECT len({tokens_sql('text')}) AS len FROM documents)
SELECT count(*) AS n_rows, min(len) AS min_len, max(len) AS max_len, {s6('avg(len)')} AS mean_len, {s6('stddev_samp(len)')} AS std_len,
  {', '.join(s6(f'quantile_cont(len, {q})') + ' AS ' + n for n, q in prof.LENGTH_QUANTILES.items())} FROM l
""")
def _(spark, sf):
    s = prof.sequence_stats(table(spark, sf, "documents"), "text", " ")
    return s.withColumns({c: r6(c) for c in s.columns if c not in ("n_rows", "min_len", "max_len")})


@query("agg_token_topk", f"""
WITH {DOC_TOKENS}, t AS (SELECT trim(token, {STRIP}) AS token FROM tok), f AS (SELECT token, count(*) AS cnt FROM t WHERE token <> '' GROUP BY 1)
SELECT token, cnt, (SELECT count(*) FROM f) AS n_distinct FROM f ORDER BY cnt DESC, token LIMIT 10
""")
def _(spark, sf):
    return prof.top_tokens(table(spark, sf, "documents"), "text", " ", 10)


@query("agg_min_max", _union([f"SELECT '{c}' AS \"column\", {s6(f'min({c})')} AS min, {s6(f'max({c})')} AS max FROM lineitem" for c in LI_NUM]))
def _(spark, sf):
    return prof.min_max(table(spark, sf, "lineitem"), LI_NUM).withColumns({"min": r6("min"), "max": r6("max")})


@query("agg_distinct_values", f"WITH {IMP} " + _union([f"SELECT DISTINCT '{c}' AS \"column\", {c} AS value FROM imp" for c in EV_TEXT]))
def _(spark, sf):
    return prof.distinct_values(impressions(spark, sf), EV_TEXT)


@query("agg_hist_equal", f"""
WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
b AS (SELECT CAST(least(floor((o_totalprice - lo) * 10 / (hi - lo)), 9) AS INTEGER) AS bin FROM orders, s), e AS (SELECT unnest(range(10)) AS bin)
SELECT CAST(e.bin AS INTEGER) AS bin, {s6('any_value(lo) + (any_value(hi) - any_value(lo)) / 10 * e.bin', 4)} AS low,
  {s6('any_value(lo) + (any_value(hi) - any_value(lo)) / 10 * (e.bin + 1)', 4)} AS high, count(b.bin) AS cnt FROM e LEFT JOIN b ON b.bin = e.bin, s GROUP BY e.bin
""")
def _(spark, sf):
    return prof.equal_width_histogram(table(spark, sf, "orders"), "o_totalprice").withColumns({"low": r6("low", 4), "high": r6("high", 4)})


EDGES = [0.0, 0.01, 0.05, 0.1, 0.5]


@query("agg_hist_ranges", f"WITH {IMP} " + _union([
    f"SELECT {i} AS bin, {lo}::DOUBLE AS low, count(*) FILTER (WHERE score >= {lo}::DOUBLE{f' AND score < {EDGES[i + 1]}::DOUBLE' if i + 1 < len(EDGES) else ''}) AS cnt FROM imp" for i, lo in enumerate(EDGES)]))
def _(spark, sf):
    return prof.range_histogram(impressions(spark, sf), "score", EDGES)


@query("agg_pred_summary", f"""
WITH {IMP} SELECT count(score) AS n, {s6('avg(score)')} AS mean, min(score) AS min, max(score) AS max, {s6('stddev_pop(score)')} AS std,
  count(*) FILTER (WHERE score > 0.5::DOUBLE) AS n_positive, count(*) FILTER (WHERE score <= 0.5::DOUBLE) AS n_negative FROM imp
""")
def _(spark, sf):
    return prof.prediction_summary(impressions(spark, sf), "score").withColumns({"mean": r6("mean"), "std": r6("std")})


@query("agg_class_balance", f"""
WITH {IMP} SELECT count(*) AS total, count(*) FILTER (WHERE clicked = 1) AS positives, count(*) FILTER (WHERE clicked = 0) AS negatives, {s6('avg(clicked)')} AS rate FROM imp
""")
def _(spark, sf):
    return prof.class_balance(impressions(spark, sf), "clicked").withColumn("rate", r6("rate"))


@query("top_ctr_categories", f"WITH {IMP} SELECT hour, {s6('avg(clicked)')} AS ctr, count(*) AS cnt FROM imp GROUP BY 1 ORDER BY avg(clicked) DESC, hour LIMIT 5")
def _(spark, sf):
    return prof.top_click_rate(impressions(spark, sf), "hour", "clicked").withColumn("ctr", r6("ctr"))


# ---- metrics -------------------------------------------------------------------------------------

P = "greatest(1e-15::DOUBLE, least(1 - 1e-15::DOUBLE, score))"
LOSS = f"-(clicked * ln({P}) + (1 - clicked) * ln(1 - {P}))"


def curve_sql(source: str, by: str = "") -> str:
    """CTE c: per group, AUC and AP of (clicked, score) rows, equal scores sharing a threshold."""
    b = f"{by}, " if by else ""
    over = f"PARTITION BY {by} ORDER BY score DESC" if by else "ORDER BY score DESC"
    group = f"GROUP BY {by}" if by else ""
    return f"""cell AS (SELECT {b}score, CAST(sum(clicked) AS DOUBLE) AS p, CAST(count(*) AS DOUBLE) AS n FROM {source} GROUP BY {b}score),
cum AS (SELECT *, sum(p) OVER w AS cp, sum(n) OVER w AS cn FROM cell WINDOW w AS ({over} ROWS UNBOUNDED PRECEDING)),
agg AS (SELECT {b}sum(p * (cn - cp - (n - p) + (n - p) / 2)) AS lost, sum(p * cp / cn) AS prec, sum(p) AS np, sum(n - p) AS nn FROM cum {group}),
c AS (SELECT {b}CASE WHEN np * nn <> 0 THEN 1 - lost / (np * nn) END AS auc, CASE WHEN np <> 0 THEN prec / np END AS ap, np, nn FROM agg)"""


WLL = f"0.5::DOUBLE * avg(CASE WHEN clicked = 1 THEN {LOSS} END) + 0.5::DOUBLE * avg(CASE WHEN clicked = 0 THEN {LOSS} END)"


@query("met_logloss", f"WITH {IMP} SELECT {s6(f'avg({LOSS})')} AS logloss FROM imp")
def _(spark, sf):
    return met.log_loss(impressions(spark, sf), "clicked", "score").select(r6("logloss").alias("logloss"))


@query("met_auc", f"WITH {IMP}, {curve_sql('imp')} SELECT {s6('auc')} AS auc FROM c")
def _(spark, sf):
    return met.auc(impressions(spark, sf), "clicked", "score").select(r6("auc").alias("auc"))


@query("met_ap", f"WITH {IMP}, {curve_sql('imp')} SELECT {s6('ap')} AS ap FROM c")
def _(spark, sf):
    return met.average_precision(impressions(spark, sf), "clicked", "score").select(r6("ap").alias("ap"))


_GROUPED = f"{IMP}, {curve_sql('imp', 'user_id')}, g AS (SELECT * FROM c WHERE np > 0 AND nn > 0)"


@query("met_group_auc", f"WITH {_GROUPED} SELECT user_id, {s6('auc')} AS auc, CAST(np + nn AS DOUBLE) AS weight FROM g")
def _(spark, sf):
    return met.group_auc_table(impressions(spark, sf), "user_id", "clicked", "score").withColumn("auc", r6("auc"))


@query("met_gauc", f"WITH {_GROUPED} SELECT {s6('sum(auc * (np + nn)) / sum(np + nn)')} AS gauc FROM g")
def _(spark, sf):
    return met.gauc(impressions(spark, sf), "user_id", "clicked", "score").select(r6("gauc").alias("gauc"))


@query("met_avgauc", f"WITH {_GROUPED} SELECT {s6('avg(auc)')} AS avgauc FROM g")
def _(spark, sf):
    return met.avg_auc(impressions(spark, sf), "user_id", "clicked", "score").select(r6("avgauc").alias("avgauc"))


_MRR = f"""{IMP}, rk AS (SELECT user_id, clicked, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, id) AS r FROM imp),
mg AS (SELECT user_id, sum(clicked / r::DOUBLE) / (sum(clicked) + 1e-12::DOUBLE) AS m FROM rk GROUP BY 1)"""


@query("met_mrr", f"WITH {_MRR} SELECT {s6('avg(m)')} AS mrr FROM mg")
def _(spark, sf):
    return met.mrr(impressions(spark, sf), "user_id", "clicked", "score", "id").select(r6("mrr").alias("mrr"))


def ndcg_sql(k: int) -> str:
    gain = "sum((pow(2, clicked) - 1) / log2(r + 1))"
    return f"""a AS (SELECT user_id, clicked, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, id) AS r, row_number() OVER (PARTITION BY user_id ORDER BY clicked DESC, id) AS q FROM imp),
d AS (SELECT user_id, {gain} AS dcg FROM a WHERE r <= {k} GROUP BY 1), i AS (SELECT user_id, {gain.replace('r + 1', 'q + 1')} AS idcg FROM a WHERE q <= {k} GROUP BY 1),
n AS (SELECT user_id, dcg / (idcg + 1e-12::DOUBLE) AS v FROM d JOIN i USING (user_id))"""


@query("met_ndcg", f"WITH {IMP}, {ndcg_sql(5)} SELECT {s6('avg(v)')} AS ndcg FROM n")
def _(spark, sf):
    return met.ndcg(impressions(spark, sf), "user_id", "clicked", "score", "id", 5).select(r6("ndcg").alias("ndcg"))


@query("met_wll", f"WITH {IMP} SELECT {s6(WLL)} AS wll, {s6(f'sum(CASE WHEN clicked = 1 THEN 3 ELSE 1 END * {LOSS}) / sum(CASE WHEN clicked = 1 THEN 3 ELSE 1 END)')} AS wll_3to1 FROM imp")
def _(spark, sf):
    imp = impressions(spark, sf)
    given = met.weighted_log_loss(imp, "clicked", "score", (1.0, 3.0)).scalar()
    return met.weighted_log_loss(imp, "clicked", "score").select(r6("wll").alias("wll"), r6(given).alias("wll_3to1"))


@query("met_score", f"""
WITH {IMP}, {curve_sql('imp')}, w AS (SELECT {WLL} AS wll FROM imp)
SELECT {s6('ap')} AS ap, {s6('wll')} AS wll, {s6('1 / (1 + wll)')} AS wll_component, {s6('0.5::DOUBLE * ap + 0.5::DOUBLE / (1 + wll)')} AS final_score FROM c, w
""")
def _(spark, sf):
    s = met.composite_score(impressions(spark, sf), "clicked", "score")
    return s.select(*[r6(c).alias(c) for c in s.columns])


MODELS = {"steady": "score", "inverse": "1 - score", "hashed": hash_unit_sql("id")}


def _model_rows(spark, sf):
    imp = impressions(spark, sf)
    scores = {"steady": F.col("score"), "inverse": 1 - F.col("score"), "hashed": hash_unit("id")}
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), s.alias("score")) for m, s in scores.items()])
    return imp.select("id", "clicked", F.explode(pairs).alias("m")).select("id", "clicked", "m.model", "m.score")


@query("met_compare", f"""
WITH {IMP}, mr AS ({_union([f"SELECT '{m}' AS model, clicked, {e} AS score FROM imp" for m, e in MODELS.items()])}),
{curve_sql('mr', 'model')}, w AS (SELECT model, {WLL} AS wll FROM mr GROUP BY 1),
f AS (SELECT model, ap, wll, 1 / (1 + wll) AS part, 0.5::DOUBLE * ap + 0.5::DOUBLE / (1 + wll) AS fs FROM c JOIN w USING (model))
SELECT model, {s6('ap')} AS ap, {s6('wll')} AS wll, {s6('part')} AS wll_component, {s6('fs')} AS final_score,
  CASE WHEN row_number() OVER (ORDER BY fs DESC, model) = 1 THEN 1 ELSE 0 END AS is_best FROM f
""")
def _(spark, sf):
    t = met.compare_models(_model_rows(spark, sf), "model", "clicked", "score")
    return t.select("model", *[r6(c).alias(c) for c in ("ap", "wll", "wll_component", "final_score")], "is_best")


@query("met_evaluate", f"""
WITH {_GROUPED}, {ndcg_sql(3)}, all_c AS (SELECT CAST(clicked AS DOUBLE) AS y, score FROM imp),
cell2 AS (SELECT score, CAST(sum(clicked) AS DOUBLE) AS p, CAST(count(*) AS DOUBLE) AS n FROM imp GROUP BY 1),
cum2 AS (SELECT *, sum(p) OVER w AS cp, sum(n) OVER w AS cn FROM cell2 WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
rk AS (SELECT user_id, clicked, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, id) AS r FROM imp),
mg AS (SELECT user_id, sum(clicked / r::DOUBLE) / (sum(clicked) + 1e-12::DOUBLE) AS m FROM rk GROUP BY 1)
SELECT 'logloss' AS metric, {s6(f'avg({LOSS})')} AS value FROM imp
UNION ALL SELECT 'AUC', {s6('1 - sum(p * (cn - cp - (n - p) + (n - p) / 2)) / (sum(p) * sum(n - p))')} FROM cum2
UNION ALL SELECT 'gAUC', {s6('sum(auc * (np + nn)) / sum(np + nn)')} FROM g
UNION ALL SELECT 'avgAUC', {s6('avg(auc)')} FROM g
UNION ALL SELECT 'MRR', {s6('avg(m)')} FROM mg
UNION ALL SELECT 'NDCG(k=3)', {s6('avg(v)')} FROM n
""")
def _(spark, sf):
    names = ["logloss", "AUC", "gAUC", "avgAUC", "MRR", "NDCG(k=3)"]
    out = met.evaluate(impressions(spark, sf), names, "clicked", "score", "user_id", "id")
    return out.select("metric", r6("value").alias("value"))


@query("met_custom_group", f"""
WITH {IMP}, rk AS (SELECT user_id, clicked, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, id) AS r FROM imp),
h AS (SELECT user_id, max(CASE WHEN r <= 10 THEN clicked ELSE 0 END) AS hit, count(*) AS n FROM rk GROUP BY 1)
SELECT {s6('sum(hit * n) / sum(n)')} AS value FROM h
""")
def _(spark, sf):
    hit = F.max(F.when(F.col("rank") <= 10, F.col("label")).otherwise(0.0))
    rows = met.custom_group_metric(impressions(spark, sf), "user_id", "clicked", "score", "id", hit * F.count(F.lit(1)), F.count(F.lit(1)))
    return met.weighted_combination(rows, "value", "weight").select(r6("value").alias("value"))


@query("met_multitask", f"""
WITH {IMP}, t AS (SELECT clicked, score, CAST(event_type = 'purchase' AS INTEGER) AS bought, 1 - score AS s2 FROM imp),
a AS (SELECT {s6(f'avg({LOSS})', 12)} AS v FROM t), b AS (SELECT {s6('avg(' + LOSS.replace('score', 's2').replace('clicked', 'bought') + ')', 12)} AS v FROM t)
SELECT 'click_logloss' AS name, {s6('v')} AS value FROM a UNION ALL SELECT 'buy_logloss', {s6('v')} FROM b
UNION ALL SELECT 'logloss', {s6('(a.v + b.v) / 2')} FROM a, b
""")
def _(spark, sf):
    imp = impressions(spark, sf).withColumns({"bought": (F.col("event_type") == "purchase").cast("int"), "s2": 1 - F.col("score")})
    out = met.multitask(imp, [("click", "clicked", "score"), ("buy", "bought", "s2")], ["logloss"])
    return out.select("name", r6("value").alias("value"))
