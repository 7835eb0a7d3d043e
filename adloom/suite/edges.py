"""Queries on awkward input: missing and NaN values, shared vocabularies, large vocabularies on streams, stored settings."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.operators import encode as enc
from adloom.operators import metrics as met
from adloom.operators import profile as prof
from adloom.operators.sampling import hash_split
from adloom.plans import encoder as plan
from adloom.session import scratch_path
from adloom.sources import readers, writers
from adloom.streaming import jobs
from adloom.suite.common import CUTS, IMP, hash_split_sql, impressions, joined_ids, query, r6, s6, table, tokens_sql
from adloom.suite.encoding import DOC_COUNTS, _table_sql, fit_table, vocab_sql
from adloom.suite.reports import LOSS, WLL, curve_sql
from adloom.suite.vectors import _run, _staged

# A score is missing, NaN or paired with a missing label where the id is divisible by 5, 7 or 11.
KNOWN = f"{IMP}, ok AS (SELECT * FROM imp WHERE id % 5 <> 0 AND id % 7 <> 0 AND id % 11 <> 0)"


def _spoilt(spark, sf):
    hole = lambda n: F.col("id") % n == 0
    score = F.when(hole(5), F.lit(None)).when(hole(7), F.lit(float("nan"))).otherwise(F.col("score"))
    label = F.when(hole(11), F.lit(None)).otherwise(F.col("clicked").cast("double"))
    return impressions(spark, sf).withColumns({"score": score, "clicked": label})


@query("met_nulls", f"""
WITH {KNOWN}, {curve_sql('ok')} SELECT {s6('auc')} AS auc, {s6('ap')} AS ap, (SELECT {s6(f'avg({LOSS})')} FROM ok) AS logloss,
  (SELECT {s6(WLL)} FROM ok) AS wll, (SELECT count(*) FROM imp) - (SELECT count(*) FROM ok) AS n_unscored FROM c
""")
def _(spark, sf):
    df = _spoilt(spark, sf)
    one = met.curve_metrics(df, "clicked", "score").select(r6("auc").alias("auc"), r6("ap").alias("ap"))
    parts = {"logloss": met.log_loss(df, "clicked", "score"), "wll": met.weighted_log_loss(df, "clicked", "score"), "n_unscored": met.unscored(df, "clicked", "score")}
    return one.select("*", *[(p.scalar() if n == "n_unscored" else r6(p.scalar())).alias(n) for n, p in parts.items()])


@query("met_group_nulls", f"""
WITH {KNOWN}, {curve_sql('ok', 'user_id')}, g AS (SELECT * FROM c WHERE np > 0 AND nn > 0),
r AS (SELECT user_id, clicked, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, id) AS rk FROM ok),
m AS (SELECT user_id, sum(clicked / rk) / (sum(clicked) + 1e-12) AS v, max(CASE WHEN rk = 1 THEN clicked END) AS first, max(clicked) AS best FROM r GROUP BY 1)
SELECT 'gAUC' AS metric, {s6('sum(auc * (np + nn)) / sum(np + nn)')} AS value FROM g
UNION ALL SELECT 'MRR', {s6('avg(v)')} FROM m UNION ALL SELECT 'NDCG()', {s6('avg(first / (best + 1e-12))')} FROM m
""")
def _(spark, sf):
    out = met.evaluate(_spoilt(spark, sf), ["gAUC", "MRR", "NDCG()"], "clicked", "score", "user_id", "id")
    return out.select("metric", r6("value").alias("value"))


@query("agg_min_max_nan", f"WITH {KNOWN} SELECT 'score' AS \"column\", {s6('min(score)')} AS min, {s6('max(score)')} AS max FROM imp WHERE id % 5 <> 0 AND id % 7 <> 0")
def _(spark, sf):
    return prof.min_max(_spoilt(spark, sf), ["score"]).withColumns({"min": r6("min"), "max": r6("max")})


@query("agg_corr_nan", f"WITH {KNOWN} SELECT 'score' AS \"column\", {s6('corr(score, clicked)')} AS corr FROM ok")
def _(spark, sf):
    return prof.label_correlation(_spoilt(spark, sf), ["score"], "clicked").withColumn("corr", r6("corr"))


@query("agg_hist_nan", f"""
WITH {KNOWN}, f AS (SELECT score FROM imp WHERE id % 5 <> 0 AND id % 7 <> 0), s AS (SELECT min(score) AS lo, max(score) AS hi FROM f),
b AS (SELECT CAST(least(floor((score - lo) * 10 / (hi - lo)), 9) AS INTEGER) AS bin FROM f, s)
SELECT 'width' AS kind, bin, count(*) AS cnt FROM b GROUP BY 2
UNION ALL SELECT 'range', 0, count(*) FILTER (score < 0.5) FROM f UNION ALL SELECT 'range', 1, count(*) FILTER (score >= 0.5) FROM f
""")
def _(spark, sf):
    df = _spoilt(spark, sf)
    width = prof.equal_width_histogram(df, "score").where("cnt > 0").select(F.lit("width").alias("kind"), "bin", "cnt")
    return width.unionByName(prof.range_histogram(df, "score", [0.0, 0.5]).select(F.lit("range").alias("kind"), "bin", "cnt"))


@query("enc_shared_noremap", """
WITH a AS (SELECT DISTINCT l_suppkey AS token FROM lineitem), b AS (SELECT DISTINCT l_partkey AS token FROM lineitem WHERE l_partkey NOT IN (SELECT token FROM a)),
v AS (SELECT token FROM a UNION ALL SELECT token FROM b)
SELECT CAST(token AS VARCHAR) AS token, CAST(token AS BIGINT) AS idx FROM v UNION ALL SELECT '__PAD__', 0 UNION ALL SELECT '__OOV__', CAST(max(token) + 1 AS BIGINT) FROM v
""")
def _(spark, sf):
    spec = [
        {"name": "l_suppkey", "type": "categorical", "dtype": "str", "remap": False},
        {"name": "l_partkey", "type": "categorical", "dtype": "str", "remap": False, "share_embedding": "l_suppkey"},
    ]
    return plan.fit(table(spark, sf, "lineitem").select("l_suppkey", "l_partkey"), spec, []).vocab.select("token", "idx")


@query("enc_shared_three", """
WITH t AS (SELECT CAST(l_suppkey AS VARCHAR) AS token, 0 AS place FROM lineitem UNION ALL SELECT CAST(l_partkey AS VARCHAR), 1 FROM lineitem
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 2 FROM lineitem), f AS (SELECT token, min(place) AS place FROM t GROUP BY 1),
v AS (SELECT token, row_number() OVER (ORDER BY place, token) AS idx FROM f)
SELECT token, idx FROM v UNION ALL SELECT '__PAD__', 0 UNION ALL SELECT '__OOV__', max(idx) + 1 FROM v
""")
def _(spark, sf):
    names = ["l_suppkey", "l_partkey", "l_orderkey"]
    spec = [{"name": n, "type": "categorical", "dtype": "str", **({"share_embedding": names[0]} if i else {})} for i, n in enumerate(names)]
    return plan.fit(table(spark, sf, "lineitem").select(*names), spec, []).vocab.select("token", "idx")


@query("prj_override_loaded", _table_sql(f"SELECT id, event_type, hour, {s6('(value * vb + va) / 2')} AS value FROM enc, m"))
def _(spark, sf):
    """A stored encoder, restricted to three features, one of them without its normalizer."""
    sp, fitted = fit_table(spark, sf)
    path = scratch_path(spark, "encoder")
    fitted.save(path)
    again = plan.load(spark, path, "events", ["event_type", "hour", "value"], {"value": {"normalizer": None}})
    out = again.transform(sp.withColumn("value", F.col("value") / 2), keep=["id"])
    return out.select("id", "event_type", "hour", r6("value").alias("value"))


@query("str_transform_sequence", f"""
WITH {DOC_COUNTS}, {vocab_sql('dc')}, t AS (SELECT doc_id, unnest({tokens_sql('text')}) AS token, generate_subscripts({tokens_sql('text')}, 1) AS p, len({tokens_sql('text')}) AS n FROM documents)
SELECT d.doc_id, string_agg(CAST(CASE WHEN coalesce(t.token, '') = '' THEN 0 ELSE v.idx END AS VARCHAR), ',' ORDER BY i) AS ids
FROM documents d CROSS JOIN range(1, 21) r(i) LEFT JOIN t ON t.doc_id = d.doc_id AND t.p = r.i LEFT JOIN voc v ON v.token = t.token GROUP BY 1
""")
def _(spark, sf):
    """A sequence vocabulary past the in-row limit, on a stream: the joined form runs in each micro-batch."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    spec = [{"name": "text", "type": "sequence", "dtype": "str", "splitter": " ", "max_len": 20, "padding": "post"}]
    fitted = plan.fit(docs, spec, [])
    path, out, ckpt = (scratch_path(spark, n) for n in ("arriving", "encoded", "ckpt"))
    limit, enc.INLINE_TOKENS = enc.INLINE_TOKENS, 10
    try:
        # The documents arrive in two parts, each a batch of as many files as the scan has tasks.
        for k in range(2):
            docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == k).write.mode("append").parquet(path)
            _run(jobs.transform_stream(jobs.file_stream(spark, path, docs.schema, None), fitted, out, ckpt, ["doc_id"]))
    finally:
        enc.INLINE_TOKENS = limit
    return spark.read.parquet(out).select("doc_id", joined_ids("text").alias("ids"))


@query("src_read_records", _table_sql(f"SELECT event_type, hour, dow, {s6('CAST(CAST(value AS FLOAT) AS DOUBLE)', 4)} AS value, CAST(clicked AS FLOAT) AS clicked FROM enc"))
def _(spark, sf):
    sp, fitted = fit_table(spark, sf)
    path = scratch_path(spark, "records")
    writers.write_encoded(fitted.transform(sp), path)
    out = readers.read_records(spark, path, fitted)
    return out.select("event_type", "hour", "dow", r6("value", 4).alias("value"), "clicked")


@query("snk_append_result", f"""
WITH {IMP}, n AS (SELECT {hash_split_sql('id')} AS experiment, CAST(count(*) AS DOUBLE) AS n_rows FROM imp GROUP BY 1) SELECT experiment, 'events' AS dataset, n_rows FROM n
""")
def _(spark, sf):
    path = scratch_path(spark, "results")
    sizes = hash_split(impressions(spark, sf), "id", CUTS).groupBy("split").count().collect()
    for r in sizes:
        writers.append_result(spark, path, r["split"], "events", {"n_rows": r["count"]})
    return spark.read.parquet(path).select("experiment", "dataset", F.col("metrics")["n_rows"].alias("n_rows"))


@query("arr_pad_longest", f"""
WITH t AS (SELECT doc_id, list_transform({tokens_sql('text')}, lambda w: len(w)) AS a FROM documents), m AS (SELECT max(len(a)) AS n FROM t)
SELECT doc_id, CAST(n AS INTEGER) AS width, CAST(n - len(a) AS INTEGER) AS padded, CAST(list_sum(a) AS BIGINT) AS total FROM t, m
""")
def _(spark, sf):
    lengths = F.transform(F.split("text", " "), lambda w: F.length(w))
    d = table(spark, sf, "documents").select("doc_id", F.when(F.col("text") == "", F.array().cast("array<int>")).otherwise(lengths).alias("a"))
    out = enc.pad_longest(d, "a", -1, "post")
    total = F.aggregate(F.filter("a", lambda x: x >= 0), F.lit(0).cast("bigint"), lambda s, x: s + x)
    return out.select("doc_id", F.size("a").alias("width"), F.size(F.filter("a", lambda x: x < 0)).alias("padded"), total.alias("total"))


# Twelve columns, so more pairs than one aggregate takes; the derived ones have nulls and a constant among them.
WIDE = {
    **{c: c for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey")},
    "q2": "l_quantity * l_quantity", "net": "l_extendedprice * (1 - l_discount)", "part": "CASE WHEN l_linenumber <> 3 THEN l_quantity END",
    "flat": "CASE WHEN l_linenumber = 1 THEN 7 END", "mix": "l_tax * 100 + l_linenumber",
}
WIDE_SQL = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in WIDE.items())


@query("agg_corr_wide", f"WITH w AS (SELECT {WIDE_SQL} FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, " + ("NULL AS corr" if "flat" in (a, b) else s6(f"corr({a}, {b})", 4) + " AS corr FROM w") for a in WIDE for b in WIDE))
def _(spark, sf):
    wide = table(spark, sf, "lineitem").selectExpr(*[f"CAST({e} AS DOUBLE) AS {n}" for n, e in WIDE.items()])
    return prof.correlation_matrix(wide, list(WIDE)).withColumn("corr", r6("corr", 4))
