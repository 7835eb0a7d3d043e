"""Vector operators, submissions, models and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.operators import vectors as vec
from adloom.operators.metrics import auc as auc_of
from adloom.operators.sampling import hash_split
from adloom.plans import models, submission
from adloom.session import materialize, scratch_path
from adloom.streaming import jobs
from adloom.suite.common import (
    CUTS, IMP, hash_split_sql, impressions, md5_int_sql, query, r6, s6, table,
)
from adloom.suite.encoding import _table_sql, fit_table, vocab_sql
from adloom.suite.reports import LOSS

# One row per vector element: (label, vec_id, dim, x).
CELLS = """cell AS (SELECT label, vec_id, unnest(range(0, 64)) AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"""
# The 64 elements of a vector seen as 4 fields of 16: (vec_id, f, d, x).
FIELDS = f"""{CELLS}, fld AS (SELECT vec_id, dim // 16 AS f, dim % 16 AS d, x FROM cell)"""
N_FIELDS = 4


def emb(spark, sf):
    return table(spark, sf, "embeddings")


def fields(spark, sf):
    return emb(spark, sf).select("vec_id", vec.as_fields("embedding", N_FIELDS).alias("fields"))


# ---- grouped vectors ---------------------------------------------------------------------------


@query("vec_sum_pool", f"WITH {CELLS} SELECT label, dim, {s6('sum(x)')} AS value FROM cell GROUP BY 1, 2")
def _(spark, sf):
    return vec.sum_pooling(emb(spark, sf), "label", "embedding").withColumn("value", r6("value"))


@query("vec_avg_pool", f"WITH {CELLS} SELECT label, dim, {s6('sum(x) / (count(*) + 1e-12::DOUBLE)')} AS value FROM cell GROUP BY 1, 2")
def _(spark, sf):
    e = emb(spark, sf)
    # Padding vectors (all zero) do not count.
    padded = e.unionAll(e.select("vec_id", F.transform("embedding", lambda x: x * F.lit(0).cast("float")).alias("embedding"), "label"))
    return vec.average_pooling(padded, "label", "embedding").withColumn("value", r6("value"))


@query("vec_kmax", f"""
WITH {CELLS}, r AS (SELECT *, row_number() OVER (PARTITION BY label, dim ORDER BY x DESC, vec_id) AS rk FROM cell)
SELECT label, dim, row_number() OVER (PARTITION BY label, dim ORDER BY vec_id) - 1 AS slot, {s6('x')} AS value FROM r WHERE rk <= 3
""")
def _(spark, sf):
    return vec.kmax_pooling(emb(spark, sf), "label", "vec_id", "embedding", 3).withColumn("value", r6("value"))


@query("vec_fm", f"WITH {CELLS} SELECT label, dim, {s6('(sum(x) * sum(x) - sum(x * x)) / 2')} AS value FROM cell GROUP BY 1, 2")
def _(spark, sf):
    return vec.bi_interaction(emb(spark, sf), "label", "embedding").withColumn("value", r6("value"))


@query("vec_fm_sum", f"WITH {CELLS}, d AS (SELECT label, dim, (sum(x) * sum(x) - sum(x * x)) / 2 AS v FROM cell GROUP BY 1, 2) SELECT label, {s6('sum(v)')} AS value FROM d GROUP BY 1")
def _(spark, sf):
    return vec.product_sum(emb(spark, sf), "label", "embedding").withColumn("value", r6("value"))


@query("vec_sympoly", f"""
WITH {CELLS}, p AS (SELECT label, dim, sum(x) AS a, sum(x * x) AS b, sum(x * x * x) AS c, sum(pow(x, 4)) AS d, sum(pow(x, 5)) AS e FROM cell GROUP BY 1, 2)
SELECT label, dim, {s6('a')} AS e1, {s6('(a * a - b) / 2')} AS e2, {s6('(pow(a, 3) - 3 * a * b + 2 * c) / 6')} AS e3,
  {s6('(pow(a, 4) - 6 * a * a * b + 3 * b * b + 8 * a * c - 6 * d) / 24', 5)} AS e4,
  {s6('(pow(a, 5) - 10 * pow(a, 3) * b + 20 * a * a * c - 30 * a * d - 20 * b * c + 15 * a * b * b + 24 * e) / 120', 4)} AS e5 FROM p
""")
def _(spark, sf):
    out = vec.symmetric_polynomials(emb(spark, sf), "label", "embedding", 5)
    return out.select("label", "dim", *[r6(c, d).alias(c) for c, d in (("e1", 6), ("e2", 6), ("e3", 6), ("e4", 5), ("e5", 4))])


_TARGETS = """tgt AS (SELECT label, dim, arg_min(x, vec_id) AS t FROM cell GROUP BY 1, 2)"""


@query("vec_attention", f"""
WITH {CELLS}, {_TARGETS}, s AS (SELECT label, vec_id, sum(x * t) / 8.0::DOUBLE AS s FROM cell JOIN tgt USING (label, dim) GROUP BY 1, 2),
w AS (SELECT label, vec_id, exp(s - max(s) OVER (PARTITION BY label)) AS w FROM s)
SELECT label, dim, {s6('sum(w * x) / sum(w)')} AS value FROM cell JOIN w USING (label, vec_id) GROUP BY 1, 2
""")
def _(spark, sf):
    e = emb(spark, sf)
    targets = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("target"))
    return vec.target_attention(e, targets, "label", "embedding", "target").withColumn("value", r6("value"))


@query("vec_attention_heads", f"""
WITH {CELLS}, {_TARGETS}, s AS (SELECT label, vec_id, dim // 32 AS h, sum(x * t) / sqrt(32.0::DOUBLE) AS s, vec_id % 2 AS live FROM cell JOIN tgt USING (label, dim) GROUP BY 1, 2, 3),
m AS (SELECT label, vec_id, h, CASE WHEN live = 0 THEN -1e9::DOUBLE ELSE s END AS s FROM s),
w AS (SELECT label, vec_id, h, exp(s - max(s) OVER (PARTITION BY label, h)) AS w FROM m)
SELECT c.label, dim, {s6('sum(w * x) / sum(w)')} AS value FROM cell c JOIN w ON w.label = c.label AND w.vec_id = c.vec_id AND w.h = c.dim // 32 GROUP BY 1, 2
""")
def _(spark, sf):
    e = emb(spark, sf).withColumn("live", F.col("vec_id") % 2)
    targets = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("target"))
    return vec.target_attention(e, targets, "label", "embedding", "target", heads=2, mask="live").withColumn("value", r6("value"))


@query("vec_squeeze", f"WITH {CELLS} SELECT vec_id, {s6('avg(x)')} AS value FROM cell GROUP BY 1")
def _(spark, sf):
    return vec.squeeze(emb(spark, sf), "vec_id", "embedding").withColumn("value", r6("value"))


@query("jn_embedding_lookup", f"""
WITH {CELLS}, o AS (SELECT l_orderkey, CAST(l_partkey AS BIGINT) AS vec_id FROM lineitem)
SELECT l_orderkey, count(*) FILTER (WHERE dim = 0) AS n, {s6('sum(x * (dim + 1))', 4)} AS total FROM o JOIN cell USING (vec_id) GROUP BY 1
""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    found = vec.embedding_lookup(li, "l_orderkey", "l_partkey", emb(spark, sf), "vec_id", "embedding")
    # Every element counts, by its place.
    weighted = F.aggregate(F.transform("vector", lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return found.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), r6(F.sum(weighted), 4).alias("total"))


@query("vec_lookup_pool", f"""
WITH {CELLS}, ids AS (SELECT conv_id, vec_id FROM (SELECT conv_id, unnest([turn, len(text) % 97, conv_id % 400]) AS vec_id FROM conversations)),
j AS (SELECT conv_id, dim, x FROM ids JOIN cell USING (vec_id))
SELECT conv_id, dim, {s6('sum(x)')} AS value FROM j GROUP BY 1, 2
""")
def _(spark, sf):
    conv = table(spark, sf, "conversations")
    ids = F.array("turn", F.length("text") % 97, F.col("conv_id") % 400).cast("array<bigint>")
    rows = conv.select("conv_id", ids.alias("ids"))
    found = vec.embedding_lookup(rows, "conv_id", "ids", emb(spark, sf), "vec_id", "embedding")
    return vec.sum_pooling(found, "conv_id", "vector").withColumn("value", r6("value"))


@query("vec_numeric_embedding", f"SELECT event_id, {s6('value * 0.5')} AS a, {s6('value * -0.25')} AS b FROM events")
def _(spark, sf):
    v = vec.numeric_embedding(table(spark, sf, "events"), "event_id", "value", [0.5, -0.25])
    return v.select("event_id", r6(F.get("vector", F.lit(0))).alias("a"), r6(F.get("vector", F.lit(1))).alias("b"))


# ---- fields of a row -----------------------------------------------------------------------------


@query("vec_inner", f"WITH {FIELDS} SELECT a.vec_id, CAST(a.f AS INTEGER) AS i, CAST(b.f AS INTEGER) AS j, {s6('sum(a.x * b.x)')} AS value FROM fld a JOIN fld b ON a.vec_id = b.vec_id AND a.d = b.d AND a.f < b.f GROUP BY 1, 2, 3")
def _(spark, sf):
    return vec.inner_products(fields(spark, sf), "vec_id", "fields", N_FIELDS).withColumn("value", r6("value"))


def _long(df):
    return df.select("vec_id", "i", "j", F.posexplode("vector").alias("d", "x")).select("vec_id", "i", "j", "d", r6("x", 5).alias("value"))


@query("vec_hadamard", f"WITH {FIELDS} SELECT a.vec_id, CAST(a.f AS INTEGER) AS i, CAST(b.f AS INTEGER) AS j, a.d, {s6('a.x * b.x', 5)} AS value FROM fld a JOIN fld b ON a.vec_id = b.vec_id AND a.d = b.d AND a.f < b.f")
def _(spark, sf):
    return _long(vec.elementwise_products(fields(spark, sf), "vec_id", "fields", N_FIELDS))


def _circular_sql(sign: str) -> str:
    shift = "(a.d + b.d) % 16" if sign == "-" else "(b.d - a.d + 16) % 16"
    return f"""
WITH {FIELDS} SELECT a.vec_id, CAST(a.f AS INTEGER) AS i, CAST(b.f AS INTEGER) AS j, {shift} AS d, {s6('sum(a.x * b.x)', 5)} AS value
FROM fld a JOIN fld b ON a.vec_id = b.vec_id AND a.f < b.f GROUP BY 1, 2, 3, 4"""


@query("vec_circular", _circular_sql("-"))
def _(spark, sf):
    return _long(vec.circular_products(fields(spark, sf), "vec_id", "fields", N_FIELDS))


@query("vec_circular_correlation", _circular_sql("+"))
def _(spark, sf):
    return _long(vec.circular_products(fields(spark, sf), "vec_id", "fields", N_FIELDS, "circular_correlation"))


@query("vec_stack", f"""
WITH f AS (SELECT vec_id, list_concat(embedding, list_transform(embedding, lambda x: -x)) AS v FROM embeddings),
u AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS pos FROM f)
SELECT vec_id, 2 AS n_fields, CAST(pos AS INTEGER) AS pos, {s6('x')} AS value FROM u
""")
def _(spark, sf):
    e = emb(spark, sf).withColumn("negated", F.transform("embedding", lambda x: -x))
    s = e.select("vec_id", vec.stack_fields("embedding", "negated").alias("f"))
    flat = s.select("vec_id", F.size("f").alias("n_fields"), F.posexplode(vec.concat_fields("f")).alias("pos", "value"))
    return flat.select("vec_id", "n_fields", "pos", r6("value").alias("value"))


# ---- submissions -----------------------------------------------------------------------------------


def _sample_and_scores(spark, sf):
    """All ids, and scores for the training part of them plus ids nobody asked for."""
    imp = impressions(spark, sf)
    scored = hash_split(imp, "id", CUTS).where("split = 'train'").select(F.col("id").alias("ID"), "score")
    extra = table(spark, sf, "orders").select((-F.col("o_orderkey") - 1).alias("ID"), F.lit(0.25).alias("score"))
    return imp.select(F.col("id").alias("ID")), scored.unionAll(extra)


_SCORED = f"sc AS (SELECT id, score FROM imp WHERE {hash_split_sql('id')} = 'train' UNION ALL SELECT -o_orderkey - 1, 0.25::DOUBLE FROM orders)"


@query("sub_truncate", f"WITH {IMP}, {_SCORED} SELECT id AS \"ID\", sc.score AS clicked FROM imp JOIN sc USING (id)")
def _(spark, sf):
    sample, scores = _sample_and_scores(spark, sf)
    return submission.attach_matched(sample, scores, "ID", "score")


@query("sub_meanfill", f"WITH {IMP}, {_SCORED} SELECT id AS \"ID\", {s6('coalesce(sc.score, (SELECT avg(score) FROM sc))')} AS clicked FROM imp LEFT JOIN sc USING (id)")
def _(spark, sf):
    sample, scores = _sample_and_scores(spark, sf)
    return submission.attach_filled(sample, scores, "ID", "score").withColumn("clicked", r6("clicked"))


@query("sub_match_report", f"""
WITH {IMP}, {_SCORED} SELECT count(*) FILTER (WHERE i.id IS NOT NULL AND sc.id IS NOT NULL) AS matched, count(*) FILTER (WHERE sc.id IS NULL) AS without_prediction,
  count(*) FILTER (WHERE i.id IS NULL) AS unused_predictions FROM imp i FULL JOIN sc ON sc.id = i.id
""")
def _(spark, sf):
    sample, scores = _sample_and_scores(spark, sf)
    return submission.match_report(sample, scores, "ID")


@query("agg_validate", f"""
WITH {IMP} SELECT 'columns' AS "check", 1 AS passed, 'ID,clicked' AS detail UNION ALL SELECT 'rows', CAST(count(*) > 0 AS INTEGER), CAST(count(*) AS VARCHAR) FROM imp
UNION ALL SELECT 'nulls', 1, '0' UNION ALL SELECT 'range', CAST(count(*) = 0 AS INTEGER), CAST(count(*) AS VARCHAR) FROM imp WHERE value / 100 > 1
""")
def _(spark, sf):
    return submission.validate(impressions(spark, sf).select(F.col("id").alias("ID"), (F.col("value") / 100).alias("clicked")))


@query("sub_submit", f"WITH {IMP} SELECT CAST(id AS VARCHAR) AS \"ID\", score AS clicked FROM imp")
def _(spark, sf):
    path = scratch_path(spark, "submission")
    submission.submit(impressions(spark, sf).select(F.col("id").alias("ID"), F.col("score").alias("clicked")), path)
    return spark.read.schema("ID string, clicked double").option("header", True).csv(path)


# ---- baselines and models -----------------------------------------------------------------------------


@query("ml_constant_baseline", "SELECT event_id, 0.018::DOUBLE AS clicked FROM events")
def _(spark, sf):
    return models.constant_baseline(table(spark, sf, "events"), "event_id", 0.018)


@query("ml_hashed_baseline", f"SELECT event_id, {s6('least(0.2::DOUBLE, (' + md5_int_sql('event_id') + ' % 1000) / 10000.0::DOUBLE + 0.01::DOUBLE)')} AS clicked FROM events")
def _(spark, sf):
    return models.hashed_baseline(table(spark, sf, "events"), "event_id").withColumn("clicked", r6("clicked"))


@query("ml_category_rate", f"""
WITH {IMP}, sp AS (SELECT *, {hash_split_sql('id')} AS split FROM imp), o AS (SELECT avg(clicked) AS r FROM sp WHERE split = 'train'),
g AS (SELECT user_id, sum(clicked) AS c, count(*) AS n FROM sp WHERE split = 'train' GROUP BY 1)
SELECT id, {s6('(coalesce(c, 0) + (SELECT r FROM o) * 20) / (coalesce(n, 0) + 20)')} AS clicked FROM sp LEFT JOIN g USING (user_id)
""")
def _(spark, sf):
    sp = hash_split(impressions(spark, sf), "id", CUTS)
    return models.category_rate_baseline(sp.where("split = 'train'"), sp, "id", "user_id", "clicked").withColumn("clicked", r6("clicked"))


@query("ml_external_score", f"WITH {IMP} SELECT id, {s6('1 / (1 + exp(-(0.02 * value - 0.01 * k)))')} AS score FROM imp")
def _(spark, sf):
    import numpy as np

    def predict(pdf):
        return 1 / (1 + np.exp(-(0.02 * pdf["value"] - 0.01 * pdf["k"])))

    return models.score_external(impressions(spark, sf), predict, ["value", "k"], ["id"]).withColumn("score", r6("score"))


def _trained(spark, sf, kind, **params):
    """Encoded impressions, label = purchase of a high value, so that there is something to learn."""
    sp, fitted = fit_table(spark, sf)
    y = (F.col("value") > 0.2).cast("double")
    coded = fitted.transform(sp, keep=["id", "split", "user_id"]).withColumn("clicked", y)
    coded = materialize(coded, "coded")
    model = models.fit_model(coded.where("split = 'train'"), kind, ["hour", "dow"], ["value", "k"], "clicked", **params)
    return coded, model


_TEST_SPLIT = _table_sql("SELECT id, CAST(value > 0.2 AS INTEGER) AS clicked, 1 AS in_range, 1 AS separates FROM enc WHERE split = 'test'")


def _facts(scored):
    """What holds of any sound model here: probabilities for all rows, and an AUC above 0.9 for a separable label."""
    scored = materialize(scored.select("id", F.col("clicked").cast("int").alias("clicked"), "score"), "scored")
    auc = auc_of(scored, "clicked", "score").scalar()
    return scored.select("id", "clicked", F.col("score").between(0, 1).cast("int").alias("in_range"), (auc > 0.9).cast("int").alias("separates"))


@query("ml_lr", _TEST_SPLIT)
def _(spark, sf):
    coded, model = _trained(spark, sf, "logistic", maxIter=20)
    return _facts(models.score(model, coded.where("split = 'test'")))


@query("ml_fm", _TEST_SPLIT)
def _(spark, sf):
    coded, model = _trained(spark, sf, "fm", maxIter=200, factorSize=4, seed=7, stepSize=0.5)
    return _facts(models.score(model, coded.where("split = 'test'")))


@query("ml_mlp", _TEST_SPLIT)
def _(spark, sf):
    coded, model = _trained(spark, sf, "mlp", maxIter=20, seed=7, hidden=[8])
    return _facts(models.score(model, coded.where("split = 'test'")))


@query("ml_evaluate", "SELECT * FROM (VALUES ('AUC', 1), ('logloss', 1), ('gAUC', 1), ('MRR', 1)) t(metric, plausible)")
def _(spark, sf):
    """Each metric of the separable label lies where it has to: AUCs above 0.9, loss below that of a coin, MRR in (0, 1]."""
    coded, model = _trained(spark, sf, "logistic", maxIter=20)
    out = models.evaluate_model(model, coded.where("split = 'valid'"), ["AUC", "logloss", "gAUC", "MRR"], "clicked", "user_id", "id")
    good = F.when(F.col("metric").isin("AUC", "gAUC"), F.col("value") > 0.9).when(F.col("metric") == "logloss", F.col("value") < 0.6932)
    return out.select("metric", good.otherwise((F.col("value") > 0) & (F.col("value") <= 1)).cast("int").alias("plausible"))


@query("ml_grid", "SELECT 'elasticNetParam=' || e || ', regParam=' || r AS params, 1 AS plausible FROM (VALUES ('0.0'), ('1.0')) a(e), (VALUES ('0.0'), ('0.1')) b(r)")
def _(spark, sf):
    """Every combination once; each better than a coin, or at it where the penalty takes all weights."""
    coded, _ = _trained(spark, sf, "logistic", maxIter=5)
    grid = {"regParam": [0.0, 0.1], "elasticNetParam": [0.0, 1.0]}
    found = models.grid_search(coded.where("split = 'train'"), ["hour"], ["value", "k"], "clicked", grid)
    return models.grid_table(found, coded).select("params", F.col("metric").between(0.5, 1).cast("int").alias("plausible"))


# ---- streams ---------------------------------------------------------------------------------------------


def _staged(spark, sf, parts: int = 4):
    """The impressions as a folder of files in id order, its schema, and how many files make ``parts`` batches.

    There are as many files as the scan has tasks, or a few more, so that no task writes a fixed share of the table.
    """
    path = scratch_path(spark, "arriving")
    imp = impressions(spark, sf)
    files = -(-imp.rdd.getNumPartitions() // parts)
    imp.repartitionByRange(parts * files, "id").sortWithinPartitions("id").write.parquet(path)
    return path, imp.schema, files


def _run(stream_query):
    stream_query.awaitTermination()


@query("str_transform", _table_sql(f"SELECT id, event_type, hour, dow, {s6('value')} AS value, clicked FROM enc"))
def _(spark, sf):
    _, fitted = fit_table(spark, sf)
    path, schema, files = _staged(spark, sf)
    out = scratch_path(spark, "encoded")
    _run(jobs.transform_stream(jobs.file_stream(spark, path, schema, files), fitted, out, scratch_path(spark, "ckpt"), ["id"]))
    return spark.read.parquet(out).drop("batch").select("id", "event_type", "hour", "dow", r6("value").alias("value"), "clicked")


@query("str_counts", f"WITH {IMP} SELECT event_type, count(*) AS cnt, min(value) AS min_value, max(value) AS max_value FROM imp GROUP BY 1")
def _(spark, sf):
    path, schema, files = _staged(spark, sf)
    out = scratch_path(spark, "counts")
    _run(jobs.count_stream(jobs.file_stream(spark, path, schema, files), "event_type", "value", out, scratch_path(spark, "ckpt")))
    return jobs.latest(spark, out)


@query("str_vocab", f"WITH {IMP}, cc AS (SELECT DISTINCT 'user_id' AS feature, CAST(user_id AS VARCHAR) AS token FROM imp), {vocab_sql('cc')} SELECT token, idx FROM voc")
def _(spark, sf):
    """All files in one batch: the stream's vocabulary equals the batch one."""
    path, schema, _ = _staged(spark, sf)
    out = scratch_path(spark, "vocab")
    _run(jobs.vocab_stream(jobs.file_stream(spark, path, schema, None), "user_id", "id", out, scratch_path(spark, "ckpt")))
    return jobs.growing_vocab(spark, out, "user_id").select("token", "idx")


def _dealt(spark, sf, run):
    """The impressions arrive in four parts, by the remainder of the id; ``run(path, schema)`` makes one batch of each."""
    path, imp = scratch_path(spark, "dealt"), impressions(spark, sf)
    for k in range(4):
        imp.where(F.col("id") % 4 == k).write.mode("append").parquet(path)
        _run(run(path, imp.schema))


@query("str_vocab_growing", f"""
WITH {IMP}, u AS (SELECT CAST(user_id * 40 + CAST(k AS INTEGER) % 40 AS VARCHAR) AS token, id, id % 4 AS batch FROM imp),
t AS (SELECT token, min(batch) AS batch FROM u GROUP BY 1), o AS (SELECT token, batch, min(id) AS first FROM u JOIN t USING (token, batch) GROUP BY 1, 2),
n AS (SELECT token, row_number() OVER (ORDER BY batch, CASE WHEN batch = 0 THEN 0 ELSE first END, token) AS idx FROM o)
SELECT token, idx FROM n UNION ALL SELECT '__PAD__', 0 UNION ALL SELECT '__OOV__', (SELECT count(*) + 1 FROM n)
""")
def _(spark, sf):
    """Four batches: tokens of the first are numbered in order, later ones follow as they arrive."""
    out, ckpt = scratch_path(spark, "vocab"), scratch_path(spark, "ckpt")

    def run(path, schema):
        stream = jobs.file_stream(spark, path, schema, None).withColumn("key", F.col("user_id") * 40 + F.col("k").cast("int") % 40)
        return jobs.vocab_stream(stream, "key", "id", out, ckpt)

    _dealt(spark, sf, run)
    return jobs.growing_vocab(spark, out, "key").select("token", "idx")


@query("str_running_metrics", f"""
WITH {IMP}, r AS (SELECT batch, clicked, score FROM imp, range(4) b(batch) WHERE id % 4 <= batch),
p AS (SELECT batch, score, sum(clicked) AS pos, count(*) AS n FROM r GROUP BY 1, 2),
w AS (SELECT *, sum(pos) OVER v AS cum_pos, sum(n) OVER v AS cum_n FROM p WINDOW v AS (PARTITION BY batch ORDER BY score DESC)),
a AS (SELECT batch, 1 - sum(pos * (cum_n - cum_pos - (n - pos) / 2.0)) / (sum(pos) * sum(n - pos)) AS auc, sum(pos * cum_pos / cum_n) / sum(pos) AS ap FROM w GROUP BY 1),
l AS (SELECT batch, avg({LOSS}) AS logloss, count(*) AS n FROM r GROUP BY 1)
SELECT CAST(batch AS INTEGER) AS batch, {s6('auc')} AS auc, {s6('ap')} AS ap, {s6('logloss')} AS logloss, n FROM a JOIN l USING (batch)
""")
def _(spark, sf):
    """Metrics of everything seen so far, after each of four batches."""
    out, ckpt = scratch_path(spark, "running"), scratch_path(spark, "ckpt")
    _dealt(spark, sf, lambda path, schema: jobs.running_metric_stream(jobs.file_stream(spark, path, schema, None), "clicked", "score", out, ckpt))
    return spark.read.parquet(out).select("batch", *[r6(c).alias(c) for c in ("auc", "ap", "logloss")], "n")


@query("str_metrics", f"WITH {IMP} SELECT 'logloss' AS metric, {s6(f'avg({LOSS})')} AS value FROM imp")
def _(spark, sf):
    path, schema, _ = _staged(spark, sf)
    out = scratch_path(spark, "history")
    _run(jobs.metric_stream(jobs.file_stream(spark, path, schema, None), ["logloss"], "clicked", "score", out, scratch_path(spark, "ckpt")))
    return jobs.latest(spark, out).select("metric", r6("value").alias("value"))
