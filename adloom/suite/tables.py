"""Scans, sinks, samples, splits, projections, cleaning and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.functions import hooks, scalars
from adloom.functions.arrays import drop_blank, split_tokens
from adloom.operators import clean, sampling
from adloom.operators.joins import fits_broadcast, semi_join
from adloom.operators.metrics import top_k
from adloom.operators.profile import union_all
from adloom.operators.ranking import with_rank, with_row_index
from adloom.plans.encoder import prepare
from adloom.session import scratch_path
from adloom.sources import readers, writers
from adloom.spec import expand, labels
from adloom.suite.common import (
    CUTS, DOC_TOKENS, IMP, STRIP, hash_split_sql, hash_unit_sql, impressions, md5_int_sql, md5_sql, query, r6, s6, table,
    tokens_sql,
)

# ---- sources and sinks -----------------------------------------------------------------------


@query("src_read_text", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    writers.write_csv(table(spark, sf, "customer"), path)
    return readers.read_text_table(spark, path, ["c_custkey", "c_name", "c_mktsegment", "not_there"])


@query("src_parquet", "SELECT * FROM customer")
def _(spark, sf):
    return readers.read_table(spark, f"{sf}/customer.parquet")


@query("src_prune", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(spark, sf):
    return readers.read_table(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_orderstatus", "not_there"])


@query("src_row_count", "SELECT count(*) AS n_rows FROM lineitem")
def _(spark, sf):
    return readers.row_count(table(spark, sf, "lineitem"))


@query("src_limit_sql", "SELECT count(*) AS n_rows FROM (SELECT * FROM orders LIMIT 1000)")
def _(spark, sf):
    return readers.row_count(readers.sql_head(spark, f"{sf}/orders.parquet", 1000))


@query("src_column", "SELECT text FROM documents")
def _(spark, sf):
    return readers.read_column(spark, f"{sf}/documents.parquet", "text")


@query("snk_partitioned_roundtrip", f"""
WITH {IMP}, s AS (SELECT {hash_split_sql('id')} AS split, * FROM imp)
SELECT split, count(*) AS n_rows, {s6('avg(clicked)')} AS click_rate, {s6('avg(value)')} AS mean_value FROM s GROUP BY split
""")
def _(spark, sf):
    path = scratch_path(spark, "encoded")
    writers.write_encoded(sampling.hash_split(impressions(spark, sf), "id", CUTS), path, split="split")
    back = readers.read_encoded(spark, path)
    return back.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), r6(F.avg("clicked")).alias("click_rate"), r6(F.avg("value")).alias("mean_value")
    )


@query("src_encoded_split", f"""
WITH {IMP} SELECT id, event_type, clicked FROM imp WHERE {hash_split_sql('id')} = 'valid'
""")
def _(spark, sf):
    path = scratch_path(spark, "encoded")
    writers.write_encoded(sampling.hash_split(impressions(spark, sf), "id", CUTS), path, split="split")
    return readers.read_encoded(spark, path, "valid").select("id", "event_type", "clicked")


@query("snk_blocks", "SELECT least(500, count(*)) AS largest_block, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys FROM orders")
def _(spark, sf):
    path = scratch_path(spark, "blocks")
    writers.write_encoded(table(spark, sf, "orders"), path, max_records=500)
    blocks = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).scalar()
    whole = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("o_orderkey").alias("n_keys"))
    return whole.select(blocks.alias("largest_block"), "n_rows", "n_keys")


@query("snk_append", f"""
WITH {IMP} SELECT {hash_split_sql('id')} AS split, count(*) AS n_rows FROM imp GROUP BY 1
""")
def _(spark, sf):
    path = scratch_path(spark, "append")
    split = sampling.hash_split(impressions(spark, sf), "id", CUTS).select("id", "split", "value")
    for name, _ in CUTS:
        writers.append_table(split.where(F.col("split") == name), path)
    return spark.read.parquet(path).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


@query("snk_replace_column", "SELECT o_orderkey, o_orderstatus, lower(o_orderpriority) AS o_orderpriority FROM orders")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    new = orders.select("o_orderkey", F.lower("o_orderpriority").alias("o_orderpriority"))
    path = scratch_path(spark, "replaced")
    writers.write_encoded(writers.replace_column(orders, "o_orderpriority", new, "o_orderkey"), path)
    return spark.read.parquet(path)


@query("snk_keep_existing", "SELECT count(*) AS n_rows FROM nation")
def _(spark, sf):
    path = scratch_path(spark, "once")
    nation = table(spark, sf, "nation")
    writers.write_encoded(nation, path)
    writers.write_encoded(nation.unionAll(nation), path, if_exists="ignore")
    return readers.row_count(spark.read.parquet(path))


@query("snk_structure", f"""
WITH a AS (SELECT count(*) AS n, avg(CASE WHEN label <> 0 THEN 1.0 ELSE 0.0 END) AS z, max(len(embedding)) AS w,
                  avg(len(list_filter(embedding, lambda x: x <> 0))) AS ez FROM embeddings)
SELECT 'label' AS "column", 'int' AS dtype, n AS n_rows, 1 AS width, {s6('z')} AS avg_non_zero FROM a
UNION ALL SELECT 'embedding', 'array<float>', n, w, {s6('ez')} FROM a
""")
def _(spark, sf):
    rep = writers.structure_report(table(spark, sf, "embeddings"), ["label", "embedding"])
    return rep.withColumn("avg_non_zero", r6("avg_non_zero"))


# ---- samples and splits ------------------------------------------------------------------------


@query("idx_row_index", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_idx FROM events")
def _(spark, sf):
    return with_row_index(table(spark, sf, "events").select("event_id", "ts"), ["ts", "event_id"]).select("event_id", "row_idx")


@query("smp_first_n", "SELECT event_id, value FROM events ORDER BY ts, event_id LIMIT 1000")
def _(spark, sf):
    return sampling.first_rows(table(spark, sf, "events"), ["ts", "event_id"], 1000).select("event_id", "value")


@query("smp_hash_n", f"SELECT event_id, value FROM events ORDER BY {md5_sql('event_id')}, event_id LIMIT 500")
def _(spark, sf):
    return sampling.hash_sample(table(spark, sf, "events"), "event_id", 500).select("event_id", "value")


@query("smp_fraction", f"SELECT event_id FROM events WHERE {hash_unit_sql('event_id')} < 0.1::DOUBLE")
def _(spark, sf):
    return sampling.fraction_sample(table(spark, sf, "events"), "event_id", 0.1).select("event_id")


def _tail_sql(order: str, test: str, valid: str, by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    over = f"OVER (PARTITION BY {by})" if by else "OVER ()"
    return f"""
WITH {IMP}, r AS (
  SELECT id, clicked, row_number() OVER ({part}ORDER BY {order}) AS rn, count(*) {over} AS n FROM imp),
z AS (SELECT *, {test} AS t, {valid} AS v FROM r)
SELECT id, clicked, CASE WHEN rn > n - t THEN 'test' WHEN rn > n - t - v THEN 'valid' ELSE 'train' END AS split FROM z"""


@query("spl_sequential", _tail_sql("ts, id", "CAST(floor(n * 0.2::DOUBLE) AS BIGINT)", "CAST(floor(n * 0.1::DOUBLE) AS BIGINT)"))
def _(spark, sf):
    return sampling.sequential_split(impressions(spark, sf), ["ts", "id"], 0.1, 0.2).select("id", "clicked", "split")


@query("spl_positional", _tail_sql("id", "0", "CAST(floor(n * 0.1::DOUBLE) AS BIGINT)"))
def _(spark, sf):
    return sampling.sequential_split(impressions(spark, sf), ["id"], valid_size=0.1).select("id", "clicked", "split")


@query("spl_random_exact", _tail_sql(md5_sql("id"), "1000", "CAST(floor(n * 0.1::DOUBLE) AS BIGINT)"))
def _(spark, sf):
    return sampling.random_split(impressions(spark, sf), "id", 0.1, 1000).select("id", "clicked", "split")


@query("spl_hash", f"WITH {IMP} SELECT id, {hash_split_sql('id')} AS split FROM imp")
def _(spark, sf):
    return sampling.hash_split(impressions(spark, sf), "id", CUTS).select("id", "split")


@query("spl_stratified", _tail_sql(md5_sql("id"), "CAST(floor(n * 0.15::DOUBLE) AS BIGINT)", "CAST(floor(n * 0.15::DOUBLE) AS BIGINT)", "clicked"))
def _(spark, sf):
    return sampling.stratified_split(impressions(spark, sf), "id", "clicked").select("id", "clicked", "split")


@query("spl_report", f"""
WITH {IMP} SELECT {hash_split_sql('id')} AS split, count(*) AS n_rows, {s6('avg(clicked)')} AS click_rate FROM imp GROUP BY 1
""")
def _(spark, sf):
    rep = sampling.split_report(sampling.hash_split(impressions(spark, sf), "id", CUTS), "clicked")
    return rep.withColumn("click_rate", r6("click_rate"))


@query("srt_shuffle", f"SELECT o_orderkey, row_number() OVER (ORDER BY {md5_sql('o_orderkey', 42 * 1000003 + 1)}, o_orderkey) AS rank FROM orders")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    path = scratch_path(spark, "shuffled")
    sampling.shuffle_rows(orders, "o_orderkey", epoch=1).withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    return with_rank(spark.read.parquet(path), ["place"]).select("o_orderkey", "rank")


# ---- projections and filters -------------------------------------------------------------------

_EVENT_SPECS = [
    {"name": ["event_type", "hour"], "type": "categorical", "dtype": "str"},
    {"name": "dow", "type": "categorical", "dtype": "str", "active": False},
    {"name": "value", "type": "numeric", "dtype": "float", "fill_na": 0},
]


@query("prj_active", f"WITH {IMP} SELECT CAST(clicked AS DOUBLE) AS clicked, value, hour, event_type FROM imp")
def _(spark, sf):
    return prepare(impressions(spark, sf), expand(_EVENT_SPECS), labels({"name": "clicked", "dtype": "float"}))


@query("prj_prefix", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def _(spark, sf):
    return clean.by_prefix(table(spark, sf, "orders"), ["o_"], ["o_orderst", "o_orderdate"])


@query("prj_existing", "SELECT p_name, p_brand FROM part")
def _(spark, sf):
    return clean.keep_existing(table(spark, sf, "part"), ["p_name", "missing", "p_brand"])


@query("prj_dummy_label", "SELECT doc_id, lang, 0.0::DOUBLE AS clicked FROM documents")
def _(spark, sf):
    return clean.ensure_label(table(spark, sf, "documents").select("doc_id", "lang"))


@query("prj_copy", "SELECT doc_id, lang, lang AS lang_copy FROM documents")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    fn, arg = hooks.resolve("copy_from(lang)", "lang_copy")
    return docs.withColumn("lang_copy", fn(docs, arg))


@query("flt_split", f"WITH {IMP} SELECT id, value FROM imp WHERE {hash_split_sql('id')} = 'test'")
def _(spark, sf):
    return sampling.hash_split(impressions(spark, sf), "id", CUTS).where("split = 'test'").select("id", "value")


@query("flt_drop_null", "SELECT event_type, count(*) AS cnt FROM (SELECT nullif(event_type, 'error') AS event_type FROM events) WHERE event_type IS NOT NULL GROUP BY 1")
def _(spark, sf):
    ev = table(spark, sf, "events").select(F.nullif("event_type", F.lit("error")).alias("event_type"))
    return clean.value_counts(clean.drop_null(ev, "event_type"), "event_type")


@query("flt_tokens", f"SELECT doc_id, len(list_filter(list_transform({tokens_sql('text')}, lambda x: trim(x, {STRIP})), lambda x: x <> '')) AS n FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.size(drop_blank(split_tokens("text", " "))).alias("n"))


@query("flt_min_freq", "SELECT l_partkey, count(*) AS cnt FROM lineitem GROUP BY 1 HAVING count(*) >= 30")
def _(spark, sf):
    return clean.frequent_values(table(spark, sf, "lineitem"), "l_partkey", 30)


# ---- casts and missing values --------------------------------------------------------------------


@query("cst_fill", """
SELECT event_id, coalesce(nullif(value, round(value)), 0) AS value, coalesce(nullif(event_type, 'view'), '') AS event_type FROM events
""")
def _(spark, sf):
    ev = table(spark, sf, "events").select(
        "event_id", F.nullif("value", F.round("value")).alias("value"), F.nullif("event_type", F.lit("view")).alias("event_type")
    )
    return clean.fill_missing(ev, {"value": 0.0, "event_type": ""})


@query("cst_cast", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_totalprice FROM orders")
def _(spark, sf):
    spec = [{"name": "o_custkey", "type": "categorical", "dtype": "str"}, {"name": "o_totalprice", "type": "numeric", "dtype": "float", "fill_na": 0}]
    return prepare(table(spark, sf, "orders"), expand(spec), [], keep=["o_orderkey"])


@query("cst_try_numeric", "SELECT p_partkey, coalesce(TRY_CAST(split_part(p_brand, '#', 2) AS DOUBLE), 0) AS num, coalesce(TRY_CAST(p_name AS DOUBLE), 0) AS bad FROM part")
def _(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("b"), "p_name")
    return part.select("p_partkey", clean.numeric_or_zero("b").alias("num"), clean.numeric_or_zero("p_name").alias("bad"))


@query("cst_text_unknown", "SELECT p_partkey, coalesce(CAST(nullif(p_size, 11) AS VARCHAR), 'unknown') AS p_size FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", clean.text_or(F.nullif("p_size", F.lit(11))).alias("p_size"))


@query("cst_rare", """
WITH kept AS (SELECT p_name FROM part GROUP BY 1 HAVING count(*) >= 50)
SELECT p_partkey, CASE WHEN p_name IN (SELECT p_name FROM kept) THEN p_name ELSE 'rare' END AS name_or_rare FROM part
""")
def _(spark, sf):
    part = table(spark, sf, "part")
    kept = clean.frequent_values(part, "p_name", 50)
    return clean.mark_rare(part.select("p_partkey", "p_name"), "p_name", kept, "name_or_rare", fits_broadcast(kept)).select("p_partkey", "name_or_rare")


@query("cst_clip", f"WITH {IMP} SELECT id, greatest(0.001, least(0.999, score))::DOUBLE AS p FROM imp")
def _(spark, sf):
    return impressions(spark, sf).select("id", scalars.clip("score", 0.001, 0.999).alias("p"))


@query("cst_ensure_sequences", "SELECT doc_id, coalesce(text, '') AS seq_a, '' AS other FROM documents")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("seq"))
    filled = clean.ensure_sequences(docs, ["seq_a"])
    return clean.ensure_sequences(filled.drop("seq"), ["seq_a", "other"]).select("doc_id", "seq_a", "other")


@query("cst_class_threshold", f"""
WITH {IMP} SELECT id, score AS kept, CASE WHEN value > 0.5::DOUBLE THEN 1.0 ELSE 0.0 END::DOUBLE AS cut FROM imp
""")
def _(spark, sf):
    imp = impressions(spark, sf).select("id", "score", "value")
    out = clean.class_from_score(clean.class_from_score(imp, "score", "kept"), "value", "cut")
    return out.select("id", "kept", "cut")


# ---- scalar functions ------------------------------------------------------------------------------

_STAMPS = "st AS (SELECT event_id, strftime(ts, '%y%m%d%H') AS hour FROM events)"


def _stamps(spark, sf):
    return table(spark, sf, "events").select("event_id", F.date_format("ts", "yyMMddHH").alias("hour"))


def _hooked(df, call, out):
    fn, arg = hooks.resolve(call, out)
    return df.withColumn(out, fn(df, arg))


@query("fn_weekday", f"WITH {_STAMPS} SELECT event_id, dayofweek(strptime('20' || substr(hour, 1, 6), '%Y%m%d')) AS weekday FROM st")
def _(spark, sf):
    return _hooked(_stamps(spark, sf), "convert_weekday", "weekday").select("event_id", "weekday")


@query("fn_weekend", f"WITH {_STAMPS} SELECT event_id, CASE WHEN dayofweek(strptime('20' || substr(hour, 1, 6), '%Y%m%d')) IN (0, 6) THEN 1 ELSE 0 END AS weekend FROM st")
def _(spark, sf):
    return _hooked(_stamps(spark, sf), "convert_weekend", "weekend").select("event_id", "weekend")


@query("fn_hour", f"WITH {_STAMPS} SELECT event_id, CAST(substr(hour, 7, 2) AS INTEGER) AS hour_of_day FROM st")
def _(spark, sf):
    return _hooked(_stamps(spark, sf), "convert_hour", "hour_of_day").select("event_id", "hour_of_day")


@query("fn_logsq_bucket", """
SELECT o_orderkey, CASE WHEN o_totalprice > 2 THEN CAST(floor(pow(ln(o_totalprice), 2)) AS INTEGER) ELSE CAST(trunc(o_totalprice) AS INTEGER) END AS bucket FROM orders
""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("bucket"))
    return _hooked(orders, "convert_to_bucket", "bucket")


@query("fn_prefix2", "SELECT doc_id, coalesce(substr(nullif(source, 'src0'), 1, 2), '') AS prefix FROM documents")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.nullif("source", F.lit("src0")).alias("source"))
    return docs.select("doc_id", hooks.resolve("extract_country_code(source)", "")[0](docs, "source").alias("prefix"))


@query("fn_age_bucket", """
WITH a AS (SELECT p_partkey, CAST(nullif(p_size * 2 - 3, 41) AS DOUBLE) AS age FROM part)
SELECT p_partkey, CASE WHEN age IS NULL OR age < 1 OR age > 95 THEN '' WHEN age <= 10 THEN '1' WHEN age <= 20 THEN '2'
  WHEN age <= 30 THEN '3' WHEN age <= 40 THEN '4' WHEN age <= 50 THEN '5' WHEN age <= 60 THEN '6' ELSE '7' END AS age FROM a
""")
def _(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.nullif(F.col("p_size") * 2 - 3, F.lit(41)).cast("string").alias("age"))
    return _hooked(part, "bucketize_age", "age")


@query("fn_rejoin", f"SELECT doc_id, array_to_string(list_slice({tokens_sql('text')}, 1, 50), '^') AS seq FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", scalars.rejoin("text", " ", "^", 50).alias("seq"))


@query("fn_lower", "SELECT lower(lang) AS token, count(*) AS cnt FROM (SELECT upper(lang) AS lang FROM documents WHERE n_chars > 1000 UNION ALL SELECT lang FROM documents) GROUP BY 1")
def _(spark, sf):
    from adloom.operators.vocab import token_counts

    docs = table(spark, sf, "documents")
    mixed = docs.where("n_chars > 1000").select(F.upper("lang").alias("lang")).unionAll(docs.select("lang"))
    return token_counts(mixed, ["lang"], lower=["lang"]).select("token", "cnt")


@query("fn_hash_prob", f"SELECT event_id, {s6('least(0.2::DOUBLE, (' + md5_int_sql('event_id') + ' % 1000) / 10000.0::DOUBLE + 0.01::DOUBLE)')} AS p FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", r6(scalars.hash_probability("event_id")).alias("p"))


@query("fn_sigmoid", f"SELECT event_id, {s6('1 / (1 + exp(-(value / 100)))')} AS p, value AS identity FROM events")
def _(spark, sf):
    x = F.col("value") / 100
    return table(spark, sf, "events").select(
        "event_id", r6(scalars.link(x, "binary_classification")).alias("p"), scalars.link("value", "regression").alias("identity")
    )


# ---- windows, sorts, sets ----------------------------------------------------------------------------


@query("win_rank", f"WITH {IMP} SELECT id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, id) AS rank FROM imp")
def _(spark, sf):
    imp = impressions(spark, sf).select("id", "user_id", (-F.col("score")).alias("neg"))
    return with_rank(imp, ["neg", "id"], ["user_id"]).select("id", "user_id", "rank")


@query("win_topk", f"WITH {IMP}, r AS (SELECT id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, id) AS rank FROM imp) SELECT * FROM r WHERE rank <= 3")
def _(spark, sf):
    imp = impressions(spark, sf).select("id", "user_id", (-F.col("score")).alias("neg"))
    return top_k(imp, ["user_id"], ["neg", "id"], 3).select("id", "user_id", "rank")


@query("win_running", """
SELECT o_orderkey, CAST(coalesce(sum(o_custkey) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM orders
""")
def _(spark, sf):
    from adloom.operators.ranking import running_totals

    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return running_totals(o, ["o_orderkey"], {"upto": "o_custkey"}).select("o_orderkey", (F.col("upto") - F.col("o_custkey")).alias("before"))


@query("srt_by_count", "SELECT p_brand, count(*) AS cnt FROM part GROUP BY 1 ORDER BY cnt DESC, p_brand")
def _(spark, sf):
    return clean.value_counts(table(spark, sf, "part"), "p_brand").orderBy(F.desc("cnt"), "p_brand")


@query("srt_number_tokens", "SELECT p_brand, row_number() OVER (ORDER BY p_brand) AS rank FROM (SELECT DISTINCT p_brand FROM part)")
def _(spark, sf):
    return with_rank(table(spark, sf, "part").select("p_brand").distinct(), ["p_brand"])


@query("top_head_tail", """
(SELECT 'head' AS side, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20)
UNION ALL (SELECT 'tail', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 20)
""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    head = o.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select(F.lit("head").alias("side"), "*")
    tail = o.orderBy("o_totalprice", "o_orderkey").limit(20).select(F.lit("tail").alias("side"), "*")
    return head.unionAll(tail)


@query("set_union", """
SELECT c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS suppkey FROM customer
UNION ALL SELECT s_name, s_nationkey, NULL, s_suppkey FROM supplier
""")
def _(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"), F.col("s_suppkey").alias("suppkey"))
    return union_all([c, s])


@query("set_with_constants", "SELECT DISTINCT v FROM (SELECT event_type AS v FROM events UNION ALL SELECT 'unknown' UNION ALL SELECT 'rare')")
def _(spark, sf):
    ev = table(spark, sf, "events").select(F.col("event_type").alias("v"))
    fixed = spark.range(1).select(F.explode(F.array(F.lit("unknown"), F.lit("rare"))).alias("v"))
    return ev.distinct().union(fixed).distinct()


# ---- key joins ------------------------------------------------------------------------------------------


@query("jn_anti_tokens", f"""
WITH {DOC_TOKENS}, btok AS (SELECT DISTINCT unnest({tokens_sql('text')}) AS token FROM benchmark)
SELECT token, cnt FROM cnts WHERE token NOT IN (SELECT token FROM btok)
""")
def _(spark, sf):
    from adloom.operators.joins import anti_join

    docs = table(spark, sf, "documents").select(F.explode(split_tokens("text", " ")).alias("token"))
    counts = docs.groupBy("token").agg(F.count(F.lit(1)).alias("cnt"))
    bench = table(spark, sf, "benchmark").select(F.explode(split_tokens("text", " ")).alias("token")).distinct()
    return anti_join(counts, bench, ["token"])


@query("jn_semi", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def _(spark, sf):
    rich = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return semi_join(table(spark, sf, "orders"), rich, ["o_custkey"]).select("o_orderkey")


@query("jn_align_rate", f"""
WITH {IMP}, c AS (SELECT nullif(event_type, 'error') AS v, clicked FROM imp)
SELECT v, count(*) AS cnt, {s6("CASE WHEN v IS NULL THEN NULL ELSE avg(clicked) END")} AS ctr FROM c GROUP BY v
""")
def _(spark, sf):
    from adloom.operators.joins import null_safe_join

    c = impressions(spark, sf).select(F.nullif("event_type", F.lit("error")).alias("v"), "clicked")
    rates = c.where("v IS NOT NULL").groupBy("v").agg(F.avg("clicked").alias("ctr"))
    return null_safe_join(clean.value_counts(c, "v"), rates, ["v"]).select("v", "cnt", r6("ctr").alias("ctr"))


@query("jn_totals", f"""
WITH {IMP}, t AS (SELECT CAST(sum(clicked) AS DOUBLE) AS p FROM imp)
SELECT user_id, {s6("sum(clicked) / (SELECT p FROM t)")} AS share FROM imp GROUP BY user_id
""")
def _(spark, sf):
    imp = impressions(spark, sf)
    total = imp.agg(F.sum("clicked").cast("double")).scalar()
    return imp.groupBy("user_id").agg(F.sum("clicked").alias("c")).select("user_id", r6(F.col("c") / total).alias("share"))
