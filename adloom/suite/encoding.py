"""Vocabularies, encoders, scalers, feature maps and array expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.functions import arrays
from adloom.operators import encode as enc
from adloom.operators import vocab as voc
from adloom.operators.quantiles import quantile_boundaries
from adloom.operators.sampling import hash_split
from adloom.plans import encoder as plan
from adloom.plans.dataset import build_dataset, open_dataset
from adloom.session import materialize, scratch_path
from adloom.sources import writers
from adloom.spec import restrict
from adloom.suite.common import (
    CUTS, DOC_TOKENS, IMP, hash_split_sql, impressions, joined_ids, md5_int_sql, query, r6, s6, table, tokens_sql,
)

CATS = ["event_type", "hour", "dow"]

# (feature, token, cnt) of the three categorical columns, and their full vocabulary.
CAT_COUNTS = f"""{IMP}, long AS (
  SELECT 'event_type' AS feature, event_type AS token FROM imp UNION ALL SELECT 'hour', hour FROM imp UNION ALL SELECT 'dow', dow FROM imp),
cc AS (SELECT feature, token, count(*) AS cnt FROM long GROUP BY 1, 2)"""


def vocab_sql(counts: str, name: str = "voc", features: str = "") -> str:
    """Vocabulary CTE from (feature, token, cnt); features without a token still get their reserved ids.

    ``features`` is the relation that lists the features, where ``counts`` may have lost some.
    """
    return f"""{name}_t AS (SELECT feature, token, row_number() OVER (PARTITION BY feature ORDER BY token) AS idx FROM {counts}),
{name}_f AS (SELECT DISTINCT feature FROM {features or counts}),
{name} AS (SELECT * FROM {name}_t UNION ALL SELECT feature, '__PAD__', 0 FROM {name}_f
  UNION ALL SELECT feature, '__OOV__', coalesce(max(idx), 0) + 1 FROM {name}_f LEFT JOIN {name}_t USING (feature) GROUP BY feature)"""


DOC_COUNTS = f"{DOC_TOKENS}, dc AS (SELECT 'text' AS feature, token, cnt FROM cnts WHERE token <> '')"
# A smaller vocabulary that leaves out rare tokens, so that encoding meets unknown ones.
DOC_VOCAB = f"{DOC_COUNTS}, dcf AS (SELECT * FROM dc WHERE cnt >= 3), {vocab_sql('dcf', features='dc')}"


def doc_counts(spark, sf):
    return voc.token_counts(table(spark, sf, "documents"), sequences={"text": " "})


def doc_vocab(spark, sf):
    return materialize(voc.build_vocab(doc_counts(spark, sf), ["text"], min_freq=3), "vocab")


def _ids(df):
    return df.select("feature", "token", "idx")


# ---- vocabularies --------------------------------------------------------------------------------


@query("enc_vocab", f"WITH {CAT_COUNTS}, f AS (SELECT * FROM cc WHERE cnt >= 400), {vocab_sql('f', features='cc')} SELECT * FROM voc")
def _(spark, sf):
    return _ids(voc.build_vocab(voc.token_counts(impressions(spark, sf), CATS), CATS, min_freq=400))


@query("enc_vocab_topk", f"""
WITH {DOC_COUNTS}, r AS (SELECT *, row_number() OVER (ORDER BY cnt DESC, token) AS rk FROM dc), f AS (SELECT * FROM r WHERE rk <= 2000),
{vocab_sql('f')} SELECT * FROM voc
""")
def _(spark, sf):
    counts = doc_counts(spark, sf).where("token <> ''")
    return _ids(voc.build_vocab(counts, ["text"], num_ids=2000))


@query("enc_vocab_noremap", """
WITH t AS (SELECT DISTINCT p_size FROM part)
SELECT 'p_size' AS feature, CAST(p_size AS VARCHAR) AS token, CAST(p_size AS BIGINT) AS idx FROM t
UNION ALL SELECT 'p_size', '__PAD__', 0 UNION ALL SELECT 'p_size', '__OOV__', max(p_size) + 1 FROM t
""")
def _(spark, sf):
    return _ids(voc.build_vocab(voc.token_counts(table(spark, sf, "part"), ["p_size"]), ["p_size"], remap=False))


@query("enc_seq_vocab", f"""
WITH {DOC_COUNTS}, {vocab_sql('dc')}, m AS (SELECT max(len({tokens_sql('text')})) AS max_len FROM documents)
SELECT token, idx, (SELECT max_len FROM m) AS max_len FROM voc
""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    longest = voc.sequence_max_len(docs, {"text": " "}).scalar()
    return voc.build_vocab(doc_counts(spark, sf), ["text"]).select("token", "idx", longest.alias("max_len"))


@query("enc_vocab_size", f"WITH {CAT_COUNTS}, {vocab_sql('cc')} SELECT feature, max(idx) + 1 AS vocab_size FROM voc GROUP BY 1")
def _(spark, sf):
    return voc.vocab_sizes(voc.build_vocab(voc.token_counts(impressions(spark, sf), CATS), CATS))


# Two key columns that share one vocabulary.
_MERGED = f"""
a AS (SELECT DISTINCT 'owner' AS feature, CAST(l_suppkey AS VARCHAR) AS token FROM lineitem),
{vocab_sql('a', 'va')}, b AS (SELECT DISTINCT CAST(s_suppkey + 7 AS VARCHAR) AS token FROM supplier),
fresh AS (SELECT token, row_number() OVER (ORDER BY token) AS nth FROM b WHERE token NOT IN (SELECT token FROM va)),
o AS (SELECT idx AS oov FROM va WHERE token = '__OOV__')
SELECT token, idx FROM va WHERE token <> '__OOV__'
UNION ALL SELECT token, (SELECT oov FROM o) + nth - 1 FROM fresh
UNION ALL SELECT '__OOV__', (SELECT oov FROM o) + (SELECT count(*) FROM fresh)"""


def _merge_inputs(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("owner"))
    sup = table(spark, sf, "supplier").select((F.col("s_suppkey") + 7).alias("other"))
    return voc.build_vocab(voc.token_counts(li, ["owner"]), ["owner"]), voc.token_counts(sup, ["other"])


@query("enc_merge_vocab", f"WITH {_MERGED}")
def _(spark, sf):
    shared, counts = _merge_inputs(spark, sf)
    return voc.merge_vocab(shared, voc.build_vocab(counts, ["other"]), "owner").select("token", "idx")


@query("enc_add_vocab", f"WITH {_MERGED}")
def _(spark, sf):
    shared, counts = _merge_inputs(spark, sf)
    return voc.extend_vocab(shared, counts.withColumn("feature", F.lit("owner"))).select("token", "idx")


@query("enc_vocab_saved", f"WITH {CAT_COUNTS}, {vocab_sql('cc')} SELECT feature, token, CAST(idx AS BIGINT) AS idx FROM voc")
def _(spark, sf):
    path = scratch_path(spark, "vocab")
    writers.write_vocab(voc.build_vocab(voc.token_counts(impressions(spark, sf), CATS), CATS), path)
    return spark.read.schema("feature string, token string, idx bigint").json(path)


# ---- applying vocabularies -------------------------------------------------------------------------

# Users seen in training at least 45 times keep their id; the others are unknown.
_TRAIN_VOCAB = f"""{IMP}, sp AS (SELECT *, {hash_split_sql('id')} AS split FROM imp),
tc AS (SELECT 'user_id' AS feature, CAST(user_id AS VARCHAR) AS token, count(*) AS cnt FROM sp WHERE split = 'train' GROUP BY 2 HAVING count(*) >= 45),
{vocab_sql('tc', features="(SELECT 'user_id' AS feature)")}"""


@query("enc_category", f"""
WITH {_TRAIN_VOCAB} SELECT id, split, coalesce(v.idx, (SELECT idx FROM voc WHERE token = '__OOV__')) AS user_id
FROM sp LEFT JOIN voc v ON v.token = CAST(sp.user_id AS VARCHAR)
""")
def _(spark, sf):
    sp = hash_split(impressions(spark, sf), "id", CUTS)
    vocab = materialize(voc.build_vocab(voc.token_counts(sp.where("split = 'train'"), ["user_id"]), ["user_id"], min_freq=45), "vocab")
    return enc.encode_category(sp.select("id", "split", "user_id"), "user_id", vocab, voc.collect_stats(vocab)["user_id"])


def _sequence_sql(side: str, n: int) -> str:
    cut = "t[greatest(len(t) - {n} + 1, 1):]" if side == "pre" else "t[1:{n}]"
    cut = cut.format(n=n)
    ids = "string_agg(CAST(idx AS VARCHAR), ',' ORDER BY pos)"
    fill = f"repeat('0,', CAST({n} - m AS INTEGER))"
    pad = f"{fill} || l" if side == "pre" else f"l || repeat(',0', CAST({n} - m AS INTEGER))"
    return f"""
WITH {DOC_VOCAB}, cutd AS (SELECT doc_id, {cut} AS t FROM (SELECT doc_id, {tokens_sql('text')} AS t FROM documents)),
e AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM cutd),
c AS (SELECT doc_id, pos, CASE WHEN e.token = '' THEN 0 ELSE coalesce(v.idx, (SELECT idx FROM voc WHERE token = '__OOV__')) END AS idx
      FROM e LEFT JOIN voc v ON v.token = e.token),
g AS (SELECT doc_id, {ids} AS l, count(*) AS m FROM c GROUP BY doc_id)
SELECT doc_id, {pad} AS ids FROM g"""


def _encode_docs(spark, sf, side, n):
    vocab = doc_vocab(spark, sf)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = enc.encode_sequence(docs, "text", " ", vocab, voc.collect_stats(vocab)["text"], n, side, out="ids", id_col="doc_id")
    return out.select("doc_id", joined_ids("ids").alias("ids"))


@query("enc_sequence_pre", _sequence_sql("pre", 100))
def _(spark, sf):
    return _encode_docs(spark, sf, "pre", 100)


@query("enc_sequence_post", _sequence_sql("post", 150))
def _(spark, sf):
    return _encode_docs(spark, sf, "post", 150)


@query("enc_sequence_joined", _sequence_sql("post", 150))
def _(spark, sf):
    """The same result by the join that serves vocabularies too large to broadcast."""
    from dataclasses import replace

    from adloom.operators.joins import BROADCAST_ROWS

    vocab = doc_vocab(spark, sf)
    stats = replace(voc.collect_stats(vocab)["text"], tokens=BROADCAST_ROWS + 1)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = enc.encode_sequence(docs, "text", " ", vocab, stats, 150, "post", out="ids", id_col="doc_id")
    return out.select("doc_id", joined_ids("ids").alias("ids"))


def _large_sql() -> str:
    def column(feature: str, n: int, fill: str) -> str:
        ids = fill.format(k=f"CAST({n} - {feature}.m AS INTEGER)", l=f"{feature}.l")
        return f"CASE WHEN {feature}.l IS NULL THEN '0' || repeat(',0', {n - 1}) ELSE {ids} END AS {feature}"

    def category(name: str) -> str:
        found, unknown = (f"(SELECT idx FROM voc WHERE feature = '{name}' AND token = {t})" for t in (f"d.{name}", "'__OOV__'"))
        return f"CAST(coalesce({found}, {unknown}) AS INTEGER) AS {name}"

    return f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {tokens_sql('text')} AS w, {tokens_sql('text', '.')} AS p FROM documents),
long AS (SELECT 'lang' AS feature, lang AS token FROM d UNION ALL SELECT 'source', source FROM d
  UNION ALL SELECT 'words', unnest(w) FROM d UNION ALL SELECT 'parts', unnest(p) FROM d),
cc AS (SELECT feature, token, count(*) AS cnt FROM long GROUP BY 1, 2), f AS (SELECT * FROM cc WHERE cnt >= 2 AND token <> ''),
{vocab_sql('f', features='cc')},
cut AS (SELECT doc_id, 'words' AS feature, w[greatest(len(w) - 39, 1):] AS t FROM d UNION ALL SELECT doc_id, 'parts', p[1:20] FROM d),
e AS (SELECT doc_id, feature, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM cut),
c AS (SELECT e.doc_id, e.feature, pos, CASE WHEN e.token = '' THEN 0 ELSE coalesce(v.idx, o.idx) END AS idx
  FROM e LEFT JOIN voc v ON v.feature = e.feature AND v.token = e.token JOIN voc o ON o.feature = e.feature AND o.token = '__OOV__'),
g AS (SELECT doc_id, feature, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY pos) AS l, count(*) AS m FROM c GROUP BY 1, 2)
SELECT d.doc_id, {category('lang')}, {category('source')}, {column('words', 40, "repeat('0,', {k}) || {l}")}, {column('parts', 20, "{l} || repeat(',0', {k})")}
FROM d LEFT JOIN g words ON words.doc_id = d.doc_id AND words.feature = 'words' LEFT JOIN g parts ON parts.doc_id = d.doc_id AND parts.feature = 'parts'"""


@query("enc_table_large", _large_sql())
def _(spark, sf):
    """Two categories and two sequences, all with vocabularies taken as past every limit: one narrow lookup for the four."""
    from dataclasses import replace

    from adloom.operators.joins import BROADCAST_ROWS

    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", F.col("text").alias("words"), F.col("text").alias("parts"))
    fitted = plan.fit(docs, [
        {"name": ["lang", "source"], "type": "categorical", "dtype": "str"},
        {"name": "words", "type": "sequence", "dtype": "str", "splitter": " ", "max_len": 40},
        {"name": "parts", "type": "sequence", "dtype": "str", "splitter": ".", "max_len": 20, "padding": "post"},
    ], [], min_categr_count=2)
    fitted = replace(fitted, stats={k: replace(v, tokens=BROADCAST_ROWS + 1) for k, v in fitted.stats.items()})
    out = fitted.transform(docs, keep=["doc_id"], id_col="doc_id")
    return out.select("doc_id", "lang", "source", joined_ids("words").alias("words"), joined_ids("parts").alias("parts"))


@query("enc_meta", f"""
WITH {IMP}, sp AS (SELECT *, {hash_split_sql('id')} AS split, CAST(user_id * 3 + CAST(k AS INTEGER) % 11 AS VARCHAR) AS key FROM imp),
a AS (SELECT key, row_number() OVER (ORDER BY key) AS idx FROM (SELECT DISTINCT key FROM sp WHERE split = 'train')),
b AS (SELECT key, row_number() OVER (ORDER BY min(id), key) + (SELECT count(*) FROM a) AS idx FROM sp WHERE key NOT IN (SELECT key FROM a) GROUP BY key),
v AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT id, split, idx AS key FROM sp JOIN v USING (key)
""")
def _(spark, sf):
    sp = hash_split(impressions(spark, sf), "id", CUTS)
    key = (F.col("user_id") * 3 + F.pmod(F.col("k").cast("int"), F.lit(11))).cast("string")
    return plan.encode_meta(sp.select("id", "split", key.alias("key")), "key", "split", "train", "id")


# ---- label-style codes -------------------------------------------------------------------------------


def _class_codes(df, column, classes, out):
    """0-based codes of a column whose classes are all known."""
    classes = materialize(classes, "classes")
    rows = classes.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("token") + 16).alias("b")).first()
    stats = voc.VocabStats(rows["n"], -1, rows["n"], rows["b"])
    return enc.encode_category(df, column, classes, stats, out=out)


@query("enc_label", """
WITH c AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS code FROM (SELECT DISTINCT p_type FROM part))
SELECT p_partkey, code FROM part JOIN c USING (p_type)
""")
def _(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    out = _class_codes(part, "p_type", voc.class_labels(voc.token_counts(part, ["p_type"])), "code")
    return out.select("p_partkey", "code")


@query("enc_label_union", """
WITH u AS (SELECT 'customer' AS origin, c_custkey AS key, CAST(c_nationkey AS VARCHAR) AS nation FROM customer
  UNION ALL SELECT 'supplier', s_suppkey, CAST(s_nationkey AS VARCHAR) FROM supplier),
c AS (SELECT nation, row_number() OVER (ORDER BY nation) - 1 AS code FROM (SELECT DISTINCT nation FROM u))
SELECT origin, key, code FROM u JOIN c USING (nation)
""")
def _(spark, sf):
    a = table(spark, sf, "customer").select(F.lit("customer").alias("origin"), F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation"))
    b = table(spark, sf, "supplier").select(F.lit("supplier").alias("origin"), F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("nation"))
    u = a.unionByName(b, allowMissingColumns=True)
    return _class_codes(u, "nation", voc.class_labels(voc.token_counts(u, ["nation"])), "code").select("origin", "key", "code")


@query("enc_label_rare", f"""
WITH {IMP}, sp AS (SELECT id, CAST(user_id AS VARCHAR) AS u, {hash_split_sql('id')} AS split FROM imp),
f AS (SELECT u FROM sp WHERE split = 'train' GROUP BY u HAVING count(*) >= 45 UNION SELECT 'unknown' UNION SELECT 'rare'),
c AS (SELECT u, row_number() OVER (ORDER BY u) - 1 AS code FROM f)
SELECT id, coalesce(code, (SELECT code FROM c WHERE u = 'rare')) AS code FROM sp LEFT JOIN c USING (u)
""")
def _(spark, sf):
    sp = hash_split(impressions(spark, sf), "id", CUTS).select("id", F.col("user_id").cast("string").alias("u"), "split")
    counts = voc.token_counts(sp.where("split = 'train'"), ["u"]).where("cnt >= 45")
    classes = materialize(voc.class_labels(counts, ["unknown", "rare"], ["u"]), "classes")
    facts = classes.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("token") + 16).alias("b"),
        F.max(F.when(F.col("token") == "rare", F.col("idx"))).alias("rare"),
    ).first()
    stats = voc.VocabStats(facts["n"], facts["rare"], facts["n"], facts["b"])
    return enc.encode_category(sp, "u", classes, stats, out="code").select("id", "code")


@query("enc_seq_offset2", f"""
WITH {DOC_COUNTS} SELECT token, row_number() OVER (ORDER BY token) + 1 AS idx FROM dc
UNION ALL SELECT '__PAD__', 0 UNION ALL SELECT '__OOV__', 1
""")
def _(spark, sf):
    return voc.offset_vocab(doc_counts(spark, sf), ["text"]).select("token", "idx")


@query("enc_seq_capped", f"""
WITH {DOC_COUNTS}, f AS (SELECT token FROM dc ORDER BY cnt DESC, token LIMIT 48)
SELECT token, row_number() OVER (ORDER BY token) + 1 AS idx FROM f UNION ALL SELECT '__PAD__', 0 UNION ALL SELECT '__OOV__', 1
""")
def _(spark, sf):
    return voc.offset_vocab(doc_counts(spark, sf).where("token <> ''"), ["text"], capacity=50).select("token", "idx")


# ---- scalers and buckets ---------------------------------------------------------------------------------


@query("enc_minmax", f"""
WITH s AS (SELECT min(o_totalprice) AS a, max(o_totalprice) - min(o_totalprice) AS b FROM orders)
SELECT o_orderkey, {s6('(o_totalprice - a) / b')} AS scaled FROM orders, s
""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    sc = enc.fit_scalers(o, {"o_totalprice": "MinMaxScaler"})
    return o.select("o_orderkey", r6(enc.scale("o_totalprice", sc["o_totalprice"])).alias("scaled"))


@query("enc_standard", f"""
WITH s AS (SELECT avg(l_quantity) AS a, stddev_pop(l_quantity) AS b, avg(l_tax) AS c, stddev_pop(l_tax) AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, {s6('(l_quantity - a) / b')} AS qty, {s6('(l_tax - c) / d')} AS tax FROM lineitem, s
""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    sc = enc.fit_scalers(li, {"l_quantity": "StandardScaler", "l_tax": "StandardScaler"})
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", r6(enc.scale("l_quantity", sc["l_quantity"])).alias("qty"),
        r6(enc.scale("l_tax", sc["l_tax"])).alias("tax"),
    )


@query("enc_callable", f"SELECT event_id, {s6('ln(1 + value)')} AS x FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", r6(enc.apply_normalizer("value", F.log1p)).alias("x"))


@query("enc_callable_pandas", f"SELECT event_id, {s6('ln(1 + value)')} AS x FROM events")
def _(spark, sf):
    import numpy as np

    from adloom.functions.vectorized import vectorized

    return table(spark, sf, "events").select("event_id", r6(enc.apply_normalizer("value", vectorized(np.log1p))).alias("x"))


@query("enc_float_sequence", f"""
WITH g AS (SELECT doc_id, list_transform({tokens_sql('text')}, lambda w: len(w)) AS t FROM documents),
s AS (SELECT min(n_chars) AS a, max(n_chars) - min(n_chars) AS b FROM documents),
e AS (SELECT doc_id, unnest(t[greatest(len(t) - 19, 1):]) AS x, generate_subscripts(t[greatest(len(t) - 19, 1):], 1) + greatest(20 - len(t), 0) AS pos FROM g),
p AS (SELECT doc_id, unnest(range(1, 21)) AS pos FROM g)
SELECT doc_id, pos, {s6('coalesce((x - a) / b, -1)')} AS x FROM p LEFT JOIN e USING (doc_id, pos), s
""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    sc = enc.fit_scalers(docs, {"n_chars": "MinMaxScaler"})["n_chars"]
    lengths = F.array_join(F.transform(arrays.split_tokens("text", " "), lambda w: F.length(w).cast("string")), ",")
    out = docs.select("doc_id", enc.encode_float_sequence(lengths, ",", 20, sc).alias("v"))
    return out.select("doc_id", F.posexplode("v").alias("p", "x")).select("doc_id", (F.col("p") + 1).alias("pos"), r6("x").alias("x"))


@query("enc_float_sequence_vectorized", f"""
WITH g AS (SELECT doc_id, list_transform({tokens_sql('text')}, lambda w: len(w)) AS t FROM documents),
e AS (SELECT doc_id, unnest(t[greatest(len(t) - 19, 1):]) AS x, generate_subscripts(t[greatest(len(t) - 19, 1):], 1) + greatest(20 - len(t), 0) AS pos FROM g),
p AS (SELECT doc_id, unnest(range(1, 21)) AS pos FROM g)
SELECT doc_id, pos, {s6('coalesce(ln(1 + x), -1)')} AS x FROM p LEFT JOIN e USING (doc_id, pos)
""")
def _(spark, sf):
    """A user's vectorised function over all elements of a batch."""
    import numpy as np

    from adloom.functions.vectorized import vectorized

    docs = table(spark, sf, "documents")
    lengths = F.array_join(F.transform(arrays.split_tokens("text", " "), lambda w: F.length(w).cast("string")), ",")
    out = docs.select("doc_id", enc.encode_float_sequence(lengths, ",", 20, vectorized(np.log1p)).alias("v"))
    return out.select("doc_id", F.posexplode("v").alias("p", "x")).select("doc_id", (F.col("p") + 1).alias("pos"), r6("x").alias("x"))


@query("enc_quantile_bucket", f"""
WITH b AS (SELECT quantile_cont(o_totalprice, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM orders)
SELECT o_orderkey, len(list_filter(q, lambda x: x <= o_totalprice)) AS bucket FROM orders, b
""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    edges = quantile_boundaries(o, ["o_totalprice"], 10).first()["boundaries"]
    return o.select("o_orderkey", enc.quantile_bucket("o_totalprice", edges).alias("bucket"))


@query("enc_hash_bucket", f"""
WITH n AS (SELECT least(64, count(DISTINCT c_name)) AS n FROM customer)
SELECT c_custkey, {md5_int_sql('c_name')} % n AS bucket FROM customer, n
""")
def _(spark, sf):
    spec = [{"name": "c_name", "type": "categorical", "dtype": "str", "category_processor": "hash_bucket", "num_buckets": 64}]
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    fitted = plan.fit(c, spec, [])
    return fitted.transform(c, keep=["c_custkey"]).withColumnRenamed("c_name", "bucket")


@query("enc_pretrained", f"""
WITH t AS (SELECT DISTINCT 'label' AS feature, CAST(vec_id * 2 AS VARCHAR) AS token FROM embeddings), {vocab_sql('t', 'v0')},
keys AS (SELECT CAST(vec_id AS VARCHAR) AS token, embedding FROM embeddings),
o AS (SELECT idx AS oov FROM v0 WHERE token = '__OOV__'),
fresh AS (SELECT token, row_number() OVER (ORDER BY token) AS nth FROM keys WHERE token NOT IN (SELECT token FROM v0)),
v AS (SELECT token, idx FROM v0 WHERE token <> '__OOV__' UNION ALL SELECT token, (SELECT oov FROM o) + nth - 1 FROM fresh
      UNION ALL SELECT '__OOV__', (SELECT oov FROM o) + (SELECT count(*) FROM fresh))
SELECT idx, {s6("coalesce(embedding[1], 0)")} AS first, {s6("coalesce(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 0)", 5)} AS total
FROM v LEFT JOIN keys USING (token)
""")
def _(spark, sf):
    emb = table(spark, sf, "embeddings")
    data = emb.select((F.col("vec_id") * 2).cast("string").alias("item"))
    vectors = emb.select(F.col("vec_id").cast("string").alias("key"), F.col("embedding").alias("vector"))
    spec = [{"name": "item", "type": "categorical", "dtype": "str", "pretrained_emb": "vectors"}]
    fitted = plan.fit(data, spec, [], pretrained={"item": vectors})
    matrix = plan.pretrained_matrix(fitted, "item", vectors, 64)
    total = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x)
    return matrix.select("idx", r6(F.get("vector", F.lit(0))).alias("first"), r6(total, 5).alias("total"))


# ---- the whole table --------------------------------------------------------------------------------------

TABLE_SPEC = [
    {"name": CATS, "type": "categorical", "dtype": "str"},
    {"name": ["value", "k"], "type": "numeric", "dtype": "float", "normalizer": "MinMaxScaler", "fill_na": 0},
]
LABEL = {"name": "clicked", "dtype": "float"}


def _table_sql(select: str) -> str:
    return f"""
WITH {IMP}, sp AS (SELECT *, {hash_split_sql('id')} AS split FROM imp),
long AS (SELECT 'event_type' AS feature, event_type AS token FROM sp WHERE split = 'train'
  UNION ALL SELECT 'hour', hour FROM sp WHERE split = 'train' UNION ALL SELECT 'dow', dow FROM sp WHERE split = 'train'),
cc AS (SELECT DISTINCT feature, token FROM long), {vocab_sql('cc')},
m AS (SELECT min(value) AS va, max(value) - min(value) AS vb, min(k) AS ka, max(k) - min(k) AS kb FROM sp WHERE split = 'train'),
enc AS (SELECT sp.id, sp.split, e.idx AS event_type, h.idx AS hour, d.idx AS dow, (value - va) / vb AS value, (k - ka) / kb AS k, CAST(clicked AS DOUBLE) AS clicked
  FROM sp JOIN voc e ON e.feature = 'event_type' AND e.token = sp.event_type JOIN voc h ON h.feature = 'hour' AND h.token = sp.hour
  JOIN voc d ON d.feature = 'dow' AND d.token = sp.dow, m)
{select}"""


def fit_table(spark, sf):
    sp = hash_split(impressions(spark, sf), "id", CUTS)
    return sp, plan.fit(sp.where("split = 'train'"), TABLE_SPEC, LABEL, "events")


@query("enc_table", _table_sql(f"SELECT id, split, event_type, hour, dow, {s6('value')} AS value, {s6('k')} AS k, clicked FROM enc"))
def _(spark, sf):
    sp, fitted = fit_table(spark, sf)
    out = fitted.transform(sp, keep=["id", "split"])
    return out.withColumns({"value": r6("value"), "k": r6("k")})


@query("enc_table_rates", _table_sql(f"SELECT split, event_type, hour, count(*) AS cnt, {s6('avg(clicked)')} AS ctr FROM enc GROUP BY 1, 2, 3"))
def _(spark, sf):
    sp, fitted = fit_table(spark, sf)
    out = fitted.transform(sp, keep=["id", "split"])
    return out.groupBy("split", "event_type", "hour").agg(F.count(F.lit(1)).alias("cnt"), r6(F.avg("clicked")).alias("ctr"))


@query("enc_reloaded", _table_sql(f"SELECT id, event_type, hour, dow, {s6('value')} AS value, clicked FROM enc WHERE split = 'test'"))
def _(spark, sf):
    sp, fitted = fit_table(spark, sf)
    path = scratch_path(spark, "encoder")
    fitted.save(path)
    again = plan.load(spark, path, "events")
    out = again.transform(sp.where("split = 'test'"), keep=["id"])
    return out.select("id", "event_type", "hour", "dow", r6("value").alias("value"), "clicked")


@query("enc_build_dataset", f"""
WITH {IMP}, r AS (SELECT *, row_number() OVER (ORDER BY id) AS rn, count(*) OVER () AS n FROM imp),
sp AS (SELECT *, CASE WHEN rn > n - floor(n * 0.2::DOUBLE) THEN 'test' WHEN rn > n - floor(n * 0.2::DOUBLE) - floor(n * 0.1::DOUBLE) THEN 'valid' ELSE 'train' END AS split FROM r),
m AS (SELECT min(value) AS a, max(value) - min(value) AS b FROM sp WHERE split = 'train'),
h AS (SELECT hour, row_number() OVER (ORDER BY hour) AS idx FROM (SELECT DISTINCT hour FROM sp WHERE split = 'train'))
SELECT split, count(*) AS n_rows, {s6('avg(clicked)')} AS click_rate, {s6('avg((value - a) / b)')} AS mean_value, CAST(sum(idx) AS BIGINT) AS hour_ids
FROM sp JOIN h USING (hour), m GROUP BY split
""")
def _(spark, sf):
    path = scratch_path(spark, "dataset")
    for _ in range(2):
        # The second call finds the data set and leaves it as it is.
        build_dataset(impressions(spark, sf), TABLE_SPEC, LABEL, path, "events", ["id"], valid_size=0.1, test_size=0.2)
    _, rows = open_dataset(spark, path, "events")
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), r6(F.avg("clicked")).alias("click_rate"), r6(F.avg("value")).alias("mean_value"),
        F.sum("hour").alias("hour_ids"),
    )


@query("enc_shared_vocab", """
WITH a AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS token FROM orders),
va AS (SELECT token, row_number() OVER (ORDER BY token) AS idx FROM a),
b AS (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS token FROM orders),
vb AS (SELECT token, row_number() OVER (ORDER BY token) + (SELECT count(*) FROM a) AS idx FROM b WHERE token NOT IN (SELECT token FROM a)),
v AS (SELECT * FROM va UNION ALL SELECT * FROM vb)
SELECT x.idx AS o_custkey, y.idx AS o_orderkey FROM orders JOIN v x ON x.token = CAST(o_custkey AS VARCHAR) JOIN v y ON y.token = CAST(o_orderkey AS VARCHAR)
""")
def _(spark, sf):
    spec = [
        {"name": "o_custkey", "type": "categorical", "dtype": "str"},
        {"name": "o_orderkey", "type": "categorical", "dtype": "str", "share_embedding": "o_custkey"},
    ]
    o = table(spark, sf, "orders")
    return plan.fit(o, spec, []).transform(o)


# ---- feature map ------------------------------------------------------------------------------------------

_MAP_SPEC = [
    {"name": "user_id", "type": "meta", "dtype": "str", "remap": False},
    {"name": CATS, "type": "categorical", "dtype": "str", "source": "context"},
    {"name": ["value", "k"], "type": "numeric", "dtype": "float", "fill_na": 0, "source": "measure"},
    {"name": "path", "type": "sequence", "dtype": "str", "splitter": ",", "max_len": 5, "source": "history"},
    {"name": "hour2", "type": "categorical", "dtype": "str", "share_embedding": "hour", "source": "history"},
]


def _map_inputs(spark, sf):
    imp = impressions(spark, sf)
    return imp.withColumn("path", F.concat_ws(",", "event_type", "dow", "event_type")).withColumn("hour2", F.col("hour"))


_MAP_SIZES = f"""{IMP}, path AS (SELECT DISTINCT unnest([event_type, dow]) AS t FROM imp),
z AS (SELECT count(DISTINCT event_type) + 2 AS e, count(DISTINCT hour) + 2 AS h, count(DISTINCT dow) + 2 AS d, (SELECT count(*) + 2 FROM path) AS p FROM imp)"""


@query("fm_counts", f"WITH {_MAP_SIZES} SELECT 7 AS num_fields, e + h + d + p + 2 AS total_features, 12 AS input_length FROM z")
def _(spark, sf):
    fitted = plan.fit(_map_inputs(spark, sf), _MAP_SPEC, LABEL)
    return plan.field_counts(fitted.feature_map_df(spark))


@query("fm_fields_by_source", f"WITH {_MAP_SIZES} SELECT 2 AS num_fields FROM z")
def _(spark, sf):
    fitted = plan.fit(_map_inputs(spark, sf), _MAP_SPEC, LABEL)
    return plan.field_counts(fitted.feature_map_df(spark), ["history"]).select("num_fields")


@query("fm_offsets", f"""
WITH {_MAP_SIZES} SELECT unnest(['user_id','event_type','hour','dow','value','k','path','hour2','clicked']) AS feature,
  unnest([0,1,2,3,4,5,6,11,12]) AS "offset", unnest([1,1,1,1,1,1,5,1,1]) AS width FROM z
""")
def _(spark, sf):
    fitted = plan.fit(_map_inputs(spark, sf), _MAP_SPEC, LABEL)
    return plan.column_offsets(fitted.feature_map_df(spark), ["clicked"])


@query("fm_sizes", f"""
WITH {_MAP_SIZES} SELECT unnest(['event_type','hour','dow','path','hour2']) AS feature, unnest([e, h, d, p, h]) AS vocab_size,
  unnest([e, h, d, p, h]) - 1 AS oov_idx FROM z
""")
def _(spark, sf):
    fitted = plan.fit(_map_inputs(spark, sf), _MAP_SPEC, LABEL)
    path = scratch_path(spark, "map")
    fitted.save(path)
    back = spark.read.parquet(f"{path}/feature_map")
    return back.where("vocab_size IS NOT NULL").select("feature", "vocab_size", "oov_idx")


@query("prj_override", f"WITH {CAT_COUNTS}, f AS (SELECT * FROM cc WHERE feature <> 'dow'), g AS (SELECT * FROM f WHERE feature <> 'hour' OR cnt >= 410), {vocab_sql('g', features='f')} SELECT feature, max(idx) + 1 AS vocab_size FROM voc GROUP BY 1")
def _(spark, sf):
    from adloom.spec import expand

    specs = restrict(expand(TABLE_SPEC), ["hour", "event_type"], [{"name": "hour", "min_categr_count": 410}])
    return voc.vocab_sizes(plan.fit(impressions(spark, sf), specs, LABEL).vocab)


@query("prj_inputs", _table_sql(f"SELECT {s6('value')} AS value, {s6('k')} AS k FROM enc"))
def _(spark, sf):
    sp = hash_split(impressions(spark, sf), "id", CUTS)
    spec = [{**TABLE_SPEC[0], "source": "context"}, {**TABLE_SPEC[1], "source": "measure"}, {"name": "user_id", "type": "meta", "dtype": "str", "remap": False, "source": "measure"}]
    fitted = plan.fit(sp.where("split = 'train'"), spec, LABEL)
    out = plan.model_inputs(fitted.transform(sp), fitted, ["measure"])
    return out.select(r6("value").alias("value"), r6("k").alias("k"))


# ---- arrays -----------------------------------------------------------------------------------------------


@query("arr_pad", f"""
WITH t AS (SELECT doc_id, list_transform({tokens_sql('text')}, lambda w: len(w)) AS a FROM documents)
SELECT doc_id, array_to_string(list_concat(list_resize(CAST([] AS BIGINT[]), CAST(greatest(30 - len(a), 0) AS BIGINT), 0), a[1:30]), ',') AS pre_post,
  array_to_string(list_resize(a[greatest(len(a) - 29, 1):], 30, 0), ',') AS post_pre FROM t
""")
def _(spark, sf):
    lengths = F.transform(arrays.split_tokens("text", " "), lambda w: F.length(w))
    d = table(spark, sf, "documents").select("doc_id", lengths.alias("a"))
    return d.select(
        "doc_id", joined_ids(arrays.pad("a", 30, 0, "pre", "post")).alias("pre_post"),
        joined_ids(arrays.pad("a", 30, 0, "post", "pre")).alias("post_pre"),
    )


@query("arr_len", f"SELECT doc_id, len({tokens_sql('text')}) AS n FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", arrays.token_count("text", " ").alias("n"))


@query("arr_explode", f"WITH {DOC_TOKENS} SELECT doc_id, count(*) AS n, count(DISTINCT token) AS n_unique FROM tok GROUP BY 1")
def _(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id", F.array_join(arrays.split_tokens("text", " "), "^").alias("s"))
    tokens = joined.select("doc_id", F.explode(arrays.split_tokens("s", "^")).alias("token"))
    return tokens.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("token").alias("n_unique"))


@query("arr_nonpad", f"SELECT doc_id, least(len({tokens_sql('text')}), 400) AS n FROM documents")
def _(spark, sf):
    ones = F.transform(arrays.split_tokens("text", " "), lambda w: F.lit(1))
    return table(spark, sf, "documents").select("doc_id", arrays.non_pad_count(arrays.pad(ones, 400)).alias("n"))


@query("arr_flatten", f"""
SELECT vec_id, 66 AS width, {s6("list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) + label + vec_id", 5)} AS total FROM embeddings
""")
def _(spark, sf):
    e = table(spark, sf, "embeddings")
    v = e.select("vec_id", arrays.flatten_row(["label", "embedding", "vec_id"], ["embedding"]).alias("v"))
    return v.select("vec_id", F.size("v").alias("width"), r6(F.aggregate("v", F.lit(0.0), lambda s, x: s + x), 5).alias("total"))


@query("arr_slice", f"SELECT vec_id, {s6('embedding[3]')} AS a, {s6('embedding[4]')} AS b FROM embeddings")
def _(spark, sf):
    e = table(spark, sf, "embeddings")
    v = e.select("vec_id", arrays.flatten_row(["label", "embedding"], ["embedding"]).alias("v"))
    part = v.select("vec_id", arrays.slice_feature("v", 3, 2).alias("p"))
    return part.select("vec_id", r6(F.get("p", F.lit(0))).alias("a"), r6(F.get("p", F.lit(1))).alias("b"))
