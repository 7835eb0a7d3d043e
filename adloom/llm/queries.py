"""Registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm import bpe, decontaminate, fingerprint, html, langid, lm, ngram_join, packing, privacy, runs, toxicity, warc, whitening
from adloom.llm.common import remainder, table
from adloom.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of every whole document and of its edited text, with their likeness."""
    return fingerprint.compare(table(spark, sf, "documents"))


@query
def op2_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of ids and decoded text of every whole document."""
    return bpe.digest(table(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"))


@query
def op5_lm(spark: SparkSession, sf: str) -> DataFrame:
    """Bigram and base score of every whole document, learned from those not held out."""
    docs = table(spark, sf, "documents").select("doc_id", (remainder("doc_id", 7) == 2).alias("held_out"), "text")
    return lm.score(docs, "not held_out")


# Rows whose id leaves remainder 0 of 5 (toxicity) or 2 of 4 (language) are held out: nothing is learned from them.
def toxicity_model(spark: SparkSession, docs: DataFrame, sf: str) -> toxicity.Model:
    return toxicity.fit(docs, table(spark, sf, "labels").where(remainder("doc_id", 5) != 0))


@query
def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Score, prediction and toxic passages of every whole document, learned from the labelled ones not held out."""
    docs = table(spark, sf, "documents")
    model = toxicity_model(spark, docs, sf)
    out = toxicity.score(docs.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "score", "predicted", "passages")


@query
def op7_language(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every whole document, learned from those not held out."""
    docs = table(spark, sf, "documents")
    held_out = remainder("doc_id", 4) == 2
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


@query
def op3_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate group, number of links and of copies of every document."""
    return ngram_join.join(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op4_html(spark: SparkSession, sf: str) -> DataFrame:
    """Visible text of every page."""
    return html.extract(table(spark, sf, "pages").select("page_id", "url", "html"))


@query
def op8_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """Regions of every whole document that lie within the edit budget of a benchmark item."""
    found = decontaminate.search(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))
    return found.select("doc_id", F.explode("regions").alias("r")).select("doc_id", "r.item_id", "r.start", "r.end", "r.edits")


# The second replica, of each 100 pages: one has a flipped first letter, one has lost its last character, one is lost, one is there
# three times, and one is there again under a new id.
DAMAGE = 100
NEW_ID = 1_000_000_000_000


def replica(body: Column, page_id: Column) -> tuple[Column, Column]:
    """The body in the second replica, and the ids under which it is there."""
    at = F.pmod(page_id * 7919, F.lit(DAMAGE))
    cut = F.substring(body, 1, F.greatest(F.length(body) - 1, F.lit(0)))
    text = F.when(at == 7, F.concat(F.lit("#"), F.substring(body, 2, 1 << 30))).when(at == 11, cut).otherwise(body)
    ids = F.when(at == 13, F.array().cast("array<bigint>")).when(at == 17, F.array_repeat(page_id, 3))
    return text, ids.when(at == 19, F.array(page_id, page_id + NEW_ID)).otherwise(F.array(page_id))


@query
def op9_merkle(spark: SparkSession, sf: str) -> DataFrame:
    """Records in which a second replica of all pages differs: copies and offset on both sides."""
    page = F.coalesce(F.col("page_id").cast("bigint"), F.lit(-1).cast("bigint"))
    text, ids = replica(F.col("html"), page)
    sides = [F.struct(*warc.leaf(warc.record(F.col("url"), body))).alias(n) for n, body in (("a", F.col("html")), ("b", text))]
    pages = table(spark, sf, "pages")
    both = materialize(pages.select(page.alias("page"), F.coalesce("url", F.lit("")).alias("url"), ids.alias("ids"), *sides), "records")
    one = both.select("page", "url", "a.*")
    two = both.select(F.explode("ids").alias("page"), "url", "b.*")
    return warc.audit(one, two).withColumnRenamed("page", "page_id")


@query
def op10_privacy(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data in every whole document, and the words beside it that disclose it."""
    return privacy.report(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op11_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Periodic runs of words of every whole document; one document in ten is made periodic from some word on."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    docs = table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), h.alias("h"), F.floor(h / 10).alias("g"))
    cut = docs.where("h % 10 = 0").select("doc_id", "g", F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("w"))
    cut = cut.withColumn("n", F.size("w")).withColumn("a", F.expr("if(n > 0, g % n, 0)")).withColumn("p", F.expr("1 + floor((n - a) / (3 + g % 8))"))
    # Words before a, then whole periods, then a part of one.
    head, period, tail = F.slice("w", F.lit(1), F.expr("int(a)")), F.expr("slice(w, int(a) + 1, int(p))"), F.expr("slice(w, int(a) + 1, int((n - a) % p))")
    looped = F.concat(head, F.flatten(F.array_repeat(period, F.expr("int((n - a) div p)"))), tail)
    texts = docs.where("h % 10 <> 0").select("doc_id", "text").unionByName(cut.select("doc_id", F.array_join(looped, " ").alias("text")))
    found = runs.find(texts)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n"))))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("b"), F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", (-F.col("b.s")).alias("start"), "b.length", (-F.col("b.p")).alias("period"), F.expr("1000 * b.length div -b.p").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


@query
def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """Every embedding's coordinates on the first components of the distinct ones, with exact deviations."""
    found = whitening.whiten(table(spark, sf, "embeddings").select("vec_id", "embedding"))
    each = F.inline(F.arrays_zip(F.transform("whitened", lambda _, i: i + 1).alias("component"), "whitened", "explained"))
    return found.select("vec_id", "n", "deviation", "identity_error", each)


@query
def op13_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents' pieces of at most 2048 tokens, in as few sequences as the search finds."""
    return packing.pack(table(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"))


def _record_sql(body: str) -> str:
    head = "'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')"
    return f"{head} || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || CAST(strlen({body}) AS VARCHAR) || repeat(chr(13) || chr(10), 2) || {body} || repeat(chr(13) || chr(10), 2)"


ORACLES["op9_merkle"] = f"""
WITH p AS (SELECT coalesce(page_id, -1) AS page_id, coalesce(url, '') AS url, coalesce(html, '') AS body, coalesce(page_id, -1) * 7919 AS h FROM pages),
d AS (SELECT *, (h % {DAMAGE} + {DAMAGE}) % {DAMAGE} AS kind FROM p),
e AS (SELECT *, CASE kind WHEN 7 THEN '#' || substr(body, 2) WHEN 11 THEN substr(body, 1, greatest(length(body) - 1, 0)) ELSE body END AS other,
  CASE kind WHEN 13 THEN CAST([] AS BIGINT[]) WHEN 17 THEN [page_id, page_id, page_id] WHEN 19 THEN [page_id, page_id + {NEW_ID}] ELSE [page_id] END AS ids FROM d),
r AS (SELECT 'a' AS side, page_id, url, {_record_sql('body')} AS t FROM e UNION ALL SELECT 'b', unnest(ids), url, {_record_sql('other')} FROM e),
g AS (SELECT side, page_id, url, sha256(t) AS hash, strlen(t) AS length, count(*) AS copies FROM r GROUP BY 1, 2, 3, 4, 5),
n AS (SELECT *, CAST(sum(length * copies) OVER (PARTITION BY side ORDER BY page_id, url, hash ROWS UNBOUNDED PRECEDING) AS BIGINT) - length * copies AS "offset" FROM g),
a AS (SELECT * FROM n WHERE side = 'a'), b AS (SELECT * FROM n WHERE side = 'b')
SELECT page_id, url, hash, coalesce(a.length, b.length) AS length, coalesce(a.copies, 0) AS copies_a, coalesce(b.copies, 0) AS copies_b,
  a."offset" AS offset_a, b."offset" AS offset_b
FROM a FULL JOIN b USING (page_id, url, hash) WHERE coalesce(a.copies, 0) <> coalesce(b.copies, 0)
"""

ORACLES["op3_ngram_join"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\s+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i)),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, '|' ORDER BY g)) AS whole FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 5 * c >= 4 * (x.n + y.n - c)),
r(node, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.node),
m AS (SELECT node, min(root) AS class_id FROM r GROUP BY 1),
k AS (SELECT a AS node, count(*) AS n_links FROM l GROUP BY 1)
SELECT n.doc_id, class_id, coalesce(n_links, 0) AS n_links, count(*) OVER (PARTITION BY whole) AS copies
FROM n JOIN m ON m.node = n.doc_id LEFT JOIN k ON k.node = n.doc_id
"""
