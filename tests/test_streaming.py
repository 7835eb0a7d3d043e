"""Streams give the batch result, also when they stop and go on."""

import pytest
from pyspark.sql import functions as F

from adloom.operators import metrics
from adloom.plans import encoder as plan
from adloom.streaming import jobs

SPEC = [
    {"name": "c", "type": "categorical", "dtype": "str"},
    {"name": "s", "type": "sequence", "dtype": "str", "splitter": ",", "max_len": 3},
    {"name": "x", "type": "numeric", "dtype": "float", "normalizer": "StandardScaler", "fill_na": 0},
]
LABEL = {"name": "y", "dtype": "float"}


@pytest.fixture
def arriving(spark, tmp_path):
    """A folder and a function that drops the next file into it."""
    path = str(tmp_path / "in")

    def drop(start, n):
        spark.range(start, start + n).select(
            "id", F.concat(F.lit("c"), F.col("id") % 7).alias("c"), F.concat_ws(",", F.col("id") % 3, F.col("id") % 5).alias("s"),
            (F.col("id") * 1.5).alias("x"), (F.col("id") % 2).cast("int").alias("y"),
        ).coalesce(1).write.mode("append").parquet(path)

    return path, drop


def test_transform_with_sequences_and_restart(spark, arriving, tmp_path):
    path, drop = arriving
    drop(0, 20)
    batch = spark.read.parquet(path)
    fitted = plan.fit(batch, SPEC, LABEL)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    for start in (20, 40):
        jobs.transform_stream(jobs.file_stream(spark, path, batch.schema, 1), fitted, out, ckpt, ["id"]).awaitTermination()
        drop(start, 20)
    jobs.transform_stream(jobs.file_stream(spark, path, batch.schema, 1), fitted, out, ckpt, ["id"]).awaitTermination()
    want = fitted.transform(spark.read.parquet(path), keep=["id"])
    got = spark.read.parquet(out)
    assert got.count() == 60
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_vocabulary_grows_in_arrival_order(spark, arriving, tmp_path):
    path, drop = arriving
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    drop(3, 2)
    schema = spark.read.parquet(path).schema
    jobs.vocab_stream(jobs.file_stream(spark, path, schema), "c", "id", out, ckpt).awaitTermination()
    drop(5, 4)
    jobs.vocab_stream(jobs.file_stream(spark, path, schema), "c", "id", out, ckpt).awaitTermination()
    got = {r["token"]: r["idx"] for r in jobs.growing_vocab(spark, out, "c").collect()}
    assert got == {"__PAD__": 0, "c3": 1, "c4": 2, "c5": 3, "c6": 4, "c0": 5, "c1": 6, "__OOV__": 7}


def test_counts_of_known_tokens_grow(spark, arriving, tmp_path):
    path, drop = arriving
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    for start, n in ((0, 3), (7, 2)):  # c0 c1 c2, then c0 c1 again
        drop(start, n)
        schema = spark.read.parquet(path).schema
        jobs.vocab_stream(jobs.file_stream(spark, path, schema), "c", "id", out, ckpt).awaitTermination()
    got = {r["token"]: (r["idx"], r["cnt"]) for r in jobs.growing_vocab(spark, out, "c").collect()}
    assert got == {"__PAD__": (0, 0), "c0": (1, 2), "c1": (2, 2), "c2": (3, 1), "__OOV__": (4, 0)}


def test_counters_keep_two_tables_at_most(spark, arriving, tmp_path):
    path, drop = arriving
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    for k in range(4):
        drop(10 * k, 10)
        schema = spark.read.parquet(path).schema
        jobs.count_stream(jobs.file_stream(spark, path, schema), "c", "x", out, ckpt).awaitTermination()
    assert jobs.latest(spark, out).groupBy().sum("cnt").first()[0] == 40
    assert spark.read.parquet(out).select("batch").distinct().count() == 2


def test_streams_go_through_the_batch_plan(spark, arriving):
    path, drop = arriving
    drop(0, 5)
    batch = spark.read.parquet(path)
    fitted = plan.fit(batch, SPEC, LABEL)
    with pytest.raises(ValueError, match="transform_stream"):
        fitted.transform(jobs.file_stream(spark, path, batch.schema, 1))


def test_metrics_of_all_rows_so_far(spark, tmp_path):
    """After each of four batches: what the batch metrics say of all rows up to there, ties and unusable rows included."""
    path, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    row = lambda i: F.pmod(F.xxhash64(i), F.lit(40))
    rows = spark.range(400).select("id", (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) == 0).cast("int").alias("y"), F.when(F.col("id") % 50 != 7, row("id") / 40).alias("p"))
    for k in range(4):
        rows.where(F.floor(F.col("id") / 100) == k).coalesce(1).write.mode("append").parquet(path)
        jobs.running_metric_stream(jobs.file_stream(spark, path, rows.schema, 1), "y", "p", out, ckpt).awaitTermination()
    for k in range(4):
        seen = rows.where(F.col("id") < 100 * (k + 1))
        want = metrics.cell_metrics(metrics.score_cells(seen, "y", "p")).first()
        got = spark.read.parquet(f"{out}/batch={k}").first()
        assert got.n == seen.where("p IS NOT NULL").count()
        for name in ("auc", "ap", "logloss", "wll"):
            assert got[name] == pytest.approx(want[name], abs=1e-12)
        assert got.auc == pytest.approx(metrics.auc(seen, "y", "p").first().auc, abs=1e-12)
        assert got.logloss == pytest.approx(metrics.log_loss(seen, "y", "p").first().logloss, abs=1e-12)


def test_a_batch_of_cells_is_worked_out_once(spark, tmp_path, monkeypatch):
    """The passes of the metrics over a batch read what was stored of it instead of writing the state again."""
    path, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    spark.range(200).select((F.col("id") % 3 == 0).cast("int").alias("y"), (F.col("id") % 20 / 20).alias("p")).write.parquet(path)
    files = []
    monkeypatch.setattr(jobs, "cell_metrics", lambda cells: files.extend(cells.inputFiles()) or metrics.cell_metrics(cells))
    jobs.running_metric_stream(jobs.file_stream(spark, path, "y int, p double", None), "y", "p", out, ckpt).awaitTermination()
    assert [r.n for r in spark.read.parquet(out).collect()] == [200]
    assert files and not any(f.startswith(f"file://{path}") for f in files)


def test_parts_arrive_as_many_files(spark, tmp_path, monkeypatch):
    """The stream of documents is staged by all tasks of the scan, in two batches, and no row without an id is lost."""
    from adloom.suite import edges
    from adloom.suite.common import QUERIES

    key = F.when(F.col("id") % 9 != 0, F.col("id"))
    docs = spark.range(0, 160, 1, 8).select(key.alias("doc_id"), F.concat_ws(" ", F.lit("a"), F.col("id") % 5).alias("text"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    stream, files = jobs.file_stream, []

    def watched(spark, path, *rest):
        files.append(len(spark.read.parquet(path).inputFiles()))
        return stream(spark, path, *rest)

    monkeypatch.setattr(edges.jobs, "file_stream", watched)
    assert QUERIES["str_transform_sequence"](spark, str(tmp_path)).count() == 160
    assert files[-1] >= 8
