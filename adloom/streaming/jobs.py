"""Structured Streaming versions of the batch jobs: transform, counters, growing vocabulary, running metrics.

Every sink is idempotent by batch id or checkpointed, so a restarted query neither loses nor repeats rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from adloom.operators.joins import anti_join
from adloom.operators.metrics import cell_metrics, evaluate, score_cells
from adloom.operators.ranking import with_rank
from adloom.operators.vocab import with_reserved
from adloom.plans.encoder import FittedEncoder
from adloom.session import materialize, remove_path


def file_stream(spark: SparkSession, path: str, schema: T.StructType | str, max_files: int | None = 100, pattern: str | None = None) -> DataFrame:
    """Arriving Parquet files, at most ``max_files`` in a batch (None: all that have arrived)."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def transform_stream(stream: DataFrame, fitted: FittedEncoder, out: str, checkpoint: str, keep: Sequence[str] = ()) -> StreamingQuery:
    """Encode arriving rows with a fitted encoder into Parquet, one folder ``batch=…`` per micro-batch.

    Each micro-batch is encoded by the batch plan, so vocabularies of any size work; a replayed one rewrites its folder.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        fitted.transform(batch, keep=keep).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(store).start()


def count_stream(stream: DataFrame, key: str, value: str, out: str, checkpoint: str) -> StreamingQuery:
    """Running count, minimum and maximum per key; ``out`` holds the latest complete table and the one before it."""
    agg = stream.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"), F.min(value).alias("min_value"), F.max(value).alias("max_value"))

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        remove_path(batch.sparkSession, f"{out}/batch={batch_id - 2}")

    return agg.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(store).start()


def latest(spark: SparkSession, out: str) -> DataFrame:
    """Table written by the last batch of a sink that keeps one table per batch."""
    df = spark.read.parquet(out)
    last = df.agg(F.max("batch")).first()[0]
    return spark.read.parquet(f"{out}/batch={last}")


def vocab_stream(stream: DataFrame, column: str, order: str, out: str, checkpoint: str) -> StreamingQuery:
    """A vocabulary that grows as batches arrive; read it with :func:`growing_vocab`.

    The first batch is numbered in token order; tokens new in a later batch follow by their smallest
    ``order`` value. Each batch appends its tokens with their counts, as its own folder, known ones under
    the id they have: a replayed batch sees the folders before it and rewrites the same one.
    """

    def grow(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tokens = batch.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("token")).agg(
            F.count(F.lit(1)).alias("cnt"), F.min(order).alias("_o")
        )
        last = 0
        if batch_id > 0:
            before = spark.read.parquet(out).where(F.col("batch") < batch_id)
            last = before.agg(F.max("idx")).first()[0] or 0
            ids = before.groupBy("token").agg(F.min("idx").alias("idx"))
            known = tokens.join(ids, "token").select("token", "idx", "cnt")
            tokens = anti_join(tokens, ids, ["token"])
        fresh = with_rank(tokens, ["token"] if batch_id == 0 else ["_o", "token"], name="idx")
        rows = fresh.select("token", (F.col("idx") + last).alias("idx"), "cnt")
        rows = rows if batch_id == 0 else rows.unionByName(known)
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(grow).start()


def growing_vocab(spark: SparkSession, out: str, feature: str) -> DataFrame:
    """The vocabulary gathered so far, with its reserved ids: (feature, token, idx, cnt)."""
    seen = spark.read.parquet(out).groupBy("token", "idx").agg(F.sum("cnt").alias("cnt"))
    tokens = seen.select(F.lit(feature).alias("feature"), "token", "idx", "cnt")
    return with_reserved(tokens, tokens.groupBy("feature").agg(F.max("idx").alias("last")), [feature])


def metric_stream(stream: DataFrame, metrics: Sequence[str], label: str, score: str, out: str, checkpoint: str, group: str | None = None, tie: str | None = None) -> StreamingQuery:
    """Metrics of each arriving batch, kept as a history table (batch, metric, value)."""

    def step(batch: DataFrame, batch_id: int) -> None:
        evaluate(batch, metrics, label, score, group, tie).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(step).start()


def running_metric_stream(stream: DataFrame, label: str, score: str, out: str, checkpoint: str) -> StreamingQuery:
    """AUC, average precision, log loss and weighted log loss of everything seen so far, a row per batch (auc, ap, logloss, wll, n).

    The state is one cell per distinct score, kept and added to by the state store; earlier rows are never read again. Round
    scores to bound the number of cells. A replayed batch writes its row anew.
    """

    def step(cells: DataFrame, batch_id: int) -> None:
        # The metrics take several passes, each of which would read the batch and write the state again.
        found = cell_metrics(materialize(cells, "cells")).select("auc", "ap", "logloss", "wll", (F.col("n_pos") + F.col("n_neg")).cast("bigint").alias("n"))
        found.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    cells = score_cells(stream, label, score)
    return cells.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(step).start()
