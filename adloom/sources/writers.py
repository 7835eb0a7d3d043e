"""Sinks. Writes fail as a whole when a task fails; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.functions.arrays import non_pad_count
from adloom.session import path_exists


def write_encoded(df: DataFrame, path: str, split: str | None = None, max_records: int | None = None, if_exists: str = "errorifexists") -> None:
    """Encoded data set, one folder per split in a single pass, in files of at most ``max_records`` rows.

    ``if_exists='ignore'`` keeps an existing data set untouched.
    """
    writer = df.write.mode(if_exists)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    if split:
        writer = writer.partitionBy(split)
    writer.parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    """Append rows; a schema that differs from the stored one is refused."""
    spark = df.sparkSession
    stored = spark.read.parquet(path).dtypes if path_exists(spark, path) else None
    if stored is not None and stored != df.dtypes:
        raise ValueError(f"schema mismatch: table has {stored}, rows have {df.dtypes}")
    df.write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_vocab(vocab: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> None:
    """Vocabulary ordered by feature and id."""
    vocab.select("feature", "token", "idx").orderBy("feature", "idx").write.mode(mode).format(fmt).save(path)


def replace_column(df: DataFrame, name: str, values: DataFrame, on: str) -> DataFrame:
    """Stored data set with one column added or replaced by key; write it to a new path."""
    kept = df.drop(name) if name in df.columns else df
    return kept.join(values.select(on, name), on, "left")


def append_result(spark: SparkSession, path: str, experiment: str, dataset: str, metrics: Mapping[str, float]) -> None:
    """One result row with its time."""
    row = spark.range(1).select(
        F.current_timestamp().alias("finished_at"), F.lit(experiment).alias("experiment"), F.lit(dataset).alias("dataset"),
        F.map_from_arrays(
            F.array(*[F.lit(k) for k in metrics]), F.array(*[F.lit(float(v)) for v in metrics.values()])
        ).alias("metrics"),
    )
    row.write.mode("append").parquet(path)


def structure_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, dtype, n_rows, width, avg_non_zero) of a stored data set."""
    types = {c: t for c, t in df.dtypes if columns is None or c in columns}
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c, t in types.items():
        if t.startswith("array"):
            aggs += [F.max(F.size(c)).alias(f"{c}__w"), F.avg(non_pad_count(c).cast("double")).alias(f"{c}__z")]
        else:
            number = F.col(c).try_cast("double") if t == "string" else F.col(c).cast("double")
            aggs += [F.lit(1).alias(f"{c}__w"), F.avg(F.when(number != 0, 1.0).otherwise(0.0)).alias(f"{c}__z")]
    entries = [
        F.struct(
            F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.col("_n").alias("n_rows"),
            F.col(f"{c}__w").alias("width"), F.col(f"{c}__z").alias("avg_non_zero"),
        )
        for c, t in types.items()
    ]
    return df.agg(*aggs).select(F.explode(F.array(*entries)).alias("r")).select("r.*")
