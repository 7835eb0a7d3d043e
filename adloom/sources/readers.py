"""Scans. All are lazy and prune columns at the file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.operators.clean import keep_existing
from adloom.plans.encoder import FittedEncoder, record_schema


def read_text_table(spark: SparkSession, path: str, declared: Sequence[str], sep: str = ",", n_rows: int | None = None) -> DataFrame:
    """Delimited file with a header, every cell as text, declared columns only (those the file has)."""
    header = spark.read.option("header", True).option("sep", sep).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    df = spark.read.schema(schema).option("header", True).option("sep", sep).option("enforceSchema", False).csv(path)
    df = keep_existing(df, declared)
    return df if n_rows is None else df.limit(n_rows)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet, whole or pruned to the wanted columns that exist."""
    df = spark.read.parquet(path)
    return df if columns is None else keep_existing(df, columns)


def read_column(spark: SparkSession, path: str, column: str) -> DataFrame:
    return spark.read.parquet(path).select(column)


def row_count(df: DataFrame) -> DataFrame:
    """Row count as a table; answered from Parquet footers when aggregate push-down is on."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def sql_head(spark: SparkSession, path: str, n: int) -> DataFrame:
    return spark.sql(f"SELECT * FROM parquet.`{path}` LIMIT {int(n)}")


def read_encoded(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """An encoded data set; a split is a pruned partition."""
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def read_records(spark: SparkSession, path: str, fitted: FittedEncoder) -> DataFrame:
    """Encoded data under the typed record schema of its feature map."""
    schema = T.StructType.fromDDL(record_schema(fitted))
    raw = spark.read.parquet(path)
    return raw.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields if f.name in raw.columns])
