"""Projection, filtering, casting and missing-value rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions.arrays import as_col
from adloom.operators.joins import lookup_join

# Declared dtype -> Spark type. Anything else in a spec is an error.
DTYPES = {"str": "string", "float": "double", "int": "bigint"}


def spark_type(dtype: str) -> str:
    try:
        return DTYPES[dtype]
    except KeyError:
        raise ValueError(f"dtype {dtype!r} is not one of {sorted(DTYPES)}") from None


def keep_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def by_prefix(df: DataFrame, include: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """Columns whose name starts with one of ``include`` and none of ``exclude``."""
    names = [c for c in df.columns if c.startswith(tuple(include)) and not c.startswith(tuple(exclude) or ("\0",))]
    return df.select(*names)


def ensure_label(df: DataFrame, label: str = "clicked", value: float = 0.0) -> DataFrame:
    """Add a constant label where the table has none."""
    return df if label in df.columns else df.withColumn(label, F.lit(value))


def copy_column(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.withColumn(target, F.col(source))


def drop_null(df: DataFrame, *cols: str) -> DataFrame:
    return df.dropna(subset=list(cols))


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating-point column."""
    missing = F.col(name).isNull()
    return missing | F.isnan(name) if dict(df.dtypes)[name] in ("double", "float") else missing


def fill_missing(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace null/NaN by the column's default."""
    return df.select(
        *[
            F.when(is_missing(df, c), F.lit(defaults[c]).cast(t)).otherwise(F.col(c)).alias(c) if c in defaults else F.col(c)
            for c, t in df.dtypes
        ]
    )


def numeric_or_zero(c: str | Column, default: float = 0.0) -> Column:
    """Tolerant parse: text that is no number, null and NaN become ``default``."""
    return F.coalesce(F.nanvl(as_col(c).try_cast("double"), F.lit(None).cast("double")), F.lit(default))


def text_or(c: str | Column, default: str = "unknown") -> Column:
    return F.coalesce(as_col(c).cast("string"), F.lit(default))


def value_counts(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("cnt"))


def frequent_values(df: DataFrame, name: str, min_freq: int) -> DataFrame:
    """Values occurring at least ``min_freq`` times, with their counts."""
    return value_counts(df, name).where(F.col("cnt") >= min_freq)


def mark_rare(
    df: DataFrame, name: str, kept: DataFrame, out: str, small: bool, rare: str = "rare"
) -> DataFrame:
    """Replace values that are not in ``kept`` by one label. ``small``: ``kept`` was checked to be broadcastable."""
    return lookup_join(df, name, kept, name, name, out, F.lit(rare), small)


def ensure_sequences(df: DataFrame, wanted: Sequence[str], source: str = "seq") -> DataFrame:
    """Missing sequence columns copy ``source``, or are '' when that is missing too."""
    base = F.coalesce(F.col(source).cast("string"), F.lit("")) if source in df.columns else F.lit("")
    return df.select("*", *[base.alias(c) for c in wanted if c not in df.columns])


def class_from_score(df: DataFrame, score: str, out: str, threshold: float = 0.5) -> DataFrame:
    """Scores already in [0, 1] stay as they are; any other scale is cut to 0/1 at ``threshold``."""
    low = df.agg(F.min(score)).scalar()
    high = df.agg(F.max(score)).scalar()
    cut = F.when(F.col(score) > threshold, 1.0).otherwise(0.0)
    return df.withColumn(out, F.when((low < 0) | (high > 1), cut).otherwise(F.col(score)))
