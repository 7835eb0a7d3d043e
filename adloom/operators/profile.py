"""Profiling reports: value counts, click rates, missing values, correlations, histograms. NaN counts as missing."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions.arrays import WHITE_SPACE, split_tokens, token_count
from adloom.operators.clean import is_missing, value_counts
from adloom.operators.quantiles import column_quantiles, interpolated_quantiles, unpivot, weighted_values
from adloom.operators.vocab import feature_table
from adloom.session import materialize

# Column pairs up to which a correlation matrix is one wide aggregate.
WIDE_PAIRS = 60
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
# Asked-for error of an estimated number of distinct values: its standard error is then 1.6 %, so a tenth is six of them away.
# With Spark's 0.05 it is two.
APPROX_ERROR = 0.02
LENGTH_QUANTILES = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}


def _rows_to_columns(one_row: DataFrame, groups: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Turn a one-row aggregate into one row per column: {column: {output: aggregate name}}."""
    entries = [
        F.struct(F.lit(name).alias("column"), *[F.col(src).alias(out) for out, src in fields.items()])
        for name, fields in groups.items()
    ]
    return one_row.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def value_ratios(df: DataFrame, name: str) -> DataFrame:
    """Counts with their share of all rows."""
    counts = value_counts(df, name)
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("ratio", F.col("cnt") / total)


def click_rate(df: DataFrame, name: str, label: str) -> DataFrame:
    return df.where(F.col(name).isNotNull()).groupBy(name).agg(
        F.avg(F.col(label).cast("double")).alias("ctr"), F.count(F.lit(1)).alias("cnt")
    )


def top_click_rate(df: DataFrame, name: str, label: str, n: int = 5) -> DataFrame:
    return click_rate(df, name, label).orderBy(F.desc("ctr"), name).limit(n)


def categorical_summary(df: DataFrame, name: str, label: str, top_n: int = 20) -> DataFrame:
    """The most frequent values including null: count, ratio, click rate (null for the null value)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    rows = df.groupBy(name).agg(F.count(F.lit(1)).alias("cnt"), F.avg(F.col(label).cast("double")).alias("_ctr"))
    return (
        rows.orderBy(F.desc("cnt"), F.asc_nulls_last(name))
        .limit(top_n)
        .select(name, "cnt", (F.col("cnt") / total).alias("ratio"), F.when(F.col(name).isNotNull(), F.col("_ctr")).alias("ctr"))
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """(column, n_unique). The exact form counts all columns with one two-level aggregation, the other one estimates them with
    an error of ``APPROX_ERROR``."""
    if approx:
        agg = df.agg(*[F.approx_count_distinct(c, APPROX_ERROR).alias(c) for c in columns])
        return _rows_to_columns(agg, {c: {"n_unique": c} for c in columns})
    pairs = unpivot(df, columns, "string").where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.lit(1).alias("one"))
    found = pairs.groupBy("feature").agg(F.count("one").alias("n"))
    names = feature_table(df.sparkSession, columns)
    return names.join(found, "feature", "left").select(F.col("feature").alias("column"), F.coalesce("n", F.lit(0)).alias("n_unique"))


def _rates(df: DataFrame, flags: Mapping[str, Column], out: str) -> DataFrame:
    agg = df.agg(*[F.avg(f.cast("double")).alias(c) for c, f in flags.items()])
    return _rows_to_columns(agg, {c: {out: c} for c in flags})


def missing_ratio(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _rates(df, {c: is_missing(df, c) for c in columns}, "missing_ratio").orderBy(F.desc("missing_ratio"), "column")


def zero_ratio(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _rates(df, {c: F.coalesce(F.col(c) == 0, F.lit(False)) for c in columns}, "zero_ratio").orderBy(F.desc("zero_ratio"), "column")


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column; quartiles are exact and distributed."""
    exprs, groups = [], {}
    for c in columns:
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        parts = {"count": F.count(x), "mean": F.avg(x), "std": F.stddev_samp(x), "min": F.min(x), "max": F.max(x)}
        exprs += [e.alias(f"{c}__{k}") for k, e in parts.items()]
        groups[c] = {k: f"{c}__{k}" for k in parts}
    moments = _rows_to_columns(df.agg(*exprs), groups)
    quartiles = column_quantiles(df, columns, QUARTILES)
    return moments.join(quartiles.withColumnRenamed("feature", "column"), "column", "left").select(
        "column", "count", "mean", "std", "min", *QUARTILES, "max"
    )


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, top (ties: smallest value) and freq per column."""
    pairs = unpivot(df, columns, "string").where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(F.col("feature").alias("column")).agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def schema_report(df: DataFrame) -> DataFrame:
    """(position, column, dtype, non_null)."""
    agg = df.agg(*[F.count(c).alias(c) for c in df.columns])
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.col(c).alias("non_null"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return agg.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def number(c: str) -> Column:
    """A column as double, NaN counting as missing."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def safe_corr(a: str, b: str) -> Column:
    """Pearson correlation over rows where both are numbers; null when either is constant."""
    x, y = number(a), number(b)
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    varies = (F.max(x) > F.min(x)) & (F.max(y) > F.min(y))
    return F.when(varies, F.covar_pop(x, y) / (F.stddev_pop(x) * F.stddev_pop(y)))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, corr) for every ordered pair of columns, from one pass over the table."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    if len(pairs) > WIDE_PAIRS:
        half = _wide_correlation(df, columns)
        return half.unionByName(half.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "corr"))
    agg = df.agg(*[safe_corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    entries = []
    for a, b in pairs:
        for x, y in {(a, b), (b, a)}:
            entries.append(F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"{a}__{b}").alias("corr")))
    return agg.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


# A variance below this share of the mean square is that of a constant.
FLAT = 1e-12


def _wide_correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, corr) of every unordered pair: each task sums products of whole batches, one row a pair and task goes on.

    Values are taken relative to the column's mean, which keeps the sums well conditioned.
    """
    means = df.agg(*[F.coalesce(F.avg(number(c)), F.lit(0.0)) for c in columns]).first()
    shifted = df.select(*[(number(c) - F.lit(float(m))).alias(f"c{i}") for i, (c, m) in enumerate(zip(columns, means, strict=True))])
    upper = np.triu_indices(len(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, len(columns), len(columns)))
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(columns))]).astype(float)
            held = ~np.isnan(x)
            x, m = np.where(held, x, 0.0), held.astype(float)
            one = x.T @ m, (x * x).T @ m
            sums += np.stack([m.T @ m, one[0], one[0].T, one[1], one[1].T, x.T @ x])
        data = [pa.array(upper[0]), pa.array(upper[1]), *(pa.array(s[upper]) for s in sums)]
        yield pa.RecordBatch.from_arrays(data, names=["i", "j", "n", "x", "y", "xx", "yy", "xy"])

    parts = shifted.mapInArrow(run, "i long, j long, n double, x double, y double, xx double, yy double, xy double")
    total = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    n = F.col("n")
    var = lambda s, ss: F.col(ss) / n - (F.col(s) / n) ** 2
    varies = (n > 0) & (var("x", "xx") > FLAT * F.col("xx") / n) & (var("y", "yy") > FLAT * F.col("yy") / n)
    corr = (F.col("xy") / n - F.col("x") * F.col("y") / (n * n)) / F.sqrt(var("x", "xx") * var("y", "yy"))
    names = F.array(*map(F.lit, columns))
    return total.select(names[F.col("i").cast("int")].alias("a"), names[F.col("j").cast("int")].alias("b"), F.when(varies, corr).alias("corr"))


def label_correlation(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Correlation of each column with the label, highest first."""
    agg = df.agg(*[safe_corr(c, label).alias(c) for c in columns])
    return _rows_to_columns(agg, {c: {"corr": c} for c in columns}).orderBy(F.desc_nulls_last("corr"), "column")


def sequence_stats(df: DataFrame, name: str, sep: str = ",") -> DataFrame:
    """Length statistics of a delimited column: min, max, mean, std and exact percentiles."""
    lengths = df.select(token_count(name, sep).alias("len"))
    # The table of distinct lengths answers everything else without splitting the texts again.
    counted = materialize(weighted_values(lengths, ["len"]), "lengths")
    n, total = F.sum("cnt"), F.sum(F.col("value") * F.col("cnt"))
    spread = F.sum(F.col("value") * F.col("value") * F.col("cnt")) - total * total / n
    basic = counted.agg(
        F.coalesce(n, F.lit(0)).alias("n_rows"), F.min("value").cast("int").alias("min_len"), F.max("value").cast("int").alias("max_len"),
        (total / n).alias("mean_len"), F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / F.nullif(n - 1, F.lit(0)))).alias("std_len"),
    )
    q = interpolated_quantiles(counted, LENGTH_QUANTILES)
    found = q.select(F.struct(*LENGTH_QUANTILES).alias("q")).scalar()
    return basic.select("*", found.alias("q")).select(*basic.columns, *[F.col(f"q.{n}").alias(n) for n in LENGTH_QUANTILES])


def token_frequency(df: DataFrame, name: str, sep: str = ",") -> DataFrame:
    tokens = df.select(F.explode(split_tokens(name, sep)).alias("token")).select(F.btrim("token", F.lit(WHITE_SPACE)).alias("token"))
    return tokens.where("token <> ''").groupBy("token").agg(F.count(F.lit(1)).alias("cnt"))


def top_tokens(df: DataFrame, name: str, sep: str = ",", n: int = 10) -> DataFrame:
    """The most frequent tokens, with the number of distinct ones."""
    freq = token_frequency(df, name, sep)
    # Counting by ``cnt`` lets both uses share one shuffle.
    distinct = freq.agg(F.count_if(F.col("cnt") > 0)).scalar()
    return freq.orderBy(F.desc("cnt"), "token").limit(n).withColumn("n_distinct", distinct)


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    agg = df.agg(*[f(number(c)).alias(f"{c}__{k}") for c in columns for k, f in (("min", F.min), ("max", F.max))])
    return _rows_to_columns(agg, {c: {"min": f"{c}__min", "max": f"{c}__max"} for c in columns})


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) set of every column."""
    return unpivot(df, columns, "string").where(F.col("value").isNotNull()).select(F.col("feature").alias("column"), "value").distinct()


def equal_width_histogram(df: DataFrame, name: str, bins: int = 10) -> DataFrame:
    """(bin, low, high, cnt); the last bin is closed, a constant column spans ±0.5 around its value."""
    x = number(name)
    span = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    span = span.select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    binned = df.where(x.isNotNull()).select(
        F.least(F.floor((x - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("int").alias("bin")
    )
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("cnt"))
    edges = span.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return edges.join(counts, "bin", "left").select(
        "bin", (F.col("lo") + width * F.col("bin")).alias("low"), (F.col("lo") + width * (F.col("bin") + 1)).alias("high"),
        F.coalesce("cnt", F.lit(0)).alias("cnt"),
    )


def range_histogram(df: DataFrame, name: str, edges: Sequence[float]) -> DataFrame:
    """Counts in half-open ranges [edge, next edge); the last range is open at the top."""
    x = number(name)
    conds = [(x >= lo) & (x < hi) for lo, hi in zip(edges, edges[1:])] + [x >= edges[-1]]
    agg = df.agg(*[F.count_if(c).alias(f"r{i}") for i, c in enumerate(conds)])
    entries = [
        F.struct(F.lit(i).alias("bin"), F.lit(float(lo)).alias("low"), F.col(f"r{i}").alias("cnt"))
        for i, lo in enumerate(edges)
    ]
    return agg.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def prediction_summary(df: DataFrame, score: str, threshold: float = 0.5) -> DataFrame:
    x = number(score)
    return df.agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max"),
        F.stddev_pop(x).alias("std"), F.count_if(x > threshold).alias("n_positive"), F.count_if(x <= threshold).alias("n_negative"),
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    y = number(label)
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(y == 1).alias("positives"), F.count_if(y == 0).alias("negatives"),
        F.avg(y).alias("rate"),
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables; columns a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
