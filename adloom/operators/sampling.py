"""Deterministic samples and splits.

Random order means the order of a seeded MD5 of a unique row id: the same rows are drawn on any
cluster, with any partitioning, after any retry. Exact sizes come from cutoffs (the key found at a
given rank), so the wide table is only ever filtered or labelled, never sorted or shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions.scalars import hash_unit, md5_key
from adloom.operators.joins import fits_broadcast, null_safe_join
from adloom.operators.ranking import keys_at_ranks
from adloom.session import materialize

# Up to this many rows an exact sample is one bounded heap per task; above it, a cutoff filter.
HEAP_ROWS = 1_000


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """Exactly the first ``min(n, total)`` rows in key order (unique keys)."""
    if n <= HEAP_ROWS:
        return df.orderBy(*order).limit(n)
    return _below_cutoff(df, order, n)


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, total)`` rows drawn without replacement: those with the smallest hashes."""
    hashed = df.withColumn("_h", md5_key(key, seed))
    order = ["_h", key]
    picked = hashed.orderBy(*order).limit(n) if n <= HEAP_ROWS else _below_cutoff(hashed, order, n)
    return picked.select(*df.columns)


def _below_cutoff(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    last = keys_at_ranks(df, order, {"last": F.least(F.lit(n), F.col("_total"))}).select("last").scalar()
    key = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return df.where(key <= last)


def fraction_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Map-only sample of about ``fraction`` of the rows."""
    return df.where(hash_unit(key, seed) < fraction)


def shuffle_rows(df: DataFrame, key: str, epoch: int = 0, seed: int = 42) -> DataFrame:
    """A new global order per epoch, by range partitioning on the hash."""
    return df.orderBy(md5_key(key, seed * 1_000_003 + epoch), key)


def split_size(size: float, total: str = "_total") -> Column:
    """Rows asked for: a fraction below 1 (rounded down) or a count."""
    if size < 1:
        return F.floor(F.col(total) * F.lit(float(size))).cast("bigint")
    return F.lit(int(size)).cast("bigint")


def _tail_split(
    df: DataFrame, order: Sequence[str], valid_size: float, test_size: float, by: Sequence[str], out: str
) -> DataFrame:
    test, valid = split_size(test_size), split_size(valid_size)
    rank_of = {"test_from": F.col("_total") - test + 1, "valid_from": F.col("_total") - test - valid + 1}
    # One row per stratum, stored so that later passes over the split do not find the cutoffs again.
    cutoffs = materialize(keys_at_ranks(df, order, rank_of, by).drop("_total"), "cutoffs")
    key = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    label = (
        F.when(key >= F.col("test_from"), "test").when(key >= F.col("valid_from"), "valid").otherwise("train")
    )
    if by:
        joined = null_safe_join(df, cutoffs, by, "left", broadcast=fits_broadcast(cutoffs))
    else:
        both = cutoffs.select(F.struct("test_from", "valid_from").alias("c")).scalar()
        joined = df.select("*", both.alias("_c")).select(
            *df.columns, F.col("_c.test_from").alias("test_from"), F.col("_c.valid_from").alias("valid_from")
        )
    return joined.select(*df.columns, label.alias(out))


def sequential_split(
    df: DataFrame, order: Sequence[str], valid_size: float = 0, test_size: float = 0, out: str = "split"
) -> DataFrame:
    """Test from the tail, valid from the new tail, train before them, all in key order."""
    return _tail_split(df, order, valid_size, test_size, (), out)


def random_split(
    df: DataFrame, key: str, valid_size: float = 0, test_size: float = 0, seed: int = 42, out: str = "split"
) -> DataFrame:
    """The same exact sizes in random order."""
    hashed = df.withColumn("_h", md5_key(key, seed))
    return _tail_split(hashed, ["_h"], valid_size, test_size, (), out).drop("_h")


def stratified_split(
    df: DataFrame, key: str, label: str, valid_size: float = 0.15, test_size: float = 0.15,
    seed: int = 42, out: str = "split",
) -> DataFrame:
    """Exact (rounded-down) sizes within each label value, random inside it."""
    hashed = df.withColumn("_h", md5_key(key, seed))
    return _tail_split(hashed, ["_h"], valid_size, test_size, [label], out).drop("_h")


def hash_split(
    df: DataFrame, key: str, cuts: Sequence[tuple[str, float]], seed: int = 42, out: str = "split"
) -> DataFrame:
    """Map-only split: ``cuts`` are (name, upper bound in (0, 1]) in ascending order."""
    unit = hash_unit(key, seed)
    label = F.lit(cuts[-1][0])
    for name, upper in reversed(cuts[:-1]):
        label = F.when(unit < upper, name).otherwise(label)
    return df.withColumn(out, label)


def split_report(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(F.col(label).cast("double")).alias("click_rate")
    )
