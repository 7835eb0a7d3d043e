"""Scalar expressions used by hooks, splits, baselines and scoring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adloom.functions.arrays import as_col, split_tokens

# Upper bound (inclusive) of each labelled age range; anything older is the last label.
AGE_UPPER_BOUNDS = ((10, "1"), (20, "2"), (30, "3"), (40, "4"), (50, "5"), (60, "6"))
AGE_LAST_LABEL = "7"
AGE_RANGE = (1, 95)
# The hashed baseline's floor, step count and ceiling.
BASELINE_FLOOR, BASELINE_STEPS, BASELINE_SCALE, BASELINE_CEILING = 0.01, 1000, 10000.0, 0.2


def compact_date(stamp: str | Column) -> Column:
    """Date of a YYMMDDHH text, years 2000-2099."""
    return F.to_date(F.concat(F.lit("20"), F.substring(as_col(stamp), 1, 6)), "yyyyMMdd")


def weekday(stamp: str | Column) -> Column:
    """Sunday = 0 … Saturday = 6."""
    return F.dayofweek(compact_date(stamp)) - 1


def weekend(stamp: str | Column) -> Column:
    return F.when(weekday(stamp).isin(0, 6), 1).otherwise(0)


def hour_of(stamp: str | Column) -> Column:
    return F.substring(as_col(stamp), 7, 2).cast("int")


def log_square_bucket(value: str | Column) -> Column:
    """Integer part of the squared logarithm above 2, the truncated value up to 2."""
    v = as_col(value).cast("double")
    return F.when(v > 2, F.floor(F.pow(F.log(v), 2))).otherwise(v.cast("bigint")).cast("int")


def text_prefix(value: str | Column, n: int = 2) -> Column:
    return F.coalesce(F.substring(as_col(value), 1, n), F.lit(""))


def age_bucket(age: str | Column) -> Column:
    years = as_col(age).try_cast("double")
    low, high = AGE_RANGE
    out = F.when(years.isNull() | (years < low) | (years > high), "")
    for bound, label in AGE_UPPER_BOUNDS:
        out = out.when(years <= bound, label)
    return out.otherwise(AGE_LAST_LABEL)


def rejoin(text: str | Column, sep: str = ",", new_sep: str = "^", max_len: int = 50) -> Column:
    """First ``max_len`` tokens joined by another separator; null and '' give ''."""
    return F.array_join(F.slice(split_tokens(text, sep), 1, max_len), new_sep)


def clip(value: str | Column, low: float, high: float) -> Column:
    """Bounded value; null stays null and NaN stays NaN."""
    x = as_col(value)
    return F.when(F.isnan(x.cast("double")), x).when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def sigmoid(x: str | Column) -> Column:
    return 1 / (1 + F.exp(-as_col(x)))


def link(x: str | Column, task: str) -> Column:
    """Output link of a task: sigmoid for binary classification, identity for regression."""
    if task == "binary_classification":
        return sigmoid(x)
    if task == "regression":
        return as_col(x)
    raise ValueError(f"task {task!r} is not supported")


def md5_key(key: str | Column, seed: int = 42) -> Column:
    """A seeded, reproducible 128-bit hash as hex text: the order used by every exact random split."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), as_col(key).cast("string")))


def md5_int(key: str | Column, seed: int = 42, digits: int = 8) -> Column:
    """Leading hex digits of :func:`md5_key` as a BIGINT."""
    return F.conv(F.substring(md5_key(key, seed), 1, digits), 16, 10).cast("bigint")


def hash_unit(key: str | Column, seed: int = 42) -> Column:
    """Uniform value in [0, 1) that depends on the key only."""
    return md5_int(key, seed) / F.lit(float(1 << 32))


def hash_probability(key: str | Column, seed: int = 42) -> Column:
    """Stable pseudo-probability of a key for the no-model baseline."""
    step = F.pmod(md5_int(key, seed), F.lit(BASELINE_STEPS)) / F.lit(BASELINE_SCALE)
    return F.least(F.lit(BASELINE_CEILING), step + F.lit(BASELINE_FLOOR))
