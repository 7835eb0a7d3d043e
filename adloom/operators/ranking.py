"""Exact order statistics without a single-partition window.

The key range is cut into buckets at boundaries taken from a hash sample of the keys. A row's bucket
depends on its key and the boundaries only, so losing an executor and recomputing gives the same
bucket again and no lineage cut is needed. Bucket totals (one row per bucket after map-side
combining) give each bucket its starting offset; the window then runs inside a bucket.

All orders are ascending over unique keys: negate a number for descending order, and
aggregate duplicates into a weight first. Balance comes from the sample; results are exact with any
boundaries.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adloom.operators.joins import fits_broadcast, null_safe_join
from adloom.session import materialize, shuffle_partitions

SAMPLES_PER_BUCKET = 8
MAX_BUCKETS = 8192
CUTOFF_BUCKETS = 1024


def _key(cols: Sequence[str]) -> Column:
    return F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)


def bucket_boundaries(
    df: DataFrame, key_cols: Sequence[str], buckets: int, also: Sequence[str] = ()
) -> DataFrame:
    """One row, one array of at most ``buckets - 1`` ascending keys cutting the range evenly.

    The sample is the rows with the smallest hashes. An approximate row count first thins the table
    to about four times the sample, so the part that is brought together does not grow with the
    table. ``also`` names columns the main pass reads anyway: hashing them too keeps this pass on the
    same shuffle.
    """
    wanted = buckets * SAMPLES_PER_BUCKET
    rows = df.select(_key(key_cols).alias("k"), F.xxhash64(*dict.fromkeys([*key_cols, *also])).alias("h"))
    estimate = rows.agg(F.approx_count_distinct("h")).scalar()
    # The top 30 bits of the hash, as a number in [0, 1).
    unit = F.shiftrightunsigned("h", 34).cast("double") / F.lit(float(1 << 30))
    sample = (
        rows.where(unit * estimate < F.lit(float(4 * wanted)))
        .orderBy("h")
        .limit(wanted)
        .agg(F.array_sort(F.collect_list("k")).alias("s"))
    )
    cut = F.transform(
        F.sequence(F.lit(1), F.lit(max(buckets - 1, 1))),
        lambda i: F.get("s", F.floor(i * F.size("s") / F.lit(buckets)).cast("int")),
    )
    return sample.select(F.filter(cut, lambda k: k.isNotNull()).alias("bounds"))


def with_bucket(
    df: DataFrame, key_cols: Sequence[str], buckets: int | None = None, name: str = "_bucket",
    bounds: DataFrame | None = None, also: Sequence[str] = (),
) -> DataFrame:
    """Add the number of boundaries at or below the row's key, found by halving steps."""
    buckets = min(buckets or 4 * shuffle_partitions(df.sparkSession), MAX_BUCKETS)
    steps = [1 << p for p in range(max(buckets - 1, 1).bit_length() - 1, -1, -1)]
    if bounds is None:
        bounds = bucket_boundaries(df, key_cols, buckets, also)
    key = _key(key_cols)

    # One projection per halving step keeps the search in generated code (a lambda would not be). The
    # boundaries are a constant of the plan, evaluated once; they are never a column of the rows.
    edges = bounds.scalar()
    found = df.withColumn(name, F.lit(0))
    for step in steps:
        probe = F.get(edges, F.col(name) + (step - 1))
        found = found.withColumn(name, F.col(name) + F.when(probe <= key, step).otherwise(0))
    return found


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    totals: Mapping[str, str | Column],
    by: Sequence[str] = (),
    buckets: int | None = None,
    also: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running sums of ``totals`` in ``order`` within each ``by`` group.

    A group may be of any size: it is spread over as many buckets as its share of the rows. Only
    groups that straddle a boundary get a non-zero offset, so the broadcast table has fewer rows
    than there are buckets.
    """
    by = list(by)
    summed = [v for v in totals.values() if isinstance(v, str) and v in df.columns]
    frame = with_bucket(df, [*by, *order], buckets, also=[*summed, *also])
    names = list(totals)
    exprs = [F.expr(v) if isinstance(v, str) else v for v in totals.values()]
    cells = frame.groupBy(*by, "_bucket").agg(*[F.sum(e).alias(n) for n, e in zip(names, exprs)])
    before = W.partitionBy(*by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        cells.select(
            *by,
            "_bucket",
            *[F.sum(n).over(before).alias(f"_before_{n}") for n in names],
            F.row_number().over(W.partitionBy(*by).orderBy("_bucket")).alias("_nth"),
        )
        .where("_nth > 1")
        .drop("_nth")
    )
    inside = W.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = frame.select(
        *df.columns, "_bucket", *[F.sum(e).over(inside).alias(f"_in_{n}") for n, e in zip(names, exprs)]
    )
    joined = null_safe_join(local, offsets, [*by, "_bucket"], "left", broadcast=True)
    return joined.select(
        *df.columns,
        *[(F.col(f"_in_{n}") + F.coalesce(F.col(f"_before_{n}"), F.lit(0))).alias(n) for n in names],
    )


def with_rank(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    name: str = "rank",
    buckets: int | None = None,
    also: Sequence[str] = (),
) -> DataFrame:
    """Exact 1-based position of each row in ``order`` within its ``by`` group.

    Over an aggregated table pass an aggregate column as ``also``: all passes then share its shuffle
    (see :func:`bucket_boundaries`).
    """
    return running_totals(df, order, {name: F.lit(1).cast("bigint")}, by, buckets, also)


def with_row_index(df: DataFrame, order: Sequence[str], name: str = "row_idx") -> DataFrame:
    """Dense 0-based global row index in key order."""
    return with_rank(df, order, name=name).withColumn(name, F.col(name) - 1)


def rank_targets(counts: DataFrame, ranks: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Where the wanted ranks lie: (by…, _cell, _total, _name, _r) with ``_r`` counted from the start of the cell.

    ``counts`` holds the weight ``_n`` of each (by…, _cell); ``ranks`` is as in :func:`keys_at_ranks`.
    """
    upto = W.partitionBy(*by).orderBy("_cell").rowsBetween(W.unboundedPreceding, 0)
    cells = counts.withColumn("_upto", F.sum("_n").over(upto)).withColumn("_total", F.sum("_n").over(W.partitionBy(*by)))
    wanted = F.array(*[F.struct(F.lit(n).alias("n"), r.cast("bigint").alias("r")) for n, r in ranks.items()])
    return (
        cells.select(*by, "_cell", "_upto", "_n", "_total", F.explode(wanted).alias("t"))
        .where((F.col("t.r") <= F.col("_upto")) & (F.col("t.r") > F.col("_upto") - F.col("_n")))
        .select(*by, "_cell", "_total", F.col("t.n").alias("_name"), (F.col("t.r") - F.col("_upto") + F.col("_n")).alias("_r"))
    )


def keys_at_ranks(
    df: DataFrame,
    order: Sequence[str],
    ranks: Mapping[str, Column],
    by: Sequence[str] = (),
    weight: str | Column | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """One row per ``by`` group with the key at each requested 1-based rank (null outside) and ``_total``.

    ``ranks`` maps an output name to an expression over ``_total``, the group's total weight. Only
    the buckets that hold a wanted rank are ever sorted; the rest of the table is counted map-side.
    """
    by = list(by)
    buckets = buckets or min(CUTOFF_BUCKETS, 16 * shuffle_partitions(df.sparkSession))
    mass = F.lit(1).cast("bigint") if weight is None else (F.expr(weight) if isinstance(weight, str) else weight)
    narrow = df.select(*by, *order, mass.alias("_w"))
    keys = [*by, *order]
    if weight is None:
        # Raw rows are cheaper to scan again than to store; both passes must cut at the same keys.
        bounds = materialize(bucket_boundaries(narrow, keys, buckets), "bounds")
        frame = with_bucket(narrow, keys, buckets, "_cell", bounds)
    else:
        # Weighted rows come from an aggregation: store them with their buckets and aggregate once.
        frame = materialize(with_bucket(narrow, keys, buckets, "_cell", also=["_w"]), "weighted")
    targets = rank_targets(frame.groupBy(*by, "_cell").agg(F.sum("_w").alias("_n")), ranks, by)
    # One row per group and rank.
    targets = materialize(targets, "targets")
    small = fits_broadcast(targets)
    cells_hit = targets.select(*by, "_cell").distinct()
    local = materialize(null_safe_join(frame, cells_hit, [*by, "_cell"], "left_semi", broadcast=small), "cells")
    ranked = running_totals(local, order, {"_cum": "_w"}, [*by, "_cell"])
    hit = F.col("_r").between(F.col("_cum") - F.col("_w") + 1, F.col("_cum"))
    found = null_safe_join(ranked, targets, [*by, "_cell"], "inner", broadcast=small, extra=hit).select(
        *by, "_total", "_name", _key(order).alias("_k")
    )
    groups = found.groupBy(*by) if by else found.groupBy()
    picked = [F.max(F.when(F.col("_name") == n, F.col("_k"))).alias(n) for n in ranks]
    return groups.agg(*picked, F.max("_total").alias("_total"))
