"""Exact interpolated quantiles of many columns at once.

The columns of a table are counted in cells where they are read: a mergeable summary of each column gives the cell boundaries, every
task sends one count per (column, cell), and only the values of the cells that hold a wanted rank are grouped and ordered. So of all
values about ranks / cells move, whatever the table's size; the boundaries affect balance, never results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adloom.operators.ranking import keys_at_ranks, rank_targets, running_totals
from adloom.session import materialize

# Cells of a column, a power of two, halved where all columns together would have more than MOST_CELLS.
CELLS, MOST_CELLS = 512, 1 << 16
# Share of the rows that settles the cells.
SAMPLE = 1 / 16
# Values of one cell that a single task may order; a larger cell is ordered in parts.
CELL_VALUES = 1 << 21


def unpivot(df: DataFrame, columns: Sequence[str], kind: str, ids: Sequence[str] = ()) -> DataFrame:
    """(ids…, feature, value) with every column cast to one type."""
    cast = df.select(*ids, *[F.col(c).cast(kind).alias(c) for c in columns])
    return cast.unpivot(list(ids), list(columns), "feature", "value")


def numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value) of the non-null, non-NaN values."""
    return unpivot(df, columns, "double").where(F.col("value").isNotNull() & ~F.isnan("value"))


def weighted_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, cnt) of the non-null, non-NaN values; equal values are combined map-side."""
    return numbers(df, columns).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt"))


def cell_boundaries(df: DataFrame, columns: Sequence[str], cells: int) -> DataFrame:
    """One row, one array: for each column its ``cells`` - 1 ascending boundaries, which cut a sample about evenly."""
    shares = [i / cells for i in range(1, cells)]
    # The sample settles balance only; whatever it holds, results are exact.
    clean = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns]
    picks = df.sample(SAMPLE, seed=1).agg(*[F.percentile_approx(x, shares, F.lit(4 * cells)).alias(f"_{i}") for i, x in enumerate(clean)])
    blank = F.array_repeat(F.lit(0.0), cells - 1)
    return picks.select(F.flatten(F.array(*[F.coalesce(f"_{i}", blank) for i in range(len(columns))])).alias("bounds"))


def in_cells(df: DataFrame, columns: Sequence[str], bounds: DataFrame, cells: int) -> DataFrame:
    """(feature, value, _cell) of all numbers, the cell being the number of the column's boundaries at or below the value.

    ``cells`` is a power of two, so the halving steps never leave the boundaries of the column.
    """
    edges = bounds.scalar()
    named = df.select(*[F.col(c).cast("double").alias(str(i)) for i, c in enumerate(columns)])
    long = numbers(named, [str(i) for i in range(len(columns))]).withColumn("feature", F.col("feature").cast("int")).withColumn("_cell", F.lit(0))
    step = cells // 2
    while step:
        probe = F.get(edges, F.col("feature") * (cells - 1) + F.col("_cell") + (step - 1))
        long = long.withColumn("_cell", F.col("_cell") + F.when(probe <= F.col("value"), step).otherwise(0))
        step //= 2
    return long


def values_in_cells(frame: DataFrame, targets: DataFrame) -> DataFrame:
    """(feature, _cell, value, cnt) of the cells that ``targets`` name; a target per column and rank is all that is broadcast."""
    hit = F.broadcast(targets.select("feature", "_cell").distinct())
    return frame.join(hit, ["feature", "_cell"], "left_semi").groupBy("feature", "_cell", "value").agg(F.count(F.lit(1)).alias("cnt"))


def column_ranks(df: DataFrame, columns: Sequence[str], ranks: Mapping[str, Column]) -> DataFrame:
    """(feature, _total, one column per rank): the values at 1-based ranks, given as expressions over ``_total``."""
    cells = CELLS
    while cells > 2 and cells * len(columns) > MOST_CELLS:
        cells //= 2
    bounds = materialize(cell_boundaries(df, columns, cells), "bounds")
    frame = in_cells(df, columns, bounds, cells)
    counts = materialize(frame.groupBy("feature", "_cell").agg(F.count(F.lit(1)).alias("_n")), "counts")
    targets = rank_targets(counts, ranks, ["feature"])
    values = values_in_cells(frame, targets)
    largest = counts.agg(F.max("_n")).first()[0] or 0
    if largest <= CELL_VALUES:
        upto = W.partitionBy("feature", "_cell").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
        placed = values.withColumn("_cum", F.sum("cnt").over(upto))
    else:
        placed = running_totals(materialize(values, "values"), ["value"], {"_cum": "cnt"}, ["feature", "_cell"])
    hit = F.col("_r").between(F.col("_cum") - F.col("cnt") + 1, F.col("_cum"))
    found = placed.join(F.broadcast(targets), ["feature", "_cell"]).where(hit)
    picked = [F.max(F.when(F.col("_name") == n, F.col("value"))).alias(n) for n in ranks]
    names = F.array(*map(F.lit, columns))
    return found.groupBy(F.get(names, F.col("feature")).alias("feature")).agg(*picked, F.max("_total").alias("_total"))


def _interpolated(quantiles: Mapping[str, float]) -> tuple[dict[str, Column], list[Column]]:
    """The ranks that quantiles lie between, and the quantiles as expressions over their values."""
    ranks, out = {}, []
    for name, q in quantiles.items():
        pos = (F.col("_total") - 1) * F.lit(float(q))
        ranks[f"_lo_{name}"], ranks[f"_hi_{name}"] = F.floor(pos) + 1, F.ceil(pos) + 1
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return ranks, out


def column_quantiles(df: DataFrame, columns: Sequence[str], quantiles: Mapping[str, float]) -> DataFrame:
    """(feature, one column per quantile) of the columns of a table; columns without a number have no row."""
    ranks, out = _interpolated(quantiles)
    return column_ranks(df, columns, ranks).select("feature", *out)


def interpolated_quantiles(values: DataFrame, quantiles: Mapping[str, float]) -> DataFrame:
    """(feature, one column per quantile) from (feature, value, cnt), linear interpolation between ranks.

    No reducer holds a column: only the value buckets around the wanted ranks are ever sorted.
    """
    ranks, out = _interpolated(quantiles)
    return keys_at_ranks(values, ["value"], ranks, ["feature"], "cnt").select("feature", *out)


def quantile_boundaries(df: DataFrame, columns: Sequence[str], num_buckets: int) -> DataFrame:
    """(feature, boundaries): the inner edges of ``num_buckets`` equally filled buckets."""
    names = {f"b{i}": i / num_buckets for i in range(1, num_buckets)}
    q = column_quantiles(df, columns, names)
    return q.select("feature", F.array(*names).alias("boundaries"))
