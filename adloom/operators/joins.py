"""Key joins that treat null as a value, stay unambiguous on self-derived tables, and survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.session import shuffle_partitions

# A lookup table is broadcast only when it was counted and fits this many rows / bytes.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def null_safe_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    broadcast: bool = False,
    extra: Column | None = None,
) -> DataFrame:
    """Join on equal-or-both-null keys; the right keys do not appear in the result.

    ``broadcast`` is for tables whose row bound the caller has established.
    """
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in on], *[F.col(c) for c in right.columns if c not in on]
    )
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    if extra is not None:
        cond = cond & extra
    out = left.join(F.broadcast(renamed) if broadcast else renamed, cond, how)
    return out.drop(*[f"_r_{c}" for c in on])


def _measure(name: str, kind: T.DataType) -> Column:
    """Bytes of one value; texts and arrays by their own length."""
    c = F.col(f"`{name}`")
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.StringType, T.ArrayType, T.StructType, T.MapType)):
        return F.lit(16) + F.greatest(F.size(c), F.lit(0)) * 8
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.lit(16) + F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.lit(16) + 4 * F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return F.lit(16)


def fits_broadcast(table: DataFrame) -> bool:
    """Whether the rows and bytes of ``table``, as measured by one aggregate, lie within the broadcast limits.

    Give it a stored table or a cheap plan: what is above the table runs once more when it is used.
    """
    size = reduce(lambda a, b: a + b, [_measure(f.name, f.dataType).cast("bigint") for f in table.schema], F.lit(0).cast("bigint"))
    rows, size_ = table.agg(F.count(F.lit(1)), F.sum(size)).first()
    return rows <= BROADCAST_ROWS and (size_ or 0) <= BROADCAST_BYTES


def semi_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return null_safe_join(left, right.select(*on), on, "left_semi")


def anti_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return null_safe_join(left, right.select(*on), on, "left_anti")


def hot_hashes(df: DataFrame, keys: Sequence[str], null_safe: bool = False) -> list[int]:
    """Hashes of the keys that hold more rows than half a shuffle partition should.

    Counted by Spark's mergeable frequent-items sketch in one narrow aggregate, so the list is bounded by twice the number of
    shuffle partitions. The sketch tracks eight times as many items as are wanted. The sketch misses no key above an eighth of that share by more than its error of a fiftieth.
    """
    wanted = 2 * shuffle_partitions(df.sparkSession)
    rows = df if null_safe else df.dropna(subset=list(keys))
    top = F.expr(f"approx_top_k(_hash, {wanted}, {max(8 * wanted, 1024)})")
    found = rows.select(F.xxhash64(*keys).alias("_hash")).agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    return sorted(r["item"] for r in found["top"] or [] if r["count"] * wanted >= found["n"] and r["count"] > 1)


def cut_join(
    df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left", known: Sequence[int] = (), null_safe: bool = False,
) -> DataFrame:
    """Join with a table too large to broadcast, cut in two at the hot keys of ``df``.

    Rows with a hot key stay where they are and meet a broadcast of these keys' entries; all others are shuffled. ``how`` is
    'left' or 'inner'; both sides name their keys alike. Null keys match nothing (each other where ``null_safe``) and are not
    shuffled. ``known`` are hashes of keys known to be hot. The entries are measured before they are broadcast.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how!r}")
    renamed = table.select(
        *[F.col(k).cast(df.schema[k].dataType).alias(f"_r_{k}") for k in keys], *[F.col(c) for c in table.columns if c not in keys]
    )

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) if null_safe else F.col(k) == F.col(f"_r_{k}") for k in keys]
        return left.join(right, reduce(lambda a, b: a & b, same), how).drop(*[f"_r_{k}" for k in keys])

    hot = sorted({*hot_hashes(df, keys, null_safe), *known})
    is_hot = F.xxhash64(*keys).isin(*hot) if hot else F.lit(False)
    if not null_safe:
        is_hot = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], is_hot)
    entries = renamed.where(F.xxhash64(*[f"_r_{k}" for k in keys]).isin(*hot) if hot else F.lit(False))
    if not fits_broadcast(entries):
        return joined(df, renamed)
    return joined(df.where(is_hot), F.broadcast(entries)).unionByName(joined(df.where(~is_hot), renamed))


def lookup_join(
    df: DataFrame,
    key: str,
    table: DataFrame,
    table_key: str,
    table_value: str,
    out: str,
    default: Column,
    small: bool,
    hot_keys: Sequence[str] = (),
) -> DataFrame:
    """Add ``out`` = the table's value for ``key``, or ``default`` when it is missing.

    ``small`` tables (checked by the caller) are broadcast. Others go through :func:`cut_join`, so one key holding a third of
    all rows is not shuffled; ``hot_keys`` are keys known to be hot besides those that are measured.
    """
    entries = table.select(F.col(table_key).alias("_tk"), F.col(table_value).alias("_tv"))
    keep = [c for c in df.columns if c != out]
    keyed = df.withColumn("_tk", F.col(key))
    if small:
        joined = keyed.join(F.broadcast(entries), "_tk", "left")
    else:
        known = df.sparkSession.range(1).select(*[F.xxhash64(F.lit(k)) for k in hot_keys]).first() if hot_keys else ()
        joined = cut_join(keyed, entries, ["_tk"], "left", tuple(known))
    return joined.select(*keep, F.coalesce(F.col("_tv"), default).alias(out))
