"""Applying fitted vocabularies and scalers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions.arrays import as_col, pad, split_tokens, take
from adloom.functions.scalars import md5_int
from adloom.functions.vectorized import Vectorized
from adloom.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, cut_join, lookup_join
from adloom.operators.vocab import OOV, PAD_IDX, VocabStats
from adloom.session import materialize

# Vocabularies up to this size travel inside the plan (each task unpacks them); larger ones are joined.
INLINE_TOKENS = 100_000
INLINE_BYTES = 8 << 20


def encode_category(
    df: DataFrame, column: str, vocab: DataFrame, stats: VocabStats, feature: str | None = None,
    out: str | None = None, lower: bool = False, default: int | None = None,
) -> DataFrame:
    """Replace values by ids; unknown and null values get the OOV id (or ``default``)."""
    tokens = vocab.where(F.col("feature") == (feature or column))
    key = F.col(column).cast("string")
    keyed = df.withColumn("_key", F.lower(key) if lower else key)
    fallback = F.lit(stats.oov_idx if default is None else default).cast("bigint")
    joined = lookup_join(keyed, "_key", tokens, "token", "idx", out or column, fallback, stats.small, stats.hot)
    return joined.drop("_key")


def token_index(vocab: DataFrame, slots: int) -> DataFrame:
    """One row, one array of small token → id maps addressed by hash, for lookups inside arrays."""
    slot = F.pmod(F.xxhash64("token"), F.lit(slots)).cast("int")
    filled = vocab.groupBy(slot.alias("slot")).agg(F.collect_list(F.struct("token", "idx")).alias("e"))
    every = vocab.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot"))
    ordered = every.join(filled, "slot", "left").agg(F.array_sort(F.collect_list(F.struct("slot", "e"))).alias("s"))
    return ordered.select(F.transform("s", lambda x: F.map_from_entries(x["e"])).alias("maps"))


def inline(stats: VocabStats) -> bool:
    """Whether a vocabulary is small enough to be addressed inside each row."""
    return stats.tokens <= INLINE_TOKENS and stats.bytes <= INLINE_BYTES


@dataclass(frozen=True)
class Lookup:
    """A column to encode: a text, or an array of texts whose ``na_value`` is padding."""

    column: str
    feature: str
    stats: VocabStats
    na_value: str = ""


def encode_columns(df: DataFrame, lookups: Sequence[Lookup], vocab: DataFrame, id_col: str | None = None) -> DataFrame:
    """Replace several columns by ids (arrays by arrays of ids) in one pass, for vocabularies of any size.

    All values become one narrow table (row id, column, position, token), which is looked up once, collected once by row id,
    and joined back, so the wide row moves once however many columns there are. Hot tokens and nulls are not shuffled for the
    lookup. Unknown and null values get the OOV id, padding tokens id 0. ``id_col`` is unique; without it rows are numbered.
    """
    keyed = df
    if id_col is None:
        # Written out once, so a retried task cannot number the rows differently.
        id_col = "_rid"
        keyed = materialize(df.withColumn(id_col, F.monotonically_increasing_id()), "rows")
    arrays = [n for n, x in enumerate(lookups) if dict(df.dtypes)[x.column].startswith("array")]
    stats = {x.feature: x.stats for x in lookups}
    place = {f: i for i, f in enumerate(sorted(stats))}

    def cell(n: int, pos: Column, token: Column) -> Column:
        owner = F.lit(place[lookups[n].feature])
        return F.struct(F.lit(n).alias("n"), pos.cast("int").alias("pos"), owner.alias("owner"), token.cast("string").alias("token"))

    def cells(n: int, x: Lookup) -> Column:
        if n not in arrays:
            return F.array(cell(n, F.lit(0), F.col(x.column)))
        return F.coalesce(F.transform(x.column, lambda t, i: cell(n, i, F.nullif(t, F.lit(x.na_value)))), F.array())

    names = list(dict.fromkeys(x.column for x in lookups if x.column != id_col))
    narrow = keyed.select(id_col, *names)
    small = sum(s.tokens for s in stats.values()) <= BROADCAST_ROWS and sum(s.bytes for s in stats.values()) <= BROADCAST_BYTES
    if small:
        # Whole sequences move once; exploding, looking up and collecting then stay in place.
        narrow = narrow.repartition(id_col)
    elif id_col != "_rid":
        # The join takes three passes: the texts are split once and only what is looked up is kept.
        narrow = materialize(narrow, "narrow")
    parts = narrow.select(F.col(id_col).alias("_id"), F.inline(F.concat(*[cells(n, x) for n, x in enumerate(lookups)])))
    owner = F.create_map(*[F.lit(v) for pair in place.items() for v in pair])[F.col("feature")]
    entries = vocab.where(F.col("feature").isin(*place)).select(owner.alias("owner"), "token", "idx")
    if small:
        coded = parts.join(F.broadcast(entries), ["owner", "token"], "left")
    else:
        coded = cut_join(parts, entries, ["owner", "token"])
    if arrays:
        padding = F.col("token").isNull() & F.col("n").isin(*arrays)
        coded = coded.withColumn("idx", F.when(padding, F.lit(PAD_IDX).cast("bigint")).otherwise(F.col("idx")))
    lists = coded.groupBy("_id").agg(F.sort_array(F.collect_list(F.struct("n", "pos", "idx"))).alias("_cells"))

    def ids(n: int, x: Lookup) -> Column:
        mine = F.filter(F.coalesce("_cells", F.array().cast("array<struct<n:int,pos:int,idx:bigint>>")), lambda c: c["n"] == n)
        found = F.transform(mine, lambda c: F.coalesce(c["idx"], F.lit(x.stats.oov_idx).cast("bigint")))
        return (found if n in arrays else F.get(found, F.lit(0))).alias(x.column)

    out = {x.column: ids(n, x) for n, x in enumerate(lookups)}
    return keyed.join(lists, keyed[id_col] == lists["_id"], "left").select(*[out.get(c, F.col(c)) for c in df.columns])


def encode_tokens(
    df: DataFrame, tokens: str, vocab: DataFrame, stats: VocabStats, out: str, na_value: str = "",
    id_col: str | None = None,
) -> DataFrame:
    """Array of tokens → array of ids, same order; the missing-value token is padding, others OOV.

    A vocabulary of moderate size is addressed inside each row, without a shuffle. A larger one goes through
    :func:`encode_columns`.
    """
    if inline(stats):
        oov = F.lit(stats.oov_idx).cast("bigint")
        slots = 1 << max(stats.tokens - 1, 1).bit_length()

        def look_up(t: Column) -> Column:
            hit = F.get("_maps", F.pmod(F.xxhash64(t), F.lit(slots)).cast("int"))[t]
            return F.when(t == na_value, F.lit(PAD_IDX).cast("bigint")).otherwise(F.coalesce(hit, oov))

        maps = token_index(vocab, slots).scalar()
        keep = [c for c in df.columns if c != out]
        return df.select("*", maps.alias("_maps")).select(*keep, F.transform(tokens, look_up).alias(out))
    keep = [c for c in df.columns if c != out]
    staged = df.select(*keep, F.col(tokens).alias("_coded"))
    coded = encode_columns(staged, [Lookup("_coded", "tokens", stats, na_value)], vocab.withColumn("feature", F.lit("tokens")), id_col)
    return coded.withColumnRenamed("_coded", out)


def sequence_tokens(column: str, sep: str, max_len: int, padding: str = "pre", lower: bool = False) -> Column:
    """The tokens of a delimited text that survive cutting to ``max_len``."""
    return take(split_tokens(F.lower(column) if lower else F.col(column), sep), max_len, padding)


def fixed_length(ids: str, max_len: int, padding: str = "pre") -> Column:
    """Ids filled up to ``max_len`` with the padding id."""
    fill = F.array_repeat(F.lit(PAD_IDX).cast("bigint"), F.greatest(F.lit(max_len) - F.size(ids), F.lit(0)))
    return (F.concat(fill, F.col(ids)) if padding == "pre" else F.concat(F.col(ids), fill)).cast("array<int>")


def encode_sequence(
    df: DataFrame, column: str, sep: str, vocab: DataFrame, stats: VocabStats, max_len: int,
    padding: str = "pre", na_value: str = "", feature: str | None = None, out: str | None = None,
    lower: bool = False, id_col: str | None = None,
) -> DataFrame:
    """Delimited text → fixed-length id array, padded and cut on the same side.

    Cutting comes first: tokens that cannot survive are never looked up.
    """
    own = vocab.where(F.col("feature") == (feature or column))
    staged = df.withColumn("_toks", sequence_tokens(column, sep, max_len, padding, lower))
    coded = encode_tokens(staged, "_toks", own, stats, "_ids", na_value, id_col)
    keep = [c for c in df.columns if c != (out or column)]
    return coded.select(*keep, fixed_length("_ids", max_len, padding).alias(out or column))


def pad_longest(df: DataFrame, column: str, value: object = 0, padding: str = "pre") -> DataFrame:
    """Pad to the longest array of the table."""
    longest = df.agg(F.max(F.size(column))).first()[0] or 0
    return df.withColumn(column, pad(column, longest, value, padding))


# ---- numeric scaling -------------------------------------------------------------------------

Scaler = tuple[float, float]  # (offset, divisor)


def fit_scalers(df: DataFrame, kinds: Mapping[str, str]) -> dict[str, Scaler]:
    """One aggregate for all columns; nulls and NaN are ignored; a zero range divides by 1."""
    exprs = []
    for name, kind in kinds.items():
        x = F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
        if kind == "MinMaxScaler":
            exprs += [F.min(x).alias(f"{name}__a"), (F.max(x) - F.min(x)).alias(f"{name}__b")]
        elif kind == "StandardScaler":
            exprs += [F.avg(x).alias(f"{name}__a"), F.stddev_pop(x).alias(f"{name}__b")]
        else:
            raise ValueError(f"normalizer {kind!r} is not supported")
    if not exprs:
        return {}
    row = df.agg(*exprs).first()
    return {n: (row[f"{n}__a"] or 0.0, row[f"{n}__b"] or 1.0) for n in kinds}


def scale(c: str | Column, scaler: Scaler) -> Column:
    return (as_col(c).cast("double") - F.lit(float(scaler[0]))) / F.lit(float(scaler[1]))


def apply_normalizer(c: str | Column, normalizer: Scaler | Callable[[Column], Column]) -> Column:
    """A fitted scaler, or the user's own Column → Column function (a pandas UDF works too)."""
    return normalizer(as_col(c)) if callable(normalizer) else scale(c, normalizer)


def encode_float_sequence(
    column: str | Column, sep: str, max_len: int, scaler: Scaler | Callable[[Column], Column] | None,
    padding: str = "pre", padding_value: float = -1.0,
) -> Column:
    """Delimited numbers → scaled fixed-length array.

    The normaliser is a fitted scaler, a function of columns, or a vectorised function, which takes all elements of a batch at once.
    """
    kept = take(split_tokens(column, sep), max_len, padding)
    if isinstance(scaler, Vectorized):
        numbers = scaler.elements(F.transform(kept, lambda t: t.cast("double")))
    else:
        numbers = F.transform(kept, lambda t: t.cast("double") if scaler is None else apply_normalizer(t.cast("double"), scaler))
    return pad(numbers, max_len, float(padding_value), padding)


# ---- buckets ---------------------------------------------------------------------------------


def quantile_bucket(c: str | Column, boundaries: Sequence[float]) -> Column:
    """Number of boundaries at or below the value; null stays null."""
    x = as_col(c).cast("double")
    edges = F.array(*[F.lit(float(b)) for b in boundaries]) if boundaries else F.array().cast("array<double>")
    return F.when(x.isNotNull(), F.size(F.filter(edges, lambda b: b <= x)))


def hash_bucket(c: str | Column, num_buckets: int, seed: int = 42) -> Column:
    return F.pmod(md5_int(F.coalesce(as_col(c).cast("string"), F.lit("")), seed), F.lit(num_buckets)).cast("int")


# ---- pretrained vectors ----------------------------------------------------------------------


def align_pretrained(vocab: DataFrame, pretrained: DataFrame, dim: int, frozen: bool = True, seed: int = 42) -> DataFrame:
    """(token, idx, vector) for every id of an extended vocabulary.

    Ids without a pretrained vector get zeros (frozen) or small reproducible normal noise; padding is
    always zero.
    """
    found = vocab.join(pretrained.select(F.col("key").alias("token"), F.col("vector").cast("array<double>").alias("_v")), "token", "left")
    zeros = F.array_repeat(F.lit(0.0), dim)
    if frozen:
        missing = zeros
    else:
        # Box-Muller on two hashes of (id, position): the same noise on every run.
        def noise(i: Column) -> Column:
            u1 = (F.pmod(F.xxhash64(F.lit(seed), "idx", i, F.lit(1)), F.lit(1 << 30)) + 1) / F.lit(float((1 << 30) + 1))
            u2 = F.pmod(F.xxhash64(F.lit(seed), "idx", i, F.lit(2)), F.lit(1 << 30)) / F.lit(float(1 << 30))
            return F.sqrt(-2 * F.log(u1)) * F.cos(u2 * F.lit(6.283185307179586)) * F.lit(1e-4)

        missing = F.when(F.col("idx") == PAD_IDX, zeros).otherwise(F.transform(F.sequence(F.lit(1), F.lit(dim)), noise))
    return found.select("token", "idx", F.coalesce("_v", missing).alias("vector"))
