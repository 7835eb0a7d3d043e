"""Vector operators without learned weights.

Two shapes are served. *Grouped* vectors (entity, pos, vector) can be of any number per entity: they
are summed element by element with map-side combining. *Fields of a row* (ARRAY<ARRAY<DOUBLE>>, one
inner array per field) are bounded by the schema, and their pairwise products stay inside the row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adloom.functions.arrays import as_col
from adloom.operators.joins import cut_join, fits_broadcast, null_safe_join
from adloom.operators.metrics import TINY, top_k

MAX_ORDER = 5
MASKED_SCORE = -1e9
# exp(-SPAN) is far above the smallest double.
SPAN = 256.0


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def array_sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def doubles(vector: str | Column) -> Column:
    return as_col(vector).cast("array<double>")


def elements(df: DataFrame, entity: str, vector: str, extra: Sequence[str] = ()) -> DataFrame:
    """(entity, extra…, dim, x) with one row per vector element."""
    return df.select(entity, *extra, F.posexplode(doubles(vector)).alias("dim", "x"))


# ---- grouped vectors -----------------------------------------------------------------------------


def sum_pooling(df: DataFrame, entity: str, vector: str) -> DataFrame:
    return elements(df, entity, vector).groupBy(entity, "dim").agg(F.sum("x").alias("value"))


def average_pooling(df: DataFrame, entity: str, vector: str) -> DataFrame:
    """Sum over the number of vectors whose elements do not add up to zero (padding)."""
    flagged = df.withColumn("_live", F.when(array_sum(doubles(vector)) != 0, 1.0).otherwise(0.0))
    sums = elements(flagged, entity, vector, ["_live"]).groupBy(entity, "dim").agg(F.sum("x").alias("_s"), F.sum("_live").alias("_m"))
    return sums.select(entity, "dim", (F.col("_s") / (F.col("_m") + TINY)).alias("value"))


def kmax_pooling(df: DataFrame, entity: str, pos: str, vector: str, k: int) -> DataFrame:
    """The k largest values of each dimension, in original order: (entity, dim, slot, value).

    Equal values keep the smaller position.
    """
    cells = elements(df, entity, vector, [pos]).withColumn("_neg", -F.col("x"))
    best = top_k(cells, [entity, "dim"], ["_neg", pos], k, "_rk")
    slots = best.groupBy(entity, "dim").agg(F.sort_array(F.collect_list(F.struct(F.col(pos).alias("p"), F.col("x")))).alias("l"))
    return slots.select(entity, "dim", F.posexplode("l.x").alias("slot", "value"))


def bi_interaction(df: DataFrame, entity: str, vector: str) -> DataFrame:
    """Sum of all pairwise products per dimension, from the sums of values and of squares."""
    sums = elements(df, entity, vector).groupBy(entity, "dim").agg(F.sum("x").alias("_s"), F.sum(F.col("x") * F.col("x")).alias("_q"))
    return sums.select(entity, "dim", ((F.col("_s") * F.col("_s") - F.col("_q")) / 2).alias("value"))


def product_sum(df: DataFrame, entity: str, vector: str) -> DataFrame:
    return bi_interaction(df, entity, vector).groupBy(entity).agg(F.sum("value").alias("value"))


def symmetric_polynomials(df: DataFrame, entity: str, vector: str, order: int = 2) -> DataFrame:
    """Elementary symmetric polynomials e_1 … e_order per dimension: (entity, dim, e1, …).

    From power sums p_i by Newton's recurrence  n·e_n = Σ_{i=1..n} (−1)^{i−1} e_{n−i} p_i.
    """
    if not 1 <= order <= MAX_ORDER:
        raise ValueError(f"order must be 1..{MAX_ORDER}")
    powers = [F.sum(F.pow(F.col("x"), F.lit(float(i)))).alias(f"p{i}") for i in range(1, order + 1)]
    sums = elements(df, entity, vector).groupBy(entity, "dim").agg(*powers)
    e: list[Column] = [F.lit(1.0)]
    for n in range(1, order + 1):
        terms = [(-1.0) ** (i - 1) * e[n - i] * F.col(f"p{i}") for i in range(1, n + 1)]
        e.append(sum(terms[1:], terms[0]) / n)
    return sums.select(entity, "dim", *[e[n].alias(f"e{n}") for n in range(1, order + 1)])


def target_attention(
    items: DataFrame, targets: DataFrame, entity: str, vector: str, target: str, heads: int = 1,
    use_scale: bool = True, mask: str | None = None,
) -> DataFrame:
    """Softmax-weighted sum of an entity's item vectors, scored against its target vector.

    (entity, dim, value). ``targets`` has one vector per entity; ``mask`` is a 0/1 column of items. The softmax is
    computed in one aggregate of mergeable sums, so an entity may have any number of items; each is scored once. The items of a
    hot entity are not shuffled to a large table of targets.
    """
    t = targets.select(entity, doubles(target).alias("_t"))
    cols = [entity, doubles(vector).alias("_v")]
    if mask:
        cols.append(F.col(mask).alias("_mask"))
    narrow = items.select(*cols)
    if fits_broadcast(t):
        joined = null_safe_join(narrow, t, [entity], "inner", broadcast=True)
    else:
        joined = cut_join(narrow, t, [entity], "inner", null_safe=True)
    width = F.floor(F.size("_v") / heads).cast("int")
    parts = F.transform(
        F.sequence(F.lit(0), F.lit(heads - 1)),
        lambda h: F.struct(
            h.alias("head"),
            F.slice("_v", h * width + 1, width).alias("v"),
            _dot(F.slice("_v", h * width + 1, width), F.slice("_t", h * width + 1, width)).alias("dot"),
        ),
    )
    scored = joined.select("*", F.explode(parts).alias("p"))
    score = F.col("p.dot") / F.sqrt(F.size("p.v").cast("double")) if use_scale else F.col("p.dot")
    if mask:
        score = F.when(F.col("_mask") == 0, F.lit(MASKED_SCORE)).otherwise(score)
    scored = scored.select(entity, "p.head", F.col("p.v").alias("_hv"), score.alias("_s"))
    # Scores are cut into ranges as wide as a double can hold; weights are relative to the upper end of their range, so they
    # add up in one aggregate with partial sums. Ranges are rescaled when they meet: there are few of them per entity.
    ranged = scored.withColumn("_range", F.floor(F.col("_s") / SPAN))
    weighted = ranged.withColumn("_w", F.exp(F.col("_s") - (F.col("_range") + 1) * SPAN))
    sums = (
        weighted.select(entity, "head", "_range", "_w", F.posexplode("_hv").alias("d", "x"), F.size("_hv").alias("width"))
        .groupBy(entity, "head", "width", "d", "_range")
        .agg(F.sum(F.col("_w") * F.col("x")).alias("_num"), F.sum("_w").alias("_den"))
    )
    highest = F.max("_range").over(W.partitionBy(entity, "head", "d"))
    rescaled = sums.withColumn("_f", F.exp((F.col("_range") - highest) * SPAN))
    return rescaled.groupBy(entity, (F.col("head") * F.col("width") + F.col("d")).cast("int").alias("dim")).agg(
        (F.sum(F.col("_num") * F.col("_f")) / F.sum(F.col("_den") * F.col("_f"))).alias("value")
    )


def squeeze(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Mean over the elements of each vector."""
    v = doubles(vector)
    return df.select(key, (array_sum(v) / F.size(v)).alias("value"))


def embedding_lookup(df: DataFrame, entity: str, ids: str, table: DataFrame, idx: str = "idx", vector: str = "vector") -> DataFrame:
    """(entity, pos, vector) for each id of an id or id-array column; ids without a vector are dropped.

    A table that was counted and fits is broadcast; beyond that only rows with ids that are not hot are shuffled.
    """
    kind = dict(df.dtypes)[ids]
    long = (
        df.select(entity, F.posexplode(ids).alias("pos", "_id"))
        if kind.startswith("array") else df.select(entity, F.lit(0).alias("pos"), F.col(ids).alias("_id"))
    )
    vectors = table.select(F.col(idx).alias("_id"), doubles(vector).alias("vector"))
    if fits_broadcast(vectors):
        found = long.join(F.broadcast(vectors), "_id")
    else:
        found = cut_join(long, vectors, ["_id"], "inner")
    return found.select(entity, "pos", "vector")


def numeric_embedding(df: DataFrame, entity: str, value: str, weights: Sequence[float]) -> DataFrame:
    """A numeric field's vector: the value times a weight vector."""
    return df.select(entity, F.transform(F.array(*[F.lit(float(w)) for w in weights]), lambda w: w * F.col(value)).alias("vector"))


# ---- fields of one row ---------------------------------------------------------------------------


def as_fields(vector: str | Column, fields: int) -> Column:
    """Cut a flat vector into ``fields`` equal field vectors."""
    v = doubles(vector)
    width = F.floor(F.size(v) / fields).cast("int")
    return F.transform(F.sequence(F.lit(0), F.lit(fields - 1)), lambda i: F.slice(v, i * width + 1, width))


def stack_fields(*vectors: str | Column) -> Column:
    return F.array(*[doubles(v) for v in vectors])


def concat_fields(fields: str | Column) -> Column:
    return F.flatten(as_col(fields))


def _field_pairs(df: DataFrame, key: str, fields: str, n: int) -> DataFrame:
    """(key, i, j, a, b) for the field pairs i < j of each row; ``n`` is fixed by the schema."""
    pairs = [
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.get(fields, F.lit(i)).alias("a"), F.get(fields, F.lit(j)).alias("b"))
        for i in range(n) for j in range(i + 1, n)
    ]
    return df.select(key, F.explode(F.array(*pairs)).alias("p")).select(key, "p.*")


def inner_products(df: DataFrame, key: str, fields: str, n: int) -> DataFrame:
    return _field_pairs(df, key, fields, n).select(key, "i", "j", _dot(F.col("a"), F.col("b")).alias("value"))


def elementwise_products(df: DataFrame, key: str, fields: str, n: int) -> DataFrame:
    return _field_pairs(df, key, fields, n).select(key, "i", "j", F.zip_with("a", "b", lambda x, y: x * y).alias("vector"))


def circular_products(df: DataFrame, key: str, fields: str, n: int, kind: str = "circular_convolution") -> DataFrame:
    """Circular convolution  Σ_k a[k]·b[(m−k) mod d]  or correlation  Σ_k a[k]·b[(m+k) mod d]  of field pairs."""
    if kind == "hadamard_product":
        return elementwise_products(df, key, fields, n)
    if kind not in ("circular_convolution", "circular_correlation"):
        raise ValueError(f"interaction {kind!r} is not supported")
    sign = -1 if kind == "circular_convolution" else 1
    d = F.size("a")

    def at(m: Column) -> Column:
        return F.aggregate(
            F.transform("a", lambda x, k: x * F.get("b", F.pmod(m + k * sign, d))), F.lit(0.0), lambda s, x: s + x
        )

    return _field_pairs(df, key, fields, n).select(key, "i", "j", F.transform(F.sequence(F.lit(0), d - 1), at).alias("vector"))
