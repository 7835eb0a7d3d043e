"""Vocabularies as tables: (feature, token, idx, cnt).

Id 0 is the padding token and the highest id is the out-of-vocabulary token of each feature. Tokens
are counted for all features in one shuffle and numbered by exact distributed rank, so neither the
number of tokens nor one dominant feature is limited by a single task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.functions.arrays import WHITE_SPACE, split_tokens
from adloom.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, anti_join
from adloom.operators.quantiles import unpivot
from adloom.operators.ranking import with_rank
from adloom.session import materialize

# Reserved tokens and the id of the padding token.
PAD, OOV = "__PAD__", "__OOV__"
PAD_IDX = 0


def feature_table(spark: SparkSession, features: Sequence[str]) -> DataFrame:
    """One row per feature name, built inside the plan."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))


def _per_feature(values: Mapping[str, object] | object, default: object) -> Column:
    if not isinstance(values, Mapping):
        return F.lit(values)
    col = F.lit(default)
    for feature, value in values.items():
        col = F.when(F.col("feature") == feature, F.lit(value)).otherwise(col)
    return col


def token_counts(
    df: DataFrame,
    columns: Sequence[str] = (),
    sequences: Mapping[str, str] | None = None,
    lower: Sequence[str] = (),
    skip_blank: bool = False,
) -> DataFrame:
    """(feature, token, cnt) of categorical columns and of separator-delimited sequence columns.

    Null values and null or empty sequences give no token. ``lower`` features are folded before
    counting, so counts of case variants add up. ``skip_blank`` trims sequence tokens and drops
    empty ones.
    """
    parts = []
    if columns:
        parts.append(unpivot(df, columns, "string").withColumnRenamed("value", "token"))
    if sequences:
        arrays = []
        for name, sep in sequences.items():
            arrays.append(F.struct(F.lit(name).alias("feature"), split_tokens(name, sep).alias("tokens")))
        one = df.select(F.explode(F.array(*arrays)).alias("s")) if len(arrays) > 1 else df.select(arrays[0].alias("s"))
        exploded = one.select("s.feature", F.explode("s.tokens").alias("token"))
        if skip_blank:
            exploded = exploded.withColumn("token", F.btrim("token", F.lit(WHITE_SPACE))).where("token <> ''")
        parts.append(exploded)
    long = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if lower:
        long = long.withColumn("token", F.when(F.col("feature").isin(*lower), F.lower("token")).otherwise(F.col("token")))
    return long.where(F.col("token").isNotNull()).groupBy("feature", "token").agg(F.count(F.lit(1)).alias("cnt"))


def sequence_max_len(df: DataFrame, sequences: Mapping[str, str]) -> DataFrame:
    """One row: the longest observed length of each sequence column."""
    return df.agg(*[F.coalesce(F.max(F.size(split_tokens(n, s))), F.lit(0)).alias(n) for n, s in sequences.items()])


def kept_tokens(
    counts: DataFrame,
    min_freq: Mapping[str, int] | int = 1,
    na_value: Mapping[str, str] | str = "",
    num_ids: int | None = None,
) -> DataFrame:
    """Tokens that enter the vocabulary: the ``num_ids`` most frequent (count, then token), then the
    frequency floor, without the missing-value token."""
    if num_ids is not None:
        by_count = counts.withColumn("_neg", -F.col("cnt"))
        ranked = with_rank(by_count, ["_neg", "token"], ["feature"], "_rk", also=["cnt"])
        counts = materialize(ranked.where(F.col("_rk") <= num_ids).drop("_neg", "_rk"), "top")
    return counts.where(
        (F.col("cnt") >= _per_feature(min_freq, 1)) & (F.col("token") != _per_feature(na_value, ""))
    )


def with_reserved(tokens: DataFrame, last_idx: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add the padding and out-of-vocabulary rows; ``last_idx`` is (feature, last), the highest id so far."""
    spark = tokens.sparkSession
    reserved = (
        feature_table(spark, features)
        .join(last_idx, "feature", "left")
        .select(
            "feature",
            F.explode(
                F.array(
                    F.struct(F.lit(PAD).alias("token"), F.lit(PAD_IDX).cast("bigint").alias("idx")),
                    F.struct(F.lit(OOV).alias("token"), (F.coalesce("last", F.lit(0)) + 1).cast("bigint").alias("idx")),
                )
            ).alias("r"),
        )
        .select("feature", "r.token", "r.idx", F.lit(0).cast("bigint").alias("cnt"))
    )
    return tokens.select("feature", "token", F.col("idx").cast("bigint").alias("idx"), "cnt").unionByName(reserved)


def build_vocab(
    counts: DataFrame,
    features: Sequence[str],
    min_freq: Mapping[str, int] | int = 1,
    na_value: Mapping[str, str] | str = "",
    num_ids: int | None = None,
    remap: bool = True,
) -> DataFrame:
    """Vocabulary with ids 1… in token order (or the token's own integer without ``remap``)."""
    kept = kept_tokens(counts, min_freq, na_value, num_ids)
    if remap:
        last = kept.groupBy("feature").agg(F.count(F.lit(1)).alias("last"))
        return with_reserved(with_rank(kept, ["token"], ["feature"], "idx", also=["cnt"]), last, features)
    own = kept.withColumn("idx", F.col("token").cast("bigint"))
    return with_reserved(own, own.groupBy("feature").agg(F.max("idx").alias("last")), features)


def class_labels(counts: DataFrame, always: Sequence[str] = (), features: Sequence[str] = ()) -> DataFrame:
    """0-based classes in token order, no reserved ids; ``always`` are classes even when unseen."""
    if always:
        fixed = feature_table(counts.sparkSession, features).select(
            "feature", F.explode(F.array(*[F.lit(a) for a in always])).alias("token"), F.lit(0).cast("bigint").alias("cnt")
        )
        counts = counts.unionByName(fixed).groupBy("feature", "token").agg(F.sum("cnt").alias("cnt"))
    return with_rank(counts, ["token"], ["feature"], "idx", also=["cnt"]).withColumn("idx", F.col("idx") - 1)


def offset_vocab(counts: DataFrame, features: Sequence[str], capacity: int | None = None) -> DataFrame:
    """Sequence vocabulary with PAD = 0, OOV = 1 and tokens from 2 in token order.

    ``capacity`` bounds the size including the two reserved ids, keeping the most frequent tokens.
    """
    kept = kept_tokens(counts, num_ids=None if capacity is None else capacity - 2)
    tokens = with_rank(kept, ["token"], ["feature"], "idx", also=["cnt"]).withColumn("idx", F.col("idx") + 1)
    reserved = feature_table(counts.sparkSession, features).select(
        "feature",
        F.explode(
            F.array(
                F.struct(F.lit(PAD).alias("token"), F.lit(0).cast("bigint").alias("idx")),
                F.struct(F.lit(OOV).alias("token"), F.lit(1).cast("bigint").alias("idx")),
            )
        ).alias("r"),
    )
    return tokens.select("feature", "token", "idx", "cnt").unionByName(
        reserved.select("feature", "r.token", "r.idx", F.lit(0).cast("bigint").alias("cnt"))
    )


def extend_vocab(vocab: DataFrame, new_tokens: DataFrame, order: Sequence[str] = ("token",)) -> DataFrame:
    """Add tokens the vocabulary lacks; ``new_tokens`` is (feature, token, cnt, …order columns).

    New ids start at the old OOV id, in ``order``; OOV always moves to one past the highest id.
    """
    # Both are read several times below; a written table keeps that from repeating their plans.
    vocab = materialize(vocab, "vocab")
    unseen = materialize(anti_join(new_tokens, vocab, ["feature", "token"]), "unseen")
    oov = vocab.where(F.col("token") == OOV).select("feature", F.col("idx").alias("_oov"))
    fresh = (
        with_rank(unseen, list(order), ["feature"], "_nth")
        .join(oov, "feature")
        .select("feature", "token", (F.col("_oov") + F.col("_nth") - 1).alias("idx"), "cnt")
    )
    grown = unseen.groupBy("feature").agg(F.count(F.lit(1)).alias("_new"))
    moved = (
        vocab.where(F.col("token") == OOV)
        .join(grown, "feature", "left")
        .select("feature", "token", (F.col("idx") + F.coalesce("_new", F.lit(0))).alias("idx"), "cnt")
    )
    return vocab.where(F.col("token") != OOV).unionByName(fresh).unionByName(moved)


def add_own_ids(vocab: DataFrame, tokens: DataFrame) -> DataFrame:
    """Add tokens that are their own ids; OOV moves to one past the highest id of its feature."""
    unseen = anti_join(tokens.select("feature", "token", "cnt"), vocab, ["feature", "token"]).withColumn("idx", F.col("token").cast("bigint"))
    oov = F.col("token") == OOV
    both = vocab.where(~oov).unionByName(unseen)
    top = both.where(F.col("token") != PAD).groupBy("feature").agg(F.max("idx").alias("_top"))
    moved = vocab.where(oov).join(top, "feature", "left").select(
        "feature", "token", F.greatest("idx", F.coalesce(F.col("_top") + 1, F.col("idx"))).alias("idx"), "cnt"
    )
    return both.unionByName(moved)


def merge_vocab(shared: DataFrame, column_vocab: DataFrame, owner: str, remap: bool = True) -> DataFrame:
    """Add the real tokens of another feature's vocabulary to the vocabulary of ``owner``.

    Without ``remap`` they keep the integers they are.
    """
    tokens = column_vocab.where(~F.col("token").isin(PAD, OOV)).select(F.lit(owner).alias("feature"), "token", "cnt")
    return extend_vocab(shared, tokens) if remap else add_own_ids(shared, tokens)


def vocab_sizes(vocab: DataFrame) -> DataFrame:
    return vocab.groupBy("feature").agg((F.max("idx") + 1).alias("vocab_size"))


@dataclass(frozen=True)
class VocabStats:
    """What encoding needs to know about one feature's vocabulary."""

    size: int
    oov_idx: int
    tokens: int
    bytes: int
    hot: tuple[str, ...] = ()

    @property
    def small(self) -> bool:
        return self.tokens <= BROADCAST_ROWS and self.bytes <= BROADCAST_BYTES


def collect_stats(vocab: DataFrame) -> dict[str, VocabStats]:
    """One row per feature; hot tokens (at least 1 % of the occurrences, so at most 100 per feature)
    are looked up only for vocabularies too large to broadcast."""
    rows = vocab.groupBy("feature").agg(
        F.max("idx").alias("top"),
        F.max(F.when(F.col("token") == OOV, F.col("idx"))).alias("oov"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.octet_length("token") + 16).alias("b"),
        F.sum("cnt").alias("total"),
    )
    facts = {r["feature"]: r for r in rows.collect()}
    stats = {f: VocabStats(r["top"] + 1, r["oov"], r["n"], r["b"]) for f, r in facts.items()}
    large = [f for f, s in stats.items() if not s.small]
    if large:
        floor = _per_feature({f: max(1, facts[f]["total"] // 100) for f in large}, 1)
        hot = vocab.where(F.col("feature").isin(*large) & (F.col("cnt") >= floor)).select("feature", "token").collect()
        for f in large:
            s = stats[f]
            stats[f] = VocabStats(s.size, s.oov_idx, s.tokens, s.bytes, tuple(r["token"] for r in hot if r["feature"] == f))
    return stats
