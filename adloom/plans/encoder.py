"""Fit and apply a whole column spec: the table-level encoder.

Fitting takes one aggregate for scalers, one for sequence lengths, one token count for all vocabularies, one merge
for all shared ones, one run per distinct bucket count and one per pretrained feature.
Applying it is one lazy plan over a batch or streaming table.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adloom.functions import hooks
from adloom.operators import encode as enc
from adloom.operators import vocab as voc
from adloom.operators.clean import is_missing, spark_type
from adloom.operators.quantiles import quantile_boundaries
from adloom.session import materialize, path_exists
from adloom.spec import FeatureSpec, LabelSpec, expand, labels


def prepare(
    df: DataFrame, specs: Sequence[FeatureSpec], label_specs: Sequence[LabelSpec], keep: Sequence[str] = ()
) -> DataFrame:
    """Fill missing values, cast to the declared types, run hooks, keep the active columns.

    Labels come first, then features in reverse spec order; ``keep`` columns pass through in front. Labels
    may be absent; an absent active feature that no hook makes is an error. A non-text column without ``fill_na`` fails at run time if it really has missing values.
    """
    order = [*label_specs, *reversed(specs)]
    absent = [s.name for s in specs if s.active and not s.preprocess and s.name not in df.columns]
    if absent:
        raise ValueError(f"the table lacks the feature columns {absent}")
    for s in order:
        kind = "string" if getattr(s, "is_float_sequence", False) else spark_type(s.dtype)
        if s.name in df.columns:
            df = df.withColumn(s.name, _filled(df, s).cast(kind))
        if s.preprocess:
            fn, arg = hooks.resolve(s.preprocess, s.name)
            df = df.withColumn(s.name, fn(df, arg).cast(kind))
    names = [s.name for s in order if s.active is not False and s.name in df.columns]
    return df.select(*[c for c in keep if c not in names], *names)


def _filled(df: DataFrame, s: FeatureSpec | LabelSpec) -> Column:
    c = F.col(s.name)
    missing = is_missing(df, s.name)
    if s.fill_na is not None:
        fill = F.lit(s.fill_na) if dict(df.dtypes)[s.name] != "string" else F.lit(str(s.fill_na))
        return F.when(missing, fill).otherwise(c)
    if s.dtype == "str":
        return F.coalesce(c.cast("string"), F.lit(""))
    fail = F.raise_error(F.lit(f"column {s.name} has missing values and no fill_na"))
    return F.when(missing, fail.cast(dict(df.dtypes)[s.name])).otherwise(c)


@dataclass
class FittedEncoder:
    """Everything :meth:`transform` needs; vocabularies stay a table."""

    dataset_id: str
    specs: list[FeatureSpec]
    labels: list[LabelSpec]
    vocab: DataFrame
    stats: dict[str, voc.VocabStats]
    scalers: dict[str, enc.Scaler] = field(default_factory=dict)
    max_len: dict[str, int] = field(default_factory=dict)
    boundaries: dict[str, list[float]] = field(default_factory=dict)
    hash_buckets: dict[str, int] = field(default_factory=dict)

    # -- vocabulary ownership ------------------------------------------------------------------

    def owner(self, s: FeatureSpec) -> str:
        """The feature whose vocabulary (or scaler) a shared feature uses."""
        return s.share_embedding or s.name

    def _normalizer(self, s: FeatureSpec) -> Any:
        target = next(x for x in self.specs if x.name == self.owner(s))
        return target.normalizer if callable(target.normalizer) else self.scalers.get(target.name)

    # -- transform -----------------------------------------------------------------------------

    def transform(self, df: DataFrame, prepared: bool = False, keep: Sequence[str] = (), id_col: str | None = None) -> DataFrame:
        """Encode a table: ``keep`` columns, features in spec order, then labels.

        Columns with vocabularies too large for the row are looked up together, in one narrow pass; ``id_col`` (unique) is
        only used there. Streams go through
        :func:`adloom.streaming.jobs.transform_stream`, which applies this plan to each micro-batch.
        """
        if df.isStreaming:
            raise ValueError("encode a stream with adloom.streaming.jobs.transform_stream")
        absent = [s.name for s in self.specs if s.active and s.name not in df.columns] if prepared else []
        if absent:
            raise ValueError(f"the table lacks the feature columns {absent}")
        if not prepared:
            df = prepare(df, self.specs, self.labels, keep)
        present = [s for s in self.specs if s.name in df.columns and s.active]
        together = self._looked_up_together(present)
        for s in present:
            if s in together:
                continue
            if s.type == "numeric":
                normalizer = self._normalizer(s) if s.normalizer else None
                x = F.col(s.name).cast("double")
                df = df.withColumn(s.name, x if normalizer is None else enc.apply_normalizer(x, normalizer))
            elif s.type == "categorical" or s.has_vocab and s.type == "meta":
                df = self._categorical(df, s)
            elif s.type == "sequence":
                df = self._sequence(df, s, id_col)
            else:
                df = df.withColumn(s.name, F.col(s.name).cast(spark_type(s.dtype)))
        if together:
            df = self._all_at_once(df, together, id_col)
        names = [s.name for s in self.specs if s.active and s.name in df.columns]
        names += [x.name for x in self.labels if x.name in df.columns]
        return df.select(*[c for c in keep if c not in names], *names)

    def _looked_up_together(self, present: Sequence[FeatureSpec]) -> list[FeatureSpec]:
        """Features whose vocabularies fit neither the row nor (categories) a broadcast; a single category is joined by itself."""
        with_ids = [s for s in present if s.has_vocab and s.type != "numeric"]
        large = [s for s in with_ids if s.type != "sequence" and not self.stats[self.owner(s)].small]
        long = [s for s in with_ids if s.type == "sequence" and not enc.inline(self.stats[self.owner(s)])]
        return [*large, *long] if long or len(large) > 1 else []

    def _all_at_once(self, df: DataFrame, features: Sequence[FeatureSpec], id_col: str | None) -> DataFrame:
        def tokens(s: FeatureSpec) -> Column:
            if s.type == "sequence":
                return enc.sequence_tokens(s.name, s.splitter, self.max_len[s.name], s.padding, s.lower)
            return F.lower(F.col(s.name).cast("string")) if s.lower else F.col(s.name).cast("string")

        if id_col is not None and any(s.name == id_col for s in features):
            raise ValueError(f"id_col {id_col!r} is itself encoded")
        df = df.withColumns({s.name: tokens(s) for s in features})
        lookups = [enc.Lookup(s.name, self.owner(s), self.stats[self.owner(s)], s.na_value) for s in features]
        df = enc.encode_columns(df, lookups, self.vocab, id_col)
        return df.withColumns({
            s.name: enc.fixed_length(s.name, self.max_len[s.name], s.padding) if s.type == "sequence" else F.col(s.name).cast("int")
            for s in features
        })

    def _categorical(self, df: DataFrame, s: FeatureSpec) -> DataFrame:
        if s.category_processor == "quantile_bucket":
            return df.withColumn(s.name, enc.quantile_bucket(s.name, self.boundaries[s.name]))
        if s.category_processor == "hash_bucket":
            return df.withColumn(s.name, enc.hash_bucket(s.name, self.hash_buckets[s.name]))
        owner = self.owner(s)
        out = enc.encode_category(df, s.name, self.vocab, self.stats[owner], owner, lower=s.lower)
        return out.withColumn(s.name, F.col(s.name).cast("int"))

    def _sequence(self, df: DataFrame, s: FeatureSpec, id_col: str | None) -> DataFrame:
        n = self.max_len[s.name]
        if s.is_float_sequence:
            value = -1.0 if s.padding_idx is None else float(s.padding_idx)
            return df.withColumn(
                s.name, enc.encode_float_sequence(s.name, s.splitter, n, self._normalizer(s), s.padding, value)
            )
        owner = self.owner(s)
        return enc.encode_sequence(
            df, s.name, s.splitter, self.vocab, self.stats[owner], n, s.padding, s.na_value, owner,
            lower=s.lower, id_col=id_col,
        )

    def extend_meta(self, df: DataFrame, order: str) -> FittedEncoder:
        """A copy whose meta keys also cover ``df``: new keys continue by their smallest ``order`` value."""
        vocab = self.vocab
        for s in self.specs:
            if s.type == "meta" and s.remap:
                keys = df.where(F.col(s.name).isNotNull()).groupBy(F.col(s.name).cast("string").alias("token"))
                new = keys.agg(F.lit(0).cast("bigint").alias("cnt"), F.min(order).alias("_o"))
                vocab = voc.extend_vocab(vocab, new.select(F.lit(s.name).alias("feature"), "token", "cnt", "_o"), ["_o", "token"])
        vocab = materialize(vocab, "vocab")
        return replace(self, vocab=vocab, stats=voc.collect_stats(vocab))

    # -- derived metadata ----------------------------------------------------------------------

    def feature_map(self) -> list[dict[str, Any]]:
        """One entry per active feature, in spec order: the schema a model reads."""
        out = []
        for i, s in enumerate(x for x in self.specs if x.active):
            e: dict[str, Any] = {
                "feature": s.name, "position": i, "type": s.type, "dtype": s.dtype, "source": s.source,
                "vocab_size": None, "oov_idx": None, "padding_idx": None, "max_len": None,
                "share_embedding": s.share_embedding, "embedding_dim": s.embedding_dim, "emb_output_dim": s.emb_output_dim,
            }
            if s.has_vocab:
                st = self.stats[self.owner(s)]
                e.update(vocab_size=st.size, oov_idx=st.oov_idx, padding_idx=float(s.padding_idx or 0))
            elif s.category_processor == "quantile_bucket":
                e["vocab_size"] = len(self.boundaries[s.name]) + 1
            elif s.category_processor == "hash_bucket":
                e["vocab_size"] = self.hash_buckets[s.name]
            if s.type == "sequence":
                e["max_len"] = self.max_len[s.name]
                if s.is_float_sequence:
                    e["padding_idx"] = -1.0 if s.padding_idx is None else float(s.padding_idx)
            out.append(e)
        return out

    def feature_map_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.feature_map(), FEATURE_MAP_SCHEMA)

    # -- persistence ---------------------------------------------------------------------------

    def save(self, path: str, mode: str = "errorifexists") -> None:
        """Tables only: vocabulary, feature map and one row of fitted state."""
        spark = self.vocab.sparkSession
        if any(callable(s.normalizer) for s in self.specs):
            raise ValueError("function normalizers cannot be saved; register them again after loading")
        if mode == "errorifexists" and path_exists(spark, f"{path}/state/_SUCCESS"):
            raise ValueError(f"{path} already holds an encoder")
        # The state comes last and marks the whole as stored; leftovers of a run that broke off are replaced.
        mode = "overwrite"
        self.vocab.write.mode(mode).parquet(f"{path}/vocab")
        self.feature_map_df(spark).coalesce(1).write.mode(mode).parquet(f"{path}/feature_map")
        state = {
            "dataset_id": self.dataset_id,
            "specs": [asdict(s) for s in self.specs],
            "labels": [asdict(x) for x in self.labels],
            "stats": {k: asdict(v) for k, v in self.stats.items()},
            "scalers": self.scalers, "max_len": self.max_len,
            "boundaries": self.boundaries, "hash_buckets": self.hash_buckets,
        }
        spark.createDataFrame([(self.dataset_id, json.dumps(state))], "dataset_id string, state string").coalesce(1).write.mode(mode).parquet(f"{path}/state")


# Fixed schema of the feature-map table.
FEATURE_MAP_SCHEMA = (
    "feature string, position int, type string, dtype string, source string, vocab_size bigint, oov_idx bigint, "
    "padding_idx double, max_len int, share_embedding string, embedding_dim int, emb_output_dim int"
)


def load(
    spark: SparkSession, path: str, dataset_id: str, use_features: Sequence[str] | None = None,
    feature_specs: Mapping[str, Mapping[str, Any]] | None = None,
) -> FittedEncoder:
    """Reload a saved encoder; another dataset's encoder is refused.

    ``use_features`` keeps only these features active; ``feature_specs`` overrides fields of a feature's spec.
    """
    state = json.loads(spark.read.parquet(f"{path}/state").first()["state"])
    if state["dataset_id"] != dataset_id:
        raise ValueError(f"encoder belongs to dataset {state['dataset_id']!r}, not {dataset_id!r}")
    specs = []
    for s in state["specs"]:
        s = {**s, **(feature_specs or {}).get(s["name"], {})}
        if use_features is not None and s["name"] not in use_features:
            s["active"] = False
        specs.append(FeatureSpec(**s))
    unknown = {*(use_features or ()), *(feature_specs or {})} - {s.name for s in specs}
    if unknown:
        raise ValueError(f"the stored encoder has no features {sorted(unknown)}")
    return FittedEncoder(
        dataset_id,
        specs,
        [LabelSpec(**x) for x in state["labels"]],
        spark.read.parquet(f"{path}/vocab"),
        {k: voc.VocabStats(**{**v, "hot": tuple(v["hot"])}) for k, v in state["stats"].items()},
        {k: tuple(v) for k, v in state["scalers"].items()},
        state["max_len"], state["boundaries"], state["hash_buckets"],
    )


def fit(
    df: DataFrame, feature_cols: Sequence[Mapping[str, Any] | FeatureSpec],
    label_col: Mapping[str, Any] | Sequence[Mapping[str, Any]], dataset_id: str = "dataset",
    min_categr_count: int = 1, num_buckets: int = 10, prepared: bool = False,
    pretrained: Mapping[str, DataFrame] | None = None,
) -> FittedEncoder:
    """Fit every active column of the (training) table.

    ``pretrained`` maps a feature to its (key, vector) table: the keys join the vocabulary.
    """
    specs, label_specs = expand(feature_cols), labels(label_col)
    data = df if prepared else prepare(df, specs, label_specs)
    active = [s for s in specs if s.active]

    with_vocab = [s for s in active if s.has_vocab]
    owners = [s for s in with_vocab if not s.share_embedding]
    sharers = [s for s in with_vocab if s.share_embedding]
    vocab = _fit_vocab(data, with_vocab, owners, sharers, min_categr_count)
    for feature, table in (pretrained or {}).items():
        keys = table.select(F.lit(feature).alias("feature"), F.col("key").cast("string").alias("token"), F.lit(0).cast("bigint").alias("cnt"))
        vocab = voc.extend_vocab(vocab, keys)
    vocab = materialize(vocab, "vocab")

    kinds = {s.name: s.normalizer for s in active if s.type == "numeric" and isinstance(s.normalizer, str)}
    scalers = enc.fit_scalers(data, kinds)
    max_len = {s.name: s.max_len for s in active if s.type == "sequence"}
    open_len = {s.name: s.splitter for s in active if s.type == "sequence" and s.dtype == "str" and not s.max_len}
    if open_len:
        max_len.update(voc.sequence_max_len(data, open_len).first().asDict())

    boundaries: dict[str, list[float]] = {}
    by_count: dict[int, list[str]] = {}
    for s in active:
        if s.category_processor == "quantile_bucket":
            by_count.setdefault(s.num_buckets or num_buckets, []).append(s.name)
    for n, names in by_count.items():
        boundaries.update({r["feature"]: list(r["boundaries"]) for r in quantile_boundaries(data, names, n).collect()})
    hashed = [s for s in active if s.category_processor == "hash_bucket"]
    hash_buckets: dict[str, int] = {}
    if hashed:
        seen = data.agg(*[F.countDistinct(F.coalesce(F.col(s.name).cast("string"), F.lit(""))).alias(s.name) for s in hashed]).first()
        hash_buckets = {s.name: min(s.num_buckets or num_buckets, seen[s.name]) for s in hashed}
    return FittedEncoder(
        dataset_id, specs, label_specs, vocab, voc.collect_stats(vocab), scalers, max_len, boundaries, hash_buckets
    )


def _fit_vocab(
    data: DataFrame, with_vocab: Sequence[FeatureSpec], owners: Sequence[FeatureSpec], sharers: Sequence[FeatureSpec], floor: int
) -> DataFrame:
    if not with_vocab:
        return data.sparkSession.range(0).selectExpr("'' AS feature", "'' AS token", "id AS idx", "id AS cnt")
    counts = voc.token_counts(
        data,
        [s.name for s in with_vocab if s.type != "sequence"],
        {s.name: s.splitter for s in with_vocab if s.type == "sequence"} or None,
        [s.name for s in with_vocab if s.lower],
    )
    if sharers or len({(s.num_ids, s.remap) for s in owners}) > 1:
        # Several vocabularies come from these counts: count the table once.
        counts = materialize(counts, "counts")

    def build(group: Sequence[FeatureSpec], ids: int | None, remap: bool) -> DataFrame:
        names = [s.name for s in group]
        mine = counts.where(F.col("feature").isin(*names))
        return voc.build_vocab(
            mine, names, {s.name: s.min_categr_count or floor for s in group}, {s.name: s.na_value for s in group}, ids, remap
        )

    def all_of(group: Sequence[FeatureSpec]) -> DataFrame | None:
        out = None
        for ids, remap in sorted({(s.num_ids, s.remap) for s in group}, key=str):
            part = build([s for s in group if (s.num_ids, s.remap) == (ids, remap)], ids, remap)
            out = part if out is None else out.unionByName(part)
        return out

    vocab = all_of(owners)
    if not sharers:
        return vocab
    # Shared vocabularies grow in spec order, then token order: all sharers are numbered together.
    by_name = {s.name: s for s in owners}
    found = all_of(sharers).where(~F.col("token").isin(voc.PAD, voc.OOV))
    places = {s.name: F.struct(F.lit(s.share_embedding).alias("owner"), F.lit(i).alias("place")) for i, s in enumerate(sharers)}
    where = F.create_map(*[x for n, place in places.items() for x in (F.lit(n), place)])[F.col("feature")]
    tokens = found.groupBy(where["owner"].alias("feature"), "token").agg(F.sum("cnt").alias("cnt"), F.min(where["place"]).alias("_place"))
    own_ids = [n for n, s in by_name.items() if not s.remap]
    numbered = tokens.where(~F.col("feature").isin(*own_ids)) if own_ids else tokens
    if len(own_ids) < len(by_name):
        vocab = voc.extend_vocab(vocab, numbered, ["_place", "token"])
    if own_ids:
        vocab = voc.add_own_ids(vocab, tokens.where(F.col("feature").isin(*own_ids)))
    return vocab


def field_counts(feature_map: DataFrame, sources: Sequence[str] = ()) -> DataFrame:
    """(num_fields, total_features, input_length) from a feature-map table.

    Shared vocabularies count once; numeric fields and float sequences count 1; meta keys are no fields.
    """
    fields = F.col("type") != "meta"
    if sources:
        fields = fields & F.col("source").isin(*sources)
    own = F.when(F.col("type") == "numeric", 1).when((F.col("type") == "sequence") & (F.col("dtype") == "float"), 1)
    own = own.when(F.col("type") == "meta", 0).when(F.col("share_embedding").isNotNull(), 0).otherwise(F.col("vocab_size"))
    return feature_map.agg(
        F.count_if(fields).alias("num_fields"), F.sum(own).alias("total_features"),
        F.sum(F.coalesce("max_len", F.lit(1))).alias("input_length"),
    )


def column_offsets(feature_map: DataFrame, label_names: Sequence[str] = ()) -> DataFrame:
    """(feature, offset, width): consecutive positions of the flat row vector, labels after the inputs.

    The feature map has one row per column, so its window is small by construction.
    """
    inputs = feature_map.select("feature", "position", F.coalesce("max_len", F.lit(1)).alias("width"))
    if label_names:
        tail = feature_map.sparkSession.range(1).select(
            F.posexplode(F.array(*[F.lit(n) for n in label_names])).alias("p", "feature")
        )
        last = inputs.agg(F.max("position")).scalar()
        inputs = inputs.unionByName(tail.select("feature", (last + 1 + F.col("p")).alias("position"), F.lit(1).alias("width")))
    before = W.orderBy("position").rowsBetween(W.unboundedPreceding, -1)
    return inputs.select("feature", F.coalesce(F.sum("width").over(before), F.lit(0)).alias("offset"), "width")


def model_inputs(encoded: DataFrame, fitted: FittedEncoder, sources: Sequence[str] = (), drop: Sequence[str] = ()) -> DataFrame:
    """The input columns of the given sources, without meta keys and ``drop`` columns."""
    names = [s.name for s in fitted.specs if s.type != "meta" and s.active and (not sources or s.source in sources) and s.name not in drop]
    return encoded.select(*names)


def record_schema(fitted: FittedEncoder) -> str:
    """Typed record schema: numeric and label float, ids bigint, sequences arrays."""
    parts = []
    for s in fitted.specs:
        if s.active:
            kind = {"numeric": "float", "categorical": "bigint", "meta": "bigint"}.get(s.type)
            parts.append(f"`{s.name}` {kind or ('array<float>' if s.is_float_sequence else 'array<bigint>')}")
    return ", ".join([*parts, *[f"`{x.name}` float" for x in fitted.labels]])


def encode_meta(df: DataFrame, column: str, split: str, first: str, order: str) -> DataFrame:
    """Group keys → ids. The ``first`` split numbers its keys in key order; keys that appear only in
    other splits continue after them, by their smallest ``order`` value."""
    keys = df.select(F.col(column).cast("string").alias("token"), F.col(split).alias("_s"), F.col(order).alias("_o")).where(F.col("token").isNotNull())
    seen = keys.groupBy("token").agg(F.count_if(F.col("_s") == first).alias("cnt"), F.min("_o").alias("_o"))
    feature = F.lit(column).alias("feature")
    base = voc.build_vocab(seen.where(F.col("cnt") > 0).select(feature, "token", "cnt"), [column])
    full = voc.extend_vocab(base, seen.where(F.col("cnt") == 0).select(feature, "token", "cnt", "_o"), ["_o", "token"])
    full = materialize(full, "meta")
    return enc.encode_category(df, column, full, voc.collect_stats(full)[column])


def pretrained_matrix(fitted: FittedEncoder, feature: str, pretrained: DataFrame, dim: int) -> DataFrame:
    """(token, idx, vector) of a fitted feature whose vocabulary includes the pretrained keys."""
    spec = next(s for s in fitted.specs if s.name == feature)
    mine = fitted.vocab.where(F.col("feature") == fitted.owner(spec))
    return enc.align_pretrained(mine, pretrained, dim, spec.freeze_emb)
