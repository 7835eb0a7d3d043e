"""Vocabulary, sequence, scaler and whole-table goldens; save/load; streaming equals batch."""

import pytest
from pyspark.sql import functions as F

from adloom.functions import arrays, hooks, scalars
from adloom.operators import encode as enc
from adloom.operators import vocab as voc
from adloom.plans import encoder as plan
from adloom.sources import readers, writers
from adloom.spec import FeatureSpec, expand, restrict


def frame(spark, values, name="c", kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, {name} {kind}")


def ids(vocab, feature=None):
    rows = vocab.where(F.col("feature") == feature) if feature else vocab
    return {r["token"]: r["idx"] for r in rows.collect()}


LETTERS = ["b", "a", "b", "", "c", "b", "a"]


def test_vocab(spark):
    counts = voc.token_counts(frame(spark, LETTERS), ["c"])
    assert ids(voc.build_vocab(counts, ["c"])) == {"__PAD__": 0, "a": 1, "b": 2, "c": 3, "__OOV__": 4}
    assert ids(voc.build_vocab(counts, ["c"], min_freq=2)) == {"__PAD__": 0, "a": 1, "b": 2, "__OOV__": 3}
    assert ids(voc.build_vocab(counts.limit(0), ["c"])) == {"__PAD__": 0, "__OOV__": 1}
    assert ids(voc.build_vocab(counts, ["c"], num_ids=1)) == {"__PAD__": 0, "b": 1, "__OOV__": 2}


def test_no_remap(spark):
    counts = voc.token_counts(frame(spark, ["7", "3"]), ["c"])
    assert ids(voc.build_vocab(counts, ["c"], remap=False)) == {"3": 3, "7": 7, "__PAD__": 0, "__OOV__": 8}


def test_lower_folds_before_counting(spark):
    counts = voc.token_counts(frame(spark, ["A", "a", "B"]), ["c"], lower=["c"])
    assert ids(voc.build_vocab(counts, ["c"], min_freq=2)) == {"__PAD__": 0, "a": 1, "__OOV__": 2}


def _shared(spark):
    return voc.build_vocab(voc.token_counts(frame(spark, ["a", "b"], "s"), ["s"]), ["s"])


def test_merge(spark):
    def column(tokens):
        return voc.build_vocab(voc.token_counts(frame(spark, tokens), ["c"]), ["c"])

    assert ids(voc.merge_vocab(_shared(spark), column(["b", "c", "d"]), "s")) == {"__PAD__": 0, "a": 1, "b": 2, "c": 3, "d": 4, "__OOV__": 5}
    assert ids(voc.merge_vocab(_shared(spark), column(["b", "c"]), "s")) == {"__PAD__": 0, "a": 1, "b": 2, "c": 3, "__OOV__": 4}
    assert ids(voc.merge_vocab(_shared(spark), column(["b"]), "s")) == {"__PAD__": 0, "a": 1, "b": 2, "__OOV__": 3}


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("text,n,side,want", [
    ("a,b,z,a", 3, "pre", [2, 3, 1]), ("a,b,z,a", 3, "post", [1, 2, 3]), ("a,b", 4, "pre", [0, 0, 1, 2]),
    ("a,b", 4, "post", [1, 2, 0, 0]), ("", 2, "pre", [0, 0]), (None, 2, "post", [0, 0]), ("a,,b", 3, "pre", [1, 0, 2]),
])
def test_sequences(spark, small, text, n, side, want):
    vocab = _shared(spark)
    stats = voc.VocabStats(4, 3, 4 if small else 10**9, 40, () if small else ("a",))
    out = enc.encode_sequence(frame(spark, [text]), "c", ",", vocab, stats, n, side, feature="s")
    assert out.first()["c"] == want


@pytest.mark.parametrize("small", [True, False])
def test_category_lookup_with_hot_and_null_keys(spark, small):
    values = ["a"] * 40 + [None] * 20 + ["zz"] * 20 + ["b"]
    stats = voc.VocabStats(4, 3, 4 if small else 10**9, 40, () if small else ("a",))
    out = enc.encode_category(frame(spark, values), "c", _shared(spark), stats, "s").orderBy("id").collect()
    assert [r["c"] for r in out] == [1] * 40 + [3] * 40 + [2]


def test_min_max(spark):
    df = frame(spark, [1.0, 3.0, 5.0, None], kind="double")
    sc = enc.fit_scalers(df, {"c": "MinMaxScaler"})
    assert sc == {"c": (1.0, 4.0)}
    assert [r[0] for r in df.select(enc.scale("c", sc["c"])).collect()] == [0, 0.5, 1, None]
    assert df.select(enc.scale(F.lit(7.0), sc["c"])).first()[0] == 1.5
    flat = frame(spark, [2.0, 2.0], kind="double")
    assert [r[0] for r in flat.select(enc.scale("c", enc.fit_scalers(flat, {"c": "MinMaxScaler"})["c"])).collect()] == [0, 0]
    with pytest.raises(ValueError):
        enc.fit_scalers(df, {"c": "Other"})


def test_pad_and_split_traps(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],), (None,)], "a array<int>")
    assert [r[0] for r in df.select(arrays.pad("a", 5)).collect()] == [[0, 0, 1, 2, 3], [0] * 5, [0] * 5]
    assert [r[0] for r in df.select(arrays.pad("a", 2)).collect()] == [[2, 3], [0, 0], [0, 0]]
    assert [r["a"] for r in enc.pad_longest(df, "a", 9, "post").collect()] == [[1, 2, 3], [9] * 3, [9] * 3]
    for sep in ["^", "|", ",", ".", "\\", "||"]:
        assert df.select(arrays.split_tokens(F.lit(f"x{sep}y"), sep)).first()[0] == ["x", "y"]
    with pytest.raises(ValueError):
        arrays.pad("a", 2, padding="left")


def test_hooks(spark):
    df = spark.createDataFrame([("14101900", 9.0, "0")], "hour string, v double, age string")

    def run(call, arg):
        fn, name = hooks.resolve(call, arg)
        return df.select(fn(df, name)).first()[0]

    assert (run("convert_weekday", "x"), run("convert_weekend", "x"), run("convert_hour", "x")) == (0, 1, 0)
    assert run("convert_to_bucket", "v") == 4 and run("copy_from(age)", "v") == "0"
    values = [run("convert_to_bucket", "v") for _ in (1,)]
    assert values == [4]
    ages = {"0": "", "10": "1", "10.5": "2", "60": "6", "95": "7", "96": "", None: "", "x": ""}
    adf = frame(spark, list(ages), "age")
    assert [r[0] for r in adf.orderBy("id").select(scalars.age_bucket("age")).collect()] == list(ages.values())
    buckets = frame(spark, [9.0, 2.0, -1.7], "v", "double").orderBy("id").select(scalars.log_square_bucket("v")).collect()
    assert [r[0] for r in buckets] == [4, 2, -1]
    with pytest.raises(ValueError, match="unknown preprocess hook"):
        hooks.resolve("no_such(v)", "v")


SPEC = [
    {"name": "g", "type": "meta", "dtype": "str", "remap": False},
    {"name": ["a", "b"], "type": "categorical", "dtype": "str"},
    {"name": "x", "type": "numeric", "dtype": "float", "normalizer": "MinMaxScaler", "fill_na": 0},
    {"name": "s", "type": "sequence", "dtype": "str", "splitter": "^", "share_embedding": "a"},
    {"name": "fs", "type": "sequence", "dtype": "float", "splitter": "|", "max_len": 3, "share_embedding": "x", "fill_na": ""},
    {"name": "q", "type": "categorical", "dtype": "float", "fill_na": 0, "category_processor": "quantile_bucket", "num_buckets": 4},
    {"name": "off", "type": "categorical", "dtype": "str", "active": False},
    {"name": "w", "type": "categorical", "dtype": "str", "preprocess": "copy_from(a)"},
]
LABEL = {"name": "clicked", "dtype": "float"}
DATA = [
    (1, "u1", "p", "m", 0.0, "p^q", "0|10", 1.0, "z", 1), (2, "u1", "q", None, 10.0, "z", "5", 2.0, "z", 0),
    (3, "u2", "p", "n", None, "", None, 3.0, "z", 0), (4, "u3", None, "m", 5.0, None, "1|2|3|4", 4.0, "z", 1),
]


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(DATA, "id int, g string, a string, b string, x double, s string, fs string, q double, off string, clicked int")


@pytest.fixture(scope="module")
def fitted(data):
    return plan.fit(data, SPEC, LABEL, "demo")


def test_whole_table(spark, data, fitted):
    assert ids(fitted.vocab, "a") == {"__PAD__": 0, "p": 1, "q": 2, "z": 3, "__OOV__": 4}
    out = {r["id"]: r for r in fitted.transform(data, keep=["id"]).collect()}
    assert out[1].asDict() == {
        "id": 1, "g": "u1", "a": 1, "b": 1, "x": 0.0, "s": [1, 2], "fs": [-1.0, 0.0, 1.0], "q": 1 - 1, "w": 1, "clicked": 1.0,
    }
    assert out[2]["b"] == 3 and out[2]["s"] == [0, 3] and out[2]["x"] == 1.0
    assert out[4]["a"] == 4 and out[4]["s"] == [0, 0] and out[4]["fs"] == [0.2, 0.3, 0.4]
    assert [out[i]["q"] for i in (1, 2, 3, 4)] == [0, 1, 2, 3]


def test_feature_map(spark, fitted):
    counts = plan.field_counts(fitted.feature_map_df(spark)).first()
    # g is meta; a(5) + b(4) + x(1) + fs(1) + q(4) + w(4); s shares a's vocabulary.
    assert counts["num_fields"] == 7 and counts["total_features"] == 19 and counts["input_length"] == 11
    offs = {r["feature"]: (r["offset"], r["width"]) for r in plan.column_offsets(fitted.feature_map_df(spark), ["clicked"]).collect()}
    assert offs["s"] == (4, 2) and offs["fs"] == (6, 3) and offs["clicked"] == (11, 1)


def test_save_load(spark, data, fitted, tmp_path):
    path = str(tmp_path / "enc")
    fitted.save(path)
    again = plan.load(spark, path, "demo")
    assert sorted(map(str, again.transform(data, keep=["id"]).collect())) == sorted(map(str, fitted.transform(data, keep=["id"]).collect()))
    with pytest.raises(ValueError, match="belongs to dataset"):
        plan.load(spark, path, "other")


def test_transform_is_one_lazy_plan_without_python(data, fitted):
    text = fitted.transform(data)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "SinglePartition" not in text.split("Subquery")[0]


def test_missing_value_without_default_fails(spark):
    df = spark.createDataFrame([(1, None)], "y int, x double")
    spec = [{"name": "x", "type": "numeric", "dtype": "float"}]
    with pytest.raises(Exception, match="no fill_na"):
        plan.prepare(df, expand(spec), []).collect()


def test_spec_errors():
    for bad in ({"type": "image"}, {"type": "sequence"}, {"type": "numeric", "dtype": "complex"},
                {"type": "categorical", "category_processor": "numeric_bucket"}):
        with pytest.raises(ValueError):
            FeatureSpec(name="c", **bad)
    with pytest.raises(KeyError):
        restrict(expand(SPEC), ["a"], [{"name": "b", "source": "x"}])


def test_meta_extends(spark):
    spec = [{"name": "g", "type": "meta", "dtype": "str"}]
    train, later = frame(spark, ["u2", "u1"], "g"), frame(spark, ["u9", "u0", "u1"], "g")
    fitted = plan.fit(train, spec, [])
    assert [r["g"] for r in fitted.transform(train, keep=["id"]).orderBy("id").collect()] == [2, 1]
    grown = fitted.extend_meta(later, "id")
    assert [r["g"] for r in grown.transform(later, keep=["id"]).orderBy("id").collect()] == [3, 4, 1]


def test_pretrained_noise_is_reproducible(spark):
    vocab = _shared(spark)
    emb = spark.createDataFrame([("a", [1.0, 2.0])], "key string, vector array<double>")
    frozen = {r["token"]: r["vector"] for r in enc.align_pretrained(vocab, emb, 2).collect()}
    assert frozen == {"a": [1.0, 2.0], "b": [0.0, 0.0], "__PAD__": [0.0, 0.0], "__OOV__": [0.0, 0.0]}
    one, two = (sorted(map(str, enc.align_pretrained(vocab, emb, 2, frozen=False).collect())) for _ in range(2))
    assert one == two
    free = {r["token"]: r["vector"] for r in enc.align_pretrained(vocab, emb, 2, frozen=False).collect()}
    assert free["__PAD__"] == [0.0, 0.0] and 0 < abs(free["b"][0]) < 1e-3


def test_append_refuses_other_schema(spark, data, tmp_path):
    path = str(tmp_path / "t")
    writers.append_table(data.select("id"), path)
    writers.append_table(data.select("id"), path)
    assert spark.read.parquet(path).count() == 8
    with pytest.raises(ValueError, match="schema mismatch"):
        writers.append_table(data.select("g"), path)


def test_typed_records(spark, data, fitted, tmp_path):
    path = str(tmp_path / "rec")
    writers.write_encoded(fitted.transform(data), path)
    kinds = dict(readers.read_records(spark, path, fitted).dtypes)
    assert kinds["x"] == "float" and kinds["a"] == "bigint" and kinds["s"] == "array<bigint>" and kinds["fs"] == "array<float>"


def test_result_rows(spark, tmp_path):
    path = str(tmp_path / "results")
    writers.append_result(spark, path, "exp1", "demo", {"AUC": 0.6})
    writers.append_result(spark, path, "exp2", "demo", {"AUC": 0.7})
    assert {r["experiment"]: r["metrics"]["AUC"] for r in spark.read.parquet(path).collect()} == {"exp1": 0.6, "exp2": 0.7}


def test_absent_columns(spark, data, fitted):
    with pytest.raises(ValueError, match="lacks the feature columns"):
        fitted.transform(data.drop(fitted.specs[0].name))
    with pytest.raises(ValueError, match="lacks the feature columns"):
        fitted.transform(plan.prepare(data, fitted.specs, fitted.labels).drop(fitted.specs[0].name), prepared=True)
    label = fitted.labels[0].name
    assert label not in fitted.transform(data.drop(label)).columns


def test_shared_vocabulary_keeps_own_ids(spark):
    df = spark.createDataFrame([("3", "5"), ("5", "9"), ("7", "11")], "a string, b string")
    spec = [{"name": "a", "type": "categorical", "dtype": "str", "remap": False}, {"name": "b", "type": "categorical", "dtype": "str", "remap": False, "share_embedding": "a"}]
    assert ids(plan.fit(df, spec, []).vocab) == {"3": 3, "5": 5, "7": 7, "9": 9, "11": 11, "__PAD__": 0, "__OOV__": 12}


def test_encoder_refuses_function_normalizers_before_writing(spark, tmp_path):
    from adloom.session import path_exists

    df = spark.createDataFrame([(1.0,)], "x double")
    fitted = plan.fit(df, [{"name": "x", "type": "numeric", "dtype": "float", "normalizer": lambda c: c * 2}], [])
    with pytest.raises(ValueError, match="function normalizers"):
        fitted.save(str(tmp_path / "enc"))
    assert not path_exists(spark, str(tmp_path / "enc"))


def test_interrupted_build_is_replaced(spark, data, tmp_path):
    from adloom.plans import dataset

    path = str(tmp_path / "set")
    spec, label = [{"name": "v", "type": "numeric", "dtype": "float", "fill_na": 0}], {"name": "y", "dtype": "float"}
    rows = spark.createDataFrame([(i, float(i), i % 2) for i in range(20)], "id long, v double, y int")
    rows.limit(3).write.parquet(f"{path}/data/split=train")  # left by a run that broke off before its encoder was stored
    dataset.build_dataset(rows, spec, label, path, "d", ["id"], valid_size=0.2, test_size=0.2)
    assert dataset.open_dataset(spark, path, "d")[1].count() == 20


def test_broadcast_is_measured(spark, monkeypatch):
    from adloom.operators import joins

    wide = spark.range(100).select("id", F.array_repeat(F.lit(0.5), 1000).alias("v"))
    assert joins.fits_broadcast(wide)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 500_000)
    assert not joins.fits_broadcast(wide) and joins.fits_broadcast(wide.select("id"))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 99)
    assert not joins.fits_broadcast(wide.select("id"))


def test_clip_keeps_missing_values(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (-1.0,), (2.0,)], "x double")
    out = [r[0] for r in df.select(scalars.clip("x", 0.0, 1.0)).collect()]
    assert out[0] is None and out[1] != out[1] and out[2:] == [0.0, 1.0]


def test_vectorised_function_inside_arrays(spark):
    import numpy as np
    import pandas as pd

    from adloom.functions.vectorized import vectorized
    from adloom.operators import encode

    rows = spark.createDataFrame([(1, "1,2,3,4"), (2, ""), (3, None), (4, "7")], "i int, s string").repartition(2)
    seen = vectorized(lambda x: pd.Series(np.log1p(x)))
    got = {r.i: r.v for r in rows.select("i", encode.encode_float_sequence("s", ",", 3, seen).alias("v")).collect()}
    assert got[1] == pytest.approx([np.log(3), np.log(4), np.log(5)])
    assert got[4][:2] == [-1.0, -1.0] and got[4][2] == pytest.approx(np.log(8))
    plain = {r.i: r.v for r in rows.select("i", encode.encode_float_sequence("s", ",", 3, F.log1p).alias("v")).collect()}
    assert [got[i] for i in (2, 3)] == [plain[i] for i in (2, 3)]
    arrays = spark.createDataFrame([([1.0, None],), ([],), (None,)], "a array<double>").select(vectorized(lambda x: x + 1).elements(F.col("a")).alias("a"))
    assert [r.a for r in arrays.collect()] == [[2.0, None], [], None]
