"""The pipeline: each stage's decisions against brute force on its own input, and columns of any name."""

from pyspark.sql import functions as F

import corpus_pipeline
from adloom.llm import decontaminate
from tests.conftest import SF as SMALL

SF = SMALL.replace("0.001", "0.01")


def test_stages_in_order(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.withColumns({c: F.lit(c) for c in ("score", "predicted", "regions", "hash", "_row", "_id", "Text2")})
    benchmark = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, SF)
        if name != "bpe":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs_out = spark.read.parquet(str(tmp_path / name))
        rows = docs_out.collect()
        kept = {r.doc_id for r in rows}
        assert len(kept) == len(rows) and kept <= set(before)
        gone = set(before) - kept
        if name == "toxicity":
            assert len(gone & toxic) > 0.6 * len(toxic) and len(gone - toxic) < 0.1 * len(before)
        elif name == "near_duplicates":
            sets = {k: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for k, t in before.items() for w in [t.lower().split()]}
            like = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8
            assert not [(a, b) for a in kept for b in kept if a < b and like(a, b)]
            # Whatever goes hangs together, by links, with a smaller id that stays.
            root = {k: k for k in before}
            for a in before:
                for b in before:
                    if a < b and like(a, b):
                        x, y = root[a], root[b]
                        root = {k: min(x, y) if r in (x, y) else r for k, r in root.items()}
            assert kept == {k for k in before if root[k] == k}
        elif name == "decontamination":
            folded = {k: decontaminate.fold(t)[0] for k, t in before.items()}
            held = {k for k, t in folded.items() if any(decontaminate.fold(b)[0] in t for b in benchmark)}
            assert held and gone == held
        elif name == "privacy":
            assert not gone and all("@mail" not in r.text for r in rows)
            assert any("[EMAIL]" in r.text for r in rows)
        else:
            assert not gone and all(r.n_tokens == len(r.ids) for r in rows)
        docs = docs_out
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_on_empty_and_null_rows(spark, tmp_path):
    for n in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{n}.parquet").write.parquet(f"{tmp_path}/{n}.parquet")
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "no id", None, "s", 5), (None, None, None, None, None), (3, "a b c", "en", "s", 5)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    out = sorted((r.doc_id or 0, r.n_tokens) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert out == [(0, 0), (0, 2), (1, 0), (3, 3)]
