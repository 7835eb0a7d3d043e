"""The training-data pipeline: each stage reads what the one before it stored.

Extra columns of the documents pass through all stages but the last, whatever their names: stages work under names of their own.
Null and empty texts pass all filters and have no tokens; repeated rows are copies of each other, so one of them stays; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm import bpe, decontaminate, ngram_join, privacy, toxicity
from adloom.llm.common import table
from adloom.llm.queries import tokenizer_path
from adloom.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _renamed(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run ``work`` with ``doc_id`` and ``text`` under their names and all other columns under safe ones."""
    inner = [c if c in ("doc_id", "text") else f"_column{i}" for i, c in enumerate(docs.columns)]
    return work(docs.toDF(*inner)).select(*inner).toDF(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents scored as toxic go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _renamed(docs, lambda d: toxicity.score(d, model, keep_text=True).where("predicted = 0"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: one document of each group of near-duplicates stays."""
    return _renamed(docs, ngram_join.keep_one)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that hold a benchmark item go."""
    benchmark = table(spark, sf_dir, "benchmark")
    return _renamed(docs, lambda d: decontaminate.search(d, benchmark, keep_text=True).where(F.size("regions") == 0))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: personal data and the words that disclose it give way to marks."""
    return _renamed(docs, privacy.sanitise)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: token ids of what was kept, with a digest of the decoded text."""
    coded = bpe.digest(docs, tokenizer_path("word_bpe_49k.json"), ids=True)
    return coded.select("doc_id", "n_tokens", "ids", "decoded_sha256")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("privacy", sanitise),
    ("bpe", tokenise),
]

# Segment scores, MinHash values, alignments and merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
