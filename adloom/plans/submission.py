"""From predictions to a checked submission table."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.operators.profile import equal_width_histogram, prediction_summary
from adloom.sources.writers import write_csv


def positive_class(probability: str) -> Column:
    """Second element of a two-class probability vector."""
    return vector_to_array(F.col(probability))[1]


def attach_matched(sample: DataFrame, scores: DataFrame, key: str, score: str, out: str = "clicked") -> DataFrame:
    """Rows of ``sample`` that have a prediction."""
    return sample.select(key).join(scores.select(key, F.col(score).alias(out)), key, "inner")


def attach_filled(sample: DataFrame, scores: DataFrame, key: str, score: str, out: str = "clicked") -> DataFrame:
    """All rows of ``sample``; missing predictions get the mean prediction."""
    mean = scores.agg(F.avg(F.col(score).cast("double"))).scalar()
    joined = sample.select(key).join(scores.select(key, F.col(score).alias("_s")), key, "left")
    return joined.select(key, F.coalesce("_s", mean).alias(out))


def match_report(sample: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """How many keys are on both sides, and on one side only."""
    both = sample.select(key, F.lit(1).alias("_a")).join(scores.select(key, F.lit(1).alias("_b")), key, "full")
    return both.agg(
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("matched"),
        F.count_if(F.col("_b").isNull()).alias("without_prediction"),
        F.count_if(F.col("_a").isNull()).alias("unused_predictions"),
    )


def validate(df: DataFrame, key: str = "ID", score: str = "clicked") -> DataFrame:
    """One row per check: (check, passed, detail)."""
    missing = [c for c in (key, score) if c not in df.columns]
    if missing:
        return df.sparkSession.range(1).select(
            F.lit("columns").alias("check"), F.lit(0).alias("passed"), F.lit(f"missing {missing}").alias("detail")
        )
    agg = df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(score).isNull() | F.col(key).isNull()).alias("nulls"),
        F.count_if((F.col(score) < 0) | (F.col(score) > 1)).alias("outside"),
    )

    def check(name: str, ok: Column, detail: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), F.when(ok, 1).otherwise(0).alias("passed"), detail.cast("string").alias("detail"))

    checks = F.array(
        check("columns", F.lit(True), F.lit(f"{key},{score}")),
        check("rows", F.col("n") > 0, F.col("n")),
        check("nulls", F.col("nulls") == 0, F.col("nulls")),
        check("range", F.col("outside") == 0, F.col("outside")),
    )
    return agg.select(F.explode(checks).alias("c")).select("c.*")


def submit(df: DataFrame, path: str, key: str = "ID", score: str = "clicked") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Validate, write as CSV, and return the check, summary and histogram tables.

    A failed check stops the write.
    """
    report = validate(df, key, score)
    failed = [r["check"] for r in report.where("passed = 0").collect()]
    if failed:
        raise ValueError(f"submission failed checks: {failed}")
    write_csv(df.select(key, score), path)
    return report, prediction_summary(df, score), equal_width_histogram(df, score)
