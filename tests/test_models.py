"""Models on spark.ml."""

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from adloom.operators.metrics import evaluate
from adloom.plans import models


def test_rows_are_scored_once(spark, monkeypatch):
    """The metrics read stored scores, and only the columns they need."""

    class Half:
        def transform(self, df):
            return df.withColumn("probability", array_to_vector(F.array(1 - F.col("x"), F.col("x"))))

    seen = []
    monkeypatch.setattr(models, "evaluate", lambda df, *rest: seen.append(df) or evaluate(df, *rest))
    rows = spark.range(40).select("id", (F.col("id") % 2).alias("y"), (F.col("id") % 4 / 4).alias("x"), (F.col("id") % 3).alias("g"), F.lit("wide").alias("w"))
    got = {r["metric"]: r["value"] for r in models.evaluate_model(Half(), rows, ["AUC", "MRR"], "y", "g", "id").collect()}
    assert got["AUC"] == 0.75 and 0 < got["MRR"] <= 1
    assert seen[0].columns == ["y", "g", "id", "score"] and seen[0].inputFiles()


def test_fit_rows_are_dealt_evenly(spark, monkeypatch):
    """A table in two parts, one of them large, is fitted by all cores alike."""
    sizes = []

    class Spy(Estimator):
        def __init__(self, **params):
            super().__init__()

        def _fit(self, dataset):
            sizes.extend(r["count"] for r in dataset.groupBy(F.spark_partition_id()).count().collect())
            return PipelineModel([])

    monkeypatch.setitem(models.ESTIMATORS, "spy", Spy)
    rows = spark.range(0, 900, 1, 1).union(spark.range(900, 910, 1, 1)).select((F.col("id") * 0.5).alias("x"), (F.col("id") % 2).alias("y"))
    models.fit_model(rows, "spy", [], ["x"], "y")
    assert sum(sizes) == 910 and len(sizes) >= 8 and max(sizes) < 2 * 910 / 8
