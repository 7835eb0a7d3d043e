"""Model fit and batch scoring on ``spark.ml``, and the no-model baselines."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import FMClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.functions.scalars import hash_probability
from adloom.operators.joins import cut_join, fits_broadcast
from adloom.operators.metrics import curve_metrics, evaluate
from adloom.plans.submission import positive_class
from adloom.session import materialize

ESTIMATORS: dict[str, Callable[..., Estimator]] = {
    "logistic": LogisticRegression, "fm": FMClassifier, "mlp": MultilayerPerceptronClassifier,
}


class ExactAuc(Evaluator):
    """Model-selection criterion: the exact AUC of the positive-class probability."""

    def __init__(self, label: str) -> None:
        super().__init__()
        self.label = label

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = dataset.select(self.label, positive_class("probability").alias("_p"))
        return curve_metrics(scored, self.label, "_p").first()["auc"]

    def isLargerBetter(self) -> bool:
        return True


def feature_stages(categorical: Sequence[str], numeric: Sequence[str]) -> list[Estimator | Any]:
    """One-hot ids and numeric columns in one vector."""
    hot = [f"{c}__hot" for c in categorical]
    stages: list[Any] = []
    if categorical:
        stages.append(OneHotEncoder(inputCols=list(categorical), outputCols=hot, dropLast=False, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=[*hot, *numeric], outputCol="features"))
    return stages


def fit_model(df: DataFrame, kind: str, categorical: Sequence[str], numeric: Sequence[str], label: str, **params: Any) -> PipelineModel:
    """Fit on encoded columns. For 'mlp', ``hidden`` lists the inner layer widths."""
    stages = feature_stages(categorical, numeric)
    # Every iteration is as long as its largest part: the rows are dealt out evenly, over all cores at least.
    parts = max(df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism)
    inputs = [c for c in dict.fromkeys([*categorical, *numeric]) if c != label]
    data = df.select(*inputs, F.col(label).cast("double").alias(label)).repartition(parts)
    if kind == "mlp":
        front = Pipeline(stages=stages).fit(data)
        width = front.transform(data).select("features").first()[0].size
        layers = [width, *params.pop("hidden", [8]), 2]
        head = MultilayerPerceptronClassifier(featuresCol="features", labelCol=label, layers=layers, **params).fit(front.transform(data))
        return PipelineModel([*front.stages, head])
    head = ESTIMATORS[kind](featuresCol="features", labelCol=label, **params)
    return Pipeline(stages=[*stages, head]).fit(data)


def score(model: Model, df: DataFrame, out: str = "score") -> DataFrame:
    """Positive-class probability for every row."""
    return model.transform(df).withColumn(out, positive_class("probability")).drop("features", "rawPrediction", "probability", "prediction")


def score_external(df: DataFrame, predict: Callable[[pd.DataFrame], pd.Series], columns: Sequence[str], keep: Sequence[str], out: str = "score") -> DataFrame:
    """Score with the user's own vectorised function, one Arrow batch at a time."""
    narrow = df.select(*keep, *[c for c in columns if c not in keep])
    schema = ", ".join([*[f"`{c}` {t}" for c, t in narrow.select(*keep).dtypes], f"`{out}` double"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            res = b[list(keep)].copy()
            res[out] = predict(b[list(columns)]).astype(float).values
            yield res

    return narrow.mapInPandas(run, schema)


def evaluate_model(model: Model, df: DataFrame, metrics: Sequence[str], label: str, group: str | None = None, tie: str | None = None) -> DataFrame:
    # The metrics take many passes: score the rows once and keep what the metrics read.
    names = dict.fromkeys(c for c in (label, group, tie) if c is not None)
    scored = materialize(score(model, df).select(*names, "score"), "scored")
    return evaluate(scored, metrics, label, "score", group, tie)


def grid_search(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str, grid: Mapping[str, Sequence[Any]], train_ratio: float = 0.8, seed: int = 42, parallelism: int = 2) -> TrainValidationSplitModel:
    """Every combination of ``grid`` (logistic-regression parameters), compared on a held-out part."""
    lr = LogisticRegression(featuresCol="features", labelCol=label)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(lr.getParam(name), list(values))
    search = TrainValidationSplit(
        estimator=Pipeline(stages=[*feature_stages(categorical, numeric), lr]), estimatorParamMaps=builder.build(),
        evaluator=ExactAuc(label),
        trainRatio=train_ratio, seed=seed, parallelism=parallelism,
    )
    return search.fit(df.withColumn(label, F.col(label).cast("double")))


def grid_table(result: TrainValidationSplitModel, df: DataFrame) -> DataFrame:
    """(params, metric) per combination."""
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda x: x[0].name)), float(v))
        for m, v in zip(result.getEstimatorParamMaps(), result.validationMetrics)
    ]
    return df.sparkSession.createDataFrame(rows, "params string, metric double")


def constant_baseline(df: DataFrame, key: str, rate: float, out: str = "clicked") -> DataFrame:
    return df.select(key, F.lit(float(rate)).alias(out))


def hashed_baseline(df: DataFrame, key: str, out: str = "clicked") -> DataFrame:
    return df.select(key, hash_probability(key).alias(out))


def category_rate_baseline(train: DataFrame, df: DataFrame, key: str, category: str, label: str, prior_rows: float = 20.0, out: str = "clicked") -> DataFrame:
    """Smoothed click rate of the row's category: (clicks + prior · rate) / (rows + prior)."""
    overall = train.agg(F.avg(F.col(label).cast("double"))).scalar()
    rates = train.groupBy(category).agg(F.sum(F.col(label).cast("double")).alias("_c"), F.count(F.lit(1)).alias("_n"))
    rates = materialize(rates, "rates")
    narrow = df.select(key, category)
    joined = narrow.join(F.broadcast(rates), category, "left") if fits_broadcast(rates) else cut_join(narrow, rates, [category])
    smoothed = (F.coalesce("_c", F.lit(0.0)) + overall * prior_rows) / (F.coalesce("_n", F.lit(0)) + prior_rows)
    return joined.select(key, smoothed.alias(out))
