"""From a raw table to encoded train / valid / test tables in one call."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.operators.profile import union_all
from adloom.operators.sampling import random_split, sequential_split
from adloom.plans.encoder import FittedEncoder, fit, load
from adloom.session import path_exists, remove_path
from adloom.sources.writers import write_encoded
from adloom.spec import FeatureSpec


def build_dataset(
    train: DataFrame,
    feature_cols: Sequence[Mapping[str, Any] | FeatureSpec],
    label_col: Mapping[str, Any] | Sequence[Mapping[str, Any]],
    path: str,
    dataset_id: str,
    order: Sequence[str],
    valid: DataFrame | None = None,
    test: DataFrame | None = None,
    valid_size: float = 0,
    test_size: float = 0,
    split_type: str = "sequential",
    keep: Sequence[str] = (),
    max_records: int | None = None,
    **fit_options: Any,
) -> FittedEncoder:
    """Split, fit on the training part, and write ``path/data`` (one folder per split) and ``path/encoder``.

    With sizes, valid and test are cut from ``train`` (sequentially in ``order``, or at random by its
    first column); without, the given tables are used. An existing data set is loaded, not rebuilt.
    """
    spark = train.sparkSession
    if path_exists(spark, f"{path}/encoder/state/_SUCCESS"):
        return load(spark, f"{path}/encoder", dataset_id)
    if split_type not in ("sequential", "random"):
        raise ValueError(f"split_type {split_type!r} is not supported")
    if valid_size or test_size:
        if split_type == "sequential":
            rows = sequential_split(train, order, valid_size, test_size)
        else:
            rows = random_split(train, order[0], valid_size, test_size)
    else:
        parts = [("train", train), ("valid", valid), ("test", test)]
        rows = union_all([df.withColumn("split", F.lit(name)) for name, df in parts if df is not None])
    fitted = fit(rows.where(F.col("split") == "train"), feature_cols, label_col, dataset_id, **fit_options)
    encoded = fitted.transform(rows, keep=[*keep, "split"], id_col=order[0] if len(order) == 1 else None)
    # The encoder's state is stored last: data without it come from a run that broke off, and are replaced.
    remove_path(spark, f"{path}/data")
    write_encoded(encoded, f"{path}/data", split="split", max_records=max_records)
    fitted.save(f"{path}/encoder")
    return fitted


def open_dataset(spark: SparkSession, path: str, dataset_id: str) -> tuple[FittedEncoder, DataFrame]:
    """A built data set: its encoder and its encoded rows."""
    return load(spark, f"{path}/encoder", dataset_id), spark.read.parquet(f"{path}/data")
