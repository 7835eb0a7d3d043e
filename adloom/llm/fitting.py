"""Bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Longest text, in characters, that a fitting sample takes; scoring has no such limit.
FIT_CHARS = 100_000


def usable_text(text: str) -> Column:
    """Rows whose text can be learned from."""
    return (F.length(text) > 0) & (F.length(text) <= FIT_CHARS)


def label_sample(df: DataFrame, key: str, label: str, per_label: int, max_labels: int) -> DataFrame:
    """About ``per_label`` rows of each label, chosen by a hash of ``key``, so that the choice ignores partitioning.

    Rows of one key are drawn together; rows without a label take no part. More than ``max_labels`` labels are an error,
    because the fitted tables grow with their number.
    """
    labelled = df.where(F.col(label).isNotNull())
    sizes = {r[0]: r[1] for r in labelled.groupBy(label).count().limit(max_labels + 1).collect()}
    if len(sizes) > max_labels:
        raise ValueError(f"more than {max_labels} distinct values of {label!r}")
    if not sizes:
        return labelled.limit(0)
    share = F.create_map(*[F.lit(x) for k, n in sorted(sizes.items()) for x in (k, min(1.0, per_label / n))])
    unit = F.pmod(F.xxhash64(key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return labelled.where(unit < share[F.col(label)])
