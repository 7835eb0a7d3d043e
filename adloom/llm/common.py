"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

# Text handled at once inside a task; a single longer text forms a slice of its own.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def remainder(doc_id: Column | str, parts: int) -> Column:
    """crc32 of an id written as text, modulo ``parts``; null ids count as the empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % parts


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts together stay below ``limit`` bytes."""
    sizes = pc.binary_length(batch.column(column)).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + (n or 0) > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n or 0
    if len(sizes) > start:
        yield batch.slice(start)


def map_text(df: DataFrame, column: str, fn: Callable[[pa.RecordBatch], dict], schema: str | StructType) -> DataFrame:
    """Run ``fn`` over slices of rows; it returns a dict of equally long columns named as in ``schema``."""
    spark_schema = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                out = fn(part)
                arrays = [pa.array(out[f.name], type=f.type, from_pandas=False) for f in arrow]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, spark_schema)


def extended(df: DataFrame, columns: list[str], added: str) -> StructType:
    """The fields of some columns, followed by those that ``added`` declares."""
    return StructType([df.schema[c] for c in columns] + _parse_datatype_string(added).fields)


def forget_others(own: str) -> None:
    """Drop what operators other than ``own`` (a module's name) keep between batches: the stages of a pipeline share workers."""
    for name, module in list(sys.modules.items()):
        if name.startswith("adloom.llm.") and name != own:
            for value in list(vars(module).values()):
                clear = getattr(value, "cache_clear", None)
                if callable(clear):
                    clear()
