"""User functions over whole columns, moved in Arrow batches."""

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


class Vectorized:
    """A pandas/NumPy function as a function of columns, and of the elements of array columns."""

    def __init__(self, fn: Callable[[pd.Series], pd.Series], return_type: str) -> None:
        @F.pandas_udf(return_type)
        def run(x: pd.Series) -> pd.Series:
            return fn(x)

        @F.arrow_udf(f"array<{return_type}>")
        def inside(x: pa.Array) -> pa.Array:
            # One call for all elements of the batch; the lists keep their lengths.
            values = x.flatten().to_pandas()
            done = pa.array(np.asarray(fn(values)) if len(values) else [], from_pandas=True)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False))
            offsets = pa.array(np.r_[0, ends].astype(np.int32))
            return pa.ListArray.from_arrays(offsets, done, mask=x.is_null())

        self._run, self._inside = run, inside

    def __call__(self, column: Column) -> Column:
        return self._run(column)

    def elements(self, column: Column) -> Column:
        """The function over every element of an array column; null arrays stay null, null elements reach it as NaN."""
        return self._inside(column)


def vectorized(fn: Callable[[pd.Series], pd.Series], return_type: str = "double") -> Vectorized:
    """Turn a pandas/NumPy function into a Column function, e.g. as a spec's ``normalizer``, also of float sequences."""
    return Vectorized(fn, return_type)
