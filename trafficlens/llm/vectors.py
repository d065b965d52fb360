"""What the operators on vectors share: which rows count, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column, bound: float) -> Column:
    """The vector is there, has an entry, and every entry is a number of less
    than ``bound`` in size."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) < bound), F.lit(False))), F.lit(False))


def usual_length(rows: DataFrame, vector: str) -> int | None:
    """The most frequent length (of equally frequent ones the longest); None
    without rows."""
    lengths = rows.groupBy(F.size(vector).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    return top[0]["size"] if top else None


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column without nulls whose lists all have ``width`` entries."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def lists(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel()))
