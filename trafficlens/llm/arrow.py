"""Small helpers for operators that run over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

SLICE_BYTES = 8 << 20
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Texts go to the workers in batches of ``BATCH_BYTES`` (Spark's own limit, 64 MB,
    counts several times a task: twice in the executor, twice in its worker). A limit
    that the cluster sets stays."""
    if not spark.sparkContext.getConf().contains(BATCH_KEY):
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


def slices(batches: Iterator[pa.RecordBatch], column: str | int = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about ``limit`` bytes of ``column``
    (one row where it alone is longer), to bound what a task holds at once."""
    from .textbatch import blocks, buffers

    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = buffers(batch.column(column))
        for a, b in blocks(offsets, limit):
            yield batch.slice(a, b - a)
