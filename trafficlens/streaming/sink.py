"""A Parquet table that a stream can write twice without harm.

Every micro-batch (epoch) has a folder of its own, ``run=<r>/epoch=<n>``; the run
is named after the stream's checkpoint location, so a restarted stream goes on
where it stopped and a stream with a new checkpoint adds to the table. When the
folder is complete the epoch is entered in a manifest (a table beside the data,
one row per epoch). Readers take the epochs of the manifest only:

* a batch that fails halfway leaves a folder that nobody reads; its replay
  overwrites it;
* a batch replayed after it was entered is left out.

``read_table`` gives all committed rows (append), ``read_last`` those of the last
epoch of each run (complete), ``read_latest`` the newest row of each key (update).
A table without a committed epoch needs the ``schema`` and is empty."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

RUN, EPOCH = "run", "epoch"


def run_name(checkpoint: str) -> str:
    return "r" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:20]


def manifest_path(path: str) -> str:
    return path.rstrip("/") + "-manifest"


def committed(spark: SparkSession, path: str) -> DataFrame:
    """(run, epoch, rows) of the committed epochs."""
    try:
        return spark.read.schema("run string, epoch long, rows long").parquet(manifest_path(path) + "/*/*")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "run string, epoch long, rows long")


def write_epoch(batch: DataFrame, path: str, run: str, epoch: int) -> bool:
    """Write and commit one micro-batch; False if it was committed before."""
    spark = batch.sparkSession
    if not committed(spark, path).where((F.col("run") == run) & (F.col("epoch") == epoch)).isEmpty():
        return False
    folder = f"{path.rstrip('/')}/{RUN}={run}/{EPOCH}={epoch}"
    batch.write.mode("overwrite").parquet(folder)
    rows = spark.read.schema(batch.schema).parquet(folder).groupBy().agg(F.count(F.lit(1)).alias("rows"))
    (rows.select(F.lit(run).alias("run"), F.lit(epoch).cast("long").alias("epoch"), "rows")
     .write.mode("overwrite").parquet(f"{manifest_path(path)}/{run}/{epoch}"))
    return True


def _rows(spark: SparkSession, path: str, schema: T.StructType | str | None, epochs: DataFrame) -> DataFrame:
    """The rows of these epochs with run and epoch."""
    if epochs.isEmpty():
        if schema is None:
            raise ValueError(f"{path} has no committed epoch: give its schema")
        return spark.createDataFrame([], schema).withColumns({RUN: F.lit(None).cast("string"), EPOCH: F.lit(None).cast("long")})
    reader = spark.read if schema is None else spark.read.schema(
        T.StructType([*(T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields,
                      T.StructField(RUN, T.StringType()), T.StructField(EPOCH, T.LongType())]))
    rows = reader.parquet(path).withColumn(EPOCH, F.col(EPOCH).cast("long"))
    return rows.join(epochs.select(RUN, EPOCH), [RUN, EPOCH], "left_semi")


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    return _rows(spark, path, schema, committed(spark, path)).drop(RUN, EPOCH)


def read_last(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    last = committed(spark, path).groupBy(RUN).agg(F.max(EPOCH).alias(EPOCH))
    return _rows(spark, path, schema, last).drop(RUN, EPOCH)


def read_latest(spark: SparkSession, path: str, keys: list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """One row per run and key: that of the highest epoch. A key has at most one row an
    epoch, so no group is larger than the number of epochs that touched it."""
    rows = _rows(spark, path, schema, committed(spark, path))
    newest = Window.partitionBy(RUN, *keys).orderBy(F.desc(EPOCH))
    return rows.withColumn("_tl_nth", F.row_number().over(newest)).where("_tl_nth = 1").drop("_tl_nth", RUN, EPOCH)
