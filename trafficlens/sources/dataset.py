"""Parquet packet tables: sink, folder scans, multi-folder union, a
normaliser for foreign parquet with drifting column types, file inventory
and the Spark event-log reader."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..schema import PACKET_SCHEMA
from .framing import open_file

PARTITION_COLUMN = "class_name"
KEY_FIELDS = [T.StructField("path", T.StringType()), T.StructField("ordinal", T.LongType())]


def write_packets(packets: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per class (``class_name=<name>``), explicit column types so
    no file carries a per-file inferred type. The row key (path, ordinal) is kept
    where the table has one."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in [*PACKET_SCHEMA.fields, *KEY_FIELDS] if f.name in packets.columns]
    packets.select(*cols, PARTITION_COLUMN).write.mode(mode).partitionBy(PARTITION_COLUMN).parquet(path)


def read_packets(spark: SparkSession, path: str, classes: list[str] | None = None) -> DataFrame:
    """One scan over the class-partitioned table; a class list becomes
    partition pruning (only those folders are listed and read)."""
    written = spark.read.parquet(path).columns
    schema = T.StructType([*PACKET_SCHEMA.fields, *(f for f in KEY_FIELDS if f.name in written),
                           T.StructField(PARTITION_COLUMN, T.StringType())])
    df = spark.read.schema(schema).parquet(path)
    if classes is not None:
        df = df.where(F.col(PARTITION_COLUMN).isin(*classes))
    return df


def read_class_folders(spark: SparkSession, folders: list[str]) -> DataFrame:
    """The original layout (one folder of parquet files per class, no
    partition column): a single multi-path scan under the fixed schema."""
    return spark.read.schema(PACKET_SCHEMA).parquet(*folders)


def union_all(frames: list[DataFrame], by_name: bool = True) -> DataFrame:
    """UNION ALL of many frames (by name by default, by position if asked)."""
    if by_name:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return reduce(lambda a, b: a.union(b), frames)


def _row_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, row_group) of every row group, from the footers."""
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with open_file(path)[0] as f:
                n = pq.ParquetFile(f).metadata.num_row_groups
            yield pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array(range(n), pa.int32())], names=["path", "row_group"])


def _typed(column: pa.Array, kind: pa.DataType) -> pa.Array:
    """The column as ``kind``: fractions are cut, NaN is null, what doesn't fit is an error."""
    if pa.types.is_floating(column.type) and pa.types.is_integer(kind):
        column = pc.trunc(pc.if_else(pc.is_nan(column), pa.scalar(None, column.type), column))
    return pc.cast(column, kind)


def normalise_foreign(spark: SparkSession, root: str, schema: T.StructType = PACKET_SCHEMA) -> DataFrame:
    """Read parquet files whose column types drift between files (an integer
    column written as int64 in one file and double-with-nulls in another,
    as pandas does). Spark cannot read such a folder in one scan, so tasks read
    the footers, row groups are dealt to tasks, and each is read there (the columns
    of ``schema`` only) and cast. No path passes the driver. Columns that a file
    lacks are null, others are ignored; a folder without files gives no rows."""
    fields = list(to_arrow_schema(schema))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, group in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_file(path)[0] as f:
                    file = pq.ParquetFile(f)
                    there = [x.name for x in fields if x.name in file.schema_arrow.names]
                    for rows in file.iter_batches(row_groups=[group], columns=there):
                        yield pa.RecordBatch.from_arrays([
                            _typed(rows.column(x.name), x.type) if x.name in there else pa.nulls(rows.num_rows, x.type)
                            for x in fields], names=[x.name for x in fields])

    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
               .option("pathGlobFilter", "*.parquet").load(root).select("path"))
    groups = listing.repartition("path").mapInArrow(_row_groups, "path string, row_group int")
    return groups.repartition("path", "row_group").mapInArrow(read, schema)


def directory_inventory(spark: SparkSession, root: str, folders: DataFrame | None = None) -> DataFrame:
    """``(dir, n)``: files directly inside each sub-folder. Only the listing
    is read (``ReadSchema`` is the path), counted by a partial aggregate.
    With a ``folders`` frame (column ``dir``), empty folders appear with 0."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("dir")))
    counts = files.groupBy("dir").agg(F.count(F.lit(1)).alias("n"))
    if folders is not None:
        counts = folders.select("dir").join(counts, "dir", "left") \
            .select("dir", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    return counts


# Only the fields used: an explicit schema skips inference over every line
# (event kinds disagree, e.g. "timestamp" vs "Timestamp").
EVENT_LOG_SCHEMA = T.StructType([
    T.StructField("Event", T.StringType()),
    T.StructField("Task Info", T.StructType([
        T.StructField("Executor ID", T.StringType()),
        T.StructField("Launch Time", T.LongType()),
        T.StructField("Finish Time", T.LongType()),
        T.StructField("Failed", T.BooleanType()),
    ])),
    T.StructField("Task Metrics", T.StructType([
        T.StructField("Executor Run Time", T.LongType()),
        T.StructField("JVM GC Time", T.LongType()),
    ])),
])


def event_log_report(spark: SparkSession, log_dir: str) -> DataFrame:
    """Per executor, from Spark's JSON event log: tasks, failed tasks, total
    run time, GC time and task wall time (ms)."""
    ev = spark.read.schema(EVENT_LOG_SCHEMA).json(log_dir)
    t = ev.where(F.col("Event") == "SparkListenerTaskEnd")
    info, m = F.col("`Task Info`"), F.col("`Task Metrics`")
    return t.groupBy(info.getField("Executor ID").alias("executor_id")).agg(
        F.count(F.lit(1)).alias("tasks"),
        F.count_if(info.getField("Failed")).alias("failed"),
        F.sum(m.getField("Executor Run Time")).cast("bigint").alias("run_ms"),
        F.sum(m.getField("JVM GC Time")).cast("bigint").alias("gc_ms"),
        F.sum(info.getField("Finish Time") - info.getField("Launch Time")).cast("bigint").alias("wall_ms"),
    )
