"""Folder trees listed on executors.

A frontier of folders is listed level by level: each folder is one row, tasks list
their folders and return entries, and the folders among them are the next
frontier. Every level is written to the shared checkpoint folder, so a lost
executor repeats its own folders only, and the driver sees one count per level,
never a path. One folder's entries are made in batches, so a folder of millions of
files is bounded in memory (its listing itself is one call of its file system).

Names that begin with "_" or "." are hidden and skipped, as Spark's own scans do.
Links to folders are followed; a link to a folder above itself is an error once the
tree is ``MOST_LEVELS`` deep. A root that isn't there is an error."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .framing import local_path

MOST_LEVELS = 256
ENTRIES_AT_ONCE = 10_000
FOLDERS_PER_TASK = 256

_ENTRY = "dir string, path string, is_dir boolean, length long"


def _entries(folder: str) -> Iterator[tuple[str, bool, int | None]]:
    """(path, is_dir, length) of what is directly inside a folder."""
    here = local_path(folder)
    if here is not None:
        with os.scandir(here) as found:
            for x in found:
                inside = x.is_dir()
                yield f"{folder}/{x.name}", inside, None if inside else x.stat().st_size
        return
    from pyarrow import fs

    filesystem, inner = fs.FileSystem.from_uri(folder)
    for x in filesystem.get_file_info(fs.FileSelector(inner)):
        inside = x.type == fs.FileType.Directory
        yield f"{folder}/{x.base_name}", inside, None if inside else x.size


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows):
        columns = zip(*rows) if rows else ([], [], [], [])
        kinds = (pa.string(), pa.string(), pa.bool_(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                          names=["dir", "path", "is_dir", "length"])

    for batch in batches:
        held = []
        for folder in batch.column(0).to_pylist():
            for path, inside, length in _entries(folder):
                if path.rsplit("/", 1)[1][0] not in "_.":
                    held.append((folder, path, inside, length))
                if len(held) >= ENTRIES_AT_ONCE:
                    yield batch_of(held)
                    held = []
        yield batch_of(held)


def list_tree(spark: SparkSession, root: str) -> DataFrame:
    """Everything below ``root``: (dir, path, is_dir, length); ``length`` is null for
    folders. Paths begin with ``root`` as it was given (local ones with "file:")."""
    root = root.rstrip("/") or "/"
    if local_path(root) is not None:
        root = "file:" + os.path.abspath(local_path(root))
    width = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    frontier, n, levels = spark.createDataFrame([(root,)], "path string"), 1, []
    while n:
        if len(levels) == MOST_LEVELS:
            raise ValueError(f"more than {MOST_LEVELS} levels of folders under {root}")
        path = scratch_path(spark, "level")
        tasks = min(n, max(width, -(-n // FOLDERS_PER_TASK)))
        frontier.repartition(tasks, "path").mapInArrow(_listed, _ENTRY).write.parquet(path)
        levels.append(spark.read.schema(_ENTRY).parquet(path))
        frontier = levels[-1].where("is_dir").select("path")
        n = frontier.count()
    return reduce(DataFrame.union, levels)


def folder_counts(spark: SparkSession, root: str) -> DataFrame:
    """(dir, n, n_below, bytes_below) of every folder under ``root``, the root too: the
    files directly inside, and files and bytes in the whole tree below. Folders
    without files have 0. A file counts once for each folder above it: rows grow with
    files times depth and are summed before the shuffle."""
    tree = list_tree(spark, root).checkpoint()
    base = root.rstrip("/")
    base = "file:" + os.path.abspath(local_path(base)) if local_path(base) is not None else base
    files = tree.where(~F.col("is_dir")).groupBy("dir").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"))
    below = F.split(F.substr("dir", F.lit(len(base) + 2)), "/")
    parts = F.filter(below, lambda x: x != "")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.concat(F.array(F.lit(base)), F.slice(parts, F.lit(1), k)), "/"))
    rows = files.select(F.explode(above).alias("up"), "dir", "n", "bytes")
    totals = rows.groupBy(F.col("up").alias("dir")).agg(
        F.sum(F.when(F.col("up") == F.col("dir"), F.col("n")).otherwise(0)).alias("n"),
        F.sum("n").alias("n_below"), F.sum("bytes").alias("bytes_below"))
    folders = tree.where("is_dir").select(F.col("path").alias("dir")).union(spark.createDataFrame([(base,)], "dir string"))
    zero = F.lit(0).cast("bigint")
    return folders.join(totals, "dir", "left").select("dir", *(F.coalesce(c, zero).alias(c) for c in ("n", "n_below", "bytes_below")))
