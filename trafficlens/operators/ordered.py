"""Position of a row in its group without putting a whole group in one task.

A plain ``Window.partitionBy(key).orderBy(t)`` sends every row of a key to one
task, so a key holding a third of the data runs in one task. Here rows are
range-partitioned on (key, ordering columns): Spark's sampled range bounds cut
the globally sorted sequence into equal slices, so a hot key is split over
many tasks while every other key stays in one. Inside a task the running row
id less the smallest of the (task, key) run is the local position; only a
per-(task, key) summary — about one row per key plus one per task, since only
keys at slice borders span tasks — goes through a window, and joins back on
(task, key). Null keys are a group of their own. All of it is built-in
functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path

PID = "_tl_pid"
IDX = "_tl_idx"
SUMMARY_ROWS = 200_000


def _partitions(df: DataFrame, partitions: int | None) -> int:
    """Range tasks: the shuffle width, or more when the input has more scan
    splits (each about ``spark.sql.files.maxPartitionBytes``), so the task
    size stays bounded as the data grows."""
    if partitions:
        return partitions
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    try:
        n = max(n, df.rdd.getNumPartitions())
    except Exception:  # noqa: BLE001 - no RDD view (remote session): keep the shuffle width
        pass
    return n


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared checkpoint folder: range bounds are sampled
    in a pass of their own, and each later pass would work the rows out again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _summary(summary: DataFrame) -> DataFrame:
    """The per-(task, key) summary, worked out once; broadcast up to ``SUMMARY_ROWS``."""
    kept = summary.checkpoint(eager=True)
    return F.broadcast(kept) if kept.count() <= SUMMARY_ROWS else kept


def local_scan(df: DataFrame, by: list[str], order: list[str], partitions: int | None = None) -> DataFrame:
    """Range-partition on (by, order) (``order`` must make a total order
    within a key, e.g. end in a unique id), sort each task the same way and
    add ``_tl_pid`` (task) and ``_tl_idx`` (ascending row id in the task)."""
    ranged = df.repartitionByRange(_partitions(df, partitions), *by, *order).sortWithinPartitions(*by, *order)
    return ranged.withColumns({PID: F.spark_partition_id(), IDX: F.monotonically_increasing_id()})


def position_in_group(df: DataFrame, by: list[str], order: list[str], out: str = "ordinal",
                      total: str | None = None, partitions: int | None = None) -> DataFrame:
    """0-based position of each row inside its ``by`` group in ``order``
    (``row_number() - 1``) and optionally the group size, skew-safe. Rows
    whose key is null are kept and numbered among themselves."""
    ensure_checkpoint_dir(df.sparkSession)
    scanned = local_scan(df, by, order, partitions).checkpoint(eager=True)
    summary = scanned.groupBy(PID, *by).agg(F.count(F.lit(1)).alias("_tl_n"), F.min(IDX).alias("_tl_low"))
    w = Window.partitionBy(*by).orderBy(PID)
    before = F.coalesce(F.sum("_tl_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    summary = summary.withColumn("_tl_off", before - F.col("_tl_low"))
    if total:
        summary = summary.withColumn(total, F.sum("_tl_n").over(Window.partitionBy(*by)))
    names = [PID, *by]
    keys = [f"_tl_k{i}" for i in range(len(names))]
    right = summary.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], "_tl_off", *([total] if total else []))
    same = F.lit(True)
    for n, k in zip(names, keys):
        same = same & F.col(n).eqNullSafe(F.col(k))
    joined = scanned.join(_summary(right), same)
    return joined.withColumn(out, F.col("_tl_off") + F.col(IDX)).drop(PID, IDX, "_tl_off", *keys)


def running_total(df: DataFrame, by: list[str], order: list[str], amount: str, out: str = "cum",
                  partitions: int | None = None) -> DataFrame:
    """Rows of ``df`` with ``out``, the sum of ``amount`` over the rows of the same
    ``by`` group up to and with this one in ``order`` (a total order), skew-safe: sums
    run inside range tasks, and only a per-(task, group) summary is combined."""
    ensure_checkpoint_dir(df.sparkSession)
    scanned = local_scan(df, by, order, partitions).checkpoint(eager=True)
    inside = Window.partitionBy(PID, *by).orderBy(IDX).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*by).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    summary = (scanned.groupBy(PID, *by).agg(F.sum(amount).alias("_tl_n"))
               .withColumn("_tl_off", F.coalesce(F.sum("_tl_n").over(earlier), F.lit(0))))
    names = [PID, *by]
    keys = [f"_tl_k{i}" for i in range(len(names))]
    right = summary.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], "_tl_off")
    same = F.lit(True)
    for n, k in zip(names, keys):
        same = same & F.col(n).eqNullSafe(F.col(k))
    return (scanned.withColumn(out, F.sum(amount).over(inside)).join(right, same)
            .withColumn(out, F.col(out) + F.col("_tl_off")).drop(PID, IDX, "_tl_off", *keys))
