"""Label dimension: names → dense indices 0..k-1 in ascending name order.

``class_dimension`` numbers the distinct names wherever they are: names are
range-partitioned, numbered in each task, and per-task offsets come from the
counts of the tasks before it. No name passes the driver and there is no limit to
their number.

``attach_class_index`` looks a column's names up. Up to ``LITERAL_NAMES`` names
(counted by a limited collect) become a plain expression over the sorted names, so
filters on other columns still push down; more names are joined from the
dimension, broadcast while its size is below ``BROADCAST_BYTES`` and shuffled
beyond (a name that very many rows hold is then split by the skew join). Null
names, and names that an explicit list lacks, have no index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import position_in_group

LITERAL_NAMES = 1_000
BROADCAST_BYTES = 32 << 20


def normalise_class_name(col):
    """Folder names like "Health Fitness" and "HealthFitness" are one class."""
    return F.regexp_replace(col, r"\s+", "")


def _names(df: DataFrame, name_col: str) -> DataFrame:
    return df.select(F.col(name_col).alias("class_name")).where(F.col("class_name").isNotNull()).distinct()


def class_dimension(df: DataFrame, name_col: str, partitions: int | None = None) -> DataFrame:
    """``(class_name, CLASS)`` for the distinct names of ``name_col``."""
    placed = position_in_group(_names(df, name_col), [], ["class_name"], "CLASS", partitions=partitions)
    return placed.select("class_name", F.col("CLASS").cast("int").alias("CLASS"))


def attach_class_index(df: DataFrame, name_col: str, out: str = "CLASS", classes: list[str] | None = None) -> DataFrame:
    if classes is None:
        found = _names(df, name_col).limit(LITERAL_NAMES + 1).collect()
        if len(found) > LITERAL_NAMES:
            return _looked_up(df, name_col, out)
        classes = [r["class_name"] for r in found]
    ordered = sorted(set(classes))
    idx = F.array_position(F.array(*[F.lit(c) for c in ordered]).cast("array<string>"), F.col(name_col)) - 1
    return df.withColumn(out, F.when(idx >= 0, idx.cast("int")))


def _looked_up(df: DataFrame, name_col: str, out: str) -> DataFrame:
    names = class_dimension(df, name_col).select(F.col("class_name").alias("_tl_name"), F.col("CLASS").alias("_tl_class")).checkpoint()
    size = names.agg(F.sum(F.octet_length("_tl_name") + 16)).first()[0]
    side = F.broadcast(names) if size <= BROADCAST_BYTES else names
    kept = df.drop(out) if out in df.columns else df
    return kept.join(side, F.col(name_col) == F.col("_tl_name"), "left").withColumn(out, F.col("_tl_class")).drop("_tl_name", "_tl_class")
