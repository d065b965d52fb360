"""End-to-end jobs over real inputs: the steps a user runs one after another.

* ``extract``   captures under ``root/<Class>/`` → class-partitioned parquet
  packet table (optionally a prefix percentage of every capture).
* ``profile``   rows / columns / classes and box statistics of a table.
* ``train``     split → fit → score → report row (appended to a results table).
* ``inventory`` files per folder.

Each takes the session and paths as arguments; ``python -m trafficlens``
runs them from the command line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields
from ..operators import profile as PF
from ..operators import sample as SA
from ..schema import FEATURE_COLUMNS
from ..sources import capture as CAP
from ..sources import dataset as DS
from . import model as M


def extract(spark: SparkSession, capture_root: str, out: str, percent: int = 100, compat: bool = False,
            classes: list[str] | None = None, extended: bool = False) -> DataFrame:
    """Decode every capture into the packet table and write it partitioned by
    class; returns the written table (read back)."""
    decode = fields.extended_features_of if extended else fields.packet_features_of
    table = CAP.read_captures(spark, capture_root, classes, decode=decode)
    if percent < 100 or compat:
        table = SA.prefix_sample(table, percent, compat=compat)
    table = table.drop("n_in_capture")
    if extended:
        table.write.mode("overwrite").partitionBy("class_name").parquet(out)
        return spark.read.parquet(out)
    DS.write_packets(table, out)
    return DS.read_packets(spark, out, classes)


def profile(spark: SparkSession, table: str, classes: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    df = DS.read_packets(spark, table, classes).drop("class_name", "path", "ordinal")
    return PF.profile(df), PF.box_statistics(df, FEATURE_COLUMNS)


def train(spark: SparkSession, table: str, kind: str = "decision_tree", classes: list[str] | None = None,
          null_policy: str = "skip", results: str | None = None, model_out: str | None = None,
          matrix_out: str | None = None, **params) -> DataFrame:
    """Train on a packet table written by ``extract``. The split key is the
    capture row key when present, else all feature columns and the class."""
    df = spark.read.parquet(table)
    if classes is not None:
        df = df.where(F.col("class_name").isin(*classes))
    keys = ["path", "ordinal"] if {"path", "ordinal"} <= set(df.columns) else ["class_name", *FEATURE_COLUMNS]
    _, report = M.train_and_report(df, kind, key_cols=keys, null_policy=null_policy, save_to=model_out,
                                     matrix_to=matrix_out, **params)
    if results:
        M.append_report(report, results)
    return report


def inventory(spark: SparkSession, root: str) -> DataFrame:
    return DS.directory_inventory(spark, root)
