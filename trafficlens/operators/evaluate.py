"""Classifier evaluation in one aggregate.

The confusion matrix in long form ``(label, prediction, n)`` is a single
partial-aggregated group-by over the scored rows (k² groups at most); the
per-class and weighted scores are then computed on those k² rows, so the
scored data is read once instead of once per metric. Definitions follow
Spark ML's ``MulticlassClassificationEvaluator``: classes are weighted by
their share of actual rows; precision of a class never predicted is 0; F1 of
a class with p + r = 0 is 0; weighted recall equals accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import position_in_group

MAX_GRID_CLASSES = 10_000  # columns of the dense grid; ``confusion_rows`` has no limit


def confusion_long(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return (pred.groupBy(F.col(label).cast("double").alias("label"),
                         F.col(prediction).cast("double").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def class_scores(confusion: DataFrame) -> DataFrame:
    """One row per class (actual or predicted): support, predicted, tp,
    precision, recall, f1 — one aggregate: each confusion cell adds to its
    actual class and to its predicted class."""
    n, lab, pre = F.col("n"), F.col("label"), F.col("prediction")
    cells = F.array(
        F.struct(lab.alias("class"), n.alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(lab == pre, n).otherwise(F.lit(0)).cast("bigint").alias("tp")),
        F.struct(pre.alias("class"), F.lit(0).cast("bigint").alias("support"), n.alias("predicted"),
                 F.lit(0).cast("bigint").alias("tp")),
    )
    s = confusion.select(F.inline(cells)).groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    s = s.withColumn("precision", p).withColumn("recall", r)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return s.withColumn("f1", f1)


def weighted_scores(confusion: DataFrame) -> DataFrame:
    """One row: n, accuracy, weighted_precision, weighted_recall, f1."""
    cs = class_scores(confusion)
    n = F.sum("support")
    return cs.agg(
        n.alias("n"),
        (F.sum("tp") / n).alias("accuracy"),
        (F.sum(F.col("support") * F.col("precision")) / n).alias("weighted_precision"),
        (F.sum(F.col("support") * F.col("recall")) / n).alias("weighted_recall"),
        (F.sum(F.col("support") * F.col("f1")) / n).alias("f1"),
    )


def evaluate(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return weighted_scores(confusion_long(pred, label, prediction))


def confusion_grid(confusion: DataFrame, classes: list[float], actual_only: bool = False) -> DataFrame:
    """Dense matrix: one row per actual label, one column ``p_<k>`` per class
    in ``classes`` (ascending), zeros filled. By default a class that is
    predicted but never actual keeps its column; ``actual_only=True`` drops
    those columns, as mllib's matrix does (pass the actual labels)."""
    cls = sorted(set(float(c) for c in classes))
    return (confusion.groupBy("label")
            .pivot("prediction", cls)
            .agg(F.sum("n"))
            .na.fill(0)
            .select("label", *[F.col(f"`{c}`").cast("bigint").alias(f"p_{int(c)}") for c in cls]))


def grid_classes(confusion: DataFrame, actual_only: bool = False) -> list[float]:
    """Axis values of the grid: every label or prediction seen (k values),
    or only the actual labels (mllib's axes)."""
    vals = confusion.select(F.col("label").alias("c"))
    if not actual_only:
        vals = vals.union(confusion.select(F.col("prediction").alias("c")))
    vals = vals.distinct()
    out = [r["c"] for r in vals.orderBy("c").limit(MAX_GRID_CLASSES + 1).collect()]
    if len(out) > MAX_GRID_CLASSES:
        raise ValueError(f"more than {MAX_GRID_CLASSES} columns: use confusion_rows")
    return out


def confusion_axis(confusion: DataFrame) -> DataFrame:
    """(class, position): every label or prediction seen, numbered from 0 in
    ascending order without passing the driver."""
    seen = confusion.select(F.col("label").alias("class")).union(confusion.select("prediction")).where("class IS NOT NULL").distinct()
    return position_in_group(seen, [], ["class"], "position")


def confusion_rows(confusion: DataFrame) -> DataFrame:
    """The matrix for any number of classes: one row per actual class, (label,
    position, total, cells), where cells lists (position, n) of the predicted classes
    that occur, in axis order. Rows without a label or a prediction are left out."""
    axis = confusion_axis(confusion)
    placed = (confusion.join(axis.select(F.col("class").alias("label"), "position"), "label")
              .join(axis.select(F.col("class").alias("prediction"), F.col("position").alias("_tl_at")), "prediction"))
    cell = F.struct(F.col("_tl_at").alias("position"), "n")
    return placed.groupBy("label", "position").agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(cell)).alias("cells"))

