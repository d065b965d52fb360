"""Training jobs: assemble → (scale) → estimator as one Spark ML Pipeline,
reproducible key-hash split, timed fit, scoring and the one-pass evaluation,
returned as a one-row run report."""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.feature import MinMaxScaler, SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.evaluate import confusion_long, confusion_rows, weighted_scores
from ..operators.prepare import NULL_POLICIES, apply_null_policy, split_bucket, split_key
from ..schema import FEATURE_COLUMNS, LABEL_COLUMN

MODEL_KINDS = ("decision_tree", "random_forest", "perceptron")

REPORT_SCHEMA = ("model string, rows_train bigint, rows_test bigint, accuracy double, "
                 "weighted_precision double, weighted_recall double, f1 double, train_seconds double, "
                 "total_seconds double, null_policy string, train_percent int, seed int, rows_dropped bigint, classes int")


def build_pipeline(kind: str, features: list[str] | None = None, label: str = LABEL_COLUMN,
                   num_classes: int | None = None, seed: int = 42, scaled: bool | None = None,
                   handle_invalid: str = "error", labels: list[float] | None = None, **params) -> Pipeline:
    """Pipeline for one of the three estimators. Parameters default to the
    original jobs: tree (depth 5, 32 bins, gini), forest of 100 trees of
    depth 5, perceptron layers [n_features, 10, 5, k]. The perceptron reads
    min-max scaled features by default; trees read raw features. ``labels`` (for
    the perceptron) are the classes in order where they aren't 0 to k-1: it is
    trained on their places, and its predictions are the labels again."""
    feats = features or FEATURE_COLUMNS
    stages = [VectorAssembler(inputCols=feats, outputCol="features", handleInvalid=handle_invalid)]
    use_scaled = (kind == "perceptron") if scaled is None else scaled
    fcol = "features"
    if use_scaled:
        stages.append(MinMaxScaler(inputCol="features", outputCol="scaledFeatures"))
        fcol = "scaledFeatures"
    if kind == "decision_tree":
        est = DecisionTreeClassifier(labelCol=label, featuresCol=fcol, seed=seed, **params)
    elif kind == "random_forest":
        params.setdefault("numTrees", 100)
        params.setdefault("maxDepth", 5)
        est = RandomForestClassifier(labelCol=label, featuresCol=fcol, seed=seed, **params)
    elif kind == "perceptron":
        if not num_classes:
            raise ValueError("perceptron needs num_classes")
        layers = params.pop("layers", [len(feats), 10, 5, num_classes])
        if labels:
            listed = "array(" + ", ".join(f"{x!r}D" for x in labels) + ")"
            stages.append(SQLTransformer(statement=f"SELECT *, double(array_position({listed}, {label}) - 1) AS labelPlace FROM __THIS__"))
            params["predictionCol"] = "placePrediction"
        est = MultilayerPerceptronClassifier(labelCol="labelPlace" if labels else label, featuresCol=fcol, seed=seed,
                                             layers=layers, **params)
    else:
        raise ValueError(f"model kind {kind!r} not in {MODEL_KINDS}")
    stages.append(est)
    if kind == "perceptron" and labels:
        stages.append(SQLTransformer(statement=f"SELECT *, {listed}[int(placePrediction)] AS prediction FROM __THIS__"))
    return Pipeline(stages=stages)


def _complete(df: DataFrame, features: list[str], policy: str) -> Column:
    """Whether the null policy keeps the row."""
    kept = F.lit(True)
    if policy == "skip":
        for name in features:
            kept = kept & F.col(name).isNotNull()
            if dict(df.dtypes)[name] in ("double", "float"):
                kept = kept & ~F.isnan(name)
    return kept


def train_and_report(packets: DataFrame, kind: str = "decision_tree", key_cols: list[str] | None = None,
                     null_policy: str = "skip", train_percent: int = 80, seed: int = 42,
                     num_classes: int | None = None, save_to: str | None = None,
                     split: str = "hash", matrix_to: str | None = None, **params) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training share, score the test share and return
    ``(model, report)``; the report is one row with sizes, the four
    weighted scores, the timings (fit, and the whole job including the
    evaluation), the rows that the null policy left out and the number of classes
    of the training share. ``matrix_to`` names a table for the confusion matrix
    (``confusion_rows``). Label, features and split flag are persisted (memory and
    disk) while the fit and the evaluation reread them, and released afterwards."""
    t0 = time.time()
    label = LABEL_COLUMN
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null policy {null_policy!r} not in {NULL_POLICIES}")
    keys = key_cols or ["path", "ordinal"]
    # one pass computes features and the split flag; rows left out have none
    kept = _complete(packets, FEATURE_COLUMNS, null_policy)
    columns = [F.col(label).cast("double").alias(label), *FEATURE_COLUMNS]
    if split == "hash":
        in_train = split_bucket(split_key(*keys), seed) < train_percent
        flagged = packets.select(*columns, F.when(kept, in_train).alias("is_train"))
    elif split == "random":  # compatibility: randomSplit (depends on partitioning)
        left_out = packets.where(~kept).select(*columns, F.lit(None).cast("boolean").alias("is_train"))
        share = [train_percent / 100.0, 1 - train_percent / 100.0]
        first, second = packets.where(kept).select(*columns).randomSplit(share, seed)
        flagged = first.withColumn("is_train", F.lit(True)).union(second.withColumn("is_train", F.lit(False))).union(left_out)
    else:
        raise ValueError(f"split {split!r} not in ('hash', 'random')")
    if null_policy == "zero":
        flagged = apply_null_policy(flagged, "zero")
    flagged = flagged.persist(StorageLevel.MEMORY_AND_DISK)
    train = flagged.where(F.col("is_train"))
    test = flagged.where(~F.col("is_train"))
    sizes = flagged.groupBy("is_train", label).agg(F.count(F.lit(1)).alias("n")).persist()
    n_train, dropped, classes = sizes.agg(
        F.coalesce(F.sum(F.when(F.col("is_train"), F.col("n"))), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("is_train").isNull(), F.col("n"))), F.lit(0)),
        F.count_distinct(F.when(F.col("is_train"), F.col(label)))).first()
    labels = None
    if kind == "perceptron":  # its last layer has a unit per class
        seen = [r[label] for r in sizes.where("is_train").select(label).distinct().orderBy(label).collect() if r[label] is not None]
        if num_classes is None:
            num_classes = len(seen)
            labels = None if seen == [float(i) for i in range(len(seen))] else seen
    handle = "keep" if null_policy == "keep" else "error"
    pipe = build_pipeline(kind, num_classes=num_classes, seed=seed, handle_invalid=handle, labels=labels, **params)
    t_fit = time.time()
    model = pipe.fit(train)
    train_seconds = time.time() - t_fit
    if save_to:
        model.write().overwrite().save(save_to)
    confusion = confusion_long(model.transform(test).select(F.col(label).alias("label"), "prediction")).persist()
    scores = weighted_scores(confusion).first()
    if matrix_to:
        confusion_rows(confusion).write.mode("overwrite").parquet(matrix_to)
    for table in (confusion, sizes, flagged):
        table.unpersist()
    spark = packets.sparkSession
    # one row of numbers computed above from the data (the run report)
    report = spark.createDataFrame([(
        kind, int(n_train), int(scores["n"] or 0), scores["accuracy"], scores["weighted_precision"],
        scores["weighted_recall"], scores["f1"], round(train_seconds, 3), round(time.time() - t0, 3),
        null_policy, int(train_percent), int(seed), int(dropped), int(classes),
    )], REPORT_SCHEMA)
    return model, report


def score(model: PipelineModel, packets: DataFrame) -> DataFrame:
    """Score new traffic (batch or streaming DataFrame) with a saved or fresh
    pipeline; rows with null features are kept only if the model was built
    with ``handleInvalid='keep'``."""
    return model.transform(packets)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def append_report(report: DataFrame, path: str) -> None:
    """Append run-report rows to a parquet results table."""
    report.write.mode("append").parquet(path)
