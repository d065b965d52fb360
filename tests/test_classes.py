"""Class indices and confusion matrices without a limit to the number of classes; the training report."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from trafficlens.operators import evaluate as EV
from trafficlens.operators import labels as LB
from trafficlens.plans import model as M
from trafficlens.schema import FEATURE_COLUMNS


def test_many_names(spark):
    names = spark.range(200_000).select(F.concat(F.lit("n"), F.md5(F.col("id").cast("string"))).alias("name"))
    rows = LB.class_dimension(names.union(names.limit(50_000)), "name", partitions=16).orderBy("CLASS").collect()
    assert [r.CLASS for r in rows] == list(range(200_000))
    assert all(a.class_name < b.class_name for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("limits", [(1_000, 32 << 20), (3, 32 << 20), (3, 0)])
def test_lookup_is_the_same_by_expression_broadcast_and_shuffle(spark, monkeypatch, limits):
    monkeypatch.setattr(LB, "LITERAL_NAMES", limits[0])
    monkeypatch.setattr(LB, "BROADCAST_BYTES", limits[1])
    rows = [(i, f"c{i % 37:02d}" if i % 3 else "c05") for i in range(900)] + [(1000, None), (1001, "")]
    df = spark.createDataFrame(rows, "i int, name string").withColumn("CLASS", F.lit(99))
    order = {n: k for k, n in enumerate(sorted({n for _, n in rows if n is not None}))}
    got = {r.i: r.CLASS for r in LB.attach_class_index(df, "name").collect()}
    assert got == {i: order.get(n) for i, n in rows}


def test_names_that_an_explicit_list_lacks(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "name string")
    assert [r.CLASS for r in LB.attach_class_index(df, "name", classes=["b"]).orderBy("name").collect()] == [None, None, 0]
    none = spark.createDataFrame([], "name string")
    assert LB.attach_class_index(none, "name").collect() == [] and LB.class_dimension(none, "name").collect() == []


def test_matrix_of_twenty_thousand_classes(spark):
    n = 20_000
    pred = spark.range(3 * n).select((F.col("id") % n).cast("double").alias("label"),
                                     F.when(F.col("id") < 2 * n, F.col("id") % n).otherwise((F.col("id") + 1) % n + 0.5).cast("double").alias("prediction"))
    rows = EV.confusion_rows(EV.confusion_long(pred))
    assert rows.count() == n
    some = {r.label: r for r in rows.where("label IN (0, 7, 19999)").collect()}
    assert some[7.0].position == 14 and some[7.0].total == 3 and [tuple(c) for c in some[7.0].cells] == [(14, 2), (17, 1)]
    assert [tuple(c) for c in some[19999.0].cells] == [(1, 1), (39998, 2)]


def test_rows_and_grid_agree(spark):
    data = [(0.0, 0.0)] * 5 + [(0.0, 2.0)] * 3 + [(1.0, 1.0)] * 2 + [(None, 1.0), (1.0, None)]
    conf = EV.confusion_long(spark.createDataFrame(data, "label double, prediction double"))
    rows = {r.label: {c.position: c.n for c in r.cells} for r in EV.confusion_rows(conf).collect()}
    assert rows == {0.0: {0: 5, 2: 3}, 1.0: {1: 2}}


def packets(spark, classes=(2, 5, 9), n=600):
    cols = [(F.col("id") % len(classes) * 20 + F.col("id") % 7 + k).cast("int").alias(c) for k, c in enumerate(FEATURE_COLUMNS)]
    lab = F.element_at(F.array(*[F.lit(c) for c in classes]), (F.col("id") % len(classes) + 1).cast("int"))
    df = spark.range(n).select(F.lit("p").alias("path"), F.col("id").alias("ordinal"), lab.alias("CLASS"), *cols)
    return df.withColumn(FEATURE_COLUMNS[0], F.when(F.col("ordinal") % 10 != 0, F.col(FEATURE_COLUMNS[0])))


def test_report_counts_dropped_rows_and_writes_the_matrix(spark, tmp_path):
    df = packets(spark)
    _, report = M.train_and_report(df, "decision_tree", matrix_to=str(tmp_path / "m"))
    r = report.first()
    assert r.rows_dropped == 60 and r.rows_train + r.rows_test == 540 and r.classes == 3 and r.accuracy > 0.9
    rows = spark.read.parquet(str(tmp_path / "m")).collect()
    assert sum(x.total for x in rows) == r.rows_test and {x.label for x in rows} == {2.0, 5.0, 9.0}
    _, zero = M.train_and_report(df, "decision_tree", null_policy="zero")
    assert zero.first().rows_dropped == 0 and zero.first().rows_train + zero.first().rows_test == 600


def test_random_split_is_sparks_own(spark):
    df = packets(spark)
    _, report = M.train_and_report(df, "decision_tree", split="random", seed=3)
    kept = df.na.drop(subset=FEATURE_COLUMNS).select(F.col("CLASS").cast("double").alias("CLASS"), *FEATURE_COLUMNS)
    first, second = kept.randomSplit([0.8, 0.2], 3)
    r = report.first()
    assert (r.rows_train, r.rows_test, r.rows_dropped) == (first.count(), second.count(), 60)


def test_perceptron_with_labels_that_are_not_dense(spark, tmp_path):
    model, report = M.train_and_report(packets(spark, (2, 5, 900)), "perceptron", maxIter=40, save_to=str(tmp_path / "model"))
    assert report.first().classes == 3 and report.first().accuracy > 0.8
    data = packets(spark, (2, 5, 900)).na.drop().withColumn("CLASS", F.col("CLASS").cast("double"))
    a = Counter(r.prediction for r in M.score(model, data).collect())
    b = Counter(r.prediction for r in M.score(M.load_model(str(tmp_path / "model")), data).collect())
    assert a == b and set(a) <= {2.0, 5.0, 900.0}
