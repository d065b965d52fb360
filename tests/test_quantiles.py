"""Exact quantiles of columns with any number of values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trafficlens.operators import profile as PF
from trafficlens.operators.ordered import running_total
from trafficlens.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def long_frame(spark, columns):
    parts = [pd.DataFrame({"feature": k, "value": v}) for k, v in columns.items()]
    return spark.createDataFrame(pd.concat(parts)).repartition(7)


@pytest.mark.parametrize("accuracy", [20, 100, 10000])
def test_quantiles_against_numpy(spark, accuracy):
    rnd = np.random.default_rng(3)
    columns = {
        "wide": rnd.integers(-2**62, 2**62, 20011).astype(float),     # a 64-bit column, all values distinct
        "hot": np.where(rnd.random(20000) < 0.34, 5.0, rnd.normal(size=20000)),
        "two": np.repeat([1.0, 2.0], [9999, 10001]),
        "same": np.full(5000, 7.0),
        "heavy": np.exp(rnd.normal(size=6007) * 6),
        "one": np.array([3.5]), "three": np.array([1.0, 2.0, 10.0]), "five": np.arange(5.0),
    }
    rows = {r["feature"]: r for r in exact_quantiles(long_frame(spark, columns), PROBABILITIES, accuracy).collect()}
    assert set(rows) == set(columns)
    for name, values in columns.items():
        r = rows[name]
        assert (r["n"], r["min"], r["max"]) == (len(values), values.min(), values.max())
        assert r["q"] == pytest.approx(np.quantile(values, PROBABILITIES).tolist(), rel=1e-12)


def test_empty_infinite_and_null_values(spark):
    empty = spark.createDataFrame([], "feature string, value double")
    assert exact_quantiles(empty, [0.5]).collect() == []
    df = spark.createDataFrame([(None, 1.0), (2, float("-inf")), (3, 5.0), (4, float("inf"))], "a int, b double")
    got = {r["feature"]: r for r in PF.box_statistics(df, ["a", "b"], bounded=False).collect()}
    assert (got["a"]["n"], got["a"]["median"]) == (3, 3.0) and (got["b"]["n"], got["b"]["median"]) == (4, 3.0)


def test_bracketed_box_equals_histogram_box(spark):
    rnd = np.random.default_rng(4)
    df = spark.createDataFrame(pd.DataFrame({"x": np.exp(rnd.normal(size=9000)), "y": rnd.integers(0, 50, 9000).astype(float)}))
    by = lambda frame: sorted(map(tuple, frame.collect()))
    assert by(PF.box_statistics(df, ["x", "y"], accuracy=50, bounded=False)) == by(PF.box_statistics(df, ["x", "y"]))
    assert by(PF.box_fliers(df, ["x", "y"], accuracy=50, bounded=False)) == by(PF.box_fliers(df, ["x", "y"]))


def test_only_the_brackets_are_counted_value_by_value(spark):
    from trafficlens.operators.quantiles import _brackets, _zone_counts
    df = spark.range(100000).select(F.lit("x").alias("feature"), (F.col("id") * 12345.678).alias("value"))
    brackets = _brackets(df, [0.25, 0.5, 0.75], 1000)
    counts = _zone_counts(df, brackets, 3)
    assert counts.count() < 100000 * 3 * 2 * 5 / 1000
    assert counts.agg(F.sum("n")).first()[0] == 100000


def test_running_total_of_a_hot_group_runs_in_many_tasks(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("k"), "id", (F.col("id") % 5).alias("n"))
    got = running_total(df, ["k"], ["id"], "n", partitions=8)
    rows = got.toPandas().sort_values(["k", "id"])
    assert (rows.groupby("k")["n"].cumsum() == rows["cum"]).all() and len(rows) == 9000
