"""Input is worked out once, tasks and groups are few, whatever reads them."""

import numpy as np
import pandas as pd

from constants import SF_SMALL
from trafficlens.operators import ordered, profile, ranges
from trafficlens.plans.catalogue import samples_table, training_table
from trafficlens.sources import capture
from trafficlens.streaming import metrics as SM


def counted(spark, df):
    """The rows of ``df`` and a counter of how many were worked out."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    return df.mapInPandas(run, df.schema), seen


def test_unbounded_box_statistics_work_rows_out_once(spark):
    df, seen = counted(spark, spark.range(3000).selectExpr("cast(id as double) as x"))
    r = profile.box_statistics(df, ["x"], accuracy=100, bounded=False).first()
    assert (r.n, r.min, r.median, r.max, r.fliers) == (3000, 0.0, 1499.5, 2999.0, 0)
    assert seen.value == 3000


def test_ordered_series_work_rows_out_once(spark):
    rows = spark.range(2000).selectExpr("timestamp_seconds(id) as ts", "'m' as metric", "map('a', string(id % 3)) as labels",
                                        "cast(id as double) as value", "id as sample_id")
    df, seen = counted(spark, rows)
    assert ranges.ordered_series(df).count() == 2000 and seen.value == 2000


def test_ram_share_orders_its_samples_once(spark, monkeypatch):
    calls, plain = [], ranges.ordered_series
    monkeypatch.setattr(ranges, "ordered_series", lambda *a: (calls.append(1), plain(*a))[1])
    assert ranges.ram_share_at(samples_table(spark, SF_SMALL), 60).count() > 0
    assert len(calls) == 1


def test_positions_join_a_small_summary_without_a_shuffle(spark, monkeypatch):
    rows = spark.range(500).selectExpr("if(id % 7 = 0, null, string(id % 4)) as path", "id as ts")
    got = ordered.position_in_group(rows, ["path"], ["ts"], total="n")
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(ordered, "SUMMARY_ROWS", 0)
    shuffled = ordered.position_in_group(rows, ["path"], ["ts"], total="n")
    assert sorted(map(str, got.collect())) == sorted(map(str, shuffled.collect()))


def test_training_table_does_not_decode_again(spark):
    plan = training_table(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "unhex" not in plan


def test_small_ranges_share_tasks(spark):
    listing = spark.createDataFrame([("a", 10 << 30, "x")], "path string, length long, class_name string")
    assert capture._tasks(listing, 64 << 10, None) == max(160, int(spark.conf.get("spark.sql.shuffle.partitions")))


class State:
    def __init__(self):
        self.get, self.exists, self.hasTimedOut, self.watermark, self.timer = None, False, False, 0, None

    def update(self, value):
        self.get, self.exists = value, True

    def remove(self):
        self.get, self.exists = None, False

    def getCurrentWatermarkMs(self):  # noqa: N802 - Spark's name
        return self.watermark

    def setTimeoutTimestamp(self, ms):  # noqa: N802
        self.timer = ms


def test_steps_of_a_group_close_one_by_one():
    fn, state = SM._increase_fn(10_000_000), State()
    at = np.array([1, 4, 12, 15, 25])  # seconds; late ones come in a later batch

    def batch(us, value):
        return pd.DataFrame({"us": us * 1_000_000, "sample_id": us, "value": value})

    first = pd.concat(fn(("m", "{}", 0), iter([batch(at[[1, 2, 4]], [5.0, 1.0, 9.0])]), state))
    assert first[["step", "value", "samples", "closed"]].values.tolist() == [[0, 0.0, 1, False], [1, 0.0, 1, False], [2, 0.0, 1, False]]
    later = pd.concat(fn(("m", "{}", 0), iter([batch(at[[3, 0]], [4.0, 2.0])]), state))
    assert later[["step", "value"]].values.tolist() == [[0, 3.0], [1, 3.0]] and state.timer == 10_000
    state.hasTimedOut, state.watermark = True, 20_000
    ended = pd.concat(fn(("m", "{}", 0), iter([]), state))
    assert ended[["step", "value", "samples", "closed"]].values.tolist() == [[0, 3.0, 2, True], [1, 3.0, 2, True]]
    assert state.timer == 30_000 and len(state.get[0]) == 1
    state.watermark = 30_000
    assert len(pd.concat(fn(("m", "{}", 0), iter([]), state))) == 1 and not state.exists
