"""The epoch sink under replays and failures, and counter state under disorder."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from trafficlens.operators import metrics as MX
from trafficlens.session import scratch_path
from trafficlens.streaming import jobs as SJ
from trafficlens.streaming import metrics as SM
from trafficlens.streaming import sink as SK


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_replayed_epoch_leaves_the_table_unchanged(spark):
    path = scratch_path(spark, "sink")
    one, two = spark.range(5).withColumn("v", F.lit("a")), spark.range(3).withColumn("v", F.lit("b"))
    assert SK.write_epoch(one, path, "r1", 0) and SK.write_epoch(two, path, "r1", 1)
    before = rows(SK.read_table(spark, path))
    assert len(before) == 8
    assert not SK.write_epoch(spark.range(100).withColumn("v", F.lit("late")), path, "r1", 1)
    assert rows(SK.read_table(spark, path)) == before
    assert rows(SK.committed(spark, path)) == [("r1", 0, 5), ("r1", 1, 3)]


def test_half_written_epoch_is_not_read_and_its_replay_is(spark):
    path = scratch_path(spark, "sink")
    SK.write_epoch(spark.range(4), path, "r1", 0)
    spark.range(50, 60).write.parquet(f"{path}/run=r1/epoch=1")  # a batch that died before its commit
    assert SK.read_table(spark, path).count() == 4
    assert SK.write_epoch(spark.range(50, 57), path, "r1", 1)
    assert rows(SK.read_table(spark, path)) == [(i,) for i in [0, 1, 2, 3, 50, 51, 52, 53, 54, 55, 56]]


def test_a_stream_with_a_new_checkpoint_adds(spark):
    path = scratch_path(spark, "sink")
    SK.write_epoch(spark.range(2), path, SK.run_name("/a"), 0)
    SK.write_epoch(spark.range(2), path, SK.run_name("/b/"), 0)
    assert SK.run_name("/b/") == SK.run_name("/b") != SK.run_name("/a")
    assert SK.read_table(spark, path).count() == 4


def test_last_and_latest(spark):
    path = scratch_path(spark, "sink")
    for epoch, data in enumerate([[("a", 1), ("b", 1)], [("a", 2)], [("c", 5), ("a", 3)]]):
        SK.write_epoch(spark.createDataFrame(data, "k string, v long"), path, "r", epoch)
    assert rows(SK.read_last(spark, path)) == [("a", 3), ("c", 5)]
    assert rows(SK.read_latest(spark, path, ["k"])) == [("a", 3), ("b", 1), ("c", 5)]


def test_a_table_without_epochs(spark):
    path = scratch_path(spark, "sink")
    assert SK.read_table(spark, path, "k string, v long").collect() == []
    assert SK.read_latest(spark, path, ["k"], "k string, v long").columns == ["k", "v"]
    with pytest.raises(ValueError, match="schema"):
        SK.read_table(spark, path)


def test_a_failing_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    """The third batch fails after its data were written; the restarted stream replays it once."""
    src, path, ckpt = str(tmp_path / "src"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    for k in range(4):
        spark.range(10 * k, 10 * k + 10).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(src)
    seen = []

    def breaks(batch):
        seen.append(batch.count())
        if len(seen) == 3:
            batch.write.parquet(f"{path}/run={SK.run_name(ckpt)}/epoch=2")
            raise RuntimeError("lost")
        return batch

    with pytest.raises(Exception, match="lost"):
        SJ.run_to_table(stream, path, "append", ckpt, breaks)
    assert SK.read_table(spark, path).count() == 20
    SJ.run_to_table(stream, path, "append", ckpt, breaks)
    assert rows(SK.read_table(spark, path)) == [(i,) for i in range(40)]


T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "ts timestamp, metric string, labels map<string,string>, value double, sample_id long"


def disordered(seed, n=300):
    r = random.Random(seed)
    rows = [(T0 + dt.timedelta(seconds=10 * i, milliseconds=r.randrange(9000)), "c", {"e": r.choice("ab")}, float(r.randrange(60)), i) for i in range(n)]
    at = [(x[0] + dt.timedelta(seconds=r.randrange(480)), x) for x in rows]
    return rows, [x for _, x in sorted(at, key=lambda p: p[0])]


def test_counter_state_takes_samples_in_any_order(spark):
    rows_, arriving = disordered(4)
    slices = [spark.createDataFrame(arriving[a:a + 50], SCHEMA) for a in range(0, 300, 50)]
    path = SJ.run_in_arrivals(spark, slices, lambda s: SM.counter_increase_stream(s, 300, "10 minutes"), scratch_path(spark, "inc"), "update")
    totals = SK.read_latest(spark, path, SM.INC_KEYS)
    got = {(r.step, r.labels["e"]): r.value for r in SM.increase_vector(totals).collect()}
    want = {(r.step, r.labels["e"]): r.value for r in MX.increase(spark.createDataFrame(rows_, SCHEMA), 300).collect()}
    assert got == want and len(got) == 20
    assert totals.agg(F.sum("samples")).first()[0] == 300
    closed = totals.where("closed").select("step").distinct().count()
    assert 0 < closed < 10  # the watermark closed the early steps, the last are open but there


def test_counter_state_drops_what_the_watermark_has_passed(spark):
    rows_ = [(T0 + dt.timedelta(seconds=s), "c", {"e": "a"}, float(s), s) for s in (10, 20, 7200, 7210, 14_400)]
    late = [(T0 + dt.timedelta(seconds=15), "c", {"e": "a"}, 999.0, 99)]
    slices = [spark.createDataFrame(x, SCHEMA) for x in (rows_[:2], rows_[2:4], rows_[4:], late)]
    path = SJ.run_in_arrivals(spark, slices, lambda s: SM.counter_increase_stream(s, 300, "10 minutes"), scratch_path(spark, "inc"), "update")
    totals = SK.read_latest(spark, path, SM.INC_KEYS).orderBy("step").collect()
    assert [(r.value, r.samples, r.closed) for r in totals] == [(10.0, 2, True), (10.0, 2, True), (0.0, 1, False)]
