"""Models, streams, sources, plan shape, and the driver contract with an
oracle sweep at sf0.001."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from constants import SF_SMALL
from oracle_check import TABLES, digest
from pcap_fixtures import FRAMES, write_pcap
from trafficlens.plans.catalogue import REGISTRY, training_table
from trafficlens.sources import dataset as DS

SLOW = {"train_decision_tree", "train_random_forest", "train_perceptron", "model_round_trip",
        "score_new_traffic", "stream_metric_windows", "stream_counter_deltas", "stream_scoring",
        "stream_ingest", "event_log_report", "capture_discovery", "file_inventory"}


def test_entry_contract(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert df.columns[:3] == ["model", "rows_train", "rows_test"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n not in SLOW))
def test_oracle_small(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_models_beat_majority_and_round_trip(spark):
    rep = REGISTRY["train_decision_tree"](spark, SF_SMALL).first()
    data = training_table(spark, SF_SMALL).na.drop()
    majority = data.groupBy("CLASS").count().agg(F.max("count")).first()[0] / data.count()
    assert rep["f1"] > 0.85 and rep["accuracy"] > majority
    rt = REGISTRY["model_round_trip"](spark, SF_SMALL).first()
    assert rt["rows"] > 0 and rt["agree"] == rt["rows"]


def test_stream_windows_equal_batch(spark):
    a = sorted(tuple(r) for r in REGISTRY["stream_metric_windows"](spark, SF_SMALL).collect())
    b = sorted(tuple(r) for r in REGISTRY["metric_heap_avg_1m"](spark, SF_SMALL).collect())
    assert a == b and a


def test_stream_ingest_equals_batch_decode(spark):
    a = REGISTRY["stream_ingest"](spark, SF_SMALL)
    b = REGISTRY["packet_features"](spark, SF_SMALL).drop("event_id")
    ra, rb = [tuple(r) for r in a.collect()], [tuple(r) for r in b.collect()]
    assert len(ra) == len(rb) and digest(a.columns, ra)[0] == digest(b.columns, rb)[0]


def test_stream_counter_deltas_match_batch(spark):
    """Out-of-order arrivals over restarted streams: every step, open ones too."""
    s = REGISTRY["stream_counter_deltas"](spark, SF_SMALL)
    batch = REGISTRY["metric_task_balance"](spark, SF_SMALL)
    assert sorted(map(tuple, s.select(batch.columns).collect())) == sorted(map(tuple, batch.collect()))


def test_directory_inventory_nested_and_empty(spark, tmp_path):
    root = tmp_path
    write_pcap(str(root / "A" / "x.pcap"), [(1.0, FRAMES["arp"])])
    write_pcap(str(root / "A" / "y.pcap"), [(1.0, FRAMES["arp"])])
    write_pcap(str(root / "A" / "deep" / "z.pcap"), [(1.0, FRAMES["arp"])])
    (root / "Empty").mkdir()
    folders = spark.createDataFrame([(f"file:{root}/A",), (f"file:{root}/Empty",)], "dir string")
    inv = DS.directory_inventory(spark, str(root), folders)
    got = {r["dir"].rsplit("/", 1)[-1]: r["n"] for r in inv.collect()}
    assert got == {"A": 2, "Empty": 0}
    plan = DS.directory_inventory(spark, str(root))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_event_log_report(spark, event_log_dir):
    REGISTRY["dataset_profile"](spark, SF_SMALL).collect()
    rep = REGISTRY["event_log_report"](spark, SF_SMALL).collect()
    assert rep and sum(r["tasks"] for r in rep) > 0


def test_decoder_plan_is_jvm_only_and_pushes_class_filter(spark):
    pk = REGISTRY["class_subset"](spark, SF_SMALL)
    plan = pk._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "PythonUDF" not in plan
    skip = REGISTRY["null_policy_skip"](spark, SF_SMALL)
    assert len(skip._jdf.queryExecution().optimizedPlan().toString()) < 200_000


def test_parquet_class_pruning(spark, tmp_path):
    path = str(tmp_path / "pk")
    DS.write_packets(REGISTRY["class_subset"](spark, SF_SMALL), path)
    df = DS.read_packets(spark, path, ["click"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "click" in plan
    assert {r["class_name"] for r in df.select("class_name").distinct().collect()} == {"click"}


def test_stream_drops_and_counts_rows_later_than_watermark(spark, tmp_path):
    """Samples an hour older than the watermark arrive in the third
    micro-batch (late events are judged against the watermark of the
    batch before): they are dropped from the window averages and counted."""
    import datetime as dt
    import time
    from trafficlens.session import scratch_path
    from trafficlens.streaming import jobs as SJ
    from trafficlens.streaming import metrics as SM
    from trafficlens.streaming import sink as SK
    src = tmp_path / "src"
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    schema = "ts timestamp, metric string, labels map<string,string>, value double, sample_id long"
    parts = {
        "a": [(t0 + dt.timedelta(seconds=i), "g", {"type": "gauges"}, 1.0, i) for i in range(50)],
        "b": [(t0 + dt.timedelta(minutes=5, seconds=i), "g", {"type": "gauges"}, 1.0, 50 + i) for i in range(5)],
        "c": [(t0 - dt.timedelta(hours=1), "g", {"type": "gauges"}, 5.0, 100 + i) for i in range(7)],
    }
    now = time.time()
    for k, (name, rows) in enumerate(parts.items()):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(src / name))
        for f in (src / name).iterdir():  # the file source takes files in modification order
            os.utime(f, (now + 60 * k, now + 60 * k))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(str(src)))
    stats = {}
    out = SJ.run_to_table(SM.windowed_average(stream, 60, "1 minute"), scratch_path(spark, "late"), "append",
                          stats=stats)
    assert stats["input_rows"] == 62 and stats["batches"] >= 3
    # counted where the state operator drops them: after partial
    # aggregation, so the 7 late samples of one window count as one row
    assert stats["late_rows"] >= 1
    res = SK.read_table(spark, out)
    assert res.where("value > 1").count() == 0 and res.count() >= 1


def test_stream_counter_state_across_micro_batches(spark, tmp_path):
    """Samples arrive in three time-ordered files (one micro-batch each):
    every closed step equals the batch increase exactly."""
    import time
    from trafficlens.operators import metrics as MX
    from trafficlens.plans import projections as P
    from trafficlens.session import scratch_path
    from trafficlens.streaming import jobs as SJ
    from trafficlens.streaming import metrics as SM
    from trafficlens.streaming import sink as SK
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    s = MX.select_series(P.samples(ev), "metrics_executor_completedTasks_total")
    bounds = s.selectExpr("percentile(unix_micros(ts), array(0.33, 0.66))").first()[0]
    now = time.time()
    parts = [s.where(F.unix_micros("ts") < bounds[0]),
             s.where((F.unix_micros("ts") >= bounds[0]) & (F.unix_micros("ts") < bounds[1])),
             s.where(F.unix_micros("ts") >= bounds[1])]
    for k, part in enumerate(parts):
        d = tmp_path / f"p{k}"
        part.coalesce(1).write.parquet(str(d))
        for f in d.iterdir():
            os.utime(f, (now + 60 * k, now + 60 * k))
    stream = (spark.readStream.schema(s.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(str(tmp_path)))
    stats = {}
    out = SJ.run_to_table(SM.counter_increase_stream(stream, 300), scratch_path(spark, "inc3"), "update",
                          stats=stats)
    assert stats["batches"] >= 3
    batch = {(r["step"], r["series"]): r["value"] for r in
             MX.with_series_id(MX.increase(s, 300)).collect()}
    totals = SK.read_latest(spark, out, SM.INC_KEYS)
    got = {(r["step"], r["series"]): r["value"] for r in MX.with_series_id(SM.increase_vector(totals)).collect()}
    assert got == batch
    assert totals.where("closed").count() > 0.9 * len(batch)
