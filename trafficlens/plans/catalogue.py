"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Each query reads the driver's tables (through the projections of
``projections.py``) so its work grows with them. Oracle twins live in
``oracle_sql.py`` under the same names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields
from ..operators import evaluate as EV
from ..operators import metrics as MX
from ..operators import prepare as PR
from ..operators import profile as PF
from ..operators import ranges as RG
from ..operators import sample as SA
from ..operators.labels import class_dimension
from ..operators.ordered import staged
from ..schema import EXTENDED_INT_COLUMNS, FEATURE_COLUMNS, PACKET_COLUMNS
from ..session import scratch_path
from ..sources import capture as CAP
from ..sources import dataset as DS
from ..sources import folders as FO
from ..streaming import jobs as SJ
from ..streaming import metrics as SM
from ..streaming import sink as SK
from . import model as M
from . import projections as P

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a small input (fewer scan splits than cores, e.g. one row group)
    all cores; a large input already has enough splits and is left alone."""
    try:
        n = df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (e.g. a remote session): leave as scanned
        return df
    return df.repartition(n) if parts < n else df


def events(spark, sf_dir) -> DataFrame:
    return spread(table(spark, sf_dir, "events"))


def packet_table(spark, sf_dir, keep=("event_id",)) -> DataFrame:
    return fields.packet_features(P.packets(events(spark, sf_dir)), keep=list(keep))


def extended_table(spark, sf_dir, keep=("event_id",)) -> DataFrame:
    return fields.extended_features(P.packets(events(spark, sf_dir)), keep=list(keep))


# ---- F: packet fields -------------------------------------------------------

@register("packet_features")
def q_packet_features(spark, sf_dir):
    return packet_table(spark, sf_dir)


def _select_packet(cols):
    def q(spark, sf_dir):
        return packet_table(spark, sf_dir).select("event_id", *cols)
    return q


def _select_extended(cols):
    def q(spark, sf_dir):
        return extended_table(spark, sf_dir).select("event_id", *cols)
    return q


register("packet_ip_octets")(_select_packet(
    [f"Source_IP{i}" for i in range(1, 5)] + [f"Destination_IP{i}" for i in range(1, 5)]))
register("packet_ip_text_length")(_select_packet(["LEN_SRC_IP", "LEN_DEST_IP"]))
register("packet_ports")(_select_packet(["TCP_SPORT", "TCP_DPORT"]))
register("packet_payload_length")(_select_packet(["LEN_RAW"]))
register("packet_send_time")(_select_packet(PACKET_COLUMNS[14:]))
register("packet_ip_header")(_select_extended(["LEN", "ID", "IP_FLAGS", "FRAG", "TTL", "PROTO", "CHKSUM"]))
register("packet_tcp_header")(_select_extended(
    ["SEQ", "ACK", "DATAOFS", "RESERVED", "TCP_FLAGS", "WINDOW", "CHKSUM_", "URGPTR"]))
register("packet_mac_bytes")(_select_extended(
    [f"DST_{i}" for i in range(1, 7)] + [f"SRC_{i}" for i in range(1, 7)] + ["TYPE"]))
register("packet_version_ihl")(_select_extended(["VERSION", "IHL"]))


@register("packet_features_extended")
def q_packet_features_extended(spark, sf_dir):
    df = extended_table(spark, sf_dir)
    return df.select("event_id", *PACKET_COLUMNS, *EXTENDED_INT_COLUMNS, "SEQ", "ACK",
                     F.length("MESSAGE_RAW").alias("MESSAGE_LEN"),
                     F.unix_timestamp("TIME_TCP").alias("TIME_TCP_EPOCH"),
                     fields.tcp_flag_letters(F.col("TCP_FLAGS")).alias("TCP_FLAG_LETTERS"),
                     "NAME")


@register("packet_layer_flags")
def q_packet_layer_flags(spark, sf_dir):
    return fields.layer_flags(P.packets(events(spark, sf_dir)), keep=["event_id"])


@register("ip_text_parse")
def q_ip_text_parse(spark, sf_dir):
    """Dotted text → octets, with malformed forms mixed in."""
    ev = events(spark, sf_dir)
    e, u = F.col("event_id"), F.col("user_id")
    r = P.packet_rule_columns(e, u, F.lit(0), F.col("value"))
    good = F.concat_ws(".", *[r[k].cast("string") for k in ("s1", "s2", "s3", "s4")])
    text = (F.when(e % 9 == 0, F.concat(F.lit("256."), good))
            .when(e % 9 == 1, F.concat_ws(".", r["s1"].cast("string"), r["s2"].cast("string")))
            .when(e % 9 == 2, F.concat(F.lit("0"), good))
            .when(e % 9 == 3, F.concat(good, F.lit(".")))
            .otherwise(good))
    octs = fields.ip_text_octets(text)
    return ev.select(e, text.alias("ip_text"), *[o.alias(f"IP{i + 1}") for i, o in enumerate(octs)])


# ---- S3 / P / U / S4: labels, subsets, unions, prefix samples -----------------


SUBSET_CLASSES = ["click", "purchase", "view"]


def round6(df: DataFrame, cols: list[str]) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(F.col(c).cast("double"), 6))
    return df


def packets_with_positions(spark, sf_dir, cols=("path", "ts", "event_id", "CLASS")) -> DataFrame:
    """Capture positions over only the columns needed: the ordered scan runs
    in Python and checkpoints its input, and Catalyst cannot prune columns
    through it, so frames are never carried along."""
    frames = P.packets(events(spark, sf_dir)).select(*cols)
    return SA.with_capture_positions(frames, "path", ["ts", "event_id"])


@register("class_index")
def q_class_index(spark, sf_dir):
    return class_dimension(events(spark, sf_dir), "event_type")


@register("label_double")
def q_label_double(spark, sf_dir):
    return PR.label_as_double(packet_table(spark, sf_dir)).select("event_id", "CLASS")


@register("class_union")
def q_class_union(spark, sf_dir):
    """Positional UNION ALL of per-class slices (one pushed-down filter per
    branch), as the jobs union one folder per class."""
    frames = P.packets(events(spark, sf_dir))
    names = ["click", "error", "purchase", "signup", "view"]
    parts = [fields.packet_features(frames.where(F.col("class_name") == n), keep=["event_id"]) for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


@register("class_subset")
def q_class_subset(spark, sf_dir):
    frames = PR.class_subset(P.packets(events(spark, sf_dir)), SUBSET_CLASSES)
    return fields.packet_features(frames, keep=["event_id", "class_name"])


def _prefix(pct):
    def q(spark, sf_dir):
        pos = packets_with_positions(spark, sf_dir)
        return SA.prefix_sample(pos, pct).select("event_id", "path", "ordinal", "n_in_capture", "CLASS")
    return q


for _pct in (20, 40, 60, 80):
    register(f"prefix_sample_{_pct}")(_prefix(_pct))


@register("prefix_sample_20_compat")
def q_prefix_sample_20_compat(spark, sf_dir):
    pos = packets_with_positions(spark, sf_dir)
    return SA.prefix_sample(pos, 20, compat=True).select("event_id", "path", "ordinal", "n_in_capture", "CLASS")


@register("packets_per_capture")
def q_packets_per_capture(spark, sf_dir):
    return SA.packets_per_capture(P.packets(events(spark, sf_dir)), "path")


# ---- A1-A6: profile, box statistics, nulls, min-max ----------------------------

@register("dataset_profile")
def q_dataset_profile(spark, sf_dir):
    return PF.profile(PR.canonical(packet_table(spark, sf_dir)), "CLASS")


@register("distinct_classes")
def q_distinct_classes(spark, sf_dir):
    return PF.distinct_values(packet_table(spark, sf_dir), "CLASS")


@register("box_statistics")
def q_box_statistics(spark, sf_dir):
    st = PF.box_statistics(packet_table(spark, sf_dir), FEATURE_COLUMNS)
    return round6(st, ["min", "q1", "median", "q3", "max", "iqr", "whisker_lo", "whisker_hi"])


@register("box_fliers")
def q_box_fliers(spark, sf_dir):
    return PF.box_fliers(packet_table(spark, sf_dir), FEATURE_COLUMNS)


UNBOUNDED_ACCURACY = 1000  # of the sketch; results are exact at any


@register("box_statistics_unbounded")
def q_box_statistics_unbounded(spark, sf_dir):
    """Box statistics of the 32-bit sequence numbers: as many values as rows."""
    st = PF.box_statistics(extended_table(spark, sf_dir), ["SEQ", "ACK"], accuracy=UNBOUNDED_ACCURACY, bounded=False)
    return round6(st, ["min", "q1", "median", "q3", "max", "iqr", "whisker_lo", "whisker_hi"])


@register("box_fliers_unbounded")
def q_box_fliers_unbounded(spark, sf_dir):
    """Fliers among the measured values of the events."""
    return PF.box_fliers(events(spark, sf_dir), ["value"], accuracy=UNBOUNDED_ACCURACY, bounded=False)


@register("null_policy_skip")
def q_null_policy_skip(spark, sf_dir):
    return PR.apply_null_policy(packet_table(spark, sf_dir), "skip")


@register("null_policy_zero")
def q_null_policy_zero(spark, sf_dir):
    return PR.apply_null_policy(packet_table(spark, sf_dir), "zero")


@register("null_policy_counts")
def q_null_policy_counts(spark, sf_dir):
    return PR.null_counts(packet_table(spark, sf_dir))


@register("minmax_summary")
def q_minmax_summary(spark, sf_dir):
    return PR.minmax_summary(packet_table(spark, sf_dir))


@register("minmax_scaled")
def q_minmax_scaled(spark, sf_dir):
    df = packet_table(spark, sf_dir)
    return round6(PR.minmax_scale(df).select("event_id", *FEATURE_COLUMNS), FEATURE_COLUMNS)


# ---- X3: key-hash split --------------------------------------------------------

@register("hash_split")
def q_hash_split(spark, sf_dir):
    pos = packets_with_positions(spark, sf_dir)
    key = PR.split_key("path", "ordinal")
    return pos.select("event_id", "path", "ordinal",
                      PR.split_bucket(key, 42).alias("bucket"),
                      (PR.split_bucket(key, 42) < 80).alias("is_train"))


@register("hash_split_counts")
def q_hash_split_counts(spark, sf_dir):
    pos = packets_with_positions(spark, sf_dir)
    flagged = PR.with_split_flag(pos, ["path", "ordinal"], 80, 42)
    return flagged.groupBy("is_train").agg(F.count(F.lit(1)).alias("rows"))


# ---- A7-A11: evaluation over the predictions projection -------------------------

def _confusion(spark, sf_dir):
    return EV.confusion_long(P.predictions(events(spark, sf_dir)))


@register("confusion_long")
def q_confusion_long(spark, sf_dir):
    return _confusion(spark, sf_dir)


@register("confusion_grid")
def q_confusion_grid(spark, sf_dir):
    conf = _confusion(spark, sf_dir)
    return EV.confusion_grid(conf, EV.grid_classes(conf))


@register("confusion_rows")
def q_confusion_rows(spark, sf_dir):
    """The matrix as sparse rows; cells as text."""
    rows = EV.confusion_rows(_confusion(spark, sf_dir))
    cells = F.array_join(F.transform("cells", lambda c: F.concat_ws(":", c["position"].cast("string"), c["n"].cast("string"))), ",")
    return rows.select("label", "position", "total", cells.alias("cells"))


@register("class_scores")
def q_class_scores(spark, sf_dir):
    return round6(EV.class_scores(_confusion(spark, sf_dir)), ["precision", "recall", "f1"])


@register("weighted_scores")
def q_weighted_scores(spark, sf_dir):
    return round6(EV.weighted_scores(_confusion(spark, sf_dir)),
                  ["accuracy", "weighted_precision", "weighted_recall", "f1"])


# ---- X1-X9, S9, S12, X11: training, report, model store, scoring ----------------



def training_table(spark, sf_dir, percent: int = 100, compat: bool = False) -> DataFrame:
    """Packet features keyed by (path, ordinal), the capture row key; a
    ``percent`` below 100 keeps that prefix of every capture (the 1 / 20 /
    100 % data variants). Frames are decoded first, so the ordered scan
    carries ~80-byte feature rows, not frames."""
    feats = staged(fields.packet_features(P.packets(events(spark, sf_dir)), keep=["path", "ts", "event_id"]), "features")
    pos = SA.with_capture_positions(feats, "path", ["ts", "event_id"])
    if percent < 100 or compat:
        pos = SA.prefix_sample(pos, percent, compat=compat)
    return pos.select("path", "ordinal", *PACKET_COLUMNS)


def _train(kind, **params):
    def q(spark, sf_dir):
        _, report = M.train_and_report(training_table(spark, sf_dir), kind, key_cols=["path", "ordinal"],
                                       null_policy="skip", **params)
        return report
    return q


register("train_decision_tree")(_train("decision_tree"))
register("train_random_forest")(_train("random_forest"))
register("train_perceptron")(_train("perceptron"))


@register("train_confusion")
def q_train_confusion(spark, sf_dir):
    """Confusion matrix of a tree on the test share: rows of the share per actual
    class, and how many of them have a prediction in the matrix."""
    path = scratch_path(spark, "matrix")
    M.train_and_report(training_table(spark, sf_dir), "decision_tree", key_cols=["path", "ordinal"], matrix_to=path)
    cells = F.aggregate("cells", F.lit(0).cast("bigint"), lambda a, c: a + c["n"])
    return spark.read.parquet(path).select(F.col("label").cast("int").alias("CLASS"), F.col("total").alias("test_rows"), cells.alias("predicted"))


@register("model_round_trip")
def q_model_round_trip(spark, sf_dir):
    """Fit, save to the shared checkpoint folder, load back, and count test
    rows on which the loaded model agrees with the fitted one."""
    data = PR.apply_null_policy(training_table(spark, sf_dir), "skip") \
        .withColumn("CLASS", F.col("CLASS").cast("double"))
    train, test = PR.hash_split(staged(data, "training"), ["path", "ordinal"])
    model = M.build_pipeline("decision_tree").fit(train)
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    loaded = M.load_model(path)
    a = model.transform(test).select("path", "ordinal", F.col("prediction").alias("p1"))
    b = loaded.transform(test).select("path", "ordinal", F.col("prediction").alias("p2"))
    return a.join(b, ["path", "ordinal"]).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("p1") == F.col("p2")).alias("agree"))


@register("score_new_traffic")
def q_score_new_traffic(spark, sf_dir):
    """Score every packet (nulls zero-filled) with a tree fitted on the
    training share; predicted class counts."""
    data = PR.apply_null_policy(training_table(spark, sf_dir), "zero") \
        .withColumn("CLASS", F.col("CLASS").cast("double"))
    train, _ = PR.hash_split(data, ["path", "ordinal"])
    model = M.build_pipeline("decision_tree").fit(train)
    return M.score(model, data).groupBy("prediction").agg(F.count(F.lit(1)).alias("packets"))


# ---- M1-M13: metric questions over the samples projection -----------------------



def samples_table(spark, sf_dir) -> DataFrame:
    return P.samples(events(spark, sf_dir))


def _metric(fn, *args):
    def q(spark, sf_dir):
        return MX.round_value(fn(samples_table(spark, sf_dir), *args))
    return q


register("metric_completed_share")(_metric(MX.completed_task_share))
register("metric_cpu_rate")(_metric(MX.cpu_rate_by_pod))


@register("metric_cpu_rate_extrapolated")
def q_metric_cpu_rate_extrapolated(spark, sf_dir):
    """M2 with the query language's edge extrapolation."""
    sel = MX.select_series(samples_table(spark, sf_dir), "container_cpu_usage_seconds_total",
                           [("namespace", "=", "default")])
    return MX.round_value(MX.sum_by(MX.rate(sel, 300, extrapolate=True), ["pod"]))
register("metric_memory_by_pod")(_metric(MX.memory_by_pod))
register("metric_heap_avg_1m")(_metric(MX.driver_heap_avg_1m))
register("metric_heap")(_metric(MX.gauge_by_executor, "metrics_executor_JVMHeapMemory_bytes"))
register("metric_storage_heap")(_metric(MX.gauge_by_executor, "metrics_executor_usedOnHeapStorageMemory_bytes"))
register("metric_task_balance")(_metric(MX.task_balance))
register("metric_gc_total")(_metric(MX.gauge_by_executor, "metrics_executor_totalGCTime_seconds_total"))
register("metric_duration_total")(_metric(MX.gauge_by_executor, "metrics_executor_totalDuration_seconds_total"))
register("metric_tasks_total")(_metric(MX.gauge_by_executor, "metrics_executor_totalTasks_total"))
register("metric_gc_share")(_metric(MX.gc_share))
register("metric_ram_share")(_metric(MX.ram_share))
register("metric_cpu_share")(_metric(MX.cpu_share))

# ranges every 15 seconds, instant values every minute with a look-back of five
register("metric_completed_share_sliding")(_metric(RG.completed_task_share_at))
register("metric_cpu_rate_sliding")(_metric(RG.cpu_rate_by_pod_at))
register("metric_cpu_rate_sliding_extrapolated")(_metric(RG.cpu_rate_by_pod_at, 15, True))
register("metric_heap_avg_sliding")(_metric(RG.driver_heap_average_at))
register("metric_task_balance_sliding")(_metric(RG.task_balance_at))
register("metric_cpu_share_sliding")(_metric(RG.cpu_share_at))
register("metric_memory_by_pod_lookback")(_metric(RG.memory_by_pod_at))
for _name, _of in (("heap", "JVMHeapMemory_bytes"), ("storage_heap", "usedOnHeapStorageMemory_bytes"), ("gc_total", "totalGCTime_seconds_total"),
                   ("duration_total", "totalDuration_seconds_total"), ("tasks_total", "totalTasks_total")):
    register(f"metric_{_name}_lookback")(_metric(RG.gauge_by_executor_at, f"metrics_executor_{_of}"))
register("metric_gc_share_lookback")(_metric(RG.gc_share_at))
register("metric_ram_share_lookback")(_metric(RG.ram_share_at))


# ---- S1/S2/S5-S8/S11: captures, parquet tables, inventory, event log --------------



def captures_from_events(spark, sf_dir) -> str:
    """Write the packets projection as pcap files (one folder per class) in
    the shared checkpoint folder and return the root."""
    root = scratch_path(spark, "captures")
    frames = P.packets(events(spark, sf_dir))
    CAP.write_captures(frames, root, "class_name", order=["ts_us", "event_id"]).count()
    return root


@register("capture_scan")
def q_capture_scan(spark, sf_dir):
    """Events → pcap files → framed by byte ranges and decoded in one read → the 20 features."""
    root = captures_from_events(spark, sf_dir)
    return CAP.read_captures(spark, root, decode=fields.packet_features_of).select(*PACKET_COLUMNS)


@register("capture_ordinals")
def q_capture_ordinals(spark, sf_dir):
    """Records per capture folder with the sum of their places and of their lengths,
    read in ranges of 64 KB."""
    root = captures_from_events(spark, sf_dir)
    frames = CAP.read_captures(spark, root, range_bytes=64 << 10)
    per_file = frames.groupBy("class_name", "path", "n_in_capture").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ordinal").alias("places"), F.sum(F.length("frame")).alias("bytes"))
    right = (F.col("n") == F.col("n_in_capture")) & (F.col("places") * 2 == F.col("n") * (F.col("n") - 1))
    return per_file.groupBy("class_name").agg(F.sum("n").alias("records"), F.sum("bytes").cast("long").alias("bytes"),
                                              F.bool_and(right).alias("gapless"))


@register("capture_discovery")
def q_capture_discovery(spark, sf_dir):
    root = captures_from_events(spark, sf_dir)
    return CAP.list_captures(spark, root).groupBy("class_name").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


@register("capture_records_per_class")
def q_capture_records_per_class(spark, sf_dir):
    """Records and broken records per class folder; no frame is kept."""
    root = captures_from_events(spark, sf_dir)
    return CAP.capture_report(spark, root).groupBy("class_name").agg(
        F.sum("records").cast("bigint").alias("records"), F.sum("broken_records").cast("bigint").alias("broken_records"))


@register("file_inventory")
def q_file_inventory(spark, sf_dir):
    root = captures_from_events(spark, sf_dir)
    return DS.directory_inventory(spark, root)


@register("folder_counts")
def q_folder_counts(spark, sf_dir):
    """One file per (class, day) is written, and the tree is listed on executors: files
    directly inside each folder and in the tree below it."""
    path = scratch_path(spark, "days")
    rows = events(spark, sf_dir).select("event_id", "event_type", F.to_date("ts").alias("day"))
    rows.repartition("event_type", "day").write.option("maxRecordsPerFile", 0).partitionBy("event_type", "day").parquet(path)
    got = FO.folder_counts(spark, path)
    return got.select(F.regexp_replace(F.regexp_extract("dir", "/days-[0-9a-f]{32}(.*)$", 1), "(event_type|day)=", "").alias("folder"), "n", "n_below")


@register("parquet_round_trip")
def q_parquet_round_trip(spark, sf_dir):
    """Packet table → class-partitioned parquet → one pruned scan."""
    path = scratch_path(spark, "packets")
    DS.write_packets(fields.packet_features(P.packets(events(spark, sf_dir)), keep=["class_name"]), path)
    return DS.read_packets(spark, path)


@register("parquet_normalise")
def q_parquet_normalise(spark, sf_dir):
    """Two writes into one folder with drifting types (BIGINT features in
    one, DOUBLE in the other), read back through the normaliser."""
    path = scratch_path(spark, "foreign")
    pk = packet_table(spark, sf_dir, keep=())
    even = pk.where(F.col("CLASS") % 2 == 0)
    odd = pk.where(F.col("CLASS") % 2 == 1)
    even.select("CLASS", *[F.col(c).cast("bigint").alias(c) for c in FEATURE_COLUMNS]) \
        .write.mode("overwrite").parquet(path)
    odd.select("CLASS", *[F.col(c).cast("double").alias(c) for c in FEATURE_COLUMNS]) \
        .write.mode("append").parquet(path)
    return DS.normalise_foreign(spark, path)


@register("event_log_report")
def q_event_log_report(spark, sf_dir):
    """Executor report from this session's event log (empty when the session
    writes none): reruns a profile so the log has task rows."""
    PF.profile(packet_table(spark, sf_dir)).collect()
    conf = spark.sparkContext.getConf()
    if conf.get("spark.eventLog.enabled", "false") != "true":
        return spark.createDataFrame([], "executor_id string, tasks bigint, failed bigint, "
                                         "run_ms bigint, gc_ms bigint, wall_ms bigint")
    return DS.event_log_report(spark, conf.get("spark.eventLog.dir"))


# ---- T1-T3: streaming ---------------------------------------------------------------



def event_classes(spark, sf_dir) -> list[str]:
    """Sorted class names (one small aggregate) for streams, whose indices
    must not depend on a micro-batch."""
    return [r["class_name"] for r in class_dimension(events(spark, sf_dir), "event_type").collect()]


@register("stream_metric_windows")
def q_stream_metric_windows(spark, sf_dir):
    """1-minute driver-heap averages from the events stream, complete mode."""
    heap = MX.select_series(P.samples(SJ.events_stream(spark, sf_dir)), None,
                            [(MX.NAME, "=~", "metrics_spark_.*_driver_jvm_heap_used_Value"),
                             ("type", "=", "gauges")])
    path = SJ.run_to_table(SM.windowed_average(heap, 60), scratch_path(spark, "stream-avg"), "complete")
    return MX.round_value(SK.read_last(spark, path).select("step", "metric", "labels_json", "value"))


@register("stream_counter_deltas")
def q_stream_counter_deltas(spark, sf_dir):
    """Completed tasks by executor and 5-minute step from events that arrive up to
    eight minutes late, by a stream that is started again for each slice of them."""
    def done(arriving):
        s = MX.select_series(P.samples(arriving), "metrics_executor_completedTasks_total")
        return SM.counter_increase_stream(s, 300)

    path = SJ.run_in_arrivals(spark, P.arrivals(events(spark, sf_dir)), done, scratch_path(spark, "stream-inc"), "update")
    totals = SK.read_latest(spark, path, SM.INC_KEYS, SM.INC_OUTPUT)
    return MX.round_value(MX.sum_by(SM.increase_vector(totals), ["executor_id"]))


@register("stream_scoring")
def q_stream_scoring(spark, sf_dir):
    """Fit a tree on the batch training share and score the packet stream: packets and
    scored packets (those with a prediction) per actual class."""
    classes = event_classes(spark, sf_dir)
    data = PR.apply_null_policy(training_table(spark, sf_dir), "zero") \
        .withColumn("CLASS", F.col("CLASS").cast("double"))
    train, _ = PR.hash_split(data, ["path", "ordinal"])
    model = M.build_pipeline("decision_tree").fit(train)
    stream = PR.apply_null_policy(SJ.packets_stream(spark, sf_dir, classes), "zero")
    scored = SJ.score_stream(model, stream).select("event_id", "CLASS", "prediction")
    path = SJ.run_to_table(scored, scratch_path(spark, "stream-score"), "append")
    known = F.col("prediction").between(0, len(classes) - 1)
    return SK.read_table(spark, path, scored.schema).groupBy(F.col("CLASS").cast("int").alias("CLASS")).agg(
        F.count(F.lit(1)).alias("packets"), F.count_if(known).alias("scored"), F.count_distinct("event_id").alias("events"))


@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """New capture files → path-only file stream → index + framing per
    micro-batch → packet features table."""
    classes = event_classes(spark, sf_dir)
    root = captures_from_events(spark, sf_dir)
    path = SJ.ingest_captures(spark, root, scratch_path(spark, "stream-ingest"), classes)
    return SK.read_table(spark, path).select(*PACKET_COLUMNS)
