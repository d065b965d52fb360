"""DuckDB SQL twins, keyed like ``catalogue.REGISTRY``."""

from __future__ import annotations

from .oracle import CTE_EV, CTE_PK, CTE_RULE, FEATURE_LIST, PACKET_COLS, with_pk

SQL: dict[str, str] = {}


def _pk_select(cols: str) -> str:
    return with_pk(f"SELECT event_id, {cols} FROM pk")


SQL["packet_features"] = _pk_select(PACKET_COLS)
SQL["packet_ip_octets"] = _pk_select(", ".join(c for c in FEATURE_LIST if "_IP" in c and "LEN" not in c))
SQL["packet_ip_text_length"] = _pk_select("LEN_SRC_IP, LEN_DEST_IP")
SQL["packet_ports"] = _pk_select("TCP_SPORT, TCP_DPORT")
SQL["packet_payload_length"] = _pk_select("LEN_RAW")
SQL["packet_send_time"] = _pk_select("Send_Year, Send_Month, Send_Day, Send_Hour, Send_Minute, Send_Second")

_IP_HDR = """
  (CASE WHEN has_ip THEN ihl * 4 + (CASE WHEN is_tcp THEN 20 ELSE 8 END) + plen END)::INTEGER AS LEN,
  (CASE WHEN has_ip THEN ip_id END)::INTEGER AS ID,
  (CASE WHEN has_ip THEN 2 END)::INTEGER AS IP_FLAGS,
  (CASE WHEN has_ip THEN 0 END)::INTEGER AS FRAG,
  (CASE WHEN has_ip THEN ttl END)::INTEGER AS TTL,
  (CASE WHEN is_tcp THEN 6 WHEN has_ip THEN 17 END)::INTEGER AS PROTO,
  (CASE WHEN has_ip THEN ip_chk END)::INTEGER AS CHKSUM"""
_TCP_HDR = """
  (CASE WHEN is_tcp THEN seq END)::BIGINT AS SEQ,
  (CASE WHEN is_tcp THEN ack END)::BIGINT AS ACK,
  (CASE WHEN is_tcp THEN 5 END)::INTEGER AS DATAOFS,
  (CASE WHEN is_tcp THEN 0 END)::INTEGER AS RESERVED,
  (CASE WHEN is_tcp THEN (CASE WHEN plen > 0 THEN 24 ELSE 16 END) END)::INTEGER AS TCP_FLAGS,
  (CASE WHEN is_tcp THEN win END)::INTEGER AS WINDOW,
  (CASE WHEN is_tcp THEN tcp_chk END)::INTEGER AS CHKSUM_,
  (CASE WHEN is_tcp THEN 0 END)::INTEGER AS URGPTR"""
_MAC = """
  2::INTEGER AS DST_1,
  ((user_id >> 32) % 256)::INTEGER AS DST_2, ((user_id >> 24) % 256)::INTEGER AS DST_3,
  ((user_id >> 16) % 256)::INTEGER AS DST_4, ((user_id >> 8) % 256)::INTEGER AS DST_5,
  (user_id % 256)::INTEGER AS DST_6,
  10::INTEGER AS SRC_1,
  ((event_id >> 32) % 256)::INTEGER AS SRC_2, ((event_id >> 24) % 256)::INTEGER AS SRC_3,
  ((event_id >> 16) % 256)::INTEGER AS SRC_4, ((event_id >> 8) % 256)::INTEGER AS SRC_5,
  (event_id % 256)::INTEGER AS SRC_6,
  (CASE WHEN event_id % 11 = 5 THEN 33024 WHEN has_ip THEN 2048 ELSE 2054 END)::INTEGER AS TYPE"""
_VER = """
  (CASE WHEN is_tcp THEN 4 END)::INTEGER AS VERSION,
  (CASE WHEN is_tcp THEN ihl END)::INTEGER AS IHL"""

SQL["packet_ip_header"] = _pk_select(_IP_HDR)
SQL["packet_tcp_header"] = _pk_select(_TCP_HDR)
SQL["packet_mac_bytes"] = _pk_select(_MAC)
SQL["packet_version_ihl"] = _pk_select(_VER)
SQL["packet_features_extended"] = _pk_select(
    PACKET_COLS + "," + _VER + "," + _MAC + "," + _IP_HDR + "," + _TCP_HDR + """,
  (CASE WHEN has_ip AND plen > 0 THEN plen END)::INTEGER AS MESSAGE_LEN,
  (CASE WHEN is_tcp THEN epoch(date_trunc('second', ts)) END)::BIGINT AS TIME_TCP_EPOCH,
  (CASE WHEN is_tcp THEN (CASE WHEN plen > 0 THEN 'PA' ELSE 'A' END) END) AS TCP_FLAG_LETTERS,
  'Ethernet' AS NAME""")
SQL["packet_layer_flags"] = _pk_select("has_ip, is_tcp AS has_tcp, (has_ip AND plen > 0) AS has_raw")

SQL["ip_text_parse"] = "WITH " + CTE_RULE + """,
t AS (
  SELECT event_id, s1, s2, s3, s4, concat_ws('.', s1, s2, s3, s4) AS good,
    CASE WHEN event_id % 9 = 0 THEN '256.' || concat_ws('.', s1, s2, s3, s4)
         WHEN event_id % 9 = 1 THEN concat_ws('.', s1, s2)
         WHEN event_id % 9 = 2 THEN '0' || concat_ws('.', s1, s2, s3, s4)
         WHEN event_id % 9 = 3 THEN concat_ws('.', s1, s2, s3, s4) || '.'
         ELSE concat_ws('.', s1, s2, s3, s4) END AS ip_text,
    event_id % 9 IN (0, 1, 2, 3) AS bad
  FROM rule
)
SELECT event_id, ip_text,
  (CASE WHEN NOT bad THEN s1 END)::INTEGER AS IP1, (CASE WHEN NOT bad THEN s2 END)::INTEGER AS IP2,
  (CASE WHEN NOT bad THEN s3 END)::INTEGER AS IP3, (CASE WHEN NOT bad THEN s4 END)::INTEGER AS IP4
FROM t"""


# ---- labels, subsets, unions, prefix samples ---------------------------------

SQL["class_index"] = "WITH " + CTE_PK + "\nSELECT DISTINCT class_name, CLASS FROM pk"
SQL["label_double"] = _pk_select("CLASS::DOUBLE AS CLASS")
SQL["class_union"] = _pk_select(PACKET_COLS)
SQL["class_subset"] = with_pk(f"SELECT event_id, class_name, {PACKET_COLS} FROM pk "
                              "WHERE class_name IN ('click', 'purchase', 'view')")

_POS = """,
pos AS (
  SELECT *, (row_number() OVER (PARTITION BY path ORDER BY ts, event_id) - 1)::BIGINT AS ordinal,
         count(*) OVER (PARTITION BY path) AS n_in_capture
  FROM pk
)"""


def _with_pos(body: str) -> str:
    return "WITH " + CTE_PK + _POS + "\n" + body


for _pct in (20, 40, 60, 80):
    SQL[f"prefix_sample_{_pct}"] = _with_pos(
        f"SELECT event_id, path, ordinal, n_in_capture, CLASS FROM pos WHERE ordinal < (n_in_capture * {_pct}) // 100")
SQL["prefix_sample_20_compat"] = _with_pos(
    "SELECT event_id, path, ordinal, n_in_capture, CLASS FROM pos WHERE ordinal <= (n_in_capture * 20) // 100")
SQL["packets_per_capture"] = with_pk("SELECT path, count(*) AS packets FROM pk GROUP BY path")

# ---- profile, box statistics, nulls, min-max -----------------------------------

SQL["dataset_profile"] = with_pk("SELECT count(*) AS rows, 20 AS columns, count(DISTINCT CLASS) AS classes FROM pk")
SQL["distinct_classes"] = with_pk("SELECT DISTINCT CLASS FROM pk")

_LONG = ",\nlong AS (\n" + "\n  UNION ALL ".join(
    f"SELECT event_id, '{c}' AS feature, {c}::DOUBLE AS value FROM pk WHERE {c} IS NOT NULL"
    for c in FEATURE_LIST) + "\n)"
_Q = """,
q AS (
  SELECT feature, count(*) AS n, min(value) AS mn, max(value) AS mx,
         quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
         quantile_cont(value, 0.75) AS q3
  FROM long GROUP BY feature
),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM q)"""
_BOX = """
SELECT f.feature, n, round(mn, 6) AS min, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(mx, 6) AS max, round(iqr, 6) AS iqr,
       round(min(CASE WHEN l.value >= lo_fence THEN l.value END), 6) AS whisker_lo,
       round(max(CASE WHEN l.value <= hi_fence THEN l.value END), 6) AS whisker_hi,
       count(*) FILTER (WHERE l.value < lo_fence OR l.value > hi_fence) AS fliers
FROM f JOIN long l USING (feature)
GROUP BY f.feature, n, mn, q1, median, q3, mx, iqr"""
_FLIERS = """
SELECT l.feature, l.value, count(*) AS n
FROM long l JOIN f USING (feature)
WHERE l.value < lo_fence OR l.value > hi_fence
GROUP BY l.feature, l.value"""
SQL["box_statistics"] = "WITH " + CTE_PK + _LONG + _Q + _BOX
SQL["box_fliers"] = "WITH " + CTE_PK + _LONG + _Q + _FLIERS
SQL["box_statistics_unbounded"] = "WITH " + CTE_PK + """,
long AS (
  SELECT 'SEQ' AS feature, seq::DOUBLE AS value FROM pk WHERE is_tcp
  UNION ALL SELECT 'ACK' AS feature, ack::DOUBLE AS value FROM pk WHERE is_tcp
)""" + _Q + _BOX
SQL["box_fliers_unbounded"] = """WITH
long AS (SELECT 'value' AS feature, value FROM events WHERE value IS NOT NULL)""" + _Q + _FLIERS

SQL["null_policy_skip"] = with_pk(f"SELECT event_id, {PACKET_COLS} FROM pk WHERE " +
                                  " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_LIST))
SQL["null_policy_zero"] = with_pk("SELECT event_id, CLASS, " +
                                  ", ".join(f"coalesce({c}, 0)::INTEGER AS {c}" for c in FEATURE_LIST) + " FROM pk")
SQL["null_policy_counts"] = with_pk("\n  UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) AS rows FROM pk"
    for c in FEATURE_LIST))
SQL["minmax_summary"] = with_pk("\n  UNION ALL ".join(
    f"SELECT '{c}' AS feature, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM pk" for c in FEATURE_LIST))
SQL["minmax_scaled"] = "WITH " + CTE_PK + ",\nmm AS (SELECT " + ", ".join(
    f"min({c})::DOUBLE AS mn_{c}, max({c})::DOUBLE AS mx_{c}" for c in FEATURE_LIST) + " FROM pk)\nSELECT event_id, " + \
    ", ".join(f"round(CASE WHEN mx_{c} = mn_{c} THEN (CASE WHEN {c} IS NOT NULL THEN 0.5 END) "
              f"ELSE ({c} - mn_{c}) / (mx_{c} - mn_{c}) END, 6) AS {c}" for c in FEATURE_LIST) + \
    " FROM pk, mm"

# ---- key-hash split -------------------------------------------------------------

_BUCKET = "((('0x' || substr(md5('42:' || path || ':' || ordinal::VARCHAR), 1, 8))::BIGINT) % 100)::INTEGER"
SQL["hash_split"] = _with_pos(f"SELECT event_id, path, ordinal, {_BUCKET} AS bucket, {_BUCKET} < 80 AS is_train FROM pos")
SQL["hash_split_counts"] = _with_pos(f"SELECT {_BUCKET} < 80 AS is_train, count(*) AS rows FROM pos GROUP BY 1")

SQL["train_confusion"] = _with_pos(f"""SELECT CLASS, count(*) AS test_rows, count(*) AS predicted FROM pos
WHERE {_BUCKET} >= 80 AND {' AND '.join(f'{c} IS NOT NULL' for c in FEATURE_LIST)} GROUP BY CLASS""")

# ---- evaluation over the predictions projection ---------------------------------

CTE_PRED = CTE_EV + """,
pred AS (
  SELECT event_id, CLASS::DOUBLE AS label,
    (CASE WHEN floor(value)::BIGINT % 10 < 6 THEN CLASS
          WHEN floor(value)::BIGINT % 10 < 8 THEN (CLASS + 1) % 5
          WHEN floor(value)::BIGINT % 10 < 9 THEN 0 ELSE 9 END)::DOUBLE AS prediction
  FROM ev
),
conf AS (SELECT label, prediction, count(*) AS n FROM pred GROUP BY label, prediction),
cls AS (
  SELECT c AS class,
    coalesce((SELECT sum(n) FROM conf WHERE label = c), 0)::BIGINT AS support,
    coalesce((SELECT sum(n) FROM conf WHERE prediction = c), 0)::BIGINT AS predicted,
    coalesce((SELECT sum(n) FROM conf WHERE label = c AND prediction = c), 0)::BIGINT AS tp
  FROM (SELECT label AS c FROM conf UNION SELECT prediction FROM conf)
),
sc AS (
  SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
            CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall
  FROM cls
),
sc2 AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
  FROM sc
)"""

SQL["confusion_long"] = "WITH " + CTE_PRED + "\nSELECT label, prediction, n FROM conf"
SQL["confusion_grid"] = "WITH " + CTE_PRED + "\nSELECT label, " + ", ".join(
    f"sum(CASE WHEN prediction = {k} THEN n ELSE 0 END)::BIGINT AS p_{k}" for k in (0, 1, 2, 3, 4, 9)) + \
    " FROM conf GROUP BY label"
SQL["confusion_rows"] = "WITH " + CTE_PRED + """,
axis AS (SELECT class, row_number() OVER (ORDER BY class) - 1 AS position FROM cls)
SELECT label, l.position, sum(n)::BIGINT AS total, string_agg(p.position || ':' || n, ',' ORDER BY p.position) AS cells
FROM conf JOIN axis l ON l.class = label JOIN axis p ON p.class = prediction
GROUP BY label, l.position"""
SQL["class_scores"] = "WITH " + CTE_PRED + """
SELECT class, support, predicted, tp, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1 FROM sc2"""
SQL["weighted_scores"] = "WITH " + CTE_PRED + """
SELECT sum(support)::BIGINT AS n, round(sum(tp) / sum(support), 6) AS accuracy,
       round(sum(support * precision) / sum(support), 6) AS weighted_precision,
       round(sum(support * recall) / sum(support), 6) AS weighted_recall,
       round(sum(support * f1) / sum(support), 6) AS f1
FROM sc2"""


# ---- metric questions over the samples projection ---------------------------------

CTE_SM = CTE_EV + """,
b AS (
  SELECT ts, event_id, event_type, floor(value * 100)::DOUBLE AS value, user_id % 10 AS ex,
    CASE WHEN user_id % 10 = 9 THEN 'driver' ELSE (user_id % 10)::VARCHAR END AS exl,
    ((floor(epoch_us(ts) / 60000000)::BIGINT * (user_id % 10 + 1)) % 1000)::DOUBLE AS counter,
    CASE WHEN user_id % 10 < 8 THEN 'spark-exec-' || (user_id % 10)::VARCHAR
         ELSE 'web-' || (user_id % 10)::VARCHAR END AS pod,
    CASE WHEN user_id % 10 = 9 THEN 'kube' ELSE 'default' END AS ns
  FROM ev
),
sm AS (
  SELECT ts, 'metrics_executor_completedTasks_total' AS metric, exl AS executor_id, NULL AS pod, NULL AS namespace, NULL AS type, NULL AS node, counter AS value, event_id * 16 + 0 AS sample_id FROM b WHERE event_type = 'view'
  UNION ALL SELECT ts, 'metrics_executor_totalTasks_total', exl, NULL, NULL, NULL, NULL, counter * 2, event_id * 16 + 1 FROM b WHERE event_type = 'click'
  UNION ALL SELECT ts, 'metrics_executor_totalGCTime_seconds_total', exl, NULL, NULL, NULL, NULL, counter, event_id * 16 + 2 FROM b WHERE event_type = 'purchase'
  UNION ALL SELECT ts, 'metrics_executor_totalDuration_seconds_total', exl, NULL, NULL, NULL, NULL, counter * 10, event_id * 16 + 3 FROM b WHERE event_type = 'signup'
  UNION ALL SELECT ts, 'metrics_executor_JVMHeapMemory_bytes', exl, NULL, NULL, NULL, NULL, value, event_id * 16 + 4 FROM b WHERE event_type = 'error'
  UNION ALL SELECT ts, 'metrics_executor_JVMOffHeapMemory_bytes', exl, NULL, NULL, NULL, NULL, floor(value / 2), event_id * 16 + 5 FROM b WHERE event_type IN ('error', 'view')
  UNION ALL SELECT ts, 'metrics_executor_usedOnHeapStorageMemory_bytes', exl, NULL, NULL, NULL, NULL, value, event_id * 16 + 6 FROM b WHERE event_type = 'click'
  UNION ALL SELECT ts, 'container_cpu_usage_seconds_total', NULL, pod, ns, NULL, NULL, counter, event_id * 16 + 7 FROM b
  UNION ALL SELECT ts, 'container_memory_usage_bytes', NULL, pod, ns, NULL, NULL, value, event_id * 16 + 8 FROM b
  UNION ALL SELECT ts, 'metrics_spark_app_driver_jvm_heap_used_Value', NULL, NULL, NULL, 'gauges', NULL, value, event_id * 16 + 9 FROM b WHERE ex = 9 AND event_id % 2 = 0
  UNION ALL SELECT ts, 'metrics_spark_job_driver_jvm_heap_used_Value', NULL, NULL, NULL, 'gauges', NULL, value, event_id * 16 + 10 FROM b WHERE ex = 9 AND event_id % 2 = 1
  UNION ALL SELECT ts, 'metrics_spark_app_driver_jvm_heap_used_Value', NULL, NULL, NULL, 'counters', NULL, value, event_id * 16 + 11 FROM b WHERE ex = 9 AND event_id % 3 = 0
  UNION ALL SELECT ts, 'machine_memory_bytes', NULL, NULL, NULL, NULL, (event_id % 2)::VARCHAR, (event_id % 2 + 1) * 1000.0, event_id * 16 + 12 FROM b
  UNION ALL SELECT ts, 'machine_cpu_cores', NULL, NULL, NULL, NULL, (event_id % 2)::VARCHAR, (event_id % 2 + 1) * 4.0, event_id * 16 + 13 FROM b
),
s5 AS (SELECT *, floor(epoch_us(ts) / 300000000)::BIGINT AS step FROM sm),
s1 AS (SELECT *, floor(epoch_us(ts) / 60000000)::BIGINT AS step FROM sm),
last5 AS (
  SELECT step, metric, executor_id, pod, namespace, type, node,
         arg_max(value, (ts, sample_id)) AS value
  FROM s5 GROUP BY ALL
),
inc5 AS (
  SELECT step, metric, executor_id, pod, namespace, type, node,
         sum(CASE WHEN prev IS NULL THEN 0 WHEN value >= prev THEN value - prev ELSE value END) AS value
  FROM (SELECT *, lag(value) OVER (PARTITION BY metric, executor_id, pod, namespace, type, node, step
                                   ORDER BY ts, sample_id) AS prev FROM s5)
  GROUP BY ALL
)"""


def _sm(body: str) -> str:
    return "WITH " + CTE_SM + "\n" + body


def _by_exec_last(metric: str) -> str:
    return _sm(f"SELECT step, executor_id, round(sum(value), 6) AS value FROM last5 "
               f"WHERE metric = '{metric}' GROUP BY step, executor_id")


SQL["metric_completed_share"] = _sm("""
SELECT n.step, n.executor_id, round(CASE WHEN d.value = 0 THEN NULL ELSE n.value / d.value END, 6) AS value
FROM (SELECT step, executor_id, sum(value) AS value FROM inc5
      WHERE metric = 'metrics_executor_completedTasks_total' AND executor_id <> 'driver' GROUP BY ALL) n
JOIN (SELECT step, executor_id, sum(value) AS value FROM last5
      WHERE metric = 'metrics_executor_totalTasks_total' AND executor_id <> 'driver' GROUP BY ALL) d
USING (step, executor_id)""")
SQL["metric_cpu_rate"] = _sm("""
SELECT step, pod, round(sum(value / 300.0), 6) AS value FROM inc5
WHERE metric = 'container_cpu_usage_seconds_total' AND namespace = 'default' GROUP BY step, pod""")
SQL["metric_memory_by_pod"] = _sm("""
SELECT step, pod, round(sum(value), 6) AS value FROM last5
WHERE metric = 'container_memory_usage_bytes' AND namespace = 'default' GROUP BY step, pod""")
SQL["metric_heap_avg_1m"] = _sm("""
SELECT step, metric, '{"type":"' || type || '"}' AS labels_json, round(avg(value), 6) AS value FROM s1
WHERE regexp_full_match(metric, 'metrics_spark_.*_driver_jvm_heap_used_Value') AND type = 'gauges'
GROUP BY step, metric, type""")
SQL["metric_heap"] = _by_exec_last("metrics_executor_JVMHeapMemory_bytes")
SQL["metric_storage_heap"] = _by_exec_last("metrics_executor_usedOnHeapStorageMemory_bytes")
SQL["metric_task_balance"] = _sm("""
SELECT step, executor_id, round(sum(value), 6) AS value FROM inc5
WHERE metric = 'metrics_executor_completedTasks_total' GROUP BY step, executor_id""")
SQL["metric_gc_total"] = _by_exec_last("metrics_executor_totalGCTime_seconds_total")
SQL["metric_duration_total"] = _by_exec_last("metrics_executor_totalDuration_seconds_total")
SQL["metric_tasks_total"] = _by_exec_last("metrics_executor_totalTasks_total")
SQL["metric_gc_share"] = _sm("""
SELECT g.step, g.executor_id, round(CASE WHEN d.value = 0 THEN NULL ELSE g.value / d.value END * 100.0, 6) AS value
FROM (SELECT step, executor_id, sum(value) AS value FROM last5
      WHERE metric = 'metrics_executor_totalGCTime_seconds_total' GROUP BY ALL) g
JOIN (SELECT step, executor_id, sum(value) AS value FROM last5
      WHERE metric = 'metrics_executor_totalDuration_seconds_total' GROUP BY ALL) d
USING (step, executor_id)""")
SQL["metric_ram_share"] = _sm("""
SELECT h.step, round(CASE WHEN m.value = 0 THEN NULL ELSE h.value / m.value END, 6) AS value
FROM (SELECT a.step, sum(a.value + o.value) AS value
      FROM (SELECT * FROM last5 WHERE metric = 'metrics_executor_JVMHeapMemory_bytes') a
      JOIN (SELECT * FROM last5 WHERE metric = 'metrics_executor_JVMOffHeapMemory_bytes') o
      USING (step, executor_id) GROUP BY a.step) h
JOIN (SELECT step, sum(value) AS value FROM last5 WHERE metric = 'machine_memory_bytes' GROUP BY step) m
USING (step)""")
SQL["metric_cpu_share"] = _sm("""
SELECT c.step, round(CASE WHEN k.value = 0 THEN NULL ELSE c.value / k.value END, 6) AS value
FROM (SELECT step, sum(value / 300.0) AS value FROM inc5
      WHERE metric = 'container_cpu_usage_seconds_total' AND namespace = 'default'
        AND regexp_full_match(pod, 'spark.*') GROUP BY step) c
JOIN (SELECT step, sum(value) AS value FROM last5 WHERE metric = 'machine_cpu_cores' GROUP BY step) k
USING (step)""")

SQL["capture_scan"] = with_pk(f"SELECT {PACKET_COLS} FROM pk")
SQL["parquet_round_trip"] = with_pk(f"SELECT {PACKET_COLS}, class_name FROM pk")
SQL["folder_counts"] = """
WITH days AS (SELECT DISTINCT event_type, ts::DATE AS day FROM events)
SELECT '/' || event_type || '/' || day::VARCHAR AS folder, 1::BIGINT AS n, 1::BIGINT AS n_below FROM days
UNION ALL SELECT '/' || event_type, 0, count(*) FROM days GROUP BY event_type
UNION ALL SELECT '', 0, count(*) FROM days"""
SQL["parquet_normalise"] = with_pk(f"SELECT {PACKET_COLS} FROM pk")
SQL["stream_metric_windows"] = SQL["metric_heap_avg_1m"]
SQL["stream_counter_deltas"] = SQL["metric_task_balance"]
SQL["stream_scoring"] = "WITH " + CTE_EV + "\nSELECT CLASS, count(*) AS packets, count(*) AS scored, count(DISTINCT event_id) AS events FROM ev GROUP BY CLASS"
SQL["stream_ingest"] = with_pk(f"SELECT {PACKET_COLS} FROM pk")
SQL["capture_records_per_class"] = ("SELECT event_type AS class_name, count(*) AS records, 0::BIGINT AS broken_records "
                                    "FROM events GROUP BY event_type")
SQL["capture_ordinals"] = with_pk("""
SELECT class_name, count(*) AS records, true AS gapless,
  sum(greatest(60, 14 + (CASE WHEN event_id % 11 = 5 THEN 4 ELSE 0 END)
    + (CASE WHEN has_ip THEN ihl * 4 + (CASE WHEN is_tcp THEN 20 ELSE 8 END) + plen ELSE 28 END)))::BIGINT AS bytes
FROM pk GROUP BY class_name""")

SQL["metric_cpu_rate_extrapolated"] = _sm("""
, g AS (
  SELECT step, pod,
    sum(CASE WHEN prev IS NULL THEN 0 WHEN value >= prev THEN value - prev ELSE value END) AS raw,
    count(*) AS n, arg_min(value, (ts, sample_id)) AS first_v,
    epoch_us(min(ts)) / 1e6 AS first_t, epoch_us(max(ts)) / 1e6 AS last_t
  FROM (SELECT *, lag(value) OVER (PARTITION BY metric, namespace, pod, step ORDER BY ts, sample_id) AS prev
        FROM s5 WHERE metric = 'container_cpu_usage_seconds_total' AND namespace = 'default')
  GROUP BY step, pod
), e AS (
  SELECT *, last_t - first_t AS sampled, (last_t - first_t) / (n - 1) AS avg_gap,
    CASE WHEN raw > 0 AND first_v >= 0 THEN (last_t - first_t) * (first_v / raw) END AS to_zero,
    first_t - step * 300 AS to_start0, (step * 300 + 300) - last_t AS to_end
  FROM g WHERE n >= 2 AND last_t - first_t > 0
), f AS (
  SELECT *, CASE WHEN to_zero IS NOT NULL AND to_zero < to_start0 THEN to_zero ELSE to_start0 END AS to_start
  FROM e
)
SELECT step, pod, round(sum(raw * ((sampled
    + CASE WHEN to_start < avg_gap * 1.1 THEN to_start ELSE avg_gap / 2 END
    + CASE WHEN to_end < avg_gap * 1.1 THEN to_end ELSE avg_gap / 2 END) / sampled) / 300.0), 6) AS value
FROM f GROUP BY step, pod""")

# ---- ranges at a free step: every window holds its own copy of its samples here -----

_SERIES = "metric, executor_id, pod, namespace, type, node"


def _windows(name: str, where: str, reach: int, every: int) -> str:
    """CTEs ``name``_inc, ``name``_avg and ``name``_last: one row per series and step
    whose window (step * every - reach, step * every] holds a sample."""
    us = 1_000_000
    return f""",
{name} AS (
  SELECT *, unnest(generate_series((epoch_us(ts) + {every * us} - 1) // {every * us}, (epoch_us(ts) + {reach * us} - 1) // {every * us})) AS step
  FROM sm WHERE {where}
),
{name}_inc AS (
  SELECT step, {_SERIES}, sum(CASE WHEN prev IS NULL THEN 0 WHEN value >= prev THEN value - prev ELSE value END) AS value,
    count(*) AS n, arg_min(value, (ts, sample_id)) AS first_v, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us
  FROM (SELECT *, lag(value) OVER (PARTITION BY {_SERIES}, step ORDER BY ts, sample_id) AS prev FROM {name})
  GROUP BY ALL
),
{name}_avg AS (SELECT step, {_SERIES}, avg(value) AS value FROM {name} GROUP BY ALL),
{name}_last AS (SELECT step, {_SERIES}, arg_max(value, (ts, sample_id)) AS value FROM {name} GROUP BY ALL)"""


_CPU = "metric = 'container_cpu_usage_seconds_total' AND namespace = 'default'"
_DONE = "metric = 'metrics_executor_completedTasks_total'"
_NO_DRIVER = " AND executor_id <> 'driver'"

SQL["metric_completed_share_sliding"] = _sm(
    _windows("d", _DONE + _NO_DRIVER, 300, 15) + _windows("t", "metric = 'metrics_executor_totalTasks_total'" + _NO_DRIVER, 300, 15) + """
SELECT n.step, n.executor_id, round(CASE WHEN d.value = 0 THEN NULL ELSE n.value / d.value END, 6) AS value
FROM (SELECT step, executor_id, sum(value) AS value FROM d_inc GROUP BY ALL) n
JOIN (SELECT step, executor_id, sum(value) AS value FROM t_last GROUP BY ALL) d USING (step, executor_id)""")
SQL["metric_cpu_rate_sliding"] = _sm(_windows("c", _CPU, 300, 15) + """
SELECT step, pod, round(sum(value / 300.0), 6) AS value FROM c_inc GROUP BY step, pod""")
SQL["metric_cpu_rate_sliding_extrapolated"] = _sm(_windows("c", _CPU, 300, 15) + """,
e AS (
  SELECT *, (last_us - first_us) / 1e6 AS sampled, (last_us - first_us) / 1e6 / (n - 1) AS gap, (step * 15000000 - last_us) / 1e6 AS to_end,
    least((first_us - (step * 15000000 - 300000000)) / 1e6,
          CASE WHEN value > 0 AND first_v >= 0 THEN (last_us - first_us) / 1e6 * (first_v / value) END) AS to_start
  FROM c_inc WHERE n >= 2 AND last_us > first_us
)
SELECT step, pod, round(sum(value * ((sampled + CASE WHEN to_start < gap * 1.1 THEN to_start ELSE gap / 2 END
  + CASE WHEN to_end < gap * 1.1 THEN to_end ELSE gap / 2 END) / sampled) / 300.0), 6) AS value
FROM e GROUP BY step, pod""")
SQL["metric_heap_avg_sliding"] = _sm(_windows("h", "regexp_full_match(metric, 'metrics_spark_.*_driver_jvm_heap_used_Value') AND type = 'gauges'", 60, 15) + """
SELECT step, metric, '{"type":"' || type || '"}' AS labels_json, round(value, 6) AS value FROM h_avg""")
SQL["metric_task_balance_sliding"] = _sm(_windows("d", _DONE, 300, 15) + """
SELECT step, executor_id, round(sum(value), 6) AS value FROM d_inc GROUP BY step, executor_id""")
SQL["metric_cpu_share_sliding"] = _sm(
    _windows("c", _CPU + " AND regexp_full_match(pod, 'spark.*')", 300, 15) + _windows("k", "metric = 'machine_cpu_cores'", 300, 15) + """
SELECT c.step, round(CASE WHEN k.value = 0 THEN NULL ELSE c.value / k.value END, 6) AS value
FROM (SELECT step, sum(value / 300.0) AS value FROM c_inc GROUP BY step) c
JOIN (SELECT step, sum(value) AS value FROM k_last GROUP BY step) k USING (step)""")
SQL["metric_memory_by_pod_lookback"] = _sm(_windows("m", "metric = 'container_memory_usage_bytes' AND namespace = 'default'", 300, 60) + """
SELECT step, pod, round(sum(value), 6) AS value FROM m_last GROUP BY step, pod""")
for _name, _of in (("heap", "JVMHeapMemory_bytes"), ("storage_heap", "usedOnHeapStorageMemory_bytes"), ("gc_total", "totalGCTime_seconds_total"),
                   ("duration_total", "totalDuration_seconds_total"), ("tasks_total", "totalTasks_total")):
    SQL[f"metric_{_name}_lookback"] = _sm(_windows("m", f"metric = 'metrics_executor_{_of}'", 300, 60) + """
SELECT step, executor_id, round(sum(value), 6) AS value FROM m_last GROUP BY step, executor_id""")
SQL["metric_gc_share_lookback"] = _sm(
    _windows("g", "metric = 'metrics_executor_totalGCTime_seconds_total'", 300, 60)
    + _windows("d", "metric = 'metrics_executor_totalDuration_seconds_total'", 300, 60) + """
SELECT g.step, g.executor_id, round(CASE WHEN d.value = 0 THEN NULL ELSE g.value / d.value END * 100.0, 6) AS value
FROM (SELECT step, executor_id, sum(value) AS value FROM g_last GROUP BY ALL) g
JOIN (SELECT step, executor_id, sum(value) AS value FROM d_last GROUP BY ALL) d USING (step, executor_id)""")
SQL["metric_ram_share_lookback"] = _sm(
    _windows("h", "metric = 'metrics_executor_JVMHeapMemory_bytes'", 300, 60)
    + _windows("o", "metric = 'metrics_executor_JVMOffHeapMemory_bytes'", 300, 60) + _windows("m", "metric = 'machine_memory_bytes'", 300, 60) + """
SELECT h.step, round(CASE WHEN m.value = 0 THEN NULL ELSE h.value / m.value END, 6) AS value
FROM (SELECT step, sum(h_last.value + o_last.value) AS value FROM h_last JOIN o_last USING (step, executor_id) GROUP BY step) h
JOIN (SELECT step, sum(value) AS value FROM m_last GROUP BY step) m USING (step)""")
