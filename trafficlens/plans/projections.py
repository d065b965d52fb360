"""Deterministic projections of the driver's ``events`` table into the three
inputs the reference's jobs read: framed packets, metric samples and
predictions. Every rule is a row-level Column expression (one scan, no
shuffle), and is written the same way in the DuckDB oracle, so the decoders
and operators downstream are checked against values fixed by construction.

Rules (e = event_id, u = user_id, c = class index of event_type):
  * IPv4 unless e % 50 = 0 (then an ARP frame); UDP instead of TCP when
    e % 10 = 7; 802.1Q tag when e % 11 = 5; IP options (IHL 6) when e % 7 = 3;
    payload of 100*c + floor(value) % 150 bytes unless e % 3 = 0;
    destination port 443 when e % 5 = 0 else 8000 + c (5000 + c for UDP).
  * capture file = one per user, ``capture-<u>.pcap``; order by (ts, e).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.labels import attach_class_index


def _hx(x: Column, width: int) -> Column:
    return F.lpad(F.hex(x.cast("bigint")), width, "0")


def utc_instant(ntz: Column) -> Column:
    """A TIMESTAMP_NTZ wall clock read as UTC, as a TIMESTAMP — by calendar
    arithmetic, so the result does not depend on the session time zone."""
    day_us = F.unix_date(F.to_date(ntz)).cast("bigint") * 86_400_000_000
    tod_us = (F.hour(ntz) * 3600 + F.minute(ntz) * 60).cast("bigint") * 1_000_000 \
        + (F.date_part(F.lit("SECOND"), ntz) * 1_000_000).cast("bigint")
    return F.timestamp_micros(day_us + tod_us)


def events_with_class(events: DataFrame, classes: list[str] | None = None) -> DataFrame:
    return attach_class_index(events, "event_type", out="CLASS", classes=classes)


def packet_rule_columns(e: Column, u: Column, c: Column, v: Column) -> dict[str, Column]:
    has_ip = (e % 50) != 0
    tcp = has_ip & ((e % 10) != 7)
    udp = has_ip & ((e % 10) == 7)
    ihl = F.when((e % 7) == 3, F.lit(6)).otherwise(F.lit(5))
    plen = F.when((e % 3) == 0, F.lit(0)).otherwise(c * 100 + F.floor(v).cast("bigint") % 150)
    return {
        "has_ip": has_ip, "tcp": tcp, "udp": udp, "vlan": (e % 11) == 5, "ihl": ihl, "plen": plen,
        "s1": (u % 3) * 81 + 10, "s2": u % 256, "s3": F.floor(e / 256) % 256, "s4": e % 256,
        "d1": (e * 13) % 224, "d2": (u * 7) % 256, "d3": e % 100, "d4": (e + u) % 256,
        "sport": (e * 37) % 60000 + 1024,
        "dport": F.when(udp, c + 5000).when((e % 5) == 0, F.lit(443)).otherwise(c + 8000),
        "seq": (e * 2654435761) % 4294967296, "ack": (u * 40503 + e * 7) % 4294967296,
        "flags": F.when(plen > 0, F.lit(24)).otherwise(F.lit(16)),
        "window": (e * 101) % 65536, "tcp_chk": (e * 3) % 65536,
        "ip_id": e % 65536, "ttl": u % 64 + 32, "ip_chk": (e * 7) % 65536, "udp_chk": (e * 5) % 65536,
    }


def packets(events: DataFrame, classes: list[str] | None = None) -> DataFrame:
    """Framed records ``(path, ts, linktype, orig_len, frame, event_id,
    user_id, class_name, CLASS)`` built from events; no shuffle beyond the
    class dimension."""
    ev = events_with_class(events, classes)
    e, u, c, v = F.col("event_id"), F.col("user_id"), F.col("CLASS"), F.col("value")
    r = packet_rule_columns(e, u, c, v)
    l4_len = F.when(r["tcp"], F.lit(20)).otherwise(F.lit(8))
    ip_total = r["ihl"] * 4 + l4_len + r["plen"]
    mac = F.concat(F.lit("02"), _hx(u, 10), F.lit("0A"), _hx(e, 10))
    vlan = F.when(r["vlan"], F.concat(F.lit("8100"), _hx(u % 4096, 4))).otherwise(F.lit(""))
    ip = F.concat(
        _hx(r["ihl"] + 64, 2), F.lit("00"), _hx(ip_total, 4), _hx(r["ip_id"], 4), F.lit("4000"),
        _hx(r["ttl"], 2), F.when(r["tcp"], F.lit("06")).otherwise(F.lit("11")), _hx(r["ip_chk"], 4),
        _hx(r["s1"], 2), _hx(r["s2"], 2), _hx(r["s3"], 2), _hx(r["s4"], 2),
        _hx(r["d1"], 2), _hx(r["d2"], 2), _hx(r["d3"], 2), _hx(r["d4"], 2),
        F.when(r["ihl"] == 6, F.lit("01010100")).otherwise(F.lit("")),
    )
    tcp = F.concat(_hx(r["sport"], 4), _hx(r["dport"], 4), _hx(r["seq"], 8), _hx(r["ack"], 8),
                   F.lit("50"), _hx(r["flags"], 2), _hx(r["window"], 4), _hx(r["tcp_chk"], 4), F.lit("0000"))
    udp = F.concat(_hx(r["sport"], 4), _hx(r["dport"], 4), _hx(r["plen"] + 8, 4), _hx(r["udp_chk"], 4))
    payload = F.repeat(_hx(e % 256, 2), r["plen"].cast("int"))
    arp = F.concat(F.lit("0001080006040001"), F.lit("0A"), _hx(e, 10), F.lit("0A000001"),
                   F.lit("000000000000"), F.lit("0A000002"))
    body = F.when(r["has_ip"], F.concat(F.lit("0800"), ip, F.when(r["tcp"], tcp).otherwise(udp), payload)) \
        .otherwise(F.concat(F.lit("0806"), arp))
    # Ethernet minimum of 60 bytes: pad short frames with zeros
    size = F.when(r["vlan"], F.lit(18)).otherwise(F.lit(14)) + \
        F.when(r["has_ip"], ip_total).otherwise(F.lit(28))
    pad = F.repeat(F.lit("00"), F.greatest(F.lit(60) - size, F.lit(0)).cast("int"))
    frame = F.unhex(F.concat(mac, vlan, body, pad))
    return ev.select(
        F.concat(F.lit("capture-"), u.cast("string"), F.lit(".pcap")).alias("path"),
        utc_instant(F.col("ts")).alias("ts"),
        F.lit(1).alias("linktype"),
        F.length(frame).alias("orig_len"),
        frame.alias("frame"),
        e.alias("event_id"), u.alias("user_id"),
        F.col("event_type").alias("class_name"), c.alias("CLASS"),
    )


def samples(events: DataFrame) -> DataFrame:
    """Metric samples ``(ts, metric, labels, value, sample_id)`` from one scan
    of events: each event emits several samples through one generator.

    executor ex = user_id % 10 (9 = driver). Counters grow with time inside a
    series and wrap at 1000 (so resets occur): floor(epoch/60)*(1+ex) % 1000.
    """
    e, u = F.col("event_id"), F.col("user_id")
    et = F.col("event_type")
    ex = u % 10
    ex_label = F.when(ex == 9, F.lit("driver")).otherwise(ex.cast("string"))
    minute = F.floor(F.unix_micros(utc_instant(F.col("ts"))) / 60000000)
    counter = ((minute * (ex + 1)) % 1000).cast("double")
    # gauges are whole byte counts (exact sums in any order)
    val = F.floor(F.col("value") * 100).cast("double")
    pod = F.when(ex < 8, F.concat(F.lit("spark-exec-"), ex.cast("string"))) \
        .otherwise(F.concat(F.lit("web-"), ex.cast("string")))
    ns = F.when(ex == 9, F.lit("kube")).otherwise(F.lit("default"))
    node = (e % 2).cast("string")

    def s(metric, labels: dict, value: Column, cond: Column | None = None, k: int = 0):
        lab = F.create_map(*[x for kv in labels.items() for x in (F.lit(kv[0]), kv[1])])
        st = F.struct(F.lit(metric).alias("metric"), lab.alias("labels"),
                      value.cast("double").alias("value"), (e * 16 + k).alias("sample_id"))
        return F.when(cond, st) if cond is not None else st

    exl = {"executor_id": ex_label}
    gen = F.array(
        # Executor counters fed by one event type each.
        s("metrics_executor_completedTasks_total", exl, counter, et == "view", 0),
        s("metrics_executor_totalTasks_total", exl, counter * 2, et == "click", 1),
        s("metrics_executor_totalGCTime_seconds_total", exl, counter, et == "purchase", 2),
        s("metrics_executor_totalDuration_seconds_total", exl, counter * 10, et == "signup", 3),
        # Executor gauges.
        s("metrics_executor_JVMHeapMemory_bytes", exl, val, et == "error", 4),
        s("metrics_executor_JVMOffHeapMemory_bytes", exl, F.floor(val / 2), et.isin("error", "view"), 5),
        s("metrics_executor_usedOnHeapStorageMemory_bytes", exl, val, et == "click", 6),
        # container counters / gauges by pod
        s("container_cpu_usage_seconds_total", {"namespace": ns, "pod": pod}, counter, None, 7),
        s("container_memory_usage_bytes", {"namespace": ns, "pod": pod}, val, None, 8),
        # driver heap gauges: several metric names sharing a prefix
        s("metrics_spark_app_driver_jvm_heap_used_Value", {"type": F.lit("gauges")}, val, (ex == 9) & (e % 2 == 0), 9),
        s("metrics_spark_job_driver_jvm_heap_used_Value", {"type": F.lit("gauges")}, val, (ex == 9) & (e % 2 == 1), 10),
        s("metrics_spark_app_driver_jvm_heap_used_Value", {"type": F.lit("counters")}, val, (ex == 9) & (e % 3 == 0), 11),
        # machines: node = event_id % 2
        s("machine_memory_bytes", {"node": node}, (e % 2 + 1) * 1000.0, None, 12),
        s("machine_cpu_cores", {"node": node}, (e % 2 + 1) * 4.0, None, 13),
    )
    return (events.select(utc_instant(F.col("ts")).alias("ts"), F.explode(gen).alias("s"))
            .where(F.col("s").isNotNull())
            .select("ts", "s.metric", "s.labels", "s.value", "s.sample_id"))


def predictions(events: DataFrame) -> DataFrame:
    """``(label, prediction)`` from a fixed rule on value: right most of the
    time, sometimes off by one class, sometimes the never-actual class 9."""
    ev = events_with_class(events)
    c = F.col("CLASS")
    b = F.floor(F.col("value")).cast("bigint") % 10
    pred = (F.when(b < 6, c).when(b < 8, (c + 1) % 5).when(b < 9, F.lit(0))
            .otherwise(F.lit(9)))
    return ev.select(F.col("event_id"), c.cast("double").alias("label"), pred.cast("double").alias("prediction"))


def arrivals(events: DataFrame, slices: int = 4, most_delay: int = 480) -> list[DataFrame]:
    """The events in the order in which they arrive, each up to ``most_delay`` seconds
    after its time, cut into ``slices`` spans of equal length."""
    at = F.unix_micros(utc_instant(F.col("ts"))) + (F.col("event_id") * 7919 % most_delay) * 1_000_000
    low, high = events.agg(F.min(at), F.max(at)).first()
    if low is None:
        return [events]
    cuts = [low + (high - low) * k // slices for k in range(1, slices)]
    limits = [None, *cuts, None]
    out = []
    for a, b in zip(limits, limits[1:]):
        inside = F.lit(True) if a is None else at >= a
        out.append(events.where(inside if b is None else inside & (at < b)))
    return out
