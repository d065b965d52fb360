"""Time-series metric queries over a long samples table
``(ts, metric, labels MAP<STRING,STRING>, value, sample_id)``.

A range query is evaluated at tumbling steps of its range length: step s
covers [s·r, (s+1)·r). Building blocks:

* ``select_series`` — metric name / label matchers (=, !=, =~, !~; regexes
  are fully anchored).
* ``last_sample``   — instant vector: the last sample of each series in the
  step (``max_by`` on (ts, sample_id)).
* ``increase`` / ``rate`` — sum of counter deltas between consecutive
  samples inside the step, a drop counted as a reset (the new value is the
  increase). No extrapolation to the step edges. ``lag`` over (series, step):
  such a group holds the samples of one series in one step only.
* ``avg_over_time`` — mean per series and step.
* ``sum_by`` / ``sum_all`` — aggregation by label values.
* ``divide`` / ``add`` — one-to-one vector matching: inner join on step and
  the matching labels; series missing on either side drop out.

All aggregates are partial-first (map-side combine); vectors carry
``step`` plus label columns, so joins are on small, already-aggregated data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NAME = "__name__"


def _label(name: str) -> Column:
    return F.col("metric") if name == NAME else F.col("labels").getItem(name)


def _full_match(col: Column, regex: str) -> Column:
    return col.rlike(f"^(?:{regex})$")


def select_series(samples: DataFrame, metric: str | None = None,
                  matchers: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """``metric{label op "value", ...}``; a missing label counts as "" as in
    the query language."""
    cond = F.lit(True)
    if metric is not None:
        cond = cond & (F.col("metric") == metric)
    for name, op, value in matchers or []:
        v = F.coalesce(_label(name), F.lit(""))
        if op == "=":
            cond = cond & (v == value)
        elif op == "!=":
            cond = cond & (v != value)
        elif op == "=~":
            cond = cond & _full_match(v, value)
        elif op == "!~":
            cond = cond & ~_full_match(v, value)
        else:
            raise ValueError(f"matcher op {op!r}")
    return samples.where(cond)


def with_step(samples: DataFrame, seconds: int) -> DataFrame:
    us = int(seconds) * 1_000_000
    return samples.withColumn("step", F.floor(F.unix_micros(F.col("ts")) / F.lit(us)).cast("bigint"))


def with_series_id(samples: DataFrame) -> DataFrame:
    """A groupable series identity: metric name + sorted label pairs."""
    return samples.withColumn(
        "series", F.concat(F.col("metric"), F.to_json(F.array_sort(F.map_entries(F.col("labels"))))))


def labels_json() -> Column:
    """The labels as JSON text, names in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(F.col("labels")))))


def last_sample(samples: DataFrame, step_seconds: int = 300) -> DataFrame:
    # a series is (metric, labels); maps group order-insensitively
    s = with_step(samples, step_seconds)
    return s.groupBy("step", "metric", "labels").agg(
        F.max_by(F.col("value"), F.struct("ts", "sample_id")).alias("value"))


def counter_delta(prev: Column, cur: Column) -> Column:
    """Increase between two consecutive counter samples: the difference, or
    the new value itself after a reset; 0 without a previous sample."""
    return F.when(prev.isNull() | F.isnan(prev), F.lit(0.0)).when(cur >= prev, cur - prev).otherwise(cur)


def increase(samples: DataFrame, range_seconds: int = 300, extrapolate: bool = False) -> DataFrame:
    """Counter increase per series and step. ``extrapolate=True`` follows
    the query language's rule: the raw increase is scaled from the span
    between the first and last sample towards the step edges (by at most
    half an average sample interval past a sample, and not below zero at
    the start), and series with fewer than two samples in a step give no
    value."""
    s = with_series_id(with_step(samples, range_seconds))
    w = Window.partitionBy("series", "step").orderBy("ts", "sample_id")
    at, value = F.struct("ts", "sample_id"), F.col("value")
    inc = (s.withColumn("_tl_d", counter_delta(F.lag("value").over(w), value)).groupBy("series", "step")
           .agg(F.sum("_tl_d").alias("value"), F.count(F.lit(1)).alias("samples"), F.min_by(value, at).alias("first_value"),
                F.min(at).alias("first_key"), F.max(at).alias("last_key"),
                F.first("metric").alias("metric"), F.first("labels").alias("labels")))
    if extrapolate:
        inc = _extrapolated(inc, range_seconds)
    return inc.select("step", "metric", "labels", "value")


def _extrapolated(inc: DataFrame, range_seconds: int) -> DataFrame:
    sec = lambda c: F.unix_micros(c) / F.lit(1e6)
    first_t, last_t = sec(F.col("first_key.ts")), sec(F.col("last_key.ts"))
    start = F.col("step") * range_seconds
    end = start + range_seconds
    raw, n, first_v = F.col("value"), F.col("samples"), F.col("first_value")
    sampled = last_t - first_t
    avg_gap = sampled / (n - 1)
    to_start = first_t - start
    # a counter cannot have been below zero before the first sample
    to_zero = F.when((raw > 0) & (first_v >= 0), sampled * (first_v / raw))
    to_start = F.when(to_zero.isNotNull() & (to_zero < to_start), to_zero).otherwise(to_start)
    to_end = end - last_t
    threshold = avg_gap * 1.1
    span = (sampled
            + F.when(to_start < threshold, to_start).otherwise(avg_gap / 2)
            + F.when(to_end < threshold, to_end).otherwise(avg_gap / 2))
    return (inc.where((n >= 2) & (sampled > 0))
            .withColumn("value", raw * (span / sampled)))


def rate(samples: DataFrame, range_seconds: int = 300, extrapolate: bool = False) -> DataFrame:
    inc = increase(samples, range_seconds, extrapolate)
    return inc.withColumn("value", F.col("value") / F.lit(float(range_seconds)))


def avg_over_time(samples: DataFrame, range_seconds: int = 60) -> DataFrame:
    s = with_step(samples, range_seconds)
    return s.groupBy("step", "metric", "labels").agg(F.avg("value").alias("value"))


def sum_by(vec: DataFrame, by: list[str]) -> DataFrame:
    return vec.groupBy("step", *[_label(k).alias(k) for k in by]).agg(F.sum("value").alias("value"))


def sum_all(vec: DataFrame) -> DataFrame:
    return vec.groupBy("step").agg(F.sum("value").alias("value"))


def divide(a: DataFrame, b: DataFrame, on: list[str] | None = None, scale: float = 1.0) -> DataFrame:
    """``a / b`` with one-to-one matching on step and ``on`` label columns;
    division by zero gives null."""
    keys = ["step", *(on or [])]
    j = a.withColumnRenamed("value", "_a").join(b.withColumnRenamed("value", "_b"), keys)
    return j.select(*keys, (F.try_divide(F.col("_a"), F.col("_b")) * F.lit(scale)).alias("value"))


def add(a: DataFrame, b: DataFrame) -> DataFrame:
    """Series-wise ``a + b``: match on step and the full label set (metric
    names dropped); unmatched series drop out."""
    ka = a.select("step", F.to_json(F.array_sort(F.map_entries("labels"))).alias("_k"),
                  "labels", F.col("value").alias("_a"))
    kb = b.select("step", F.to_json(F.array_sort(F.map_entries("labels"))).alias("_k"),
                  F.col("value").alias("_b"))
    return ka.join(kb, ["step", "_k"]).select("step", "labels", (F.col("_a") + F.col("_b")).alias("value"))


def round_value(vec: DataFrame, digits: int = 6) -> DataFrame:
    return vec.withColumn("value", F.round(F.col("value"), digits))


# ---- the thirteen documented questions -------------------------------------------

EXEC = [("executor_id", "!=", "driver")]


def completed_task_share(s: DataFrame) -> DataFrame:
    """increase(completedTasks[5m]) by executor ÷ totalTasks by executor,
    driver excluded."""
    num = sum_by(increase(select_series(s, "metrics_executor_completedTasks_total", EXEC), 300), ["executor_id"])
    den = sum_by(last_sample(select_series(s, "metrics_executor_totalTasks_total", EXEC), 300), ["executor_id"])
    return divide(num, den, ["executor_id"])


def cpu_rate_by_pod(s: DataFrame) -> DataFrame:
    return sum_by(rate(select_series(s, "container_cpu_usage_seconds_total", [("namespace", "=", "default")]), 300),
                  ["pod"])


def memory_by_pod(s: DataFrame) -> DataFrame:
    return sum_by(last_sample(select_series(s, "container_memory_usage_bytes", [("namespace", "=", "default")]), 300),
                  ["pod"])


def driver_heap_avg_1m(s: DataFrame) -> DataFrame:
    sel = select_series(s, None, [(NAME, "=~", "metrics_spark_.*_driver_jvm_heap_used_Value"),
                                  ("type", "=", "gauges")])
    return avg_over_time(sel, 60).select("step", "metric", labels_json().alias("labels_json"), "value")


def gauge_by_executor(s: DataFrame, metric: str) -> DataFrame:
    return sum_by(last_sample(select_series(s, metric), 300), ["executor_id"])


def task_balance(s: DataFrame) -> DataFrame:
    return sum_by(increase(select_series(s, "metrics_executor_completedTasks_total"), 300), ["executor_id"])


def gc_share(s: DataFrame) -> DataFrame:
    gc = gauge_by_executor(s, "metrics_executor_totalGCTime_seconds_total")
    dur = gauge_by_executor(s, "metrics_executor_totalDuration_seconds_total")
    return divide(gc, dur, ["executor_id"], 100.0)


def ram_share(s: DataFrame) -> DataFrame:
    heap = last_sample(select_series(s, "metrics_executor_JVMHeapMemory_bytes"), 300)
    off = last_sample(select_series(s, "metrics_executor_JVMOffHeapMemory_bytes"), 300)
    mem = last_sample(select_series(s, "machine_memory_bytes"), 300)
    return divide(sum_all(add(heap, off)), sum_all(mem))


def cpu_share(s: DataFrame) -> DataFrame:
    cpu = rate(select_series(s, "container_cpu_usage_seconds_total",
                             [("namespace", "=", "default"), ("pod", "=~", "spark.*")]), 300)
    cores = last_sample(select_series(s, "machine_cpu_cores"), 300)
    return divide(sum_all(cpu), sum_all(cores))
