"""Range and instant questions at any evaluation step.

``metrics.py`` evaluates a range at tumbling steps of its own length. Here the
step is free: a five-minute range every 15 seconds, or the last value within a
look-back. The answer at time t covers (t - range, t]; ``step`` numbers the
evaluation times, t = step * every.

One pass over the samples gives what every window needs:

* ``ordered_series`` — each sample with its position, its reset correction (the
  sum of the values that resets threw away so far), the running sum of the values
  and the times of its neighbours in the series. Samples are range-partitioned on
  (series, ts, sample_id), so a series that holds a third of all samples is
  spread over many tasks; only one summary row per (task, series) goes through a
  window over the whole series, and carries the last value, the next time and the
  totals over the borders between tasks.
* ``at_steps`` — a sample is the last of the windows that end between it and its
  successor, and the first of those that begin between its predecessor and it. It
  is listed under these steps only, so each window gets two rows, its first and its
  last sample, however many samples it holds or how much windows overlap. Totals
  at the last less totals before the first are the window's.

So an increase is value and correction at the last sample less those at the first,
an average the difference of running sums over that of positions, and an instant
value the value at the last sample. Whole numbers below 2^53 are exact; an average
of other values carries a rounding error relative to the series' running sum.

Series without a sample in a window give no row. A null value or time is no
sample. A NaN is a sample that adds 0 to running sums and is no reset. Empty in,
empty out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .metrics import EXEC, NAME, add, divide, labels_json, select_series, sum_all, sum_by, with_series_id
from .ordered import IDX, PID, local_scan, staged

LOOK_BACK = 300


def _null_safe(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Inner join on ``by``, null keys included; ``right`` keeps no key columns."""
    named = right.select(*[F.col(c).alias(f"_tl_k{i}") for i, c in enumerate(by)], *[c for c in right.columns if c not in by])
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_tl_k{i}"))
    return left.join(named, same).drop(*[f"_tl_k{i}" for i in range(len(by))])


def ordered_series(samples: DataFrame, partitions: int | None = None) -> DataFrame:
    """(series, metric, labels, us, value, position, correction, running, before_us,
    after_us) of every sample; positions count from 0 in each series."""
    ensure_checkpoint_dir(samples.sparkSession)
    s = with_series_id(samples.where(F.col("value").isNotNull() & F.col("ts").isNotNull()))
    s = s.select("series", "metric", "labels", F.unix_micros("ts").alias("us"), "sample_id", F.col("value").cast("double").alias("value"))
    ranged = local_scan(staged(s, "samples"), ["series"], ["us", "sample_id"], partitions).checkpoint(eager=True)
    w = Window.partitionBy(PID, "series").orderBy(IDX)
    sofar = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value, before = F.col("value"), F.col("_tl_before")
    plain = F.when(F.isnan(value), F.lit(0.0)).otherwise(value)
    rows = ranged.withColumns({"_tl_before": F.lag("value").over(w), "before_us": F.lag("us").over(w), "after_us": F.lead("us").over(w),
                               "position": F.row_number().over(w).cast("long") - 1, "running": F.sum(plain).over(sofar)})
    lost = F.when((value < before) & ~F.isnan(before), before).otherwise(F.lit(0.0))  # the counter began anew here
    rows = rows.withColumn("correction", F.sum(lost).over(sofar)).drop("_tl_before")
    part = rows.groupBy(PID, "series").agg(
        F.count(F.lit(1)).alias("_tl_n"), F.min("us").alias("_tl_first_us"), F.max("us").alias("_tl_last_us"),
        F.min_by("value", IDX).alias("_tl_first"), F.max_by("value", IDX).alias("_tl_last"),
        F.max_by("running", IDX).alias("_tl_sum"), F.max_by("correction", IDX).alias("_tl_lost"))
    tasks = Window.partitionBy("series").orderBy(PID)
    earlier = tasks.rowsBetween(Window.unboundedPreceding, -1)
    last = F.lag("_tl_last").over(tasks)
    part = part.withColumn("_tl_border", F.when((F.col("_tl_first") < last) & ~F.isnan(last), last).otherwise(F.lit(0.0)))
    zero = F.lit(0.0)
    part = part.select(
        PID, "series", F.lag("_tl_last_us").over(tasks).alias("_tl_before_us"), F.lead("_tl_first_us").over(tasks).alias("_tl_after_us"),
        F.coalesce(F.sum("_tl_n").over(earlier), F.lit(0)).alias("_tl_position"),
        F.coalesce(F.sum("_tl_sum").over(earlier), zero).alias("_tl_running"),
        (F.coalesce(F.sum(F.col("_tl_lost") + F.col("_tl_border")).over(earlier), zero) + F.col("_tl_border")).alias("_tl_correction"))
    out = _null_safe(rows, part, [PID, "series"])
    return out.select(
        "series", "metric", "labels", "us", "value", (F.col("position") + F.col("_tl_position")).alias("position"),
        (F.col("correction") + F.col("_tl_correction")).alias("correction"), (F.col("running") + F.col("_tl_running")).alias("running"),
        F.coalesce("before_us", "_tl_before_us").alias("before_us"), F.coalesce("after_us", "_tl_after_us").alias("after_us"))


def _steps(low_us: Column, below_us: Column, every_us: int) -> Column:
    """The steps whose time is in [low, below)."""
    def down(us: Column) -> Column:  # whole numbers: a double has no room for microseconds of far dates
        return ((us - F.pmod(us, F.lit(every_us))) / every_us).cast("bigint")

    low, high = down(low_us + (every_us - 1)), down(below_us - 1)
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))


def at_steps(ordered: DataFrame, range_seconds: int, every_seconds: int) -> DataFrame:
    """(step, series, metric, labels, first, last): the first and the last sample of
    each window that holds one, as (us, value, position, correction, running)."""
    reach, every = int(range_seconds) * 1_000_000, int(every_seconds) * 1_000_000
    us, before, after = F.col("us"), F.col("before_us"), F.col("after_us")
    as_last = _steps(us, F.least(us + reach, after), every)  # least() skips nulls
    as_first = _steps(F.greatest(us, before + reach), us + reach, every)
    sample = F.struct("us", "value", "position", "correction", "running")
    none = F.lit(None).cast("struct<us:bigint,value:double,position:bigint,correction:double,running:double>")
    uses = F.concat(F.transform(as_last, lambda k: F.struct(k.alias("step"), none.alias("first"), sample.alias("last"))),
                    F.transform(as_first, lambda k: F.struct(k.alias("step"), sample.alias("first"), none.alias("last"))))
    rows = ordered.select("series", "metric", "labels", F.inline(uses))
    return rows.groupBy("series", "step").agg(
        F.any_value("metric").alias("metric"), F.any_value("labels").alias("labels"),
        F.any_value("first", True).alias("first"), F.any_value("last", True).alias("last"))


def increase_at(samples: DataFrame, range_seconds: int = 300, every_seconds: int = 15, extrapolate: bool = False) -> DataFrame:
    """Counter increase of each series over the range before every step: vectors
    like those of ``metrics.increase``."""
    w = at_steps(ordered_series(samples), range_seconds, every_seconds)
    raw = (F.col("last.value") - F.col("first.value")) + (F.col("last.correction") - F.col("first.correction"))
    if not extrapolate:
        return w.select("step", "metric", "labels", raw.alias("value"))
    n = F.col("last.position") - F.col("first.position") + 1
    sampled = (F.col("last.us") - F.col("first.us")) / 1e6
    end = F.col("step") * (int(every_seconds) * 1_000_000)  # microseconds
    to_start = (F.col("first.us") - (end - int(range_seconds) * 1_000_000)) / 1e6
    to_end = (end - F.col("last.us")) / 1e6
    w = w.select("step", "metric", "labels", raw.alias("raw"), n.alias("n"), sampled.alias("sampled"), F.col("first.value").alias("low"),
                 to_start.alias("to_start"), to_end.alias("to_end")).where((F.col("n") >= 2) & (F.col("sampled") > 0))
    # a counter cannot have been below zero before the first sample
    to_zero = F.when((F.col("raw") > 0) & (F.col("low") >= 0), F.col("sampled") * (F.col("low") / F.col("raw")))
    to_start = F.least(F.col("to_start"), to_zero)  # least() skips a null
    gap = F.col("sampled") / (F.col("n") - 1)
    span = (F.col("sampled") + F.when(to_start < gap * 1.1, to_start).otherwise(gap / 2)
            + F.when(F.col("to_end") < gap * 1.1, F.col("to_end")).otherwise(gap / 2))
    return w.select("step", "metric", "labels", (F.col("raw") * (span / F.col("sampled"))).alias("value"))


def rate_at(samples: DataFrame, range_seconds: int = 300, every_seconds: int = 15, extrapolate: bool = False) -> DataFrame:
    inc = increase_at(samples, range_seconds, every_seconds, extrapolate)
    return inc.withColumn("value", F.col("value") / F.lit(float(range_seconds)))


def average_at(samples: DataFrame, range_seconds: int = 60, every_seconds: int = 15) -> DataFrame:
    """Mean of the values of each series over the range before every step."""
    w = at_steps(ordered_series(samples), range_seconds, every_seconds)
    first_value = F.when(F.isnan("first.value"), F.lit(0.0)).otherwise(F.col("first.value"))
    total = F.col("last.running") - F.col("first.running") + first_value
    n = F.col("last.position") - F.col("first.position") + 1
    return w.select("step", "metric", "labels", (total / n).alias("value"))


def last_at(samples: DataFrame, every_seconds: int = 15, look_back: int = LOOK_BACK) -> DataFrame:
    """Instant vector at every step: the last value of each series within the
    look-back, so a series without a sample since the step before still answers."""
    w = at_steps(ordered_series(samples), look_back, every_seconds)
    return w.select("step", "metric", "labels", F.col("last.value").alias("value"))


# ---- the documented questions at a free step ---------------------------------------


def completed_task_share_at(s: DataFrame, every_seconds: int = 15) -> DataFrame:
    """M1: increase of completed tasks over 5 minutes by executor, over the total."""
    done = select_series(s, "metrics_executor_completedTasks_total", EXEC)
    total = select_series(s, "metrics_executor_totalTasks_total", EXEC)
    return divide(sum_by(increase_at(done, 300, every_seconds), ["executor_id"]),
                  sum_by(last_at(total, every_seconds), ["executor_id"]), ["executor_id"])


def cpu_rate_by_pod_at(s: DataFrame, every_seconds: int = 15, extrapolate: bool = False) -> DataFrame:
    """M2."""
    cpu = select_series(s, "container_cpu_usage_seconds_total", [("namespace", "=", "default")])
    return sum_by(rate_at(cpu, 300, every_seconds, extrapolate), ["pod"])


def driver_heap_average_at(s: DataFrame, every_seconds: int = 15) -> DataFrame:
    """M4, one row per series: metric and labels (as JSON text)."""
    heap = select_series(s, None, [(NAME, "=~", "metrics_spark_.*_driver_jvm_heap_used_Value"), ("type", "=", "gauges")])
    return average_at(heap, 60, every_seconds).select("step", "metric", labels_json().alias("labels_json"), "value")


def task_balance_at(s: DataFrame, every_seconds: int = 15) -> DataFrame:
    """M7."""
    return sum_by(increase_at(select_series(s, "metrics_executor_completedTasks_total"), 300, every_seconds), ["executor_id"])


def cpu_share_at(s: DataFrame, every_seconds: int = 15) -> DataFrame:
    """M13."""
    cpu = select_series(s, "container_cpu_usage_seconds_total", [("namespace", "=", "default"), ("pod", "=~", "spark.*")])
    return divide(sum_all(rate_at(cpu, 300, every_seconds)), sum_all(last_at(select_series(s, "machine_cpu_cores"), every_seconds)))


def memory_by_pod_at(s: DataFrame, every_seconds: int = 60) -> DataFrame:
    """M3."""
    return sum_by(last_at(select_series(s, "container_memory_usage_bytes", [("namespace", "=", "default")]), every_seconds), ["pod"])


def gauge_by_executor_at(s: DataFrame, metric: str, every_seconds: int = 60) -> DataFrame:
    """M5, M6, M8, M9, M10."""
    return sum_by(last_at(select_series(s, metric), every_seconds), ["executor_id"])


def gc_share_at(s: DataFrame, every_seconds: int = 60) -> DataFrame:
    """M11."""
    return divide(gauge_by_executor_at(s, "metrics_executor_totalGCTime_seconds_total", every_seconds),
                  gauge_by_executor_at(s, "metrics_executor_totalDuration_seconds_total", every_seconds), ["executor_id"], 100.0)


def ram_share_at(s: DataFrame, every_seconds: int = 60) -> DataFrame:
    """M12, of one ordered scan over the samples of all three metrics."""
    heap, off, machine = "metrics_executor_JVMHeapMemory_bytes", "metrics_executor_JVMOffHeapMemory_bytes", "machine_memory_bytes"
    values = last_at(s.where(F.col("metric").isin(heap, off, machine)), every_seconds).checkpoint(eager=True)
    used = add(select_series(values, heap), select_series(values, off))
    return divide(sum_all(used), sum_all(select_series(values, machine)))
