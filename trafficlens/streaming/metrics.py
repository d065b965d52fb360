"""Streaming metric operators.

* ``windowed_average`` — ``avg_over_time`` as an event-time tumbling window
  with a watermark (late samples beyond it are dropped by Spark).
* ``counter_increase_stream`` — counter increases per (series, step) with
  ``applyInPandasWithState``. ``GROUP_STEPS`` steps of a series make a group, whose
  state is the buffer of their samples in the order of (ts, sample_id): a sample that arrives late, but within
  the watermark, takes its place in the buffer, so the increase is that of the
  batch operator whatever the order of arrival. Each micro-batch emits the
  present total of the steps it touched (``closed`` false); an event-time timer at
  the end of the first open step emits the last total of the steps that the watermark
  has passed (``closed`` true) and drops their samples. Samples later than the watermark are dropped and
  counted by Spark. Written through ``sink.read_latest``, the table always shows
  the newest total of every step, open steps included, so nothing is lost at the
  end of a run.

A buffer holds one series' samples of the open steps of a group. A sample without a value or a time
is none."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.metrics import labels_json


def windowed_average(samples: DataFrame, seconds: int = 60, watermark: str = "10 minutes") -> DataFrame:
    """``(step, metric, labels_json, value)`` — mean per series per window."""
    s = samples.withWatermark("ts", watermark)
    g = s.groupBy(F.window("ts", f"{seconds} seconds"), "metric",
                  labels_json().alias("labels_json"))
    out = g.agg(F.avg("value").alias("value"))
    return out.select((F.unix_seconds(F.col("window.start")) / seconds).cast("bigint").alias("step"),
                      "metric", "labels_json", "value")


INC_OUTPUT = "metric string, labels_json string, step long, value double, samples long, closed boolean"
INC_STATE = "us array<long>, id array<long>, value array<double>"
GROUP_STEPS = 24
INC_KEYS = ["metric", "labels_json", "step"]


def _total(value: np.ndarray) -> float:
    """Sum of the increases between consecutive samples; a drop is a reset."""
    before, now = value[:-1], value[1:]
    return float(np.where(np.isnan(before), 0.0, np.where(now < before, now, now - before)).sum())


def _increase_fn(step_us: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
        metric, labels = key[0], key[1]

        def rows(step, value, wanted, closed):
            low, high = np.searchsorted(step, wanted), np.searchsorted(step, wanted, "right")
            return pd.DataFrame({"metric": metric, "labels_json": labels, "step": wanted,
                                 "value": [_total(value[a:b]) for a, b in zip(low.tolist(), high.tolist())],
                                 "samples": high - low, "closed": closed})

        us, id_, value = (list(x) for x in state.get) if state.exists else ([], [], [])
        new = []
        if not state.hasTimedOut:
            for pdf in pdfs:
                new += pdf["us"].tolist()
                id_ += pdf["sample_id"].tolist()
                value += pdf["value"].tolist()
        order = np.lexsort((id_, us + new))
        us, id_, value = (np.asarray(x, dtype=t)[order] for x, t in ((us + new, np.int64), (id_, np.int64), (value, np.float64)))
        step = us // step_us
        if state.hasTimedOut:
            past = (step + 1) * step_us // 1000 <= state.getCurrentWatermarkMs()
            ended = np.unique(step[past])
            if len(ended):
                yield rows(step[past], value[past], ended, True)
            us, id_, value, step = us[~past], id_[~past], value[~past], step[~past]
        else:
            yield rows(step, value, np.unique(np.asarray(new, dtype=np.int64) // step_us), False)
        if not len(us):
            state.remove()
            return
        state.update((us.tolist(), id_.tolist(), value.tolist()))
        # a step closes when the watermark passes its end (a timer can't lie in the past)
        state.setTimeoutTimestamp(max((int(step[0]) + 1) * step_us // 1000, state.getCurrentWatermarkMs() + 1))
    return fn


def counter_increase_stream(samples: DataFrame, seconds: int = 300, watermark: str = "10 minutes") -> DataFrame:
    """Counter increases per series and step, in update mode (see ``INC_KEYS``)."""
    s = samples.where(F.col("value").isNotNull() & F.col("ts").isNotNull())
    us, width = F.unix_micros("ts"), F.lit(seconds * 1_000_000 * GROUP_STEPS)
    s = s.select("metric", labels_json().alias("labels_json"), "ts", us.alias("us"), "sample_id", "value",
                 ((us - F.pmod(us, width)) / width).cast("bigint").alias("steps"))
    return (s.withWatermark("ts", watermark).groupBy("metric", "labels_json", "steps")
            .applyInPandasWithState(_increase_fn(seconds * 1_000_000), INC_OUTPUT, INC_STATE,
                                    "update", GroupStateTimeout.EventTimeTimeout))


def increase_vector(totals: DataFrame) -> DataFrame:
    """The totals as a vector (step, metric, labels, value) like those of the batch operators."""
    labels = F.from_json("labels_json", "map<string,string>")
    return totals.select("step", "metric", labels.alias("labels"), "value")
