"""Ranges at a free step against brute force over every window."""

import datetime as dt
import math
import random

import pytest

from trafficlens.operators import ranges as RG
from trafficlens.operators.metrics import increase
from trafficlens.operators.ordered import PID, local_scan

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "ts timestamp, metric string, labels map<string,string>, value double, sample_id long"


def frame(spark, rows):
    """rows: (seconds, series, value)"""
    data = [(T0 + dt.timedelta(seconds=s), "c", {"e": e}, None if v is None else float(v), i) for i, (s, e, v) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def rows_of(seed, n=400, span=4000):
    r = random.Random(seed)
    out = [(round(r.uniform(0, span), 3), r.choice("abcaaaaaa"), r.randrange(50)) for _ in range(n)]
    out += [(r.randrange(0, span, 15), r.choice("ab"), r.randrange(50)) for _ in range(60)]  # on the grid, and ties
    return out + [(600, "b", 7), (600, "b", 3), (600, "b", 9), (50_000, "a", 4)]


def windows(rows, reach, every):
    """{(step, series): [values in order]} of every window (t - reach, t]."""
    base = int(T0.timestamp())
    out = {}
    by = {}
    for i, (s, e, v) in enumerate(rows):
        if v is not None:
            by.setdefault(e, []).append((base + s, i, float(v)))
    for e, samples in by.items():
        samples.sort()
        steps = {k for s, _, _ in samples for k in range(int(s // every), int((s + reach) // every) + 2)}
        for k in steps:
            held = [x for x in samples if k * every - reach < x[0] <= k * every]
            if held:
                out[k, e] = held
    return out


def increase_of(held):
    return sum(b - a if b >= a else b for a, b in zip([x[2] for x in held], [x[2] for x in held][1:]))


def got(df):
    return {(r["step"], r["labels"]["e"]): r["value"] for r in df.collect()}


@pytest.mark.parametrize("reach,every", [(300, 15), (60, 60), (10, 45), (45, 7)])
def test_windows_of_every_kind(spark, reach, every):
    rows = rows_of(reach + every)
    want = windows(rows, reach, every)
    s = frame(spark, rows)
    assert got(RG.increase_at(s, reach, every)) == {k: increase_of(h) for k, h in want.items()}
    assert got(RG.last_at(s, every, reach)) == {k: h[-1][2] for k, h in want.items()}
    average = got(RG.average_at(s, reach, every))
    assert average.keys() == want.keys()
    assert all(average[k] == pytest.approx(sum(x[2] for x in h) / len(h)) for k, h in want.items())


def test_extrapolated_rates(spark):
    rows = rows_of(9)
    have = got(RG.rate_at(frame(spark, rows), 300, 15, extrapolate=True))
    want = {}
    for (k, e), h in windows(rows, 300, 15).items():
        sampled = h[-1][0] - h[0][0]
        if len(h) < 2 or sampled <= 0:
            continue
        raw, gap = increase_of(h), sampled / (len(h) - 1)
        to_start, to_end = h[0][0] - (k * 15 - 300), k * 15 - h[-1][0]
        if raw > 0:
            to_start = min(to_start, sampled * h[0][2] / raw)
        span = sampled + (to_start if to_start < gap * 1.1 else gap / 2) + (to_end if to_end < gap * 1.1 else gap / 2)
        want[k, e] = raw * span / sampled / 300
    assert have.keys() == want.keys() and all(math.isclose(have[k], want[k], rel_tol=1e-6, abs_tol=1e-9) for k in want)


def test_one_series_over_many_tasks(spark):
    rows = [(i * 0.5, "hot", (i * 7) % 1000) for i in range(3000)]
    s = frame(spark, rows)
    ordered = RG.ordered_series(s, partitions=16)
    assert [r.position for r in ordered.orderBy("us").collect()] == list(range(3000))
    tasks = local_scan(s, ["labels.e"], ["ts", "sample_id"], 16).groupBy(PID).count().collect()
    assert len(tasks) == 16 and max(r["count"] for r in tasks) < 600  # the series isn't in one task
    want = windows(rows, 300, 15)
    assert got(RG.increase_at(s, 300, 15)) == {k: increase_of(h) for k, h in want.items()}


def test_a_series_still_answers_within_the_look_back(spark):
    s = frame(spark, [(30, "a", 5), (1000, "a", 6)])
    base = int(T0.timestamp()) // 60
    steps = {k - base: v for (k, _), v in got(RG.last_at(s, 60, 300)).items()}
    assert steps == {**{k: 5.0 for k in range(1, 6)}, **{k: 6.0 for k in range(17, 22)}}


def test_tumbling_steps_are_a_special_case(spark):
    """A range as long as its step, with no sample on a step's edge."""
    rows = [(s + 0.25, e, v) for s, e, v in rows_of(3) if s != int(s)]
    a = got(RG.increase_at(frame(spark, rows), 300, 300))
    b = got(increase(frame(spark, rows), 300))
    assert a == {(k + 1, e): v for (k, e), v in b.items()}


def test_no_copy_per_window(spark):
    """Each sample is listed under two kinds of steps, however much windows overlap."""
    rows = [(i, "a", i) for i in range(2000)]
    ordered = RG.ordered_series(frame(spark, rows)).cache()
    listed = RG.at_steps(ordered, 600, 10).count()
    assert listed <= 2000 / 10 + 600 / 10 + 2  # a copy per window would be 120,000 rows


def test_nulls_and_nothing(spark):
    assert RG.increase_at(frame(spark, [])).collect() == []
    assert RG.last_at(frame(spark, [(1, "a", None)])).collect() == []
    odd = spark.createDataFrame([(T0, None, None, 1.0, 1), (T0 + dt.timedelta(seconds=10), None, None, 3.0, 2), (None, "c", {"e": "a"}, 1.0, 3)], SCHEMA)
    rows = RG.increase_at(odd, 300, 15).collect()
    assert len(rows) == 21 and {r["value"] for r in rows} == {0.0, 2.0} and {r["metric"] for r in rows} == {None}
