"""Metric operators on hand-made samples: resets, single samples, vector
matching, selectors."""

import datetime as dt

import pytest

from trafficlens.operators import metrics as MX

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def samples(spark, rows):
    data = [(T0 + dt.timedelta(seconds=s), m, lab, float(v), i) for i, (s, m, lab, v) in enumerate(rows)]
    return spark.createDataFrame(data, "ts timestamp, metric string, labels map<string,string>, value double, sample_id long")


def test_increase_with_reset_and_single_sample(spark):
    e1, e2 = {"executor_id": "1"}, {"executor_id": "2"}
    s = samples(spark, [
        (10, "c", e1, 5), (20, "c", e1, 9), (30, "c", e1, 2), (40, "c", e1, 6),  # reset inside the step
        (15, "c", e2, 100),                                                    # single sample
        (310, "c", e1, 7),                                                     # next step
    ])
    rows = MX.increase(s, 300).collect()
    base = min(r["step"] for r in rows)
    got = {(r["step"] - base, r["labels"]["executor_id"]): r["value"] for r in rows}
    assert got[(0, "1")] == pytest.approx(4 + 2 + 4)
    assert got[(0, "2")] == 0.0
    assert got[(1, "1")] == 0.0
    assert all(v >= 0 for v in got.values())
    r = {(x["step"] - base, x["labels"]["executor_id"]): x["value"] for x in MX.rate(s, 300).collect()}
    assert r[(0, "1")] == pytest.approx(10 / 300)


def test_last_sample_sum_by_and_selectors(spark):
    s = samples(spark, [
        (10, "g", {"executor_id": "1"}, 5), (20, "g", {"executor_id": "1"}, 8),
        (12, "g", {"executor_id": "driver"}, 50), (13, "h", {"executor_id": "1"}, 1),
    ])
    v = MX.sum_by(MX.last_sample(MX.select_series(s, "g", MX.EXEC), 300), ["executor_id"]).collect()
    assert [(r["executor_id"], r["value"]) for r in v] == [("1", 8.0)]
    rx = MX.select_series(s, None, [(MX.NAME, "=~", "g|h"), ("executor_id", "!~", "driv.*")])
    assert rx.count() == 3
    # anchoring: "g" does not match "gg"
    assert MX.select_series(s, None, [(MX.NAME, "=~", "")]).count() == 0


def test_vector_division_drops_unmatched_series(spark):
    s = samples(spark, [
        (10, "a", {"executor_id": "1"}, 6), (10, "a", {"executor_id": "2"}, 4),
        (10, "b", {"executor_id": "1"}, 3), (10, "b", {"executor_id": "3"}, 0),
    ])
    a = MX.sum_by(MX.last_sample(MX.select_series(s, "a"), 300), ["executor_id"])
    b = MX.sum_by(MX.last_sample(MX.select_series(s, "b"), 300), ["executor_id"])
    got = {r["executor_id"]: r["value"] for r in MX.divide(a, b, ["executor_id"]).collect()}
    assert got == {"1": 2.0}


def test_add_matches_full_label_set(spark):
    s = samples(spark, [
        (10, "heap", {"executor_id": "1"}, 6), (10, "off", {"executor_id": "1"}, 4),
        (10, "heap", {"executor_id": "2"}, 1),
    ])
    h = MX.last_sample(MX.select_series(s, "heap"), 300)
    o = MX.last_sample(MX.select_series(s, "off"), 300)
    assert [r["value"] for r in MX.sum_all(MX.add(h, o)).collect()] == [10.0]


def test_avg_over_time(spark):
    s = samples(spark, [(1, "g", {"type": "gauges"}, 2), (30, "g", {"type": "gauges"}, 4), (61, "g", {"type": "gauges"}, 9)])
    got = sorted((r["step"], r["value"]) for r in MX.avg_over_time(s, 60).collect())
    assert [(st - got[0][0], v) for st, v in got] == [(0, 3.0), (1, 9.0)]


def test_increase_extrapolated_like_the_query_language(spark):
    """Samples at 30 s, 60 s, 90 s (values 10, 20, 30) in the step [0, 300):
    raw increase 20 over 60 s; average gap 30 s, threshold 33 s. Start: the
    counter reaches zero 30 s before the first sample (60·10/20 = 30 < 30 s to
    the edge → 30); end: 210 s to the edge ≥ threshold → half a gap (15).
    Span 60 + 30 + 15 = 105 → 20 · 105 / 60 = 35."""
    e = {"executor_id": "1"}
    s = samples(spark, [(30, "c", e, 10), (60, "c", e, 20), (90, "c", e, 30), (400, "c", e, 5)])
    rows = MX.increase(s, 300, extrapolate=True).collect()
    assert len(rows) == 1  # the single-sample step gives no value
    assert rows[0]["value"] == pytest.approx(35.0)
    assert MX.increase(s, 300).where("value > 0").first()["value"] == pytest.approx(20.0)
