"""Whitening and hard negatives against brute force."""

import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.llm import hard_negatives, whitening

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType())])


def vectors(n=240, d=12, seed=5, labels=4):
    r = random.Random(seed)
    centres = [[r.gauss(0, 0.4) for _ in range(d)] for _ in range(labels)]
    rows = []
    for i in range(n):
        k = r.randrange(labels)
        rows.append((i, [float(np.float32(c + r.gauss(0, 0.3))) for c in centres[k]], k))
    return rows


def odd_vectors(d=12):
    """Nulls, non-finite entries, other lengths, ties and repeated rows."""
    one = [float(np.float32(0.1 * i - 0.3)) for i in range(d)]
    return [(None, one, 1), (5_000, None, 1), (5_050, one, None), (5_100, [None, *one[1:]], 1), (5_150, [math.nan, *one[1:]], 1),
            (5_200, [math.inf, *one[1:]], 2), (5_250, [], 1), (5_300, one[:5], 1), (5_350, one, 1), (5_350, one, 1), (5_351, one, 1),
            (5_352, one, 2), (5_352, one, 2), (5_353, [1e30, *one[1:]], 1), (5_400, [0.0] * d, 3), (None, None, None)]


def clashing(df):
    names = ["row", "q", "norm", "angles", "windows", "ab", "rb", "kind", "rank", "y", "n", "size", "component", "whitened"]
    return df.select("*", *(F.lit(i).alias(c) for i, c in enumerate(names)))


def usable(vector, d=12):
    return vector is not None and len(vector) == d and all(x is not None and math.isfinite(x) and abs(x) < 1e9 for x in vector)


def brute_negatives(rows):
    kept = []
    for vec_id, v, label in rows:
        if label is None or not usable(v):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((vec_id, label, [math.floor(256 * x) for x in v]))
    out = []
    for i, (a, la, qa) in enumerate(kept):
        if a is None or a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(qa, q)), b is None, b or 0, b, lb) for j, (b, lb, q) in enumerate(kept) if j != i)
        for p in [s for s in scored if s[4] == la][:5]:
            fit = [s for s in scored if s[4] != la and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0]][:3]
            out += [(a, p[3], k + 1, s[3], -p[0], -s[0]) for k, s in enumerate(fit)]
    return Counter(out)


@pytest.mark.parametrize("blocks", [(16_384, 65_536), (3, 40)])
def test_hard_negatives(spark, monkeypatch, blocks):
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", blocks[0])
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", blocks[1])
    rows = vectors() + odd_vectors() + [(50, vectors()[50][1], 1)] * 3
    df = clashing(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = hard_negatives.hard_negatives(df)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    want = brute_negatives(rows)
    assert len(want) > 40 and Counter(map(tuple, got.collect())) == want


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives.hard_negatives(spark.createDataFrame([], SCHEMA)).collect() == []
    assert hard_negatives.hard_negatives(spark.createDataFrame([(None, None, None), (50, [math.nan], 1)], SCHEMA)).collect() == []
    one = spark.createDataFrame([(50, [0.5, 0.5], 1)], SCHEMA)
    assert hard_negatives.hard_negatives(one).collect() == []


def test_large_components_score_in_integers(spark):
    r = random.Random(2)
    rows = [(i, [float(np.float32(r.uniform(-1, 1) * 4e6)) for _ in range(6)], i % 3) for i in range(120)]
    want = Counter()
    kept = [(i, (l + 1) % 10 if i % 7 == 0 else l, [math.floor(256 * x) for x in v]) for i, v, l in rows]
    for a, la, qa in kept:
        if a % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(qa, q)), b, lb) for b, lb, q in kept if b != a)
            for p in [s for s in scored if s[2] == la][:5]:
                fit = [s for s in scored if s[2] != la and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0]][:3]
                want.update((a, p[1], k + 1, s[1], -p[0], -s[0]) for k, s in enumerate(fit))
    assert max(abs(w[4]) for w in want) > 2**53
    assert Counter(map(tuple, hard_negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect())) == want


def test_score_bounds_hold():
    g = np.random.default_rng(1)
    q = np.floor(g.standard_normal((400, 10)) * 90)
    q[:50] = q[50:100] * 2  # parallel rows: the bounds are tight
    directions = q[:7] / np.linalg.norm(q[:7], axis=1)[:, None]
    norm = np.linalg.norm(q, axis=1)
    angles = np.arccos(np.clip(q @ directions.T / norm[:, None], -1, 1)).T
    for i in range(0, 400, 9):
        low, high = hard_negatives.score_bounds(angles[:, i], norm[i], angles, norm)
        score = q @ q[i]
        assert (low <= score).all() and (score <= high).all()
        if i < 7:  # its own direction is stored: both bounds meet the score
            assert np.abs(high - low).max() < 20


def brute_whitening(rows, d=12, k=8):
    kept = [(i, [math.floor(1024 * x) + 100_000 for x in v]) for i, v, _ in rows if usable(v, d)]
    x = [v for _, v in kept]
    n = len(x)
    sums = [sum(v[j] for v in x) for j in range(d)]
    v = np.array([[float(Fraction(n * sum(r[i] * r[j] for r in x) - sums[i] * sums[j], n * n)) for j in range(d)] for i in range(d)])
    e, w = np.linalg.eigh(v)
    e, w = e[::-1][:k], w[:, ::-1][:, :k]
    return kept, n, sums, v, e, w


def test_whitening(spark):
    rows = vectors() + odd_vectors()
    got = whitening.whiten(clashing(spark.createDataFrame(rows, SCHEMA).repartition(4))).collect()
    kept, n, sums, v, e, w = brute_whitening(rows)
    assert len(got) == 8 * len(kept) and {r.n for r in got} == {n}
    want = {}
    for i, x in kept:
        dev = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        z = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)]) @ w / np.sqrt(e)
        want.setdefault((i, dev), []).append(z)
    signs = {}
    for r in got:
        z = want[r.vec_id, r.deviation][0][r.component - 1]
        signs.setdefault(r.component, np.sign(r.whitened * z) if abs(z) > 0.1 else None)
        s = signs[r.component] or np.sign(r.whitened * z)
        assert abs(r.whitened - s * z) < 1e-8 and r.deviation_text == str(r.deviation)
        assert abs(r.explained - e[r.component - 1] / np.trace(v)) < 1e-12 and r.identity_error < 1e-10
    assert Counter(r.vec_id for r in got) == Counter({i: 8 * c for i, c in Counter(i for i, _ in kept).items()})


def test_whitened_covariance_as_measured(spark):
    rows = vectors(n=90)
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    z = np.zeros((90, 8))
    for r in got:
        z[r.vec_id, r.component - 1] = r.whitened
    assert np.abs(z.T @ z / 90 - np.outer(z.mean(0), z.mean(0)) - np.eye(8)).max() < 1e-10


def test_whitening_of_little(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 1), (2, [None], 1)], SCHEMA)).collect() == []
    same = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25], 1)] * 3, SCHEMA)).collect()
    assert len(same) == 6 and all(r.whitened is None and r.explained is None and r.deviation == 0 for r in same)
    flat = whitening.whiten(spark.createDataFrame([(i, [i * 0.5, i * 1.0, 7.0], 1) for i in range(5)], SCHEMA)).collect()
    assert {(r.component, r.whitened is None) for r in flat} == {(1, False), (2, True), (3, True)}


def test_whitening_beyond_a_long(spark):
    r = random.Random(4)
    rows = [(i, [float(np.float32(r.uniform(-1, 1) * 10.0 ** r.randint(0, 11))) for _ in range(5)], 0) for i in range(60)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    x = [[math.floor(1024 * a) + 100_000 for a in v] for _, v, _ in rows]
    sums = [sum(v[j] for v in x) for j in range(5)]
    for g in got:
        dev = sum((60 * a - s) ** 2 for a, s in zip(x[g.vec_id], sums))
        assert g.deviation_text == str(dev) and g.deviation == (dev if dev < 2**63 else None)
    assert any(g.deviation is None for g in got)


@pytest.mark.parametrize("spectrum", [[9, 9, 9, 4, 4, 1, 0, 0], [5, 5 * (1 + 1e-10), 3, 2.9999, 1, 1e-9, 0, 0], [1] * 8,
                                      [1e9, 1e3, 1, 1e-3, 1e-6, 0, 0, 0], [8, 7, 6, 5, 4, 3, 2, 1]])
def test_spectrum_slicing(spectrum):
    g = np.random.default_rng(0)
    q, _ = np.linalg.qr(g.standard_normal((8, 8)))
    v = (q * np.array(spectrum)) @ q.T
    v = (v + v.T) / 2
    values, vectors_ = whitening.leading_eigenpairs(v, 6)
    size = max(spectrum)
    assert np.abs(values - np.sort(spectrum)[::-1][:6]).max() < 1e-11 * size
    assert np.abs(vectors_ @ vectors_.T - np.eye(6)).max() < 1e-6
    assert np.abs(vectors_ @ v - values[:, None] * vectors_).max() < 1e-11 * size


def test_negative_pivots():
    g = np.random.default_rng(3)
    for d in range(1, 25):
        a = g.standard_normal((d, d))
        a += a.T
        if d % 3 == 0:
            np.fill_diagonal(a, 0)
        assert whitening.negative_pivots(a) == (np.linalg.eigvalsh(a) < 0).sum()
    assert whitening.negative_pivots(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1
    assert whitening.negative_pivots(np.zeros((3, 3))) == 0
