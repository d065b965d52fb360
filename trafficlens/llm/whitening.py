"""Whitening of vectors by spectrum slicing.

Every entry c of a vector becomes the integer x = floor(``SCALE`` * c) + ``SHIFT``.

1. One pass adds up n, the sums S and the products G of all vectors: each task
   forms exact integer sums (in three limbs of ``LIMB`` bits), Spark adds the limbs.
   The shift cancels in every difference, so tasks leave it out.
2. The driver gets these d + d(d+1)/2 sums, never a vector, and forms the covariance
   V = (n G - S S') / n^2 from exact integers, rounded once per entry.
3. Spectrum slicing: the number of negative pivots in the LDL' factors of V - s I
   (symmetric pivoting, 1x1 and 2x2 blocks) is the number of eigenvalues below s,
   so bisection on s isolates the k-th largest eigenvalue. Rayleigh quotient
   iteration from inside the interval converges cubically to its eigenvector;
   counts on either side of the result certify that it is number k. Where it left
   the interval, the interval is halved and the iteration starts again. Eigenvalues
   that no slice of ``RESOLUTION`` * trace can part share an interval; their vectors
   are kept orthogonal to those found before.
4. A second pass projects each centred vector, divided by the root of the
   eigenvalue, and computes its exact deviation.

The covariance of the whitened columns is W V W' for the rows W of the projection:
``identity_error`` is its largest absolute difference from the identity, from the
exact moments, so it needs no third pass.

Rows whose vector is null, empty, holds a null or non-finite entry or one of 2^53 /
``SCALE`` or more, or has another length than most (of equally frequent lengths
the longest counts) are left out. Repeated rows count each time; a null id is kept.
Fewer than k dimensions give fewer components. A component whose eigenvalue is no
more than ``RESOLUTION`` * trace (as with one row, or equal rows) can't be whitened:
null, and left out of ``identity_error``; with a trace of 0 ``explained`` is null.
``deviation`` is null where it doesn't fit a long; ``deviation_text`` (decimal
digits) is always exact. Empty in, empty out; extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import finite, matrix, usual_length

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LIMB = 60
RESOLUTION = 1e-13
OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
       "deviation_text string")


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, y) of the rows that count: y = x - SHIFT."""
    kept = embeddings.where(finite(F.col("embedding"), 2.0**53 / SCALE))
    ints = kept.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE)).alias("y"))
    width = usual_length(ints, "y")
    return ints.where(F.size("y") == (width or 0))


def _products(y: np.ndarray) -> np.ndarray:
    """Exact y'y (Python integers where a long or a double can't hold it)."""
    most = int(np.abs(y).max(initial=0)) ** 2 * len(y)
    if most < 2**53:
        f = y.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    low, high = y & 0x3FFFFFF, y >> 26  # 26 and 28 bits: products of a slice below 2^56
    total = 0
    for a in range(0, len(y), 64):
        lo, hi = low[a:a + 64], high[a:a + 64]
        cross = (lo.T @ hi).astype(object)
        total = total + (lo.T @ lo).astype(object) + ((cross + cross.T) << 26) + ((hi.T @ hi).astype(object) << 52)
    return total


def moments(ints: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, products) of all vectors, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1), dtype=object)
        for batch in batches:
            if batch.num_rows:
                y = matrix(batch.column(0), width)
                total += _products(np.concatenate([np.ones((len(y), 1), np.int64), y], axis=1))
        i, j = np.triu_indices(width + 1)
        values = total[i, j]
        mask = (1 << LIMB) - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(i), pa.array(j), *(pa.array([int(v) >> LIMB * k if k == 2 else int(v) >> LIMB * k & mask for v in values], pa.int64())
                                         for k in range(3))], names=["i", "j", "l0", "l1", "l2"])

    parts = ints.select("y").mapInArrow(run, "i long, j long, l0 long, l1 long, l2 long")
    sums = parts.groupBy("i", "j").agg(*(F.sum(F.col(c).cast("decimal(19,0)")).alias(c) for c in ("l0", "l1", "l2")))
    full = [[0] * (width + 1) for _ in range(width + 1)]
    for r in sums.collect():
        full[r["i"]][r["j"]] = full[r["j"]][r["i"]] = sum(int(r[f"l{k}"]) << LIMB * k for k in range(3))
    return full[0][0], full[0][1:], [row[1:] for row in full[1:]]


def covariance(n: int, sums: list[int], products: list[list[int]]) -> np.ndarray:
    """Divisor n; each entry is rounded once (Python's integer division)."""
    d = len(sums)
    return np.array([[(n * products[i][j] - sums[i] * sums[j]) / (n * n) for j in range(d)] for i in range(d)]).reshape(d, d)


def negative_pivots(a: np.ndarray) -> int:
    """The number of negative eigenvalues of a symmetric matrix: signs of the
    blocks in its LDL' factors, pivots chosen over the whole rest (1x1 where the
    largest diagonal entry will do, else a 2x2 block, which has one of each sign)."""
    a = a.copy()
    count, n = 0, len(a)
    alpha = (1 + 17**0.5) / 8
    while n:
        diagonal = np.abs(np.diagonal(a))
        p = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diagonal(a)))
        r, s = divmod(int(off.argmax()), n)
        if diagonal[p] >= alpha * off[r, s]:
            if a[p, p] == 0:  # nothing is left: these eigenvalues are 0
                return count
            count += a[p, p] < 0
            rest = np.delete(np.arange(n), p)
            column = a[rest, p]
            a = a[np.ix_(rest, rest)] - np.outer(column, column / a[p, p])
        else:
            count += 1
            rest = np.delete(np.arange(n), [r, s])
            block, columns = a[np.ix_([r, s], [r, s])], a[np.ix_(rest, [r, s])]
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(block, columns.T)
        n = len(a)
    return int(count)


def _eigenvector(v: np.ndarray, shift: float, found: list[np.ndarray], seed: int) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from near ``shift``, orthogonal to ``found``."""
    d = len(v)
    x = np.random.default_rng(seed).standard_normal(d)
    basis = np.array(found).reshape(-1, d)
    x -= basis.T @ (basis @ x)
    x /= np.linalg.norm(x)
    scale = np.linalg.norm(v)
    value, residual = shift, np.inf
    for step in range(30):
        try:
            y = np.linalg.solve(v - value * np.eye(d), x)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            y = np.linalg.solve(v - (value + scale * 1e-15) * np.eye(d), x)
        y -= basis.T @ (basis @ y)
        x = y / np.linalg.norm(y)
        if step < 2:  # inverse iteration first: stay with the eigenvalue next to the shift
            continue
        value = float(x @ v @ x)
        now = float(np.linalg.norm(v @ x - value * x))
        if now >= residual / 2 and residual <= scale * 1e-13:
            break
        residual = min(residual, now)
    return value, x


def leading_eigenpairs(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit vectors (rows)."""
    d = len(v)
    identity, trace = np.eye(d), float(np.trace(v))
    least = RESOLUTION * trace
    if not trace > 0:  # all rows are equal
        return np.zeros(min(k, d)), identity[:k]
    bound = float(np.abs(v).sum(axis=1).max(initial=0)) * (1 + 1e-12) + least

    def above(s: float) -> int:
        return d - negative_pivots(v - s * identity)

    values, vectors = [], []
    known = {-bound: d, bound: 0}  # eigenvalues above each slice tried
    for number in range(1, min(k, d) + 1):
        low = max(s for s, c in known.items() if c >= number)
        high = min(s for s, c in known.items() if c < number)
        pair = None
        while pair is None:
            inside = known[low] - known[high]
            if inside > 1 and high - low > least:
                middle = (low + high) / 2
                known[middle] = above(middle)
                low, high = (middle, high) if known[middle] >= number else (low, middle)
                continue
            value, x = _eigenvector(v, (low + high) / 2, vectors, number)
            margin = max(least, 4 * float(np.linalg.norm(v @ x - value * x)))
            if high - low <= least or (low - margin <= value <= high + margin
                                       and above(value - margin) >= number and above(value + margin) < number):
                pair = value, x
            else:
                middle = (low + high) / 2
                known[middle] = above(middle)
                low, high = (middle, high) if known[middle] >= number else (low, middle)
        values.append(pair[0])
        vectors.append(pair[1])
    return np.array(values), np.array(vectors).reshape(-1, d)


def _square_sums(t: np.ndarray) -> list[int]:
    """Exact sum of squares of each row."""
    if int(np.abs(t).max(initial=0)) ** 2 * t.shape[1] < 2**63:
        return (t * t).sum(axis=1).tolist()
    if t.dtype != object and int(np.abs(t).max()) < 2**58:
        low, high = t & (2**28 - 1), t >> 28  # 28 and 31 bits
        parts = zip(*(x.astype(object).sum(axis=1) for x in (low * low, low * high, high * high)))
        return [int(a) + (int(b) << 29) + (int(c) << 56) for a, b, c in parts]
    return [sum(int(x) ** 2 for x in row) for row in t]


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component."""
    spark = embeddings.sparkSession
    ints = integer_vectors(embeddings)
    width = usual_length(ints, "y")
    if width is None:
        return spark.createDataFrame([], OUT)
    n, sums, products = moments(ints, width)
    v = covariance(n, sums, products)
    values, vectors = leading_eigenpairs(v, components)
    k, trace = len(values), float(np.trace(v))
    usable = values > RESOLUTION * trace
    w = vectors / np.sqrt(np.where(usable, values, 1.0))[:, None]
    error = np.abs((w @ v @ w.T - np.eye(k))[np.ix_(usable, usable)]).max(initial=0.0)
    explained = [float(e / trace) if trace > 0 else None for e in values]
    most = max(map(abs, sums), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            y = matrix(batch.column(1), width)
            if n * int(np.abs(y).max()) + most < 2**62:
                t = y * n - np.array(sums, dtype=np.int64)
            else:
                t = y.astype(object) * n - np.array(sums, dtype=object)
            exact = _square_sums(t)
            z = (t / n).astype(float) @ w.T
            at = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, n)), pa.array([x if x < 2**63 else None for x in exact], pa.int64()).take(pa.array(at)),
                pa.array(z.ravel(), mask=np.tile(~usable, rows)), pa.array(explained * rows, pa.float64()),
                pa.array(np.full(rows * k, error)), pa.array([str(x) for x in exact]).take(pa.array(at))],
                names=[c.split()[0] for c in OUT.split(", ")])

    return ints.mapInArrow(run, OUT)
