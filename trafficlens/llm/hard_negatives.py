"""Hard negatives by angular triangle filtering.

A row is its integer vector (floor of ``SCALE`` times each component) and its
label; its score with an anchor is their integer inner product. An anchor's
positives are its ``positives`` best other rows of the same label, and for each
positive the best ``negatives`` rows of other labels are wanted whose score lies
in a window given by the positive's score.

1. Every row stores its norm and its angles to the reference directions, the
   mean vectors of the ``REFERENCES`` labels with most rows (sums over all rows).
   By the triangle inequality on the sphere the angle between two rows is at least
   the largest difference and at most the smallest sum of their angles to a
   direction (and at most 2 pi less that sum); cosines times norms, widened by
   ``SLACK`` for rounding, bound the score.
2. Anchors against all rows, in blocks: anchors are dealt to blocks of
   ``ANCHOR_BLOCK`` and rows to blocks of ``ROW_BLOCK``; a task takes a pair of
   blocks, holds the anchors and lets the rows stream by, batch after batch. Only
   a row whose bound reaches what the anchor still looks for gets an integer
   score: for positives, the worst of the best five so far; for negatives, a
   window that overlaps its interval and isn't yet full of better rows.
3. Each task hands on the best few per anchor (per positive), and a window with a
   rank limit picks those of all tasks.

The work is anchors times rows (both are stated by the caller). Rows are dealt by
a hash of their place in a written table, so neither a label nor an id that many
rows share gathers in one task; the prepared rows and the positives are written
to the shared checkpoint folder, so a lost executor costs tasks.

Rows with a null label, a null or empty vector, or a null or non-finite component
take no part; neither do rows whose squared integer norm reaches 2^62 (scores
would be no longs) or whose length isn't the most frequent one. Rows are told
apart by their place, not by their id: a row that repeats is another row. A null
id can be a positive or a negative (after all other ids) but no anchor. Ties in
score go to the smaller id. Empty in, empty out; extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .vectors import finite, lists, matrix, usual_length

SCALE = 256
REFERENCES = 16
ANCHOR_BLOCK = 16_384
ROW_BLOCK = 8_192
FIRST_SCORED = 64
SLACK = 1e-7
_NO_ID = np.iinfo(np.int64).max
_ROW = "row long, vec_id long, label long, q array<long>, norm double, angles array<double>"


def integer_rows(rows: DataFrame, label: Column) -> DataFrame:
    """(vec_id, label, q) of the rows that take part."""
    q = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    square = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    ints = (rows.where(label.isNotNull() & finite(F.col("embedding"), 2.0**31 / SCALE))
            .select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), q.alias("q"))
            .where(square < 2.0**62))
    width = usual_length(ints, "q")
    return ints.where(F.size("q") == (width or 0))


def reference_directions(ints: DataFrame, width: int) -> np.ndarray:
    """Unit mean vectors of the labels with most rows."""
    top = [r["label"] for r in ints.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "label").limit(REFERENCES).collect()]
    index = np.array(sorted(top), dtype=np.int64)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(index), width))
        for batch in batches:
            label = batch.column(0).to_numpy()
            at = np.searchsorted(index, label).clip(max=len(index) - 1)
            mine = index[at] == label
            np.add.at(total, at[mine], matrix(batch.column(1), width)[mine])
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(index)), width)),
                                          pa.array(np.tile(np.arange(width), len(index))), pa.array(total.ravel())],
                                         names=["direction", "at", "total"])

    got = (ints.select("label", "q").mapInArrow(sums, "direction long, at long, total double")
           .groupBy("direction", "at").agg(F.sum("total").alias("total")).collect())
    mean = np.zeros((len(index), width))
    for r in got:
        mean[r["direction"], r["at"]] = r["total"]
    size = np.linalg.norm(mean, axis=1)
    return mean[size > 0] / size[size > 0, None]


def prepare(ints: DataFrame, width: int) -> DataFrame:
    """The rows with their place, norm and stored angles, written and read again."""
    directions = reference_directions(ints, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = matrix(batch.column(3), width).astype(float)
            norm = np.sqrt((q * q).sum(axis=1))
            cosine = q @ directions.T / np.where(norm > 0, norm, 1.0)[:, None]
            angles = np.arccos(np.clip(cosine, -1.0, 1.0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norm), lists(angles)],
                                             names=["row", "vec_id", "label", "q", "norm", "angles"])

    path = scratch_path(ints.sparkSession, "vectors")
    placed = ints.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "q")
    placed.mapInArrow(run, _ROW).write.parquet(path)
    return ints.sparkSession.read.parquet(path)


class _Side:
    """Rows of one batch or block as arrays."""

    def __init__(self, batch: pa.RecordBatch, width: int):
        self.row, self.label = batch.column("row").to_numpy(), batch.column("label").to_numpy()
        self.id = batch.column("vec_id").fill_null(_NO_ID).to_numpy()
        self.no_id = batch.column("vec_id").is_null().to_numpy(zero_copy_only=False)
        self.q = matrix(batch.column("q"), width)
        self.norm = batch.column("norm").to_numpy()
        angles = batch.column("angles")
        self.angles = np.ascontiguousarray(matrix(angles, len(angles[0])).T)


def score_bounds(anchor_angles, anchor_norm, angles, norm) -> tuple[np.ndarray, np.ndarray]:
    """(low, high): the score of every row with the anchor lies between them.
    ``angles``: directions x rows."""
    size = anchor_norm * norm
    if not len(angles):
        return -size - 1, size + 1
    total = angles + anchor_angles[:, None]
    least = np.abs(angles - anchor_angles[:, None]).max(axis=0) - SLACK
    most = np.minimum(total.min(axis=0), 2 * np.pi - total.max(axis=0)) + SLACK
    wide = size * 1e-9 + 1
    return size * np.cos(np.clip(most, 0, np.pi)) - wide, size * np.cos(np.clip(least, 0, np.pi)) + wide


class _Best:
    """The best ``k`` rows so far: score falling, then id."""

    def __init__(self, k: int):
        self.k, self.score, self.id, self.none = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, score: np.ndarray, id_: np.ndarray, none: np.ndarray) -> None:
        if not len(score):
            return
        s, i, n = np.concatenate([self.score, score]), np.concatenate([self.id, id_]), np.concatenate([self.none, none])
        order = np.lexsort((i, n, -s))[:self.k]
        self.score, self.id, self.none = s[order], i[order], n[order]

    @property
    def worst(self) -> float:
        """A later row must reach this score."""
        return float(self.score[-1]) if len(self.score) == self.k else -np.inf


class _Positives:
    """Same-label search for one anchor."""

    def __init__(self, anchor, k: int):
        self.best = [_Best(k)]

    def look(self, a, scores_of, rows: _Side) -> None:
        mine = np.flatnonzero((rows.label == a.label) & (rows.row != a.row))
        if not len(mine):
            return
        best = self.best[0]
        _, high = score_bounds(a.angles, a.norm, rows.angles[:, mine], rows.norm[mine])
        order = np.argsort(-high)
        for part in (order[:FIRST_SCORED], order[FIRST_SCORED:]):
            at = mine[part[high[part] >= best.worst]]
            best.add(scores_of(at), rows.id[at], rows.no_id[at])


class _Negatives:
    """Other-label search for one anchor: one window for each of its positives."""

    def __init__(self, anchor, k: int):
        self.windows = anchor.windows
        self.best = [_Best(k) for _ in anchor.windows]

    def look(self, a, scores_of, rows: _Side) -> None:
        open_ = [(max(low, b.worst), high) for (low, high), b in zip(self.windows, self.best) if low <= high]
        if not open_:
            return
        low, high = score_bounds(a.angles, a.norm, rows.angles, rows.norm)
        near = np.zeros(len(low), dtype=bool)
        for least, most in open_:
            near |= (high >= least) & (low <= most)
        at = np.flatnonzero(near & (rows.label != a.label))
        score = scores_of(at)
        for (least, most), best in zip(self.windows, self.best):
            fit = np.flatnonzero((score >= max(least, best.worst)) & (score <= most))
            best.add(score[fit], rows.id[at[fit]], rows.no_id[at[fit]])


class _Anchor:
    def __init__(self, side: _Side, i: int, windows):
        self.row, self.label, self.norm = side.row[i], side.label[i], side.norm[i]
        self.q, self.angles, self.windows = side.q[i], side.angles[:, i], windows


def _search(width: int, search, k: int):
    """Tasks over (anchor block, row block, rows), anchors first in each pair."""

    def results(held):
        out = [(a.row, p, int(s), None if none else int(i)) for a, find in held for p, b in enumerate(find.best)
               for s, i, none in zip(b.score, b.id, b.none)]
        return pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], pa.int64()) for j in range(4)],
                                          names=["anchor", "positive", "score", "vec_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("ab", "rb", "kind")])
            cuts = np.flatnonzero(np.any(keys[:, 1:] != keys[:, :-1], axis=0)) + 1 if len(batch) else []
            for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if tuple(keys[:2, a]) != key:
                    if held:
                        yield results(held)
                    key, held = tuple(keys[:2, a]), []
                side = _Side(part, width)
                if keys[2, a] == 0:
                    windows = part.column("windows").to_pylist()
                    for i in range(b - a):
                        anchor = _Anchor(side, i, [(w["low"], w["high"]) for w in windows[i] or []])
                        held.append((anchor, search(anchor, k)))
                    continue
                exact, longest = side.q.astype(float), side.norm.max()
                for anchor, find in held:
                    # all partial sums stay below the product of the norms
                    plain = anchor.norm * longest < 2.0**52
                    q = anchor.q.astype(float) if plain else anchor.q
                    rows_q = exact if plain else side.q
                    find.look(anchor, lambda at, q=q, rows_q=rows_q: (rows_q[at] @ q).astype(np.int64), side)
        if held:
            yield results(held)

    return run


_WINDOWS = "array<struct<low:long,high:long>>"


def _against_all(anchors: DataFrame, rows: DataFrame, width: int, search, k: int) -> DataFrame:
    """(anchor, positive, score, vec_id): the best ``k`` for every anchor and
    search, over all pairs of blocks. ``anchors`` has a column ``windows``."""
    spark = rows.sparkSession
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    anchor_blocks = -(-anchors.count() // ANCHOR_BLOCK) or 1
    row_blocks = -(-rows.count() // ROW_BLOCK) or 1
    place = F.xxhash64("row")

    def block(n, seed):
        return F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n))

    left = anchors.withColumns({"ab": block(anchor_blocks, 1), "rb": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1).cast("long"))),
                                "kind": F.lit(0)})
    right = rows.withColumns({"windows": F.lit(None).cast(_WINDOWS), "rb": block(row_blocks, 2),
                              "ab": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(anchor_blocks - 1).cast("long"))), "kind": F.lit(1)})
    names = ["ab", "rb", "kind", "row", "vec_id", "label", "q", "norm", "angles", "windows"]
    tasks = max(wide, min(anchor_blocks * row_blocks, 32_768))
    pairs = (left.select(*names).unionByName(right.select(*names)).repartition(tasks, "ab", "rb")
             .sortWithinPartitions("ab", "rb", "kind", place))
    found = pairs.mapInArrow(_search(width, search, k), "anchor long, positive long, score long, vec_id long")
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(rows: DataFrame, label: Column, anchor: Column, positives: int = 5, negatives: int = 3,
         least: tuple[int, int] = (1, 2), most: tuple[int, int] = (19, 20)) -> DataFrame:
    """The hard negatives of all anchors. ``rows``: vec_id, embedding; ``label``
    and ``anchor`` are columns of it (``anchor`` may use vec_id only). A negative's
    score s satisfies least * p <= s <= most * p (fractions) for the positive's p."""
    spark = rows.sparkSession
    ints = integer_rows(rows, label)
    width = usual_length(ints, "q")
    if width is None:
        return spark.createDataFrame([], OUT)
    table = prepare(ints, width)
    anchors = table.where(F.coalesce(anchor, F.lit(False)))
    bare = anchors.withColumn("windows", F.lit(None).cast(_WINDOWS))
    path = scratch_path(spark, "positives")
    _against_all(bare, table, width, _Positives, positives).write.parquet(path)
    found = spark.read.parquet(path)
    p = F.col("score").cast("decimal(38,0)")
    low, high = F.ceil(p * least[0] / least[1]), F.floor(p * most[0] / most[1])
    wanted = found.groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_list(F.struct(
        "rank", low.cast("long").alias("low"), high.cast("long").alias("high")))).alias("windows"))
    wanted = wanted.withColumn("windows", F.transform("windows", lambda w: F.struct(w["low"].alias("low"), w["high"].alias("high"))))
    hard = _against_all(anchors.join(wanted, "row"), table, width, _Negatives, negatives)
    hard = hard.select("anchor", (F.col("positive") + 1).cast("int").alias("which"), F.col("rank").alias("nth"),
                       F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    named = found.select("anchor", F.col("rank").alias("which"), F.col("vec_id").alias("positive_id"),
                         F.col("score").alias("positive_score"))
    return (hard.join(named, ["anchor", "which"]).join(ids, "anchor")
            .select("anchor_id", "positive_id", F.col("nth").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """The contract's anchors, labels and windows over ``embeddings``."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(embeddings, moved, F.col("vec_id") % 50 == 0)
