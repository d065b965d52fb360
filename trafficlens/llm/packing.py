"""Best-fit packing of token sequences by hierarchical residual packing.

Each partition packs its pieces best-fit (longest first) and closes its bins.
Bins filled to ``nearly_full``
(by default: to the last token, since one piece may have a single one) are final. The other bins become items of the
next round: ``FAN_IN`` neighbouring nodes of a tree merge, their underfull bins
are packed best-fit again, and so on up to one root.

What a node hands on is bounded without loss. Of the bins of a best fit any two
hold more than the capacity together, so at most one is half full or less, and
two bins can only merge if one of them is. A merge of ``FAN_IN`` nodes therefore
moves at most ``FAN_IN`` bins, and with r merges left on the way to the root no
more than ``FAN_IN * r`` bins of one fill are ever used. A node hands on that many
bins of each fill (at most ``capacity * FAN_IN * r`` pairs, for any table): the
packing is the same as if it handed on all. Rounds after the first move (bin,
fill) pairs only, and each round's pairs are checkpointed.

Null text is empty (one token, the end id). Rows with null or repeated ids are
packed like any other; extra columns are ignored; an empty table gives an empty
result. Longer documents are cut into full pieces and a rest."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .arrow import small_batches
from .textbatch import blocks, buffers
from .wordbpe import encoder

CAPACITY = 2048
END_ID = 0
NEARLY_FULL = 1.0  # a bin is final when no token fits
FAN_IN = 8
ROWS_AT_ONCE = 400_000
BLOCK_BYTES = 1 << 20

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, place long, fill long, node long"


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, place, fill): longest first, each item into the fullest bin that
    still takes it. Ties go by position, so equal input packs equally."""
    order = np.argsort(-lengths, kind="stable")
    bins, places = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps, fills = 0, []  # gaps: bit g is set where a bin with g free places is
    for i, need in zip(order.tolist(), lengths[order].tolist()):
        enough = gaps >> need
        if enough:
            gap = need + (enough & -enough).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps ^= 1 << gap
        else:
            gap, b = capacity, len(fills)
            fills.append(0)
        bins[i], places[i] = b, capacity - gap
        fills[b] += need
        if gap > need:
            by_gap[gap - need].append(b)
            gaps |= 1 << (gap - need)
    return bins, places, np.array(fills, dtype=np.int64)


def token_pieces(data: np.ndarray, offsets: np.ndarray, path: str, capacity: int, end_id: int):
    """(row, piece, start, length, crc) arrays of a block of texts."""
    ids, first = encoder(path).block(data, offsets)
    end = np.array([end_id], dtype="<u4")
    rows, pieces, starts, lengths, crcs = [], [], [], [], []
    for row, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        whole = np.concatenate([ids[a:b], end]).astype("<u4", copy=False)
        for piece, at in enumerate(range(0, len(whole), capacity)):
            part = whole[at:at + capacity]
            rows.append(row)
            pieces.append(piece)
            starts.append(at)
            lengths.append(len(part))
            crcs.append(zlib.crc32(part))
    return tuple(np.array(x, dtype=np.int64) for x in (rows, pieces, starts, lengths, crcs))


def _leaves(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """Every piece with its bin of the first round (``_PIECE``)."""

    def packed(held: list, node: int, number: int) -> tuple[pa.RecordBatch, int]:
        ids = pa.concat_arrays([h[0] for h in held])
        piece, start, length, crc = (np.concatenate([h[k] for h in held]) for k in range(1, 5))
        bins, places, fills = best_fit(length, capacity)
        columns = [ids, pa.array(piece.astype(np.int32)), *(pa.array(x) for x in (
            start, length, crc, (node << 32) + number + bins, places, fills[bins], np.full(len(bins), node)))]
        names = [x.split()[0] for x in _PIECE.split(", ")]
        return pa.RecordBatch.from_arrays(columns, names=names), number + len(fills)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, number, held, n = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for a, b in blocks(offsets, BLOCK_BYTES):
                rows, *rest = token_pieces(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], path, capacity, end_id)
                held.append((batch.column(0).slice(a, b - a).take(pa.array(rows)), *rest))
                n += len(rows)
                if n >= ROWS_AT_ONCE:
                    out, number = packed(held, node, number)
                    held, n = [], 0
                    yield out
        if held:
            yield packed(held, node, number)[0]

    return docs.select("doc_id", "text").mapInArrow(run, _PIECE)


def _merged(bins: DataFrame, capacity: int, of_each_fill: int, full: int) -> DataFrame:
    """One round: (bin, fill, node) to (bin, parent, base, fill, node, open)."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["fill", "bin"], ascending=[False, True], ignore_index=True)
        bins, places, fills = best_fit(rows["fill"].to_numpy(), capacity)
        first = np.flatnonzero(places == 0)
        parent = np.zeros(len(fills), np.int64)
        parent[bins[first]] = rows["bin"].to_numpy()[first]
        order = np.argsort(fills, kind="stable")
        place = np.zeros(len(fills), np.int64)  # among the bins of the same fill
        place[order] = np.arange(len(fills)) - np.searchsorted(fills[order], fills[order])
        is_open = (fills < full) & (place < of_each_fill)
        return pd.DataFrame({"bin": rows["bin"], "parent": parent[bins], "base": places, "fill": fills[bins],
                             "node": rows["node"], "open": is_open[bins]})

    return bins.groupBy("node").applyInPandas(merge, "bin long, parent long, base long, fill long, node long, open boolean")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         nearly_full: float = NEARLY_FULL, fan_in: int = FAN_IN) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. ``docs`` has doc_id and text."""
    ensure_checkpoint_dir(docs.sparkSession)
    small_batches(docs.sparkSession)
    full = int(nearly_full * capacity)
    leaves = _leaves(docs, path, capacity, end_id).checkpoint()
    moved = None
    open_bins = (leaves.where((F.col("place") == 0) & (F.col("fill") < full))
                 .select("bin", "fill", (F.floor(F.col("node") / fan_in)).alias("node")))
    last = leaves.agg(F.max("node")).first()[0] or 0
    rounds = 0
    while fan_in ** rounds <= last:
        rounds += 1
    for left in range(rounds - 1, -1, -1):
        merged = _merged(open_bins, capacity, fan_in * left, full).checkpoint()
        step = merged.select("bin", "parent", "base")
        if moved is None:
            moved = step
        else:
            later = step.select(F.col("bin").alias("parent"), F.col("parent").alias("higher"), F.col("base").alias("more"))
            moved = (moved.join(later, "parent", "left")
                     .select("bin", F.coalesce("higher", "parent").alias("parent"),
                             (F.col("base") + F.coalesce("more", F.lit(0))).alias("base")))
        open_bins = (merged.where((F.col("base") == 0) & F.col("open"))
                     .select("bin", "fill", (F.floor(F.col("node") / fan_in)).alias("node")))
    placed = leaves
    if moved is not None:
        placed = leaves.join(moved, "bin", "left")
    else:
        placed = leaves.withColumns({"parent": F.lit(None).cast("long"), "base": F.lit(None).cast("long")})
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32",
                         F.coalesce("parent", "bin").alias("sequence_id"),
                         (F.col("place") + F.coalesce("base", F.lit(0))).alias("offset"))
