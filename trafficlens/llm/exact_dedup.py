"""Exact duplicates by skew-safe combining.

Texts are equal when they are identical after each run of ``[\\x20\\x09-\\x0D]``
is replaced by one space. Three stages, each comparing whole contents:

1. locally, within an Arrow batch, only one row of each content goes on;
2. those winners meet by (digest, salt): a content that fills a third of the
   table is spread over ``SALTS`` groups;
3. the winners of the salts meet by digest.

Contents travel compressed (the same content compresses to the same bytes, and
different ones to different bytes), so comparing them compares the whole text.
Each row learns its final winner through (digest, doc_id) pairs: row to local
winner, to salt winner, to final winner; every step gathers a bounded number of
rows per key whatever the size of the group.

Null text is empty. The smallest doc_id of a group stays, null ids come last; of
rows that repeat the same id and text exactly one stays. An empty table gives an
empty result. Extra columns are kept by ``drop_copies`` whatever their names."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import slices
from .slot import free
from .textbatch import _WS, buffers

SALTS = 32
LOCAL_BYTES = 8 << 20


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Each white-space run of each text as one space: (bytes, offsets)."""
    space = _WS[data]
    again = np.zeros(len(data), dtype=bool)
    again[1:] = space[1:] & space[:-1]
    again[offsets[:-1][offsets[:-1] < len(data)]] = False
    stays = ~again
    size = np.add.reduceat(stays, np.minimum(offsets[:-1], len(data) - 1), dtype=np.int64) if len(data) else np.zeros(len(offsets) - 1, np.int64)
    size[np.diff(offsets) == 0] = 0
    return np.where(space, np.uint8(32), data)[stays].tobytes(), np.concatenate([[0], np.cumsum(size)])


def _local(batch: pa.RecordBatch, at: int):
    """(contents, digests, winner row of each row) of one batch; column 0 is doc_id."""
    raw, offsets = normalised(*buffers(batch.column(at)))
    ids = batch.column(0).to_pylist()
    bodies = [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    digests = [hashlib.sha256(b).digest() for b in bodies]
    best: dict[bytes, int] = {}
    for i, body in enumerate(bodies):
        j = best.setdefault(body, i)
        if j != i and ids[i] is not None and (ids[j] is None or ids[i] < ids[j]):
            best[body] = i
    return ids, bodies, digests, [best[b] for b in bodies]


def _members(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, sha, local (its local winner's doc_id), first, ordinal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free()
        for batch in slices(batches, 1, LOCAL_BYTES):
            ids, _, digests, winner = _local(batch, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array([ids[w] for w in winner], pa.int64()),
                 pa.array([w == i for i, w in enumerate(winner)]), pa.array(range(len(ids)), pa.int32())],
                names=["doc_id", "sha", "local", "first", "ordinal"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, sha binary, local long, first boolean, ordinal int")


def _winners(docs: DataFrame) -> DataFrame:
    """Per local winner: sha, doc_id, n (rows it stands for), body (compressed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in slices(batches, 1, LOCAL_BYTES):
            ids, bodies, digests, winner = _local(batch, 1)
            n = np.bincount(winner, minlength=len(ids))
            rows = [i for i, w in enumerate(winner) if w == i]
            yield pa.RecordBatch.from_arrays(
                [pa.array([digests[i] for i in rows], pa.binary()), pa.array([ids[i] for i in rows], pa.int64()),
                 pa.array(n[rows]), pa.array([pack(bodies[i]) for i in rows], pa.binary())],
                names=["sha", "doc_id", "n", "body"])

    return docs.select("doc_id", "text").mapInArrow(run, "sha binary, doc_id long, n long, body binary")


def _combined(winners: DataFrame, keys: list[str]) -> DataFrame:
    """One merge: rows of equal keys and content learn ``keep`` and ``total``;
    ``top`` marks one row of each."""
    same = Window.partitionBy(*keys).orderBy(F.col("doc_id").asc_nulls_last())
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return winners.withColumns({"keep": F.first("doc_id").over(whole), "total": F.sum("n").over(whole),
                                "top": F.row_number().over(same) == 1})


def _links(docs: DataFrame, salts: int) -> DataFrame:
    """sha, local, keep_id, group_size for each (digest, local winner's id)."""
    salted = _combined(_winners(docs).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts))), ["sha", "salt", "body"])
    final = _combined(salted.where("top").select("sha", "body", F.col("keep").alias("doc_id"), F.col("total").alias("n")),
                      ["sha", "body"]).select("sha", F.col("doc_id").alias("mid"), F.col("keep").alias("keep_id"),
                                              F.col("total").alias("group_size"))
    # total stays in use so that both readers of the salted merge share its exchange
    step = salted.where("total > 0").select(F.col("sha").alias("s"), F.col("doc_id").alias("local"), F.col("keep").alias("mid_keep")).distinct()
    on = (F.col("s") == F.col("sha")) & F.col("mid_keep").eqNullSafe(F.col("mid"))
    return step.join(final, on).select("sha", "local", "keep_id", "group_size").distinct()


def duplicate_groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    links = _links(docs, salts).select(F.col("sha").alias("s"), F.col("local").alias("l"), "keep_id", "group_size")
    rows = _members(docs).join(links, (F.col("s") == F.col("sha")) & F.col("l").eqNullSafe(F.col("local")))
    could = F.col("first") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    rows = rows.withColumns({"could": could, "salt": F.when(could, 0).otherwise(F.col("ordinal") % 1024)})
    one = Window.partitionBy("sha", "doc_id", "could", "salt").orderBy("ordinal")
    return rows.select("doc_id", "keep_id", "group_size", (F.col("could") & (F.row_number().over(one) == 1)).alias("kept"),
                       F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    doc_id, text = names[docs.columns.index("doc_id")], names[docs.columns.index("text")]
    schema = T.StructType([*plain.schema.fields, T.StructField("sha", T.BinaryType()), T.StructField("winner_id", T.LongType())])
    id_at, text_at = names.index(doc_id), names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free()
        for batch in slices(batches, text_at, LOCAL_BYTES):
            _, _, digests, winner = _local(pa.RecordBatch.from_arrays([batch.column(id_at), batch.column(text_at)], names=["doc_id", "text"]), 1)
            rows = pa.array([i for i, w in enumerate(winner) if w == i], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(c.take(rows) for c in batch.columns), pa.array(digests, pa.binary()).take(rows), batch.column(id_at).take(rows)],
                names=[*names, "sha", "winner_id"])

    # keys without nulls, so that join and deduplication share one exchange of the texts
    winner = {"winner": F.coalesce("winner_id", F.lit(0)), "without": F.col("winner_id").isNull()}
    # the size stays in use so that the readers of the salted merge share its exchange here too
    links = _links(docs.select("doc_id", "text"), salts).where("group_size > 0")
    kept = links.select("sha", F.col("keep_id").alias("winner_id")).distinct().withColumns(winner)
    local = plain.mapInArrow(run, schema).withColumns(winner)
    key = ["sha", "winner", "without"]
    return (local.join(kept.select(*key), key, "left_semi").dropDuplicates(key)
            .select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns))))
