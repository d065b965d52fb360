"""Packet captures (classic pcap and pcapng): source and sink.

Capture bytes are read once. Every file is cut into byte ranges of
``range_bytes``; a task takes a range, finds its first record, frames what begins
in it (``framing.py``) and numbers the records from 0. What comes out is staged as
Parquet in the shared checkpoint folder, frames or (``decode``) the much
narrower features made of them in the same job, with one border row per range. A
window over the border rows of each file then

* checks that every range begins where the one before it ended (a range in which
  no record begins must lie inside a record), and that no block file declares
  interfaces behind its first packet; a file that fails is framed again as one
  range, so the rows are exact either way;
* gives the ordinal of each range's first record and the file's total.

Rows meet their range's facts by a broadcast of the border table while its size
is below ``BORDER_BYTES`` (estimated from its rows and paths), by a shuffle beyond.

A last record cut short by the end of the file is dropped and counted as broken,
as is everything behind a record whose length can't be (``capture_report``). Empty
files give no rows; a file that is no capture is an error."""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.labels import attach_class_index, normalise_class_name
from ..session import scratch_path
from .framing import BORDER, FIELDS, frame_range, local_path

RANGE_BYTES = 256 << 20
BATCH_BYTES = 8 << 20
TASK_BYTES = 64 << 20
BORDER_BYTES = 32 << 20
FILES_PER_TASK = 64

_RANGE = "path string, class_name string, CLASS int, range_idx int, low long, high long, length long"
_STAGED = ("path string, class_name string, CLASS int, range_idx int, local long, ts timestamp, linktype int, orig_len int, "
           f"frame binary, border {BORDER}")
FRAMED = ["path", "ordinal", "ts", "linktype", "orig_len", "frame", "class_name", "CLASS", "n_in_capture"]
Decode = Callable[[DataFrame, list[str]], DataFrame]


def list_captures(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Capture files under ``root`` with their class folder:
    ``(path, length, class_name)``; only the listing is read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", glob).load(root).select("path", "length"))
    return files.withColumn("class_name", normalise_class_name(
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)))


def _ranges(listing: DataFrame, range_bytes: int) -> DataFrame:
    number = F.greatest(F.ceil(F.col("length") / range_bytes), F.lit(1))
    low = F.col("range_idx") * F.lit(range_bytes).cast("long")
    rows = listing.select("path", "class_name", "CLASS", "length", F.explode(F.sequence(F.lit(0), (number - 1).cast("int"))).alias("range_idx"))
    return rows.select("path", "class_name", "CLASS", "range_idx", low.alias("low"),
                       F.least(low + range_bytes, F.col("length")).alias("high"), "length")


def _framed(ranges: DataFrame, batch_bytes: int, frames: bool) -> DataFrame:
    """Framing of ranges: record rows and border rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                for got in frame_range(r["path"], r["length"], r["range_idx"], r["low"], r["high"], batch_bytes, frames):
                    n = got.num_rows
                    facts = [pa.array([r[k]] * n, t) for k, t in (("path", pa.string()), ("class_name", pa.string()),
                                                                  ("CLASS", pa.int32()), ("range_idx", pa.int32()))]
                    yield pa.RecordBatch.from_arrays([*facts, *got.columns], names=["path", "class_name", "CLASS", "range_idx", *FIELDS.names])

    return ranges.mapInArrow(run, _STAGED)


def _tasks(listing: DataFrame, range_bytes: int, partitions: int | None) -> int:
    """About one task per range or ``FILES_PER_TASK`` files; small ranges share one
    by ``TASK_BYTES``, so their number doesn't grow with the fineness of the ranges."""
    if partitions:
        return partitions
    files, size = listing.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    base = int(listing.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(base, -(-files // FILES_PER_TASK), -(-size // max(range_bytes, TASK_BYTES)))


def _checked(borders: DataFrame) -> DataFrame:
    """Border rows with ``offset`` (records of the ranges before), ``total`` (of the
    file) and ``sound`` (the file's ranges fit together)."""
    file = Window.partitionBy("path")
    earlier = file.orderBy("range_idx").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max("exit").over(earlier)  # -1 from ranges in which nothing begins
    first = F.col("range_idx") == 0
    fits = first | ((F.col("sync") >= 0) & (F.col("sync") == reached)) | ((F.col("sync") < 0) & (reached >= F.col("high")))
    alone = F.max("range_idx").over(file) == 0
    sound = F.min(F.coalesce(fits, F.lit(False)) & ~(F.col("odd") & ~alone)).over(file)
    return borders.withColumns({"offset": F.coalesce(F.sum("records").over(earlier), F.lit(0)),
                                "total": F.sum("records").over(file), "sound": sound})


def _staged(listing: DataFrame, range_bytes: int, batch_bytes: int, partitions: int | None, decode: Decode | None,
            frames: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, borders) of a listing, read once and staged."""
    spark = listing.sparkSession
    ranges = _ranges(listing, range_bytes).repartition(_tasks(listing, range_bytes, partitions), "path", "range_idx")
    rows = _framed(ranges, batch_bytes, frames)
    if decode is not None:
        rows = decode(rows, ["path", "class_name", "range_idx", "local", "border"])
    path = scratch_path(spark, "framed")
    rows.write.parquet(path)
    staged = spark.read.schema(rows.schema).parquet(path)
    high = (F.col("range_idx") + 1) * F.lit(range_bytes).cast("long")
    borders = staged.where(F.col("border").isNotNull()).select("path", "range_idx", "border.*", high.alias("high"))
    return staged.where(F.col("border").isNull()).drop("border"), _checked(borders)


def _settled(listing: DataFrame, range_bytes: int, batch_bytes: int, partitions: int | None, decode: Decode | None,
             frames: bool = True) -> list[tuple[DataFrame, DataFrame]]:
    """The staged rows and sound borders of all files; those whose ranges don't fit
    are framed again, each as one range."""
    spark = listing.sparkSession
    rows, borders = _staged(listing, range_bytes, batch_bytes, partitions, decode, frames)
    path = scratch_path(spark, "borders")
    borders.write.parquet(path)
    borders = spark.read.schema(borders.schema).parquet(path)
    out = [(rows, borders.where("sound"))]
    odd = borders.where(~F.col("sound")).select("path").distinct()
    if not odd.isEmpty():
        again = listing.join(odd, "path", "left_semi")
        out.append(_staged(again, 1 << 62, batch_bytes, partitions, decode, frames))
    return out


def _joined(rows: DataFrame, borders: DataFrame) -> DataFrame:
    facts = borders.select("path", "range_idx", "offset", F.col("total").alias("n_in_capture"))
    size = facts.agg(F.coalesce(F.sum(F.length("path") + 64), F.lit(0))).first()[0]
    facts = F.broadcast(facts) if size <= BORDER_BYTES else facts
    return (rows.join(facts, ["path", "range_idx"])
            .withColumn("ordinal", F.col("offset") + F.col("local")).drop("offset", "local", "range_idx"))


def frames_from_listing(listing: DataFrame, classes: list[str] | None = None, batch_bytes: int = BATCH_BYTES,
                        partitions: int | None = None, range_bytes: int = RANGE_BYTES, decode: Decode | None = None) -> DataFrame:
    """Framed records of a listing ``(path, length, class_name)``; or what
    ``decode(frames, keep)`` makes of them (its result holds the columns ``keep``), with
    ``ordinal`` and ``n_in_capture``. Pass ``classes`` for stable class indices
    across separate runs (streams)."""
    known = attach_class_index(listing.select("path", "length", "class_name"), "class_name", "CLASS", classes)
    parts = [_joined(*p) for p in _settled(known, range_bytes, batch_bytes, partitions, decode)]
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.select(*FRAMED) if decode is None else out


def read_captures(spark: SparkSession, root: str, classes: list[str] | None = None, batch_bytes: int = BATCH_BYTES,
                  glob: str = "*", partitions: int | None = None, range_bytes: int = RANGE_BYTES,
                  decode: Decode | None = None) -> DataFrame:
    """Framed records of every capture under ``root/<class>/``, with
    ``class_name``, ``CLASS`` (sorted class index) and ``n_in_capture``."""
    listing = list_captures(spark, root, glob)
    if classes is not None:
        listing = listing.where(F.col("class_name").isin(*classes))
    return frames_from_listing(listing, classes, batch_bytes, partitions, range_bytes, decode)


def capture_report(spark: SparkSession, root: str, glob: str = "*", range_bytes: int = RANGE_BYTES,
                   batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Per capture: class_name, records, broken records and bytes read; no frame is kept."""
    listing = list_captures(spark, root, glob).withColumn("CLASS", F.lit(None).cast("int"))
    parts = [borders for _, borders in _settled(listing, range_bytes, batch_bytes, None, None, frames=False)]
    borders = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    per_file = borders.groupBy("path").agg(F.sum("records").alias("records"), F.sum("broken").alias("broken_records"),
                                           F.sum("bytes_read").alias("bytes_read"))
    return listing.select("path", "class_name").join(per_file, "path")


# ---- sink ------------------------------------------------------------------------

def _pcap_header(linktype: int, snaplen: int = 262144) -> bytes:
    return struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, snaplen, linktype)


class _Output:
    """Write-then-rename output on a local or remote (pyarrow.fs) path, so a
    retried task replaces its file atomically."""

    def __init__(self, final: str):
        self.final = final
        self.tmp = f"{final}.{uuid.uuid4().hex}.tmp"
        local = local_path(final)
        if local is not None:
            os.makedirs(os.path.dirname(local), exist_ok=True)
            self.fs, self.f = None, open(local_path(self.tmp), "wb")
        else:
            from pyarrow import fs as pafs
            self.fs, inner = pafs.FileSystem.from_uri(self.tmp)
            self._tmp_inner = inner
            self._final_inner = pafs.FileSystem.from_uri(final)[1]
            self.f = self.fs.open_output_stream(inner)

    def write(self, b: bytes) -> None:
        self.f.write(b)

    def drop(self) -> None:
        """Of a task that failed nothing appears under the final name."""
        self.f.close()

    def close(self) -> None:
        self.f.close()
        if self.fs is None:
            os.replace(local_path(self.tmp), local_path(self.final))
        else:
            self.fs.move(self._tmp_inner, self._final_inner)


def _write_fn(root: str, class_col: str):
    def write(batches):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        outs: dict[str, _Output] = {}
        try:
            for rb in batches:
                d = rb.to_pydict()
                for i in range(rb.num_rows):
                    cls = d[class_col][i]
                    if cls not in outs:
                        outs[cls] = _Output(f"{root.rstrip('/')}/{cls}/part-{pid:05d}.pcap")
                        outs[cls].write(_pcap_header(d["linktype"][i]))
                    us = d["ts_us"][i]
                    body = d["frame"][i]
                    outs[cls].write(struct.pack("<IIII", us // 1_000_000, us % 1_000_000, len(body),
                                                d["orig_len"][i]) + body)
        except BaseException:
            for o in outs.values():
                o.drop()
            raise
        for o in outs.values():
            o.close()
        yield pa.RecordBatch.from_arrays([pa.array([o.final for o in outs.values()], pa.string())],
                                         names=["file"])
    return write


def write_captures(frames: DataFrame, root: str, class_col: str = "class_name",
                   order: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """Write framed records as classic pcap files ``root/<class>/part-N.pcap``
    (one file per class and task, records in ``order`` inside a file), on
    local or remote storage. Returns the written file list."""
    n = partitions or int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    order = order or ["ts_us"]
    rows = frames.select(class_col, "linktype", "orig_len", "frame",
                         F.unix_micros("ts").alias("ts_us"), *[c for c in order if c != "ts_us"])
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    out = ranged.select(class_col, "linktype", "orig_len", "frame", "ts_us") \
        .mapInArrow(_write_fn(root, class_col), "file string")
    return out
