"""Stream runners: sources, the foreachBatch sink, scoring and ingest.

Every stream writes through ``foreachBatch`` into a table of committed epochs
(``sink.py``: a replayed micro-batch leaves it unchanged) and keeps its offsets
in a checkpoint location under the shared checkpoint folder, so a restarted job
(or a lost executor) resumes exactly where it stopped.
``trigger(availableNow=True)`` processes everything present and stops,
which is how batch-equivalence is tested."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields
from ..operators.labels import normalise_class_name
from ..plans import projections as P
from ..session import scratch_path
from ..sources import capture as CAP
from . import sink as SK

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def events_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1) -> DataFrame:
    """The events table as a file stream (the source watches the folder and
    picks the events file by name)."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .option("pathGlobFilter", "events.parquet").parquet(sf_dir))


def run_to_table(stream: DataFrame, path: str, mode: str = "append", checkpoint: str | None = None,
                 transform=None, stats: dict | None = None) -> str:
    """Run ``stream`` until all available input is processed; each
    micro-batch is written (optionally transformed) as an epoch of the table at
    ``path``: read it with ``sink.read_table`` (append), ``sink.read_last``
    (complete) or ``sink.read_latest`` (update). ``stats`` (a dict)
    receives the input rows, micro-batches and the rows that stateful
    operators dropped as later than the watermark (counted after partial
    aggregation: late samples of one group count once per task). Late data
    is judged against the watermark of the previous micro-batch."""
    spark = stream.sparkSession
    ckpt = checkpoint or scratch_path(spark, "stream-ckpt")
    run = SK.run_name(ckpt)

    def sink(batch: DataFrame, epoch_id: int):
        SK.write_epoch(transform(batch) if transform else batch, path, run, epoch_id)

    q = (stream.writeStream.outputMode(mode).foreachBatch(sink)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    if stats is not None:
        stats.update(progress_totals(q.recentProgress))
    return path


def progress_totals(progress) -> dict:
    """Input rows, batches and watermark-dropped rows over query progress."""
    def get(obj, key, default=0):
        try:
            return obj[key]
        except (KeyError, TypeError, IndexError):
            return getattr(obj, key, default)
    late = 0
    rows = 0
    for p in progress:
        rows += get(p, "numInputRows") or 0
        for op in get(p, "stateOperators", []) or []:
            late += get(op, "numRowsDroppedByWatermark") or 0
    return {"input_rows": int(rows), "batches": len(progress), "late_rows": int(late)}


def run_in_arrivals(spark: SparkSession, slices: list[DataFrame], start, path: str, mode: str) -> str:
    """Rows that arrive in slices, as from a job that is started again for each:
    every slice is added to a folder, and the stream ``start(source)`` goes on from
    its checkpoint. ``slices`` have one schema."""
    source, ckpt = scratch_path(spark, "arrivals"), scratch_path(spark, "stream-ckpt")
    for part in slices:
        part.write.mode("append").parquet(source)
        run_to_table(start(spark.readStream.schema(part.schema).parquet(source)), path, mode, ckpt)
    return path


def score_stream(model: PipelineModel, packets: DataFrame) -> DataFrame:
    """Scoring is a stateless projection: the fitted pipeline applies to a
    streaming DataFrame unchanged."""
    return model.transform(packets)


def packets_stream(spark: SparkSession, sf_dir: str, classes: list[str]) -> DataFrame:
    """Streaming packet features from the events stream (explicit class list:
    indices must not depend on what one micro-batch happens to contain)."""
    ev = events_stream(spark, sf_dir)
    frames = P.packets(ev, classes=classes)
    return fields.packet_features(frames, keep=["path", "event_id"])


def ingest_captures(spark: SparkSession, root: str, out: str, classes: list[str],
                    files_per_trigger: int = 100, checkpoint: str | None = None) -> str:
    """New capture files under ``root/<class>/`` → packet features appended
    to ``out``. The stream reads only file paths (never content); each
    micro-batch's file list drives the distributed index + framing job."""
    listing = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
               .option("recursiveFileLookup", "true")
               .option("maxFilesPerTrigger", files_per_trigger).load(root)
               .select("path", "length"))

    def ingest(batch: DataFrame) -> DataFrame:
        lst = batch.withColumn("class_name", normalise_class_name(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)))
        return CAP.frames_from_listing(lst, classes, decode=fields.packet_features_of).drop("n_in_capture", "class_name")

    return run_to_table(listing, out, "append", checkpoint, ingest)
