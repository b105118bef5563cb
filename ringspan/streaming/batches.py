"""Micro-batches handed to a function, once each in effect, and the tables such functions keep.

A stream may run its last micro-batch again after a failure. Everything here is stored by the number of the
micro-batch, so a batch that is run again replaces what it wrote. Rows go from executors to tables; of a
batch the driver sees a few numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ringspan.functions.time import (
    HALF_MINUTE_MS,
    PUBLISH_WAIT_MS,
    SNAPSHOT_DELAY_S,
    SNAPSHOT_SIZE_S,
)
from ringspan.operators.active import active_interval_rows, open_at_window_end
from ringspan.operators.snapshots import snapshot_overlap, snapshot_started
from ringspan.streaming.run import start_stream

Act = Callable[[DataFrame, int], None]


class BatchTable:
    """A Parquet table that a stream fills, a folder for each micro-batch."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType) -> None:
        self.spark, self.path = spark, path
        self.schema = StructType([*schema.fields, StructField("batch_id", LongType())])

    @staticmethod
    def create(spark: SparkSession, path: str, schema: StructType) -> BatchTable:
        """The table, with an empty batch -1 so that it can be read before the first one is there."""
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/batch_id=-1")
        return BatchTable(spark, path, schema)

    def put(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Write or replace a batch and return it as it is stored: the stream's own plan runs once."""
        rows.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        return self.read().where(F.col("batch_id") == batch_id).drop("batch_id")

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def upto(self, batch_id: int) -> DataFrame:
        """The rows so far. Folders of other batches are not looked into."""
        return self.read().where(F.col("batch_id") <= batch_id)


class _Memory:
    """A few numbers carried from each micro-batch to the next: a stored row per batch."""

    def __init__(self, spark: SparkSession, path: str, names: list[str]) -> None:
        self.schema = StructType([StructField(name, LongType()) for name in names])
        self.table = BatchTable.create(spark, path, self.schema)

    def before(self, batch_id: int) -> Row:
        stored = self.table.read().where(F.col("batch_id") == batch_id - 1).drop("batch_id").first()
        return stored or Row(*self.schema.names)(*[None] * len(self.schema))

    def put(self, batch_id: int, *values: int | None) -> None:
        row = self.table.spark.createDataFrame([values], self.schema)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.table.path}/batch_id={batch_id}")


def each_batch(
    stream: DataFrame,
    act: Act,
    checkpoint: str,
    every: str | None = None,
    name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Call ``act(rows, batch_id)`` for each micro-batch; the arguments are those of ``materialize_stream``.

    ``act`` runs on the driver and should store what it makes by ``batch_id`` (see ``BatchTable``).
    """
    return start_stream(stream.writeStream.foreachBatch(act), stream, checkpoint, every, name, state_partitions)


def append_to(path: str) -> Act:
    """Store each micro-batch's rows below ``path``."""

    def act(rows: DataFrame, batch_id: int) -> None:
        BatchTable.create(rows.sparkSession, path, rows.schema).put(rows, batch_id)

    return act


def running_totals(path: str, window_ms: int = HALF_MINUTE_MS) -> Act:
    """``open_at_window_end`` while the stream runs: takes the windows of ``stream_window_deltas`` as they close.

    Windows close in their order, so a batch continues from the total the batch before it ended with. That
    number is stored with each batch and survives restarts. The table is ``{path}/totals``.
    """

    def act(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        closed = BatchTable.create(spark, f"{path}/closed", rows.schema).put(rows, batch_id)
        memory = _Memory(spark, f"{path}/carry", ["open"])
        carry = memory.before(batch_id)["open"] or 0
        totals = open_at_window_end(closed, window_ms).withColumn("count", F.col("count") + carry)
        BatchTable.create(spark, f"{path}/totals", totals.schema).put(totals, batch_id)
        added = closed.agg(F.sum("delta_sum")).first()[0] or 0
        memory.put(batch_id, carry + added)

    return act


def due_analysis(
    path: str,
    every_s: int = SNAPSHOT_SIZE_S - SNAPSHOT_DELAY_S,
    wait_ms: int = 1_000,
    size_s: int = SNAPSHOT_SIZE_S,
    delay_s: int = SNAPSHOT_DELAY_S,
    started: bool = False,
) -> Act:
    """Calls pile up in ``{path}/calls``; when the watermark is ``every_s`` past the last one analysed, the calls
    that are there are analysed at it, before the next micro-batch begins. Results are in ``{path}/snapshots``.

    The watermark of a micro-batch is ``wait_ms`` before the latest end of the batches before it. An analysis
    reads the calls behind it only, as its range is a filter on the stored ends.
    """
    analyse = snapshot_started if started else snapshot_overlap

    def act(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        calls = BatchTable.create(spark, f"{path}/calls", rows.schema)
        here = calls.put(rows, batch_id)
        memory = _Memory(spark, f"{path}/marks", ["latest", "analysed"])
        latest, analysed = memory.before(batch_id)
        wm = None if latest is None else (latest - wait_ms) // 1000
        due = wm is not None and wm >= (analysed or 0) + every_s
        result = analyse(calls.upto(batch_id), wm if due else 0, size_s, delay_s)
        BatchTable.create(spark, f"{path}/snapshots", result.schema)
        if due:
            BatchTable(spark, f"{path}/snapshots", result.schema).put(result, batch_id)
        last = here.agg(F.max("end_ts")).first()[0]
        ends = [end for end in (latest, last) if end is not None]
        memory.put(batch_id, max(ends, default=None), wm if due else analysed)

    return act


def corrected_windows(path: str, wait_ms: int = PUBLISH_WAIT_MS, window_ms: int = HALF_MINUTE_MS) -> Act:
    """Rows per window, published once the window is closed and again whenever a late call changes it.

    A window closes when the latest end so far, less ``wait_ms``, has passed it. ``{path}/versions`` gets a row per
    publication: ``window_start_ms, count, max_ts, max_type, max_ingest_ms``, whole and not as a difference,
    ``correction`` for a window that had been closed before, and the version as ``batch_id``. No call is dropped for
    being late. ``latest_versions`` is the state of all windows.
    """

    def act(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        calls = rows.select("start_ts", "end_ts", "ingest_ts")
        landed = BatchTable.create(spark, f"{path}/calls", calls.schema).put(calls, batch_id)
        counted = active_interval_rows(landed, window_ms)
        counts = BatchTable.create(spark, f"{path}/counts", counted.schema)
        # In window order, so that a range of windows is few row groups.
        here = counts.put(counted.sort("window_start_ms"), batch_id)
        memory = _Memory(spark, f"{path}/marks", ["latest"])
        before = memory.before(batch_id)["latest"]
        last = landed.agg(F.max("end_ts")).first()[0]
        lowest = here.agg(F.min("window_start_ms")).first()[0]
        latest = max((end for end in (before, last) if end is not None), default=None)
        memory.put(batch_id, latest)

        end = F.col("window_start_ms") + window_ms
        closed_before = F.lit(False) if before is None else end <= before - wait_ms
        closed = F.lit(False) if latest is None else end <= latest - wait_ms
        so_far = counts.upto(batch_id).where(closed)
        fresh = so_far.where(~closed_before).withColumn("correction", F.lit(False))
        touched = here.where(closed_before).select("window_start_ms")
        opened = (
            so_far.where(closed_before & (F.col("window_start_ms") >= F.lit(lowest)))
            .join(touched, "window_start_ms", "left_semi")
            .withColumn("correction", F.lit(True))
        )
        versions = (
            fresh.unionByName(opened)
            .groupBy("window_start_ms", "correction")
            .agg(
                F.sum("count").alias("count"),
                F.max("max_ts").alias("max_ts"),
                F.lit("end").alias("max_type"),
                F.max("max_ingest_ms").alias("max_ingest_ms"),
            )
        )
        BatchTable.create(spark, f"{path}/versions", versions.schema).put(versions, batch_id)

    return act


def latest_versions(versions: DataFrame) -> DataFrame:
    """Of each window the row published last, and how many ``versions`` of it there were."""
    row = F.struct(*[c for c in versions.columns if c not in ("window_start_ms", "batch_id", "correction")])
    return (
        versions.groupBy("window_start_ms")
        .agg(F.max_by(row, "batch_id").alias("row"), F.count("*").alias("versions"))
        .select("window_start_ms", "row.*", "versions")
    )
