"""Running a stream into a table, flushing its tail, and reading its progress."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ringspan.functions.time import SNAPSHOT_DELAY_S, SNAPSHOT_SIZE_S, now_ms
from ringspan.operators.snapshots import (
    next_triggers,
    watermark_snapshots,
    watermark_snapshots_started,
)

PROGRESS = StructType(
    [
        StructField("batch_id", LongType()),
        StructField("processing_time", StringType()),
        StructField("watermark", StringType()),
        StructField("watermark_s", LongType()),
        StructField("input_rows", LongType()),
        StructField("late_rows", LongType()),
    ]
)


def materialize_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet table that batch queries can read while it grows.

    Rows go from the executors to the table and never through the driver. Each query needs its own
    ``checkpoint``. With ``every`` ("1 second") it keeps running; without, it stops when the input
    at hand is used up.

    Adaptive execution does not apply to streams, so every micro-batch runs as many tasks per stateful
    step as there were shuffle partitions at the first start. ``state_partitions`` sets that number for
    this query; the default is the session's.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    return start_stream(writer, stream, checkpoint, every, name, state_partitions)


def start_stream(
    writer: DataStreamWriter,
    stream: DataFrame,
    checkpoint: str,
    every: str | None = None,
    name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start a writer of ``stream`` with the settings of ``materialize_stream``."""
    writer = writer.option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    writer = writer.trigger(**({"processingTime": every} if every else {"availableNow": True}))
    if state_partitions is None:
        return writer.start()
    conf, key = stream.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    conf.set(key, str(state_partitions))
    try:
        return writer.start()  # the query keeps a copy of the session's settings
    finally:
        conf.set(key, before)


def with_tail(stream: DataFrame, folder: str) -> DataFrame:
    """``stream`` plus a second, at first empty, source below ``folder`` for ``push_tail``."""
    spark = stream.sparkSession
    spark.createDataFrame([], stream.schema).write.mode("ignore").parquet(folder)
    return stream.unionByName(spark.readStream.schema(stream.schema).parquet(folder))


def push_tail(spark: SparkSession, folder: str, schema: StructType, far: Row) -> None:
    """Add one far-future row, which moves the watermark past all real windows."""
    spark.createDataFrame([far], schema).write.mode("append").parquet(folder)


def _finish(query: StreamingQuery) -> list:
    """Wait for a query that ends by itself; all its progress reports, however many batches it took
    (the query keeps only the latest ones)."""
    reports, ended = {}, False
    while not ended:
        ended = query.awaitTermination(1)
        reports.update({(report.batchId, report.timestamp): report for report in query.recentProgress})
    return list(reports.values())


def run_to_end(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    flush: Callable[[], None] | None = None,
    state_partitions: int | None = None,
) -> tuple[DataFrame, list]:
    """Process all available input and return the written table and the progress reports.

    ``flush`` adds input that closes the open windows (see ``push_tail``) once the data is through;
    the stream then resumes from its checkpoint. Without it the windows the watermark has not passed
    are withheld, as append mode does.
    """

    def start() -> StreamingQuery:
        return materialize_stream(stream, path, checkpoint, state_partitions=state_partitions)

    progress = _finish(start())
    if flush is not None:
        flush()
        progress += _finish(start())
    return stream.sparkSession.read.schema(stream.schema).parquet(path), progress


def late_rows(progress: Iterable) -> int:
    """Rows that came after the watermark had passed their window and were dropped."""
    return sum(_late(report) for report in progress)


def _late(report) -> int:
    return sum(operator.numRowsDroppedByWatermark for operator in report.stateOperators)


def watermark_seconds(text: str | None) -> int | None:
    """ISO watermark of a progress report as epoch seconds."""
    return None if text is None else int(datetime.fromisoformat(text.replace("Z", "+00:00")).timestamp())


def stamp_arrival(stream: DataFrame) -> DataFrame:
    """Add ``arrived_ms``, the time of the micro-batch that brought a row, for ``due_snapshots``."""
    return stream.withColumn("arrived_ms", now_ms())


def _milliseconds(timestamp: str) -> int:
    return round(datetime.fromisoformat(timestamp.replace("Z", "+00:00")).timestamp() * 1000)


def due_snapshots(
    table: DataFrame,
    progress: Iterable,
    every_s: int = SNAPSHOT_SIZE_S - SNAPSHOT_DELAY_S,
    last: int = 0,
    started: bool = False,
) -> DataFrame:
    """Analyse the rows a stream has written so far at each watermark that is due.

    A watermark is due when it lies ``every_s`` after the last one analysed (``last``, for a caller
    that polls a running stream). The rows so far are those of the micro-batch that reports the watermark and of
    the ones before it; ``table`` holds them all, with ``arrived_ms`` (see ``stamp_arrival``), and is read
    once for all watermarks.
    """
    reports = sorted(progress, key=lambda report: report.timestamp)
    begins = [_milliseconds(report.timestamp) for report in reports]
    reached = [watermark_seconds((report.eventTime or {}).get("watermark")) for report in reports]
    due = next_triggers([wm for wm in reached if wm is not None], every_s, last)
    # What a report's micro-batch brought was stamped before the next one began.
    upto = {wm: end for wm, end in reversed(list(zip(reached, [*begins[1:], 1 << 62])))}
    spark = table.sparkSession
    watermarks = spark.createDataFrame([(wm,) for wm in due], "wm long")
    # For each stamp the first due watermark that sees it: one row per micro-batch and watermark.
    limits = spark.createDataFrame([(upto[wm], 0, wm) for wm in due], "arrived_ms long, is_row int, wm long")
    stamps = table.select("arrived_ms").distinct().select("arrived_ms", F.lit(1), F.lit(None).cast("long"))
    ahead = Window.orderBy(F.desc("arrived_ms"), "is_row").rowsBetween(Window.unboundedPreceding, 0)
    seen = limits.union(stamps).withColumn("visible_s", F.min("wm").over(ahead)).where("is_row = 1")
    calls = table.join(seen.select("arrived_ms", "visible_s"), "arrived_ms").where("visible_s is not null")
    analyse = watermark_snapshots_started if started else watermark_snapshots
    return analyse(calls, watermarks)


def progress_table(spark: SparkSession, progress: Iterable) -> DataFrame:
    """Progress reports (``query.recentProgress``, a bounded list) as a table."""
    return spark.createDataFrame([report_row(report) for report in progress], PROGRESS)


def report_row(report) -> tuple:
    """The values of ``PROGRESS`` in a report."""
    watermark = (report.eventTime or {}).get("watermark")
    return (
        report.batchId,
        report.timestamp,
        watermark,
        watermark_seconds(watermark),
        report.numInputRows,
        _late(report),
    )


def run_batches(query: StreamingQuery, batches: int, limit_s: float = 600) -> None:
    """Let a query over an endless source finish so many micro-batches, then stop it."""
    until = time.monotonic() + limit_s
    try:
        while True:
            report = query.lastProgress
            if report is not None and report.batchId >= batches - 1:
                return
            if not query.isActive:
                raise query.exception() or RuntimeError("the query stopped by itself")
            if time.monotonic() > until:
                raise TimeoutError(f"fewer than {batches} micro-batches in {limit_s} s")
            time.sleep(0.2)
    finally:
        query.stop()
