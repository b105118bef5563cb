"""Progress reports of streams, kept in a table by a listener."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StringType, StructField, StructType

from ringspan.streaming.run import PROGRESS, report_row

LOGGED = StructType([StructField("query_id", StringType()), StructField("run_id", StringType()), *PROGRESS.fields])


class ProgressLog(StreamingQueryListener):
    """Appends the progress reports of a session's streams to a Parquet table, ``hold`` reports a file.

    A query keeps only its latest reports and loses them with its run; the table has those of all runs. A file is
    written when ``hold`` reports are at hand and when a query ends; ``hold=1`` writes each at once.
    """

    def __init__(self, spark: SparkSession, path: str, hold: int = 20) -> None:
        super().__init__()
        self.spark, self.path, self.hold = spark, path, hold
        self._rows: list[tuple] = []
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()
        spark.createDataFrame([], LOGGED).write.mode("ignore").parquet(path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = event.progress
        with self._lock:
            self._rows.append((str(report.id), str(report.runId), *report_row(report)))
            if len(self._rows) >= self.hold:
                self._flush()

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._flush()
        self._end_of(str(event.runId)).set()

    def _end_of(self, run_id: str) -> threading.Event:
        return self._ended.setdefault(run_id, threading.Event())

    def _flush(self) -> None:
        rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, LOGGED).coalesce(1).write.mode("append").parquet(self.path)

    def settled(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Wait until all reports of an ended run are in the table."""
        return self._end_of(str(query.runId)).wait(seconds)

    def read(self, query_id: str | None = None) -> DataFrame:
        """The reports of all runs so far, of one query if given."""
        rows = self.spark.read.schema(LOGGED).parquet(self.path)
        return rows if query_id is None else rows.where(F.col("query_id") == query_id)
