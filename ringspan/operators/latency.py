"""Publish metrics per window and their summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringspan.functions.time import PUBLISH_WAIT_MS, now_ms
from ringspan.operators.running import accumulate
from ringspan.schema import WINDOW_RESULT, require_columns

# Distinct latencies (ms) ordered by one task.
_VALUES_PER_CELL = 65_536


def stamp_ingest(df: DataFrame) -> DataFrame:
    """Arrival time ``ingest_ts``: the wall clock when the (micro-)batch is read."""
    return df.withColumn("ingest_ts", now_ms())


def add_publish_metrics(
    windows: DataFrame,
    wait_ms: int = PUBLISH_WAIT_MS,
    publish_ms: Column | None = None,
    zero_without_arrival: bool = True,
) -> DataFrame:
    """Window results with the nine columns of the result file.

    Takes ``window_start_ms, count, max_ts, max_type, max_ingest_ms``; ``publish_ms`` defaults to the
    wall clock of the (micro-)batch. Windows without an arrival have the latency 0; with
    ``zero_without_arrival`` off the latency is always the difference, as for start/end events.
    """
    require_columns(windows, ["window_start_ms", "count", "max_ts", "max_type", "max_ingest_ms"])
    publish = now_ms() if publish_ms is None else publish_ms
    latency = F.col("publish_time_ms") - F.col("max_ingest_ms")
    if zero_without_arrival:
        latency = F.when(F.col("max_ingest_ms") > 0, latency).otherwise(F.lit(0).cast("long"))
    timed = windows.withColumns(
        {"timer_ts": F.col("max_ts") + wait_ms + 1, "publish_time_ms": publish}
    )
    return timed.withColumns(
        {
            "event_wait_ms": F.greatest(
                F.lit(0).cast("long"), F.col("publish_time_ms") - F.col("timer_ts")
            ),
            "publish_latency_ms": latency,
        }
    ).select(*WINDOW_RESULT)


def latency_summary(windows: DataFrame, column: str = "publish_latency_ms") -> DataFrame:
    """One row ``count, avg, p50, p95`` with exact ranks.

    ``column`` holds whole milliseconds. ``p50`` is the true median; ``p95`` is the value of rank
    ``floor(0.95 n)`` (from 1). Values are folded into a histogram, whose running counts give the
    ranks; nothing is sorted as a whole.
    """
    histogram = (
        windows.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("long").alias("v"))
        .agg(F.count("*").alias("n"))
    )
    ranked = accumulate(histogram, "v", ["n"], _VALUES_PER_CELL)

    def at_rank(rank: Column) -> Column:
        return F.min(F.when(F.col("n_upto") >= rank, F.col("v")))

    total = F.col("n_total")
    p95_rank = F.greatest(F.floor(total * F.lit(0.95)), F.lit(1).cast("long"))
    return ranked.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("count"),
        (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("avg"),
        (
            (at_rank(F.floor((total + 1) / 2)) + at_rank(F.floor(total / 2) + 1)) / F.lit(2.0)
        ).alias("p50"),
        at_rank(p95_rank).alias("p95"),
    )
