"""Replay of a stored table in the rhythm of a rate source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringspan.schema import require_columns


def rate_stream(spark: SparkSession, rows_per_second: int = 10_000) -> DataFrame:
    """``timestamp, value``: an endless counter with arrival times."""
    return (
        spark.readStream.format("rate")
        .option("rowsPerSecond", rows_per_second)
        .option("rampUpTime", 0)
        .load()
    )


def tick_stream(spark: SparkSession, rows_per_batch: int, start_ms: int = 0, step_ms: int = 1_000) -> DataFrame:
    """``timestamp, value``: the same counter in micro-batches of a fixed size, at a clock of its own that moves
    ``step_ms`` with each of them. What a micro-batch holds depends on its number alone, so a replay can be repeated.
    """
    return (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("startTimestamp", start_ms)
        .option("advanceMillisPerBatch", step_ms)
        .load()
    )


def replay_join(
    rate: DataFrame,
    table: DataFrame,
    how: str = "inner",
    offset: int = 0,
    rows: int | None = None,
) -> DataFrame:
    """Give each tick of ``rate`` (``timestamp, value``) the table row with ``id = value % n + offset``.

    Ids are dense from 0, so offset 0 replays the whole table; ``how="left"`` with offset 1 is the
    variant in which the last key finds no row. ``n`` is counted once unless given. Spark plans the
    table's side by its size in bytes: a stored table below ``spark.sql.autoBroadcastJoinThreshold`` is broadcast, a
    larger one shuffled, in batches and streams alike. An empty table yields no match.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how={how!r}; one of inner, left")
    require_columns(table, ["id"])
    n = table.count() if rows is None else rows
    key = (F.col("value") % F.lit(n) + offset) if n else F.lit(None).cast("long")
    ticks = rate.withColumnRenamed("timestamp", "rate_ts").withColumn("id", key)
    return ticks.join(table, "id", how)
