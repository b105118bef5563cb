"""Call records derived from a generic ``events(event_id, ts, user_id, event_type, value)`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from ringspan.operators.pairing import calls_to_events

EVENT_TABLE = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)


def calls_from(table: DataFrame) -> DataFrame:
    """One call per table row; batch or stream. Needs the session time zone UTC."""
    start = F.expr("unix_millis(cast(ts as timestamp))")
    length = F.when(F.col("event_type").isin("error", "signup"), F.lit(0).cast("long")).otherwise(
        F.floor(F.col("value") * 12000)
    )
    outcome = (
        F.when(F.col("event_type") == "error", "failed")
        .when(F.col("event_type") == "signup", "busy")
        .otherwise("connected")
    )
    return table.select(
        F.col("event_id").alias("unique_id"),
        start.alias("start_ts"),
        (start + length).alias("end_ts"),
        (F.lit(9_000_000_000) + F.col("user_id") % 50).alias("caller"),
        (F.lit(9_000_000_000) + (F.col("user_id") * 7 + F.col("event_id")) % 1000).alias("callee"),
        outcome.alias("disposition"),
        (F.lit(100_000_000) + F.col("user_id")).alias("imei"),
    )


def calls_table(spark: SparkSession, folder: str) -> DataFrame:
    return calls_from(spark.read.parquet(f"{folder}/events.parquet"))


def events_table(spark: SparkSession, folder: str) -> DataFrame:
    return calls_to_events(calls_table(spark, folder))


def table_stream(
    spark: SparkSession, folder: str, files_per_trigger: int | None = None
) -> DataFrame:
    """The same table as a file stream. The name is written as a pattern, as a stream takes a single file only so."""
    reader = spark.readStream.schema(EVENT_TABLE)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{folder}/events.parque[t]")
