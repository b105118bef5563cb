"""CSV and Parquet readers for calls and events, batch and stream, and the result writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ringspan.schema import CALLS, EVENTS, WINDOW_RESULT, require_columns, with_id

# Fixed value: the event time is called ``timestamp`` in the files.
_FILE_EVENT_TIME = "timestamp"


def _file_schema(schema: StructType, has_id: bool) -> StructType:
    renamed = StructType(
        [
            StructField(_FILE_EVENT_TIME if f.name == "event_ts" else f.name, f.dataType)
            for f in schema
        ]
    )
    return with_id(renamed) if has_id else renamed


def text_schema(schema: StructType) -> StructType:
    """The same columns, all strings."""
    return StructType([StructField(f.name, StringType()) for f in schema])


def _typed(schema: StructType) -> list[Column]:
    return [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]


def parse_calls(text: DataFrame, has_id: bool = False) -> DataFrame:
    """Typed calls from string columns, batch or stream: the rows whose id, start and end are readable
    and whose caller is readable or empty (an empty caller becomes 0). Header lines do not parse."""
    no_caller = F.coalesce(F.col("caller"), F.lit("")) == ""
    return (
        text.withColumn("_no_caller", no_caller)
        .select(*_typed(_file_schema(CALLS, has_id)), "_no_caller")
        .withColumn(
            "caller", F.when(F.col("_no_caller"), F.lit(0).cast("long")).otherwise(F.col("caller"))
        )
        .drop("_no_caller")
        .where(
            "unique_id is not null and start_ts is not null and end_ts is not null and caller is not null"
        )
    )


def parse_events(text: DataFrame, has_id: bool = False) -> DataFrame:
    """Typed events from string columns, batch or stream: the rows with readable type and time."""
    return (
        text.select(*_typed(_file_schema(EVENTS, has_id)))
        .withColumnRenamed(_FILE_EVENT_TIME, "event_ts")
        .where("event_type is not null and event_ts is not null")
    )


# ``bad="null"`` and ``bad="drop"`` are reader modes.
_MODES = {"null": "PERMISSIVE", "drop": "DROPMALFORMED"}


def _read(spark: SparkSession, path: str, schema: StructType, bad: str) -> DataFrame:
    if bad == "parse":
        return spark.read.schema(text_schema(schema)).option("header", False).csv(path)
    if bad not in _MODES:
        raise ValueError(f"bad={bad!r}; one of null, drop, parse")
    return spark.read.schema(schema).option("header", True).option("mode", _MODES[bad]).csv(path)


def read_calls(
    spark: SparkSession, path: str, bad: str = "null", has_id: bool = False
) -> DataFrame:
    """Calls from CSV with an explicit schema.

    ``bad`` says what becomes of malformed input: ``null`` turns bad fields into NULL, ``drop`` drops
    every row with a bad or missing field, ``parse`` keeps what ``parse_calls`` can use.
    """
    raw = _read(spark, path, _file_schema(CALLS, has_id), bad)
    return parse_calls(raw, has_id) if bad == "parse" else raw


def read_events(
    spark: SparkSession, path: str, bad: str = "null", has_id: bool = False
) -> DataFrame:
    """Events from CSV, the file's ``timestamp`` renamed to ``event_ts``; ``bad`` as in ``read_calls``."""
    raw = _read(spark, path, _file_schema(EVENTS, has_id), bad)
    if bad == "parse":
        return parse_events(raw, has_id)
    return raw.withColumnRenamed(_FILE_EVENT_TIME, "event_ts")


def read_calls_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """CSV files of calls as a stream, malformed lines left out."""
    schema = text_schema(_file_schema(CALLS, has_id=False))
    return parse_calls(_csv_stream(spark, path, schema, files_per_trigger))


def read_events_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """CSV files of events as a stream, malformed lines left out."""
    schema = text_schema(_file_schema(EVENTS, has_id=False))
    return parse_events(_csv_stream(spark, path, schema, files_per_trigger))


def _csv_stream(spark, path, schema, files_per_trigger) -> DataFrame:
    return read_signal_stream(spark, path, schema, "csv", files_per_trigger, header=False)


def write_events_csv(events: DataFrame, path: str) -> None:
    events.withColumnRenamed("event_ts", _FILE_EVENT_TIME).write.option("header", True).csv(path)


def register(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` available to ``spark.sql`` under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def register_signals(calls: DataFrame, events: DataFrame) -> None:
    """Views ``mono_signal`` and ``bi_signal`` with the file's column names, for queries in SQL text."""
    register(calls, "mono_signal")
    register(events.withColumnRenamed("event_ts", _FILE_EVENT_TIME), "bi_signal")


def read_signal_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
    header: bool = True,
) -> DataFrame:
    """A folder (or glob) of files as a stream, oldest file first."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", header)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def write_windows(
    windows: DataFrame, path: str, fmt: str = "csv", checkpoint: str | None = None
) -> StreamingQuery | None:
    """Write window results (nine columns); a stream needs its own ``checkpoint`` folder."""
    require_columns(windows, WINDOW_RESULT)
    rows = windows.select(*WINDOW_RESULT)
    if not rows.isStreaming:
        writer = rows.write.format(fmt)
        (writer.option("header", True) if fmt == "csv" else writer).save(path)
        return None
    if checkpoint is None:
        raise ValueError("a streaming write needs a checkpoint folder of its own")
    sink = rows.writeStream.format(fmt).outputMode("append")
    if fmt == "csv":
        sink = sink.option("header", True)
    return (
        sink.option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
