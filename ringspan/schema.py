"""Record shapes.

*Calls* (mono signal): one row per call with its start and end.
*Events* (bi signal): one row per endpoint, ``event_type`` 0 for a start and 1 for an end.
All times are epoch milliseconds.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

# Column names and codes of the input files.
START, END = 0, 1

CALLS = StructType(
    [
        StructField("unique_id", LongType()),
        StructField("start_ts", LongType()),
        StructField("end_ts", LongType()),
        StructField("caller", LongType()),
        StructField("callee", LongType()),
        StructField("disposition", StringType()),
        StructField("imei", LongType()),
    ]
)

EVENTS = StructType(
    [
        StructField("unique_id", LongType()),
        StructField("event_type", IntegerType()),
        StructField("caller", LongType()),
        StructField("callee", LongType()),
        StructField("event_ts", LongType()),
        StructField("disposition", StringType()),
        StructField("imei", LongType()),
    ]
)

WINDOW_RESULT = (
    "window_start_ms",
    "count",
    "max_ts",
    "timer_ts",
    "publish_time_ms",
    "event_wait_ms",
    "publish_latency_ms",
    "max_type",
    "max_ingest_ms",
)


def with_id(schema: StructType) -> StructType:
    """The same record after ``assign_sequence_id`` has added its dense ``id``."""
    return StructType([*schema.fields, StructField("id", LongType())])


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` itself, or a ``ValueError`` that lists the missing columns."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df
