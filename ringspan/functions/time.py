"""Time arithmetic on epoch milliseconds, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Window sizes and thresholds of the original queries, in milliseconds or seconds.
HALF_MINUTE_MS = 30_000
FIVE_MINUTES_MS = 300_000
IDLE_MINUTE_MS = 60_000
IDLE_QUARTER_HOUR_MS = 900_000
IDLE_LAG_MS = 30_000
SNAPSHOT_SIZE_S = 40
SNAPSHOT_DELAY_S = 10
PUBLISH_WAIT_MS = 2_000
LEAD_MS = 2_000


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def floor_to(ts: Column | str, size: int) -> Column:
    """Start of the epoch-aligned bucket of ``size`` that holds ``ts``."""
    ts = _col(ts)
    return ts - F.pmod(ts, F.lit(size).cast("long"))


def bucket(ts: Column | str, size: int) -> Column:
    """Number of that bucket. Integer arithmetic only: a double quotient loses digits."""
    return F.call_function("div", floor_to(ts, size), F.lit(size).cast("long"))


def to_timestamp(ms: Column | str) -> Column:
    return F.timestamp_millis(_col(ms))


def now_ms() -> Column:
    """Wall clock, fixed once per batch or micro-batch."""
    return F.unix_millis(F.current_timestamp())


def overlaps(lo_ms: Column | int, hi_ms: Column | int) -> Column:
    """The call touches ``[lo, hi)``: it had not ended before ``lo`` and began before ``hi``."""
    return (F.col("end_ts") >= lo_ms) & (F.col("start_ts") < hi_ms)


def started_in(lo_ms: Column | int, hi_ms: Column | int) -> Column:
    """The call touches ``[lo, hi)`` and began inside it."""
    return overlaps(lo_ms, hi_ms) & (F.col("start_ts") >= lo_ms)


def gap_passes(gap: Column, threshold_ms: int, inclusive: bool) -> Column:
    return gap >= threshold_ms if inclusive else gap > threshold_ms
