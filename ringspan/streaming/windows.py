"""Window counts on streams, in append mode.

``stream_spans`` folds calls by the windows of their start and end. A call is one row of state however long it
lasts, and ``delay`` covers the disorder of arrivals only. ``active_of_spans`` and ``interval_rows_of_spans`` turn
the folded calls, at any time, into the counts of all windows.

``stream_active_distinct`` and ``stream_interval_rows`` emit a single final row per window instead. Calls arrive when
they end, so a window is complete only after the longest call that touches it has ended: their ``delay`` must
cover the longest call, and a call is a row of state for each window it touches. A shorter delay drops rows,
and ``progress_table`` reports how many.

``stream_timed_windows`` emits a window whenever the watermark has passed its latest end, and again after late calls.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ringspan.functions.time import HALF_MINUTE_MS, PUBLISH_WAIT_MS, bucket, floor_to, to_timestamp
from ringspan.operators.active import delta_of
from ringspan.operators.expand import expand_windows, explode_range


def _window_ms(timestamp: str):
    return F.unix_millis(timestamp)


def _expanded(calls: DataFrame, window_ms: int, delay: str) -> DataFrame:
    return (
        expand_windows(calls, window_ms)
        .withColumn("window_time", to_timestamp("window_start"))
        .withWatermark("window_time", delay)
    )


def stream_spans(
    calls: DataFrame, delay: str | None, window_ms: int = HALF_MINUTE_MS, time: str = "end_ts"
) -> DataFrame:
    """Calls folded by first and last window: ``first, last, n, max_ts``, and ``max_ingest_ms`` where calls
    carry ``ingest_ts``. Inverted calls are dropped.

    ``time`` is the column calls arrive by, up to ``delay`` out of order (None for the output of
    ``stream_sent_once``, which has its watermark). What arrived in one of its windows is emitted when the watermark
    has passed that window; equal spans may come out of several of them.
    """
    arrival = [F.max("ingest_ts").alias("max_ingest_ms")] if "ingest_ts" in calls.columns else []
    if delay is not None:
        calls = calls.withColumn("event_time", to_timestamp(time)).withWatermark("event_time", delay)
    return (
        calls.where("end_ts >= start_ts")
        .withColumns({"first": floor_to("start_ts", window_ms), "last": floor_to("end_ts", window_ms)})
        .groupBy(F.window("event_time", f"{window_ms} milliseconds"), "first", "last")
        .agg(F.count("*").alias("n"), F.max("end_ts").alias("max_ts"), *arrival)
        .drop("window")
    )


def stream_sent_once(calls: DataFrame, delay: str, time: str = "end_ts") -> DataFrame:
    """Calls without those that are sent again within ``delay``: one row of state per id.

    ``time`` is the column calls arrive by. Rows without an id are one id.
    """
    return (
        calls.withColumn("event_time", to_timestamp(time))
        .withWatermark("event_time", delay)
        .dropDuplicatesWithinWatermark(["unique_id"])
    )


def stream_active_distinct(
    calls: DataFrame, delay: str, window_ms: int = HALF_MINUTE_MS
) -> DataFrame:
    """Distinct calls per window: ``WindowStart, ActiveCalls``.

    Rows are made unique per (call, window) first, which spreads a busy window over all tasks; the
    count then combines partial counts.
    """
    return (
        _expanded(calls.select("unique_id", "start_ts", "end_ts"), window_ms, delay)
        .select("unique_id", "window_time")
        .dropDuplicates(["unique_id", "window_time"])
        .groupBy("window_time")
        .agg(F.count("unique_id").alias("ActiveCalls"))
        .select(_window_ms("window_time").alias("WindowStart"), "ActiveCalls")
    )


def stream_interval_rows(
    calls: DataFrame, delay: str, window_ms: int = HALF_MINUTE_MS
) -> DataFrame:
    """Rows per window with the latest end and arrival; ``calls`` carries ``ingest_ts``."""
    rows = calls.where("end_ts >= start_ts").select("start_ts", "end_ts", "ingest_ts")
    return (
        _expanded(rows, window_ms, delay)
        .groupBy("window_time")
        .agg(
            F.count("*").alias("count"),
            F.max("end_ts").alias("max_ts"),
            F.max("ingest_ts").alias("max_ingest_ms"),
        )
        .select(
            _window_ms("window_time").alias("window_start_ms"),
            "count",
            "max_ts",
            F.lit("end").alias("max_type"),
            "max_ingest_ms",
        )
    )


def stream_window_deltas(
    events: DataFrame, delay: str, window_ms: int = HALF_MINUTE_MS
) -> DataFrame:
    """Starts minus other events per window: ``window_start, delta_sum, max_event_ts``, and the latest
    arrival ``max_ingest_ms`` where events carry ``ingest_ts``.

    The running total over windows is not a stream aggregate; ``open_at_window_end`` takes it over the
    (small) table this stream writes.
    """
    arrival = [F.max("ingest_ts").alias("max_ingest_ms")] if "ingest_ts" in events.columns else []
    return (
        events.where("event_type is not null and event_ts is not null")
        .withColumn("event_time", to_timestamp("event_ts"))
        .withWatermark("event_time", delay)
        .groupBy(F.window("event_time", f"{window_ms} milliseconds"))
        .agg(
            F.sum(delta_of("event_type")).alias("delta_sum"),
            F.max("event_ts").alias("max_event_ts"),
            *arrival,
        )
        .withColumn("window_start", _window_ms("window.start"))
        .select(
            "window_start", "delta_sum", "max_event_ts", *(["max_ingest_ms"] if arrival else [])
        )
    )



TIMED = "window_start_ms long, count long, max_ts long, timer_ts long, max_type string, max_ingest_ms long"
_HELD = "window_start_ms array<long>, count array<long>, max_ts array<long>, max_ingest_ms array<long>"
_HELD_COLUMNS = ["window_start_ms", "count", "max_ts", "max_ingest_ms"]

# Windows whose state is one row (an hour of half-minutes).
_WINDOWS_PER_KEY = 120


def stream_timed_windows(
    calls: DataFrame,
    delay: str,
    wait_ms: int = PUBLISH_WAIT_MS,
    window_ms: int = HALF_MINUTE_MS,
    windows_per_key: int = _WINDOWS_PER_KEY,
) -> DataFrame:
    """Per window the calls that touch it, emitted when the watermark has passed ``timer_ts``, which is the
    latest end among them plus ``wait_ms`` and one: ``window_start_ms, count, max_ts, timer_ts, max_type, max_ingest_ms``.

    A window's state is cleared when it is emitted. A call that comes later opens it again, and it is emitted
    again with what came since: the counts of all its emissions add up. ``calls`` carry ``ingest_ts`` (NULL: 0); the
    watermark follows their ends. Neighbouring windows share a row of state and its timer, which is that of the
    window due first; a call is a row per such group of windows.
    """
    span_ms = window_ms * windows_per_key

    def touched(group: int, lots: Iterator[pd.DataFrame]) -> pd.DataFrame:
        """The group's windows that the calls of a micro-batch touch."""
        rows = pd.concat(lots)
        first = np.maximum(rows["first"].to_numpy(), group * span_ms)
        last = np.minimum(rows["last"].to_numpy(), (group + 1) * span_ms - window_ms)
        sizes = (last - first) // window_ms + 1
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return pd.DataFrame({
            "window_start_ms": np.repeat(first, sizes) + place * window_ms,
            "count": 1,
            "max_ts": np.repeat(rows["end_ts"].to_numpy(), sizes),
            "max_ingest_ms": np.repeat(rows["ingest_ts"].to_numpy(), sizes),
        })

    def step(key: tuple, lots: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        stored = state.get if state.exists else ([], [], [], [])
        held = pd.DataFrame(dict(zip(_HELD_COLUMNS, stored)), dtype="int64")
        now = state.getCurrentWatermarkMs()
        # Due windows leave before new calls are added, also where one micro-batch brings both.
        due = held["max_ts"] + wait_ms + 1 < now
        out, held = held[due], held[~due]
        if not state.hasTimedOut:
            both = pd.concat([held, touched(key[0], lots)]).groupby("window_start_ms", as_index=False)
            held = both.agg({"count": "sum", "max_ts": "max", "max_ingest_ms": "max"})
        if len(held):
            state.update(tuple(held[c].tolist() for c in _HELD_COLUMNS))
            state.setTimeoutTimestamp(max(int(held["max_ts"].min()) + wait_ms + 1, now + 1))
        elif state.exists:
            state.remove()
        yield out.assign(timer_ts=out["max_ts"] + wait_ms + 1, max_type="end")

    spans = calls.where("end_ts >= start_ts").select(
        floor_to("start_ts", window_ms).alias("first"),
        floor_to("end_ts", window_ms).alias("last"),
        "end_ts",
        F.coalesce("ingest_ts", F.lit(0).cast("long")).alias("ingest_ts"),
        to_timestamp("end_ts").alias("event_time"),
    )
    groups = explode_range(spans, bucket("first", span_ms), bucket("last", span_ms), 1, "group")
    return (
        groups.withWatermark("event_time", delay)
        .groupBy("group")
        .applyInPandasWithState(step, TIMED, _HELD, "append", GroupStateTimeout.EventTimeTimeout)
    )
