"""Active calls per window, in the several meanings the original queries use.

The counts aggregate before they expand: a call adds two window edges (or a few blocks), partial
aggregation folds them on the map side, and only the aggregate, one row per window, is shuffled,
ordered and filled out. Work per call does not grow with its length, and no window is a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringspan.functions.time import FIVE_MINUTES_MS, HALF_MINUTE_MS, bucket, floor_to, to_timestamp
from ringspan.operators.expand import cover_windows, explode_range, spread_cover
from ringspan.operators.pairing import is_end, is_start
from ringspan.operators.running import SLICE_MS, accumulate, max_before
from ringspan.schema import START

# Windows ordered by one task when totals run across windows (34 hours of half-minutes).
_WINDOWS_PER_CELL = 4096


def _edges(spans: DataFrame, window_ms: int, **weights: Column) -> DataFrame:
    """``+weight`` at the first window of a span and ``-weight`` just past its last one."""
    return spans.select(
        F.inline(
            F.array(
                F.struct(F.col("first").alias("at"), *[w.alias(n) for n, w in weights.items()]),
                F.struct(
                    (F.col("last") + window_ms).alias("at"),
                    *[(-w).alias(n) for n, w in weights.items()],
                ),
            )
        )
    )


def _spans(calls: DataFrame, window_ms: int, *columns: str) -> DataFrame:
    """First and last window of each call."""
    return calls.select(
        *columns,
        floor_to("start_ts", window_ms).alias("first"),
        floor_to("end_ts", window_ms).alias("last"),
    ).where("first <= last")


def _fill_active(edges: DataFrame, window_ms: int, shown: str = "delta") -> DataFrame:
    """Edges to ``WindowStart, ActiveCalls``: the running total of ``delta`` at every window where
    the running total of ``shown`` is positive."""
    totals = list(dict.fromkeys(["delta", shown]))
    steps = edges.groupBy("at").agg(*[F.sum(t).alias(t) for t in totals])
    levels = accumulate(steps, "at", totals, window_ms * _WINDOWS_PER_CELL)
    return explode_range(
        levels.where(F.col(f"{shown}_upto") > 0),
        F.col("at"),
        F.col("next_at") - window_ms,
        window_ms,
        "WindowStart",
    ).select("WindowStart", F.col("delta_upto").alias("ActiveCalls"))


def active_distinct(
    calls: DataFrame,
    window_ms: int = HALF_MINUTE_MS,
    sliced: bool = True,
    windows_per_slice: int = _WINDOWS_PER_CELL,
) -> DataFrame:
    """Distinct call ids overlapping each window, closed end: ``WindowStart, ActiveCalls``.

    Of each row only the windows count that no earlier-starting row of the same id has covered; what
    remains of an id is disjoint, so distinct counting turns into plain counting. Where ids are known
    to be unique, ``active_calls`` gives the same counts without shuffling anything per call. Ids are
    cut into slices of windows, unless ``sliced`` is off.
    """
    spans = _spans(calls, window_ms, "unique_id")
    known = spans.where("unique_id is not null")
    if sliced:
        folded = known.groupBy("unique_id", "first").agg(F.max("last").alias("last"))
        ranked = max_before(folded, "unique_id", "first", "last", window_ms * windows_per_slice)
    else:
        earlier = (
            Window.partitionBy("unique_id")
            .orderBy("first")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        ranked = known.withColumn("before", F.max("last").over(earlier))
    fresh = ranked.where("before is null or last > before").select(
        F.greatest(F.col("first"), F.col("before") + window_ms).alias("first"), "last"
    )
    # A row without an id opens its windows but is not counted, as in count(distinct).
    unknown = spans.where("unique_id is null")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    edges = _edges(fresh, window_ms, delta=one, present=one).unionByName(
        _edges(unknown, window_ms, delta=none, present=one)
    )
    return _fill_active(edges, window_ms, shown="present")


def active_calls(calls: DataFrame, window_ms: int = HALF_MINUTE_MS) -> DataFrame:
    """Rows (not ids) overlapping each window: ``WindowStart, ActiveCalls``."""
    edges = _edges(_spans(calls, window_ms), window_ms, delta=F.lit(1).cast("long"))
    return _fill_active(edges, window_ms)


def active_pairs(
    events: DataFrame,
    window_ms: int = HALF_MINUTE_MS,
    sliced: bool = True,
    slice_ms: int = SLICE_MS,
) -> DataFrame:
    """Start/end pairs (rule ``all_after``) overlapping each window, without forming the pairs.

    A start opens as many pairs as its id has later ends; an end closes as many as its id has earlier
    starts. Both are running totals, so an id with *m* starts and *n* ends costs *m + n* rows. Ids are cut
    into slices of time, unless ``sliced`` is off.
    """
    signals = events.where(
        (is_start() | is_end()) & F.col("unique_id").isNotNull() & F.col("event_ts").isNotNull()
    ).select("unique_id", "event_ts", "event_type")
    ranked = _sliced_ranks(signals, slice_ms) if sliced else _ranks(signals)
    window = floor_to("event_ts", window_ms)
    edges = ranked.select(
        F.inline(
            F.array(
                F.struct(window.alias("at"), (F.col("starts") * F.col("ends_after")).alias("delta")),
                F.struct(
                    (window + window_ms).alias("at"),
                    (-F.col("ends") * F.col("starts_before")).alias("delta"),
                ),
            )
        )
    ).where("delta <> 0")
    return _fill_active(edges, window_ms)


def _ranks(signals: DataFrame) -> DataFrame:
    """Per event, the starts of its id before it and the ends after it."""
    # Of equal times the ends come first: a pair needs an end strictly after its start.
    by_id = Window.partitionBy("unique_id").orderBy("event_ts", F.desc("event_type"))
    upto = by_id.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = by_id.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return signals.select(
        "event_ts",
        is_start().cast("long").alias("starts"),
        is_end().cast("long").alias("ends"),
        F.count_if(is_start()).over(upto).alias("starts_before"),
        (F.count_if(is_end()).over(whole) - F.count_if(is_end()).over(upto)).alias("ends_after"),
    )


def _sliced_ranks(signals: DataFrame, slice_ms: int) -> DataFrame:
    """The same per distinct time of an id: equal times fold on the map side, totals go slice by slice."""
    points = signals.groupBy("unique_id", "event_ts").agg(
        F.count_if(is_start()).alias("starts"), F.count_if(is_end()).alias("ends")
    )
    totals = accumulate(points, "event_ts", ["starts", "ends"], slice_ms, by=["unique_id"])
    return totals.select(
        "event_ts",
        "starts",
        "ends",
        (F.col("starts_upto") - F.col("starts")).alias("starts_before"),
        (F.col("ends_total") - F.col("ends_upto")).alias("ends_after"),
    )


def active_interval_rows(calls: DataFrame, window_ms: int = HALF_MINUTE_MS) -> DataFrame:
    """Rows overlapping each window with the latest end and the latest arrival among them.

    ``window_start_ms, count, max_ts, max_type, max_ingest_ms``; ``calls`` carries ``ingest_ts``.
    Inverted rows are dropped, zero-length rows are kept.
    """
    blocks = (
        cover_windows(calls.where("end_ts >= start_ts"), window_ms)
        .groupBy("level", "node")
        .agg(
            F.count("*").alias("n"),
            F.max("end_ts").alias("last_end"),
            F.max("ingest_ts").alias("last_ingest"),
        )
    )
    return (
        spread_cover(blocks, window_ms, "window_start_ms")
        .groupBy("window_start_ms")
        .agg(
            F.sum("n").alias("count"),
            F.max("last_end").alias("max_ts"),
            F.lit("end").alias("max_type"),
            F.max("last_ingest").alias("max_ingest_ms"),
        )
    )


def active_of_spans(spans: DataFrame, window_ms: int = HALF_MINUTE_MS) -> DataFrame:
    """``WindowStart, ActiveCalls`` from calls folded by first and last window (``first, last, n``)."""
    return _fill_active(_edges(spans.where("first <= last"), window_ms, delta=F.col("n")), window_ms)


def interval_rows_of_spans(spans: DataFrame, window_ms: int = HALF_MINUTE_MS) -> DataFrame:
    """``active_interval_rows`` from folded calls (``first, last, n, max_ts, max_ingest_ms``)."""
    blocks = (
        cover_windows(spans.withColumns({"start_ts": F.col("first"), "end_ts": F.col("last")}), window_ms)
        .groupBy("level", "node")
        .agg(F.sum("n").alias("n"), F.max("max_ts").alias("max_ts"), F.max("max_ingest_ms").alias("max_ingest_ms"))
    )
    return (
        spread_cover(blocks, window_ms, "window_start_ms")
        .groupBy("window_start_ms")
        .agg(
            F.sum("n").alias("count"),
            F.max("max_ts").alias("max_ts"),
            F.lit("end").alias("max_type"),
            F.max("max_ingest_ms").alias("max_ingest_ms"),
        )
    )


def starts_by_window_id(calls: DataFrame, window_ms: int = FIVE_MINUTES_MS) -> DataFrame:
    """Calls started per numbered window: ``WindowID, ActiveCalls``."""
    return calls.groupBy(bucket("start_ts", window_ms).alias("WindowID")).agg(
        F.count("*").alias("ActiveCalls")
    )


def starts_per_window(
    events: DataFrame, window: str = "30 seconds", delay: str | None = None
) -> DataFrame:
    """Start events per tumbling window with the latest arrival ``rate_ts``; batch or stream.

    On a stream, ``delay`` sets the watermark on the event time.
    """
    starts = events.where(is_start()).withColumn(
        "event_time", to_timestamp("event_ts")
    )
    if delay is not None:
        starts = starts.withWatermark("event_time", delay)
    return (
        starts.groupBy(F.window("event_time", window))
        .agg(F.count("*").alias("start_event_count"), F.max("rate_ts").alias("max_rate_ts"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "start_event_count",
            "max_rate_ts",
        )
    )


def window_deltas(events: DataFrame, window_ms: int = HALF_MINUTE_MS) -> DataFrame:
    """Starts minus other events, and the latest event, per window that has events.

    Events with an arrival ``ingest_ts`` also give the latest arrival ``max_ingest_ms``.
    """
    readable = events.where("event_type is not null and event_ts is not null")
    arrival = [F.max("ingest_ts").alias("max_ingest_ms")] if "ingest_ts" in events.columns else []
    return readable.groupBy(floor_to("event_ts", window_ms).alias("window_start")).agg(
        F.sum(delta_of("event_type")).alias("delta_sum"),
        F.max("event_ts").alias("max_event_ts"),
        *arrival,
    )


def delta_of(event_type: str) -> Column:
    """``+1`` for a start, ``-1`` for anything else."""
    return F.when(F.col(event_type) == START, F.lit(1)).otherwise(F.lit(-1)).cast("long")


def open_at_window_end(deltas: DataFrame, window_ms: int = HALF_MINUTE_MS) -> DataFrame:
    """Running total of ``delta_sum`` over windows: calls still open when each window ends.

    Takes the output of ``window_deltas``; windows without events stay absent.
    """
    return accumulate(deltas, "window_start", ["delta_sum"], window_ms * _WINDOWS_PER_CELL).select(
        F.col("window_start").alias("window_start_ms"),
        "delta_sum",
        F.col("delta_sum_upto").alias("count"),
        F.col("max_event_ts").alias("max_ts"),
        F.lit("delta").alias("max_type"),
        *[c for c in deltas.columns if c == "max_ingest_ms"],
    )
