"""Start and end events to calls, and back.

Three pairing rules:

``all``         every end of the same id, whatever the order;
``all_after``   every end strictly after the start;
``first_after`` the earliest end strictly after the start, NULL when there is none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringspan.operators.running import SLICE_MS, nearest_later
from ringspan.schema import END, START

RULES = ("all", "all_after", "first_after")


def is_start() -> Column:
    return F.col("event_type") == START


def is_end() -> Column:
    return F.col("event_type") == END


def calls_to_events(calls: DataFrame) -> DataFrame:
    """One call row to a start and an end event; other columns are kept."""
    rest = [c for c in calls.columns if c not in ("start_ts", "end_ts")]
    endpoints = F.array(
        F.struct(F.lit(START).alias("event_type"), F.col("start_ts").alias("event_ts")),
        F.struct(F.lit(END).alias("event_type"), F.col("end_ts").alias("event_ts")),
    )
    return calls.select(*rest, F.inline(endpoints))


def pair_calls(
    events: DataFrame,
    rule: str = "first_after",
    sliced: bool = True,
    slice_ms: int = SLICE_MS,
) -> DataFrame:
    """``unique_id, caller, start_ts, end_ts`` under one of the three rules.

    ``all`` and ``all_after`` return every matching pair, as an equi join; counts over pairs
    (``active_pairs``) do not go through them. ``first_after`` looks ahead in one ordered pass and
    never forms a pair it does not return; it cuts every id into slices of time, unless ``sliced`` is off
    (for tables bucketed by id and known to be even).
    """
    if rule not in RULES:
        raise ValueError(f"unknown pairing rule {rule!r}; one of {RULES}")
    if rule == "first_after":
        return _pair_first_after(events, sliced, slice_ms)
    starts = events.where(is_start()).select(
        "unique_id", "caller", F.col("event_ts").alias("start_ts")
    )
    ends = events.where(is_end()).select("unique_id", F.col("event_ts").alias("end_ts"))
    pairs = starts.join(ends, "unique_id")
    return pairs.where("end_ts > start_ts") if rule == "all_after" else pairs


def _pair_first_after(events: DataFrame, sliced: bool, slice_ms: int) -> DataFrame:
    signals = events.where(is_start() | is_end()).select(
        "unique_id", "event_type", "caller", "event_ts"
    )
    known = signals.where("unique_id is not null")
    if not sliced:
        # Latest first; of equal times the starts come first and so do not see the ends they tie with.
        ahead = (
            Window.partitionBy("unique_id")
            .orderBy(F.desc("event_ts"), "event_type")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        next_end = F.min(F.when(is_end(), F.col("event_ts"))).over(ahead)
        paired = known.withColumn("next_event_ts", next_end).where(is_start())
    else:
        # Look ahead once per distinct time of an id, then give the answer to every start there.
        points = known.groupBy("unique_id", "event_ts").agg(
            F.max(is_start()).alias("has_start"), F.max(is_end()).alias("has_end")
        )
        ahead_of = nearest_later(
            points.where("event_ts is not null"),
            "unique_id",
            "event_ts",
            F.col("has_end"),
            F.col("has_start"),
            ["event_ts"],
            slice_ms,
        ).select("unique_id", "event_ts", "next_event_ts")
        paired = known.where(is_start()).join(ahead_of, ["unique_id", "event_ts"], "left")
    # A start without an id matches nothing but is still a start.
    loose = signals.where(F.col("unique_id").isNull() & is_start()).withColumn(
        "next_event_ts", F.lit(None).cast("long")
    )
    return paired.unionByName(loose).select(
        "unique_id",
        "caller",
        F.col("event_ts").alias("start_ts"),
        F.expr("if(event_ts is null, null, next_event_ts)").alias("end_ts"),
    )
