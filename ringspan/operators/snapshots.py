"""Counts over ranges that trail a watermark: ``[wm - size, wm - delay)``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringspan.functions.time import SNAPSHOT_DELAY_S, SNAPSHOT_SIZE_S, bucket, overlaps, started_in
from ringspan.operators.expand import explode_range
from ringspan.operators.running import accumulate

# Seconds ordered by one task when totals run across seconds (about 18 hours).
_SECONDS_PER_CELL = 65_536


def _range_columns(wm: Column, size_s: int, delay_s: int) -> list[Column]:
    wm = wm.cast("long")
    return [
        wm.alias("trigger_time"),
        ((wm - size_s) * 1000).alias("window_start_ms"),
        ((wm - delay_s) * 1000).alias("window_end_ms"),
    ]


def snapshot_overlap(
    calls: DataFrame, wm_s: int, size_s: int = SNAPSHOT_SIZE_S, delay_s: int = SNAPSHOT_DELAY_S
) -> DataFrame:
    """One row: calls overlapping the range behind watermark ``wm_s`` (epoch seconds)."""
    inside = overlaps((wm_s - size_s) * 1000, (wm_s - delay_s) * 1000)
    return (
        calls.where(inside)
        .agg(F.count("*").alias("active_calls_count"))
        .select("active_calls_count", *_range_columns(F.lit(wm_s), size_s, delay_s))
    )


def snapshot_started(
    calls: DataFrame, wm_s: int, size_s: int = SNAPSHOT_SIZE_S, delay_s: int = SNAPSHOT_DELAY_S
) -> DataFrame:
    """One row: calls started inside the range, and the latest arrival ``rate_ts`` among them."""
    inside = started_in((wm_s - size_s) * 1000, (wm_s - delay_s) * 1000)
    return (
        calls.where(inside)
        .agg(F.count("*").alias("active_calls_count"), F.max("rate_ts").alias("max_rate_ts"))
        .select(
            "active_calls_count", "max_rate_ts", *_range_columns(F.lit(wm_s), size_s, delay_s)
        )
    )


def watermark_snapshots(
    calls: DataFrame,
    watermarks: DataFrame,
    size_s: int = SNAPSHOT_SIZE_S,
    delay_s: int = SNAPSHOT_DELAY_S,
) -> DataFrame:
    """``snapshot_overlap`` for every ``wm`` (distinct epoch seconds) of a table, in one pass.

    The range ends are whole seconds, so calls are first folded into seconds. A call is in range from
    the second it starts (seen from the range end) until its end, moved by the range length, has
    passed: one running total over seconds answers all watermarks, without a range join. Calls with
    a column ``visible_s`` count only from that watermark on.
    """
    span_ms = (size_s - delay_s) * 1000
    begin = bucket("start_ts", 1000)
    if "visible_s" in calls.columns:
        begin = F.greatest(begin, F.col("visible_s") - delay_s - 1)
    steps = calls.where("start_ts is not null and end_ts is not null").select(
        F.inline(
            F.array(
                F.struct(begin.alias("second"), F.lit(1).cast("long").alias("delta")),
                F.struct(
                    F.greatest(begin, bucket(F.col("end_ts") + span_ms, 1000)).alias("second"),
                    F.lit(-1).cast("long").alias("delta"),
                ),
            )
        )
    )
    # The last second before each range end, as a step of zero.
    probes = watermarks.select(
        (F.col("wm").cast("long") - delay_s - 1).alias("second"), F.lit(0).cast("long").alias("delta")
    )
    totals = accumulate(
        steps.unionByName(probes).groupBy("second").agg(F.sum("delta").alias("delta")),
        "second",
        ["delta"],
        _SECONDS_PER_CELL,
    )
    return watermarks.withColumn("second", F.col("wm").cast("long") - delay_s - 1).join(
        totals.select("second", "delta_upto"), "second"
    ).select(
        F.col("delta_upto").alias("active_calls_count"), *_range_columns(F.col("wm"), size_s, delay_s)
    )


def watermark_snapshots_started(
    calls: DataFrame,
    watermarks: DataFrame,
    size_s: int = SNAPSHOT_SIZE_S,
    delay_s: int = SNAPSHOT_DELAY_S,
) -> DataFrame:
    """``snapshot_started`` for every ``wm`` (distinct epoch seconds) of a table.

    Calls are folded into seconds before they meet the ranges; both sides of the join grow with the
    time covered and not with the calls. Calls with a column ``visible_s`` count only from that
    watermark on.
    """
    span_s = size_s - delay_s
    visible = F.col("visible_s") if "visible_s" in calls.columns else F.lit(None).cast("long")
    folded = (
        calls.where("start_ts is not null and end_ts is not null")
        .groupBy(
            bucket("start_ts", 1000).alias("second"),
            bucket(F.least("start_ts", "end_ts"), 1000).alias("still"),
            visible.alias("visible"),
        )
        .agg(F.count("*").alias("n"), F.max("rate_ts").alias("last_rate"))
        .withColumn("slot", bucket("second", span_s))
    )
    ranges = watermarks.select(F.col("wm").cast("long").alias("wm")).withColumns(
        {"lo": F.col("wm") - size_s, "hi": F.col("wm") - delay_s}
    )
    slots = explode_range(
        ranges, bucket("lo", span_s), bucket(F.col("hi") - 1, span_s), 1, "slot"
    )
    hits = (
        slots.join(folded, "slot")
        .where("second >= lo and second < hi and still >= lo and (visible is null or visible <= wm)")
        .groupBy("wm")
        .agg(F.sum("n").alias("n"), F.max("last_rate").alias("max_rate_ts"))
    )
    return ranges.select("wm").join(hits, "wm", "left").select(
        F.coalesce("n", F.lit(0).cast("long")).alias("active_calls_count"),
        "max_rate_ts",
        *_range_columns(F.col("wm"), size_s, delay_s),
    )


def next_triggers(watermarks_s: Iterable[int], every_s: int, last: int = 0) -> list[int]:
    """The watermarks at which an analysis is due: each at least ``every_s`` after the one before.

    Works on the progress reports of one query (one number per micro-batch), not on data.
    """
    due = []
    for wm in watermarks_s:
        if wm >= last + every_s:
            last = wm
            due.append(wm)
    return due
