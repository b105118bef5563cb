"""Idle time between the calls of one caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringspan.functions.time import IDLE_LAG_MS, IDLE_MINUTE_MS, bucket, gap_passes
from ringspan.operators.expand import repeat_rows
from ringspan.operators.running import SLICE_MS, nearest_later


def idle_next_start(
    calls: DataFrame,
    threshold_ms: int = IDLE_MINUTE_MS,
    inclusive: bool = False,
    sliced: bool = True,
    slice_ms: int = SLICE_MS,
) -> DataFrame:
    """For each call, the wait until the same caller's next start strictly after its end.

    ``caller, PrevEnd, NextStart, IdleGap``, a row per call and per tied next start: starts and ends
    of a caller are put in one order, in which every end looks ahead to the next start. No two calls
    are ever joined. Every caller is cut into slices of time, so no caller is too large for a task;
    ``sliced=False`` orders each caller in one task, for tables bucketed by caller and known to be even.
    """
    endpoints = (
        calls.where("caller is not null")
        .select(
            "caller",
            F.inline(
                F.array(
                    F.struct(F.col("start_ts").alias("t"), F.lit(True).alias("start")),
                    F.struct(F.col("end_ts").alias("t"), F.lit(False).alias("start")),
                )
            ),
        )
        .where("t is not null")
    )
    waits = _sliced_waits(endpoints, slice_ms) if sliced else _waits(endpoints)
    gap = F.col("next_t") - F.col("t")
    gaps = waits.where(gap_passes(gap, threshold_ms, inclusive)).select(
        "caller",
        F.col("t").alias("PrevEnd"),
        F.col("next_t").alias("NextStart"),
        gap.alias("IdleGap"),
        "copies",
    )
    return repeat_rows(gaps, F.col("copies")).drop("copies")


def _waits(endpoints: DataFrame) -> DataFrame:
    """``caller, t, next_t, copies``: ends with the next start and the number of calls tied there."""
    # Latest first; of equal times the ends come first and so do not see the starts they tie with.
    latest = Window.partitionBy("caller").orderBy(F.desc("t"), "start")
    upto = latest.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tied = F.row_number().over(latest) - F.rank().over(latest) + 1
    return (
        endpoints.withColumn("tied", tied)
        .select(
            "caller",
            "t",
            "start",
            F.min(F.when(F.col("start"), F.col("t"))).over(upto).alias("next_t"),
            F.last(F.when(F.col("start"), F.col("tied")), ignorenulls=True)
            .over(upto)
            .alias("copies"),
        )
        .where("not start")
        .drop("start")
    )


def _sliced_waits(endpoints: DataFrame, slice_ms: int) -> DataFrame:
    """The same slice by slice."""
    # Equal times fold into one row on the map side: a slice is bounded by its milliseconds.
    points = endpoints.groupBy("caller", "t").agg(
        F.count_if("start").alias("starts"), F.count_if(~F.col("start")).alias("ends")
    )
    ahead = nearest_later(
        points, "caller", "t", F.col("starts") > 0, F.col("ends") > 0, ["t", "starts"], slice_ms
    )
    return ahead.select("caller", "t", "next_t", (F.col("ends") * F.col("next_starts")).alias("copies"))


def idle_lag(
    calls: DataFrame,
    threshold_ms: int = IDLE_LAG_MS,
    inclusive: bool = True,
    sliced: bool = True,
    slice_ms: int = SLICE_MS,
) -> DataFrame:
    """For each call, the time since the end of the same caller's previous call by start.

    ``caller, prev_end, start_ts, idle_ms``. Calls with equal starts follow each other by end, open
    ends first. Callers are cut into slices as in ``idle_next_start``.
    """
    if sliced:
        return _idle_lag_sliced(calls.select("caller", "start_ts", "end_ts"), threshold_ms, inclusive, slice_ms)
    by_start = Window.partitionBy("caller").orderBy("start_ts", "end_ts")
    idle = F.col("start_ts") - F.col("prev_end")
    return (
        calls.withColumn("prev_end", F.lag("end_ts").over(by_start))
        .where(gap_passes(idle, threshold_ms, inclusive))
        .select("caller", "prev_end", "start_ts", idle.alias("idle_ms"))
    )


def _idle_lag_sliced(
    calls: DataFrame, threshold_ms: int, inclusive: bool, slice_ms: int
) -> DataFrame:
    """``idle_lag`` slice by slice, each slice starting from the last call of the slice before.

    Of the calls that begin at one instant only the first can follow a gap, unless a sibling had
    already ended ``threshold_ms`` before that instant (an inverted record). So siblings fold into
    one row with a count on the map side, and only inverted ones keep their own.
    """
    return _lag_of_siblings(fold_siblings(calls, threshold_ms, inclusive), threshold_ms, inclusive, slice_ms)


def fold_siblings(calls: DataFrame, threshold_ms: int, inclusive: bool) -> DataFrame:
    """Calls of one caller that begin together as one row each, inverted ones apart; ``n`` of them (or the sum
    of a column ``copies``), and their latest end."""
    who, order = ["unknown", "caller"], ["start_ts", "kind", "own_gap"]
    long_ended = gap_passes(F.col("start_ts") - F.col("end_ts"), threshold_ms, inclusive)
    copies = F.sum("copies") if "copies" in calls.columns else F.count("*")
    return (
        calls.withColumns(
            {
                # 0 open end, 1 inverted, 2 ordinary: the order of siblings by end.
                "kind": F.when(F.col("end_ts").isNull(), 0).when(long_ended, 1).otherwise(2),
                "own_gap": F.when(long_ended, F.col("end_ts")),
                # Unknown callers are one group, as in PARTITION BY; the flag keeps the join plain.
                "unknown": F.col("caller").isNull(),
                "caller": F.coalesce("caller", F.lit(0).cast(calls.schema["caller"].dataType)),
            }
        )
        .groupBy(*who, *order)
        .agg(copies.alias("n"), F.max("end_ts").alias("last_end"))
    )


def _lag_of_siblings(folded: DataFrame, threshold_ms: int, inclusive: bool, slice_ms: int) -> DataFrame:
    who, order = ["unknown", "caller"], ["start_ts", "kind", "own_gap"]
    keys = [*who, "_slice"]
    sliced = folded.withColumn("_slice", bucket("start_ts", slice_ms)).repartition(*keys)

    inside = Window.partitionBy(*keys).orderBy(*order)
    local = sliced.select(
        "*", F.lag("last_end").over(inside).alias("_lag"), F.row_number().over(inside).alias("_row")
    )
    last = sliced.groupBy(*keys).agg(F.max(F.struct(*order, "last_end", "n")).alias("last"))
    before = F.lag("last.last_end").over(Window.partitionBy(*who).orderBy("_slice"))
    carry = last.select(*keys, before.alias("_carry")).where("_carry is not null")

    first = F.when(F.col("_row") == 1, F.col("_carry")).otherwise(F.col("_lag"))
    candidates = local.join(carry, keys, "left").select(
        F.when(~F.col("unknown"), F.col("caller")).alias("caller"),
        "start_ts",
        F.inline(
            F.array(
                F.struct(first.alias("prev_end"), F.lit(1).cast("long").alias("_copies")),
                F.struct(F.col("own_gap").alias("prev_end"), (F.col("n") - 1).alias("_copies")),
            )
        ),
    )
    idle = F.col("start_ts") - F.col("prev_end")
    gaps = candidates.where(gap_passes(idle, threshold_ms, inclusive)).select(
        "caller", "prev_end", "start_ts", idle.alias("idle_ms"), "_copies"
    )
    return repeat_rows(gaps, F.col("_copies")).drop("_copies")
