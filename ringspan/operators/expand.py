"""One row to many: ranges, copies, windows and dyadic covers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringspan.functions.time import bucket, floor_to

# Longest array built for one row. A longer range is emitted in several arrays, so that one
# record with a wild end time costs time but not memory.
_CHUNK = 4096


def explode_range(df: DataFrame, lo: Column, hi: Column, step: int, name: str) -> DataFrame:
    """A row per value ``lo, lo+step, .. <= hi``; none where ``lo > hi`` or a bound is NULL."""
    return (
        df.withColumns({"_lo": lo, "_hi": hi})
        .where(F.col("_lo") <= F.col("_hi"))
        .withColumn("_from", F.explode(F.sequence("_lo", "_hi", F.lit(step * _CHUNK).cast("long"))))
        .withColumn(
            name,
            F.explode(
                F.sequence(
                    "_from",
                    F.least(F.col("_hi"), F.col("_from") + step * (_CHUNK - 1)),
                    F.lit(step).cast("long"),
                )
            ),
        )
        .drop("_lo", "_hi", "_from")
    )


def repeat_rows(df: DataFrame, copies: Column) -> DataFrame:
    """Each row ``copies`` times."""
    return explode_range(df, F.lit(1).cast("long"), copies.cast("long"), 1, "_copy").drop("_copy")


def expand_windows(calls: DataFrame, window_ms: int, name: str = "window_start") -> DataFrame:
    """A row per call and epoch-aligned window it touches.

    Stateless, so it also runs on a stream. Batch counts do not use it: they aggregate first and
    expand the (small) aggregate.
    """
    return explode_range(
        calls, floor_to("start_ts", window_ms), floor_to("end_ts", window_ms), window_ms, name
    )


def cover_windows(calls: DataFrame, window_ms: int) -> DataFrame:
    """Cover each call's windows by power-of-two blocks: at most two ``(level, node)`` per level.

    Block ``node`` of ``level`` spans windows ``node * 2^level .. (node + 1) * 2^level - 1``. A call
    over *n* windows needs at most ``2 log2(n)`` blocks, so a day-long call costs a couple of dozen
    rows and not thousands.
    """
    spans = calls.withColumns(
        {"_a": bucket("start_ts", window_ms), "_b": bucket("end_ts", window_ms) + 1}
    ).where("_a < _b")
    levels = spans.withColumn(
        "level", F.explode(F.expr("sequence(0, cast(ceil(log2(_b - _a)) as int))"))
    ).withColumns(
        {
            "_l": F.expr("shiftright(_a + shiftleft(1L, level) - 1, level)"),
            "_r": F.expr("shiftright(_b, level)"),
        }
    ).where("_l < _r")
    # The left edge takes a block where it is odd, the right edge likewise; a single window (level 0)
    # is taken by exactly one of them.
    return levels.withColumn(
        "node",
        F.explode(
            F.expr("array(if(_l & 1 = 1, _l, null), if(_r & 1 = 1, _r - 1, null))")
        ),
    ).where("node is not null").drop("_a", "_b", "_l", "_r")


def spread_cover(blocks: DataFrame, window_ms: int, name: str) -> DataFrame:
    """A row per block and window start inside it."""
    size = F.expr("shiftleft(1L, level)")
    first = F.col("node") * size
    return (
        explode_range(blocks, first, first + size - 1, 1, "_w")
        .withColumn(name, F.col("_w") * window_ms)
        .drop("_w", "level", "node")
    )
