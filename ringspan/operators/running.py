"""Running totals and nearest-later lookups that never put one key, or everything, in one task.

They work in two steps. Rows are cut along the order column into cells of fixed width, so a task
orders one cell. One summary row per cell is ordered across cells and joined back as a carry. The
number of cells of a key is bounded by the time range, not by the row count.

Nothing runs while a frame is built. Both steps read all columns of one exchange by key and cell, so
Spark shuffles the rows once and uses the exchange twice. Rows without a place in the order have no answer
and are left out before it, where the joins behind it would leave them out on one side only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringspan.functions.time import bucket

# 1 h: at one row per key and millisecond a cell holds at most 3.6 million rows, which one task orders
# in seconds, and a key has at most 8,784 cells a year.
SLICE_MS = 3_600_000


def _whole(at: str, columns: Sequence[str]) -> Column:
    """``at`` with the other columns behind it: its minimum or maximum reads them all."""
    return F.struct(at, *[c for c in columns if c != at])


def accumulate(
    rows: DataFrame, at: str, values: Sequence[str], cell: int, by: Sequence[str] = ()
) -> DataFrame:
    """Add to each row, in ``at`` order (per ``by``), for every value column ``v``:

    ``v_upto`` the running total including the row, ``v_total`` the grand total; and ``next_at``, the
    next row's ``at``. ``(by, at)`` must be unique and ``at`` a bigint.
    """
    keys = [*by, "_cell"]
    cells = rows.withColumn("_cell", bucket(at, cell)).where("_cell is not null").repartition(*keys)

    sums = cells.groupBy(*keys).agg(
        *[F.sum(v).alias(v) for v in values], F.min(_whole(at, rows.columns))[at].alias("_first")
    )
    order = Window.partitionBy(*by).orderBy("_cell")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(
        *keys,
        "_first",
        F.lead("_first").over(order).alias("_next"),
        *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_{v}_before") for v in values],
        *[F.sum(v).over(Window.partitionBy(*by)).alias(f"{v}_total") for v in values],
    )

    inside = Window.partitionBy(*keys).orderBy(at)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cells.select(
        "*",
        F.lead(at).over(inside).alias("_lead"),
        *[F.sum(v).over(upto).alias(f"_{v}_upto") for v in values],
    )
    # Always true; with it both sides need every column, and so share the exchange.
    joined = local.join(carry, keys).where(F.col("_first") <= F.col(at))
    return joined.select(
        *rows.columns,
        F.coalesce("_lead", "_next").alias("next_at"),
        *[(F.col(f"_{v}_before") + F.col(f"_{v}_upto")).alias(f"{v}_upto") for v in values],
        *[f"{v}_total" for v in values],
    )


def nearest_later(
    rows: DataFrame,
    key: str,
    at: str,
    mark: Column,
    ask: Column,
    take: Sequence[str],
    slice_ms: int = SLICE_MS,
) -> DataFrame:
    """Rows where ``ask`` holds, each with the ``take`` columns (prefixed ``next_``) of the nearest
    row of the same key with a strictly later ``at`` where ``mark`` holds; NULL where there is none.

    ``(key, at)`` must be unique and the ``take`` columns not NULL on marked rows.
    """
    sliced = rows.withColumn("_slice", bucket(at, slice_ms)).where("_slice is not null").repartition(key, "_slice")

    firsts = sliced.groupBy(key, "_slice").agg(
        F.min_by(F.struct(*rows.columns), F.when(mark, F.col(at))).alias("_row"), F.max(ask).alias("_asked")
    )
    later_slices = (
        Window.partitionBy(key)
        .orderBy(F.desc("_slice"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = (
        firsts.select(key, "_slice", "_asked", *[F.col("_row")[c].alias(c) for c in take]).select(
            key,
            "_slice",
            "_asked",
            *[F.last(c, ignorenulls=True).over(later_slices).alias(f"_far_{c}") for c in take],
        )
        .where(F.col("_asked") & F.col(f"_far_{take[0]}").isNotNull())
        .drop("_asked")
    )

    ahead = (
        Window.partitionBy(key, "_slice")
        .orderBy(F.desc(at))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    near = [
        F.last(F.when(mark, F.col(c)), ignorenulls=True).over(ahead).alias(f"_near_{c}") for c in take
    ]
    local = sliced.select("*", *near).where(ask)
    return local.join(carry, [key, "_slice"], "left").select(
        *rows.columns, *[F.coalesce(f"_near_{c}", f"_far_{c}").alias(f"next_{c}") for c in take]
    )


def max_before(rows: DataFrame, key: str, at: str, value: str, cell: int) -> DataFrame:
    """Add ``before``: the largest ``value`` among rows of the same key with an earlier ``at``.

    ``(key, at)`` must be unique.
    """
    cells = rows.withColumn("_cell", bucket(at, cell)).where("_cell is not null").repartition(key, "_cell")
    peak = F.max(_whole(value, rows.columns))[value]
    peaks = cells.groupBy(key, "_cell").agg(peak.alias("_peak"))
    earlier = Window.unboundedPreceding, -1
    carry = peaks.select(
        key,
        "_cell",
        F.max("_peak").over(Window.partitionBy(key).orderBy("_cell").rowsBetween(*earlier)).alias("_far"),
    ).where("_far is not null")
    near = F.max(value).over(Window.partitionBy(key, "_cell").orderBy(at).rowsBetween(*earlier))
    return (
        cells.withColumn("_near", near)
        .join(carry, [key, "_cell"], "left")
        .select(*rows.columns, F.greatest("_near", "_far").alias("before"))
    )
