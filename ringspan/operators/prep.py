"""Preparation of input tables: time re-basing and dense row ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringspan.functions.time import LEAD_MS, floor_to


def _earliest(columns: Sequence[str], align_ms: int | None) -> Column:
    earliest = F.min(F.least(*columns) if len(columns) > 1 else F.col(columns[0]))
    return earliest if align_ms is None else floor_to(earliest, align_ms)


def earliest_time(df: DataFrame, columns: Sequence[str], align_ms: int | None = None) -> int | None:
    """The earliest time in any of ``columns``, or the start of its window. Runs a job; one number."""
    return df.select(_earliest(columns, align_ms)).first()[0]


def rebase_time(
    df: DataFrame,
    columns: Sequence[str],
    target_ms: int,
    lead_ms: int = LEAD_MS,
    align_ms: int | None = None,
    earliest_ms: int | None = None,
) -> DataFrame:
    """Shift all ``columns`` so that their earliest time becomes ``target_ms + lead_ms``.

    ``align_ms`` measures from the start of the earliest window instead. The minimum is a scalar
    subquery: one pass over the time columns, no join. A stream cannot look it up and needs
    ``earliest_ms``, e.g. from ``earliest_time`` over the stored files.
    """
    target = F.lit(target_ms + lead_ms).cast("long")
    if earliest_ms is None:
        shift = target - df.select(_earliest(columns, align_ms)).scalar()
    else:
        shift = target - earliest_ms
    return df.withColumns({c: F.col(c) + shift for c in columns})


def assign_sequence_id(df: DataFrame, order: Sequence[str], path: str) -> DataFrame:
    """Add ``id`` = 0, 1, 2, .. in ``order`` (a unique key), without a global one-task sort.

    Rows are range-partitioned and sorted once and written to ``path`` (shared storage), because the
    partition sizes must come from the very rows that get numbered. Each partition's first id is then
    the running total of the sizes before it: one row per partition.
    """
    position = F.monotonically_increasing_id()
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_position", position)
        .write.parquet(path)
    )
    # monotonically_increasing_id: partition number in the upper 31 bits, row number in the lower 33.
    written = df.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_position", 33))
    sizes = written.groupBy("_part").agg(F.count("*").alias("_n"))
    first = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(first), F.lit(0)).alias("_first"))
    # Broadcast: one row per written partition, a number the job itself has set.
    return written.join(F.broadcast(offsets), "_part").select(
        *df.columns,
        (F.col("_first") + F.col("_position").bitwiseAND(F.lit((1 << 33) - 1))).alias("id"),
    )
