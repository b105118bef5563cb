"""Comparison of two window tables, e.g. a stream's output and the batch recomputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(expected: DataFrame, actual: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The keys on which the tables differ: ``keys, expected, actual`` (NULL where absent)."""
    left = expected.select(*keys, F.col(value).alias("expected"), F.lit(True).alias("_in_expected"))
    right = actual.select(*keys, F.col(value).alias("actual"), F.lit(True).alias("_in_actual"))
    same = F.col("expected").eqNullSafe(F.col("actual"))
    both = F.col("_in_expected").isNotNull() & F.col("_in_actual").isNotNull()
    return left.join(right, list(keys), "full").where(~(both & same)).drop("_in_expected", "_in_actual")
