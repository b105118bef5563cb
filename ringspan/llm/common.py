"""Small helpers the operators share: input columns, Arrow batches, unions of intervals."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def documents_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id bigint, text string`` of any table; NULL texts become empty, other columns go.

    Operators start from this, so columns of the input never clash with those they add.
    """
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def small_batches(batches: Iterable[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``max_bytes`` at most (one row at least), to bound memory."""
    for batch in batches:
        if batch.num_rows:
            step = max(1, int(batch.num_rows * max_bytes / max(1, batch.nbytes)))
            for at in range(0, batch.num_rows, step):
                yield batch.slice(at, step)


def merge_intervals(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of half-open intervals, sorted and disjoint; touching ones are joined."""
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            if end > merged[-1][1]:
                merged[-1] = (merged[-1][0], end)
        else:
            merged.append((start, end))
    return merged
