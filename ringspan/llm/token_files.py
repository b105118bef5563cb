"""Token ids as Parquet files: written in document order, read back whole or in part.

Files hold one row per document: ``doc_id``, ``part`` (the file's place in the order), ``before`` (ids of
the documents before it in the same file), ``n_tokens`` and ``tokens``, a list of ids. Ids are
dictionary-encoded, the other columns delta-encoded; row groups and pages are kept small and have page
indexes, so a reader of some documents, or of the columns besides ``tokens``, touches few pages.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from ringspan.llm.bpe import encoder
from ringspan.llm.common import documents_of, small_batches

END_ID = 0
# Bytes encoded at once. Numbers of pieces and ids take many times as much beside a worker's words.
BATCH = 1 << 20

FILE_SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("part", IntegerType()),
        StructField("before", LongType()),
        StructField("n_tokens", LongType()),
        StructField("tokens", ArrayType(IntegerType())),
    ]
)

WRITE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.dictionary.page.size": str(1 << 20),
    # Version 2 pages of integers without a dictionary are delta-encoded.
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#before": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}


def _rows(batches: Iterable[pa.RecordBatch], tokenizer: str, end_id: int, part: int) -> Iterator[pa.RecordBatch]:
    """The rows of one file."""
    before = 0
    for batch in small_batches(batches, BATCH):
        ids, counts = encoder(tokenizer).encode(batch.column("text").to_pylist())
        ids = np.insert(ids, np.cumsum(counts), end_id)
        counts = counts + 1
        offsets = np.concatenate([[0], np.cumsum(counts)])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.full(len(counts), part, np.int32)),
                pa.array(before + offsets[:-1]),
                pa.array(counts),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())),
            ],
            names=FILE_SCHEMA.names,
        )
        before += int(offsets[-1])


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
) -> None:
    """Encode whole texts, append ``end_id`` to each, and write them below ``path`` in ``doc_id`` order.

    One shuffle, by ranges of ``doc_id`` (a document's hash breaks ties, so that one id may hold any share
    of the rows). NULL ids come first; a NULL or empty text is the end id alone; repeated rows stay.
    """
    texts = documents_of(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    ordered = texts.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _rows(batches, tokenizer, end_id, TaskContext.get().partitionId())

    ordered.mapInArrow(encode, FILE_SCHEMA).write.options(**WRITE_OPTIONS).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The documents of ``write_token_files`` with ``start``: the ids of all documents before each.

    Only as much is read as the caller uses: ``start`` needs no ids, a filter on ``doc_id`` reaches the
    page index.
    """
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    # One row per file: the running total over files is as small as the file listing.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "tokens"
    )


def token_report(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: the checksum of the ids as little-endian 32-bit integers."""

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            offsets = lists.offsets.to_numpy().tolist()
            # The values array of a slice still starts at the parent's first value.
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "start", "n_tokens", "tokens").mapInArrow(
        check, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
