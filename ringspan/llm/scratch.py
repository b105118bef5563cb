"""Intermediate tables in the shared folder, arrays of fixed size over all rows, and sets of hashes."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringspan.llm.hashing import mix
from ringspan.session import work_folder


_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes a query's shuffle files as soon as it has ended, not when the driver collects its garbage."""
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVE_SHUFFLES)
        else:
            spark.conf.set(_REMOVE_SHUFFLES, before)


class Scratch:
    """Tables of one run below ``spark.checkpoint.dir``, which can be dropped as soon as they are used up.

    A saved table cuts the lineage, and the shuffles that made it go at once: what is lost with an executor is read again. Tables that the caller's
    result still reads are left for the cluster's clean-up policy.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = work_folder(spark, name)
        self._paths: dict[int, tuple[DataFrame, str]] = {}
        self._count = 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{self._count:03d}-{name}"
        self._count += 1
        with _shuffles_removed(self.spark):
            df.write.parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(saved)] = (saved, path)
        return saved

    def drop(self, saved: DataFrame) -> None:
        _, path = self._paths.pop(id(saved))
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def drop_others(self, kept: DataFrame) -> None:
        """Remove every table still held but ``kept``, the one that the caller's result reads."""
        for saved, _ in list(self._paths.values()):
            if saved is not kept:
                self.drop(saved)

    def drop_all(self) -> None:
        """Remove every table still held; the caller has written what it needs elsewhere."""
        for saved, _ in list(self._paths.values()):
            self.drop(saved)


# --- arrays of fixed size ------------------------------------------------------------------------------------

PARTS = "part int, data binary"


def array_parts(array: np.ndarray, parts: int) -> pa.RecordBatch:
    """A task's array, cut and compressed, as rows ``part, data``; parts of zeros are left out."""
    pieces = array.reshape(parts, -1)
    used = np.flatnonzero(pieces.any(axis=1))
    data = [zlib.compress(pieces[at].tobytes(), 1) for at in used]
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(data, pa.binary())], names=["part", "data"])


def combine_arrays(rows: DataFrame, size: int, parts: int, kind: str, combine: Callable) -> np.ndarray:
    """All tasks' arrays combined element by element, on the driver; its size is fixed.

    Two steps of tasks, each of which holds one copy of the parts it meets, whatever the number of rows. The result is
    fetched in one job, as an iterator would start one for each of the shuffle's partitions.
    """

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist()):
                piece = np.frombuffer(zlib.decompress(data), kind)
                held[part] = combine(held[part], piece) if part in held else piece
        data = [zlib.compress(piece.tobytes(), 1) for piece in held.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.int32()), pa.array(data, pa.binary())], names=["part", "data"]
        )

    some = rows.repartition("part", F.pmod(F.xxhash64("data"), F.lit(8))).mapInArrow(fold, PARTS)
    whole = np.zeros(size, kind).reshape(parts, -1)
    for row in some.repartition("part").mapInArrow(fold, PARTS).collect():
        whole[row["part"]] = combine(whole[row["part"]], np.frombuffer(zlib.decompress(row["data"]), kind))
    return whole.reshape(-1)


# --- sets of hashes ------------------------------------------------------------------------------------------

# A filter has 2**25 bits (4 MB) and two bits per member: some rows of no use pass, none of use is lost.
FILTER_BITS = 25


class HashFilter:
    """A Bloom filter of 64-bit hashes with a fixed size. A full one lets everything pass."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    @staticmethod
    def places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mixed = mix(hashes.astype(np.uint64))
        mask = np.uint64((1 << FILTER_BITS) - 1)
        return (mixed & mask).astype(np.int64), (mixed >> np.uint64(32) & mask).astype(np.int64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for places in self.places(hashes):
            found &= (self.bits[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)
        return found


def hash_filter(hashes: DataFrame) -> HashFilter:
    """The filter of all values of a one-column table of bigints."""
    column = hashes.columns[0]

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS - 3, np.uint8)
        for batch in batches:
            for places in HashFilter.places(batch.column(0).to_numpy(zero_copy_only=False)):
                np.bitwise_or.at(bits, places >> 3, np.uint8(1) << (places & 7).astype(np.uint8))
        yield array_parts(bits, 64)

    rows = hashes.where(F.col(column).isNotNull()).mapInArrow(collect, PARTS)
    return HashFilter(combine_arrays(rows, 1 << FILTER_BITS - 3, 64, "u1", np.bitwise_or))
