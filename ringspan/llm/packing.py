"""Documents packed into token sequences of a fixed size, best two fit, over the whole table at once.

Lengths are whole numbers up to the size of a sequence, so what a packing depends on is how many pieces there
are of each length: a table of at most ``size`` counts, whatever the number of documents. Best-two-fit runs on
those counts. It fills a sequence with the longest pieces that still fit; then it looks whether two unpacked
pieces fill the room of the sequence's smallest piece and the gap more tightly than that piece, and takes the
tightest such pair. As long as the counts last, the next sequence is filled the same way, so a filling is
worked out once and repeated. Tasks then number the pieces of each length and look up their places; no
piece meets another one before that, and no text or token is shuffled.

Defined results: a NULL or empty text is the end id alone; rows with one id, repeated rows and NULL ids are
packed like any others; an empty table has no pieces. Other columns are not looked at. A document that is longer
than a sequence is cut so that all its pieces but the first fill a sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringspan.llm.bpe import encoder
from ringspan.llm.common import documents_of, small_batches

SIZE = 1024
END_ID = 2

PIECES = "doc_id long, piece int, start long, length long, part int, nth long, tokens array<int>"
PLACED = "doc_id long, piece int, start long, length long, part int, nth long, sequence_id long, offset long"


def cut_lengths(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the pieces of documents of ``counts`` (positive) tokens, and how many pieces each one has."""
    pieces = -(-counts // size)
    lengths = np.full(int(pieces.sum()), size, np.int64)
    lengths[np.cumsum(pieces) - pieces] = counts - (pieces - 1) * size
    return lengths, pieces


def write_pieces(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    size: int = SIZE,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode whole texts, append ``end_id``, cut them and write the pieces below ``path``.

    ``part`` is the task and ``nth`` the piece's number among those of its length in the task.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, met = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in small_batches(batches, 4 << 20):
            ids, counts = encoder(tokenizer).encode(batch.column("text").to_pylist())
            ids = np.insert(ids, np.cumsum(counts), end_id)
            lengths, pieces = cut_lengths(counts + 1, size)
            row = np.repeat(np.arange(len(pieces)), pieces)
            firsts = np.cumsum(pieces) - pieces
            offsets = np.concatenate([[0], np.cumsum(lengths)])
            # Numbers within a length: the place in the stable order by length, less where the length begins.
            order = np.argsort(lengths, kind="stable")
            here = np.bincount(lengths, minlength=size + 1)
            nth = np.empty(len(lengths), np.int64)
            nth[order] = np.arange(len(lengths)) - (np.cumsum(here) - here)[lengths[order]]
            nth += met[lengths]
            met += here
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    pa.array(np.arange(len(lengths)) - firsts[row], pa.int32()),
                    pa.array(offsets[:-1] - offsets[firsts[row]]),
                    pa.array(lengths),
                    pa.array(np.full(len(lengths), part, np.int32)),
                    pa.array(nth),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())),
                ],
                names=["doc_id", "piece", "start", "length", "part", "nth", "tokens"],
            )

    documents_of(docs, id_col, text_col).mapInArrow(encode, PIECES).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(PIECES).parquet(path)


# --- the packing of counts -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Filling:
    """``times`` sequences that all hold the same lengths; ``lengths`` from the longest on, with how many of each."""

    lengths: list[int]
    copies: list[int]
    times: int


def _fill(counts: np.ndarray, size: int) -> dict[int, int]:
    """The longest pieces that fit, again and again."""
    taken: dict[int, int] = {}
    gap = size
    while gap:
        fitting = np.flatnonzero(counts[: gap + 1])
        # A length that is used up by this sequence is out; lengths only get shorter.
        length = next((at for at in fitting[::-1].tolist() if counts[at] > taken.get(at, 0)), 0)
        if not length:
            break
        copies = min(int(counts[length]) - taken.get(length, 0), gap // length)
        taken[length] = taken.get(length, 0) + copies
        gap -= copies * length
    return taken


def _best_pair(counts: np.ndarray, room: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum up to ``room``; of equal sums the one with the longest."""
    left = np.flatnonzero(counts[: room + 1])
    if not len(left):
        return None
    # For each first length the longest second one that fits beside it and is not longer.
    limit = np.minimum(room - left, left)
    at = np.searchsorted(left, limit, "right") - 1
    second = np.where(at >= 0, left[np.maximum(at, 0)], 0)
    single = (second == left) & (counts[left] < 2)
    second = np.where(single, np.where(at > 0, left[np.maximum(at - 1, 0)], 0), second)
    sums = np.where(second > 0, left + second, 0)
    best = len(sums) - 1 - int(np.argmax(sums[::-1]))
    return (int(left[best]), int(second[best])) if sums[best] else None


def best_two_fit(counts: np.ndarray, size: int = SIZE) -> list[Filling]:
    """Fillings that use up ``counts[length]`` pieces of each length, equal ones next to each other told together.

    The result is that of packing one sequence after another. After a filling has been repeated, the count of one
    of its lengths is below what the filling needs, which is at most ``size / length`` and one; so there are
    fewer than ``size * (4 + ln size)`` fillings, however many pieces there are.
    """
    counts = counts.astype(np.int64).copy()
    fillings = []
    while counts.any():
        greedy = _fill(counts, size)
        final = dict(greedy)
        smallest = min(greedy)
        gap = size - sum(length * copies for length, copies in greedy.items())
        if gap and sum(greedy.values()) > 1:
            for length, copies in greedy.items():
                counts[length] -= copies
            pair = _best_pair(counts, gap + smallest)
            for length, copies in greedy.items():
                counts[length] += copies
            if pair and sum(pair) > smallest:
                for length, change in ((smallest, -1), (pair[0], 1), (pair[1], 1)):
                    final[length] = final.get(length, 0) + change
                final = {length: copies for length, copies in final.items() if copies}
        # The same steps are taken again while every length they use is there as often.
        need = {length: max(greedy.get(length, 0), final.get(length, 0)) for length in greedy | final}
        times = min((int(counts[length]) - need[length]) // copies + 1 for length, copies in final.items())
        for length, copies in final.items():
            counts[length] -= copies * times
        lengths = sorted(final, reverse=True)
        fillings.append(Filling(lengths, [final[length] for length in lengths], times))
    return fillings


def length_counts(pieces: DataFrame, size: int = SIZE) -> np.ndarray:
    """How many pieces there are of each length: at most ``size`` rows reach the driver."""
    counts = np.zeros(size + 1, np.int64)
    for length, count in pieces.groupBy("length").count().collect():
        counts[length] = count
    return counts


# --- places --------------------------------------------------------------------------------------------------


def _spans(fillings: list[Filling]) -> tuple[np.ndarray, ...]:
    """For each length of each filling, sorted by length and rank: the length, the first rank that goes there, copies
    in a sequence, the first sequence, and the offset of the first copy."""
    rows, used, sequence = [], {}, 0
    for filling in fillings:
        offset = 0
        for length, copies in zip(filling.lengths, filling.copies):
            rank = used.get(length, 0)
            rows.append((length, rank, copies, sequence, offset))
            used[length] = rank + copies * filling.times
            offset += copies * length
        sequence += filling.times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return tuple(table.T)


def place_pieces(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id, piece, start, length, part, nth`` with ``sequence_id`` and ``offset``; tokens are not read.

    The ranks of a length are dealt out by task: how many pieces of the length earlier tasks hold, and ``nth``. The
    fillings, a table of bounded size, go to every task.
    """
    lengths, firsts, copies, sequences, offsets = _spans(best_two_fit(length_counts(pieces, size), size))
    held = pieces.groupBy("part", "length").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = held.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    ranked = pieces.drop("tokens").join(bases, ["part", "length"])

    # Spans of a length begin at its first row; ranks are searched among the starts of that length alone.
    begins = np.searchsorted(lengths, np.arange(size + 2))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            span = np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(rows):
                    first, end = begins[length[rows[0]]], begins[length[rows[0]] + 1]
                    span[rows] = first + np.searchsorted(firsts[first:end], rank[rows], "right") - 1
            within = rank - firsts[span]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "piece", "start")),
                    pa.array(length),
                    *(batch.column(c) for c in ("part", "nth")),
                    pa.array(sequences[span] + within // copies[span]),
                    pa.array(offsets[span] + within % copies[span] * length),
                ],
                names=["doc_id", "piece", "start", "length", "part", "nth", "sequence_id", "offset"],
            )

    columns = ["doc_id", "piece", "start", "length", "part", "nth"]
    return ranked.select(*columns, (F.col("base") + F.col("nth")).alias("rank")).mapInArrow(place, PLACED)


_PLACE = ["part", "length", "nth"]


def packed_sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """One row per sequence: ``sequence_id, tokens``, and ``documents``, what lies where in it."""
    rows = pieces.select(*_PLACE, "tokens").join(placed, _PLACE)
    inside = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "tokens")))
    return rows.groupBy("sequence_id").agg(inside.alias("inside")).select(
        "sequence_id",
        F.flatten("inside.tokens").alias("tokens"),
        F.transform(
            "inside", lambda s: F.struct(s["doc_id"], s["piece"], s["offset"], s["length"])
        ).alias("documents"),
    )


def packing_report(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: the checksum of each piece's ids as
    little-endian 32-bit integers, from the written pieces."""

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            offsets = lists.offsets.to_numpy().tolist()
            # The values array of a slice still starts at the parent's first value.
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in _PLACE), pa.array(sums, pa.int64())], names=[*_PLACE, "ids_crc32"]
            )

    sums = pieces.select(*_PLACE, "tokens").mapInArrow(check, "part int, length long, nth long, ids_crc32 long")
    return placed.join(sums, _PLACE).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
