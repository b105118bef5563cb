"""Words of Arrow text columns as 64-bit hashes, by array arithmetic on the bytes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

# Bytes worked on at once; longer texts are cut at gaps between words.
BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one to one (the finaliser of splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    rows = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.ones(size, np.uint64)
        powers[1:] = np.uint64(base)
        rows.append(np.multiply.accumulate(powers))
    return rows[0], rows[1]


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    size = 1 << max(20, int(len(raw)).bit_length())
    powers, inverses = _powers(size)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[raw] * powers[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


def _pieces(raw: np.ndarray, offsets: np.ndarray, gap: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``row, from, to`` of texts cut into pieces of about ``BLOCK`` bytes, between words."""
    for row, (start, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        while end - start > BLOCK:
            cut = start + BLOCK
            while cut < end and not gap[raw[cut]]:
                cut += 1
            yield row, start, cut
            start = cut
        yield row, start, end


def words(column: pa.Array, kinds: np.ndarray, fold: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """For blocks of a text column: every word's row, 64-bit hash, kind and whether a block cut it from its text.

    ``kinds[byte]`` is a byte's kind, 0 for gaps; a word is a run of bytes of one kind. ``fold[byte]`` is the
    byte that is hashed, which puts upper case down. The fourth value numbers the pieces of texts.
    """
    texts = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    gap = kinds == 0
    group: list[tuple[int, int, int]] = []
    held = 0
    for piece in _pieces(raw, offsets, gap):
        if group and held + piece[2] - piece[1] > BLOCK:
            yield _block(raw, group, kinds, fold)
            group, held = [], 0
        group.append(piece)
        held += piece[2] - piece[1]
    if group:
        yield _block(raw, group, kinds, fold)


def _block(
    raw: np.ndarray, group: list[tuple[int, int, int]], kinds: np.ndarray, fold: np.ndarray
) -> tuple[np.ndarray, ...]:
    # Pieces of a group follow each other in the buffer.
    first, last = group[0][1], group[-1][2]
    block = raw[first:last]
    kind = kinds[block]
    change = np.ones(len(block) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    borders = np.array([start - first for _, start, _ in group], np.int64)
    change[borders] = True
    edges = np.flatnonzero(change)
    starts, ends = edges[:-1], edges[1:]
    kept = kind[starts] != 0
    starts, ends = starts[kept], ends[kept]
    piece = np.searchsorted(borders, starts, "right") - 1
    rows = np.array([row for row, _, _ in group], np.int64)[piece]
    return rows, _hashes(fold[block], starts, ends), kind[starts], piece


def byte_table(**kinds: str | bytes) -> np.ndarray:
    """A kind for each byte: 1 for those of the first argument, 2 for the second, and so on; 0 for others."""
    table = np.zeros(256, np.uint8)
    for kind, members in enumerate(kinds.values(), 1):
        table[np.frombuffer(members if isinstance(members, bytes) else members.encode(), np.uint8)] = kind
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
