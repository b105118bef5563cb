"""Hand-sized records, random records, and brute-force answers."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

B = 1_764_079_980_000
CALLER = 9_000_000_000

# unique_id, caller, start, end; relative to B and CALLER
GOLDEN = [
    (1, 1, 0, 29_999),
    (2, 1, 120_000, 150_000),
    (3, 1, 130_000, 140_000),
    (4, 1, 240_000, 240_000),
    (5, 1, 240_000, 301_000),
    (6, 2, 10_000, 20_000),
    (7, 2, 80_000, 95_000),
    (8, 2, 1_000_000, 1_005_000),
]
# unique_id, caller, event_type, time: an orphan start, an orphan end, a start with two ends
ORPHANS = [
    (9, 3, 0, 5_000),
    (10, 3, 1, 15_000),
    (11, 3, 0, 40_000),
    (11, 3, 1, 50_000),
    (11, 3, 1, 70_000),
]


def calls_df(spark: SparkSession, rows, base: int = 0) -> DataFrame:
    """Rows (unique_id, caller, start, end)."""
    data = [
        (u, None if c is None else c, None if s is None else s + base, None if e is None else e + base)
        for u, c, s, e in rows
    ]
    return spark.createDataFrame(data, "unique_id long, caller long, start_ts long, end_ts long")


def events_df(spark: SparkSession, rows, base: int = 0) -> DataFrame:
    """Rows (unique_id, caller, event_type, time)."""
    data = [(u, c, t, None if ts is None else ts + base) for u, c, t, ts in rows]
    return spark.createDataFrame(data, "unique_id long, caller long, event_type int, event_ts long")


def golden_calls(spark):
    return calls_df(spark, [(u, c + CALLER, s, e) for u, c, s, e in GOLDEN], B)


def golden_events(spark):
    ends = [(u, c, 0, s) for u, c, s, _ in GOLDEN] + [(u, c, 1, e) for u, c, _, e in GOLDEN]
    return events_df(spark, [(u, c + CALLER, t, ts) for u, c, t, ts in ends + ORPHANS], B)


def random_calls(seed: int, n: int, callers: int, ids: int, span: int, inverted: bool = True):
    """Calls full of ties, nesting, repeated ids and (optionally) inverted or unknown ends."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        start = rng.randrange(0, span, 500)
        end = start + rng.choice([0, 0, 500, 1_000, 30_000, 29_500, 90_000, 4 * span])
        if inverted and rng.random() < 0.1:
            end = start - rng.choice([500, 31_000, 60_000])
        rows.append((rng.randrange(ids), rng.randrange(callers), start, end))
    return rows


def random_events(seed: int, n: int, callers: int, ids: int, span: int):
    rng = random.Random(seed)
    return [
        (rng.randrange(ids), rng.randrange(callers), rng.randrange(2), rng.randrange(0, span, 500))
        for _ in range(n)
    ]


def bag(df: DataFrame) -> Counter:
    return Counter(tuple(row) for row in df.collect())


# --- brute force -----------------------------------------------------------------------------


def windows_of(start: int, end: int, size: int):
    return range(start // size * size, end // size * size + 1, size)


def count_windows(intervals, size: int) -> dict[int, int]:
    counts = Counter()
    for start, end in intervals:
        counts.update(windows_of(start, end, size))
    return dict(counts)


def count_windows_distinct(rows, size: int) -> dict[int, int]:
    ids: dict[int, set] = {}
    for u, start, end in rows:
        for w in windows_of(start, end, size):
            ids.setdefault(w, set()).add(u)
    return {w: len(us - {None}) for w, us in ids.items()}


def idle_next(rows, threshold: int, inclusive: bool = False) -> Counter:
    """Rows (caller, start, end)."""
    out = Counter()
    for caller, _, end in rows:
        if end is None:
            continue
        later = [s for c, s, _ in rows if c == caller and s > end]
        if not later:
            continue
        nearest = min(later)
        gap = nearest - end
        if gap > threshold or (inclusive and gap == threshold):
            out[(caller, end, nearest, gap)] += later.count(nearest)
    return out


def idle_lag(rows, threshold: int) -> Counter:
    """Rows (caller, start, end), order by start, open ends first, then end."""
    out = Counter()
    by_caller: dict = {}
    for caller, start, end in rows:
        by_caller.setdefault(caller, []).append((start, end))
    for caller, calls in by_caller.items():
        calls.sort(key=lambda c: (c[0], c[1] is not None, c[1] or 0))
        for (_, prev_end), (start, _) in zip(calls, calls[1:]):
            if prev_end is not None and start - prev_end >= threshold:
                out[(caller, prev_end, start, start - prev_end)] += 1
    return out


def all_pairs(events, after: bool) -> Counter:
    out = Counter()
    for u, c, t, s in events:
        if t == 0:
            for u2, _, t2, e in events:
                if t2 == 1 and u2 == u and (not after or e > s):
                    out[(u, c, s, e)] += 1
    return out


def first_after(events) -> Counter:
    out = Counter()
    for u, c, t, s in events:
        if t == 0:
            ends = [e for u2, _, t2, e in events if t2 == 1 and u2 == u and u is not None and e > s]
            out[(u, c, s, min(ends, default=None))] += 1
    return out
