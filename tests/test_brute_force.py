"""Random records full of ties against brute force, with keys in one piece and in slices."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ringspan.operators import active, expand, gaps, pairing, running, snapshots
from tests import fixtures as fx

SEEDS = range(3)
W = 30_000


def with_nulls(rows):
    """Some unknown ends."""
    return [(u, c, s, None if i % 17 == 5 else e) for i, (u, c, s, e) in enumerate(rows)]


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("sliced", [False, True])
def test_active_counts(spark, seed, sliced):
    rows = fx.random_calls(seed, 150, 5, 40 if seed else 10, 900_000)
    df = fx.calls_df(spark, rows)
    got = active.active_distinct(df, W, sliced=sliced, windows_per_slice=4)
    assert dict(got.collect()) == fx.count_windows_distinct(
        [(u, s, e) for u, _, s, e in rows], W
    )
    assert dict(active.active_calls(df, W).collect()) == fx.count_windows(
        [(s, e) for _, _, s, e in rows], W
    )


def test_active_distinct_without_ids(spark):
    rows = [(None, 1, 0, 31_000), (7, 1, 30_000, 31_000), (7, 1, 0, 1_000), (None, 1, 90_000, 90_000)]
    got = dict(active.active_distinct(fx.calls_df(spark, rows), W).collect())
    assert got == {0: 1, 30_000: 1, 90_000: 0}


@pytest.mark.parametrize("seed", SEEDS)
def test_interval_rows(spark, seed):
    rows = fx.random_calls(seed, 120, 5, 40, 900_000)
    df = fx.calls_df(spark, rows).withColumn("ingest_ts", F.abs(F.xxhash64("unique_id", "start_ts")) % 9999)
    ingest = {(r.unique_id, r.start_ts): r.ingest_ts for r in df.collect()}
    want = {}
    for u, _, s, e in rows:
        if e >= s:
            for w in fx.windows_of(s, e, W):
                n, last, seen = want.get(w, (0, -1, -1))
                want[w] = (n + 1, max(last, e), max(seen, ingest[u, s]))
    got = {
        r["window_start_ms"]: (r["count"], r["max_ts"], r["max_ingest_ms"])
        for r in active.active_interval_rows(df, W).collect()
    }
    assert got == want


def test_cover_is_exact_and_small(spark):
    spans = [(i, 0, a * W, b * W) for i, (a, b) in enumerate((a, b) for a in range(40) for b in range(a, 40))]
    df = fx.calls_df(spark, spans)
    blocks = expand.cover_windows(df, W)
    got = expand.spread_cover(blocks, W, "w").groupBy("unique_id").agg(
        F.count("*").alias("n"), F.count_distinct("w").alias("d"), F.min("w").alias("lo"), F.max("w").alias("hi")
    )
    assert {r.unique_id: (r.n, r.d, r.lo, r.hi) for r in got.collect()} == {
        i: ((b - a) // W + 1, (b - a) // W + 1, a, b) for i, _, a, b in spans
    }
    assert blocks.groupBy("unique_id").count().agg(F.max("count")).first()[0] <= 2 * 6


def test_long_ranges_in_chunks(spark):
    df = spark.createDataFrame([(0, 25_000), (7, 7), (9, 8)], "lo long, hi long")
    out = expand.explode_range(df, F.col("lo"), F.col("hi"), 2, "x").where("x % 2 = lo % 2")
    assert out.groupBy("lo").agg(F.count("*"), F.max("x")).sort("lo").collect() == [(0, 12_501, 25_000), (7, 1, 7)]


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("sliced", [False, True])
def test_idle_next(spark, seed, sliced):
    rows = with_nulls(fx.random_calls(seed, 150, 4, 1000, 2_000_000))
    got = gaps.idle_next_start(fx.calls_df(spark, rows), sliced=sliced, slice_ms=120_000)
    assert fx.bag(got) == fx.idle_next([(c, s, e) for _, c, s, e in rows], 60_000)


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("sliced", [False, True])
def test_idle_lag(spark, seed, sliced):
    rows = with_nulls(fx.random_calls(seed, 200, 4, 1000, 1_000_000))
    rows += [(1, None, s, e) for _, c, s, e in rows if c == 3]
    got = gaps.idle_lag(fx.calls_df(spark, rows), sliced=sliced, slice_ms=90_000)
    assert fx.bag(got) == fx.idle_lag([(c, s, e) for _, c, s, e in rows], 30_000)


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("sliced", [False, True])
def test_pairing(spark, seed, sliced):
    events = fx.random_events(seed, 120, 3, 12, 600_000) + [(None, 1, 0, 500), (None, 1, 1, 900)]
    df = fx.events_df(spark, events)
    known = [e for e in events if e[0] is not None]
    assert fx.bag(pairing.pair_calls(df, "all")) == fx.all_pairs(known, after=False)
    assert fx.bag(pairing.pair_calls(df, "all_after")) == fx.all_pairs(known, after=True)
    got = pairing.pair_calls(df, "first_after", sliced=sliced, slice_ms=60_000)
    assert fx.bag(got) == fx.first_after(events)
    pairs = fx.all_pairs(known, after=True)
    counts = active.active_pairs(df, W, sliced=sliced, slice_ms=60_000)
    assert dict(counts.collect()) == fx.count_windows([(s, e) for _, _, s, e in pairs.elements()], W)


def test_round_trip(spark):
    rows = [(i, c, s, e) for i, (_, c, s, e) in enumerate(fx.random_calls(5, 80, 4, 9, 500_000)) if e > s]
    calls = fx.calls_df(spark, rows)
    for rule in pairing.RULES:
        assert fx.bag(pairing.pair_calls(pairing.calls_to_events(calls), rule)) == fx.bag(calls)


@pytest.mark.parametrize("seed", SEEDS)
def test_snapshots(spark, seed):
    rows = with_nulls(fx.random_calls(seed, 200, 4, 1000, 600_000))
    calls = fx.calls_df(spark, rows).withColumn("rate_ts", F.timestamp_millis("start_ts"))
    marks = [0, 11, 40, 95, 111, 300, 333, 640, 10_000]
    table = spark.createDataFrame([(m,) for m in marks], "wm long")
    overlap = {r["trigger_time"]: r["active_calls_count"] for r in snapshots.watermark_snapshots(calls, table).collect()}
    started = {
        r["trigger_time"]: (r["active_calls_count"], r["max_rate_ts"])
        for r in snapshots.watermark_snapshots_started(calls, table).collect()
    }
    assert set(overlap) == set(started) == set(marks)
    for m in marks:
        assert overlap[m] == snapshots.snapshot_overlap(calls, m).first()[0]
        one = snapshots.snapshot_started(calls, m).first()
        assert started[m] == (one["active_calls_count"], one["max_rate_ts"])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-500, 500), st.integers(-5, 5)), min_size=1, max_size=40))
def test_accumulate(spark, pairs):
    rows = sorted(dict(pairs).items())
    df = spark.createDataFrame(rows, "at long, v long")
    got = running.accumulate(df, "at", ["v"], 64).sort("at").collect()
    total = 0
    for i, (row, (at, v)) in enumerate(zip(got, rows, strict=True)):
        total += v
        assert (row["at"], row["v_upto"]) == (at, total)
        assert row["next_at"] == (rows[i + 1][0] if i + 1 < len(rows) else None)
        assert row["v_total"] == sum(v for _, v in rows)


@given(st.lists(st.integers(0, 1000)), st.integers(1, 60))
def test_next_triggers(marks, every):
    due = snapshots.next_triggers(marks, every)
    assert all(b - a >= every for a, b in zip([0, *due], due))
    assert set(due) <= set(marks)
