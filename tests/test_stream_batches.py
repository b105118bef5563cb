"""Streams in micro-batches: folded calls, timers, per-batch sinks, corrections, progress, restarts."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ringspan.functions.time import to_timestamp
from ringspan.operators import active, pairing, snapshots
from ringspan.sources import replay
from ringspan.streaming import batches, run, windows
from ringspan.streaming.progress import ProgressLog

CALLS = "unique_id long, start_ts long, end_ts long, ingest_ts long"
YEAR_MS = 365 * 86_400_000
FAR = 4_102_444_800_000


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def arrive(spark, folder, lots, start, schema=CALLS):
    """Each lot is one micro-batch of a stream that is resumed for it; the progress reports of all runs."""
    reports = []
    for number, lot in enumerate(lots):
        spark.createDataFrame(lot, schema).coalesce(2).write.mode("append").parquet(f"{folder}/in")
        query = start(spark.readStream.schema(schema).parquet(f"{folder}/in"), number)
        query.awaitTermination()
        reports += query.recentProgress
    return reports


def call(n, start, end):
    return (n, start, end, end + n)


LOTS = [
    [call(1, 0, 40_000), call(2, 10_000, 45_000), call(3, 70_000, 70_000)],
    [call(4, 20_000, 200_000), call(5, 150_000, 199_000), call(9, 90_000, 80_000)],
    [call(6, 5_000, 400_000), call(7, 390_000, 401_000)],
    [call(8, 500_000, 900_000)],
]


# --- folded calls --------------------------------------------------------------------------------------------


def _spans(spark, folder, lots, **arguments):
    def start(calls, _):
        spans = windows.stream_spans(calls, "1 second", **arguments)
        return run.materialize_stream(spans, f"{folder}/out", f"{folder}/checkpoint", state_partitions=2)

    reports = arrive(spark, folder, lots, start)
    schema = "first long, last long, n long, max_ts long, max_ingest_ms long"
    return spark.read.schema(schema).parquet(f"{folder}/out"), reports


def test_folded_calls_give_the_counts_of_all_windows(spark, tmp_path):
    spans, reports = _spans(spark, tmp_path, [*LOTS, [(0, FAR, FAR, FAR)]])
    calls = spark.createDataFrame([row for lot in LOTS for row in lot], CALLS)
    assert run.late_rows(reports) == 0
    assert rows_of(active.active_of_spans(spans)) == rows_of(active.active_calls(calls))
    wanted = active.active_interval_rows(calls)
    assert rows_of(active.interval_rows_of_spans(spans).select(wanted.columns)) == rows_of(wanted)


@pytest.mark.parametrize("length", [60_000, YEAR_MS])
def test_state_does_not_grow_with_the_length_of_calls(spark, tmp_path, length):
    calls = [call(n, YEAR_MS - length + n * 60_000, YEAR_MS + n * 60_000) for n in range(20)]
    _, reports = _spans(spark, tmp_path, [calls])
    assert max(s.numRowsTotal for report in reports for s in report.stateOperators) <= 20


def test_calls_sent_again_count_once(spark, tmp_path):
    sent = [[(n, n * 1_000, n * 1_000 + 50_000, lot * 60_000 + n) for n in range(30)] for lot in range(3)]

    def start(calls, _):
        once = windows.stream_sent_once(calls, "10 minutes", "ingest_ts")
        return run.materialize_stream(once, f"{tmp_path}/out", f"{tmp_path}/checkpoint", state_partitions=2)

    reports = arrive(spark, tmp_path, sent, start)
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.count() == got.select("unique_id").distinct().count() == 30
    assert max(s.numRowsTotal for report in reports for s in report.stateOperators) == 30  # a row per id


# --- timers --------------------------------------------------------------------------------------------------


def _timed(lots, delay, wait, window):
    """State per window, timers against the watermark of the lots before: what is emitted, in plain Python."""
    held, out, latest = {}, [], None
    for lot in [*lots, []]:
        mark = None if latest is None else latest - delay
        for w, (count, last, ingest) in list(held.items()):
            if mark is not None and last + wait + 1 < mark:
                out.append((w, count, last, last + wait + 1, "end", ingest))
                del held[w]
        for _, begin, end, arrived in lot:
            if end < begin or (mark is not None and end < mark):
                continue
            for w in range(begin // window * window, end + 1, window):
                count, last, ingest = held.get(w, (0, 0, 0))
                held[w] = (count + 1, max(last, end), max(ingest, arrived))
        latest = max([end for *_, end, _ in lot] + ([] if latest is None else [latest]), default=None)
    return sorted(out)


def test_timed_windows(spark, tmp_path):
    lots = [*LOTS, [(0, FAR, FAR, FAR)]]

    def start(calls, _):
        timed = windows.stream_timed_windows(calls, "2 seconds")
        return run.materialize_stream(timed, f"{tmp_path}/out", f"{tmp_path}/checkpoint", state_partitions=2)

    reports = arrive(spark, tmp_path, lots, start)
    got = rows_of(spark.read.schema(windows.TIMED).parquet(f"{tmp_path}/out"))
    assert got == sorted(_timed(lots, 2_000, 2_000, 30_000), key=repr)
    again = [w for w, *_ in got]
    assert len(again) > len(set(again))  # some windows were opened again
    total = active.active_calls(spark.createDataFrame([row for lot in LOTS for row in lot], CALLS))
    sums = pd.DataFrame(got).groupby(0)[1].sum().to_dict()
    assert sums == {w: n for w, n in rows_of(total)}
    # Emitted windows are cleared: what is left is the far one.
    assert reports[-1].stateOperators[0].numRowsTotal == 1


# --- per-batch sinks -----------------------------------------------------------------------------------------


def test_a_batch_that_is_run_again_replaces_itself(spark, tmp_path):
    """The function dies after it has written and before the batch is committed."""
    fail = {1}
    store = batches.append_to(f"{tmp_path}/table")

    def act(rows, batch_id):
        store(rows, batch_id)
        if batch_id in fail:
            raise RuntimeError("killed")

    def start(calls, _):
        return batches.each_batch(calls, act, f"{tmp_path}/checkpoint")

    arrive(spark, tmp_path, LOTS[:1], start)
    with pytest.raises(Exception, match="killed"):
        arrive(spark, tmp_path, LOTS[1:2], start)
    half = spark.read.parquet(f"{tmp_path}/table").count()
    assert half == 6  # written, not committed
    fail.clear()
    arrive(spark, tmp_path, LOTS[2:], start)
    got = spark.read.parquet(f"{tmp_path}/table").drop("batch_id")
    assert rows_of(got) == sorted([row for lot in LOTS for row in lot], key=repr)


def test_half_written_output_goes_too(spark, tmp_path):
    """Totals written by a run that died before its carry: the next run starts from the carry before."""
    deaths = {2}
    totals = batches.running_totals(f"{tmp_path}")

    def act(rows, batch_id):
        totals(rows, batch_id)
        if batch_id in deaths:
            deaths.clear()
            raise RuntimeError("killed")

    schema = "unique_id long, event_type int, event_ts long"
    calls = spark.createDataFrame([row for lot in LOTS for row in lot if row[2] >= row[1]], CALLS)
    events = pairing.calls_to_events(calls.select("unique_id", "start_ts", "end_ts")).select("unique_id", "event_type", "event_ts")
    ordered = sorted(map(tuple, events.collect()), key=lambda row: row[2])
    lots = [ordered[at : at + 4] for at in range(0, len(ordered), 4)] + [[(None, 0, FAR)]]
    seen = []

    def start(rows, _):
        return batches.each_batch(windows.stream_window_deltas(rows, "1 second"), act, f"{tmp_path}/checkpoint")

    for lot in lots:
        try:
            arrive(spark, tmp_path, [lot], start, schema)
        except Exception as error:
            assert "killed" in str(error)
            arrive(spark, tmp_path, [[]], start, schema)
        seen.append(spark.read.parquet(f"{tmp_path}/totals").count())
    assert not deaths
    got = spark.read.parquet(f"{tmp_path}/totals").drop("batch_id")
    wanted = active.open_at_window_end(active.window_deltas(events))
    assert rows_of(got.select(wanted.columns)) == rows_of(wanted)
    assert len({n for n in seen if n}) > 2  # rows appeared while the stream ran


def test_analysis_while_the_stream_runs(spark, tmp_path):
    found = []

    def start(calls, _):
        stamped = calls.withColumn("rate_ts", to_timestamp("ingest_ts"))
        query = batches.each_batch(stamped, batches.due_analysis(f"{tmp_path}", wait_ms=1_000), f"{tmp_path}/checkpoint")
        query.awaitTermination()
        found.append(spark.read.parquet(f"{tmp_path}/snapshots").count())
        return query

    arrive(spark, tmp_path, LOTS, start)
    got = spark.read.parquet(f"{tmp_path}/snapshots")
    latest, last, wanted = None, 0, []
    for number, lot in enumerate(LOTS):
        wm = None if latest is None else (latest - 1_000) // 1_000
        if wm is not None and wm >= last + 30:
            last = wm
            so_far = spark.createDataFrame([row for part in LOTS[: number + 1] for row in part], CALLS)
            wanted.append((*snapshots.snapshot_overlap(so_far, wm).first(), number))
        latest = max([latest or 0, *[row[2] for row in lot]])
    assert rows_of(got) == sorted(wanted, key=repr) and len(wanted) == 3
    assert found == [0, 1, 2, 3]


def test_late_calls_correct_published_windows(spark, tmp_path):
    late = [*LOTS[:3], [call(11, 15_000, 42_000), call(8, 500_000, 900_000)], [call(12, 16_000, 90_000)], [call(13, 0, 0)]]

    def start(calls, _):
        return batches.each_batch(calls, batches.corrected_windows(f"{tmp_path}"), f"{tmp_path}/checkpoint")

    arrive(spark, tmp_path, late, start)
    versions = spark.read.parquet(f"{tmp_path}/versions")
    latest = {row["window_start_ms"]: row for row in batches.latest_versions(versions).collect()}
    rows = [row for lot in late for row in lot]
    closed = max(row[2] for row in rows) - 2_000
    whole = active.active_interval_rows(spark.createDataFrame(rows, CALLS)).collect()
    assert set(latest) == {row["window_start_ms"] for row in whole if row["window_start_ms"] + 30_000 <= closed}
    for row in whole:
        if row["window_start_ms"] in latest:
            got = latest[row["window_start_ms"]]
            assert all(got[c] == row[c] for c in ("count", "max_ts", "max_type", "max_ingest_ms"))
    # Window 0 was published with the lot that passed it and corrected by each later lot that touched it.
    history = versions.where("window_start_ms = 0").orderBy("batch_id").collect()
    assert [(r["batch_id"], r["count"], r["correction"]) for r in history] == [
        (0, 2, False), (1, 3, True), (2, 4, True), (3, 5, True), (4, 6, True), (5, 7, True),
    ]


# --- progress, restarts, replay ------------------------------------------------------------------------------


def test_the_listener_keeps_the_reports_of_all_runs(spark, tmp_path):
    log = ProgressLog(spark, f"{tmp_path}/log", hold=3)
    spark.streams.addListener(log)
    ids = set()
    try:

        def start(calls, _):
            query = run.materialize_stream(calls, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
            query.awaitTermination()
            assert log.settled(query)
            ids.add(str(query.id))
            return query

        reports = arrive(spark, tmp_path, LOTS, start)
    finally:
        spark.streams.removeListener(log)
    (query_id,) = ids  # one query, resumed
    kept = log.read(query_id).collect()
    assert len({row["run_id"] for row in kept}) == len(LOTS)
    assert {(r["run_id"], r["batch_id"]) for r in kept} >= {(str(p.runId), p.batchId) for p in reports}
    assert sum(row["input_rows"] for row in kept) == sum(map(len, LOTS))


def test_resumed_with_other_partitions(spark, tmp_path):
    def start(calls, number):
        spans = windows.stream_spans(calls, "1 second")
        return run.materialize_stream(spans, f"{tmp_path}/out", f"{tmp_path}/checkpoint", state_partitions=1 + 2 * number)

    arrive(spark, tmp_path, [*LOTS, [(0, FAR, FAR, FAR)]], start)
    spans = spark.read.parquet(f"{tmp_path}/out")
    calls = spark.createDataFrame([row for lot in LOTS for row in lot], CALLS)
    assert rows_of(active.active_of_spans(spans)) == rows_of(active.active_calls(calls))


def test_ticks_are_the_same_in_every_run(spark, tmp_path):
    table = spark.range(10).select("id", (F.col("id") * 7).alias("x"))
    table.write.parquet(f"{tmp_path}/table")
    stored = spark.read.parquet(f"{tmp_path}/table")
    got = []
    for name in "ab":
        ticks = replay.tick_stream(spark, 4, start_ms=5_000).where("value < 25")
        joined = replay.replay_join(ticks, stored, rows=10)
        query = run.materialize_stream(joined, f"{tmp_path}/{name}", f"{tmp_path}/check-{name}", every="0 seconds")
        run.run_batches(query, 8, limit_s=120)
        rows = spark.read.schema(joined.schema).parquet(f"{tmp_path}/{name}")
        got.append(rows_of(rows.select("value", F.unix_millis("rate_ts"), "id", "x")))
    assert got[0] == got[1] == sorted(((v, 5_000 + v // 4 * 1_000, v % 10, v % 10 * 7) for v in range(25)), key=repr)


def test_the_table_of_a_replay_is_planned_by_its_bytes(spark, tmp_path):
    spark.range(10).withColumn("x", F.col("id")).write.parquet(f"{tmp_path}/table")
    stored = spark.read.parquet(f"{tmp_path}/table")
    ticks = spark.range(20).select(to_timestamp("id").alias("timestamp"), F.col("id").alias("value"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before, plans = spark.conf.get(key), []
    try:
        for limit in ("10m", "1"):
            spark.conf.set(key, limit)
            joined = replay.replay_join(ticks, stored, rows=10)
            plans.append(joined._jdf.queryExecution().sparkPlan().toString())
    finally:
        spark.conf.set(key, before)
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" in plans[1]
