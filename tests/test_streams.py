"""Streams against the batch form of the same counts, over short micro-batches in arrival order."""

import os
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from ringspan.functions.time import to_timestamp
from ringspan.operators import active, latency, pairing, prep, reconcile, snapshots
from ringspan.schema import CALLS
from ringspan.sources import files, replay
from ringspan.sources.derived import calls_table
from ringspan.streaming import run, windows

DATA = "/root/testdata/sf0.01"
FAR = 4_102_444_800_000
BATCHES = 20


def written_in_order(spark, folder, per_file):
    """The first calls by end, as files in that order."""
    rows = (
        calls_table(spark, DATA)
        .select("unique_id", "caller", "start_ts", "end_ts")
        .orderBy("end_ts", "unique_id")
        .limit(BATCHES * per_file)
        .toPandas()
    )
    for i in range(BATCHES):
        path = folder / f"calls-{i:03d}.parquet"
        rows.iloc[i * per_file : (i + 1) * per_file].to_parquet(path, index=False)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


@pytest.fixture(scope="module")
def arrivals(spark, tmp_path_factory):
    return written_in_order(spark, tmp_path_factory.mktemp("arrivals"), 15)


@pytest.fixture(scope="module")
def short_arrivals(spark, tmp_path_factory):
    """Batches shorter than the calls in them."""
    return written_in_order(spark, tmp_path_factory.mktemp("short"), 4)


def batch_calls(spark, arrivals):
    return spark.read.parquet(arrivals)


def stream_calls(spark, arrivals):
    schema = batch_calls(spark, arrivals).schema
    return files.read_signal_stream(spark, arrivals, schema, files_per_trigger=1)


def test_active_distinct_in_short_batches(spark, arrivals, tmp_path):
    stream = windows.stream_active_distinct(stream_calls(spark, arrivals), "2 hours")
    got, progress = run.run_to_end(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert run.late_rows(progress) == 0
    assert sum(p.numInputRows for p in progress) == 300
    # Nothing closed is wrong or missing; what is withheld is the tail behind the last watermark.
    last = run.watermark_seconds(progress[-1].eventTime["watermark"]) * 1000
    wanted = active.active_distinct(batch_calls(spark, arrivals))
    diff = reconcile.reconcile(wanted, got, ["WindowStart"], "ActiveCalls").collect()
    assert got.count() > 1000
    assert all(r["WindowStart"] >= last and r["actual"] is None for r in diff)


def test_delay_shorter_than_calls_drops_rows(spark, short_arrivals, tmp_path):
    stream = windows.stream_active_distinct(stream_calls(spark, short_arrivals), "1 second")
    got, progress = run.run_to_end(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert run.late_rows(progress) > 0


def test_tail_is_flushed(spark, arrivals, tmp_path):
    source = run.with_tail(stream_calls(spark, arrivals), f"{tmp_path}/tail")
    rows = source.withColumn("ingest_ts", F.col("end_ts") + 5)
    got, _ = run.run_to_end(
        windows.stream_interval_rows(rows, "2 hours"),
        f"{tmp_path}/out",
        f"{tmp_path}/checkpoint",
        lambda: run.push_tail(spark, f"{tmp_path}/tail", source.schema, Row(None, None, FAR, FAR)),
        state_partitions=3,
    )
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    batch = batch_calls(spark, arrivals).withColumn("ingest_ts", F.col("end_ts") + 5)
    wanted = active.active_interval_rows(batch)
    for column in ("count", "max_ts", "max_ingest_ms"):
        assert reconcile.reconcile(wanted, got, ["window_start_ms"], column).count() == 0


def test_deltas_then_running_total(spark, arrivals, tmp_path):
    source = run.with_tail(stream_calls(spark, arrivals), f"{tmp_path}/tail")
    got, progress = run.run_to_end(
        windows.stream_window_deltas(pairing.calls_to_events(source), "2 hours"),
        f"{tmp_path}/out",
        f"{tmp_path}/checkpoint",
        lambda: run.push_tail(spark, f"{tmp_path}/tail", source.schema, Row(None, None, FAR, FAR)),
    )
    assert run.late_rows(progress) == 0
    wanted = active.window_deltas(pairing.calls_to_events(batch_calls(spark, arrivals)))
    assert reconcile.reconcile(
        active.open_at_window_end(wanted), active.open_at_window_end(got), ["window_start_ms"], "count"
    ).count() == 0


def test_replayed_starts(spark, arrivals, tmp_path):
    """Ticks joined to the stored table, then start counts: the replay form of the same stream."""
    table = batch_calls(spark, arrivals).withColumn("id", F.row_number().over(_by_end()) - 1)
    ticks = spark.range(300).select(to_timestamp("id").alias("timestamp"), F.col("id").alias("value"))
    ticks.repartitionByRange(5, "value").write.parquet(f"{tmp_path}/ticks")
    stream = files.read_signal_stream(spark, f"{tmp_path}/ticks", ticks.schema)
    events = pairing.calls_to_events(replay.replay_join(stream, table))
    counts = active.starts_per_window(events, delay="0 seconds")
    got, progress = run.run_to_end(counts, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    wanted = active.starts_per_window(
        pairing.calls_to_events(table.withColumn("rate_ts", to_timestamp("id")))
    )
    diff = reconcile.reconcile(wanted, got, ["window_start"], "start_event_count").collect()
    assert len(diff) <= 1  # the last window is still open


def _by_end():
    from pyspark.sql import Window

    return Window.orderBy("end_ts", "unique_id")


def test_rate_source_reaches_the_join(spark, arrivals, tmp_path):
    table = batch_calls(spark, arrivals).withColumn("id", F.col("unique_id"))
    stream = replay.replay_join(replay.rate_stream(spark, 50), table, "left")
    assert stream.isStreaming
    query = run.materialize_stream(
        stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", every="1 second", name="replay"
    )
    run.run_batches(query, 3, limit_s=120)
    assert not query.isActive
    got = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out")
    assert got.columns == stream.columns and got.where("end_ts is not null").count() > 0


def test_snapshots_follow_the_watermark(spark, arrivals, tmp_path):
    """Calls pile up in a table; each due watermark is analysed over the rows so far."""
    calls = run.stamp_arrival(stream_calls(spark, arrivals))
    timed = calls.withColumn("event_ts", to_timestamp("end_ts")).withWatermark("event_ts", "1 second")
    table, progress = run.run_to_end(timed, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert table.count() == 300
    reports = run.progress_table(spark, progress).orderBy("batch_id").collect()
    due = snapshots.next_triggers([r["watermark_s"] for r in reports if r["watermark_s"]], 30)
    got = run.due_snapshots(table, progress)
    assert sorted(r["trigger_time"] for r in got.collect()) == due
    assert len(due) > 5
    stamps = sorted(r[0] for r in table.select("arrived_ms").distinct().collect())
    batch = {r["watermark_s"]: n for n, r in reversed(list(enumerate(reports)))}
    for row in got.collect():
        so_far = table.where(F.col("arrived_ms") <= stamps[min(batch[row["trigger_time"]], len(stamps) - 1)])
        assert row[0] == snapshots.snapshot_overlap(so_far, row["trigger_time"]).first()[0]
    later = run.due_snapshots(table.withColumn("rate_ts", F.col("event_ts")), progress, last=due[-2], started=True)
    assert [r["trigger_time"] for r in later.collect()] == due[-1:]


def test_later_arrivals_are_not_counted(spark, tmp_path):
    """Three micro-batches: a call of the third overlaps the range behind the watermark of the second."""
    for batch in ([(1, 50_000, 100_000)], [(2, 150_000, 200_000)], [(3, 300_000, 390_000), (4, 10_000, 400_000)]):
        lot = spark.createDataFrame(batch, "unique_id long, start_ts long, end_ts long")
        lot.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(lot.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    timed = stream.withColumn("event_time", to_timestamp("end_ts")).withWatermark("event_time", "1 second")
    table, progress = run.run_to_end(run.stamp_arrival(timed), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    table = table.withColumn("rate_ts", F.col("event_time"))
    got = {r["trigger_time"]: r["active_calls_count"] for r in run.due_snapshots(table, progress).collect()}
    # At 99 s only the calls ending at 100 s and 200 s are there, and the second starts too late; at 199 s all are.
    assert got == {99: 1, 199: 2}
    begun = run.due_snapshots(table, progress, started=True).collect()
    assert {r["trigger_time"]: r["active_calls_count"] for r in begun} == {99: 0, 199: 0}


def test_window_file_from_a_stream(spark, arrivals, tmp_path):
    calls = stream_calls(spark, arrivals).withColumn("ingest_ts", F.col("end_ts") + 5)
    published = latency.add_publish_metrics(windows.stream_interval_rows(calls, "2 hours"))
    with pytest.raises(ValueError, match="checkpoint"):
        files.write_windows(published, f"{tmp_path}/out")
    files.write_windows(published, f"{tmp_path}/out", checkpoint=f"{tmp_path}/checkpoint").awaitTermination()
    back = spark.read.schema(published.schema).option("header", True).csv(f"{tmp_path}/out")
    assert back.count() > 1000
    assert back.where("publish_time_ms is null or publish_latency_ms < 0").count() == 0
    assert latency.latency_summary(back).first()["count"] == back.count()


def test_malformed_lines_in_a_stream(spark, tmp_path):
    path = tmp_path / "events"
    path.mkdir()
    lines = "unique_id,event_type,caller,callee,timestamp,disposition,imei\n1,0,5,6,10,busy,7\n1,x,5,6,20\n\n2,1,5,6,30\n"
    (path / "a.csv").write_text(lines)
    got, _ = run.run_to_end(
        files.read_events_stream(spark, str(path)).select("unique_id", "event_type", "event_ts"),
        f"{tmp_path}/out",
        f"{tmp_path}/checkpoint",
    )
    assert sorted(map(tuple, got.collect())) == [(1, 0, 10), (2, 1, 30)]


def test_csv_to_latency_end_to_end(spark, arrivals, tmp_path):
    """Files of lines to a stream near the present, window counts, the window file, its summary."""
    calls = batch_calls(spark, arrivals)
    source = f"{tmp_path}/csv"
    calls.select("unique_id", "start_ts", "end_ts", "caller").coalesce(1).write.option("header", True).csv(source)
    stored = files.read_calls(spark, source, bad="parse")
    assert stored.count() == 300
    earliest = prep.earliest_time(stored, ["start_ts", "end_ts"])
    near = int(time.time() * 1000)

    moved = prep.rebase_time(
        files.read_calls_stream(spark, source), ["start_ts", "end_ts"], near, earliest_ms=earliest
    )
    counts = windows.stream_interval_rows(latency.stamp_ingest(moved), "2 hours")
    published = latency.add_publish_metrics(counts)
    files.write_windows(published, f"{tmp_path}/out", checkpoint=f"{tmp_path}/checkpoint").awaitTermination()

    result = spark.read.schema(published.schema).option("header", True).csv(f"{tmp_path}/out")
    batch = active.active_interval_rows(
        prep.rebase_time(stored, ["start_ts", "end_ts"], near).withColumn("ingest_ts", F.lit(1).cast("long"))
    )
    diff = reconcile.reconcile(batch, result, ["window_start_ms"], "count").collect()
    assert result.count() > 1000 and all(r["actual"] is None for r in diff)
    assert result.agg(F.min("window_start_ms")).first()[0] == (near + 2_000) // 30_000 * 30_000
    summary = latency.latency_summary(result).first()
    assert summary["count"] == result.count() and summary["p50"] <= summary["p95"]


def test_csv_stream(spark, tmp_path):
    path = tmp_path / "calls"
    path.mkdir()
    (path / "a.csv").write_text("unique_id,start_ts,end_ts,caller,callee,disposition,imei\n1,5,9,2,3,busy,4\n")
    stream = files.read_signal_stream(spark, str(path), CALLS, fmt="csv")
    got, _ = run.run_to_end(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert [tuple(r) for r in got.collect()] == [(1, 5, 9, 2, 3, "busy", 4)]


def test_console_and_memory_sinks(spark, arrivals, tmp_path):
    counts = windows.stream_active_distinct(stream_calls(spark, arrivals), "2 hours")
    query = (
        counts.writeStream.format("memory")
        .queryName("in_memory_windows")
        .outputMode("append")
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert spark.table("in_memory_windows").count() > 1000
    # The same frame feeds a second, independent query.
    console = counts.writeStream.format("console").outputMode("append").option("truncate", "false")
    console.option("numRows", 1).trigger(availableNow=True).start().awaitTermination()
