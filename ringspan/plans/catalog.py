"""The named queries: each takes ``(spark, folder)`` and returns a DataFrame.

Calls and events are derived from the folder's ``events`` table (``sources.derived``); every query
reads all of it. Times come out as epoch milliseconds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ringspan.functions.time import (
    FIVE_MINUTES_MS,
    HALF_MINUTE_MS,
    IDLE_QUARTER_HOUR_MS,
    LEAD_MS,
    PUBLISH_WAIT_MS,
    bucket,
    to_timestamp,
)
from ringspan.operators import (
    active,
    expand,
    gaps,
    latency,
    pairing,
    prep,
    reconcile,
    snapshots,
)
from ringspan.session import work_folder
from ringspan.sources import files, replay
from ringspan.sources.derived import calls_from, calls_table, events_table, table_stream
from ringspan.streaming import batches, run, windows
from ringspan.streaming.progress import ProgressLog

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of single queries; the oracle uses the same.
TARGET_MS = 1_767_225_600_000
SNAPSHOT_WM_S = 1_705_320_000
STARTED_SIZE_S = 21_610
HOUR_MS = 3_600_000

# The ``_hot`` queries cut keys into many small slices, as a key with many rows would be.
SMALL_SLICE_MS = 600_000
# Arrivals of the stream that is analysed at its watermarks: one micro-batch per so many days of ends.
ARRIVAL_DAYS = 5

# Input of one micro-batch: state then holds the windows of the last batches, not of all time. Files
# are taken in the order they were written.
FILES_PER_BATCH = 1_000

# Disorder of a table stored by the start of its calls, and of lots that arrive in time order.
CALL_DELAY = "1 minute"
LOT_DELAY = "2 seconds"
# Second copies of calls follow after so many minutes at most.
RESENT_MINUTES = 5
# Every fortieth call arrives so many lots late.
LATE_EVERY, LATE_LOTS = 40, 2
# Micro-batches of the replay.
REPLAY_BATCHES = 5
FAR_FUTURE_MS = 4_102_444_800_000


def _utc(query: Query) -> Query:
    def run_in_utc(spark: SparkSession, folder: str) -> DataFrame:
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark = spark.newSession()  # the caller's settings stay as they are
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, folder)

    run_in_utc.__name__, run_in_utc.__doc__ = query.__name__, query.__doc__
    return run_in_utc


def _arrivals(df: DataFrame, time: str, spread: int) -> DataFrame:
    """A reproducible arrival stamp: up to ``spread`` ms after the record's own time."""
    return df.withColumn("ingest_ts", F.col(time) + F.col("unique_id") % spread).withColumn(
        "rate_ts", to_timestamp("ingest_ts")
    )


# --- active calls per window -----------------------------------------------------------------


def active_distinct_30s(spark, folder):
    return active.active_distinct(calls_table(spark, folder)).orderBy("WindowStart")


def active_calls_30s(spark, folder):
    return active.active_calls(calls_table(spark, folder)).orderBy("WindowStart")


def active_pairs_30s(spark, folder):
    return active.active_pairs(events_table(spark, folder)).orderBy("WindowStart")


def active_pairs_300s(spark, folder):
    return active.active_pairs(events_table(spark, folder), FIVE_MINUTES_MS).orderBy("WindowStart")


def active_interval_rows(spark, folder):
    return active.active_interval_rows(_arrivals(calls_table(spark, folder), "end_ts", 500))


def expand_windows_30s(spark, folder):
    return expand.expand_windows(calls_table(spark, folder), HALF_MINUTE_MS, "WindowStart").select(
        "unique_id", "start_ts", "end_ts", "WindowStart"
    )


def starts_by_window_id(spark, folder):
    return active.starts_by_window_id(calls_table(spark, folder)).orderBy("WindowID")


def _starts_in_ms(starts: DataFrame) -> DataFrame:
    return starts.select(
        F.unix_millis("window_start").alias("window_start_ms"),
        F.unix_millis("window_end").alias("window_end_ms"),
        "start_event_count",
        F.unix_millis("max_rate_ts").alias("max_rate_ms"),
    )


def starts_per_window(spark, folder):
    return _starts_in_ms(
        active.starts_per_window(_arrivals(events_table(spark, folder), "event_ts", 700))
    )


def window_deltas(spark, folder):
    return active.window_deltas(events_table(spark, folder)).orderBy("window_start")


def open_at_window_end(spark, folder):
    return active.open_at_window_end(active.window_deltas(events_table(spark, folder)))


def reconcile_mono_bi(spark, folder):
    """Windows in which the mono and the bi definition of an active call differ."""
    return reconcile.reconcile(
        active.active_distinct(calls_table(spark, folder)),
        active.active_pairs(events_table(spark, folder)),
        ["WindowStart"],
        "ActiveCalls",
    )


# --- pairing and gaps ------------------------------------------------------------------------


def calls_to_events(spark, folder):
    return pairing.calls_to_events(calls_table(spark, folder))


def pair_all(spark, folder):
    return pairing.pair_calls(_noisy_events(spark, folder), "all")


def pair_all_after(spark, folder):
    return pairing.pair_calls(_noisy_events(spark, folder), "all_after")


def pair_first_after(spark, folder):
    return pairing.pair_calls(_noisy_events(spark, folder), "first_after")


def active_pairs_noisy_30s(spark, folder):
    return active.active_pairs(_noisy_events(spark, folder)).orderBy("WindowStart")


def _noisy_calls(spark, folder):
    """The calls with repeated ids: every tenth call takes over the id before it."""
    return calls_table(spark, folder).withColumn(
        "unique_id", F.expr("if(unique_id % 10 = 9, unique_id - 1, unique_id)")
    )


def _noisy_events(spark, folder):
    """Their events; every twentieth call loses its end."""
    events = pairing.calls_to_events(_noisy_calls(spark, folder))
    return events.where("not (unique_id % 20 = 4 and event_type = 1)")


def idle_next_mono_60s(spark, folder):
    return gaps.idle_next_start(calls_table(spark, folder)).orderBy("caller", "PrevEnd")


def idle_next_bi_60s(spark, folder):
    calls = pairing.pair_calls(events_table(spark, folder), "first_after")
    return gaps.idle_next_start(calls).orderBy("caller", "PrevEnd")


def idle_next_bi_900s(spark, folder):
    calls = pairing.pair_calls(events_table(spark, folder), "first_after")
    return gaps.idle_next_start(calls, IDLE_QUARTER_HOUR_MS).orderBy("caller", "PrevEnd")


def idle_lag_mono_30s(spark, folder):
    return gaps.idle_lag(calls_table(spark, folder)).orderBy("start_ts")


def idle_lag_bi_30s(spark, folder):
    calls = pairing.pair_calls(events_table(spark, folder), "all")
    return gaps.idle_lag(calls).orderBy("start_ts")


# The same questions with keys cut into many small slices; the answers must not change.


def active_distinct_hot(spark, folder):
    return active.active_distinct(_noisy_calls(spark, folder), windows_per_slice=4)


def active_pairs_hot(spark, folder):
    return active.active_pairs(_noisy_events(spark, folder), slice_ms=SMALL_SLICE_MS)


def pair_first_after_hot(spark, folder):
    return pairing.pair_calls(_noisy_events(spark, folder), "first_after", slice_ms=SMALL_SLICE_MS)


def idle_next_hot(spark, folder):
    return gaps.idle_next_start(calls_table(spark, folder), slice_ms=SMALL_SLICE_MS)


def idle_lag_hot(spark, folder):
    return gaps.idle_lag(calls_table(spark, folder), slice_ms=SMALL_SLICE_MS)


# Inverted and incomplete calls: some end before they start, some have no end or no caller.


def _faulty_calls(spark, folder):
    return calls_table(spark, folder).withColumns(
        {
            "end_ts": F.expr("if(unique_id % 11 = 3, start_ts - 60000 * (unique_id % 7), if(unique_id % 13 = 5, null, end_ts))"),
            "caller": F.expr("if(unique_id % 17 = 2, null, caller)"),
        }
    )


def active_interval_rows_faulty(spark, folder):
    calls = _faulty_calls(spark, folder)
    return active.active_interval_rows(_arrivals(calls, "end_ts", 500))


def active_distinct_faulty(spark, folder):
    return active.active_distinct(_faulty_calls(spark, folder))


def idle_lag_faulty(spark, folder):
    return gaps.idle_lag(_faulty_calls(spark, folder))


# --- snapshots behind a watermark ------------------------------------------------------------


def snapshot_overlap(spark, folder):
    return snapshots.snapshot_overlap(calls_table(spark, folder), SNAPSHOT_WM_S)


def _rate_in_ms(df: DataFrame) -> DataFrame:
    return df.withColumn("max_rate_ms", F.unix_millis("max_rate_ts")).drop("max_rate_ts")


def snapshot_started(spark, folder):
    calls = _arrivals(calls_table(spark, folder), "end_ts", 500)
    return _rate_in_ms(snapshots.snapshot_started(calls, SNAPSHOT_WM_S, STARTED_SIZE_S))


def _hourly_watermarks(calls: DataFrame) -> DataFrame:
    """The watermark a stream of these calls would have reached in each hour."""
    return calls.groupBy(bucket("end_ts", HOUR_MS).alias("hour")).agg(
        bucket(F.max("end_ts"), 1000).alias("wm")
    ).select("wm")


def watermark_snapshots(spark, folder):
    calls = calls_table(spark, folder)
    return snapshots.watermark_snapshots(calls, _hourly_watermarks(calls))


def watermark_snapshots_started(spark, folder):
    calls = _arrivals(calls_table(spark, folder), "end_ts", 500)
    return _rate_in_ms(
        snapshots.watermark_snapshots_started(calls, _hourly_watermarks(calls), size_s=1_810)
    )


# --- preparation, replay, files --------------------------------------------------------------


def sequence_id_mono(spark, folder):
    return prep.assign_sequence_id(
        calls_table(spark, folder), ["end_ts", "unique_id"], work_folder(spark, "sequence-mono")
    )


def sequence_id_bi(spark, folder):
    return prep.assign_sequence_id(
        events_table(spark, folder),
        ["event_ts", "unique_id", "event_type"],
        work_folder(spark, "sequence-bi"),
    )


def sequence_id_file(spark, folder):
    """The numbered calls as a CSV file with an ``id`` column, read back."""
    path = work_folder(spark, "sequence-file")
    sequence_id_mono(spark, folder).write.option("header", True).csv(path)
    return files.read_calls(spark, path, has_id=True)


def time_rebase_mono(spark, folder):
    return prep.rebase_time(calls_table(spark, folder), ["start_ts", "end_ts"], TARGET_MS)


def time_rebase_bi(spark, folder):
    return prep.rebase_time(
        events_table(spark, folder), ["event_ts"], TARGET_MS, align_ms=HALF_MINUTE_MS
    )


def time_rebase_windows_bi(spark, folder):
    """Window aggregates moved as wholes, so that the first window begins at the target."""
    deltas = active.window_deltas(events_table(spark, folder))
    earliest = deltas.agg(F.min("window_start")).scalar()
    shift = F.lit(TARGET_MS + LEAD_MS) - earliest
    return deltas.withColumns({c: F.col(c) + shift for c in ("window_start", "max_event_ts")})


def _ticks(calls: DataFrame) -> DataFrame:
    """Three counter values per call, so that the replay wraps around."""
    return calls.select(
        F.explode(F.array(*[F.col("unique_id") * 3 + i for i in range(3)])).alias("value")
    ).withColumn("timestamp", to_timestamp(F.lit(TARGET_MS) + F.col("value")))


def _replayed(spark, folder, how, offset):
    calls = calls_table(spark, folder)
    table = calls.withColumn("id", F.col("unique_id"))
    joined = replay.replay_join(_ticks(calls), table, how, offset)
    return joined.withColumn("rate_ms", F.unix_millis("rate_ts")).select(
        "value", "id", "rate_ms", "unique_id", "start_ts", "end_ts", "caller"
    )


def replay_inner(spark, folder):
    return _replayed(spark, folder, "inner", 0)


def replay_left(spark, folder):
    return _replayed(spark, folder, "left", 1)


def csv_calls_parse(spark, folder):
    """Calls written as CSV lines with faults, read back by the tolerant reader."""
    path = work_folder(spark, "csv-calls")
    full = F.concat_ws(
        ",", "unique_id", "start_ts", "end_ts", "caller", "callee", "disposition", "imei"
    )
    line = F.expr(
        """case unique_id % 10
             when 1 then concat(concat_ws(',', unique_id, start_ts, end_ts, caller), '\n')
             when 3 then concat_ws(',', unique_id, start_ts, 'bad', caller)
             when 5 then concat_ws(',', unique_id, start_ts)
             when 7 then concat_ws(',', unique_id, start_ts, end_ts, '', callee)
             when 8 then concat_ws(',', unique_id, start_ts, end_ts, 'x', callee)
             when 9 then concat_ws(',', unique_id, start_ts, end_ts) end"""
    )
    calls_table(spark, folder).select(F.coalesce(line, full).alias("line")).write.text(path)
    return files.read_calls(spark, path, bad="parse")


def csv_events_parse(spark, folder):
    """Events written as CSV lines with faults, read back by the tolerant reader."""
    path = work_folder(spark, "csv-events")
    full = F.concat_ws(
        ",", "unique_id", "event_type", "caller", "callee", "event_ts", "disposition", "imei"
    )
    line = F.expr(
        """case unique_id % 10
             when 2 then concat_ws(',', unique_id, event_type, caller, callee, event_ts)
             when 4 then concat_ws(',', unique_id, 'start', caller, callee, event_ts)
             when 6 then concat_ws(',', unique_id, event_type, caller, callee)
             when 8 then concat_ws(',', unique_id, event_type, caller, callee, 'late') end"""
    )
    events_table(spark, folder).select(F.coalesce(line, full).alias("line")).write.text(path)
    return files.read_events(spark, path, bad="parse")


def csv_calls_null(spark, folder):
    """Calls with unreadable end times in the file: the field is NULL, the row stays."""
    path = work_folder(spark, "csv-null")
    bad_end = F.expr("if(unique_id % 10 = 3, 'bad', cast(end_ts as string))")
    calls_table(spark, folder).withColumn("end_ts", bad_end).write.option("header", True).csv(path)
    return files.read_calls(spark, path)


def csv_calls_drop(spark, folder):
    """The same file read so that rows with a bad field are dropped."""
    path = work_folder(spark, "csv-drop")
    bad_end = F.expr("if(unique_id % 10 = 3, 'bad', cast(end_ts as string))")
    calls_table(spark, folder).withColumn("end_ts", bad_end).write.option("header", True).csv(path)
    return files.read_calls(spark, path, bad="drop")


# --- publish metrics -------------------------------------------------------------------------


def _published(spark, folder):
    rows = active.active_interval_rows(_arrivals(calls_table(spark, folder), "end_ts", 500))
    # A reproducible publish time: the timer plus up to a second.
    publish = F.col("max_ts") + PUBLISH_WAIT_MS + 1 + bucket("window_start_ms", HALF_MINUTE_MS) % 997
    return latency.add_publish_metrics(rows, publish_ms=publish)


def publish_metrics(spark, folder):
    return _published(spark, folder)


def publish_metrics_bi(spark, folder):
    events = _arrivals(events_table(spark, folder), "event_ts", 700)
    rows = active.open_at_window_end(active.window_deltas(events))
    publish = F.col("max_ts") + PUBLISH_WAIT_MS + 1 + bucket("window_start_ms", HALF_MINUTE_MS) % 997
    return latency.add_publish_metrics(rows, publish_ms=publish, zero_without_arrival=False)


def window_file(spark, folder):
    """The nine-column window file, written as CSV and read back."""
    path = work_folder(spark, "windows")
    result = _published(spark, folder)
    files.write_windows(result, path)
    return spark.read.schema(result.schema).option("header", True).csv(path)


def latency_summary(spark, folder):
    return latency.latency_summary(_published(spark, folder))


# --- streams ---------------------------------------------------------------------------------


def _far_row(df: DataFrame) -> Row:
    times = {c: FAR_FUTURE_MS for c in ("start_ts", "end_ts", "event_ts")}
    return Row(*[0 if c == "event_type" else times.get(c) for c in df.columns])


def _drained(spark, name, source: DataFrame, build) -> tuple[DataFrame, list]:
    """Run ``build(source)`` (an aggregate) over all input and past its last window; an error if a row came late."""
    folder = work_folder(spark, name)
    tail = f"{folder}/tail"
    stream = run.with_tail(source, tail)
    table, progress = run.run_to_end(
        build(stream),
        f"{folder}/out",
        f"{folder}/checkpoint",
        lambda: run.push_tail(spark, tail, stream.schema, _far_row(stream)),
        # One state partition per core.
        state_partitions=spark.sparkContext.defaultParallelism,
    )
    late = run.late_rows(progress)
    if late:
        raise RuntimeError(f"{late} rows came later than the delay allows; the windows are not whole")
    return table, progress


def _call_stream(spark, folder):
    calls = calls_from(table_stream(spark, folder, FILES_PER_BATCH))
    return calls.select("unique_id", "start_ts", "end_ts")


def _event_stream(spark, folder):
    return pairing.calls_to_events(_call_stream(spark, folder))


def _event_delay(calls: DataFrame) -> str:
    """Both events of a call come with its row, so they are out of order by the longest call."""
    longest = calls.agg(F.max(F.col("end_ts") - F.col("start_ts"))).first()[0] or 0
    return f"{longest + 60_000} milliseconds"


def _start_counts(events: DataFrame, delay: str) -> DataFrame:
    return _starts_in_ms(active.starts_per_window(_arrivals(events, "event_ts", 700), delay=delay))


def stream_starts_per_window(spark, folder):
    delay = _event_delay(calls_table(spark, folder))
    return _drained(
        spark, "starts", _event_stream(spark, folder), lambda events: _start_counts(events, delay)
    )[0]


def stream_active_distinct(spark, folder):
    """Calls folded by their first and last window while they stream; then the counts of all windows."""
    spans, _ = _drained(
        spark,
        "active",
        _call_stream(spark, folder),
        lambda calls: windows.stream_spans(
            windows.stream_sent_once(calls, CALL_DELAY, "start_ts"), None
        ),
    )
    return active.active_of_spans(spans)


def reconcile_stream_batch(spark, folder):
    """Windows where the counts of a stream of calls differ from those of stored pairs of events."""
    pairs = active.active_pairs(events_table(spark, folder))
    return reconcile.reconcile(
        pairs, stream_active_distinct(spark, folder), ["WindowStart"], "ActiveCalls"
    )


def stream_interval_rows(spark, folder):
    spans, _ = _drained(
        spark,
        "intervals",
        _call_stream(spark, folder),
        lambda calls: windows.stream_spans(
            _arrivals(calls, "end_ts", 500).drop("rate_ts"), CALL_DELAY, time="start_ts"
        ),
    )
    return active.interval_rows_of_spans(spans)


def stream_resent_calls(spark, folder):
    """Every call is sent twice, minutes apart, and counted once."""

    def sent_twice(calls: DataFrame) -> DataFrame:
        minutes = F.col("copy") * (1 + F.coalesce(F.col("unique_id") % RESENT_MINUTES, F.lit(0)))
        return calls.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
            "sent_ts", F.col("start_ts") + 60_000 * minutes
        )

    delay = f"{2 * RESENT_MINUTES} minutes"
    spans, _ = _drained(
        spark,
        "resent",
        _call_stream(spark, folder),
        lambda calls: windows.stream_spans(windows.stream_sent_once(sent_twice(calls), delay, "sent_ts"), None),
    )
    return active.active_of_spans(spans)


def stream_window_deltas(spark, folder):
    delay = _event_delay(calls_table(spark, folder))
    return _drained(
        spark,
        "deltas",
        _event_stream(spark, folder),
        lambda events: windows.stream_window_deltas(events, delay),
    )[0]


def stream_open_at_end(spark, folder):
    return active.open_at_window_end(stream_window_deltas(spark, folder))


def stream_materialized_calls(spark, folder):
    """Calls appended to a table by a stream, then read as a batch."""
    path = work_folder(spark, "calls")
    calls = calls_from(table_stream(spark, folder, FILES_PER_BATCH))
    run.materialize_stream(calls, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(calls.schema).parquet(f"{path}/out")


def _lots(rows: DataFrame, lot: Column, path: str) -> list[DataFrame]:
    """The rows by the lot they arrive in, in order: written once, by ranges, so a lot may be many files."""
    stored = rows.withColumn("lot", lot).repartitionByRange("lot", F.xxhash64(*rows.columns))
    stored.write.partitionBy("lot").parquet(f"{path}/lots")
    kept = rows.sparkSession.read.schema(f"{rows.schema.toDDL()}, lot long").parquet(f"{path}/lots")
    # As many numbers as lots of days in the time covered.
    numbers = sorted(row[0] for row in kept.select("lot").distinct().collect())
    return [kept.where(F.col("lot") == number).drop("lot") for number in numbers]


def _five_days(time: str) -> Column:
    return bucket(time, ARRIVAL_DAYS * 86_400_000)


def _arriving(
    rows: DataFrame, lot: Column, path: str, start: Callable[[DataFrame, int], StreamingQuery], flush: bool = True
) -> None:
    """Run a stream over rows that arrive lot by lot: each lot is appended to the folder that the stream reads,
    and the stream is resumed from its checkpoint and takes the lot as one micro-batch.

    ``start`` gets the stream and the number of the run. With ``flush`` a last lot of one far row closes all windows.
    """
    spark = rows.sparkSession
    lots = _lots(rows.where(lot.isNotNull()), lot, path)
    if flush:
        lots.append(spark.createDataFrame([_far_row(rows)], rows.schema))
    for number, part in enumerate(lots):
        part.write.mode("append").parquet(f"{path}/in")
        start(spark.readStream.schema(rows.schema).parquet(f"{path}/in"), number).awaitTermination()


def _plain_calls(spark, folder) -> DataFrame:
    return calls_table(spark, folder).select("unique_id", "start_ts", "end_ts")


def stream_resumed(spark, folder):
    """The folded calls of a stream that is stopped and resumed after each lot, with more input and another number
    of state partitions each time."""
    path = work_folder(spark, "resumed")

    def start(calls: DataFrame, number: int) -> StreamingQuery:
        spans = windows.stream_spans(calls, LOT_DELAY)
        return run.materialize_stream(spans, f"{path}/out", f"{path}/checkpoint", state_partitions=2 + number)

    _arriving(_plain_calls(spark, folder), _five_days("end_ts"), path, start)
    spans = spark.read.schema("first long, last long, n long, max_ts long").parquet(f"{path}/out")
    return active.active_of_spans(spans)


def stream_running_total(spark, folder):
    """Calls open at the end of each window, as rows that appear while the stream runs."""
    path = work_folder(spark, "totals")

    def start(events: DataFrame, _: int) -> StreamingQuery:
        deltas = windows.stream_window_deltas(events, LOT_DELAY)
        return batches.each_batch(
            deltas, batches.running_totals(path), f"{path}/checkpoint", state_partitions=spark.sparkContext.defaultParallelism
        )

    events = pairing.calls_to_events(_plain_calls(spark, folder))
    _arriving(events, _five_days("event_ts"), path, start)
    return spark.read.parquet(f"{path}/totals").drop("batch_id")


def stream_timed_windows(spark, folder):
    """Windows emitted by event-time timers, with the number of each emission among its window's."""
    path = work_folder(spark, "timed")

    def start(calls: DataFrame, _: int) -> StreamingQuery:
        timed = windows.stream_timed_windows(_arrivals(calls, "end_ts", 500).drop("rate_ts"), LOT_DELAY)
        return run.materialize_stream(
            timed, f"{path}/out", f"{path}/checkpoint", state_partitions=spark.sparkContext.defaultParallelism
        )

    _arriving(_plain_calls(spark, folder), _five_days("end_ts"), path, start)
    window = Window.partitionBy("window_start_ms")
    return (
        spark.read.schema(windows.TIMED)
        .parquet(f"{path}/out")
        .withColumn("emission", F.row_number().over(window.orderBy("timer_ts")))
        .withColumn("emissions", F.count("*").over(window))
    )


def stream_late_corrections(spark, folder):
    """Window rows that late calls correct after they were published: the last version of each closed window."""
    path = work_folder(spark, "corrections")

    def start(calls: DataFrame, _: int) -> StreamingQuery:
        rows = _arrivals(calls, "end_ts", 500).drop("rate_ts")
        return batches.each_batch(rows, batches.corrected_windows(path), f"{path}/checkpoint")

    late = F.when(F.col("unique_id") % LATE_EVERY == 7, LATE_LOTS).otherwise(0)
    _arriving(_plain_calls(spark, folder), _five_days("end_ts") + late, path, start, flush=False)
    return batches.latest_versions(spark.read.parquet(f"{path}/versions"))


def _analysed(spark, folder, name, started: bool) -> DataFrame:
    path = work_folder(spark, name)

    def start(calls: DataFrame, _: int) -> StreamingQuery:
        stamped = calls.withColumn("rate_ts", to_timestamp(F.col("end_ts") + F.col("unique_id") % 500))
        act = batches.due_analysis(path, started=started)
        return batches.each_batch(stamped, act, f"{path}/checkpoint")

    _arriving(_plain_calls(spark, folder), _five_days("end_ts"), path, start, flush=False)
    return spark.read.parquet(f"{path}/snapshots").drop("batch_id")


def stream_watermark_snapshots(spark, folder):
    """A growing table analysed at each due watermark of the stream that fills it, while it runs."""
    return _analysed(spark, folder, "snapshots", False)


def stream_watermark_snapshots_started(spark, folder):
    return _rate_in_ms(_analysed(spark, folder, "snapshots-started", True))


def stream_replayed_starts(spark, folder):
    """Ticks of a counter drive a stored table of events through the window counts, as it would arrive."""
    path = work_folder(spark, "replay")
    events = pairing.calls_to_events(_plain_calls(spark, folder))
    numbered = prep.assign_sequence_id(events, ["event_ts", "unique_id", "event_type"], f"{path}/numbered")
    n = numbered.count()
    far = spark.createDataFrame([_far_row(events)], events.schema).withColumn("id", F.lit(n).cast("long"))
    numbered.unionByName(far).write.parquet(f"{path}/table")
    table = spark.read.schema(numbered.schema).parquet(f"{path}/table")
    rows = -(-(n + 1) // REPLAY_BATCHES)
    ticks = replay.tick_stream(spark, rows).where(F.col("value") <= n)
    counts = _start_counts(replay.replay_join(ticks, table, rows=n + 1).drop("rate_ts"), LOT_DELAY)
    query = run.materialize_stream(
        counts,
        f"{path}/out",
        f"{path}/checkpoint",
        every="0 seconds",
        state_partitions=spark.sparkContext.defaultParallelism,
    )
    # One more micro-batch emits what the last rows have closed.
    run.run_batches(query, REPLAY_BATCHES + 2)
    return spark.read.schema(counts.schema).parquet(f"{path}/out")


def stream_progress(spark, folder):
    """Totals over the progress reports of the stream of window starts, as a listener has put them in a table."""
    log = ProgressLog(spark, work_folder(spark, "progress-log"))
    delay = _event_delay(calls_table(spark, folder))
    path = work_folder(spark, "progress")
    spark.streams.addListener(log)
    try:

        def start(calls: DataFrame, _: int) -> StreamingQuery:
            counts = _start_counts(pairing.calls_to_events(calls), delay)
            query = run.materialize_stream(counts, f"{path}/out", f"{path}/checkpoint", state_partitions=4)
            query.awaitTermination()
            if not log.settled(query):
                raise TimeoutError("the listener has not heard of the end of the query")
            return query

        _arriving(_plain_calls(spark, folder), _five_days("end_ts"), path, start, flush=False)
    finally:
        spark.streams.removeListener(log)
    return log.read().agg(F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"))


ALL: tuple[Query, ...] = (
    active_distinct_30s,
    active_calls_30s,
    active_pairs_30s,
    active_pairs_300s,
    active_pairs_noisy_30s,
    active_interval_rows,
    expand_windows_30s,
    starts_by_window_id,
    starts_per_window,
    window_deltas,
    open_at_window_end,
    reconcile_mono_bi,
    calls_to_events,
    pair_all,
    pair_all_after,
    pair_first_after,
    idle_next_mono_60s,
    idle_next_bi_60s,
    idle_next_bi_900s,
    idle_lag_mono_30s,
    idle_lag_bi_30s,
    active_distinct_hot,
    active_pairs_hot,
    pair_first_after_hot,
    idle_next_hot,
    idle_lag_hot,
    active_interval_rows_faulty,
    active_distinct_faulty,
    idle_lag_faulty,
    snapshot_overlap,
    snapshot_started,
    watermark_snapshots,
    watermark_snapshots_started,
    sequence_id_mono,
    sequence_id_bi,
    sequence_id_file,
    time_rebase_mono,
    time_rebase_bi,
    time_rebase_windows_bi,
    replay_inner,
    replay_left,
    csv_calls_parse,
    csv_events_parse,
    csv_calls_null,
    csv_calls_drop,
    publish_metrics,
    publish_metrics_bi,
    window_file,
    latency_summary,
    stream_starts_per_window,
    stream_active_distinct,
    stream_interval_rows,
    stream_window_deltas,
    stream_open_at_end,
    stream_materialized_calls,
    stream_watermark_snapshots,
    stream_watermark_snapshots_started,
    stream_progress,
    stream_resent_calls,
    stream_resumed,
    stream_running_total,
    stream_timed_windows,
    stream_late_corrections,
    stream_replayed_starts,
    reconcile_stream_batch,
)

QUERIES: dict[str, Query] = {query.__name__: _utc(query) for query in ALL}
