"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from ringspan.operators import active, gaps, pairing, snapshots
from ringspan.plans import catalog
from ringspan.sources.derived import calls_table, events_table
from tests import fixtures as fx

DATA = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = [name for name in catalog.QUERIES if not name.startswith("stream_")]


@pytest.mark.parametrize("name", BATCH)
def test_no_products_and_no_python(spark, name):
    text = plan(catalog.QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"Python|ArrowEval|MapInPandas|FlatMapGroups", text)


def test_scan_reads_only_what_is_needed(spark):
    text = plan(active.starts_by_window_id(calls_table(spark, DATA)))
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz>", text)
    text = plan(active.active_calls(calls_table(spark, DATA)))
    assert "Window" in text


def test_calls_filter_reaches_the_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    fx.golden_calls(spark).write.parquet(f"{tmp_path}/calls")
    calls = spark.read.parquet(f"{tmp_path}/calls")
    text = plan(snapshots.snapshot_overlap(calls, 1_764_080_160))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(end_ts,.*LessThan\(start_ts,", text)
    assert "ReadSchema: struct<start_ts:bigint,end_ts:bigint>" in text


def test_ordinary_gap_plans_shuffle_once(spark):
    calls = calls_table(spark, DATA)
    for df in (gaps.idle_lag(calls, sliced=False), gaps.idle_next_start(calls, sliced=False)):
        assert plan(df).count("Exchange hashpartitioning") == 1
    assert plan(pairing.pair_calls(events_table(spark, DATA), sliced=False)).count("Exchange hashpartitioning") == 1


def test_window_counts_shuffle_aggregates_only(spark):
    """Every shuffle of a count has a partial aggregate below it."""
    events = events_table(spark, DATA).withColumn("rate_ts", F.timestamp_millis("event_ts"))
    calls = calls_table(spark, DATA).withColumn("ingest_ts", F.col("end_ts"))
    for df in (
        active.window_deltas(events),
        active.starts_per_window(events),
        active.starts_by_window_id(calls),
        active.active_interval_rows(calls),
    ):
        lines = plan(df).splitlines()
        below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange" in line]
        assert below and all("HashAggregate" in line and "partial_" in line for line in below)


def test_no_job_while_a_frame_is_built(spark):
    """Building the frames starts no Spark job: nothing is sampled, collected or written."""
    calls, events = calls_table(spark, DATA), events_table(spark, DATA)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "frames")
    try:
        frames = [
            active.active_distinct(calls),
            active.active_pairs(events),
            active.open_at_window_end(active.window_deltas(events)),
            gaps.idle_next_start(pairing.pair_calls(events)),
            gaps.idle_lag(calls),
        ]
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert all(frame.limit(1).count() == 1 for frame in frames)


def test_totals_share_one_exchange(spark):
    """The cells and their sums read the same shuffle."""
    frame = active.open_at_window_end(active.window_deltas(events_table(spark, DATA)))
    frame.collect()
    assert "ReusedExchange" in plan(frame) or "ReusedExchange" in frame._jdf.queryExecution().executedPlan().toString()


def test_key_with_all_rows_in_one_slice(spark):
    """One caller and one id hold all rows, within an hour: equal milliseconds fold before they are ordered."""
    calls = spark.range(200_000).select(
        F.lit(1).cast("long").alias("unique_id"),
        F.lit(7).cast("long").alias("caller"),
        (F.col("id") % 1000 * 3_000).alias("start_ts"),
        (F.col("id") % 1000 * 3_000 + 500).alias("end_ts"),
    )
    gapped = gaps.idle_next_start(calls, 2_000)
    assert gapped.groupBy("PrevEnd").count().where("count <> 200 * 200").count() == 0
    assert gapped.select("PrevEnd").distinct().count() == 999
    assert active.active_distinct(calls, 30_000).where("ActiveCalls <> 1").count() == 0


def test_hot_caller_is_cut_into_slices(spark):
    """The sliced plan gives the same gaps for a caller with a third of all calls, in bounded groups."""
    calls = spark.range(60_000).select(
        F.col("id").alias("unique_id"),
        F.expr("if(id % 3 = 0, 7, 100 + id % 500)").alias("caller"),
        (F.col("id") * 40_000).alias("start_ts"),
        (F.col("id") * 40_000 + F.abs(F.xxhash64("id")) % 200_000).alias("end_ts"),
    )
    day = 86_400_000
    for operator in (gaps.idle_next_start, gaps.idle_lag):
        plain, cut = operator(calls, 30_000, sliced=False), operator(calls, 30_000, slice_ms=day)
        assert plain.exceptAll(cut).count() == cut.exceptAll(plain).count() == 0
        assert plain.where("caller = 7").count() > 1000


def test_hot_id_costs_rows_not_pairs(spark):
    """An id with 20,000 starts and ends has 10^8 pairs; they are counted, never formed."""
    n = 20_000
    events = spark.range(2 * n).select(
        F.lit(1).cast("long").alias("unique_id"),
        F.lit(5).cast("long").alias("caller"),
        (F.col("id") % 2).cast("int").alias("event_type"),
        (F.col("id") * 1000).alias("event_ts"),
    )
    for sliced in (False, True):
        counts = active.active_pairs(events, 30_000, sliced=sliced)
        # In window w, starts before its end times ends from its start on.
        w = 600_000
        starts = sum(1 for i in range(0, 2 * n, 2) if i * 1000 < w + 30_000)
        ends = sum(1 for i in range(1, 2 * n, 2) if i * 1000 >= w)
        inside = [i for i in range(600, 630)]
        inverted = sum(1 for s in inside if s % 2 == 0 for e in inside if e % 2 == 1 and e < s)
        assert counts.where(f"WindowStart = {w}").first()[1] == starts * ends - inverted
        first = pairing.pair_calls(events, "first_after", sliced=sliced)
        assert first.where("end_ts = start_ts + 1000").count() == n


def test_bucketed_calls_need_no_shuffle(spark, tmp_path):
    """Calls stored in buckets of their caller (events in buckets of their id) are not shuffled again."""
    calls = calls_table(spark, DATA)
    calls.write.mode("overwrite").bucketBy(8, "caller").option("path", f"{tmp_path}/calls").saveAsTable("calls_b")
    events = events_table(spark, DATA)
    events.write.mode("overwrite").bucketBy(8, "unique_id").option("path", f"{tmp_path}/events").saveAsTable("events_b")
    try:
        stored_calls, stored_events = spark.table("calls_b"), spark.table("events_b")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plans = {
            "lag": gaps.idle_lag(stored_calls, sliced=False),
            "next": gaps.idle_next_start(stored_calls, sliced=False),
            "first": pairing.pair_calls(stored_events, "first_after", sliced=False),
            "all": pairing.pair_calls(stored_events, "all_after"),
        }
        assert {name: plan(df).count("Exchange") for name, df in plans.items()} == dict.fromkeys(plans, 0)
        assert plans["next"].exceptAll(gaps.idle_next_start(calls)).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table calls_b")
        spark.sql("drop table events_b")
