"""Every named query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as contract
from tests.oracle_check import compare, connect

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_equal(spark, con, name):
    assert compare(spark, con, DATA, name) is None


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["WindowStart", "ActiveCalls"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["active_distinct_30s", "stream_window_deltas", "stream_watermark_snapshots"])
def test_table_of_many_files(spark, con, tmp_path, name):
    """The table may be a folder of files, as on a cluster."""
    table = spark.read.parquet(f"{DATA}/events.parquet")
    table.repartitionByRange(4, "event_id").write.parquet(f"{tmp_path}/events.parquet")
    query = contract.queries()[name]
    assert query(spark, str(tmp_path)).exceptAll(query(spark, DATA)).count() == 0
    assert query(spark, str(tmp_path)).count() == query(spark, DATA).count()
