"""Every checked query against its SQL, and the shape of key plans."""

import os
import re

import pytest

import __spark_entry__ as contract
import oracle
from siltbed.checks.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("SILTBED_TEST_DATA", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    ours, theirs = oracle.compare(result, duck, ORACLES[name])
    assert ours == theirs


def test_entry(spark):
    assert contract.entry(spark).columns[:2] == ["event_id", "user_id"]


def plan(spark, name):
    df = contract.queries()[name](spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_rows_limit_each_task_before_the_shuffle(spark):
    text = plan(spark, "latest_row_per_key")
    assert re.search(r"Final.*Exchange hashpartitioning.*Partial", text, re.S)
    assert text.count("Exchange") == 1


def test_latest_files_aggregate_rows_by_hash(spark):
    text = plan(spark, "latest_file_per_partition")
    assert text.count("HashAggregate") == 4 and "SortAggregate" not in text


def test_paths_are_parsed_once_per_row(spark):
    for name in ("latest_file_per_partition", "latest_row_per_key", "dates_from_path"):
        assert plan(spark, name).count("regexp_replace") == 1


def test_small_join_side_is_broadcast_after_measuring(spark):
    assert "BroadcastHashJoin" in plan(spark, "rows_of_latest_file")


def test_scans_read_only_needed_columns(spark):
    text = plan(spark, "parquet_scan")
    assert "l_comment" not in text and "l_quantity" not in text


def test_touched_partitions_prune_directories(spark, tmp_path):
    from siltbed import touched_partitions

    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 1, 1), (2, 1, 2), (3, 2, 1)], "v int, y int, m int")
    df.write.partitionBy("y", "m").parquet(path)
    stored = spark.read.parquet(path)
    text = touched_partitions(stored, df.filter("v = 1"), ["y", "m"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]+\]", text) and "Join" not in text
