"""The shared folder and measured broadcasts."""

import os

import pytest
from pyspark.sql import functions as F

from siltbed.session import broadcast_if_small, scratch_path, shared_folder


def is_marked(df):
    return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()


def test_scratch_paths_lie_in_the_shared_folder(spark):
    first, second = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert first != second and first.startswith(shared_folder(spark))
    assert os.path.isdir(os.path.dirname(first)) and not os.path.exists(first)


@pytest.mark.parametrize(("limit", "marked"), [("10MB", True), ("100", False), ("-1", False)])
def test_broadcast_follows_the_measured_size(spark, limit, marked):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        frame = broadcast_if_small(spark.range(100).selectExpr("id", "repeat('x', 50) AS t"))
        assert is_marked(frame) == marked
        assert frame.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize(("limit", "marked"), [("200KB", True), ("10KB", False)])
def test_nested_columns_count(spark, limit, marked):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        frame = spark.range(1000, numPartitions=2).selectExpr("id % 100 AS k", "id").groupBy("k")
        frame = frame.agg(F.collect_list("id").alias("ids"))
        assert is_marked(broadcast_if_small(frame)) == marked
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_known_small_frames_run_no_job_and_leave_no_file(spark):
    frame = spark.range(5).selectExpr("id AS k", "'a' AS v")
    folder = spark.sparkContext.getCheckpointDir() or shared_folder(spark)
    files = lambda: sum(len(f) for _, _, f in os.walk(folder.removeprefix("file:")))
    before = files()
    assert is_marked(broadcast_if_small(frame)) and files() == before
