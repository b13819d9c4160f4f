"""Stored tables: upserts and compaction of single files, what changed in a partition."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from siltbed.operators.changes import key_changes, partition_content_changes
from siltbed.sinks import files
from siltbed.sinks.lake import upsert_partitions
from siltbed.sources import storage

ROWS = "k int, v string, n int, p string"


def names(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, found in os.walk(path)
        for f in found
        if f.endswith(".parquet")
    }


def rows_of(spark, path):
    return sorted(map(repr, spark.read.schema(ROWS).parquet(path).collect()))


def stored(spark, path, cols=("p",)):
    """Files of one key range each, two in partition a, with odd partition values and a null key."""
    for rows in ([(1, "x", 1, "a"), (2, "x", 1, "a")], [(3, "x", 1, "a"), (None, "x", 1, "a")], [(1, "x", 1, "b c%é=/")], [(7, "x", 1, None)]):
        df = spark.createDataFrame(rows, ROWS).coalesce(1)
        df.write.mode("append").partitionBy(*cols).parquet(path) if cols else df.write.mode("append").parquet(path)


DELTAS = [
    [(2, "new", 2, "a")],
    [(None, "new", 2, "a"), (9, "new", 2, "a"), (7, "new", 2, None)],
    [(1, "old", 0, "a"), (1, "tie", 1, "b c%é=/"), (5, "new", 2, "fresh"), (7, "blank", 3, "")],
    [],
]


@pytest.mark.parametrize("rows", DELTAS)
def test_upserts_by_file_and_by_partition_agree(spark, tmp_path, rows):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    stored(spark, one), stored(spark, two)
    delta = spark.createDataFrame(rows, ROWS)
    before = names(one)
    for _ in range(2):
        files.upsert_files(delta, one, ["k"], ["p"], ["n"])
        upsert_partitions(delta, two, ["k"], ["p"], ["n"])
        assert rows_of(spark, one) == rows_of(spark, two)
    kept = [n for n, time in names(one).items() if before.get(n) == time]
    assert len(kept) == {0: 3, 1: 2, 2: 1, 3: 4}[DELTAS.index(rows)]
    assert not [n for n in os.listdir(tmp_path) if n.startswith("_")]


def test_upsert_without_partitions_or_table_or_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "x", 1, "a"), (1, "y", 2, "a")], ROWS)
    files.upsert_files(first, path, ["k"], [], ["n"])
    assert [r["v"] for r in spark.read.parquet(path).collect()] == ["y"]
    spark.createDataFrame([(4, "z", 1, "a")], ROWS).coalesce(1).write.mode("append").parquet(path)
    before = names(path)
    files.upsert_files(spark.createDataFrame([(4, "w", 5, "b")], ROWS), path, ["k"], [], ["n"])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == ["w", "y"]
    assert len([n for n in names(path) if n in before]) == 1
    files.upsert_files(spark.createDataFrame([(4, "w", 5, "b"), (4, "v", 5, "b")], ROWS), path, None, [], ["n"])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == ["v", "w", "y"]


@pytest.mark.parametrize("step", ["move_in", "delete", "write_text"])
def test_interrupted_change_is_finished_or_dropped(spark, tmp_path, monkeypatch, step):
    path, whole = str(tmp_path / "t"), str(tmp_path / "whole")
    stored(spark, path), stored(spark, whole)
    delta = spark.createDataFrame([(2, "new", 2, "a"), (1, "new", 2, "b c%é=/")], ROWS)
    calls = []

    def stop(*args, real=getattr(storage, step)):
        calls.append(args)
        if len(calls) == 2 or step == "write_text":
            raise InterruptedError
        return real(*args)

    with monkeypatch.context() as patch:
        patch.setattr(storage, step, stop)
        with pytest.raises(InterruptedError):
            files.upsert_files(delta, path, ["k"], ["p"], ["n"])
    files.settle(spark, path)
    if step != "write_text":
        files.upsert_files(delta, whole, ["k"], ["p"], ["n"])
    assert rows_of(spark, path) == rows_of(spark, whole)
    assert sorted(os.listdir(tmp_path)) == ["t", "whole"]


def test_only_key_columns_are_read_to_find_files(spark, tmp_path):
    path = str(tmp_path / "t")
    stored(spark, path)
    delta = spark.createDataFrame([(2, "new", 2, "a")], ROWS)
    plan = files.files_with_keys(spark.read.parquet(path), delta, ["k", "p"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:int>" in plan and "Sort" not in plan


def test_compaction_gathers_small_files_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rng = random.Random(1)
    big = spark.range(60_000).selectExpr("int(id) k", "uuid() v", "1 n", "'big' p").coalesce(1)
    big.write.partitionBy("p").parquet(path)
    rows = [(i, "v%d" % rng.randrange(9), i, rng.choice(["a b", "c%", None])) for i in range(300)]
    spark.createDataFrame(rows, ROWS).repartition(5).write.mode("append").partitionBy("p").parquet(path)
    spark.createDataFrame([(1, "alone", 1, "alone")], ROWS).coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    before, content = names(path), rows_of(spark, path)
    assert files.compact_small_files(spark, path, ["p"], 1 << 20) == 15
    after = names(path)
    assert len(after) == 5 and rows_of(spark, path) == content
    assert sum(before.get(n) == t for n, t in after.items()) == 2
    assert files.compact_small_files(spark, path, ["p"], 1 << 20) == 0 and names(path) == after
    assert files.compact_small_files(spark, path, ["p"], 1 << 30) == 0


def test_compaction_cuts_by_size(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(40_000).selectExpr("int(id) k", "uuid() v").repartition(16).write.parquet(path)
    total = sum(os.path.getsize(n) for n in names(path))
    assert files.compact_small_files(spark, path, [], total // 4) == 16
    sizes = [os.path.getsize(n) for n in names(path)]
    assert len(sizes) in (4, 5) and spark.read.parquet(path).distinct().count() == 40_000
    assert files.compact_small_files(spark, path, [], total // 4) == 0


CHANGES = "p string, k int, v string, m map<string,int>, path string"


def test_changes_of_rows_by_content(spark):
    old = [
        ("a", 1, "x", {"i": 1, "j": 2}, "f"), ("a", 2, None, None, "f"), ("a", None, "n", {}, "f"), ("b", 3, "x", None, "f"),
        ("b", 4, "x", None, "f"), ("b", 4, "y", None, "f"), (None, 5, "z", None, "f"), ("c", 6, "gone", None, "f"),
    ]
    new = [
        ("a", 1, "x", {"j": 2, "i": 1}, "g"), ("a", 2, "", None, "g"), ("a", None, "n", {}, "g"), ("d", 3, "x", None, "g"),
        ("b", 4, "y", None, "g"), ("b", 4, "x", None, "g"), (None, 5, "z", {"i": 1}, "g"), (None, None, "new", None, "g"),
    ]
    one, two = spark.createDataFrame(old, CHANGES), spark.createDataFrame(new, CHANGES)
    got = {(r["p"], r["k"]): r["change"] for r in key_changes(one, two, ["p", "k"]).collect()}
    assert got == {
        ("a", 1): "unchanged", ("a", 2): "updated", ("a", None): "unchanged", ("b", 3): "gone", ("d", 3): "inserted",
        ("b", 4): "unchanged", (None, 5): "updated", ("c", 6): "gone", (None, None): "inserted",
    }
    counts = {r["p"]: tuple(r)[1:] for r in partition_content_changes(one, two, ["k"], ["p"]).collect()}
    assert counts == {"a": (0, 1, 2, 0), "b": (0, 0, 1, 1), "c": (0, 0, 0, 1), "d": (1, 0, 0, 0), None: (1, 1, 0, 0)}
    swapped = spark.createDataFrame([(1, None, "x"), (2, "x", None)], "k int, a string, b string")
    back = spark.createDataFrame([(1, "x", None), (2, "x", None)], "k int, a string, b string")
    assert {r["k"]: r["change"] for r in key_changes(swapped, back, ["k"]).collect()} == {1: "updated", 2: "unchanged"}
    # A column that one side lacks is null there, and types are those of the old side.
    wider = back.withColumn("c", F.lit(1)).withColumn("k", F.col("k").cast("long"))
    assert {r["change"] for r in key_changes(back, wider, ["k"]).collect()} == {"updated"}
    assert {r["change"] for r in key_changes(back, back.withColumn("k", F.col("k").cast("long")), ["k"]).collect()} == {"unchanged"}
    assert key_changes(one.limit(0), two.limit(0), ["k"]).count() == 0


def test_comparison_joins_without_another_shuffle(spark):
    one = spark.range(1000).selectExpr("id as k", "id % 7 as p", "id as v")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = key_changes(one, one.withColumn("v", F.col("v") + 1), ["p", "k"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "FullOuter" in plan and plan.count("Exchange hashpartitioning") <= 4


def test_journal_appears_whole(spark, tmp_path):
    target = str(tmp_path / "j")
    storage.write_text(spark, target + "x", json.dumps({"new": ["é"]}), target)
    assert json.loads(storage.read_text(spark, target)) == {"new": ["é"]} and os.listdir(tmp_path).count("jx") == 0
