"""Repeated loads: the ledger, bounded scans, batches and configuration."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from siltbed import TableSpec, load_configured, load_dataset, load_table
from siltbed.plans import load
from siltbed.plans.catalog import DatasetConfig, json_specs, load_specs, size_batches
from siltbed.plans.load import LoadOptions
from siltbed.sinks import ledger
from siltbed.sinks.lake import append_standardised
from siltbed.sources.files import file_inventory, listed_files, literal_path, read_raw, this_instant
from test_plans import COLUMN_CONFIG, TABLE_CONFIG, at, dataset, put, table_row

SPEC = TableSpec("t", ("r",), "C", scheme="YYYYMM", role="Recent", keys=("k",))


def stored(spark, root, name="t"):
    return sorted(r["k"] for r in spark.read.parquet(f"{root}/standardised/{name}").collect())


def row(k, key="202401"):
    return f"k,PartitionKey\n{k},{key}\n"


def test_a_failed_load_is_repeated_without_repeating_rows(spark, tmp_path, monkeypatch):
    put(tmp_path / "raw/r", at(2), "a b%20+é.csv", row(1))
    put(tmp_path / "raw/r", at(3), "b.csv", row(2))

    def broken(*args):
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(load, "write_curated", broken)
        with pytest.raises(OSError):
            load_table(spark, SPEC, str(tmp_path))
    assert stored(spark, tmp_path) == ["1", "2"] and not (tmp_path / "curated/C").exists()
    put(tmp_path / "raw/r", at(4), "c.csv", row(3))
    curated = load_table(spark, SPEC, str(tmp_path))
    assert stored(spark, tmp_path) == ["1", "2", "3"]
    assert sorted(r["k"] for r in spark.read.parquet(curated).collect()) == ["1", "2", "3"]
    load_table(spark, SPEC, str(tmp_path), options=LoadOptions(once=False))
    assert stored(spark, tmp_path) == ["1", "1", "2", "2", "3", "3"]


@pytest.mark.parametrize("level", ["Month", None])
def test_what_a_stopped_append_left_is_removed(spark, tmp_path, level):
    for day in (2, 3, 4):
        put(tmp_path / "raw", at(day), "a b.csv", row(day))
    rows = read_raw(spark, str(tmp_path / "raw"))
    dated = rows.withColumn("ingestionDateTime", F.lit("2024-01-02").cast("timestamp_ntz"))
    path, book = str(tmp_path / "t"), str(tmp_path / "ledger")

    def write(df, target):
        if level is None:
            df.write.mode("append").parquet(target)
        else:
            append_standardised(df, target, level)

    first = dated.filter("path like '%day=02%'")
    ledger.append_once(first, path, book, "t", level, [f for f in listed_files(rows) if "day=02" in f])

    def stop(df, target):
        write(df.filter("path like '%day=03%'"), target)
        raise InterruptedError

    with pytest.raises(InterruptedError):
        ledger.append_once(dated, path, book, "t", level, listed_files(rows), stop)
    keys = lambda: sorted(r["k"] for r in spark.read.parquet(path).collect())
    assert keys() == ["2", "3"]
    assert ledger.undo_unfinished(spark, path, book, "other", level) == 0
    ledger.append_once(dated, path, book, "t", level, listed_files(rows))
    assert keys() == ["2", "3", "4"]
    assert ledger.loaded_files(spark, book, "t").count() == 3
    assert ledger.undo_unfinished(spark, path, book, "t", level) == 0


def test_json_tables_are_appended_once(spark, tmp_path):
    put(tmp_path / "raw/j", at(2), "a.json", '{"id": 1}\n', "utf-8")
    spec = TableSpec("j", ("j",), "unused", fmt="json")
    for _ in range(2):
        curated = load_table(spark, spec, str(tmp_path))
        assert spark.read.parquet(curated).count() == 1
    assert spark.read.parquet(f"{tmp_path}/standardised/json/j/schema=v1/partition=Latest").count() == 1


def test_older_files_below_a_mark_stay_unknown_to_the_ledger(spark, tmp_path):
    put(tmp_path / "raw/r", at(2), "a.csv", row(1))
    put(tmp_path / "raw/r", at(5), "b.csv", row(2))
    put(tmp_path / "raw/r", "year=2024", "stray.csv", row(9))
    load_table(spark, SPEC, str(tmp_path), [str(tmp_path / "raw/r")], after=dt.datetime(2024, 1, 3))
    assert stored(spark, tmp_path) == ["2"]
    load_table(spark, SPEC, str(tmp_path), [str(tmp_path / "raw/r")], timed=True)
    assert stored(spark, tmp_path) == ["1", "2"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_scan_and_inventory_stop_at_one_instant(spark, tmp_path, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    put(tmp_path / "r", at(2), "a.csv", row(1))
    instant = this_instant()
    put(tmp_path / "r", at(2), "b.csv", row(2))
    put(tmp_path / "r", at(2), "c.csv", row(3))
    stamp = instant.replace(tzinfo=dt.timezone.utc).timestamp()
    os.utime(tmp_path / "r" / at(2) / "a.csv", (stamp - 1, stamp - 1))
    os.utime(tmp_path / "r" / at(2) / "b.csv", (stamp + 1, stamp + 1))
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        rows = read_raw(spark, str(tmp_path / "r"), before=instant)
        assert [r["k"] for r in rows.collect()] == ["1"]
        assert [r["fileName"] for r in file_inventory(spark, str(tmp_path / "r"), before=instant).collect()] == ["a"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_a_load_joins_nothing_with_its_inventory(spark, tmp_path, monkeypatch):
    put(tmp_path / "raw/o1", at(2), "a.csv", "k,v,Partitionkey\n1,a,202401\n")
    plans = []

    def keep(df, *args, **options):
        plans.append(df._jdf.queryExecution().analyzed().toString())

    monkeypatch.setattr(load, "append_once", keep)
    load_dataset(spark, str(tmp_path), *dataset(spark), "shop")
    assert len(plans) == 1 and "Join" not in plans[0] and "RLIKE" in plans[0]


def test_batches_hold_at_most_the_bound_or_one_file(spark):
    rng = random.Random(6)
    rows = [
        (rng.choice(["a", "b", None]), f"f{i}", rng.choice([0, None, 1, 30, 99, 100, 101, 450]), dt.datetime(2024, 1, rng.randint(1, 9)))
        for i in range(400)
    ]
    files = spark.createDataFrame(rows, "load string, filePath string, fileSize long, ingestionDate timestamp_ntz")
    for by in (["load"], []):
        got = size_batches(files, 100, by).collect()
        assert sorted(r["filePath"] for r in got) == sorted(r[1] for r in rows)
        groups = {}
        for r in got:
            groups.setdefault(r["load"] if by else "", {}).setdefault(r["batch"], []).append(r)
        for batches in groups.values():
            assert sorted(batches) == list(range(len(batches)))
            total = sum(r["fileSize"] or 1 for b in batches.values() for r in b)
            assert len(batches) <= 2 * (total // 100 + 1)
            last = None
            for k in sorted(batches):
                sizes = [r["fileSize"] or 0 for r in batches[k]]
                assert sum(sizes) <= 100 or len(sizes) == 1
                assert last is None or last <= min(r["ingestionDate"] for r in batches[k])
                last = max(r["ingestionDate"] for r in batches[k])
    assert size_batches(files.limit(0), 100, ["load"]).count() == 0
    with pytest.raises(ValueError):
        size_batches(files, 0)


def test_batched_load_equals_a_whole_one(spark, tmp_path):
    put(tmp_path / "raw/o1", at(2), "a (1)%.csv", "k,v,Partitionkey\n1,a,202401\n2,a,202312\n")
    put(tmp_path / "raw/o1", at(3), "b.csv", "k,v,Partitionkey\n1,b,202401\n")
    put(tmp_path / "raw/o2", at(4), "c é.csv", "k,v,Partitionkey\n1,c,202401\n")
    put(tmp_path / "raw/n", at(4), "n.json", '{"id": 1}\n{"id": 2}\n', "utf-8")
    loads = []
    for limit in (None, 1, 200):
        lake = str(tmp_path / f"lake{limit}")
        datasets, tables, columns = dataset(spark)
        tables = tables.withColumn("DataLakePathRaw", F.concat(F.lit(f"{tmp_path}/raw/"), "DataLakePathRaw"))
        load_dataset(spark, lake, datasets, tables, columns, "shop", options=LoadOptions(batch_bytes=limit))
        rows = spark.read.parquet(f"{lake}/curated/Orders").select("k", "v", "Year", "Month")
        both = spark.read.parquet(f"{lake}/standardised/orders").select("k", "v")
        loads.append((sorted(map(tuple, rows.collect())), sorted(map(tuple, both.collect()))))
    assert loads[0][0] == [("1", "c", 2024, 1), ("2", "a", 2023, 12)]
    assert loads[0] == loads[1] == loads[2]
    assert literal_path("/a{b}*[c]?\\d") == "/a\\{b\\}\\*\\[c\\]\\?\\\\d"


def test_failing_table_leaves_the_others_appended_once(spark, tmp_path, monkeypatch):
    put(tmp_path / "raw/o1", at(2), "a.csv", "k,v,Partitionkey\n1,a,202401\n")
    put(tmp_path / "raw/n", at(2), "n.json", '{"id": 1}\n', "utf-8")
    with monkeypatch.context() as patch:
        patch.setattr(load, "write_json_latest", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load_dataset(spark, str(tmp_path), *dataset(spark), "shop", parallel=2)
    summary = json.loads(load_dataset(spark, str(tmp_path), *dataset(spark), "shop"))
    assert summary["max_ingestion_date"] == "02 January 2024 00:00:00"
    assert stored(spark, tmp_path, "orders") == ["1"]


def test_optional_columns_set_a_table(spark):
    rows = [(*table_row("t", "r"), ";", None, "[a], [b]", "true", None, "0")]
    tables = spark.createDataFrame(
        rows, TABLE_CONFIG + ", Separator string, Encoding string, HtmlColumnList string, FormAnswers string, "
        "CoarsenKey string, SanitiseNames string",
    )
    (spec,) = load_specs(tables, spark.createDataFrame([], COLUMN_CONFIG), "shop")
    assert (spec.sep, spec.encoding, spec.html, spec.answers) == (";", None, ("a", "b"), True)
    assert (spec.coarsen, spec.sanitise) == (None, False)


def test_json_tables_load_by_configuration_alone(spark, tmp_path, monkeypatch):
    datasets, tables, columns = dataset(spark)
    put(tmp_path / "raw/extra", at(2), "e.json", '{"id": 7}\n', "utf-8")
    roots = spark.createDataFrame([(str(tmp_path),)], "DataLakeRootFolder string")
    extra = spark.createDataFrame(
        [("shop", "extras", "extra"), ("shop", None, "x"), ("other", "o", "extra")],
        "DatasetName string, JsonTableName string, DataLakePathRaw string",
    )
    assert [s.name for s in json_specs(extra, "shop")] == ["extras"]
    sent = []
    monkeypatch.setattr(load, "copy_to_jdbc", lambda spark, path, url, table, **rest: sent.append((path, url, table)))
    options = LoadOptions(copies={"Organisation/Users": "[ext].[users]"}, export_url="jdbc:x")
    load_configured(spark, DatasetConfig(roots, datasets, tables, columns, extra), "shop", options=options)
    assert spark.read.parquet(f"{tmp_path}/curated/json/extras/schema=v1/partition=Latest").first()["id"] == "7"
    assert sent == [(f"{tmp_path}/curated/Organisation/Users", "jdbc:x", "[ext].[users]")]
    with pytest.raises(ValueError, match="export_url"):
        load_configured(spark, DatasetConfig(roots, datasets, tables, columns, extra), "shop", options=LoadOptions(copies={"a": "b"}))


def test_batches_share_one_ledger_entry_and_one_merge(spark, tmp_path, monkeypatch):
    # On a tie the later batch wins, though its value is the smaller one; "z" and "y" share a batch.
    put(tmp_path / "raw/o1", at(2), "a.csv", "k,v,Partitionkey\n1,x,202401\n")
    put(tmp_path / "raw/o1", at(2), "b.csv", "k,v,Partitionkey\n1,b,202401\n2,y,202401\n2,z,202401\n")
    put(tmp_path / "raw/o1", at(1), "c %2B+é.csv", "k,v,Partitionkey\n3,c,202401\n")
    files = file_inventory(spark, str(tmp_path / "raw/o1")).select("filePath", "fileSize", "ingestionDate")
    order = {r["filePath"][-5:]: r["batch"] for r in size_batches(files, 1).collect()}
    later = max("a.csv", "b.csv", key=order.get)
    merges = []
    write = load.write_curated
    monkeypatch.setattr(load, "write_curated", lambda *a: (merges.append(a[2]), write(*a)))
    datasets, tables, columns = dataset(spark)
    tables = tables.withColumn("DataLakePathRaw", F.concat(F.lit(f"{tmp_path}/raw/"), "DataLakePathRaw"))
    for _ in range(2):
        load_dataset(spark, str(tmp_path), datasets, tables, columns, "shop", options=LoadOptions(batch_bytes=1))
        rows = spark.read.parquet(f"{tmp_path}/curated/Orders").collect()
        assert sorted((r["k"], r["v"]) for r in rows) == [("1", {"a.csv": "x", "b.csv": "b"}[later]), ("2", "z"), ("3", "c")]
        assert "__from_delta" not in rows[0] and stored(spark, tmp_path, "orders") == ["1", "1", "2", "2", "3"]
    states = [r["state"] for r in ledger.entries(spark, f"{tmp_path}/ledger", "orders").collect()]
    assert len(merges) == 2 and states.count(ledger.BEGUN) == 3 and states.count(ledger.DONE) == 1
