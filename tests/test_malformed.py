"""Malformed rows, files with their own headers, counts taken while writing, repeated files."""

import json

import pytest
from pyspark.sql import functions as F

from siltbed import TableSpec, load_dataset, load_table, stream_upsert
from siltbed.operators.counts import RowCounts
from siltbed.plans.load import LoadOptions
from siltbed.sources.malformed import files_by_header, read_by_header, read_permissive, split_malformed
from test_plans import at, dataset, put


def test_csv_rows_that_do_not_fit_are_set_aside(spark, tmp_path):
    text = 'k,v\n1,a\n2\n3,c,extra\n"4","two\nlines"\n5,\n'
    put(tmp_path, at(2), "a.csv", text)
    rows = read_permissive(spark, str(tmp_path)).persist()
    good, bad = split_malformed(rows)
    assert sorted((r["k"], r["v"]) for r in good.collect()) == [("1", "a"), ("4", "two\nlines"), ("5", None)]
    assert sorted(r["text"].strip() for r in bad.collect()) == ["2", "3,c,extra"]
    assert good.select("k").count() + bad.count() == 5 and bad.columns == ["path", "text"]
    assert "FileScan" in good._jdf.queryExecution().executedPlan().toString()
    typed = read_permissive(spark, str(tmp_path), schema="k int, v int").persist()
    assert typed.filter("__malformed is not null").select("__malformed", "k").count() == 4
    with pytest.raises(ValueError):
        read_permissive(spark, str(tmp_path), "parquet")


def test_json_lines_without_a_schema(spark, tmp_path):
    put(tmp_path, at(2), "a.json", '{"k": 1, "v": "x"}\n{"k": 2\n\n[3 4]\n{"v": null}\n', "utf-8")
    good, bad = split_malformed(read_permissive(spark, str(tmp_path), "json").persist())
    assert sorted(map(repr, good.select("k", "v").collect())) == ["Row(k='1', v='x')", "Row(k=None, v=None)"]
    assert sorted(r["text"] for r in bad.collect()) == ['[3 4]', '{"k": 2']


def test_a_load_sets_malformed_rows_aside_once(spark, tmp_path):
    put(tmp_path / "raw/r", at(2), "a.csv", "k,PartitionKey\n1,202401\n2,202401,9\n")
    put(tmp_path / "raw/j", at(2), "a.json", '{"id": 1}\n{"id"\n', "utf-8")
    options = LoadOptions(quarantine=True)
    for spec in (
        TableSpec("t", ("r",), "C", scheme="YYYYMM", role="Recent", keys=("k",), columns=("k", "PartitionKey")),
        TableSpec("j", ("j",), "unused", fmt="json", columns=("id",)),
    ):
        for _ in range(2):
            counts = RowCounts()
            curated = load_table(spark, spec, str(tmp_path), options=options, counts=counts)
            assert spark.read.parquet(curated).count() == 1
            assert counts.totals()[spec.name]["read"] == 2
        bad = spark.read.parquet(f"{tmp_path}/quarantine/{spec.name}").collect()
        assert [r["text"].strip() for r in bad] == [{"t": "2,202401,9", "j": '{"id"'}[spec.name]]


def test_headers_in_any_order_with_columns_missing(spark, tmp_path):
    put(tmp_path, at(2), "a b.csv", "k,v\n1,a\n")
    put(tmp_path, at(3), "b.csv", '"v","k"\n"b, c",2\n')
    put(tmp_path, at(4), "c.csv", "k,w\n3,x\n")
    put(tmp_path, at(5), "d.csv", "k,v\n4,d\n")
    rows = read_by_header(spark, str(tmp_path))
    got = sorted((r["k"], r["v"], r["w"], r["path"].rsplit("/", 1)[1]) for r in rows.collect())
    assert got == [
        ("1", "a", None, "a%20b.csv"), ("2", "b, c", None, "b.csv"), ("3", None, "x", "c.csv"), ("4", "d", None, "d.csv")
    ]
    assert len(rows.inputFiles()) == 4 and rows._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 3
    same = read_by_header(spark, [str(tmp_path / at(2)), str(tmp_path / at(5))])
    assert same._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


@pytest.mark.parametrize("encoding", ["utf-16", "utf-16-be", "utf-8", "utf-8-sig"])
def test_headers_in_any_encoding(spark, tmp_path, encoding):
    put(tmp_path, at(2), "a.csv", 'k|"ü\nx"\n1|a\n', encoding)
    name = {"utf-16-be": "UTF-16", "utf-8-sig": "UTF-8"}.get(encoding, encoding.upper())
    files = [str(p.as_uri()) for p in tmp_path.rglob("*.csv")]
    assert list(files_by_header(spark, files, name, "|")) == [("k", "ü\nx")]


def test_a_load_joins_headers_by_name(spark, tmp_path):
    put(tmp_path / "raw/r", at(2), "a.csv", "k,v,PartitionKey\n1,a,202401\n")
    put(tmp_path / "raw/r", at(3), "b.csv", "PartitionKey,v,k\n202401,b,2\n")
    spec = TableSpec("t", ("r",), "C", scheme="YYYYMM", role="Recent", keys=("k",), columns=("k", "v", "PartitionKey"))
    curated = load_table(spark, spec, str(tmp_path), options=LoadOptions(own_headers=True))
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(curated).collect()) == [("1", "a"), ("2", "b")]


@pytest.mark.parametrize("options", [LoadOptions(), LoadOptions(storage=None), LoadOptions(batch_bytes=1)])
def test_rows_are_counted_as_they_pass(spark, tmp_path, options):
    put(tmp_path / "raw/o1", at(2), "a.csv", "k,v,Partitionkey\n1,a,202401\n2,a,202312\n2,b,202312\n")
    put(tmp_path / "raw/o2", at(3), "b.csv", "k,v,Partitionkey\n5,b,202402\n")
    put(tmp_path / "raw/n", at(2), "n.json", '{"id": 1}\n{"id": 2}\n', "utf-8")
    summary = json.loads(load_dataset(spark, str(tmp_path), *dataset(spark), "shop", options=options, counted=True))
    assert summary["tables"] == {
        "orders": {"read": 4, "appended": 4, "written": 3},
        "notes": {"read": 2, "appended": 2, "written": 2},
    }
    assert summary["max_ingestion_date"] == "03 January 2024 00:00:00"


def test_counting_adds_no_scan(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    counts, table = RowCounts(), spark.read.parquet(str(tmp_path / "t"))
    watched = counts.watch(table, "t", "read")
    plan = watched._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan
    watched.filter(F.col("id") > 3).write.parquet(str(tmp_path / "out"))
    assert counts.totals() == {"t": {"read": 10}}


def test_upserts_by_file_in_a_load(spark, tmp_path):
    spec = TableSpec("t", ("r",), "C", scheme="YYYYMM", role="Recent", keys=("k",), by_file=True)
    put(tmp_path / "raw/r", at(2), "a.csv", "k,v,PartitionKey\n1,a,202401\n2,a,202401\n")
    load_table(spark, spec, str(tmp_path))
    put(tmp_path / "raw/r", at(3), "b.csv", "k,v,PartitionKey\n2,b,202401\n")
    curated = load_table(spark, spec, str(tmp_path), [str(tmp_path / "raw/r" / at(3))])
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(curated).collect()) == [("1", "a"), ("2", "b")]


def test_stream_drops_rows_that_come_again(spark, tmp_path):
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    seen = []

    def run():
        stream_upsert(
            spark, source, "k string, v string", target, ["k"], marks, max_files=1, repeated_within="10 days",
            append=lambda batch, number: seen.extend((r["k"], r["v"]) for r in batch.collect()),
        ).awaitTermination()
        return sorted(seen)

    put(tmp_path / "in", at(2), "a.csv", "k,v\n1,x\n")
    put(tmp_path / "in", at(2), "b.csv", "k,v\n1,y\n2,x\n")
    first = run()
    assert [k for k, _ in first] == ["1", "2"]
    put(tmp_path / "in", at(2), "c.csv", "k,v\n1,z\n2,z\n3,z\n")
    put(tmp_path / "in", at(3), "d.csv", "k,v\n1,w\n")
    assert run() == sorted([*first, ("3", "z"), ("1", "w")])
