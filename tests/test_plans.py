"""Configuration, whole loads and the stream."""

import dataclasses
import datetime as dt
import json

import pytest

from siltbed import (
    TableSpec,
    column_defaults,
    config_rows,
    dataset_header,
    files_to_tables,
    load_configured,
    load_dataset,
    load_groups,
    load_specs,
    load_table,
    ordered_columns,
    read_config,
    stream_upsert,
    table_catalog,
)
from siltbed.plans import load
from siltbed.plans.catalog import GROUP_COLUMNS, DatasetConfig
from siltbed.plans.load import LoadOptions, raw_roots

COLUMN_CONFIG = "DatasetName string, CuratedTableName string, ColumnId int, ColumnName string, ReplaceMissingWith string"
TABLE_CONFIG = ", ".join(f"{c} string" for c in ("DatasetName", "DataLakePathRaw", *GROUP_COLUMNS))
DATASET_CONFIG = "DatasetName string, MaxIngestionDateTime timestamp_ntz, FlatFileExtension string, SchemaName string"


def put(root, folder, name, text, encoding="utf-16"):
    path = root / folder
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_bytes(text.encode(encoding))


def at(day, hour=0):
    return f"year=2024/month=01/day={day:02}/hour={hour:02}/minute=00"


def table_row(name, raw, method="read_csv", path="c", keys="[k]", db="Lake", role="Full", scheme="Latest"):
    return ("shop", raw, name, method, path, "ext_shop", name, keys, db, role, scheme)


def column_rows(name, *columns, **defaults):
    return [("shop", name, i, c, defaults.get(c)) for i, c in enumerate(columns)]


def test_column_config_edges(spark):
    columns = spark.createDataFrame(
        [
            ("d", "t", 3, "b", "late"),
            ("d", "t", 1, "b", "early"),
            ("d", "t", 2, "a", None),
            ("d", "u", 1, "x", "first"),
            ("d", "u", 2, "x", None),
            ("d", None, 1, "n", None),
        ],
        COLUMN_CONFIG,
    )
    names = {r[0]: r[1] for r in ordered_columns(columns).collect()}
    assert names == {"t": ["b", "a"], "u": ["x"]}
    defaults = {r[0]: r[1] for r in column_defaults(columns).collect()}
    assert defaults == {"t": {"b": "late", "a": None}, "u": {"x": None}}


def test_specs_join_raw_paths_and_skip_incomplete_rows(spark):
    tables = spark.createDataFrame(
        [
            table_row("t", "r2", scheme="YYYYMM"),
            table_row("t", "r1", scheme="YYYYMM"),
            table_row("u", "r3", "read_json_x", keys=""),
            table_row("v", "r4", role=None),
        ],
        TABLE_CONFIG,
    )
    columns = spark.createDataFrame(column_rows("t", "k", "note", note="n"), COLUMN_CONFIG)
    first, second = load_specs(tables, columns, "shop")
    assert (first.name, first.raw_paths, first.fmt) == ("t", ("r1", "r2"), "csv")
    assert (first.keys, first.columns) == (("k", "PartitionKey"), ("k", "note"))
    assert first.defaults == {"k": None, "note": "n"}
    assert (second.name, second.fmt, second.keys, second.columns) == ("u", "json", (), ())
    assert [s.name for s in load_specs(tables, columns, "shop", "u")] == ["u"]
    assert load_specs(tables, columns, "other") == []
    assert raw_roots(first, "/lake") == ["/lake/raw/r1", "/lake/raw/r2"]


def test_files_meet_their_tables(spark):
    tables = spark.createDataFrame([table_row("t", "r1"), table_row("u", "r1"), table_row("v", "r9")], TABLE_CONFIG)
    day = dt.datetime(2024, 1, 1)
    files = spark.createDataFrame(
        [("r1", "f1", day, day), ("r1", "f2", day, day), ("r2", "f3", day, day)],
        "DataLakePathRaw string, filePath string, ingestionDate timestamp_ntz, extractDate timestamp_ntz",
    )
    groups = load_groups(files_to_tables(files, tables)).collect()
    assert sorted((r["CuratedTableName"], r["files"]) for r in groups) == [("t", 2), ("u", 2)]


def test_config_rows_and_header(spark):
    tables = spark.createDataFrame([table_row("t", "r"), table_row("u", "r", "read_json")], TABLE_CONFIG)
    assert config_rows(tables, "shop").count() == 2
    assert config_rows(tables, "shop", "").count() == 2
    assert config_rows(tables, "shop", "t").count() == 1
    assert config_rows(tables, "shop", skip_method="read_json").count() == 1
    datasets = spark.createDataFrame([("shop", None, "csv", "s")], DATASET_CONFIG)
    assert tuple(dataset_header(datasets, "shop").first()) == (dt.datetime(1900, 1, 1), "ext_s", "csv")


def test_read_config(spark, tmp_path):
    frames = {
        "Configuration": spark.createDataFrame([("root",)], "DataLakeRootFolder string"),
        "Dataset": spark.createDataFrame([("shop", None, "csv", "s"), ("x", None, "csv", "s")], DATASET_CONFIG),
        "CuratedTable": spark.createDataFrame([table_row("t", "r"), table_row("u", "r")], TABLE_CONFIG),
        "CuratedColumn": spark.createDataFrame([*column_rows("t", "k"), *column_rows("u", "k")], COLUMN_CONFIG),
        "JsonTable": spark.createDataFrame([("shop", "j"), ("x", "j")], "DatasetName string, JsonName string"),
    }
    for name, frame in frames.items():
        frame.write.parquet(str(tmp_path / name))
    config = read_config(lambda name: spark.read.parquet(str(tmp_path / name)), "shop", "t")
    assert config.roots.first()[0] == "root"
    for frame in (config.datasets, config.tables, config.columns, config.json_tables):
        assert frame.count() == 1
    assert read_config(frames.__getitem__, "shop").tables.count() == 2


def test_catalog_skips_inactive_queries(spark):
    datasets = spark.createDataFrame([(1, "shop", "d/"), (2, "x", "e/")], "DatasetKey int, DatasetName string, DataLakePathRaw string")
    tables = spark.createDataFrame([(1, 7, "t", "c/", 2)], "DatasetKey int, TableKey int, TableName string, DataLakePathCurated string, SchemaVersion int")
    queries = spark.createDataFrame(
        [(7, "q/", "read_csv", "YYYY", 1), (7, "z/", "read_csv", "YYYY", 0)],
        "TableKey int, DataLakePathRaw string, ReadRawFileMethod string, DataLakePartitionCurated string, IsActive int",
    )
    row = table_catalog(datasets, tables, queries, "shop").collect()
    assert [tuple(r) for r in row] == [
        ("t", "d/q/schema=v2/partition=YYYY/", "c/schema=v2/partition=YYYY/", "read_csv", "YYYY")
    ]
    assert table_catalog(datasets, tables, queries, "x").isEmpty()


def test_table_steps_follow_the_name():
    assert TableSpec("fact_cost", (), "c").coarse_key
    assert TableSpec("dim_matter_udfs", (), "c").sanitised
    answers = TableSpec("formanswers", (), "c")
    assert answers.form_answers and answers.html_columns == ("AnswerValue", "AnswerDisplayValue")
    assert not TableSpec("t", (), "c").html_columns


def test_load_form_answers(spark, tmp_path):
    put(
        tmp_path / "raw/answers",
        at(2),
        "a.csv",
        "QuestionName,AnswerValue,AnswerSearchValue,AnswerDisplayValue\n"
        "H_BillingFE,<b>Ann Lee 42</b>,null,&nbsp;Ann\n",
    )
    columns = ("QuestionName", "AnswerValue", "AnswerSearchValue", "AnswerDisplayValue")
    spec = TableSpec("formanswers", ("answers",), "Answers", keys=("QuestionName",), columns=columns)
    curated = load_table(spark, spec, str(tmp_path))
    row = spark.read.parquet(curated).first()
    assert (row["AnswerValue"], row["AnswerDisplayValue"]) == ("Ann Lee 42", "Ann")
    assert row["AnswerIntegerValue"] == "42"
    assert row["ingestionDateTime"] == "2024-01-02 00:00:00"
    standardised = spark.read.parquet(str(tmp_path / "standardised/formanswers")).first()
    assert standardised["AnswerValue"] == "<b>Ann Lee 42</b>"
    assert (standardised["Year"], standardised["Month"]) == (2024, 1)


def test_load_sanitised_table_and_case_variants(spark, tmp_path):
    put(tmp_path / "raw/m", at(2), "a.csv", "Matter Id.,NAME\n1,x\n")
    spec = TableSpec("dim_matter_udfs", ("m",), "M", keys=("Matter_Id",), columns=("Matter_Id", "Name", "note"), defaults={"Name": "?", "note": None})
    row = spark.read.parquet(load_table(spark, spec, str(tmp_path), options=LoadOptions(storage=None))).first()
    assert (row["Matter_Id"], row["Name"], row["note"]) == ("1", "x", None)


def test_load_json_reads_configured_fields_as_text(spark, tmp_path):
    put(tmp_path / "raw/j", at(2), "j.json", '{"id": 1, "o": {"a": 2}, "extra": 3}\n', "utf-8")
    for columns, fields in (((), {"id", "o", "extra"}), (("id", "o"), {"id", "o"})):
        spec = TableSpec("j", ("j",), "unused", fmt="json", columns=columns)
        stored = spark.read.parquet(load_table(spark, spec, str(tmp_path)))
        assert set(stored.columns) == {"path", "ingestionDateTime", "extractDateTime", *fields}
        assert dict(stored.dtypes)["id"] == "string"
    assert stored.first()["o"] == '{"a": 2}'


def test_load_without_new_files_writes_nothing(spark, tmp_path):
    spec = TableSpec("t", ("r",), "C")
    assert load_table(spark, spec, str(tmp_path)) == f"{tmp_path}/curated/C"
    assert not (tmp_path / "curated").exists()


def test_export_needs_a_url_before_anything_is_written(spark, tmp_path):
    put(tmp_path / "raw/r", at(2), "a.csv", "k\n1\n")
    spec = TableSpec("t", ("r",), "C", keys=("k",), destination="ConfigDB")
    with pytest.raises(ValueError, match="export_url"):
        load_table(spark, spec, str(tmp_path))
    assert not (tmp_path / "standardised").exists()


def test_export_writes_latest_rows(spark, tmp_path, monkeypatch):
    put(tmp_path / "raw/r", at(2), "a.csv", "k,v\n1,a\n")
    put(tmp_path / "raw/r", at(3), "a.csv", "k,v\n1,b\n")
    sent = []
    monkeypatch.setattr(
        "siltbed.plans.load.write_jdbc",
        lambda df, url, table, **rest: sent.append((url, table, [r["v"] for r in df.collect()], rest)),
    )
    spec = TableSpec("t", ("r",), "C", keys=("k",), destination="ConfigDB", external_schema="s", external_table="t")
    bounds = {"properties": {}, "truncate": True, "num_partitions": 3, "batch_size": 50}
    options = LoadOptions(
        export_url="jdbc:x", export_partitions=3, export_batch_size=50, export_truncate=True
    )
    load_table(spark, spec, str(tmp_path), options=options)
    dated = dataclasses.replace(spec, scheme="YYYYMM", curated_path="D", keys=("k",))
    put(tmp_path / "raw/r", at(4), "a.csv", "k,v,PartitionKey\n1,c,202401\n")
    load_table(spark, dated, str(tmp_path), [str(tmp_path / "raw/r" / at(4))], options=options)
    assert sent == [("jdbc:x", "s.t", ["b"], bounds), ("jdbc:x", "s.t", ["c"], bounds)]


def test_json_tables_are_exported(spark, tmp_path, monkeypatch):
    put(tmp_path / "raw/j", at(2), "j.json", '{"id": 1}\n', "utf-8")
    sent = []
    monkeypatch.setattr(
        "siltbed.plans.load.write_jdbc", lambda df, url, table, **rest: sent.append([r["id"] for r in df.collect()])
    )
    spec = TableSpec("j", ("j",), "unused", fmt="json", destination="ConfigDB", external_schema="s", external_table="j")
    load_table(spark, spec, str(tmp_path), options=LoadOptions(export_url="jdbc:x"))
    assert sent == [["1"]]


@pytest.mark.parametrize("mark", [dt.datetime(2023, 6, 1), dt.datetime(2024, 1, 1)])
def test_files_without_a_time_stay_out_wherever_the_mark_is(spark, tmp_path, mark):
    put(tmp_path / "raw/r", at(2), "a.csv", "k\n1\n")
    put(tmp_path / "raw/r", "year=2024", "stray.csv", "k\n9\n")
    spec = TableSpec("t", ("r",), "C", keys=("k",))
    stored = spark.read.parquet(load_table(spark, spec, str(tmp_path), after=mark))
    assert [r["k"] for r in stored.collect()] == ["1"]


@pytest.mark.parametrize("mark", [dt.datetime(2023, 6, 1), dt.datetime(2024, 1, 1)])
def test_a_load_reads_the_files_of_its_inventory(spark, tmp_path, monkeypatch, mark):
    raw, lake = tmp_path / "raw", str(tmp_path)
    put(raw / "o1", at(2), "a.csv", "k,v,Partitionkey\n1,a,202401\n")
    put(raw / "o1", "year=2024", "stray.csv", "k,v,Partitionkey\n8,a,202401\n")
    real = load.load_table

    def late(*args, **options):
        put(raw / "o1", at(9), "late.csv", "k,v,Partitionkey\n9,a,202401\n")
        return real(*args, **options)

    monkeypatch.setattr(load, "load_table", late)
    summary = json.loads(load_dataset(spark, lake, *dataset(spark, mark), "shop"))
    assert summary["max_ingestion_date"] == "02 January 2024 00:00:00"
    assert [r["k"] for r in spark.read.parquet(f"{lake}/curated/Orders").collect()] == ["1"]
    load_dataset(spark, lake, *dataset(spark, dt.datetime(2024, 1, 2, 1)), "shop")
    standardised = spark.read.parquet(f"{lake}/standardised/orders")
    assert sorted(r["k"] for r in standardised.collect()) == ["1", "9"]


def test_load_by_configuration_alone(spark, tmp_path):
    datasets, tables, columns = dataset(spark)
    raw = tmp_path / "raw"
    put(raw / "o1", at(2), "a.csv", "k,v,Partitionkey\n1,a,202401\n")
    put(raw / "o1", at(2), "a.tmp", "k,v,Partitionkey\n2,a,202401\n")
    put(raw / "n", at(2), "n.json", '{"id": 1}\n', "utf-8")
    roots = spark.createDataFrame([(str(tmp_path),)], "DataLakeRootFolder string")
    config = DatasetConfig(roots, datasets, tables, columns, spark.createDataFrame([], "x int"))
    load_configured(spark, config, "shop")
    assert [r["k"] for r in spark.read.parquet(f"{tmp_path}/curated/Orders").collect()] == ["1"]
    assert spark.read.parquet(f"{tmp_path}/curated/json/notes/schema=v1/partition=Latest").count() == 1


def test_steps_and_text_options_of_a_table(spark, tmp_path):
    put(tmp_path / "raw/r", at(2), "a.csv", "k;h;PartitionKey\n1;<b>x</b>;20240105\n", "utf-8")
    spec = TableSpec(
        "own", ("r",), "C", keys=("k",), html=("h",), coarsen=True, sep=";", encoding="UTF-8",
    )
    row = spark.read.parquet(load_table(spark, spec, str(tmp_path))).first()
    assert (row["h"], row["PartitionKey"]) == ("x", "202401")


def dataset(spark, mark=None):
    datasets = spark.createDataFrame([("shop", mark, "csv", "shop")], DATASET_CONFIG)
    tables = spark.createDataFrame(
        [
            table_row("orders", "o1", path="Orders", keys="[k]", role="Recent", scheme="YYYYMM"),
            table_row("orders", "o2", path="Orders", keys="[k]", role="Recent", scheme="YYYYMM"),
            table_row("notes", "n", "read_json", path="unused"),
            table_row("idle", "i", path="Idle"),
        ],
        TABLE_CONFIG,
    )
    columns = spark.createDataFrame(column_rows("orders", "k", "v", "PartitionKey"), COLUMN_CONFIG)
    return datasets, tables, columns


def test_load_dataset_twice(spark, tmp_path):
    raw, lake = tmp_path / "raw", str(tmp_path)
    put(raw / "o1", at(2), "a_20240102-030405.csv", "k,v,Partitionkey\n1,a,202401\n2,a,202312\n")
    put(raw / "o2", at(3), "b.csv", "k,v,Partitionkey\n1,b,202401\n")
    put(raw / "n", at(2), "n.json", '{"id": 1}\n{"id": 2}\n', "utf-8")
    summary = json.loads(load_dataset(spark, lake, *dataset(spark), "shop", parallel=3))
    assert summary == {
        "max_extract_date": "03 January 2024 00:00:00",
        "max_ingestion_date": "03 January 2024 00:00:00",
    }
    orders = spark.read.parquet(f"{lake}/curated/Orders")
    assert sorted((r["k"], r["v"], r["Year"], r["Month"]) for r in orders.collect()) == [
        ("1", "b", 2024, 1),
        ("2", "a", 2023, 12),
    ]
    notes = spark.read.parquet(f"{lake}/curated/json/notes/schema=v1/partition=Latest")
    assert notes.columns == ["path", "ingestionDateTime", "extractDateTime", "id"]
    assert notes.count() == 2
    assert not (tmp_path / "curated/Idle").exists()

    put(raw / "o1", at(5), "c.csv", "k,v,Partitionkey\n2,c,202312\n")
    mark = dt.datetime(2024, 1, 3, 0, 30)
    load_dataset(spark, lake, *dataset(spark, mark), "shop")
    again = spark.read.parquet(f"{lake}/curated/Orders")
    assert sorted((r["k"], r["v"]) for r in again.collect()) == [("1", "b"), ("2", "c")]
    assert spark.read.parquet(f"{lake}/standardised/orders").count() == 4


def test_load_dataset_without_files(spark, tmp_path):
    summary = json.loads(load_dataset(spark, str(tmp_path), *dataset(spark), "shop"))
    assert summary["max_ingestion_date"].endswith(tuple("0123456789"))
    assert not (tmp_path / "curated").exists()
    with pytest.raises(ValueError, match="no dataset"):
        load_dataset(spark, str(tmp_path), *dataset(spark), "unknown")


@pytest.mark.parametrize("cols", [("Part",), ()])
def test_stream_takes_each_file_once(spark, tmp_path, cols):
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))

    def run():
        stream_upsert(spark, source, "k string, Part string", target, ["k"], marks, cols, max_files=1).awaitTermination()
        rows = spark.read.schema("k string, Part string, ingestionDateTime string").parquet(target)
        return sorted(tuple(r) for r in rows.select("k", "Part", "ingestionDateTime").collect())

    put(tmp_path / "in", at(2), "a.csv", "k,Part\n1,x\n")
    put(tmp_path / "in", at(3), "b.csv", "k,Part\n1,x\n2,007\n")
    expected = [("1", "x", "2024-01-03 00:00:00"), ("2", "007", "2024-01-03 00:00:00")]
    assert run() == expected
    assert run() == expected
    put(tmp_path / "in", at(1), "late.csv", "k,Part\n3,x\n1,x\n")
    assert run() == [*expected, ("3", "x", "2024-01-01 00:00:00")]
