"""Columns, latest rows, partitions and merges on small frames."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from siltbed import (
    add_missing_columns,
    calendar_columns,
    cast_by_type_map,
    conform,
    date_hierarchy,
    format_metadata,
    latest_files,
    latest_rows,
    null_typed_to,
    partition_changes,
    project_columns,
    rename_columns,
    rows_of_latest_file,
    run_summary,
    sanitise_columns,
    touched_partitions,
    union_delta,
)

T1, T2, T3 = (dt.datetime(2024, 1, day) for day in (1, 2, 3))


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=str)


def test_rename_follows_the_mapping_in_order(spark):
    df = spark.createDataFrame([(1, 2)], "a int, x int")
    assert rename_columns(df, {"a": "b", "b": "c", "none": "z"}).columns == ["c", "x"]
    with pytest.raises(ValueError):
        rename_columns(df, ["a", "b"])


def test_sanitise_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF(
        " My Col. ", "x/y?(z)-w_", "a`b"
    )
    assert sanitise_columns(df).columns == ["My_Col", "x/y?(z)-w_", "ab"]
    with pytest.raises(ValueError, match="collide"):
        sanitise_columns(spark.createDataFrame([(1, 2)], "a int, b int").toDF("a.b", "ab"))


def test_sanitise_with_metadata_last(spark):
    df = spark.createDataFrame([("p", 1, 2)], "a string, b int, c int").toDF("path", "r/r.", "d d")
    assert sanitise_columns(df, metadata_last=True).columns == ["rr", "d_d", "path"]


def test_missing_columns_compare_without_case(spark):
    df = spark.createDataFrame([(1,)], "Name int")
    filled = add_missing_columns(df, {"name": 5, "note": "n", "empty": None})
    assert filled.columns == ["name", "note", "empty"]
    assert filled.first()[:2] == (1, "n")
    assert dict(null_typed_to(filled).dtypes)["empty"] == "double"


def test_conform_keeps_metadata_and_drops_the_rest(spark):
    df = spark.createDataFrame([("p", 1, 2)], "path string, b int, extra int")
    shaped = conform(df, ["a", "b", "b"], {"a": None})
    assert shaped.dtypes == [("a", "double"), ("b", "int"), ("path", "string")]
    assert project_columns(df, ["b"], keep_metadata=False).columns == ["b"]


def test_format_metadata_is_stable(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 2, 3, 4, 45, 670000),)], "ingestionDateTime timestamp_ntz"
    )
    once = format_metadata(df)
    assert once.first()[0] == "2024-01-02 03:04:45"
    assert format_metadata(once).first()[0] == "2024-01-02 03:04:45"


def test_cast_by_type_map(spark):
    df = spark.createDataFrame(
        [(T1, 1, 2, 1.5, True)], "t timestamp_ntz, l bigint, i int, d double, b boolean"
    )
    assert [t for _, t in cast_by_type_map(df).dtypes] == ["date", "bigint", "int", "float", "string"]
    assert dict(cast_by_type_map(df, {"double": "double"}).dtypes)["d"] == "double"


ROWS = "k string, v int, path string, ingestionDateTime timestamp_ntz, extractDateTime timestamp_ntz"


def test_latest_rows_per_key(spark):
    df = spark.createDataFrame(
        [
            ("a", 1, "p1", T1, T1),
            ("a", 2, "p2", T2, T1),
            ("a", 3, "p3", T2, T2),
            (None, 4, "p", T1, T1),
            (None, 5, "p", T2, T1),
            ("b", 6, "p", None, T1),
        ],
        ROWS,
    )
    assert values(latest_rows(df, ["k"]), "k", "v") == [("a", 3), ("b", 6), (None, 5)]
    assert latest_rows(df, ["k"], ["v"]).count() == 6


def test_latest_rows_break_ties_the_same_way(spark):
    df = spark.createDataFrame([("a", v, "p", T1, T1) for v in range(20)], ROWS)
    assert values(latest_rows(df.repartition(7), ["k"]), "v") == [(19,)]
    assert values(latest_rows(df.coalesce(1), ["k"]), "v") == [(19,)]


def test_latest_rows_without_keys(spark):
    df = spark.createDataFrame(
        [("a", 1, "p1", T1, T1), ("a", 1, "p2", T2, T1), ("a", 2, "p3", T1, T1)], ROWS
    )
    assert values(latest_rows(df), "path") == [("p2",), ("p3",)]
    with pytest.raises(ValueError, match="no key columns"):
        latest_rows(df.select("path", "ingestionDateTime", "extractDateTime"))


def test_latest_rows_with_a_map_column(spark):
    df = spark.createDataFrame([("a", {"x": 1}, 1), ("a", {"x": 2}, 2)], "k string, m map<string,int>, o int")
    assert latest_rows(df, ["k"], order=["o"]).first()["m"] == {"x": 2}


FILES = "partitionKey string, v int, path string, ingestionDateTime timestamp_ntz, extractDateTime timestamp_ntz"


def test_latest_files_skip_null_partitions_and_times(spark):
    df = spark.createDataFrame(
        [
            ("x", 1, "p", T1, T3),
            ("x", 2, "p", T2, T1),
            ("x", 3, "p", T2, T2),
            ("y", 4, "p", None, T3),
            (None, 5, "p", T1, T1),
        ],
        FILES,
    )
    assert values(latest_files(df, "partitionKey")) == [("x", T2, T2)]
    newest = rows_of_latest_file(df)
    assert values(newest, "v") == [(3,)]
    assert newest.columns[-3:] == ["path", "ingestionDateTime", "extractDateTime"]


def test_rows_of_latest_file_above_the_broadcast_limit(spark):
    df = spark.createDataFrame([("x", 1, "p", T1, T1), ("x", 2, "q", T2, T1)], FILES)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        newest = rows_of_latest_file(df)
        assert values(newest, "v") == [(2,)]
        assert "Broadcast" not in newest._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_partition_changes(spark):
    df = spark.createDataFrame(
        [(2024, 1, "b", T1, T2), (2024, 1, "a", T2, T1), (None, 2, "c", T1, T1)],
        "Year int, Month int, path string, ingestionDateTime timestamp_ntz, extractDateTime timestamp_ntz",
    )
    assert values(partition_changes(df, ["Year", "Month"], "t")) == [
        ("a", T2, T2, "t", "Year=2024/Month=1"),
        ("c", T1, T1, "t", "Year=__HIVE_DEFAULT_PARTITION__/Month=2"),
    ]


def test_run_summary(spark):
    schema = "ingestionDateTime timestamp_ntz, extractDateTime timestamp_ntz"
    df = spark.createDataFrame([(T1, T3), (T2, T2)], schema)
    assert json.loads(run_summary(df).first()[0]) == {
        "max_extract_date": "03 January 2024 00:00:00",
        "max_ingestion_date": "02 January 2024 00:00:00",
    }
    now = json.loads(run_summary(spark.createDataFrame([], schema)).first()[0])
    age = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.datetime.strptime(
        now["max_ingestion_date"], "%d %B %Y %H:%M:%S"
    )
    assert abs(age) < dt.timedelta(minutes=5)


@pytest.mark.parametrize(
    ("key", "scheme", "expected"),
    [
        ("20240105", "YYYYMMDD", (dt.date(2024, 1, 5), "2024", "1", "5")),
        ("202413", "YYYYMM", (None, None, None)),
        ("202412", "YYYYMM", (dt.date(2024, 12, 1), "2024", "12")),
        ("2024", "YYYY", (dt.date(2024, 1, 1), "2024")),
        ("abc", "YYYY", (None, None)),
        (None, "YYYY", (None, None)),
    ],
)
def test_calendar_columns(spark, key, scheme, expected):
    df = spark.createDataFrame([(key,)], "PartitionKey string")
    assert tuple(calendar_columns(df, scheme=scheme).first())[1:] == expected


def test_unknown_scheme_and_level(spark):
    df = spark.createDataFrame([(T1, "2024")], "ingestionDateTime timestamp_ntz, PartitionKey string")
    with pytest.raises(ValueError):
        calendar_columns(df, scheme="YYYYWW")
    with pytest.raises(KeyError):
        date_hierarchy(df, "Day")
    assert date_hierarchy(df, "Week").columns[-3:] == ["Year", "Month", "Week"]


def test_touched_partitions_match_nulls_too(spark):
    current = spark.createDataFrame(
        [(1, 2024, "a"), (2, 2024, None), (3, 2023, "a"), (4, None, None), (5, None, "a")],
        "v int, y int, p string",
    )
    delta = spark.createDataFrame(
        [("2024", "a"), ("2024", "a"), ("2024", None), (None, None)], "y string, p string"
    )
    assert values(touched_partitions(current, delta, ["y", "p"]), "v") == [(1,), (2,), (4,)]
    assert values(touched_partitions(current, delta, ["y"]), "v") == [(1,), (2,), (4,), (5,)]
    assert touched_partitions(current, delta.limit(0), ["y"]).count() == 0


def test_union_delta(spark):
    current = spark.createDataFrame([(1, "a")], "v bigint, p string")
    delta = spark.createDataFrame([("b", 2, 9)], "p string, v int, extra int")
    both = union_delta(current, delta)
    assert both.dtypes == [("v", "bigint"), ("p", "string")]
    assert values(both) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="lacks"):
        union_delta(current, delta.drop("v"))
    assert both.filter(F.col("v").isNull()).isEmpty()
