"""Paths, keys and text."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltbed import (
    dates_from_path,
    form_answer_values,
    parse_key_list,
    plain_path,
    split_camel_case,
    strip_html,
)

FOLDER = "/r/year=2021/month=04/day=06/hour=03/minute=07/"


def one(df, column=0):
    return df.first()[column]


def dates(spark, path, **options):
    row = dates_from_path(spark.createDataFrame([(path,)], "path string"), **options).first()
    return row["ingestionDateTime"], row["extractDateTime"]


def test_dates_come_from_folder_and_stamp(spark):
    assert dates(spark, FOLDER + "x_20210406-030102.csv") == (
        dt.datetime(2021, 4, 6, 3, 7),
        dt.datetime(2021, 4, 6, 3, 1, 2),
    )


def test_extract_falls_back_to_ingestion(spark):
    ingested = dt.datetime(2021, 4, 6, 3, 7)
    assert dates(spark, FOLDER + "x.csv") == (ingested, ingested)
    assert dates(spark, FOLDER + "x_99999999-999999.csv") == (ingested, ingested)


@pytest.mark.parametrize("path", ["/r/x.csv", "202104060307", None, "/r/year=2021/month=4/x.csv"])
def test_unmatched_paths_have_no_dates(spark, path):
    assert dates(spark, path) == (None, None)


def test_stamp_without_folder_gives_only_extract(spark):
    assert dates(spark, "/r/x_20210406-030102.csv") == (None, dt.datetime(2021, 4, 6, 3, 1, 2))


def test_custom_patterns(spark):
    assert dates(
        spark,
        "/r/year=2021/month=04/e=06_04_2021",
        ingestion_regex=r"year=(\d{4})/month=(\d{2})",
        extract_regex=r"e=(\d{2}_\d{2}_\d{4})",
        extract_format="dd_MM_yyyy",
    ) == (dt.datetime(2021, 4, 1), dt.datetime(2021, 4, 6))


def test_dates_ignore_the_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    try:
        # 01:30 does not exist in London on that day.
        path = "/r/year=2024/month=03/day=31/hour=01/minute=30/x_20240331-013000.csv"
        assert dates(spark, path) == (dt.datetime(2024, 3, 31, 1, 30),) * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_plain_path(spark):
    df = spark.createDataFrame([("file:///a/y%20f+1%2520.csv",)], "p string")
    assert one(df.select(plain_path(F.col("p")))) == "file:/a/y f+1%20.csv"


@pytest.mark.parametrize(
    ("keys", "scheme", "expected"),
    [
        ("[a], [b c]", "YYYYMM", ["a", "b c", "PartitionKey"]),
        ("[a],[b]", "String", ["a", "b"]),
        ("a", None, ["a"]),
        ("", "YYYY", []),
        ("[ ]", "YYYY", []),
        ("[a],", "Latest", ["a", ""]),
    ],
)
def test_parse_key_list(spark, keys, scheme, expected):
    df = spark.createDataFrame([(keys, scheme)], "k string, s string")
    assert one(df.select(parse_key_list("k", "s"))) == expected


def test_key_list_without_scheme_or_text(spark):
    df = spark.createDataFrame([("[a]",), (None,)], "k string")
    assert [r[0] for r in df.select(parse_key_list("k")).collect()] == [["a"], None]


@pytest.mark.parametrize(
    ("html", "text", "across"),
    [
        ("<p>a&nbsp;b</p>", "a b", "a b"),
        ("a&nbspb <br/>", "a b", "a b"),
        ("x<b\nclass='y'>z", "x<b\nclass='y'>z", "xz"),
        ("1 < 2", "1 < 2", "1 < 2"),
        ("<<i>>", ">", ">"),
        (None, None, None),
    ],
)
def test_strip_html(spark, html, text, across):
    df = spark.createDataFrame([(html,)], "h string")
    assert one(strip_html(df, ["h"])) == text
    assert one(strip_html(df, ["h"], dotall=True)) == across


def test_split_camel_case(spark):
    df = spark.createDataFrame([("CommercialRealEstate ABCThing",)], "w string")
    assert one(df.select(split_camel_case("w"))) == "Commercial Real Estate ABC Thing"


@pytest.mark.parametrize(
    ("question", "answer", "searched", "expected"),
    [
        ("H_BillingFE", "Ann Lee 42", None, "42"),
        ("H_BillingFE", "nobody", "s", ""),
        ("AM_AssocMatters", "see 12.34 there", "s", "12.34"),
        ("AM_AssocMatters", "none", "s", ""),
        ("AM_AssocMatters", "see 12.34", "null", None),
        ("AM_AssocMatters", "see 12.34", None, None),
        ("MT_WorkType_RealEstate_ABCThing", "x", None, "Real Estate ABC Thing"),
        ("OtherWorkType", "x", None, ""),
        ("Other", "x 1", "s", None),
        (None, "x 1", "s", None),
    ],
)
def test_form_answer_values(spark, question, answer, searched, expected):
    df = spark.createDataFrame(
        [(question, answer, searched)],
        "QuestionName string, AnswerValue string, AnswerSearchValue string",
    )
    assert form_answer_values(df).first()["AnswerIntegerValue"] == expected
