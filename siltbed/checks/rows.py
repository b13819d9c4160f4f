"""Checked queries over rows: columns, text, latest rows, joins and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltbed.checks.inputs import (
    RAW_SQL,
    dated_events,
    orders_by_month,
    raw_events,
    table,
)
from siltbed.checks.registry import checked
from siltbed.functions.keys import parse_key_list as parsed_keys
from siltbed.functions.paths import dates_from_path as with_dates
from siltbed.functions.text import form_answer_values as with_answers
from siltbed.functions.text import split_camel_case as camel_split
from siltbed.functions.text import strip_html as without_tags
from siltbed.operators import columns as shaping
from siltbed.operators.latest import (
    latest_files,
    latest_rows,
    partition_changes,
    rows_of_latest_file as newest_file_rows,
    run_summary,
)
from siltbed.operators.merge import touched_partitions, union_delta
from siltbed.operators.partitions import calendar_columns, coarsen_key, date_hierarchy


@checked(
    f"""
WITH {RAW_SQL}
SELECT event_id, path, "ingestionDateTime", "extractDateTime" FROM raw
"""
)
def dates_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_dates(raw_events(spark, sf_dir)).select(
        "event_id", "path", "ingestionDateTime", "extractDateTime"
    )


@checked(
    f"""
WITH {RAW_SQL}
SELECT * FROM raw
QUALIFY row_number() OVER (
  PARTITION BY user_id, event_type
  ORDER BY "ingestionDateTime" DESC, "extractDateTime" DESC, event_id DESC) = 1
"""
)
def latest_row_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_rows(dated_events(spark, sf_dir), ["user_id", "event_type"])


@checked(
    f"""
WITH {RAW_SQL}
SELECT user_id, event_type, path, "ingestionDateTime", "extractDateTime" FROM raw
QUALIFY row_number() OVER (
  PARTITION BY user_id, event_type
  ORDER BY "ingestionDateTime" DESC, "extractDateTime" DESC, path DESC) = 1
"""
)
def latest_row_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = dated_events(spark, sf_dir).select(
        "user_id", "event_type", "path", "ingestionDateTime", "extractDateTime"
    )
    return latest_rows(events)


@checked(
    f"""
WITH {RAW_SQL},
per_file AS (
  SELECT event_type, "ingestionDateTime" AS i, max("extractDateTime") AS e FROM raw GROUP BY 1, 2
),
newest AS (SELECT event_type, max(i) AS i FROM per_file GROUP BY 1)
SELECT event_type, i AS "maxIngestionDate", e AS "maxExtractDate"
FROM newest JOIN per_file USING (event_type, i)
ORDER BY event_type
"""
)
def latest_file_per_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_files(dated_events(spark, sf_dir), "event_type")


@checked(
    f"""
WITH {RAW_SQL}
SELECT event_id, ts, user_id, event_type, value, props, path,
  "ingestionDateTime", "extractDateTime"
FROM raw
QUALIFY rank() OVER (
  PARTITION BY user_id ORDER BY "ingestionDateTime" DESC, "extractDateTime" DESC) = 1
"""
)
def rows_of_latest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest_file_rows(raw_events(spark, sf_dir), "user_id")


@checked(
    """
SELECT page_id, url,
  trim(regexp_replace(regexp_replace(html, '<.*?>', '', 'g'), '&nbsp;?', ' ', 'g')) AS html
FROM pages
"""
)
def strip_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_tags(table(spark, sf_dir, "pages"), ["html"])


@checked(
    """
WITH questions AS (
  SELECT event_id, event_id % 5 AS q,
    CASE event_id % 5 WHEN 0 THEN 'H_BillingFE' WHEN 1 THEN 'AM_AssocMatters'
      WHEN 2 THEN 'MT_WorkType_CommercialRealEstate_ABCThing' WHEN 3 THEN 'Other'
      ELSE 'H_ClientPartner' END AS "QuestionName",
    CASE WHEN event_id % 7 = 0 THEN 'none'
      WHEN event_id % 5 = 1 THEN 'Matter ' || user_id || '.' || event_id || ' end'
      ELSE 'User Name ' || user_id END AS "AnswerValue",
    CASE event_id % 3 WHEN 0 THEN 'null' WHEN 2 THEN 's' END AS "AnswerSearchValue"
  FROM events
)
SELECT event_id, "QuestionName", "AnswerValue", "AnswerSearchValue",
  CASE
    WHEN "QuestionName" LIKE '%WorkType%' THEN
      regexp_replace(regexp_replace(replace(
        regexp_extract("QuestionName", 'MT_WorkType_(.*)', 1), '_', ' '),
        '([a-z])([A-Z])', '\\1 \\2', 'g'), '([A-Z])([A-Z][a-z])', '\\1 \\2', 'g')
    WHEN "QuestionName" = 'AM_AssocMatters' AND "AnswerSearchValue" <> 'null' THEN
      regexp_extract("AnswerValue", '(\\d+\\.\\d+)', 1)
    WHEN "QuestionName" IN ('H_SupervisingFE', 'H_BillingFE', 'H_ClientPartner') THEN
      regexp_extract("AnswerValue", '(\\D+)\\s(\\d+)$', 2)
  END AS "AnswerIntegerValue"
FROM questions
"""
)
def form_answer_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, user = F.col("event_id"), F.col("user_id")
    names = F.array(
        *map(
            F.lit,
            (
                "H_BillingFE",
                "AM_AssocMatters",
                "MT_WorkType_CommercialRealEstate_ABCThing",
                "Other",
                "H_ClientPartner",
            ),
        )
    )
    matter = F.concat(F.lit("Matter "), user, F.lit("."), event, F.lit(" end"))
    questions = table(spark, sf_dir, "events").select(
        "event_id",
        F.get(names, (event % 5).cast("int")).alias("QuestionName"),
        F.when(event % 7 == 0, "none")
        .when(event % 5 == 1, matter)
        .otherwise(F.concat(F.lit("User Name "), user))
        .alias("AnswerValue"),
        F.when(event % 3 == 0, "null").when(event % 3 == 2, "s").alias("AnswerSearchValue"),
    )
    return with_answers(questions)


@checked(
    """
WITH words AS (
  SELECT event_id,
    upper(left(event_type, 1)) || substr(event_type, 2) || 'ABC' || upper(left(event_type, 1))
      || substr(event_type, 2) || user_id AS word
  FROM events
)
SELECT event_id, word,
  regexp_replace(regexp_replace(word, '([a-z])([A-Z])', '\\1 \\2', 'g'),
    '([A-Z])([A-Z][a-z])', '\\1 \\2', 'g') AS words
FROM words
"""
)
def split_camel_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.initcap("event_type")
    word = F.concat(title, F.lit("ABC"), title, F.col("user_id").cast("string"))
    words = table(spark, sf_dir, "events").select("event_id", word.alias("word"))
    return words.withColumn("words", camel_split("word"))


@checked(
    f"""
WITH {RAW_SQL}
SELECT to_json({{
  max_extract_date: strftime(max("extractDateTime"), '%d %B %Y %H:%M:%S'),
  max_ingestion_date: strftime(max("ingestionDateTime"), '%d %B %Y %H:%M:%S')
}})::VARCHAR AS summary
FROM raw
"""
)
def run_watermark_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(dated_events(spark, sf_dir))


@checked(
    """
SELECT event_id, ts, CAST(year(ts) AS INTEGER) AS "Year", CAST(month(ts) AS INTEGER) AS "Month",
  CAST(weekofyear(ts) AS INTEGER) AS "Week", CAST(dayofyear(ts) AS INTEGER) AS day_of_year
FROM events
"""
)
def date_hierarchy_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return date_hierarchy(events, "day_of_year", "ts")


@checked(
    """
SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y%m') AS "PartitionKey",
  CAST(date_trunc('month', o_orderdate) AS DATE) AS "PartitionDate",
  CAST(year(o_orderdate) AS VARCHAR) AS "Year", CAST(month(o_orderdate) AS VARCHAR) AS "Month"
FROM orders
"""
)
def calendar_partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyyMM").alias("PartitionKey")
    )
    return calendar_columns(orders, "PartitionKey", "YYYYMM")


@checked(
    """
SELECT o_orderkey, left(strftime(o_orderdate, '%Y%m%d'), 6) AS "PartitionKey" FROM orders
"""
)
def coarsen_day_to_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("PartitionKey")
    )
    return coarsen_key(orders)


@checked(
    """
SELECT min('f' || o_orderpriority) AS path, max(o_orderdate) AS "maxExtractDate",
  max(o_orderdate) AS "maxIngestionDateTime", 'orders' AS "CuratedTableName",
  'Year=' || year(o_orderdate) || '/Month=' || month(o_orderdate) AS "PartitionLocation"
FROM orders
GROUP BY year(o_orderdate), month(o_orderdate)
"""
)
def partition_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("f"), "o_orderpriority").alias("path"),
        F.col("o_orderdate").alias("ingestionDateTime"),
        F.col("o_orderdate").alias("extractDateTime"),
        F.year("o_orderdate").alias("Year"),
        F.month("o_orderdate").alias("Month"),
    )
    return partition_changes(orders, ["Year", "Month"], "orders")


@checked(
    """
WITH m AS (
  SELECT o_orderkey, o_custkey, o_totalprice, 1 AS ing,
    CAST(year(o_orderdate) AS INTEGER) AS "Year", CAST(month(o_orderdate) AS INTEGER) AS "Month"
  FROM orders
)
SELECT * FROM m
WHERE ("Year", "Month") IN (SELECT DISTINCT ("Year", "Month") FROM m WHERE "Year" = 1996)
"""
)
def touched_partitions_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_by_month(spark, sf_dir)
    return touched_partitions(orders, orders.filter("Year = 1996"), ["Year", "Month"])


@checked(
    """
WITH m AS (
  SELECT o_orderkey, o_custkey, o_totalprice, 1 AS ing,
    CAST(year(o_orderdate) AS INTEGER) AS "Year", CAST(month(o_orderdate) AS INTEGER) AS "Month"
  FROM orders
)
SELECT * FROM m
UNION ALL
SELECT o_orderkey, o_custkey, 0.0::DOUBLE, 2, "Year", "Month" FROM m WHERE "Year" = 1996
"""
)
def union_all_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_by_month(spark, sf_dir)
    delta = orders.filter("Year = 1996").withColumns(
        {"o_totalprice": F.lit(0.0), "ing": F.lit(2)}
    )
    return union_delta(orders, delta)


@checked("SELECT c_custkey, c_name AS customer, c_nationkey AS nation, c_acctbal FROM customer")
def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").drop("c_mktsegment")
    names = {"c_name": "customer", "c_nationkey": "nation", "unknown": "ignored"}
    return shaping.rename_columns(customers, names)


@checked(
    """
SELECT c_custkey AS "Customer_Key", c_name AS "Name-_(full)/short", c_acctbal AS balance
FROM customer
"""
)
def sanitise_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias(" Customer Key. "),
        F.col("c_name").alias("Name-_(full)/short"),
        F.col("c_acctbal").alias("b[a]l`a,n;c{e}"),
    )
    return shaping.sanitise_columns(customers)


@checked(
    f"""
WITH {RAW_SQL}
SELECT event_id AS "Event_Id", value AS "Valuegross", path, "ingestionDateTime", "extractDateTime"
FROM raw
"""
)
def sanitise_and_order_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = dated_events(spark, sf_dir).select(
        "path",
        "ingestionDateTime",
        F.col("event_id").alias("Event Id."),
        "extractDateTime",
        F.col("value").alias("Value/gross"),
    )
    return shaping.sanitise_columns(events, metadata_last=True)


@checked("SELECT c_custkey, CAST(NULL AS DOUBLE) AS rating FROM customer")
def null_typed_to_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.lit(None).alias("rating"))
    return shaping.null_typed_to(customers)


@checked("SELECT c_custkey AS \"C_CustKey\", c_name, 'n/a' AS note, 7 AS grade FROM customer")
def add_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    defaults = {"C_CustKey": -1, "note": "n/a", "grade": 7}
    return shaping.add_missing_columns(customers, defaults)


@checked("SELECT c_mktsegment, c_custkey, c_name FROM customer")
def project_configured_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    configured = ["c_mktsegment", "c_custkey", "c_name", "c_custkey"]
    return shaping.project_columns(table(spark, sf_dir, "customer"), configured)


@checked(
    """
SELECT c_name, c_custkey, CAST(NULL AS DOUBLE) AS rating, 'n/a' AS note FROM customer
"""
)
def conform_to_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    configured = ["c_name", "c_custkey", "rating", "note"]
    return shaping.conform(
        table(spark, sf_dir, "customer"), configured, {"rating": None, "note": "n/a"}
    )


@checked(
    f"""
WITH {RAW_SQL}
SELECT event_id, strftime("ingestionDateTime", '%Y-%m-%d %H:%M:%S') AS "ingestionDateTime",
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS "extractDateTime"
FROM raw
"""
)
def metadata_timestamps_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = dated_events(spark, sf_dir).select(
        "event_id", "ingestionDateTime", F.col("ts").alias("extractDateTime")
    )
    return shaping.format_metadata(events)


@checked(
    """
SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS FLOAT) AS l_extendedprice,
  l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate
FROM lineitem
"""
)
def cast_by_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    return shaping.cast_by_type_map(items)


@checked(
    """
WITH k AS (
  SELECT c_custkey,
    CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '[' || c_name || '], [k' || c_nationkey || ' ]' END
      AS listed,
    CASE c_custkey % 3 WHEN 0 THEN 'YYYYMM' WHEN 1 THEN 'Latest' ELSE 'YYYY' END AS scheme
  FROM customer
)
SELECT c_custkey, CASE WHEN listed = '' THEN '' ELSE
  array_to_string(list_transform(
    string_split(regexp_replace(listed, '[\\[\\]]', '', 'g'), ','), lambda x: trim(x)), '|')
  || CASE WHEN scheme IN ('YYYY', 'YYYYMM', 'YYYYMMDD') THEN '|PartitionKey' ELSE '' END END
  AS keys
FROM k
"""
)
def parse_key_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = F.col("c_custkey")
    listed = F.concat(F.lit("["), "c_name", F.lit("], [k"), "c_nationkey", F.lit(" ]"))
    config = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(customer % 5 == 0, "").otherwise(listed).alias("listed"),
        F.when(customer % 3 == 0, "YYYYMM")
        .when(customer % 3 == 1, "Latest")
        .otherwise("YYYY")
        .alias("scheme"),
    )
    return config.select(
        "c_custkey", F.array_join(parsed_keys("listed", "scheme"), "|").alias("keys")
    )
