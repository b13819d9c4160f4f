"""Checked queries over files: raw trees, lake tables, streams and whole loads."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltbed.checks.inputs import (
    CSV_TEXT,
    FILED_SQL,
    RAW_SQL,
    dated_events,
    filed_events,
    orders_by_month,
    table,
    write_tree,
)
from siltbed.checks.registry import checked
from siltbed.fixed_values import EXTRACT, INGESTION
from siltbed.functions.paths import dates_from_path
from siltbed.plans import catalog
from siltbed.plans.load import load_dataset, load_table
from siltbed.plans.routing import write_curated
from siltbed.plans.spec import TableSpec
from siltbed.session import scratch_path
from siltbed.sinks.lake import (
    append_standardised,
    merge_full,
    overwrite_partitions,
    overwrite_snapshot,
    rewrite_by_month,
    upsert_partitions,
    write_json_latest,
    write_partitioned,
)
from siltbed.sources.files import file_inventory as inventory
from siltbed.sources.files import raw_subtrees, read_raw
from siltbed.streaming.upsert import stream_upsert

MARK = dt.datetime(2024, 1, 29, 12, 7)


@checked("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/lineitem.parquet"
    items = read_raw(spark, path, "parquet", recursive=False, with_path=False)
    return items.select("l_orderkey", "l_linenumber", "l_extendedprice")


@checked("SELECT doc_id::VARCHAR AS doc_id, text, lang, source, lang AS folder FROM documents")
def csv_multi_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").drop("n_chars")
    root = scratch_path(spark, "csv")
    filed = documents.repartition(8).withColumn("folder", F.col("lang"))
    filed.write.partitionBy("folder").options(**CSV_TEXT).csv(root)
    folder = F.regexp_extract("path", "/folder=([^/]*)/[^/]+$", 1)
    return read_raw(spark, root).withColumn("folder", folder).drop("path")


@checked(
    f"""
WITH {FILED_SQL},
stamped AS (
  SELECT filed_at AS i, CASE WHEN event_type = 'click' THEN filed_at + INTERVAL 5 SECOND ELSE filed_at END AS e,
    CASE WHEN event_type IN ('click', 'view') THEN 'web' ELSE 'app' END AS kind
  FROM filed
)
SELECT DISTINCT i AS "ingestionDate", e AS "extractDate", kind AS "DataLakePathRaw",
  true AS named, true AS below, true AS filled
FROM stamped WHERE i > TIMESTAMP '2024-01-29 12:00:00'
"""
)
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.when(
        F.col("event_type") == "click",
        F.date_format(F.expr("filed_at + INTERVAL 5 SECOND"), "yyyyMMdd-HHmmss"),
    ).otherwise("none")
    events = filed_events(spark, sf_dir).withColumn("stamp", stamp)
    web = F.col("event_type").isin("click", "view")
    roots = {
        write_tree(events.filter(web), "inventory", below={"batch": "stamp"}): "web",
        write_tree(events.filter(~web), "inventory", below={"batch": "stamp"}): "app",
    }
    files = inventory(spark, roots, "*.parquet", after=MARK)
    names = F.create_map(*[F.lit(x) for pair in roots.items() for x in pair])
    root, path = F.col("DataLakePathRaw"), F.col("filePath")
    return files.select(
        "ingestionDate",
        "extractDate",
        F.element_at(names, root).alias("DataLakePathRaw"),
        path.endswith(F.concat(F.lit("/"), "fileName", F.lit(".parquet"))).alias("named"),
        path.contains(root).alias("below"),
        (F.col("fileSize") > 0).alias("filled"),
    ).distinct()


@checked(
    f"""
WITH {FILED_SQL}
SELECT event_id, user_id, filed_at AS "ingestionDateTime" FROM filed
WHERE filed_at > TIMESTAMP '2024-01-29 12:00:00'
"""
)
def incremental_hour_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = write_tree(filed_events(spark, sf_dir), "window")
    mark = MARK.replace(minute=0)
    newer = read_raw(spark, raw_subtrees(spark, root, after=mark), "parquet")
    return dates_from_path(newer).select("event_id", "user_id", INGESTION)


@checked(
    f"""
WITH {FILED_SQL}
SELECT strftime(filed_at, '%Y-%m-%d %H:%M:%S') AS "ingestionDateTime",
  strftime(filed_at, '%Y-%m-%d %H:%M:%S') AS "extractDateTime",
  event_id, event_type, props, zone,
  strftime(filed_at, 'year=%Y/month=%m/day=%d/hour=%H/minute=%M') AS folder
FROM filed, (VALUES ('curated'), ('standardised')) AS zones(zone)
"""
)
def json_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = filed_events(spark, sf_dir).select("event_id", "event_type", "props", "filed_at")
    raw = write_tree(events, "json", "json")
    schema = "event_id bigint, event_type string, props string"
    lake = scratch_path(spark, "json-lake")
    arrived = read_raw(spark, raw, "json", schema, multi_line=False)
    write_json_latest(arrived, "events", f"{lake}/curated", f"{lake}/standardised")
    zones = [
        spark.read.parquet(f"{lake}/{zone}/json/events/schema=v1/partition=Latest")
        .withColumn("folder", F.regexp_extract("path", "/(year=[^/]+(?:/[^/=]+=[^/]+)+)/[^/]+$", 1))
        .drop("path")
        .withColumn("zone", F.lit(zone))
        for zone in ("curated", "standardised")
    ]
    return zones[0].unionByName(zones[1])


@checked(
    f"""
WITH {RAW_SQL}
SELECT event_id, user_id, event_type, value, path,
  strftime("ingestionDateTime", '%Y-%m-%d %H:%M:%S') AS "ingestionDateTime",
  strftime("extractDateTime", '%Y-%m-%d %H:%M:%S') AS "extractDateTime"
FROM raw
QUALIFY row_number() OVER (
  PARTITION BY user_id, event_type
  ORDER BY raw."ingestionDateTime" DESC, raw."extractDateTime" DESC, event_id DESC) = 1
"""
)
def latest_snapshot_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "snapshot")
    events = dated_events(spark, sf_dir).drop("ts", "props")
    overwrite_snapshot(events, path, ["user_id", "event_type"])
    return spark.read.parquet(path)


@checked(
    """
WITH dated AS (
  SELECT event_id, user_id, CAST(year(ts) AS INTEGER) AS "Year",
    CAST(month(ts) AS INTEGER) AS "Month", ts AS "ingestionDateTime"
  FROM events
)
SELECT * FROM dated UNION ALL SELECT * FROM dated
"""
)
def standardised_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "standardised")
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("ts").alias(INGESTION)
    )
    append_standardised(events, path)
    append_standardised(events, path)
    return spark.read.parquet(path)


@checked(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate,
  CAST(year(l_shipdate) AS INTEGER) AS "Year", CAST(month(l_shipdate) AS INTEGER) AS "Month"
FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber, year(l_shipdate), month(l_shipdate)
  ORDER BY l_shipdate DESC, l_partkey DESC, l_extendedprice DESC) = 1
"""
)
def history_overwrite_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "history")
    months = ["Year", "Month"]
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
        "l_shipdate",
        F.year("l_shipdate").alias("Year"),
        F.month("l_shipdate").alias("Month"),
    )
    overwrite_partitions(
        items, path, ["l_orderkey", "l_linenumber"], months, ["l_shipdate"], extra_keys=months
    )
    return spark.read.schema(items.schema).parquet(path)


@checked(
    """
SELECT o_orderkey, o_custkey,
  CASE WHEN year(o_orderdate) = 1996 AND o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END
    AS o_totalprice,
  CASE WHEN year(o_orderdate) = 1996 AND o_orderstatus = 'F' THEN 2 ELSE 1 END AS ing,
  CAST(year(o_orderdate) AS INTEGER) AS "Year", CAST(month(o_orderdate) AS INTEGER) AS "Month"
FROM orders
"""
)
def recent_partition_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "upsert")
    orders = orders_by_month(spark, sf_dir)
    write_partitioned(orders, path, ["Year", "Month"])
    changed = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select("o_orderkey")
    delta = orders.filter("Year = 1996").join(changed, "o_orderkey", "left_semi")
    delta = delta.withColumns({"o_totalprice": F.lit(0.0), "ing": F.lit(2)})
    upsert_partitions(delta, path, ["o_orderkey"], ["Year", "Month"], ["ing"])
    return spark.read.schema(orders.schema).parquet(path)


@checked(
    """
WITH repeated AS (
  SELECT c_custkey % 100 AS k, c_custkey, c_acctbal, c_mktsegment AS "Part" FROM customer
)
SELECT k, c_custkey, c_acctbal, "Part" FROM repeated
QUALIFY row_number() OVER (PARTITION BY k, "Part" ORDER BY c_acctbal DESC, c_custkey DESC) = 1
"""
)
def string_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "string")
    customers = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") % 100).alias("k"), "c_custkey", "c_acctbal", F.col("c_mktsegment").alias("Key")
    )
    spec = TableSpec("t", (), path, scheme="String", role="History", keys=("k",), key_column="Key")
    write_curated(customers.withColumn(INGESTION, F.col("c_acctbal")).withColumn(EXTRACT, F.col("c_custkey")), spec, path)
    stored = spark.read.parquet(path)
    return stored.select(
        "k", "c_custkey", "c_acctbal", F.col("Part").cast("string").alias("Part")
    )


@checked(
    """
SELECT c_custkey, c_name, c_nationkey,
  CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 0 THEN 100000.0 ELSE c_acctbal END
    AS c_acctbal,
  c_mktsegment AS "Part"
FROM customer
"""
)
def string_partition_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "string-upsert")
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "Part")
    write_partitioned(customers, path, ["Part"])
    delta = customers.filter("Part = 'BUILDING' AND c_acctbal < 0")
    delta = delta.withColumn("c_acctbal", F.lit(100000.0))
    upsert_partitions(delta, path, ["c_custkey"], ["Part"], ["c_acctbal"])
    return spark.read.schema(customers.schema).parquet(path)


@checked(
    """
SELECT doc_id, source, lang, CASE WHEN lang = 'en' THEN 'new' ELSE text END AS text,
  CASE WHEN lang = 'en' THEN 2 ELSE 1 END AS ing
FROM documents
"""
)
def legacy_full_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "legacy")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", "text", F.lit(1).alias("ing")
    )
    merge_full(documents, path, ["doc_id"], ["source", "lang"], ["ing"])
    delta = documents.filter("lang = 'en'").withColumns({"text": F.lit("new"), "ing": F.lit(2)})
    merge_full(delta, path, ["doc_id"], ["source", "lang"], ["ing"])
    return spark.read.parquet(path)


@checked(
    """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS "Year", CAST(month(o_orderdate) AS INTEGER) AS "Month"
FROM orders
"""
)
def coarsen_partitions_to_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    days, months = scratch_path(spark, "days"), scratch_path(spark, "months")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("PartitionKey")
    )
    by_day = TableSpec("orders", (), days, scheme="YYYYMMDD", role="History", keys=("o_orderkey",))
    stamped = orders.withColumns({INGESTION: F.lit("x"), EXTRACT: F.lit("x")})
    write_curated(stamped, by_day, days)
    rewrite_by_month(spark, days, months)
    return spark.read.parquet(months).select("o_orderkey", "Year", "Month")


@checked(
    f"""
WITH {FILED_SQL}
SELECT event_id, user_id, event_type, value, ts FROM filed
QUALIFY row_number() OVER (
  PARTITION BY user_id, event_type ORDER BY filed_at DESC, ts DESC, event_id DESC) = 1
"""
)
def stream_latest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = filed_events(spark, sf_dir).drop("props")
    days = events.withColumn("filed_at", F.col("filed_at").cast("timestamp_ntz"))
    source = write_tree(days, "stream")
    target, marks = scratch_path(spark, "stream-target"), scratch_path(spark, "stream-marks")
    schema = days.drop("filed_at").schema
    query = stream_upsert(
        spark,
        source,
        schema,
        target,
        ["user_id"],
        marks,
        partition_cols=["event_type"],
        fmt="parquet",
        max_files=60,
        order=(INGESTION, EXTRACT, "ts", "event_id"),
    )
    query.awaitTermination()
    return spark.read.parquet(target).select("event_id", "user_id", "event_type", "value", "ts")


LOAD_SPEC = TableSpec(
    name="app_events",
    raw_paths=(),
    curated_path="App/Events/schema=v1/partition=YYYYMMDD",
    scheme="YYYYMMDD",
    role="History",
    keys=("user_id", "event_type"),
    columns=("event_id", "user_id", "event_type", "value", "PartitionKey", "note"),
    defaults={"note": "n/a"},
)


def event_csv(spark: SparkSession, sf_dir: str, name: str) -> str:
    key = F.date_format("ts", "yyyyMMdd")
    events = filed_events(spark, sf_dir).withColumn("Partitionkey", key).drop("ts")
    return write_tree(events, name, "csv", **CSV_TEXT)


@checked(
    f"""
WITH {FILED_SQL}
SELECT event_id, user_id, event_type, value, 'n/a' AS note,
  strftime(filed_at, '%Y-%m-%d %H:%M:%S') AS "ingestionDateTime",
  CAST(year(ts) AS INTEGER) AS "Year", CAST(month(ts) AS INTEGER) AS "Month",
  CAST(day(ts) AS INTEGER) AS "Day"
FROM filed
WHERE filed_at > TIMESTAMP '2024-01-05 12:00:00'
QUALIFY row_number() OVER (
  PARTITION BY user_id, event_type, strftime(ts, '%Y%m%d')
  ORDER BY filed_at DESC, event_id::VARCHAR DESC) = 1
"""
)
def load_table_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, lake = event_csv(spark, sf_dir, "load-raw"), scratch_path(spark, "load-lake")
    after = dt.datetime(2024, 1, 5, 12)
    paths = raw_subtrees(spark, raw, after)
    curated = load_table(spark, LOAD_SPEC, lake, paths)
    return spark.read.parquet(curated).select(
        F.col("event_id").cast("bigint"),
        F.col("user_id").cast("bigint"),
        "event_type",
        F.col("value").cast("double"),
        "note",
        INGESTION,
        "Year",
        "Month",
        "Day",
    )


def _load_config(spark: SparkSession, raw: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    datasets = spark.createDataFrame(
        [("shop", dt.datetime(2024, 1, 20, 12, 30), "csv", "shop")],
        "DatasetName string, MaxIngestionDateTime timestamp_ntz, FlatFileExtension string, SchemaName string",
    )
    fields = ("DatasetName", "DataLakePathRaw", *catalog.GROUP_COLUMNS)
    loads = [
        ("shop", raw, "snapshot", "read_csv", "Snapshot", "ext_shop", "s", "[user_id]", "Lake", "Full", "Latest"),
        ("shop", raw, "fact_cost", "read_csv", "Cost", "ext_shop", "c", "[user_id], [event_type]", "Lake", "Recent", "YYYYMM"),
    ]
    tables = spark.createDataFrame(loads, ", ".join(f"{f} string" for f in fields))
    columns = spark.createDataFrame(
        [
            ("shop", name, number, column, "none" if column == "note" else None)
            for name in ("snapshot", "fact_cost")
            for number, column in enumerate(
                ("event_id", "user_id", "event_type", "PartitionKey", "note")
            )
        ],
        "DatasetName string, CuratedTableName string, ColumnId int, ColumnName string, ReplaceMissingWith string",
    )
    return datasets, tables, columns


@checked(
    f"""
WITH {FILED_SQL},
newer AS (SELECT * FROM filed WHERE filed_at > TIMESTAMP '2024-01-20 12:00:00'),
snapshot AS (
  SELECT 'snapshot' AS loaded, * FROM newer
  QUALIFY row_number() OVER (
    PARTITION BY user_id
    ORDER BY filed_at DESC, event_id::VARCHAR DESC) = 1
),
fact_cost AS (
  SELECT 'fact_cost' AS loaded, * FROM newer
  QUALIFY row_number() OVER (
    PARTITION BY user_id, event_type, strftime(ts, '%Y%m')
    ORDER BY filed_at DESC, event_id::VARCHAR DESC) = 1
),
newest AS (SELECT max(filed_at) AS newest_at FROM newer)
SELECT loaded, event_id, user_id, event_type, 'none' AS note,
  to_json({{
    max_extract_date: strftime(newest_at, '%d %B %Y %H:%M:%S'),
    max_ingestion_date: strftime(newest_at, '%d %B %Y %H:%M:%S')
  }})::VARCHAR AS summary
FROM (SELECT * FROM snapshot UNION ALL SELECT * FROM fact_cost), newest
"""
)
def load_dataset_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, lake = event_csv(spark, sf_dir, "dataset-raw"), scratch_path(spark, "dataset-lake")
    summary = load_dataset(spark, lake, *_load_config(spark, raw), "shop", parallel=2)
    json.loads(summary)
    loaded = [
        spark.read.parquet(f"{lake}/curated/{path}").select(
            F.lit(name).alias("loaded"),
            F.col("event_id").cast("bigint"),
            F.col("user_id").cast("bigint"),
            "event_type",
            "note",
            F.lit(summary).alias("summary"),
        )
        for name, path in (("snapshot", "Snapshot"), ("fact_cost", "Cost"))
    ]
    return loaded[0].unionByName(loaded[1])
