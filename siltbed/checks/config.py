"""Checked queries over configuration tables, played by the larger given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltbed.checks.inputs import RAW_SQL, dated_events, table
from siltbed.checks.registry import checked
from siltbed.plans import catalog


def _table_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    method = F.when(F.col("c_acctbal") < 0, "read_json").otherwise("read_csv")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_mktsegment").alias("DatasetName"),
        F.concat(F.lit("t"), "c_nationkey").alias("CuratedTableName"),
        method.alias("ReadRawFileMethod"),
    )


@checked(
    """
SELECT c_custkey, c_mktsegment AS "DatasetName", 't' || c_nationkey AS "CuratedTableName",
  'read_csv' AS "ReadRawFileMethod"
FROM customer
WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3 AND c_acctbal >= 0
"""
)
def config_table_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.config_rows(_table_config(spark, sf_dir), "BUILDING", "t3", "read_json")


@checked(
    """
SELECT CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '1900-01-01' ELSE o_orderdate END
    AS "MaxIngestionDate",
  'ext_' || lower(o_orderstatus) AS "ExternalSchemaName", o_orderkey || '/' AS "DataLakePathRaw",
  'csv' AS "FlatFileExtension"
FROM orders WHERE o_orderpriority = '1-URGENT'
"""
)
def dataset_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    datasets = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("DatasetName"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("MaxIngestionDateTime"),
        F.lower("o_orderstatus").alias("SchemaName"),
        F.concat("o_orderkey", F.lit("/")).alias("DataLakePathRaw"),
        F.lit("csv").alias("FlatFileExtension"),
    )
    return catalog.dataset_header(datasets, "1-URGENT")


CATALOG_SQL = """
catalog AS (
  SELECT c_name AS "TableName",
    'r/' || n_nationkey || '/' || o_orderpriority || '/schema=v' || (c_custkey % 3)
      || '/partition=' || scheme || '/' AS "DataLakePathRaw",
    c_mktsegment || '/schema=v' || (c_custkey % 3) || '/partition=' || scheme || '/'
      AS "DataLakePathCurated",
    'read_csv' AS "ReadRawFileMethod", scheme AS "DataLakePartitionCurated"
  FROM nation
  JOIN customer ON n_nationkey = c_nationkey
  JOIN (SELECT *, CASE o_orderkey % 4 WHEN 0 THEN 'Latest' WHEN 1 THEN 'YYYYMM'
      WHEN 2 THEN 'YYYY' ELSE 'String' END AS scheme
    FROM orders WHERE o_orderstatus <> 'P') ON o_custkey = c_custkey
  WHERE n_name = 'NATION_3'
)
"""


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    datasets = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("DatasetKey"),
        F.col("n_name").alias("DatasetName"),
        F.concat(F.lit("r/"), "n_nationkey", F.lit("/")).alias("DataLakePathRaw"),
    )
    tables = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("DatasetKey"),
        F.col("c_custkey").alias("TableKey"),
        F.col("c_name").alias("TableName"),
        F.concat("c_mktsegment", F.lit("/")).alias("DataLakePathCurated"),
        (F.col("c_custkey") % 3).alias("SchemaVersion"),
    )
    schemes = F.array(*map(F.lit, ("Latest", "YYYYMM", "YYYY", "String")))
    queries = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("TableKey"),
        F.concat("o_orderpriority", F.lit("/")).alias("DataLakePathRaw"),
        F.lit("read_csv").alias("ReadRawFileMethod"),
        F.get(schemes, (F.col("o_orderkey") % 4).cast("int")).alias("DataLakePartitionCurated"),
        (F.col("o_orderstatus") != "P").alias("IsActive"),
    )
    return catalog.table_catalog(datasets, tables, queries, "NATION_3")


@checked(f"WITH {CATALOG_SQL} SELECT * FROM catalog")
def table_catalog_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog(spark, sf_dir)


@checked(
    f"""
WITH {CATALOG_SQL}
SELECT DISTINCT "DataLakePartitionCurated" FROM catalog
WHERE "DataLakePartitionCurated" <> 'Latest'
"""
)
def partition_schemes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.partition_schemes(_catalog(spark, sf_dir))


# Orders as tables and their lines as configured columns: the groups stay small
# while their number grows with the data.
COLUMNS_SQL = """
configured AS (
  SELECT l_orderkey AS t, l_linenumber AS id, 'c' || (l_partkey % 5) AS name,
    CASE WHEN l_linenumber % 3 <> 0 THEN 'd' || l_linenumber END AS value
  FROM lineitem
)
"""


def _column_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("CuratedTableName"),
        number.alias("ColumnId"),
        F.concat(F.lit("c"), F.col("l_partkey") % 5).alias("ColumnName"),
        F.when(number % 3 != 0, F.concat(F.lit("d"), number)).alias("ReplaceMissingWith"),
    )


@checked(
    f"""
WITH {COLUMNS_SQL},
firsts AS (SELECT t, name, min(id) AS id FROM configured GROUP BY t, name)
SELECT t AS "CuratedTableName", string_agg(name, ',' ORDER BY id, name) AS names
FROM firsts GROUP BY t
"""
)
def ordered_config_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = catalog.ordered_columns(_column_config(spark, sf_dir))
    return ordered.select("CuratedTableName", F.array_join("ColumnNames", ",").alias("names"))


@checked(
    f"""
WITH {COLUMNS_SQL},
lasts AS (
  SELECT * FROM configured
  QUALIFY row_number() OVER (PARTITION BY t, name ORDER BY id DESC) = 1
)
SELECT t AS "CuratedTableName",
  string_agg(name || '=' || coalesce(value, ''), ',' ORDER BY name) AS defaults
FROM lasts GROUP BY t
"""
)
def column_defaults_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = catalog.column_defaults(_column_config(spark, sf_dir))
    pairs = F.transform(
        F.array_sort(F.map_entries("Defaults")),
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))),
    )
    return maps.select("CuratedTableName", F.array_join(pairs, ",").alias("defaults"))


@checked(
    f"""
WITH {RAW_SQL}
SELECT 'table_' || event_type AS "CuratedTableName", 'read_csv' AS "ReadRawFileMethod",
  'App/' || event_type AS "DataLakePath", 'ext_app' AS "DestinationDBExternalSchema",
  event_type AS "DestinationDBExternalTable",
  '[user_id]' AS "EnrichedBusinessKeyColumnList", 'Lake' AS "DestinationDB",
  'Full' AS "FlatFileRole", 'Latest' AS "DataLakePartition", count(*) AS files,
  max("ingestionDateTime") AS "maxIngestionDate", max("extractDateTime") AS "maxExtractDate"
FROM raw WHERE event_type <> 'error'
GROUP BY event_type
"""
)
def files_to_table_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = dated_events(spark, sf_dir).select(
        F.concat(F.lit("app/"), "event_type").alias("DataLakePathRaw"),
        F.col("path").alias("filePath"),
        F.col("ingestionDateTime").alias("ingestionDate"),
        F.col("extractDateTime").alias("extractDate"),
    )
    kinds = table(spark, sf_dir, "events").select("event_type").distinct()
    tables = kinds.select(
        F.concat(F.lit("app/"), "event_type").alias("DataLakePathRaw"),
        F.concat(F.lit("table_"), "event_type").alias("CuratedTableName"),
        F.lit("read_csv").alias("ReadRawFileMethod"),
        F.concat(F.lit("App/"), "event_type").alias("DataLakePath"),
        F.lit("ext_app").alias("DestinationDBExternalSchema"),
        F.col("event_type").alias("DestinationDBExternalTable"),
        F.lit("[user_id]").alias("EnrichedBusinessKeyColumnList"),
        F.lit("Lake").alias("DestinationDB"),
        F.when(F.col("event_type") != "error", "Full").alias("FlatFileRole"),
        F.lit("Latest").alias("DataLakePartition"),
    )
    return catalog.load_groups(catalog.files_to_tables(files, tables))
