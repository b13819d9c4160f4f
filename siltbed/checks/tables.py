"""Checked queries over stored tables: single files, contents, observed counts."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltbed.checks.inputs import CSV_TEXT, FILED_SQL, filed_events, orders_by_month, table, write_tree
from siltbed.checks.registry import checked
from siltbed.fixed_values import INGESTION
from siltbed.operators import changes
from siltbed.plans import catalog
from siltbed.plans.load import load_dataset
from siltbed.session import scratch_path
from siltbed.sinks import bucketed, files
from siltbed.sinks.lake import write_partitioned
from siltbed.sources import malformed
from siltbed.streaming.upsert import stream_upsert


def _stored(spark: SparkSession, path: str) -> dict[str, tuple[int, int]]:
    """Size and time of each file of a table."""
    rows = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", F.unix_millis("modificationTime").alias("time"))
        .collect()
    )
    return {r["path"]: (r["length"], r["time"]) for r in rows}


# Orders of 1996 with a key below the median are merged; every second file of the table is by key range.
@checked(
    """
WITH low AS (SELECT max(o_orderkey) // 2 AS bound FROM orders)
SELECT o_orderkey, o_custkey,
  CASE WHEN year(o_orderdate) = 1996 AND o_orderkey < bound THEN 0.0 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN year(o_orderdate) = 1996 AND o_orderkey < bound THEN 2 ELSE 1 END AS ing,
  CAST(year(o_orderdate) AS INTEGER) AS "Year", CAST(month(o_orderdate) AS INTEGER) AS "Month",
  true AS others_untouched
FROM orders, low
"""
)
def file_level_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, cols = scratch_path(spark, "file-upsert"), ["Year", "Month"]
    orders = orders_by_month(spark, sf_dir)
    bound = orders.agg(F.max("o_orderkey")).first()[0] // 2
    low = F.col("o_orderkey") < bound
    for part in (orders.filter(low), orders.filter(~low)):  # two files a month, by key
        part.repartition(*cols).write.mode("append").partitionBy(*cols).parquet(path)
    before = _stored(spark, path)
    delta = orders.filter((F.col("Year") == 1996) & low).withColumns({"o_totalprice": F.lit(0.0), "ing": F.lit(2)})
    files.upsert_files(delta, path, ["o_orderkey"], cols, ["ing"])
    files.upsert_files(delta, path, ["o_orderkey"], cols, ["ing"])
    after = _stored(spark, path)
    months = delta.select(*cols).distinct().count()
    kept = sum(after.get(name) == of for name, of in before.items())
    stored = spark.read.schema(orders.schema).parquet(path)
    return stored.withColumn("others_untouched", F.lit(kept == len(before) - months))


@checked(
    """
WITH numbered AS (
  SELECT *, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m FROM orders
),
old AS (SELECT y, m, o_orderkey AS k, o_custkey AS c, o_totalprice AS p, o_orderstatus AS s FROM numbered WHERE o_orderkey % 11 <> 0),
new AS (
  SELECT CASE WHEN o_orderkey % 7 = 0 THEN y + 1 ELSE y END AS y, m, o_orderkey AS k, o_custkey AS c,
    CASE WHEN o_orderkey % 5 = 0 THEN -o_totalprice ELSE o_totalprice END AS p,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS s
  FROM numbered WHERE o_orderkey % 17 <> 0
)
SELECT coalesce(old.y, new.y) AS "Year", coalesce(old.m, new.m) AS "Month",
  count(*) FILTER (WHERE old.k IS NULL) AS inserted,
  count(*) FILTER (WHERE old.k = new.k AND (old.p <> new.p OR old.s IS DISTINCT FROM new.s)) AS updated,
  count(*) FILTER (WHERE old.k = new.k AND old.p = new.p AND old.s IS NOT DISTINCT FROM new.s) AS unchanged,
  count(*) FILTER (WHERE new.k IS NULL) AS gone
FROM old FULL OUTER JOIN new ON old.k = new.k AND old.y = new.y AND old.m = new.m
GROUP BY 1, 2
"""
)
def partition_content_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    orders = orders_by_month(spark, sf_dir).join(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey")
    new = orders.filter(key % 17 != 0).withColumns(
        {
            "Year": F.when(key % 7 == 0, F.col("Year") + 1).otherwise(F.col("Year")),
            "o_totalprice": F.when(key % 5 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")),
            "o_orderstatus": F.when(key % 13 != 0, F.col("o_orderstatus")),
            "ing": F.lit(2),
        }
    )
    return changes.partition_content_changes(orders.filter(key % 11 != 0), new, ["o_orderkey"], ["Year", "Month"], ["ing"])


@checked(
    """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS "Year", true AS fewer, true AS settled, true AS others_untouched
FROM orders
"""
)
def compact_small_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, cols = scratch_path(spark, "compact"), ["Year"]
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("Year"))
    write_partitioned(orders.filter("Year % 2 = 0"), path, cols)
    whole = _stored(spark, path)
    orders.filter("Year % 2 = 1").repartition(6).write.mode("append").partitionBy(*cols).parquet(path)
    before = _stored(spark, path)
    target = 4 * max(length for length, _ in whole.values())
    files.compact_small_files(spark, path, cols, target)
    after = _stored(spark, path)
    again = files.compact_small_files(spark, path, cols, target)
    fewer, settled = len(after) == len({name.rsplit("/", 1)[0] for name in before}), again == 0 and _stored(spark, path) == after
    untouched = all(after.get(name) == of for name, of in whole.items())
    return spark.read.parquet(path).select(
        "o_orderkey", "Year", F.lit(fewer).alias("fewer"), F.lit(settled).alias("settled"), F.lit(untouched).alias("others_untouched")
    )


@checked(
    f"""
WITH {FILED_SQL},
newer AS (SELECT * FROM filed WHERE filed_at > TIMESTAMP '2024-01-20 12:00:00'),
rows AS (SELECT count(*) AS n, count(DISTINCT user_id) AS users,
  count(DISTINCT (user_id, strftime(ts, '%Y%m'))) AS user_months FROM newer)
SELECT name, step, CASE step WHEN 'written' THEN CASE name WHEN 'newest' THEN users ELSE user_months END ELSE n END AS rows
FROM rows, (VALUES ('newest'), ('monthly')) AS t(name), (VALUES ('read'), ('appended'), ('written')) AS s(step)
"""
)
def observed_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = write_tree(
        filed_events(spark, sf_dir).withColumn("PartitionKey", F.date_format("ts", "yyyyMM")).drop("ts"),
        "observed",
        "csv",
        **CSV_TEXT,
    )
    fields = ("DatasetName", "DataLakePathRaw", *catalog.GROUP_COLUMNS)
    loads = [
        ("shop", raw, "newest", "read_csv", "Newest", "ext", "n", "[user_id]", "Lake", "Full", "Latest"),
        ("shop", raw, "monthly", "read_csv", "Monthly", "ext", "m", "[user_id]", "Lake", "Recent", "YYYYMM"),
    ]
    datasets = spark.createDataFrame(
        [("shop", dt.datetime(2024, 1, 20, 12, 30), "csv", "shop")],
        "DatasetName string, MaxIngestionDateTime timestamp_ntz, FlatFileExtension string, SchemaName string",
    )
    columns = spark.createDataFrame(
        [], "DatasetName string, CuratedTableName string, ColumnId int, ColumnName string, ReplaceMissingWith string"
    )
    tables = spark.createDataFrame(loads, ", ".join(f"{f} string" for f in fields))
    lake = scratch_path(spark, "observed-lake")
    summary = load_dataset(spark, lake, datasets, tables, columns, "shop", parallel=2, counted=True)
    counted = [(name, step, n) for name, steps in json.loads(summary)["tables"].items() for step, n in steps.items()]
    return spark.createDataFrame(counted, "name string, step string, rows bigint")


def _write_lines(df: DataFrame, name: str, header: str | None = None) -> str:
    """Files of text lines, one folder a month, each with the header."""
    root = scratch_path(df.sparkSession, name)
    lines = F.array_join(F.array_sort(F.collect_list("line")), "\n")
    text = lines if header is None else F.concat(F.lit(header + "\n"), lines)
    whole = df.groupBy("month").agg(text.alias("value"))
    whole.write.partitionBy("month").text(root)
    return root


_BROKEN = "CASE o_orderkey % 10 WHEN 0 THEN 'extra' WHEN 1 THEN 'short' WHEN 2 THEN 'type' ELSE 'good' END"


@checked(
    f"""
WITH kinds AS (SELECT *, {_BROKEN} AS kind FROM orders)
SELECT CASE kind WHEN 'good' THEN o_orderkey END AS k, CASE kind WHEN 'good' THEN o_custkey END AS c,
  CASE kind WHEN 'good' THEN o_orderstatus END AS s,
  CASE kind WHEN 'extra' THEN o_orderkey || ',' || o_custkey || ',' || o_orderstatus || ',more'
    WHEN 'short' THEN o_orderkey || ',' || o_custkey WHEN 'type' THEN o_orderkey || ',none,' || o_orderstatus END AS text
FROM kinds
"""
)
def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = """CASE kind WHEN 'extra' THEN concat_ws(',', o_orderkey, o_custkey, o_orderstatus, 'more')
      WHEN 'short' THEN concat_ws(',', o_orderkey, o_custkey) WHEN 'type' THEN concat_ws(',', o_orderkey, 'none', o_orderstatus)
      ELSE concat_ws(',', o_orderkey, o_custkey, o_orderstatus) END"""
    orders = table(spark, sf_dir, "orders").withColumn("kind", F.expr(_BROKEN)).withColumn("month", F.date_format("o_orderdate", "yyyyMM"))
    root = _write_lines(orders.select("month", F.expr(line).alias("line")), "csv-lines", "k,c,s")
    rows = malformed.read_permissive(spark, root, "csv", "k bigint, c bigint, s string", encoding="UTF-8", multi_line=False)
    good, bad = malformed.split_malformed(rows.persist())
    return good.select("k", "c", "s", F.lit(None).cast("string").alias("text")).unionByName(
        bad.select("text"), allowMissingColumns=True
    )


@checked(
    f"""
WITH kinds AS (SELECT *, {_BROKEN} AS kind FROM orders)
SELECT CASE WHEN kind IN ('good', 'extra') THEN o_orderkey END AS k, CASE WHEN kind IN ('good', 'extra') THEN o_orderstatus END AS s,
  CASE kind WHEN 'short' THEN '{{"k":' || o_orderkey || ',"s":"' || o_orderstatus
    WHEN 'type' THEN '[' || o_orderkey || ' "' || o_orderstatus || '"]' END AS text
FROM kinds
"""
)
def json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = """CASE kind WHEN 'short' THEN concat('{"k":', o_orderkey, ',"s":"', o_orderstatus)
      WHEN 'type' THEN concat('[', o_orderkey, ' "', o_orderstatus, '"]')
      WHEN 'extra' THEN concat('{"k":', o_orderkey, ',"s":"', o_orderstatus, '","more":1}')
      ELSE concat('{"k":', o_orderkey, ',"s":"', o_orderstatus, '"}') END"""
    orders = table(spark, sf_dir, "orders").withColumn("kind", F.expr(_BROKEN)).withColumn("month", F.date_format("o_orderdate", "yyyyMM"))
    root = _write_lines(orders.select("month", F.expr(line).alias("line")), "json-lines")
    good, bad = malformed.split_malformed(malformed.read_permissive(spark, root, "json", "k bigint, s string").persist())
    return good.select("k", "s", F.lit(None).cast("string").alias("text")).unionByName(
        bad.select("text"), allowMissingColumns=True
    )


@checked(
    """
SELECT o_orderkey::VARCHAR AS k, o_custkey::VARCHAR AS c,
  CASE WHEN month(o_orderdate) % 3 <> 2 THEN o_orderstatus END AS s,
  CASE WHEN month(o_orderdate) % 3 = 2 THEN o_orderpriority END AS p
FROM orders
"""
)
def csv_header_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with the columns k, c, s, files with s, k, c, and files with p, c, k."""
    orders = table(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyyMM"))
    root = scratch_path(spark, "headers")
    columns = {0: ("o_orderkey k", "o_custkey c", "o_orderstatus s"), 1: ("o_orderstatus s", "o_orderkey k", "o_custkey c"),
               2: ("o_orderpriority p", "o_custkey c", "o_orderkey k")}
    for third, names in columns.items():
        own = orders.filter(F.month("o_orderdate") % 3 == third).selectExpr("month", *names)
        own.hint("rebalance", "month").write.mode("append").partitionBy("month").options(**CSV_TEXT).csv(root)
    return malformed.read_by_header(spark, root).select("k", "c", "s", "p")


@checked(
    f"""
WITH {FILED_SQL}
SELECT event_id, user_id, event_type, filed_at AS "ingestionDateTime" FROM filed
"""
)
def stream_repeated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file comes under a second name, some before and some after a restart."""
    events = filed_events(spark, sf_dir).select("event_id", "user_id", "event_type", "filed_at")
    source = write_tree(events.filter("event_id % 3 <> 0"), "repeated")
    write_tree(events.filter("event_id % 3 = 1"), "repeated", root=source)
    target, marks = scratch_path(spark, "repeated-target"), scratch_path(spark, "repeated-marks")

    def append(batch: DataFrame, number: int) -> None:
        # A batch that is repeated replaces its own rows.
        batch.drop("path").withColumn("batch", F.lit(number)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch").parquet(target)

    schema = "event_id bigint, user_id bigint, event_type string"
    for late in ((), ("event_id % 3 = 2", "event_id % 3 = 0", "event_id % 3 = 0")):
        for some in late:
            write_tree(events.filter(some), "repeated", root=source)
        query = stream_upsert(
            spark, source, schema, target, ["event_id"], marks, fmt="parquet", repeated_within="60 days", append=append
        )
        query.awaitTermination()
    return spark.read.parquet(target).select("event_id", "user_id", "event_type", INGESTION)


@checked(
    """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END AS ing, true AS unmoved
FROM orders
"""
)
def bucketed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two merges into a table that holds six sevenths of the orders; keys have nulls."""
    name, keys = f"bucketed_{uuid.uuid4().hex}", ["o_orderkey", "o_custkey"]
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(key % 3 != 0, F.col("o_custkey")).alias("o_custkey"), "o_totalprice", F.lit(1).alias("ing")
    )
    bucketed.create_bucketed(orders.filter(key % 7 != 0), name, keys, 8, ["ing"])
    newer = orders.filter(key % 5 == 0).withColumns({"o_totalprice": F.lit(0.0), "ing": F.lit(2)})
    older = orders.withColumns({"o_totalprice": F.when(key % 7 == 0, F.col("o_totalprice")).otherwise(-1.0), "ing": F.when(key % 7 == 0, 1).otherwise(0)})
    for delta in (older, newer):
        moved = bucketed.merged_with_buckets(spark.table(name), delta, keys, ["ing"])
        plan = moved._jdf.queryExecution().executedPlan().toString()
        # The stored side is the first: its scan has nothing but sorts and projections above it.
        unmoved = "Exchange" not in plan.split("FileScan", 1)[0]
        bucketed.merge_bucketed(delta, name, keys, 8, ["ing"])
    rows = bucketed.read_bucketed(spark, name).withColumn("unmoved", F.lit(unmoved))
    path = scratch_path(spark, "bucketed")
    rows.write.parquet(path)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)
