"""Checked queries over repeated loads: bounded scans, the ledger, batches, configuration."""

from __future__ import annotations

import contextlib
import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltbed.checks.inputs import CSV_TEXT, FILED_SQL, filed_events, table, write_tree
from siltbed.checks.registry import checked
from siltbed.fixed_values import INGESTION
from siltbed.functions.paths import dates_from_path
from siltbed.plans import catalog
from siltbed.plans.load import LoadOptions, load_dataset, load_table
from siltbed.plans.spec import TableSpec
from siltbed.session import scratch_path
from siltbed.sinks.lake import append_standardised
from siltbed.sinks.ledger import append_once
from siltbed.sources.files import file_inventory, raw_subtrees, read_raw, this_instant

MARK = dt.datetime(2024, 1, 20, 12)


@checked(
    f"""
WITH {FILED_SQL},
early AS (SELECT * FROM filed WHERE event_id % 3 <> 0 AND filed_at > TIMESTAMP '2024-01-20 12:00:00')
SELECT event_id, user_id, filed_at AS "ingestionDateTime",
  (SELECT count(DISTINCT filed_at) FROM early) AS times
FROM early
"""
)
def bounded_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, early = filed_events(spark, sf_dir), F.col("event_id") % 3 != 0
    root = write_tree(events.filter(early), "bounded")
    before = this_instant()
    write_tree(events.filter(~early), "bounded", root=root)
    files = file_inventory(spark, root, "*.parquet", after=MARK, before=before)
    times = files.agg(F.countDistinct("ingestionDate")).first()[0]
    rows = read_raw(spark, raw_subtrees(spark, root, after=MARK), "parquet", before=before)
    dated = dates_from_path(rows).select("event_id", "user_id", INGESTION)
    return dated.withColumn("times", F.lit(times).cast("bigint"))


RETRY_SPEC = TableSpec(
    name="retried",
    raw_paths=(),
    curated_path="Retried",
    scheme="YYYYMM",
    role="Recent",
    keys=("event_id",),
    columns=("event_id", "user_id", "PartitionKey"),
)


def _event_csv(spark: SparkSession, events: DataFrame, name: str, root: str | None = None) -> str:
    keyed = events.withColumn("PartitionKey", F.date_format("ts", "yyyyMM")).drop("ts")
    return write_tree(keyed, name, "csv", root=root, **CSV_TEXT)


@checked(
    f"""
WITH {FILED_SQL}
SELECT zone, event_id, user_id, filed_at AS "ingestionDateTime",
  CAST(year(filed_at) AS INTEGER) AS "Year", CAST(month(filed_at) AS INTEGER) AS "Month"
FROM filed, (VALUES ('loads'), ('appends')) AS zones(zone)
"""
)
def standardised_append_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, events = scratch_path(spark, "retry-lake"), filed_events(spark, sf_dir)
    raw = _event_csv(spark, events.filter("event_id % 2 = 0"), "retry")
    broken = TableSpec(**{**RETRY_SPEC.__dict__, "role": "Unknown"})
    with contextlib.suppress(ValueError):  # fails after its append
        load_table(spark, broken, lake, [raw])
    load_table(spark, RETRY_SPEC, lake, [raw])
    _event_csv(spark, events.filter("event_id % 2 = 1"), "retry", raw)
    load_table(spark, RETRY_SPEC, lake, [raw])
    load_table(spark, RETRY_SPEC, lake, [raw])

    # The same rows by a bare append that stops once after its rows are in the table.
    rows = dates_from_path(read_raw(spark, raw)).select("event_id", "user_id", "path", INGESTION)
    path, ledger = scratch_path(spark, "retry-appends"), scratch_path(spark, "retry-ledger")

    def stopped(df: DataFrame, target: str) -> None:
        append_standardised(df.filter("event_id % 3 <> 1"), target)
        raise InterruptedError

    with contextlib.suppress(InterruptedError):
        append_once(rows, path, ledger, "t", append=stopped)
    append_once(rows, path, ledger, "t")
    append_once(rows, path, ledger, "t")
    stored = [
        spark.read.parquet(p).select(
            F.lit(zone).alias("zone"),
            F.col("event_id").cast("bigint"),
            F.col("user_id").cast("bigint"),
            INGESTION,
            "Year",
            "Month",
        )
        for zone, p in (("loads", f"{lake}/standardised/retried"), ("appends", path))
    ]
    return stored[0].unionByName(stored[1])


BATCH = 200_000


@checked(
    f"""
WITH file AS (
  SELECT o_orderpriority AS load, 'f' || o_orderkey AS path, o_orderdate AS time, greatest(floor(o_totalprice)::BIGINT, 1) AS size
  FROM orders
),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY load ORDER BY time, substr(md5(path), 1, 1), path
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM file
),
slotted AS (
  SELECT *, 2 * (start // {BATCH}) + CASE WHEN start // {BATCH} <> (start + size - 1) // {BATCH} THEN 1 ELSE 0 END AS slot
  FROM placed
),
batched AS (
  SELECT load, path, size, dense_rank() OVER (PARTITION BY load ORDER BY slot)::INTEGER - 1 AS batch FROM slotted
)
SELECT *, sum(size) OVER own <= {BATCH} OR count(*) OVER own = 1 AS bounded FROM batched WINDOW own AS (PARTITION BY load, batch)
"""
)
def size_bounded_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("load"),
        F.concat(F.lit("f"), "o_orderkey").alias("path"),
        F.col("o_orderdate").alias("time"),
        F.floor("o_totalprice").cast("bigint").alias("size"),
    )
    dealt = catalog.size_batches(files, BATCH, ["load"], "size", "time", "path")
    sums = dealt.groupBy("load", "batch").agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("files"))
    bounded = ((F.col("total") <= BATCH) | (F.col("files") == 1)).alias("bounded")
    return dealt.join(sums, ["load", "batch"]).select("load", "path", "size", "batch", bounded)


def _two_run_config(spark: SparkSession, raw: str, notes: str) -> dict[str, DataFrame]:
    fields = (
        "DatasetName", "DataLakePathRaw", *catalog.GROUP_COLUMNS, "Separator", "Encoding", "HtmlColumnList", "CoarsenKey"
    )
    load = ("shop", raw, "visits", "read_csv", "Visits", "ext_shop", "v", "[user_id]", "Lake", "Recent", "YYYYMM")
    return {
        "datasets": spark.createDataFrame(
            [("shop", None, "csv", "shop")],
            "DatasetName string, MaxIngestionDateTime timestamp_ntz, FlatFileExtension string, SchemaName string",
        ),
        "tables": spark.createDataFrame(
            [(*load, "|", "UTF-8", "[event_type]", "true")], ", ".join(f"{f} string" for f in fields)
        ),
        "columns": spark.createDataFrame(
            [
                ("shop", "visits", number, column, "none" if column == "note" else None)
                for number, column in enumerate(("event_id", "user_id", "event_type", "PartitionKey", "note"))
            ],
            "DatasetName string, CuratedTableName string, ColumnId int, ColumnName string, ReplaceMissingWith string",
        ),
        "json_tables": spark.createDataFrame(
            [("shop", "notes", notes)], "DatasetName string, JsonTableName string, DataLakePathRaw string"
        ),
    }


@checked(
    f"""
WITH {FILED_SQL},
visit AS (
  SELECT event_id, user_id, event_type, 'none' AS note, strftime(ts, '%Y%m') AS key, filed_at,
    strftime(filed_at, 'year=%Y/month=%m/day=%d/hour=%H/minute=%M') AS folder
  FROM filed
),
curated AS (
  SELECT * FROM visit QUALIFY row_number() OVER (
    PARTITION BY user_id, substr(key, 1, 4), substr(key, 5) ORDER BY filed_at DESC, event_id::VARCHAR DESC) = 1
),
summary AS (
  SELECT to_json({{
    max_extract_date: strftime(max(filed_at), '%d %B %Y %H:%M:%S'),
    max_ingestion_date: strftime(max(filed_at), '%d %B %Y %H:%M:%S')
  }})::VARCHAR AS summary FROM filed
)
SELECT 'curated' AS zone, event_id, user_id, event_type, note, folder,
  strftime(filed_at, '%Y-%m-%d %H:%M:%S') AS "ingestionDateTime", strftime(filed_at, '%Y-%m-%d %H:%M:%S') AS "extractDateTime",
  substr(key, 1, 4) || '/' || substr(key, 5)::INTEGER AS part, summary FROM curated, summary
UNION ALL
SELECT 'standardised', event_id, user_id, '<b>' || event_type || '</b>', note, folder,
  strftime(filed_at, '%Y-%m-%d %H:%M:%S'), strftime(filed_at, '%Y-%m-%d %H:%M:%S'),
  year(filed_at) || '/' || month(filed_at), summary FROM visit, summary
UNION ALL
SELECT 'json', event_id, NULL, props, NULL, folder,
  strftime(filed_at, '%Y-%m-%d %H:%M:%S'), strftime(filed_at, '%Y-%m-%d %H:%M:%S'), NULL, summary
FROM (SELECT v.*, f.props FROM visit v JOIN filed f USING (event_id)), summary
WHERE filed_at >= TIMESTAMP '2024-01-20 12:00:00'
"""
)
def load_dataset_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files before the mark are loaded first, the others in a second run, both in small batches."""
    lake, events = scratch_path(spark, "runs-lake"), filed_events(spark, sf_dir)
    tagged = events.withColumn("event_type", F.concat(F.lit("<b>"), "event_type", F.lit("</b>")))
    tagged = tagged.withColumn("Partitionkey", F.date_format("ts", "yyyyMMdd")).drop("ts", "props")
    notes = events.select("event_id", "props", "filed_at")
    late = F.col("filed_at") >= F.lit(MARK)
    text = {**CSV_TEXT, "encoding": "UTF-8", "sep": "|"}
    raw = write_tree(tagged.filter(~late), "runs", "csv", **text)
    json_raw = write_tree(notes.filter(~late), "runs-json", "json")
    config = _two_run_config(spark, raw, json_raw)
    options = LoadOptions(batch_bytes=64 << 10)
    load_dataset(spark, lake, dataset="shop", options=options, parallel=2, by_extension=True, **config)
    write_tree(tagged.filter(late), "runs", "csv", root=raw, **text)
    write_tree(notes.filter(late), "runs-json", "json", root=json_raw)
    mark = MARK - dt.timedelta(minutes=1)
    for _ in range(2):  # repeating a run changes nothing
        summary = load_dataset(
            spark, lake, dataset="shop", since=mark, options=options, parallel=2, by_extension=True, **config
        )
    json.loads(summary)

    def shown(path: str, zone: str, kind: str, part, **others) -> DataFrame:
        stored = spark.read.parquet(f"{lake}/{path}")
        folder = F.regexp_extract("path", "/(year=[^/]+(?:/[^/=]+=[^/]+)+)/[^/]+$", 1)
        times = [F.substring(F.col(c).cast("string"), 1, 19).alias(c) for c in (INGESTION, "extractDateTime")]
        user, note = others.get("user_id", F.col("user_id")), others.get("note", F.col("note"))
        return stored.select(
            F.lit(zone).alias("zone"),
            F.col("event_id").cast("bigint"),
            user.cast("bigint").alias("user_id"),
            F.col(kind).alias("event_type"),
            note.cast("string").alias("note"),
            folder.alias("folder"),
            *times,
            part.alias("part"),
            F.lit(summary).alias("summary"),
        )

    month, nothing = F.concat_ws("/", "Year", "Month"), F.lit(None).cast("string")
    curated = shown("curated/Visits", "curated", "event_type", month)
    standardised = shown("standardised/visits", "standardised", "event_type", month)
    latest = "curated/json/notes/schema=v1/partition=Latest"
    from_json = shown(latest, "json", "props", nothing, user_id=nothing, note=nothing)
    return curated.unionByName(standardised).unionByName(from_json)
