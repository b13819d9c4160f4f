"""Inputs of the checked queries, derived from the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltbed.functions.paths import dates_from_path
from siltbed.session import scratch_path

TIME_DIRECTORIES = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH", "minute": "mm"}

# Raw event rows: a path with the event's minute, and for two thirds of the
# rows an extract stamp in the file name.
RAW_SQL = """
raw AS (
  SELECT *,
    strftime(ts, '/lake/raw/app/year=%Y/month=%m/day=%d/hour=%H/minute=%M/') || event_type
      || CASE WHEN event_id % 3 <> 0 THEN strftime(ts, '_%Y%m%d-%H%M%S') ELSE '' END
      || '.csv' AS path,
    date_trunc('minute', ts) AS "ingestionDateTime",
    CASE WHEN event_id % 3 <> 0 THEN date_trunc('second', ts) ELSE date_trunc('minute', ts) END
      AS "extractDateTime"
  FROM events
)
"""

# Half hours of every twelfth hour: the directory an event is filed under.
FILED_SQL = """
filed AS (
  SELECT *,
    date_trunc('day', ts) + to_hours(CAST(floor(hour(ts) / 12) * 12 AS BIGINT))
      + to_minutes(CAST(floor(minute(ts) / 30) * 30 AS BIGINT)) AS filed_at
  FROM events
)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the path of the raw file they would arrive in."""
    folder = F.date_format(
        "ts", "'/lake/raw/app/year='yyyy'/month='MM'/day='dd'/hour='HH'/minute='mm'/'"
    )
    stamp = F.when(F.col("event_id") % 3 != 0, F.date_format("ts", "'_'yyyyMMdd-HHmmss"))
    name = F.concat(folder, "event_type", F.coalesce(stamp, F.lit("")), F.lit(".csv"))
    return table(spark, sf_dir, "events").withColumn("path", name)


def dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates_from_path(raw_events(spark, sf_dir))


def filed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the time of the directory they are filed under."""
    ts = F.col("ts")
    clock = [
        (F.floor(F.hour(ts) / 12) * 12).cast("int"),
        (F.floor(F.minute(ts) / 30) * 30).cast("int"),
        F.lit(0),
    ]
    filed = F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), *clock)
    return table(spark, sf_dir, "events").withColumn("filed_at", filed)


def write_tree(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    below: dict[str, str] | None = None,
    root: str | None = None,
    **options: object,
) -> str:
    """Write ``df`` as raw files in directories named after its ``filed_at``, or add them to ``root``."""
    root = root or scratch_path(df.sparkSession, name)
    folders = {
        **{unit: F.date_format("filed_at", layout) for unit, layout in TIME_DIRECTORIES.items()},
        **{folder: F.col(column) for folder, column in (below or {}).items()},
    }
    (
        df.withColumns(folders)
        .drop("filed_at", *(below or {}).values())
        .hint("rebalance", *folders)
        .write.partitionBy(*folders)
        .options(**options)
        .mode("append")
        .format(fmt)
        .save(root)
    )
    return root


CSV_TEXT = {
    "header": True,
    "encoding": "UTF-16",
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def orders_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with calendar columns and a load number."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.lit(1).alias("ing"),
        F.year("o_orderdate").alias("Year"),
        F.month("o_orderdate").alias("Month"),
    )
