"""Writing to a database."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from siltbed.operators.latest import partition_changes


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    properties: Mapping[str, str] | None = None,
    truncate: bool = False,
    num_partitions: int | None = None,
    batch_size: int | None = None,
) -> None:
    """Write ``df`` to a table; ``num_partitions`` bounds the open connections."""
    writer = df.write.format("jdbc").mode(mode).options(**(properties or {}))
    writer = writer.option("url", url).option("dbtable", table)
    if truncate:
        writer = writer.option("truncate", "true")
    if num_partitions is not None:
        writer = writer.option("numPartitions", str(num_partitions))
    if batch_size is not None:
        writer = writer.option("batchsize", str(batch_size))
    writer.save()


def copy_to_jdbc(
    spark: SparkSession, path: str, url: str, table: str, **options: object
) -> None:
    """Overwrite a database table with a curated Parquet table."""
    write_jdbc(spark.read.parquet(path), url, table, **options)


def log_partition_changes(
    df: DataFrame,
    date_cols: Iterable[str],
    table: str,
    url: str,
    log_table: str,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Append one row per changed partition of ``table`` to a log in the database."""
    write_jdbc(partition_changes(df, date_cols, table), url, log_table, "append", properties)
