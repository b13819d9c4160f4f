"""Reading from a database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    properties: Mapping[str, str] | None = None,
    alias: str = "q",
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """A table, or a ``SELECT`` that the database runs, as a DataFrame.

    Give ``partition_column``, ``bounds`` and ``num_partitions`` for a large
    result; without them it arrives through one connection.
    """
    text = query.strip()
    relation = f"({text}) {alias}" if text.lower().startswith("select") else text
    reader = spark.read.format("jdbc").options(**(properties or {}))
    reader = reader.option("url", url).option("dbtable", relation)
    if partition_column is not None:
        if bounds is None or num_partitions is None:
            raise ValueError("partition_column needs bounds and num_partitions")
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(num_partitions),
        )
    return reader.load()
