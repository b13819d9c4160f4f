"""Configuration tables as DataFrames, and the table specs made from them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from siltbed.fixed_values import (
    COARSEN_KEY,
    EARLIEST_MARK,
    ENCODING,
    EXTERNAL_SCHEMA_PREFIX,
    FORM_ANSWERS,
    GROUP_COLUMNS,
    HEADER_COLUMNS,
    HTML_COLUMNS,
    JSON_COLUMNS,
    OPTIONAL_COLUMNS,
    SANITISE_NAMES,
    SEPARATOR,
)
from siltbed.functions.keys import parse_key_list
from siltbed.operators.columns import quoted
from siltbed.plans.spec import TableSpec
from siltbed.session import broadcast_if_small


@dataclass(frozen=True)
class DatasetConfig:
    """The configuration tables, narrowed to one dataset and optionally one table."""

    roots: DataFrame
    datasets: DataFrame
    tables: DataFrame
    columns: DataFrame
    json_tables: DataFrame


def read_config(
    read: Callable[[str], DataFrame], dataset: str, table: str | None = None
) -> DatasetConfig:
    """Scan the configuration by table name; ``read`` may use JDBC or files.

    Filters are pushed to the source, be it a database or Parquet.
    """
    return DatasetConfig(
        roots=read("Configuration").select("DataLakeRootFolder"),
        datasets=config_rows(read("Dataset"), dataset).select(*HEADER_COLUMNS),
        tables=config_rows(read("CuratedTable"), dataset, table),
        columns=config_rows(read("CuratedColumn"), dataset, table),
        json_tables=config_rows(read("JsonTable"), dataset),
    )


def config_rows(
    config: DataFrame, dataset: str, table: str | None = None, skip_method: str | None = None
) -> DataFrame:
    """Configuration of one dataset, optionally of one table or without a read method."""
    rows = config.filter(F.col("DatasetName") == dataset)
    if table:
        rows = rows.filter(F.col("CuratedTableName") == table)
    if skip_method is not None:
        rows = rows.filter(F.col("ReadRawFileMethod") != skip_method)
    return rows


def dataset_header(datasets: DataFrame, name: str) -> DataFrame:
    """A dataset's mark (with a default), prefixed schema, raw path and extension."""
    mark = F.coalesce(
        F.col("MaxIngestionDateTime").cast("timestamp_ntz"),
        F.lit(EARLIEST_MARK).cast("timestamp_ntz"),
    )
    columns = [
        mark.alias("MaxIngestionDate"),
        F.concat(F.lit(EXTERNAL_SCHEMA_PREFIX), "SchemaName").alias("ExternalSchemaName"),
        "FlatFileExtension",
    ]
    if "DataLakePathRaw" in datasets.columns:
        columns.insert(2, "DataLakePathRaw")
    return datasets.filter(F.col("DatasetName") == name).select(*columns)


def table_catalog(
    datasets: DataFrame, tables: DataFrame, queries: DataFrame, name: str
) -> DataFrame:
    """Raw and curated paths of every active table query of one dataset."""
    schema = F.concat(F.lit("schema=v"), F.col("t.SchemaVersion").cast("string"), F.lit("/"))
    partition = F.concat(F.lit("partition="), F.col("q.DataLakePartitionCurated"), F.lit("/"))
    chosen = datasets.filter(F.col("DatasetName") == name)
    active = queries.filter(F.col("IsActive").cast("int") == 1)
    return (
        chosen.alias("d")
        .join(tables.alias("t"), F.col("d.DatasetKey") == F.col("t.DatasetKey"))
        .join(active.alias("q"), F.col("t.TableKey") == F.col("q.TableKey"))
        .select(
            F.col("t.TableName"),
            F.concat("d.DataLakePathRaw", "q.DataLakePathRaw", schema, partition).alias(
                "DataLakePathRaw"
            ),
            F.concat("t.DataLakePathCurated", schema, partition).alias("DataLakePathCurated"),
            F.col("q.ReadRawFileMethod"),
            F.col("q.DataLakePartitionCurated"),
        )
    )


def partition_schemes(catalog: DataFrame, column: str = "DataLakePartitionCurated") -> DataFrame:
    """Distinct partition schemes other than ``Latest``."""
    return catalog.select(column).distinct().filter(~F.col(column).eqNullSafe("Latest"))


def ordered_columns(columns: DataFrame) -> DataFrame:
    """Per table its configured column names, once each, by ``ColumnId``.

    Names are made distinct before they are collected, so a list is no longer
    than its table is wide.
    """
    named = columns.dropna(subset=["CuratedTableName"])
    first = named.groupBy("CuratedTableName", "ColumnName").agg(F.min("ColumnId").alias("ColumnId"))
    by_id = F.array_sort(F.collect_list(F.struct("ColumnId", "ColumnName")))
    names = F.transform(by_id, lambda c: c["ColumnName"])
    return first.groupBy("CuratedTableName").agg(names.alias("ColumnNames"))


def column_defaults(columns: DataFrame) -> DataFrame:
    """Per table a map from column name to default; the highest ``ColumnId`` wins."""
    named = columns.dropna(subset=["CuratedTableName", "ColumnName"])
    # Wrapped in a struct so that a null default still counts as the last one.
    last = F.max_by(F.struct("ReplaceMissingWith"), "ColumnId").alias("last")
    single = named.groupBy("CuratedTableName", "ColumnName").agg(last)
    entries = F.collect_list(F.struct("ColumnName", "last.ReplaceMissingWith"))
    return single.groupBy("CuratedTableName").agg(F.map_from_entries(entries).alias("Defaults"))


def files_to_tables(files: DataFrame, tables: DataFrame) -> DataFrame:
    """Each found file with the configuration of every table fed from its raw path.

    The configuration is measured and, as long as it is small, broadcast, so a raw
    path with most of the files is not gathered in one task.
    """
    keys = [c for c in ("DataLakePathRaw", "CuratedTableName") if c in files.columns]
    return files.join(broadcast_if_small(tables), keys)


def load_groups(matched: DataFrame) -> DataFrame:
    """One row per load: the table's settings, its file count and newest times.

    Files are counted, not listed: a load reads directories, so a table with
    most of the files costs the plan no more than any other.
    """
    return (
        matched.dropna(subset=list(GROUP_COLUMNS))
        .groupBy(*GROUP_COLUMNS)
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.max("ingestionDate").alias("maxIngestionDate"),
            F.max("extractDate").alias("maxExtractDate"),
        )
    )


def size_batches(
    files: DataFrame,
    limit: int,
    by: Iterable[str] = (),
    size: str = "fileSize",
    time: str = "ingestionDate",
    path: str = "filePath",
) -> DataFrame:
    """Files with ``batch``, from 0 for each value of ``by``: at most ``limit`` bytes or one file.

    Files lie on a line by their time, oldest first, that is cut every ``limit`` bytes. Files within
    one cut share a batch, and a file across a cut is one by itself, so there are at most
    about twice the batches needed. Where a file lies is a prefix sum in two steps, over the few
    times and then within each of them, in 16 parts by a digest of the path, so no table's
    files are gathered in one task.
    """
    if limit < 1:
        raise ValueError("a batch has at least one byte")
    by = [quoted(c) for c in by]
    part = F.substring(F.md5(quoted(path).cast("binary")), 1, 1)
    sized = files.withColumns({"__part": part, "__size": F.greatest(F.coalesce(quoted(size), F.lit(0)), F.lit(1))})
    group = [*by, quoted(time), F.col("__part")]
    line = Window.partitionBy(*by, F.lit(0)).orderBy(quoted(time), "__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = sized.groupBy(*group).agg(F.sum("__size").alias("__total"))
    before = totals.withColumn("__before", F.coalesce(F.sum("__total").over(line), F.lit(0))).drop("__total")
    names = [c for c in before.columns if c != "__before"]
    renamed = before.select(*[quoted(c).alias(f"__on_{i}") for i, c in enumerate(names)], "__before")
    on = [quoted(c).eqNullSafe(F.col(f"__on_{i}")) for i, c in enumerate(names)]
    # One row for each time, part and value of ``by``.
    placed = sized.join(broadcast_if_small(renamed), on).drop(*[f"__on_{i}" for i in range(len(names))])
    within = Window.partitionBy(*group).orderBy(quoted(path)).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("__before") + F.coalesce(F.sum("__size").over(within), F.lit(0))
    first, last = F.expr(f"__start div {int(limit)}"), F.expr(f"(__start + __size - 1) div {int(limit)}")
    slots = placed.withColumn("__start", start).withColumn("__slot", 2 * first + (first != last).cast("int"))
    used = slots.select(*by, "__slot").distinct()
    numbered = used.withColumn("batch", F.row_number().over(Window.partitionBy(*by, F.lit(0)).orderBy("__slot")) - 1)
    keys = [c for c in numbered.columns if c != "batch"]
    renamed = numbered.select(*[quoted(c).alias(f"__on_{i}") for i, c in enumerate(keys)], "batch")
    on = [quoted(c).eqNullSafe(F.col(f"__on_{i}")) for i, c in enumerate(keys)]
    return slots.join(broadcast_if_small(renamed), on).select(*[quoted(c) for c in files.columns], "batch")


def load_specs(
    tables: DataFrame, columns: DataFrame, dataset: str, table: str | None = None
) -> list[TableSpec]:
    """The specs of a dataset's tables; one configuration row each reaches the driver.

    Raw paths that share all other settings feed one load. Rows with an empty
    setting are left out. Optional columns set a table's separator and encoding, the
    columns that HTML is removed from, and the steps that otherwise follow its name.
    """
    fmt = F.regexp_extract(F.lower("ReadRawFileMethod"), "(csv|json|parquet)", 1)
    configured = config_rows(columns, dataset, table)
    rows = (
        config_rows(tables, dataset, table)
        .dropna(subset=[*GROUP_COLUMNS, "DataLakePathRaw"])
        .groupBy(*GROUP_COLUMNS)
        .agg(
            F.array_sort(F.collect_set("DataLakePathRaw")).alias("raw_paths"),
            *[(F.max(c) if c in tables.columns else F.lit(None)).alias(c) for c in OPTIONAL_COLUMNS],
        )
        .withColumns(
            {
                "fmt": F.when(fmt != "", fmt).otherwise(F.col("ReadRawFileMethod")),
                "keys": parse_key_list("EnrichedBusinessKeyColumnList", "DataLakePartition"),
            }
        )
        .join(ordered_columns(configured), "CuratedTableName", "left")
        .join(column_defaults(configured), "CuratedTableName", "left")
        .orderBy("CuratedTableName", "raw_paths")
        .collect()
    )
    return [
        TableSpec(
            name=r["CuratedTableName"],
            raw_paths=tuple(r["raw_paths"]),
            curated_path=r["DataLakePath"],
            fmt=r["fmt"],
            scheme=r["DataLakePartition"],
            role=r["FlatFileRole"],
            keys=tuple(r["keys"]),
            columns=tuple(r["ColumnNames"] or ()),
            defaults=dict(r["Defaults"] or {}),
            destination=r["DestinationDB"],
            external_schema=r["DestinationDBExternalSchema"],
            external_table=r["DestinationDBExternalTable"],
            sep=r[SEPARATOR] or None,
            encoding=r[ENCODING] or None,
            html=_names(r[HTML_COLUMNS]),
            answers=_flag(r[FORM_ANSWERS]),
            coarsen=_flag(r[COARSEN_KEY]),
            sanitise=_flag(r[SANITISE_NAMES]),
        )
        for r in rows
    ]


def _names(text: str | None) -> tuple[str, ...] | None:
    """Column names from ``[a], [b]``; none if nothing is configured."""
    if text is None:
        return None
    return tuple(n.strip().strip("[]") for n in text.split(",") if n.strip())


def _flag(value: object) -> bool | None:
    return None if value is None else str(value).strip().lower() in ("1", "true", "yes")


def json_specs(json_tables: DataFrame, dataset: str) -> list[TableSpec]:
    """The specs of a dataset's JSON tables: each is replaced by its new files, all read as text.

    Configurations without a name and a raw path for each table have none.
    """
    name, raw = JSON_COLUMNS
    if not {name, raw, "DatasetName"} <= set(json_tables.columns):
        return []
    rows = (
        config_rows(json_tables, dataset)
        .dropna(subset=[name, raw])
        .groupBy(name)
        .agg(F.array_sort(F.collect_set(raw)).alias("raw_paths"))
        .orderBy(name)
        .collect()
    )
    return [TableSpec(r[name], tuple(r["raw_paths"]), f"json/{r[name]}", fmt="json") for r in rows]
