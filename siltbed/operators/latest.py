"""Newest rows per key, newest file per partition, and change summaries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window, functions as F, types as T

from siltbed.fixed_values import (
    EXTRACT,
    INGESTION,
    METADATA_COLUMNS,
    PATH,
    RECENCY,
    SUMMARY_DATE_FORMAT,
)
from siltbed.functions.paths import dates_from_path
from siltbed.operators.columns import quoted, sanitise_columns
from siltbed.session import broadcast_if_small

_UNORDERED = (T.MapType, T.VariantType)


def key_columns(
    df: DataFrame,
    keys: Iterable[str] | None,
    extra_keys: Iterable[str] = (),
    skip: Iterable[str] = (),
) -> list[str]:
    """Window key: ``keys``, or every data column when there are none, then extras."""
    ignored = {*METADATA_COLUMNS, *skip}
    base = list(keys or ()) or [c for c in df.columns if c not in ignored]
    chosen = list(dict.fromkeys([*base, *extra_keys]))
    if not chosen:
        raise ValueError("no key columns: all rows would compete in one group")
    return chosen


def latest_rows(
    df: DataFrame,
    keys: Iterable[str] | None = None,
    extra_keys: Iterable[str] = (),
    order: Iterable[str] = RECENCY,
    tie_breakers: Iterable[str] | None = None,
) -> DataFrame:
    """Keep the newest row of each key; without keys, of each distinct data row.

    Ties fall to ``tie_breakers`` (by default every other sortable column), all
    descending, so that a rerun keeps the same row. Spark limits each map task
    to one row per key before the shuffle, so a hot key does not pile up.
    """
    order = list(order)
    partition = key_columns(df, keys, extra_keys, skip=order)
    if tie_breakers is None:
        taken = {*partition, *order}
        tie_breakers = [
            f.name
            for f in df.schema
            if f.name not in taken and not _holds(f.dataType, _UNORDERED)
        ]
    newest_first = [quoted(c).desc() for c in dict.fromkeys([*order, *tie_breakers])]
    window = Window.partitionBy(*[quoted(c) for c in partition]).orderBy(*newest_first)
    rank = "__latest_rank"
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


def _holds(data_type: T.DataType, kinds: tuple[type, ...]) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _holds(data_type.elementType, kinds)
    if isinstance(data_type, T.StructType):
        return any(_holds(f.dataType, kinds) for f in data_type)
    return isinstance(data_type, kinds)


def _newest_file(df: DataFrame, partition_col: str) -> DataFrame:
    # Both aggregates keep primitive buffers, so they hash instead of sorting and
    # combine before the shuffle. The first leaves each ingestion time once per
    # partition, which makes the second unambiguous.
    # Rows without a time are dropped last: an earlier filter would be pushed
    # below the parsing of the path and parse it a second time.
    known = df.filter(quoted(partition_col).isNotNull())
    per_file = known.groupBy(quoted(partition_col).alias(partition_col), INGESTION).agg(
        F.max(EXTRACT).alias(EXTRACT)
    )
    return (
        per_file.withColumnRenamed(INGESTION, "__ingested")
        .groupBy(quoted(partition_col).alias(partition_col))
        .agg(F.max("__ingested").alias(INGESTION), F.max_by(EXTRACT, "__ingested").alias(EXTRACT))
        .filter(F.col(INGESTION).isNotNull())
    )


def latest_files(df: DataFrame, partition_col: str) -> DataFrame:
    """Per partition the newest ingestion and the newest extract within it, sorted."""
    return (
        _newest_file(df, partition_col)
        .withColumnsRenamed({INGESTION: "maxIngestionDate", EXTRACT: "maxExtractDate"})
        .orderBy(quoted(partition_col))
    )


def rows_of_latest_file(df: DataFrame, partition_col: str = "partitionKey") -> DataFrame:
    """All rows of each partition's newest file, names sanitised, metadata last.

    Rows without times get them from their path, which is parsed once per file.
    The small side of the join is measured before it is broadcast.
    """
    if {INGESTION, EXTRACT} <= set(df.columns):
        keys, newest = [partition_col, INGESTION, EXTRACT], _newest_file(df, partition_col)
    else:
        keys, newest = [partition_col, PATH], _newest_paths(df, partition_col)
    joined = df.join(broadcast_if_small(newest), keys)
    added = [c for c in newest.columns if c not in df.columns]
    return sanitise_columns(
        joined.select(*[quoted(c) for c in [*df.columns, *added]]), metadata_last=True
    )


def _newest_paths(df: DataFrame, partition_col: str) -> DataFrame:
    partition = quoted(partition_col)
    paths = df.filter(partition.isNotNull()).select(partition, PATH).distinct()
    dated = dates_from_path(paths).filter(F.col(INGESTION).isNotNull())
    newest_first = Window.partitionBy(partition).orderBy(*[F.desc(c) for c in RECENCY])
    rank = "__file_rank"
    ranked = dated.withColumn(rank, F.rank().over(newest_first))
    return ranked.filter(F.col(rank) == 1).drop(rank)


def partition_changes(df: DataFrame, date_cols: Iterable[str], table: str) -> DataFrame:
    """One row per partition: a path to look at, newest times, table and location."""
    date_cols = list(date_cols)
    # Path is a grouping column first: a string maximum or minimum would make
    # Spark sort all rows, here it only sorts one row per partition and file.
    per_file = df.groupBy(*date_cols, PATH).agg(
        F.max(EXTRACT).alias(EXTRACT), F.max(INGESTION).alias(INGESTION)
    )
    default = F.lit("__HIVE_DEFAULT_PARTITION__")
    location = F.concat_ws(
        "/",
        *[
            F.concat(F.lit(f"{c}="), F.coalesce(quoted(c).cast("string"), default))
            for c in date_cols
        ],
    )
    return (
        per_file.groupBy(*date_cols)
        .agg(
            F.min(PATH).alias(PATH),
            F.max(EXTRACT).alias("maxExtractDate"),
            F.max(INGESTION).alias("maxIngestionDateTime"),
        )
        .orderBy(*date_cols)
        .select(
            PATH,
            "maxExtractDate",
            "maxIngestionDateTime",
            F.lit(table).alias("CuratedTableName"),
            location.alias("PartitionLocation"),
        )
    )


def run_summary(
    files: DataFrame, ingestion: str = INGESTION, extract: str = EXTRACT
) -> DataFrame:
    """JSON with the newest extract and ingestion time; now when there are no files."""
    newest = files.agg(F.max(extract).alias("extract"), F.max(ingestion).alias("ingestion"))
    now = F.current_timestamp().cast("timestamp_ntz")

    def rendered(name: str):
        time = F.coalesce(F.col(name).cast("timestamp_ntz"), now)
        clock = F.substring(time.cast("string"), len("yyyy-MM-dd ") + 1, len("HH:mm:ss"))
        return F.concat_ws(" ", F.date_format(time.cast("date"), SUMMARY_DATE_FORMAT), clock)

    summary = F.struct(
        rendered("extract").alias("max_extract_date"),
        rendered("ingestion").alias("max_ingestion_date"),
    )
    return newest.select(F.to_json(summary).alias("summary"))
