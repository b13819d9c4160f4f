"""Writing lake tables: append, overwrite, upsert and full merge."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from siltbed.fixed_values import (
    METADATA_COLUMNS,
    PARTITION_DATE,
    PARTITION_KEY,
    RECENCY,
    SCHEME_COLUMNS,
)
from siltbed.functions.paths import dates_from_path
from siltbed.operators.columns import format_metadata, quoted
from siltbed.operators.latest import key_columns, latest_rows
from siltbed.operators.merge import delta_partitions, touched_partitions, union_delta
from siltbed.operators.partitions import (
    calendar_columns,
    coarsen_key,
    date_hierarchy,
    level_columns,
)
from siltbed.sources import storage

FROM_DELTA = "__from_delta"
Watch = Callable[[DataFrame], DataFrame]


def unwatched(df: DataFrame) -> DataFrame:
    return df


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: Iterable[str],
    dynamic: bool = False,
) -> None:
    """Overwrite ``path``, or with ``dynamic`` only the partitions ``df`` has rows for.

    A rebalance hint brings each partition's rows into few files,
    and lets adaptive execution split a partition that holds a large share of
    all rows over several tasks.
    """
    cols = list(partition_cols)
    stored = storable(df, cols).hint("rebalance", *[quoted(c) for c in cols])
    (
        stored.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(*cols)
        .parquet(path)
    )


def storable(df: DataFrame, cols: list[str]) -> DataFrame:
    # Empty text is stored in the directory of nulls, so it must also match it.
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    blank = {c: F.when(quoted(c) != "", quoted(c)) for c in cols if c in text}
    return df.withColumns(blank) if blank else df


def read_table(
    spark: SparkSession, path: str, partition_types: Mapping[str, T.DataType]
) -> DataFrame:
    """A stored table whose partition values keep the given types (``'007'`` stays text)."""
    inferred = spark.read.parquet(path)
    schema = T.StructType(
        [T.StructField(f.name, partition_types.get(f.name, f.dataType)) for f in inferred.schema]
    )
    if schema == inferred.schema:
        return inferred
    return spark.read.schema(schema).parquet(path)


def append_standardised(df: DataFrame, path: str, level: str = "Month") -> None:
    """Append rows below the calendar columns of their ingestion time. No shuffle."""
    dated = date_hierarchy(df, level)
    dated.write.mode("append").partitionBy(*level_columns(level)).parquet(path)


def overwrite_snapshot(
    df: DataFrame,
    path: str,
    keys: Iterable[str] | None = None,
    order: Iterable[str] = RECENCY,
    tie_breakers: Iterable[str] | None = None,
    watch: Watch = unwatched,
) -> None:
    """Replace the table at ``path`` by the newest row of each key.

    ``watch`` sees the frame that is written, here and in the other sinks. As all replacements of a whole table, the result is written beside the old
    table and then swapped in, so a failure leaves the old table in place.
    """
    newest = latest_rows(df, keys, order=order, tie_breakers=tie_breakers)
    _replace(watch(format_metadata(newest)), path)


def _replace(df: DataFrame, path: str, partition_cols: Iterable[str] = ()) -> None:
    spark = df.sparkSession
    storage.recover(spark, path)
    if partition_cols:
        write_partitioned(df, storage.next_version(path), partition_cols)
    else:
        df.write.mode("overwrite").parquet(storage.next_version(path))
    storage.swap_in(spark, path)


def overwrite_partitions(
    df: DataFrame,
    path: str,
    keys: Iterable[str] | None,
    partition_cols: Iterable[str],
    order: Iterable[str] = RECENCY,
    tie_breakers: Iterable[str] | None = None,
    extra_keys: Iterable[str] = (),
    watch: Watch = unwatched,
) -> None:
    """Replace a partitioned table by the newest row of each key."""
    cols = list(partition_cols)
    newest = latest_rows(df, keys, extra_keys, order, tie_breakers)
    _replace(watch(format_metadata(without_key(newest, cols))), path, cols)


def without_key(df: DataFrame, partition_cols: list[str]) -> DataFrame:
    return df.drop(*[c for c in (PARTITION_KEY, PARTITION_DATE) if c not in partition_cols])


def upsert_partitions(
    delta: DataFrame,
    path: str,
    keys: Iterable[str] | None,
    partition_cols: Iterable[str],
    order: Iterable[str] = RECENCY,
    watch: Watch = unwatched,
) -> None:
    """Merge ``delta`` into the partitions it touches and rewrite only those.

    The newest row wins per key and partition, the delta on a tie, so applying a
    delta twice changes nothing. A table that does not exist yet is created. A delta of
    several batches has their numbers, from 1, in ``FROM_DELTA``: on a tie the later one wins, as if
    they were merged one by one. Such a delta is read again rather than persisted.
    """
    spark, cols, order = delta.sparkSession, list(partition_cols), list(order)
    keys = [k for k in keys or () if k != PARTITION_KEY]
    delta = storable(format_metadata(without_key(delta, cols)), cols)
    if not storage.has_data(spark, path):
        write_partitioned(watch(newest_of(delta, keys, cols, order)), path, cols)
        return
    types = {f.name: f.dataType for f in delta.schema if f.name in cols}
    current = read_table(spark, path, types)
    # Read for its partitions and again for the merge.
    delta = delta if FROM_DELTA in delta.columns else delta.persist()
    try:
        found = delta_partitions(current, delta, cols).collect()
        if found:
            touched = touched_partitions(current, delta, cols, found)
            newest = merged(touched, delta, keys, cols, order)
            write_partitioned(watch(newest), path, cols, dynamic=True)
    finally:
        delta.unpersist()


def newest_of(delta: DataFrame, keys: list[str], extra_keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key of a delta, of its last batch on a tie."""
    last = [FROM_DELTA] if FROM_DELTA in delta.columns else []
    return latest_rows(delta, keys, extra_keys, [*order, *last]).drop(*last)


def merged(
    current: DataFrame, delta: DataFrame, keys: list[str], extra_keys: list[str], order: list[str]
) -> DataFrame:
    if FROM_DELTA not in delta.columns:
        delta = delta.withColumn(FROM_DELTA, F.lit(1))
    both = union_delta(current.withColumn(FROM_DELTA, F.lit(0)), delta)
    partition = key_columns(both, keys, extra_keys, skip=[FROM_DELTA, *order])
    return latest_rows(both, partition, order=[*order, FROM_DELTA]).drop(FROM_DELTA)


def merge_full(
    delta: DataFrame,
    path: str,
    keys: Iterable[str] | None,
    extra_keys: Iterable[str] = (),
    order: Iterable[str] = RECENCY,
    allow_missing: bool = False,
    watch: Watch = unwatched,
) -> None:
    """Merge ``delta`` with the whole unpartitioned table at ``path``.

    The result is written beside the table and then swapped in, so a failure
    leaves the old table in place.
    """
    spark, order, keys = delta.sparkSession, list(order), list(keys or ())
    delta = format_metadata(delta)
    storage.recover(spark, path)
    if storage.has_data(spark, path):
        current = spark.read.parquet(path)
        if allow_missing:
            absent = [f for f in current.schema if f.name not in delta.columns]
            delta = delta.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
        newest = merged(current, delta, keys, list(extra_keys), order)
    else:
        newest = latest_rows(delta, keys, extra_keys, order)
    _replace(watch(newest), path)


def json_table_path(zone: str, source: str) -> str:
    return f"{zone.rstrip('/')}/json/{source}/schema=v1/partition=Latest"


def write_json_latest(
    df: DataFrame,
    source: str,
    curated: str,
    standardised: str,
    append: Callable[[DataFrame, str], None] | None = None,
    watch: Watch = unwatched,
) -> None:
    """Append a JSON table to the standardised zone and replace its curated copy.

    ``append`` may add the rows in another way, such as once for each raw file.
    """
    rest = [c for c in df.columns if c not in METADATA_COLUMNS]
    dated = dates_from_path(df).select(*METADATA_COLUMNS, *[quoted(c) for c in rest])
    table = format_metadata(dated).persist()
    try:
        target = json_table_path(standardised, source)
        if append is not None:
            append(table, target)
        else:
            table.write.mode("append").parquet(target)
        _replace(watch(table), json_table_path(curated, source))
    finally:
        table.unpersist()


def rewrite_by_month(
    spark: SparkSession, source: str, target: str, key_col: str = PARTITION_KEY
) -> None:
    """Rewrite a table partitioned by day into one partitioned by month.

    The month comes from ``key_col``, or from stored calendar columns if the
    table no longer has its key. A table is not rewritten onto itself.
    """
    if storage.qualified(spark, source).rstrip("/") == storage.qualified(spark, target).rstrip("/"):
        raise ValueError(f"{source} can't be rewritten onto itself")
    table = spark.read.parquet(source)
    months = SCHEME_COLUMNS["YYYYMM"]
    if key_col in table.columns:
        monthly = calendar_columns(coarsen_key(table, key_col), key_col, "YYYYMM")
        table = monthly.drop(PARTITION_DATE)
    elif not set(months) <= set(table.columns):
        raise ValueError(f"{source} has neither {key_col} nor {', '.join(months)}")
    write_partitioned(table, target, months)
