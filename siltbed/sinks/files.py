"""Changing single files of a Parquet table: upserts and compaction that leave the others alone.

New files are written beside the table first. A journal then names them and the files that
they replace, and publishing renames the new ones in and deletes the old ones. A table whose
journal still exists was interrupted while publishing; ``settle`` goes on with it, and every
change begins with that. Without a journal nothing was published and what lies beside the
table is dropped. As with any plain Parquet table, readers should not read while a change
is published. Changes of one table follow each other.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from siltbed.fixed_values import PARTITION_KEY, RECENCY
from siltbed.operators.columns import format_metadata, quoted
from siltbed.operators.latest import key_columns
from siltbed.operators.merge import delta_partitions, touched_partitions
from siltbed.session import broadcast_if_small
from siltbed.sinks.lake import FROM_DELTA, Watch, merged, newest_of, read_table, storable, unwatched, without_key, write_partitioned
from siltbed.sources import storage
from siltbed.sources.files import literal_path

TARGET_BYTES = 128 << 20


def _journal(path: str) -> str:
    return storage.beside(path, "_journal_")


def settle(spark: SparkSession, path: str) -> None:
    """Finish an interrupted change of the table at ``path``, or drop what was not published."""
    staged = storage.next_version(path)
    if storage.exists(spark, _journal(path)):
        _publish(spark, path, json.loads(storage.read_text(spark, _journal(path))))
    storage.delete_folder(spark, staged)


def _publish(spark: SparkSession, path: str, change: dict[str, list[str]]) -> None:
    staged = storage.next_version(path)
    for name in change["new"]:
        storage.move_in(spark, f"{staged}/{name}", f"{path.rstrip('/')}/{name}")
    for name in change["old"]:
        storage.delete(spark, name)
    storage.delete_folder(spark, staged)
    storage.delete_folder(spark, _journal(path))


def replace_files(
    spark: SparkSession, path: str, old: Iterable[str], write: Callable[[str], None]
) -> None:
    """Replace the files ``old`` (as Spark prints them) by what ``write`` writes to a given folder."""
    staged = storage.next_version(path)
    write(staged)
    new = [name for name in storage.files_below(spark, staged) if name.endswith(".parquet")]
    change = {"new": new, "old": list(old)}
    # The journal appears whole, by a rename, or not at all.
    storage.write_text(spark, f"{_journal(path)}{uuid.uuid4().hex}", json.dumps(change), _journal(path))
    _publish(spark, path, change)


def _matches(left: list[str], right: list[str]) -> Column:
    return reduce(and_, [quoted(one).eqNullSafe(quoted(two)) for one, two in zip(left, right)])


def files_with_keys(current: DataFrame, delta: DataFrame, keys: Iterable[str]) -> DataFrame:
    """``path`` of the files of ``current`` that hold a key of ``delta``; reads key columns only.

    Keys are compared as text would be grouped: nulls match nulls. A small delta is broadcast;
    otherwise Spark shuffles the keys, with its own runtime filter on the stored side.
    """
    keys = list(keys)
    names = [f"__delta_{i}" for i in range(len(keys))]
    types = {f.name: f.dataType for f in current.schema}
    asked = delta.select(*[quoted(k).cast(types[k]).alias(n) for k, n in zip(keys, names)]).distinct()
    held = current.select(*[quoted(k) for k in keys], F.col("_metadata.file_path").alias("__file"))
    hit = held.join(broadcast_if_small(asked), _matches(keys, names), "left_semi")
    return hit.select(F.col("__file").alias("path")).distinct()


def upsert_files(
    delta: DataFrame,
    path: str,
    keys: Iterable[str] | None,
    partition_cols: Iterable[str] = (),
    order: Iterable[str] = RECENCY,
    watch: Watch = unwatched,
) -> None:
    """Merge ``delta`` and rewrite only files that hold one of its keys.

    The rows are those of ``upsert_partitions`` for a table with one row for each key and
    partition: the newest wins, the delta on a tie. Files without a key of the delta keep
    their names and times, also within partitions that the delta touches.
    """
    spark, cols, order = delta.sparkSession, list(partition_cols), list(order)
    settle(spark, path)
    keys = [k for k in keys or () if k != PARTITION_KEY]
    delta = storable(format_metadata(without_key(delta, cols)), cols)
    if not storage.has_data(spark, path):
        newest = newest_of(delta, keys, cols, order)
        replace_files(spark, path, [], lambda staged: _write(watch(newest), staged, cols))
        return
    types = {f.name: f.dataType for f in delta.schema if f.name in cols}
    current = read_table(spark, path, types)
    delta = delta if FROM_DELTA in delta.columns else delta.persist()
    try:
        touched = current
        if cols:
            places = delta_partitions(current, delta, cols).collect()
            if not places:
                return
            touched = touched_partitions(current, delta, cols, places)
        match = key_columns(delta, keys, cols, skip=[FROM_DELTA, *order])
        # As many names at most as a rewrite of whole partitions would list.
        hit = [r["path"] for r in files_with_keys(touched, delta, match).collect()]
        stored = read_files(spark, path, hit, current.schema) if hit else current.limit(0)
        newest = merged(stored, delta, keys, cols, order)
        if not delta.isEmpty():
            replace_files(spark, path, hit, lambda staged: _write(watch(newest), staged, cols))
    finally:
        delta.unpersist()


def read_files(spark: SparkSession, path: str, files: Iterable[str], schema: T.StructType) -> DataFrame:
    """Some files of the table at ``path``, with its partition columns."""
    plain = [literal_path(storage.decoded(spark, name)) for name in files]
    return spark.read.schema(schema).option("basePath", path).parquet(*plain)


def _write(df: DataFrame, path: str, cols: list[str]) -> None:
    if cols:
        write_partitioned(df, path, cols)
    else:
        df.write.mode("overwrite").parquet(path)


def _folder(name: Column) -> Column:
    return F.regexp_replace(name, "/[^/]*$", "")


def small_files(spark: SparkSession, path: str, target: int = TARGET_BYTES) -> DataFrame:
    """``path``, ``place`` and ``pieces``: files worth gathering, with their folder and the files to make of it.

    Files below half of ``target`` are small; a folder's are gathered if that leaves fewer.
    """
    name = F.col("_metadata.file_path")
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select(name.alias("path"), "length", _folder(name).alias("place"))
    )
    small = listed.filter(F.col("length") < target / 2)
    places = small.groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"))
    pieces = F.ceil(F.col("bytes") / target).cast("int")
    chosen = places.withColumn("pieces", pieces).filter("pieces < n").select("place", "pieces")
    return small.join(broadcast_if_small(chosen), "place").select("path", "place", "pieces")


def compact_small_files(
    spark: SparkSession, path: str, partition_cols: Iterable[str] = (), target: int = TARGET_BYTES
) -> int:
    """Gather small files, folder by folder, into files of about ``target`` bytes.

    Returns how many files were replaced. Other files keep their names and times; a second
    run finds nothing to do.
    """
    cols = list(partition_cols)
    settle(spark, path)
    plan = small_files(spark, path, target).persist()
    try:
        # A table's files are listed by the driver whenever it is read.
        old = [r["path"] for r in plan.select("path").collect()]
        if not old:
            return 0
        places = plan.select("place", "pieces").distinct()
        total = places.agg(F.sum("pieces")).first()[0]
        before = Window.partitionBy(F.lit(0)).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
        # One row a folder.
        places = places.withColumn("__first", F.coalesce(F.sum("pieces").over(before), F.lit(0)))
        rows = read_files(spark, path, old, spark.read.parquet(path).schema)
        placed = rows.withColumn("__place", _folder(F.col("_metadata.file_path")))
        placed = placed.join(broadcast_if_small(places.withColumnRenamed("place", "__place")), "__place")
        # Rows of one folder are dealt over its pieces in turn, each of which one task writes.
        dealt = placed.withColumn("__piece", F.monotonically_increasing_id() % F.col("pieces"))
        dealt = dealt.repartitionById(total, (F.col("__first") + F.col("__piece")).cast("int")).select(*[quoted(c) for c in rows.columns])
        replace_files(
            spark, path, old, lambda staged: dealt.write.mode("overwrite").partitionBy(*cols).parquet(staged)
        )
        return len(old)
    finally:
        plan.unpersist()
