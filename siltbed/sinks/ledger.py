"""A ledger of loaded files, so that a repeated append leaves each row once.

The ledger is a Parquet table of small rows below a folder of its own, one directory per loaded table.
An append writes which files it is about to add, adds their rows, and then closes the
batch. Files of closed batches are loaded; a later append leaves their rows out by an anti
join, which only runs if there are such files. A batch that was never closed stopped
somewhere in its append: before the next one, the files that it left in the table, found by
the raw paths that their rows carry, are deleted, and the batch is closed as void.

Loads of one table must follow each other; loads of different tables don't meet.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltbed.fixed_values import PATH
from siltbed.functions.paths import ingestion_time
from siltbed.operators.columns import quoted
from siltbed.operators.merge import delta_partitions, touched_partitions
from siltbed.operators.partitions import date_hierarchy, level_columns
from siltbed.session import broadcast_if_small
from siltbed.sinks.lake import Watch, append_standardised, unwatched
from siltbed.sources import storage
from siltbed.sources.files import listed_files

BEGUN, DONE, VOID = "begun", "done", "void"
_ENTRIES = "batch string, file string, state string"


def _folder(ledger: str, table: str) -> str:
    return f"{ledger.rstrip('/')}/{table}"


def entries(spark: SparkSession, ledger: str, table: str) -> DataFrame:
    """batch, file and state; a closing row has no file."""
    folder = _folder(ledger, table)
    if not storage.has_data(spark, folder):
        return spark.createDataFrame([], _ENTRIES)
    return spark.read.schema(_ENTRIES).parquet(folder)


def _write(spark: SparkSession, ledger: str, table: str, rows: Iterable[tuple]) -> None:
    frame = spark.createDataFrame(list(rows), _ENTRIES)
    frame.coalesce(1).write.mode("append").parquet(_folder(ledger, table))


def loaded_files(spark: SparkSession, ledger: str, table: str) -> DataFrame:
    """Raw files whose rows the standardised table holds, as ``path``."""
    every = entries(spark, ledger, table)
    closed = every.filter(F.col("state") == DONE).select("batch")
    begun = every.filter(F.col("state") == BEGUN)
    return begun.join(broadcast_if_small(closed), "batch", "left_semi").select(F.col("file").alias(PATH)).distinct()


def not_loaded(files: DataFrame, spark: SparkSession, ledger: str, table: str) -> DataFrame:
    """Rows of ``files`` (with ``path`` as readers spell it) that no closed batch has."""
    return files.join(broadcast_if_small(loaded_files(spark, ledger, table)), PATH, "left_anti")


def undo_unfinished(spark: SparkSession, path: str, ledger: str, table: str, level: str | None = "Month") -> int:
    """Remove what unclosed batches left in the table at ``path``; returns the files removed.

    ``level`` is that of the table's calendar columns, None if it has none.
    """
    if not storage.has_data(spark, _folder(ledger, table)):
        return 0
    every = entries(spark, ledger, table)
    open_ = every.groupBy("batch").agg(F.bool_and(F.col("state") == BEGUN).alias("open")).filter("open")
    batches = [r["batch"] for r in open_.collect()]  # one a failed load
    if not batches:
        return 0
    open_ = every.filter(F.col("batch").isin(batches))
    stale: list[str] = []
    if storage.has_data(spark, path):
        stored = spark.read.parquet(path)
        lost = open_.select(F.col("file").alias(PATH))
        if level is not None:
            dated = date_hierarchy(lost.withColumn("__at", ingestion_time(F.col(PATH))), level, "__at")
            cols = list(level_columns(level))
            stored = touched_partitions(stored, dated, cols, delta_partitions(stored, dated, cols).collect())
        held = stored.select(quoted(PATH), F.col("_metadata.file_path").alias("__stored"))
        # The output files of single loads, which the writer's commit listed as well.
        stale = [r[0] for r in held.join(broadcast_if_small(lost), PATH, "left_semi").select("__stored").distinct().collect()]
        for name in stale:
            storage.delete(spark, name)
    _write(spark, ledger, table, [(b, None, VOID) for b in batches])
    return len(stale)


def append_once(
    df: DataFrame,
    path: str,
    ledger: str,
    table: str,
    level: str | None = "Month",
    files: Iterable[str] | None = None,
    append: Callable[[DataFrame, str], None] | None = None,
    watch: Watch = unwatched,
) -> None:
    """Append the rows of ``df`` whose raw file (its ``path``) is not in the table yet.

    ``files`` are the raw files that ``df`` reads, spelled as in ``path``; by default those
    that its plan lists.
    ``append`` writes rows to ``path``; by default below the calendar columns of ``level``.
    """
    spark = df.sparkSession
    undo_unfinished(spark, path, ledger, table, level)
    files = list(dict.fromkeys(listed_files(df) if files is None else files))
    if not files:
        return
    known: set[str] = set()
    if storage.has_data(spark, _folder(ledger, table)):
        listed = spark.createDataFrame([(f,) for f in files], f"{PATH} string")
        known = {r[0] for r in listed.join(loaded_files(spark, ledger, table), PATH, "left_semi").collect()}
    new = [f for f in files if f not in known]
    if not new:
        return
    rows = not_loaded(df, spark, ledger, table) if known else df
    batch = uuid.uuid4().hex
    _write(spark, ledger, table, ((batch, f, BEGUN) for f in new))
    rows = watch(rows.select(*[quoted(c) for c in df.columns]))
    if append is not None:
        append(rows, path)
    elif level is not None:
        append_standardised(rows, path, level)
    else:
        rows.write.mode("append").parquet(path)
    _write(spark, ledger, table, [(batch, None, DONE)])
