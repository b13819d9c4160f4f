"""What several operators of this folder share."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltbed.session import scratch_path
from siltbed.sources import storage

_SHIPPED: set[str] = set()
_LARGE: list = []

#: Narrow rows (a few numbers) that one task writes.
ROWS_A_FILE = 1 << 17

#: Characters of ``[\x20\x09-\x0D]``.
WHITE_SPACE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The named columns of all rows of ``documents``."""
    return table(spark, sf_dir, "documents").select(*columns)


def written(df: DataFrame, name: str, most: int | None = None, each: int = ROWS_A_FILE) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, survives executors.

    If it has ``most`` rows at most, it gets a file for every ``each`` of these: however many partitions
    the session shuffles to, few rows don't become many files, each made by a task of its own.
    """
    path = scratch_path(df.sparkSession, name)
    if most is not None:
        df = df.coalesce(max(1, -(-most // each)))
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def removed(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing reads any more."""
    for own in tables:
        storage.delete_folder(own.sparkSession, own.written_path)


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        name = os.path.join(tempfile.mkdtemp(prefix="siltbed-"), "siltbed")
        context.addPyFile(shutil.make_archive(name, "zip", os.path.dirname(package), "siltbed"))
        _SHIPPED.add(context.applicationId)


def large_cache(function: Callable) -> Callable:
    """``functools.cache`` for what a Python worker keeps between tasks of one module only."""
    cached = functools.cache(function)
    _LARGE.append(cached)
    return cached


def clear_caches(module: str) -> None:
    """Forget the large caches of all modules but this one."""
    for cached in _LARGE:
        if cached.__module__ != module and cached.cache_info().currsize:
            cached.cache_clear()


def release_memory() -> None:
    """Give memory that Arrow holds for later use back to the system."""
    pa.default_memory_pool().release_unused()


def map_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand.

    Spark goes on with a task's Python worker in later stages and jobs, so a task first drops the large
    caches of other modules, and at its end gives back what Arrow no longer uses.
    """
    ship_package(df.sparkSession)
    module = function.__module__

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_caches(module)
        yield from function(batches)
        release_memory()

    return df.mapInArrow(run, schema)


def crc32_of_id(column: str = "doc_id") -> Column:
    """CRC-32 of an id written as text; null counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def batches_of(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that texts in memory stay bounded."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sized_batches(batches: Iterable[pa.RecordBatch], column: str, most: int, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches with about ``most`` bytes of a text column, or one longer row."""
    for batch in batches_of(batches, rows):
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        totals, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            before = int(totals[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(totals, before + most, "right")))
            yield batch.slice(start, end - start)
            start = end


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of each key together, from batches sorted by the keys; groups may cross batches."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch[k].to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(batch.num_rows, bool)
        for column in columns:
            changed[1:] |= column[1:] != column[:-1]
        starts = np.flatnonzero(changed).tolist()
        for a, b in zip([0, *starts], [*starts, batch.num_rows]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield _joined(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)
