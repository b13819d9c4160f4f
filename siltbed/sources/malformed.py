"""Raw text whose malformed rows are set aside, and raw files with different headers."""

from __future__ import annotations

import csv
import datetime as dt
import io
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from siltbed.fixed_values import PATH
from siltbed.operators.columns import quoted
from siltbed.sources import storage
from siltbed.sources.files import listed_files, literal_path, read_raw

MALFORMED = "__malformed"
HEADER_BYTES = 1 << 16
LISTING_THREADS = 16


def read_permissive(
    spark: SparkSession,
    paths: str | Iterable[str],
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
    options: Mapping[str, object] | None = None,
    before: dt.datetime | None = None,
    **text: object,
) -> DataFrame:
    """Raw CSV or JSON rows with ``__malformed``: the text of a row that does not fit, else null.

    A CSV row fits if it has the header's number of values and these have the schema's types, a JSON line if it is an object of
    such. Without a schema the columns are those of the header, or of the readable lines.
    Every column is parsed, whatever is selected later, so that what fits does not depend on that.
    """
    if fmt not in ("csv", "json"):
        raise ValueError(f"only csv and json have malformed rows, not {fmt!r}")
    paths = [paths] if isinstance(paths, str) else list(paths)
    if schema is None:
        lenient = {**(options or {}), "mode": "DROPMALFORMED"}
        schema = read_raw(spark, paths, fmt, options=lenient, before=before, with_path=False, **text).schema
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    whole = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    permissive = {
        **(options or {}),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": MALFORMED,
        "columnPruning": False,
    }
    return read_raw(spark, paths, fmt, whole, options=permissive, before=before, **text)


def split_malformed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that fit, and ``path`` and ``text`` of the others.

    Persist ``rows`` before, so that one scan feeds both (Spark also refuses to read
    nothing but malformed text from files).
    """
    fits = F.col(MALFORMED).isNull()
    return rows.filter(fits).drop(MALFORMED), rows.filter(~fits).select(PATH, F.col(MALFORMED).alias("text"))


def _header(spark: SparkSession, path: str, encoding: str, sep: str) -> tuple[str, ...]:
    start = storage.first_bytes(spark, path, HEADER_BYTES)
    if encoding.lower().replace("-", "") == "utf16" and start[:2] not in (b"\xff\xfe", b"\xfe\xff"):
        encoding = "utf-16-be"
    text = start.decode(encoding, "ignore").removeprefix("﻿")
    return tuple(next(csv.reader(io.StringIO(text, newline=""), delimiter=sep), ()))


def files_by_header(
    spark: SparkSession, files: Iterable[str], encoding: str = "UTF-16", sep: str = ","
) -> dict[tuple[str, ...], list[str]]:
    """Files (as rows spell their ``path``) by the column names in their first line.

    As many small reads as files, several at a time; only names reach the driver, which has the list of files anyway.
    """
    files = list(files)
    with ThreadPoolExecutor(LISTING_THREADS) as pool:
        headers = list(pool.map(lambda f: _header(spark, f, encoding, sep), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for header, name in zip(headers, files):
        groups.setdefault(header, []).append(name)
    return groups


def read_by_header(
    spark: SparkSession,
    paths: str | Iterable[str],
    encoding: str = "UTF-16",
    sep: str = ",",
    options: Mapping[str, object] | None = None,
    before: dt.datetime | None = None,
    **text: object,
) -> DataFrame:
    """CSV files with their own headers: columns are joined by name, absent ones are null.

    Files with one header are one read; if all have the same, the directories are read as they are.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    text = {"encoding": encoding, "sep": sep, **text}
    whole = read_raw(spark, paths, "csv", options=options, before=before, **text)
    groups = files_by_header(spark, listed_files(whole), encoding, sep)
    groups.pop((), None)
    if len(groups) <= 1:
        return whole
    reads = []
    for _, files in sorted(groups.items()):
        plain = [literal_path(storage.decoded(spark, f)) for f in files]
        reads.append(read_raw(spark, plain, "csv", options=options, **text))
    joined = reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), reads)
    return joined.select(*[quoted(c) for c in joined.columns if c != PATH], PATH)
