"""Finding and reading raw files in a tree of ingestion-time directories."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from siltbed.fixed_values import PATH, TIME_UNIT_FORMATS
from siltbed.functions.paths import extract_time, ingestion_time, plain_path
from siltbed.sources import storage

LISTING_TASKS_PER_CORE = 4
_LEVELS = tuple(TIME_UNIT_FORMATS)[:5]
_INVENTORY = (
    "fileName string, filePath string, DataLakePathRaw string, fileSize bigint, "
    "ingestionDate timestamp_ntz, extractDate timestamp_ntz"
)


def naive_time(time: dt.datetime | None) -> Column:
    """A wall-clock literal, independent of the session time zone."""
    text = None if time is None else time.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def this_instant() -> dt.datetime:
    """Now, as wall-clock time in UTC: the bound of an inventory and of the loads after it.

    Whole milliseconds, as file times are, so that a file written from now on is never before it.
    """
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return now.replace(microsecond=now.microsecond // 1000 * 1000)


def _written_before(instant: dt.datetime | None) -> dict[str, str]:
    """Reader options that leave out files written at ``instant`` (UTC) or later.

    Spark compares such times in the reader's time zone, so that is set as well.
    """
    if instant is None:
        return {}
    return {"modifiedBefore": instant.isoformat(timespec="microseconds"), "timeZone": "UTC"}


def floor_time(time: dt.datetime | None, unit: str | None) -> dt.datetime | None:
    if time is None or unit is None:
        return time
    if unit != "hour":
        raise ValueError(f"a mark is floored to 'hour' or not at all, not to {unit!r}")
    return time.replace(minute=0, second=0, microsecond=0)


def raw_subtrees(
    spark: SparkSession,
    root: str,
    after: dt.datetime | None = None,
    until: dt.datetime | None = None,
    others: bool = False,
) -> list[str]:
    """Directories below ``root`` that hold all files with ``after < time <= until``.

    Only directories on a boundary are opened, so the number of listings follows
    the depth of the tree (years, months, days, hours, minutes) and not its size.
    With ``others``, children of ``root`` outside the layout are returned too.
    """
    if not storage.exists(spark, root):
        return []
    if after is None and until is None:
        return [root]
    low = after and after.timetuple()[:5]
    high = until and until.timetuple()[:5]
    kept: list[str] = []

    def visit(path: str, prefix: tuple[int, ...]) -> None:
        level = _LEVELS[len(prefix)]
        for name, is_dir in sorted(storage.children(spark, path)):
            child = f"{path.rstrip('/')}/{name}"
            unit, _, number = name.partition("=")
            if not (is_dir and unit == level and number.isdigit()):
                if others and not prefix and not name.startswith(("_", ".")):
                    kept.append(child)
                continue
            here = (*prefix, int(number))
            depth, deepest = len(here), len(here) == len(_LEVELS)
            if low and (here < low[:depth] or (deepest and here == low)):
                continue
            if high and here > high[:depth]:
                continue
            on_edge = (low and here == low[:depth]) or (high and here == high[:depth])
            if on_edge and not deepest:
                visit(child, here)
            else:
                kept.append(child)

    visit(root, ())
    return kept


def file_inventory(
    spark: SparkSession,
    roots: str | Iterable[str],
    glob: str = "*",
    after: dt.datetime | None = None,
    until: dt.datetime | None = None,
    floor: str | None = "hour",
    min_size: int = 1,
    others: bool = True,
    before: dt.datetime | None = None,
) -> DataFrame:
    """Files below ``roots`` newer than ``after``, with the times in their paths.

    Without ``others`` only directories directly below a root are searched for
    times. The mark is floored to the hour unless ``floor`` is None. One listing serves
    all roots; file contents are not read. Spark lists no file of zero bytes. Files written
    at ``before`` (an instant in UTC) or later are left out.
    """
    roots = list(dict.fromkeys([roots] if isinstance(roots, str) else roots))
    after = floor_time(after, floor)
    full = {root: storage.qualified(spark, root).rstrip("/") + "/" for root in roots}
    if _overlap(full.values()):
        parts = [file_inventory(spark, r, glob, after, until, None, min_size, others, before) for r in roots]
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        return found
    subtrees = [p for root in roots for p in raw_subtrees(spark, root, after, until, others)]
    if not subtrees:
        return spark.createDataFrame([], _INVENTORY)
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .options(**_written_before(before))
        .load(subtrees)
        .select("path", "length")
        # Spark packs tasks by file size, but no content is read: a task a core's share.
        .coalesce(LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    )
    path = F.col("path")
    ingested = ingestion_time(path)
    owner = _owner(path, full)
    files = listed.select(
        F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1).alias("fileName"),
        path.alias("filePath"),
        owner.alias("DataLakePathRaw"),
        F.col("length").alias("fileSize"),
        ingested.alias("ingestionDate"),
        F.coalesce(extract_time(path), ingested).alias("extractDate"),
    ).filter(F.col("fileSize") >= min_size)
    if after is not None:
        files = files.filter(F.col("ingestionDate") > naive_time(after))
    if until is not None:
        files = files.filter(F.col("ingestionDate") <= naive_time(until))
    return files


def _owner(path: Column, full: Mapping[str, str]) -> Column:
    """The root a path lies below: its start, cut at the depth of each root, looked up."""
    by_depth: dict[int, list[Column]] = {}
    for root, start in full.items():
        start = start.rstrip("/")
        by_depth.setdefault(start.count("/") + 1, []).extend([F.lit(start), F.lit(root)])
    found = [
        F.try_element_at(F.create_map(*pairs), F.substring_index(path, "/", depth))
        for depth, pairs in by_depth.items()
    ]
    return F.coalesce(*found)


def _overlap(paths: Iterable[str]) -> bool:
    ordered = sorted(paths)
    return any(b.startswith(a) for a, b in zip(ordered, ordered[1:]))


def raw_options(
    fmt: str,
    encoding: str | None = None,
    sep: str | None = None,
    escape: str | None = '"',
    multi_line: bool | None = None,
    check_headers: bool = False,
) -> dict[str, object]:
    """Spark reader options of a raw format, for batch and for streaming.

    CSV has a header, UTF-16 text, doubled quotes and line breaks inside values
    unless told otherwise. As in Spark, the first file's header names the
    columns of all files; ``check_headers`` makes a differing header an error.
    JSON is one object per line, a malformed line is an error, and values without
    a schema stay text, as in CSV.
    """
    if fmt == "csv":
        options = {
            "header": True,
            "multiLine": multi_line is not False,
            "encoding": encoding or "UTF-16",
            "sep": sep or ",",
            "enforceSchema": not check_headers,
        }
        return {**options, "escape": escape} if escape else options
    if fmt == "json":
        options = {
            "multiLine": bool(multi_line),
            "mode": "FAILFAST",
            "primitivesAsString": True,
        }
        return {**options, "encoding": encoding} if encoding else options
    if fmt == "parquet":
        return {}
    raise ValueError(f"raw files are read as csv, json or parquet, not {fmt!r}")


def read_raw(
    spark: SparkSession,
    paths: str | Iterable[str],
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
    recursive: bool = True,
    with_path: bool = True,
    options: Mapping[str, object] | None = None,
    before: dt.datetime | None = None,
    **text: object,
) -> DataFrame:
    """Read raw ``csv``, ``json`` or ``parquet`` files and add their ``path``.

    Without a schema every CSV column is a string. ``text`` goes to
    ``raw_options``; ``options`` are Spark's own and come last. Files written at
    ``before`` (an instant in UTC) or later are not listed, and zoned times in the
    text are then read as UTC.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format(fmt).option("recursiveFileLookup", recursive)
    reader = reader.options(**{**raw_options(fmt, **text), **_written_before(before), **(options or {})})
    if schema is not None:
        reader = reader.schema(schema)
    table = reader.load(paths)
    return table.withColumn(PATH, F.col("_metadata.file_path")) if with_path else table


def listed_files(df: DataFrame) -> list[str]:
    """The files that ``df`` reads, spelled as in its rows' ``path``."""
    return [re.sub(r"^(\w+):///", r"\1:/", f) for f in df.inputFiles()]


def literal_path(path: str) -> str:
    """``path`` with the characters that readers take for patterns escaped."""
    return re.sub(r"([*?{}\[\]\\])", r"\\\1", path)


def files_path(path: Column) -> Column:
    """An inventory's ``filePath`` as ``plain_path`` gives it for the rows of that file."""
    return F.regexp_replace(path, r"^(\w+):///", "$1:/")


def rows_of_files(df: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of ``df`` that come from a file in the inventory ``files``."""
    # Readers percent-encode paths, the inventory does not.
    listed = files.select(files_path(F.col("filePath")).alias("__file"))
    return df.join(listed, plain_path(F.col(PATH)) == F.col("__file"), "left_semi")
