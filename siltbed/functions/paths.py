"""Times carried by raw file paths."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, functions as F

from siltbed.fixed_values import (
    EXTRACT,
    EXTRACT_FORMAT,
    EXTRACT_PATTERN,
    INGESTION,
    INGESTION_PATTERN,
    PATH,
    TIME_UNIT_FORMATS,
)


def wall_clock(text: Column, pattern: str) -> Column:
    """Parse to ``timestamp_ntz``; null when ``text`` does not parse.

    The text is read as UTC and counted from an epoch without a zone, so the
    result is the same under every session time zone, also in clock changes.
    """
    instant = F.try_to_timestamp(F.concat(text, F.lit("+00:00")), F.lit(pattern + "XXX"))
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def ingestion_time(path: Column, pattern: str = INGESTION_PATTERN) -> Column:
    """Time made of the regex groups; the unit words in the regex give the format."""
    named = set(re.findall("|".join(TIME_UNIT_FORMATS), pattern))
    layout = "".join(fmt for unit, fmt in TIME_UNIT_FORMATS.items() if unit in named)
    groups = "".join(f"${i}" for i in range(1, re.compile(pattern).groups + 1))
    # One regex pass per row: an unmatched path stays as it is and, lacking the
    # leading "=", does not parse.
    digits = F.regexp_replace(path, f"(?s)^.*?(?:{pattern}).*$", f"={groups}")
    return wall_clock(digits, f"'='{layout}")


def path_time(path: str, pattern: str = INGESTION_PATTERN) -> dt.datetime | None:
    """What ``ingestion_time`` gives for one path, for lists of files on the driver."""
    found = re.search(pattern, path)
    if not found:
        return None
    try:
        return dt.datetime(*map(int, found.groups()))
    except ValueError:
        return None


def extract_time(
    path: Column, pattern: str = EXTRACT_PATTERN, layout: str = EXTRACT_FORMAT
) -> Column:
    # A path without a stamp is null before it is parsed: a failed parse costs
    # far more than the rest of the expression.
    return wall_clock(F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")), layout)


def dates_from_path(
    df: DataFrame,
    path_col: str = PATH,
    ingestion_regex: str = INGESTION_PATTERN,
    extract_regex: str = EXTRACT_PATTERN,
    extract_format: str = EXTRACT_FORMAT,
) -> DataFrame:
    """Add the ingestion time and the extract time (else the ingestion time)."""
    path = F.col(path_col)
    extracted = extract_time(path, extract_regex, extract_format)
    # Two steps, so that the ingestion time is parsed once per row.
    dated = df.withColumn(INGESTION, ingestion_time(path, ingestion_regex))
    return dated.withColumn(EXTRACT, F.coalesce(extracted, F.col(INGESTION)))


def plain_path(path: Column) -> Column:
    """Undo percent-encoding and ``scheme:///``, to compare paths of two readers."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, r"^(\w+):///", "$1:/")
