"""Calendar columns that tables are partitioned by."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltbed.fixed_values import (
    DATE_LEVELS,
    INGESTION,
    PARTITION_DATE,
    PARTITION_KEY,
    SCHEME_COLUMNS,
    SCHEME_FORMATS,
)

_PARTS = {"Year": F.year, "Month": F.month, "Day": F.dayofmonth}
_LEVELS = dict(zip(DATE_LEVELS, (F.year, F.month, F.weekofyear, F.dayofyear)))


def calendar_columns(
    df: DataFrame, key_col: str = PARTITION_KEY, scheme: str = "YYYYMMDD"
) -> DataFrame:
    """Parse the partition key by ``scheme`` and add its date and calendar columns.

    Calendar columns are unpadded strings; a key that does not parse gives nulls.
    """
    if scheme not in SCHEME_COLUMNS:
        raise ValueError(f"scheme must be one of {', '.join(SCHEME_COLUMNS)}, not {scheme!r}")
    date = F.try_to_date(F.col(key_col).cast("string"), SCHEME_FORMATS[scheme])
    parts = {c: _PARTS[c](date).cast("string") for c in SCHEME_COLUMNS[scheme]}
    return df.withColumns({PARTITION_DATE: date, **parts})


def level_columns(level: str) -> tuple[str, ...]:
    """Calendar columns from the year down to ``level``."""
    if level not in _LEVELS:
        raise KeyError(f"level must be one of {', '.join(DATE_LEVELS)}, not {level!r}")
    return DATE_LEVELS[: DATE_LEVELS.index(level) + 1]


def date_hierarchy(df: DataFrame, level: str = "Month", column: str = INGESTION) -> DataFrame:
    """Add the calendar columns of ``column`` from the year down to ``level``."""
    date = F.col(column).cast("date")
    return df.withColumns({name: _LEVELS[name](date) for name in level_columns(level)})


def coarsen_key(df: DataFrame, key_col: str = PARTITION_KEY, length: int = 6) -> DataFrame:
    """Cut the partition key, by default from day to month."""
    return df.withColumn(key_col, F.substring(F.col(key_col).cast("string"), 1, length))
