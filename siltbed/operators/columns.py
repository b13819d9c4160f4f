"""Column shaping: names, order, missing columns and types."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from siltbed.fixed_values import (
    EXTRACT,
    INGESTION,
    METADATA_COLUMNS,
    METADATA_TIME_LENGTH,
    NAME_PUNCTUATION,
    NAME_PUNCTUATION_WITH_SLASH,
    TYPE_MAP,
)

log = logging.getLogger(__name__)


def quoted(name: str) -> Column:
    """Column of that exact name, dots and backticks included."""
    escaped = name.replace("`", "``")
    return F.col(f"`{escaped}`")


def rename_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rename by ``{old: new}``, in order; names the frame lacks are ignored."""
    if not isinstance(columns, dict):
        raise ValueError(f"columns must be a dict of old to new names, not {type(columns).__name__}")
    return df.withColumnsRenamed(columns)


def sanitise_columns(df: DataFrame, metadata_last: bool = False) -> DataFrame:
    """Drop punctuation from column names and write spaces as ``_``.

    With ``metadata_last`` slashes go too, and path and times become the last
    columns.
    """
    names = df.columns
    removed = NAME_PUNCTUATION
    if metadata_last:
        removed = NAME_PUNCTUATION_WITH_SLASH
        names = [n for n in names if n not in METADATA_COLUMNS]
        names += [n for n in METADATA_COLUMNS if n in df.columns]
    table = str.maketrans("", "", removed)
    clean = [n.strip().translate(table) for n in names]
    if not metadata_last:
        clean = [n.strip() for n in clean]
    clean = [n.replace(" ", "_") for n in clean]
    twice = sorted({n for n in clean if clean.count(n) > 1})
    if twice:
        raise ValueError(f"column names collide once sanitised: {twice}")
    return df.select(*[quoted(old).alias(new) for old, new in zip(names, clean)])


def add_missing_columns(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Add configured columns that the frame lacks, holding their default.

    Names compare without case; a present column takes the configured case.
    """
    present = {name.lower(): name for name in df.columns}
    recased = {
        present[name.lower()]: name
        for name in defaults
        if name.lower() in present and name not in df.columns
    }
    missing = {n: F.lit(v) for n, v in defaults.items() if n.lower() not in present}
    renamed = df.withColumnsRenamed(recased) if recased else df
    return renamed.withColumns(missing) if missing else renamed


def null_typed_to(df: DataFrame, data_type: str = "double") -> DataFrame:
    """Give columns of the void type a type that files can store."""
    void = [f.name for f in df.schema if isinstance(f.dataType, T.NullType)]
    return df.withColumns({n: F.lit(None).cast(data_type) for n in void}) if void else df


def project_columns(
    df: DataFrame, columns: Iterable[str], keep_metadata: bool = True
) -> DataFrame:
    """Select ``columns`` once each, in order, and the metadata columns after them."""
    wanted = list(dict.fromkeys(columns))
    if keep_metadata:
        wanted += [m for m in METADATA_COLUMNS if m in df.columns and m not in wanted]
    unlisted = [c for c in df.columns if c not in wanted]
    if unlisted:
        log.info("columns not configured and left out: %s", unlisted)
    return df.select(*[quoted(c) for c in wanted])


def conform(
    df: DataFrame,
    columns: Iterable[str],
    defaults: Mapping[str, Any] | None = None,
    null_type: str = "double",
) -> DataFrame:
    """Give ``df`` the configured columns: fill, project, and type the empty ones."""
    columns = list(columns)
    filled = add_missing_columns(df, {**dict.fromkeys(columns), **(defaults or {})})
    return null_typed_to(project_columns(filled, columns), null_type)


def format_metadata(df: DataFrame, columns: Iterable[str] = (INGESTION, EXTRACT)) -> DataFrame:
    """Render the metadata times as ``yyyy-MM-dd HH:mm:ss`` text."""
    present = [c for c in columns if c in df.columns]
    times = {c: F.substring(F.col(c).cast("string"), 1, METADATA_TIME_LENGTH) for c in present}
    return df.withColumns(times) if times else df


def cast_by_type_map(
    df: DataFrame, type_map: Mapping[str, str] = TYPE_MAP, otherwise: str = "string"
) -> DataFrame:
    """Cast every column by its Spark type name.

    The default map loses the time of day (timestamp to date) and precision
    (double to float); pass another map to keep them.
    """
    return df.select(
        *[
            quoted(f.name).cast(type_map.get(f.dataType.simpleString(), otherwise)).alias(f.name)
            for f in df.schema
        ]
    )
