"""Choosing the writer for a table's partition scheme and load role."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from siltbed.fixed_values import (
    LEGACY_EXTRA_KEYS,
    OVERWRITE_ROLES,
    PARTITION_DATE,
    SCHEME_COLUMNS,
    STRING_PARTITION,
    UPSERT_ROLE,
)
from siltbed.operators.columns import rename_columns
from siltbed.operators.partitions import calendar_columns
from siltbed.plans.spec import TableSpec
from siltbed.sinks.files import upsert_files
from siltbed.sinks.lake import (
    Watch,
    merge_full,
    overwrite_partitions,
    overwrite_snapshot,
    unwatched,
    upsert_partitions,
)


def _upsert(df: DataFrame, spec: TableSpec, path: str, keys: list[str], cols: Iterable[str], watch: Watch) -> None:
    merge = upsert_files if spec.by_file else upsert_partitions
    merge(df, path, keys, cols, watch=watch)


def _by_date(df: DataFrame, spec: TableSpec, path: str, watch: Watch) -> None:
    cols = SCHEME_COLUMNS[spec.scheme]
    dated = calendar_columns(df, spec.key_column, spec.scheme)
    if spec.role == UPSERT_ROLE:
        _upsert(dated, spec, path, [k for k in spec.keys if k != spec.key_column], cols, watch)
    else:
        # The raw key stays in the window, so rows whose keys do not parse and
        # share the null partition are told apart.
        raw_key = [spec.key_column] if spec.keys else []
        narrow = dated.drop(PARTITION_DATE)
        overwrite_partitions(narrow, path, spec.keys, cols, extra_keys=[*raw_key, *cols], watch=watch)


def _by_string(df: DataFrame, spec: TableSpec, path: str, watch: Watch) -> None:
    named = rename_columns(df, {spec.key_column: STRING_PARTITION}).drop(PARTITION_DATE)
    keys = [STRING_PARTITION if k == spec.key_column else k for k in spec.keys]
    if spec.role == UPSERT_ROLE:
        _upsert(named, spec, path, keys, [STRING_PARTITION], watch)
    else:
        # As on an upsert, a key may occur once in each partition.
        overwrite_partitions(named, path, keys, [STRING_PARTITION], extra_keys=[STRING_PARTITION], watch=watch)


def _latest(df: DataFrame, spec: TableSpec, path: str, watch: Watch) -> None:
    overwrite_snapshot(df, path, spec.keys, watch=watch)


def _legacy(df: DataFrame, spec: TableSpec, path: str, watch: Watch) -> None:
    merge_full(df, path, spec.keys, LEGACY_EXTRA_KEYS, watch=watch)


WRITERS: dict[str, Callable[[DataFrame, TableSpec, str, Watch], None]] = {
    **dict.fromkeys(SCHEME_COLUMNS, _by_date),
    "String": _by_string,
    "Latest": _latest,
    "Legacy": _legacy,
}


def write_curated(df: DataFrame, spec: TableSpec, path: str, watch: Watch = unwatched) -> None:
    """Write ``df`` to the curated table at ``path`` as its spec asks; ``watch`` sees what is written."""
    if spec.scheme not in WRITERS:
        raise ValueError(f"partition scheme must be one of {', '.join(WRITERS)}, not {spec.scheme!r}")
    roles = (*OVERWRITE_ROLES, UPSERT_ROLE)
    if spec.scheme not in ("Latest", "Legacy") and spec.role not in roles:
        raise ValueError(f"load role must be one of {', '.join(roles)}, not {spec.role!r}")
    WRITERS[spec.scheme](df, spec, path, watch)
