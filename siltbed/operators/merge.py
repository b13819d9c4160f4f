"""Restricting a stored table to what a delta touches, and adding the delta."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from siltbed.operators.columns import quoted

log = logging.getLogger(__name__)


def delta_partitions(
    current: DataFrame, delta: DataFrame, partition_cols: Iterable[str]
) -> DataFrame:
    """Distinct partition values of ``delta``, in the types of ``current``."""
    types = {f.name: f.dataType for f in current.schema}
    return delta.select(*[quoted(c).cast(types[c]).alias(c) for c in partition_cols]).distinct()


def touched_partitions(
    current: DataFrame,
    delta: DataFrame,
    partition_cols: Iterable[str],
    found: list[Row] | None = None,
) -> DataFrame:
    """Rows of ``current`` in partitions that ``delta`` has rows for.

    The partitions become a literal predicate, which prunes directories before
    anything is read. However many there are, the driver holds that list anyway:
    a dynamic overwrite tracks each partition it replaces, and the file index has
    an entry for each directory. Nulls match nulls, as they share a directory.
    Pass ``found`` if the delta's partitions are known.
    """
    cols = list(partition_cols)
    types = {f.name: f.dataType for f in current.schema}
    if found is None:
        found = delta_partitions(current, delta, cols).collect()
    return current.filter(_is_one_of(cols, types, found))


def _is_one_of(cols: list[str], types: dict[str, T.DataType], rows: list[Row]) -> Column:
    def typed(value: object, name: str) -> Column:
        return F.lit(value).cast(types[name]).alias(name)

    # Rows with nulls in the same columns are one membership test, however many they are.
    patterns: dict[tuple[str, ...], list[Row]] = {}
    for row in rows:
        patterns.setdefault(tuple(c for c in cols if row[c] is not None), []).append(row)
    tests = []
    for known, alike in patterns.items():
        parts = [quoted(c).isNull() for c in cols if c not in known]
        if len(known) == 1:
            parts.append(quoted(known[0]).isin(*[typed(r[known[0]], known[0]) for r in alike]))
        elif known:
            values = [F.struct(*[typed(r[c], c) for c in known]) for r in alike]
            parts.append(F.struct(*[quoted(c) for c in known]).isin(*values))
        tests.append(reduce(and_, parts))
    return reduce(or_, tests, F.lit(False))


def union_delta(current: DataFrame, delta: DataFrame) -> DataFrame:
    """``UNION ALL`` of the delta and the table, on the table's columns and types."""
    absent = [c for c in current.columns if c not in delta.columns]
    if absent:
        raise ValueError(f"delta lacks columns of the table: {absent}")
    extra = [c for c in delta.columns if c not in current.columns]
    if extra:
        log.warning("delta columns the table does not have are left out: %s", extra)
    aligned = delta.select(*[quoted(f.name).cast(f.dataType).alias(f.name) for f in current.schema])
    return aligned.unionByName(current)
