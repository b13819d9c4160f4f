"""What really changed in a table: rows compared by key and by hashes of their contents."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from siltbed.fixed_values import METADATA_COLUMNS
from siltbed.operators.columns import quoted

INSERTED, UPDATED, UNCHANGED, GONE = "inserted", "updated", "unchanged", "gone"
_PRIME = (1 << 31) - 1


def _content(field: T.StructField) -> list[Column]:
    """What is hashed of a column; Spark skips nulls, so whether it is null counts as well."""
    column = quoted(field.name)
    value = F.array_sort(F.map_entries(column)) if isinstance(field.dataType, T.MapType) else column
    return [column.isNull(), value]


def content_by_key(df: DataFrame, keys: Iterable[str], columns: Iterable[T.StructField], prefix: str) -> DataFrame:
    """A row for each key: how many rows it has, and two sums that do not depend on their order."""
    parts = [c for field in columns for c in _content(field)]
    hashes = [F.pmod(F.xxhash64(*parts, F.lit(seed)), F.lit(_PRIME)) for seed in (0, 1)]
    sums = [F.sum(h).alias(f"{prefix}sum_{i}") for i, h in enumerate(hashes)]
    return df.groupBy(*[quoted(k).alias(f"{prefix}{k}") for k in keys]).agg(F.count(F.lit(1)).alias(f"{prefix}n"), *sums)


def key_changes(old: DataFrame, new: DataFrame, keys: Iterable[str], skip: Iterable[str] = METADATA_COLUMNS) -> DataFrame:
    """``keys`` and ``change`` for every key of either table, whose types are those of ``old``.

    All rows of a key are compared at once, whatever their order; columns in ``skip`` (by
    default path and times) are not compared, and a column that one side lacks counts as
    null there. Keys match like groups: nulls match nulls. Both sides are reduced to a row of
    numbers for each key before one full outer join, which needs no further shuffle.
    """
    keys = list(keys)
    known = {f.name: f for f in [*new.schema, *old.schema]}
    fields = [f for name, f in sorted(known.items()) if name not in {*keys, *skip}]

    def aligned(df: DataFrame) -> DataFrame:
        own = set(df.columns)
        each = [*(known[k] for k in keys), *fields]
        return df.select(*[(quoted(f.name) if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in each])

    one, two = (content_by_key(aligned(df), keys, fields, prefix) for df, prefix in ((old, "__old_"), (new, "__new_")))
    on = reduce(and_, [F.col(f"`__old_{k}`").eqNullSafe(F.col(f"`__new_{k}`")) for k in keys])
    same = reduce(and_, [F.col(f"__old_{c}") == F.col(f"__new_{c}") for c in ("n", "sum_0", "sum_1")])
    change = (
        F.when(F.col("__old_n").isNull(), INSERTED)
        .when(F.col("__new_n").isNull(), GONE)
        .when(same, UNCHANGED)
        .otherwise(UPDATED)
    )
    # A key that is null on both sides is null; one side's count says whether the key is there.
    present = [
        F.when(F.col("__old_n").isNull(), F.col(f"`__new_{k}`")).otherwise(F.col(f"`__old_{k}`")).alias(k) for k in keys
    ]
    return one.join(two, on, "full_outer").select(*present, change.alias("change"))


def partition_content_changes(
    old: DataFrame,
    new: DataFrame,
    keys: Iterable[str],
    partition_cols: Iterable[str],
    skip: Iterable[str] = METADATA_COLUMNS,
) -> DataFrame:
    """Per partition the number of keys inserted, updated, unchanged and gone.

    A key that moves to another partition is gone from one and inserted in the other.
    """
    cols = list(partition_cols)
    found = key_changes(old, new, dict.fromkeys([*cols, *keys]), skip)
    counts = [F.count_if(F.col("change") == c).alias(c) for c in (INSERTED, UPDATED, UNCHANGED, GONE)]
    return found.groupBy(*[quoted(c) for c in cols]).agg(*counts)
