"""Configured key lists such as ``[a], [b]``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from siltbed.fixed_values import PARTITION_KEY, SCHEME_COLUMNS


def parse_key_list(keys: Column | str, scheme: Column | str | None = None) -> Column:
    """Names in a bracketed list; date schemes add the partition key.

    An empty list stays empty, whatever the scheme. A null list stays null.
    """
    text = F.col(keys) if isinstance(keys, str) else keys
    names = F.transform(
        F.split(F.regexp_replace(text, r"[\[\]]", ""), ","),
        lambda name: F.regexp_replace(name, r"^\s+|\s+$", ""),
    )
    empty = F.array().cast("array<string>")
    blank = (F.size(names) == 1) & (F.element_at(names, 1) == "")
    parsed = F.when(blank, empty).otherwise(names)
    if scheme is None:
        return parsed
    dated = (F.col(scheme) if isinstance(scheme, str) else scheme).isin(*SCHEME_COLUMNS)
    return F.when(dated & ~blank, F.array_append(names, F.lit(PARTITION_KEY))).otherwise(parsed)
