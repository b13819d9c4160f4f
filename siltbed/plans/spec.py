"""What the configuration says about one table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from siltbed.fixed_values import (
    COARSE_KEY_TABLES,
    FORM_ANSWER_HTML_COLUMNS,
    FORM_ANSWER_TABLES,
    METADATA_COLUMNS,
    PARTITION_KEY,
    SANITISED_TABLES,
)


@dataclass(frozen=True)
class TableSpec:
    """Where a table's raw files are, how to read them, and how to store the result."""

    name: str
    raw_paths: tuple[str, ...]
    curated_path: str
    fmt: str = "csv"
    scheme: str = "Latest"
    role: str = "Full"
    keys: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()
    defaults: Mapping[str, Any] = field(default_factory=dict)
    destination: str | None = None
    external_schema: str | None = None
    external_table: str | None = None
    key_column: str = PARTITION_KEY
    renames: Mapping[str, str] = field(default_factory=lambda: {"Partitionkey": PARTITION_KEY})
    schema: str | None = None
    #: Steps that follow the table's name unless they are set.
    coarsen: bool | None = None
    sanitise: bool | None = None
    answers: bool | None = None
    html: tuple[str, ...] | None = None
    #: How this table's raw text is read, if not as the load's options say.
    sep: str | None = None
    encoding: str | None = None
    #: Upserts rewrite the files that hold a key of the delta, not whole partitions.
    by_file: bool = False

    def raw_schema(self) -> str | None:
        """Schema to read with, if known: configured JSON fields are read as text.

        CSV takes its columns from the header instead.
        """
        fields = [c for c in self.columns if c not in METADATA_COLUMNS]
        if self.schema is not None or self.fmt != "json" or not fields:
            return self.schema
        return ", ".join(f"`{c}` string" for c in fields)

    @property
    def coarse_key(self) -> bool:
        return self.name in COARSE_KEY_TABLES if self.coarsen is None else self.coarsen

    @property
    def sanitised(self) -> bool:
        return self.name in SANITISED_TABLES if self.sanitise is None else self.sanitise

    @property
    def form_answers(self) -> bool:
        return self.name in FORM_ANSWER_TABLES if self.answers is None else self.answers

    @property
    def html_columns(self) -> tuple[str, ...]:
        if self.html is not None:
            return self.html
        return FORM_ANSWER_HTML_COLUMNS if self.form_answers else ()
