"""Siltbed: incremental, metadata-driven lake loading on Spark DataFrames."""

from siltbed.functions.keys import parse_key_list
from siltbed.functions.paths import dates_from_path, plain_path
from siltbed.functions.text import form_answer_values, split_camel_case, strip_html
from siltbed.operators.columns import (
    add_missing_columns,
    cast_by_type_map,
    conform,
    format_metadata,
    null_typed_to,
    project_columns,
    rename_columns,
    sanitise_columns,
)
from siltbed.operators.latest import (
    latest_files,
    latest_rows,
    partition_changes,
    rows_of_latest_file,
    run_summary,
)
from siltbed.operators.merge import touched_partitions, union_delta
from siltbed.operators.partitions import calendar_columns, coarsen_key, date_hierarchy
from siltbed.plans.catalog import (
    column_defaults,
    config_rows,
    dataset_header,
    files_to_tables,
    load_groups,
    load_specs,
    ordered_columns,
    partition_schemes,
    read_config,
    table_catalog,
)
from siltbed.plans.load import LoadOptions, load_configured, load_dataset, load_table
from siltbed.plans.routing import write_curated
from siltbed.plans.spec import TableSpec
from siltbed.sinks.jdbc import copy_to_jdbc, log_partition_changes, write_jdbc
from siltbed.sinks.lake import (
    append_standardised,
    merge_full,
    overwrite_partitions,
    overwrite_snapshot,
    rewrite_by_month,
    upsert_partitions,
    write_json_latest,
)
from siltbed.sources.files import file_inventory, raw_subtrees, read_raw, rows_of_files
from siltbed.sources.jdbc import read_jdbc
from siltbed.streaming.upsert import stream_upsert

__all__ = [
    "LoadOptions",
    "TableSpec",
    "add_missing_columns",
    "append_standardised",
    "calendar_columns",
    "cast_by_type_map",
    "coarsen_key",
    "column_defaults",
    "config_rows",
    "conform",
    "copy_to_jdbc",
    "dataset_header",
    "date_hierarchy",
    "dates_from_path",
    "file_inventory",
    "files_to_tables",
    "form_answer_values",
    "format_metadata",
    "latest_files",
    "latest_rows",
    "load_configured",
    "load_dataset",
    "load_groups",
    "load_specs",
    "load_table",
    "log_partition_changes",
    "merge_full",
    "null_typed_to",
    "ordered_columns",
    "overwrite_partitions",
    "overwrite_snapshot",
    "parse_key_list",
    "partition_changes",
    "partition_schemes",
    "plain_path",
    "project_columns",
    "raw_subtrees",
    "read_config",
    "read_jdbc",
    "read_raw",
    "rename_columns",
    "rewrite_by_month",
    "rows_of_files",
    "rows_of_latest_file",
    "run_summary",
    "sanitise_columns",
    "split_camel_case",
    "stream_upsert",
    "strip_html",
    "table_catalog",
    "touched_partitions",
    "union_delta",
    "upsert_partitions",
    "write_curated",
    "write_json_latest",
    "write_jdbc",
]
