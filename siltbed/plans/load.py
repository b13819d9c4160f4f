"""Loading raw files into the standardised and curated zones."""

from __future__ import annotations

import datetime as dt
import json
import logging
from collections.abc import Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from siltbed.fixed_values import EXPORT_DESTINATION, INGESTION_PATTERN, PATH, UPSERT_ROLE
from siltbed.functions.paths import dates_from_path, ingestion_time, path_time, plain_path
from siltbed.functions.text import form_answer_values, strip_html
from siltbed.operators.columns import conform, rename_columns, sanitise_columns
from siltbed.operators.counts import RowCounts
from siltbed.operators.latest import latest_rows, run_summary
from siltbed.operators.partitions import coarsen_key
from siltbed.plans.catalog import (
    DatasetConfig,
    config_rows,
    dataset_header,
    files_to_tables,
    json_specs,
    load_groups,
    load_specs,
    size_batches,
)
from siltbed.plans.routing import write_curated
from siltbed.plans.spec import TableSpec
from siltbed.session import broadcast_if_small
from siltbed.sinks.jdbc import copy_to_jdbc, write_jdbc
from siltbed.sinks.lake import FROM_DELTA, Watch, append_standardised, json_table_path, unwatched, write_json_latest
from siltbed.sinks.ledger import append_once
from siltbed.sources.files import (
    file_inventory,
    files_path,
    floor_time,
    listed_files,
    literal_path,
    naive_time,
    raw_subtrees,
    read_raw,
    this_instant,
)
from siltbed.sources.malformed import read_by_header, read_permissive, split_malformed

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class LoadOptions:
    """How raw text is read, and where a table may be exported."""

    encoding: str = "UTF-16"
    sep: str = ","
    escape: str | None = '"'
    multi_line: bool = True
    level: str = "Month"
    check_headers: bool = False
    storage: StorageLevel | None = field(default_factory=lambda: StorageLevel.MEMORY_AND_DISK)
    export_url: str | None = None
    export_properties: Mapping[str, str] = field(default_factory=dict)
    #: Open connections at most; a fuller table sends more batches through each.
    export_partitions: int = 8
    export_batch_size: int | None = None
    export_truncate: bool = False
    #: Keep a ledger of loaded files, so that a repeated load appends no row twice.
    once: bool = True
    #: Bytes of raw files that one load persists at most (or one file); None: all of them.
    batch_bytes: int | None = None
    #: Malformed CSV and JSON rows go to the quarantine zone instead of into columns or an error.
    quarantine: bool = False
    #: CSV files of one load may have headers of their own; columns are joined by name.
    own_headers: bool = False
    #: Tables below the curated zone that are copied whole once the load is done, and their external names.
    copies: Mapping[str, str] = field(default_factory=dict)

    def text(self, spec: TableSpec) -> dict[str, object]:
        """Reader options of a table: its own separator and encoding come first."""
        names = ("encoding", "sep", "escape", "multi_line", "check_headers")
        own = {"encoding": spec.encoding, "sep": spec.sep}
        return {n: own.get(n) or getattr(self, n) for n in names}


def zone_path(root: str, zone: str, path: str) -> str:
    """``path`` inside a zone of the lake, unless it is a full path already."""
    if path.startswith("/") or "://" in path or path.startswith("file:"):
        return path
    return f"{root.rstrip('/')}/{zone}/{path}"


def raw_roots(spec: TableSpec, root: str) -> list[str]:
    return [zone_path(root, "raw", path) for path in spec.raw_paths]


def shaped(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Raw rows with times from their path and the configured columns."""
    dated = dates_from_path(rename_columns(raw, dict(spec.renames)))
    if spec.coarse_key:
        dated = coarsen_key(dated, spec.key_column)
    if spec.sanitised:
        dated = sanitise_columns(dated)
    return conform(dated, spec.columns or dated.columns, spec.defaults)


def cleaned(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Text cleaning that applies to curated tables only."""
    if spec.html_columns:
        df = strip_html(df, spec.html_columns)
    return form_answer_values(df) if spec.form_answers else df


def load_table(
    spark: SparkSession,
    spec: TableSpec,
    root: str,
    paths: Iterable[str] | None = None,
    after: dt.datetime | None = None,
    options: LoadOptions = LoadOptions(),
    before: dt.datetime | None = None,
    glob: str | None = None,
    timed: bool = False,
    inventory: DataFrame | None = None,
    counts: RowCounts | None = None,
    batches: DataFrame | None = None,
) -> str:
    """Load one table's new raw files; returns the path of its curated table.

    Files are those in ``paths``, or those in directories newer than ``after``. With
    a mark, or if ``timed``, files without an ingestion time in their path are left out,
    wherever the mark falls; otherwise everything below the roots is loaded. Files written
    at ``before`` (an instant in UTC) or later are not listed, so the files of an inventory
    up to the same instant are loaded and no others, without a join. ``glob`` restricts
    file names. If ``inventory`` (``filePath``) has files that are not listed any more, as they
    were written anew, just its files are read by name. ``counts`` are told how many rows are
    read, appended and written to the curated table, and how many are malformed. ``batches``
    (``filePath``, ``batch``) tell which files come later: an upsert gives the rows of a merge of batch after batch.

    Unless told otherwise, a ledger below the root keeps which files were appended to the
    standardised table: a load that is repeated, whole or after a failure, adds none
    of them again. The curated table gets all rows of the load either way.

    Rows are parsed once: the standardised append, the curated write and the
    export share one persisted frame, which Spark rebuilds from the raw files
    if an executor is lost.
    """
    exported = spec.destination == EXPORT_DESTINATION
    if exported and not options.export_url:
        raise ValueError(f"{spec.name} is exported to a database, but no export_url is given")
    zones = {zone: f"{root.rstrip('/')}/{zone}" for zone in ("curated", "standardised")}
    is_json = spec.fmt == "json"
    curated = zone_path(root, "curated", spec.curated_path)
    if is_json:
        curated = json_table_path(zones["curated"], spec.name)
    if paths is None:
        paths = [p for r in raw_roots(spec, root) for p in raw_subtrees(spark, r, after)]
    paths = list(paths)
    if not paths:
        log.info("%s has no new files", spec.name)
        return curated
    raw, files = _listed(spark, spec, paths, options, after, timed, before=before, glob=glob)
    if inventory is not None and len(files) < inventory.count():
        # Some were written anew since the inventory was taken; the mark will pass them.
        paths = [literal_path(r[0]) for r in inventory.select("filePath").collect()]
        raw, files = _listed(spark, spec, paths, options, after, timed)
    if raw is None:
        log.info("%s has no new files", spec.name)
        return curated
    ledger = f"{root.rstrip('/')}/ledger"

    def watched(step: str) -> Watch:
        return (lambda df: counts.watch(df, spec.name, step)) if counts is not None else unwatched

    def append(df: DataFrame, path: str, name: str, level: str | None, step: str) -> None:
        if options.once:
            append_once(df, path, ledger, name, level, files, watch=watched(step))
        elif level is not None:
            append_standardised(watched(step)(df), path, level)
        else:
            watched(step)(df).write.mode("append").parquet(path)

    raw, kept = watched("read")(raw), None
    if options.quarantine and spec.fmt != "parquet":
        kept = raw.persist(options.storage or StorageLevel.DISK_ONLY)
        raw, malformed = split_malformed(kept)
        append(malformed, f"{root.rstrip('/')}/quarantine/{spec.name}", f"quarantine/{spec.name}", None, "malformed")
    if is_json:
        try:
            once = partial(append, name=f"json/{spec.name}", level=None, step="appended")
            write_json_latest(raw, spec.name, **zones, append=once, watch=watched("written"))
        finally:
            if kept is not None:
                kept.unpersist()
        if exported:
            _export(spark.read.parquet(curated), spec, options)
        return curated
    table = shaped(raw, spec)
    if options.storage is not None and kept is None:
        table = kept = table.persist(options.storage)
    try:
        append(table, f"{zones['standardised']}/{spec.name}", spec.name, options.level, "appended")
        final = cleaned(table, spec)
        if batches is not None:
            final = numbered(final, batches)
        write_curated(final, spec, curated, watched("written"))
        if exported and spec.scheme == "Latest":
            # The curated table holds just these rows, so no second window is needed.
            _export(spark.read.parquet(curated), spec, options)
        elif exported:
            _export(latest_rows(final, spec.keys), spec, options)
    finally:
        if kept is not None:
            kept.unpersist()
    return curated


def numbered(rows: DataFrame, batches: DataFrame) -> DataFrame:
    """``rows`` with the number of their file's batch, from 1, as an upsert takes it."""
    last = batches.select(files_path(F.col("filePath")).alias("__file"), "batch").groupBy("__file").agg(F.max("batch").alias("__batch"))
    rows = rows.join(broadcast_if_small(last), plain_path(F.col(PATH)) == F.col("__file"), "left")
    return rows.withColumn(FROM_DELTA, F.coalesce(F.col("__batch") + 1, F.lit(1))).drop("__file", "__batch")


def _listed(
    spark: SparkSession,
    spec: TableSpec,
    paths: list[str],
    options: LoadOptions,
    after: dt.datetime | None,
    timed: bool,
    before: dt.datetime | None = None,
    glob: str | None = None,
) -> tuple[DataFrame | None, list[str]]:
    """A load's raw rows (None without a file) and the files that they are read from."""
    text = options.text(spec) if spec.fmt == "csv" else {}
    names = {"pathGlobFilter": glob} if glob else {}
    given = {"options": names, "before": before, **text}
    try:
        if options.quarantine and spec.fmt != "parquet":
            raw = read_permissive(spark, paths, spec.fmt, spec.raw_schema(), **given)
        elif options.own_headers and spec.fmt == "csv":
            raw = read_by_header(spark, paths, **given)
        else:
            raw = read_raw(spark, paths, spec.fmt, spec.raw_schema(), **given)
    except AnalysisException as error:
        # Without a file there is no header to take the columns from.
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None, []
    files = listed_files(raw)
    if after is not None:
        raw = raw.filter(ingestion_time(F.col(PATH)) > naive_time(after))
        files = [f for f in files if (time := path_time(f)) and time > after]
    elif timed:
        # A filter on the path alone prunes files while planning.
        raw = raw.filter(F.col(PATH).rlike(INGESTION_PATTERN))
        files = [f for f in files if path_time(f)]
    return raw, files


def _export(df: DataFrame, spec: TableSpec, options: LoadOptions) -> None:
    write_jdbc(
        df,
        options.export_url,
        f"{spec.external_schema}.{spec.external_table}",
        properties=options.export_properties,
        truncate=options.export_truncate,
        num_partitions=options.export_partitions,
        batch_size=options.export_batch_size,
    )


def load_dataset(
    spark: SparkSession,
    root: str,
    datasets: DataFrame,
    tables: DataFrame,
    columns: DataFrame,
    dataset: str,
    table: str | None = None,
    since: dt.datetime | None = None,
    options: LoadOptions = LoadOptions(),
    parallel: int = 1,
    by_extension: bool = False,
    json_tables: DataFrame | None = None,
    counted: bool = False,
) -> str:
    """Load every configured table of a dataset; returns the run summary as JSON.

    ``since`` replaces the stored mark. ``parallel`` tables load at a time. With
    ``by_extension`` only files with the dataset's extension count (JSON tables have
    their own). ``json_tables`` are loaded as well. The inventory and all loads read files written before one instant, taken
    first: what the summary reports as the next mark is what was loaded. Raw files
    must not be changed while they are loaded.

    ``counted`` adds ``tables`` to the summary: rows read, appended and written by table, which
    are counted as they pass.

    With ``LoadOptions.batch_bytes`` an upsert loads its files in batches, oldest first: each file
    has the number of its batch, and one merge over all of them keeps the rows that a merge after
    each batch would. Batches with a quarantine or an export are loaded one by one. Nothing but such a
    batch is persisted; tables, and those that are replaced as a whole, read their raw files again instead.
    """
    header = dataset_header(datasets, dataset).first()
    if header is None:
        raise ValueError(f"no dataset is configured as {dataset!r}")
    after = floor_time(since or header["MaxIngestionDate"], "hour")
    before = this_instant()
    until = before + dt.timedelta(days=1)
    if options.copies and not options.export_url:
        raise ValueError("tables are copied to a database, but no export_url is given")
    specs = load_specs(tables, columns, dataset, table)
    from_json = json_specs(json_tables, dataset) if json_tables is not None else []
    configured_json = [s for s in from_json if table in (None, "", s.name)]
    specs += configured_json
    configured = {zone_path(root, "raw", p): p for s in specs for p in s.raw_paths}
    files = file_inventory(spark, configured, after=after, until=until, others=False, before=before)
    if configured:
        pairs = [F.lit(part) for pair in configured.items() for part in pair]
        owner = F.element_at(F.create_map(*pairs), F.col("DataLakePathRaw"))
        files = files.withColumn("DataLakePathRaw", owner)
    extension = header["FlatFileExtension"]
    extension = extension.lstrip(".") if by_extension and extension else None
    if extension:
        text = sorted({p for s in specs if s.fmt != "json" for p in s.raw_paths})
        named = F.col("filePath").endswith(f".{extension}")
        files = files.filter(named | ~F.col("DataLakePathRaw").isin(text))
    files = files.persist()
    try:
        groups = load_groups(files_to_tables(files, config_rows(tables, dataset, table)))
        fed = {r[0] for r in groups.select("CuratedTableName").distinct().collect()}
        if configured_json:
            arrived = {r[0] for r in files.select("DataLakePathRaw").distinct().collect()}
            fed |= {s.name for s in configured_json if arrived & set(s.raw_paths)}
        # Loads of one table share a standardised folder and follow each other.
        ready: dict[str, list[TableSpec]] = {}
        for spec in specs:
            if spec.name in fed:
                ready.setdefault(spec.name, []).append(spec)

        counts = RowCounts() if counted else None

        def run(loads: list[TableSpec]) -> None:
            for spec in loads:
                own = files.filter(F.col("DataLakePathRaw").isin(list(spec.raw_paths)))
                glob = f"*.{extension}" if extension and spec.fmt != "json" else None
                chosen, limit = options, options.batch_bytes
                dealt = None
                if limit is not None and _loads_in_batches(spec):
                    dealt = size_batches(own.select("filePath", "fileSize", "ingestionDate"), limit)
                    # Nothing is persisted: raw text is read again for the append and for the merge.
                    chosen = replace(options, storage=None)
                if dealt is not None and (options.quarantine or spec.destination == EXPORT_DESTINATION):
                    # Malformed rows are persisted and exports follow each other batch by batch.
                    for paths in _batches(dealt):
                        load_table(spark, spec, root, paths, options=options, before=before, timed=True, counts=counts)
                    continue
                if dealt is None and limit is not None and (own.agg(F.sum("fileSize")).first()[0] or 0) > limit:
                    chosen = replace(options, storage=None)
                roots = raw_roots(spec, root)
                paths = [p for r in roots for p in raw_subtrees(spark, r, after, until)]
                load_table(
                    spark, spec, root, paths, options=chosen, before=before, glob=glob, timed=True, inventory=own, counts=counts,
                    batches=dealt,
                )

        with ThreadPoolExecutor(max(1, parallel)) as pool:
            list(pool.map(inheritable_thread_target(spark)(run), ready.values()))
        for path, external in options.copies.items():
            copy_to_jdbc(
                spark,
                zone_path(root, "curated", path),
                options.export_url,
                external,
                properties=options.export_properties,
            )
        summary = run_summary(files, "ingestionDate", "extractDate").first()["summary"]
        if counts is None:
            return summary
        return json.dumps({**json.loads(summary), "tables": counts.totals()})
    finally:
        files.unpersist()


def _loads_in_batches(spec: TableSpec) -> bool:
    """Upserts merge batch after batch; other tables are replaced as a whole."""
    return spec.fmt != "json" and spec.role == UPSERT_ROLE and spec.scheme not in ("Latest", "Legacy")


def _batches(dealt: DataFrame) -> Iterator[list[str]]:
    """The paths of each batch; the driver holds those of one batch at a time."""
    dealt = dealt.persist()
    try:
        last = dealt.agg(F.max("batch")).first()[0]
        for k in range(0 if last is None else last + 1):
            chosen = dealt.filter(F.col("batch") == k).select("filePath")
            yield [literal_path(r[0]) for r in chosen.orderBy("filePath").collect()]
    finally:
        dealt.unpersist()


def load_configured(
    spark: SparkSession, config: DatasetConfig, dataset: str, **options: object
) -> str:
    """Load a dataset by its configuration alone: root, mark, tables, columns, extension.

    ``options`` are those of ``load_dataset``.
    """
    root = config.roots.first()
    if root is None:
        raise ValueError("the configuration names no root folder")
    tables = config.tables
    return load_dataset(
        spark, root["DataLakeRootFolder"], config.datasets, tables, config.columns, dataset,
        **{"by_extension": True, "json_tables": config.json_tables, **options},
    )
