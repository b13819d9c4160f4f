"""Merging newly arrived files into a curated table as a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from siltbed.fixed_values import EXTRACT, PATH, RECENCY
from siltbed.functions.paths import dates_from_path
from siltbed.sinks.lake import merge_full, upsert_partitions
from siltbed.sources.files import raw_options


_SEEN_AT = "__seen_at"


def stream_upsert(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    target: str,
    keys: Iterable[str],
    checkpoint: str,
    partition_cols: Iterable[str] = (),
    fmt: str = "csv",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    options: Mapping[str, object] | None = None,
    max_files: int | None = None,
    order: Iterable[str] = RECENCY,
    repeated_within: str | None = None,
    append: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Process each file below ``source`` once, then stop; start again for new files.

    The checkpoint replaces the stored mark. A batch that is repeated after a
    failure merges to the same table, so files count exactly once. Without
    ``partition_cols`` every batch rewrites the whole target, which suits small
    tables only.

    With ``repeated_within`` (an interval) a row that comes again under another file name,
    with the same keys and extract time, is dropped before it is merged: Spark keeps the
    keys that it saw for that long, by extract time, also from one start to the next, and
    drops those that fall behind. A row that arrives later than that after newer ones is dropped
    as late, so it should be longer than files can be delayed. ``append`` replaces the
    merge; Spark gives it each batch and its number.
    """
    keys, cols, order = list(keys), list(partition_cols), list(order)
    reader = spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    arrived = reader.options(**{**raw_options(fmt), **(options or {})}).load(source)
    rows = dates_from_path(arrived.withColumn(PATH, F.col("_metadata.file_path")))
    if prepare is not None:
        rows = prepare(rows)

    if repeated_within is not None:
        # Spark's watermark needs a zoned time; null times would never leave the state.
        rows = rows.filter(F.col(EXTRACT).isNotNull()).withColumn(_SEEN_AT, F.col(EXTRACT).cast("timestamp"))
        rows = rows.withWatermark(_SEEN_AT, repeated_within).dropDuplicatesWithinWatermark([*keys, *cols, _SEEN_AT])
        rows = rows.drop(_SEEN_AT)

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if cols:
                upsert_partitions(batch, target, keys, cols, order)
            else:
                merge_full(batch, target, keys, order=order)
        finally:
            batch.unpersist()

    return (
        rows.writeStream.foreachBatch(append or merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
