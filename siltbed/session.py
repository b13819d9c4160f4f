"""Session helpers: a local session for tests, and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from siltbed.sources import storage


def local_session(app: str = "siltbed", cpus: str | int = "*") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SILTBED_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a session that names none (a local test) gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="siltbed-")
        storage.delete_on_exit(spark, folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, removed when the session's JVM ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/siltbed/{uuid.uuid4().hex}"
    storage.delete_on_exit(spark, folder)
    return f"{folder}/{name}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that losing an executor does not recompute it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own automatic broadcast threshold in bytes (negative: off)."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if text.startswith("-"):
        return -1
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Mark ``df`` for broadcast if it fits the session's own threshold.

    Where the planner's statistics already say so, nothing runs (they take nested
    columns for a default size, so frames with such are always measured). Otherwise ``df`` is
    materialised and measured; above the threshold it is returned unmarked, and the
    join is a shuffle join, where adaptive execution splits skewed partitions. Spark
    removes the checkpoint with the frame if ``spark.cleaner.referenceTracking.
    cleanCheckpoints`` is set.
    """
    limit = broadcast_limit(df.sparkSession)
    nested = any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in df.schema)
    if not nested and _planned_bytes(df) <= limit:
        return F.broadcast(df)
    small = checkpointed(df)
    sized = [F.coalesce(_bytes_of(f), F.lit(0)) for f in small.schema.fields if _varies(f.dataType)]
    varying = sum(sized[1:], sized[0]) if sized else F.lit(0)
    size = small.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(varying), F.lit(0)).alias("varying")
    ).first()
    estimate = size["rows"] * (16 + 16 * len(small.columns)) + size["varying"]
    return F.broadcast(small) if estimate <= limit else small


def _planned_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _varies(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))


def _bytes_of(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.octet_length(column)
    # Twice the text of a nested value covers its offsets and numbers.
    return 2 * F.octet_length(F.to_json(F.struct(column)))
