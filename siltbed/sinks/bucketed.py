"""Tables stored in buckets of their keys, so that a merge shuffles the delta alone.

Rows lie in buckets by ``KEY_HASH``, a hash of the keys that also tells nulls apart, which
bucketing by the keys themselves can't: Spark does not match null keys bucket by bucket. The
hash only brings rows together; keys are compared as such.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltbed.fixed_values import RECENCY
from siltbed.operators.columns import quoted
from siltbed.operators.latest import latest_rows

KEY_HASH = "__key_hash"
_NEW = "__new_"


def key_hash(keys: Iterable[str]) -> Column:
    """Spark's hash skips nulls, so whether a key is null counts as well."""
    return F.xxhash64(*[part for k in keys for part in (quoted(k).isNull(), quoted(k))])


def _write(df: DataFrame, table: str, buckets: int) -> None:
    df.write.format("parquet").mode("overwrite").bucketBy(buckets, KEY_HASH).sortBy(KEY_HASH).saveAsTable(table)


def create_bucketed(
    df: DataFrame, table: str, keys: Iterable[str], buckets: int, order: Iterable[str] = RECENCY
) -> None:
    """Store the newest row of each key in ``buckets`` buckets; choose them for the table's final size."""
    keys = list(keys)
    newest = latest_rows(df, keys, order=order).withColumn(KEY_HASH, key_hash(keys))
    _write(newest.repartition(buckets, KEY_HASH), table, buckets)


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).drop(KEY_HASH)


def merged_with_buckets(
    stored: DataFrame, delta: DataFrame, keys: Iterable[str], order: Iterable[str] = RECENCY
) -> DataFrame:
    """Rows of the stored table, with its hash, after the newest of each key in ``delta`` won; the delta on a tie.

    The stored side keeps its buckets: it is neither shuffled nor reduced again, since it has one row a
    key. Only the delta is shuffled, after each task dropped all but a key's newest rows.
    """
    keys, order = list(keys), list(order)
    names = [f.name for f in stored.schema if f.name != KEY_HASH]
    own = delta.select(*[quoted(f.name).cast(f.dataType).alias(f.name) for f in stored.schema if f.name != KEY_HASH])
    newest = latest_rows(own, keys, order=order).withColumn(KEY_HASH, key_hash(keys))
    new = newest.select(*[quoted(c).alias(f"{_NEW}{c}") for c in [*names, KEY_HASH]], F.lit(True).alias(f"{_NEW}here"))
    old = stored.withColumn("__old_here", F.lit(True))
    hashes = quoted(KEY_HASH) == quoted(f"{_NEW}{KEY_HASH}")
    alike = reduce(and_, [quoted(k).eqNullSafe(quoted(f"{_NEW}{k}")) for k in keys])
    # Written so that Spark joins on the hash alone, as the buckets are, and checks the keys after.
    joined = old.join(new, hashes & (alike | ~hashes), "full_outer")
    ages = [F.struct(*[quoted(f"{prefix}{c}") for c in order]) for prefix in (_NEW, "")]
    wins = F.col("__old_here").isNull() | (F.col(f"{_NEW}here").isNotNull() & (ages[0] >= ages[1]))
    return joined.select(*[F.when(wins, quoted(f"{_NEW}{c}")).otherwise(quoted(c)).alias(c) for c in [*names, KEY_HASH]])


def merge_bucketed(
    delta: DataFrame, table: str, keys: Iterable[str], buckets: int, order: Iterable[str] = RECENCY
) -> None:
    """Merge ``delta`` into a bucketed table; its replacement is written beside it and then renamed."""
    spark = delta.sparkSession
    if not spark.catalog.tableExists(table):
        create_bucketed(delta, table, keys, buckets, order)
        return
    following = f"{table}__next"
    _write(merged_with_buckets(spark.table(table), delta, keys, order), following, buckets)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {table.rsplit('.', 1)[-1]}")
