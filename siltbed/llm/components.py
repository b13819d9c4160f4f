"""Connected components of a distributed edge list by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltbed.llm.common import written


def connected_components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for edges of two longs ``a``, ``b``.

    Large stars link a node's larger neighbours to its smallest one, small stars the
    smaller ones; what is left are stars around the smallest nodes. Each round is
    written, so a lost executor costs one round; its edges are counted, so that a few
    get few files, the first ones too if ``most``, a bound on the edges, is known. Minima are combined before they
    shuffle, and a hub's edges are joined to its minimum by a join that Spark can split.
    Loops and repeated edges do no harm; nodes without edges don't appear.
    """
    now, mark = written(_oriented(edges), "edges", most), None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
        most = 2 * seen[0]  # rows of each table of this round
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least", most)
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(_oriented(large), "large_stars", most)
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "least", most)
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        now = written(_oriented(small), "edges", most)
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = now.groupBy("b").agg(F.lit(1)).select(F.col("b").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(centres)


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node to the smaller."""
    return (
        edges.filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
