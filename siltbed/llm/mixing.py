r"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Sources take ``WEIGHTS`` in turn, in code point order, null last. Their targets share
the size of all documents by weight; a target above ``MAX_EPOCHS`` times its source is
clamped there, and the excess goes to the others by weight, round by round, until none
is above. Targets come from whole numbers and one division, so they don't depend on the
order of rows or partitions.

A source's documents are taken ``floor(target / size)`` times each. The rest of its
target is met by one more repetition of the documents with the smallest seeded hash of
their id, up to the hash where the words taken are nearest to the target. The hash's
high bits form buckets; bucket sums find where a source's target falls, and only that
bucket's documents are looked at one by one, so a source with a third of all rows is
never sorted as a whole.

Null text has size 0. Rows of one id share a hash, so they get an extra repetition
together. A source of size 0 has target 0. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siltbed.llm.common import written

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Hex digits of the 15 that name a bucket: 16 ** 3 buckets for each source.
BUCKET_DIGITS = 3

SIZE, PLACE, BUCKET = "__size", "__place", "__bucket"


def word_count(text: Column) -> Column:
    """Number of runs without white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def place(doc_id: Column, seed: str = SEED) -> Column:
    """Seeded place of a document in its source: 60 bits of a hash of its id."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """Sources with their size and their rank from 0, numbered without one task for all.

    Ranges of sources are numbered apart; a range's first number is the count below it.
    """
    totals = sizes.groupBy("source").agg(F.sum(SIZE).alias("source_size"))
    low = F.monotonically_increasing_id()
    numbered = written(
        totals.withColumn("__key", F.struct(F.col("source").isNull(), "source"))
        .repartitionByRange("__key")
        .sortWithinPartitions("__key")
        .drop("__key")
        .withColumn("__low", low),
        "sources",
    )
    numbered = numbered.withColumns(
        {
            "__range": F.shiftright("__low", 33),
            "__within": F.col("__low").bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )
    counts = numbered.groupBy("__range").agg(F.count(F.lit(1)).alias("__count"))
    below = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.withColumn("__first", F.coalesce(F.sum("__count").over(below), F.lit(0)))
    return numbered.join(first.drop("__count"), "__range").select(
        "source", "source_size", (F.col("__first") + F.col("__within")).alias("rank")
    )


def water_fill(sources: DataFrame, epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to sources with source_size and weight.

    Each round clamps the sources above their cap; all but the last clamps one at least.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * epochs
    room, share, clamped = total, None, 0
    # The level only rises, so a source once clamped stays so: a round needs only the level.
    level = (0, 1)
    while True:
        above = cap * F.lit(level[1]) <= F.col("weight") * F.lit(level[0])
        held = sources.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)).alias("size"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weight"),
            F.count(F.when(above, 1)).alias("n"),
        ).first()
        room, share = total - held["size"], held["weight"]
        if not share or (held["n"] == clamped and level != (0, 1)):
            break
        clamped, level = held["n"], (room, share)
    free = (F.lit(float(room)) * F.col("weight") / F.lit(float(share or 1))).cast("double")
    return sources.withColumn("target", F.when(above, cap.cast("double")).otherwise(free))


def with_keys(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.withColumns({SIZE: word_count(F.col(text)), PLACE: place(F.col(doc_id))})


def mixing_plan(sizes: DataFrame, epochs: int = MAX_EPOCHS) -> DataFrame:
    """For each source: size, target, whole repetitions, and the last place that gets one more.

    ``sizes`` has source, the size and the place of each document, and is read twice.
    """
    weights = F.array(*map(F.lit, WEIGHTS))
    ranked = ranked_sources(sizes)
    weight = F.get(weights, (F.col("rank") % len(WEIGHTS)).cast("int")).cast("long")
    targets = water_fill(written(ranked.withColumn("weight", weight), "ranked_sources"), epochs)
    size = F.col("source_size")
    targets = targets.withColumn(
        "whole", F.when(size > 0, F.least(F.floor(F.col("target") / size), F.lit(epochs))).otherwise(0)
    ).withColumn("rest", F.col("target") - F.col("whole") * size)
    targets = written(targets.drop("rank", "weight"), "targets")

    bucket = F.shiftright(PLACE, 4 * (15 - BUCKET_DIGITS)).alias(BUCKET)
    sums = sizes.groupBy("source", bucket).agg(F.sum(SIZE).alias("n"))
    below = Window.partitionBy("source").orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(below), F.lit(0)))
    same = F.col("s.source").eqNullSafe(F.col("t.source"))
    # The bucket in which a source's rest is reached; without one, there is no rest.
    edges = written(
        sums.alias("s")
        .join(targets.alias("t"), same)
        .filter("rest > 0 and before < rest and before + n >= rest")
        .select("s.source", BUCKET, "before", "rest"),
        "edges",
    )
    inside = sizes.withColumn(BUCKET, bucket).alias("d").join(
        edges.alias("e"),
        F.col("d.source").eqNullSafe(F.col("e.source")) & (F.col(f"d.{BUCKET}") == F.col(f"e.{BUCKET}")),
    )
    inside = inside.groupBy("d.source", PLACE, "before", "rest").agg(F.sum(SIZE).alias("n"))
    upto = Window.partitionBy("source").orderBy(PLACE)
    inside = inside.withColumn("upto", F.col("before") + F.sum("n").over(upto))
    near = F.expr("upto <= rest or (upto - n < rest and upto - rest <= rest - (upto - n))")
    cut = inside.filter(near).groupBy("source").agg(F.max(PLACE).alias("cut"))
    # Where no document of the edge is near enough, all of the lower buckets still are.
    edge = edges.withColumn("lower", F.shiftleft(F.col(BUCKET), 4 * (15 - BUCKET_DIGITS)) - 1)
    cuts = edge.alias("e").join(cut.alias("c"), F.col("e.source").eqNullSafe(F.col("c.source")), "left")
    cuts = cuts.select("e.source", F.coalesce("cut", "lower").alias("cut"))
    plan = targets.alias("t").join(cuts.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")), "left")
    return written(
        plan.select("t.source", "source_size", "target", "whole", F.coalesce("cut", F.lit(-1)).alias("cut")),
        "mixing_plan",
    )


def planned(rows: DataFrame, plan: DataFrame, source: str) -> DataFrame:
    """``rows`` with the plan of their source and how often each is taken.

    The plan has one row a source; Spark broadcasts it only below its own threshold.
    """
    plan = plan.withColumnRenamed("source", "__plan_source")
    joined = rows.join(plan, F.col(source).eqNullSafe(F.col("__plan_source")))
    more = (F.col(PLACE) <= F.col("cut")).cast("long")
    return joined.withColumn("__times", F.col("whole") + more)


def mix_sizes(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, size, source_size, target, taken."""
    rows = with_keys(docs.select("doc_id", "source", "text"), "doc_id", "text")
    rows = written(rows.drop("text"), "sizes")
    return planned(rows, mixing_plan(rows), "source").select(
        "doc_id",
        F.col(SIZE).alias("size"),
        "source_size",
        "target",
        (F.col(SIZE) * F.col("__times")).alias("taken"),
    )


def mix(docs: DataFrame) -> DataFrame:
    """The documents of the mix with all their columns, repeated as often as taken."""
    names = {c: f"__in_{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    rows = with_keys(rows, names["doc_id"], names["text"])
    sizes = written(rows.select(F.col(names["source"]).alias("source"), SIZE, PLACE), "sizes")
    taken = planned(rows, mixing_plan(sizes), names["source"])
    copies = F.explode(F.sequence(F.lit(1), F.col("__times")))
    return taken.filter("__times > 0").withColumn("__copy", copies).select(
        *[F.col(n).alias(c) for c, n in names.items()]
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix-1'), 1, 15))::BIGINT AS place
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM d GROUP BY source
), o AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight,
    row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS k FROM s
), f AS (
  SELECT *, coalesce(sum(cap) OVER b, 0) AS caps, coalesce(sum(weight) OVER b, 0) AS weights FROM o
  WINDOW b AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (
  SELECT *, cap * (all_weight - weights) <= (total - caps) * weight AS clamped FROM f
), r AS (
  SELECT total - coalesce(sum(cap) FILTER (clamped), 0) AS room, sum(weight) FILTER (NOT clamped) AS share
  FROM c GROUP BY total
), t AS (
  SELECT source, source_size,
    CASE WHEN clamped THEN cap::DOUBLE ELSE room::DOUBLE * weight / share::DOUBLE END AS target FROM c, r
), w AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS whole FROM t
), p AS (
  SELECT d.*, source_size, target, whole, target - whole * source_size AS rest,
    sum(size) OVER (PARTITION BY d.source ORDER BY place) AS upto,
    sum(size) OVER (PARTITION BY d.source, place) AS n
  FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source
)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN rest > 0 AND (upto <= rest OR (upto - n < rest AND upto - rest <= rest - (upto - n)))
    THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""
