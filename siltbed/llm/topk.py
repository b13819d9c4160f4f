"""Exact top-k inner products, norm-sorted, with SVD-rotated partial sums.

Vectors become whole numbers, floor(scale * x). Their second moments (a d x d matrix,
summed over all rows) give the rotation that gathers their length in the first
dimensions; d is bounded by the data model, not by the number of rows. Candidates are
sorted by length, longest first, and cut into blocks of ``BLOCK`` rows; queries are cut
into blocks of ``QUERIES``. Every query meets the first block, which sets its
threshold: its k-th best score there. A pair of blocks is only visited if the product of
a query's length and the block's greatest length reaches the threshold (Cauchy-Schwarz).
Within a pair the first ``HEAD`` rotated dimensions are multiplied out, and the product
of what is left of both lengths bounds the rest; only pairs whose bound reaches the
threshold get their exact score, from the whole numbers. Bounds are widened by a
relative slack that is far above rounding, so no result is lost. The query set is
compared in blocks; each pair of blocks is a row, handled by one task in bounded memory.

Vectors that are null or hold null or non-finite components, and rows without an id, take
no part. Shorter vectors count as padded with zeros. Rows with one id and vector count
once; a row is no candidate for a query of its own id. An empty table gives an empty
result. Scores beyond 64 bits become the nearest 64-bit number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from siltbed.llm.common import batches_of, map_batches, sorted_groups, written

K = 5
SCALE = 256
QUERY_EVERY = 50
BLOCK = 4096
QUERIES = 1024
HEAD = 16
#: Candidates bounded at once, and pairs scored at once.
STEP, AT_ONCE = 512, 65_536
SLACK = 1e-9
#: Sums of products of whole numbers below this are exact in doubles.
EXACT = 2**53


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v (doubles that are whole numbers) of the rows that take part."""

    def whole(c: Column) -> Column:
        c = c.cast("double")
        # From 2 ** 45 on a double times 256 is whole, and may be too large for a long.
        return F.when(F.abs(c) < 2.0**45, F.floor(c * scale).cast("double")).otherwise(c * scale)

    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    kept = rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
    return kept.select(F.col("vec_id").cast("long"), F.transform("embedding", whole).alias("v")).distinct()


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, padded with zeros."""
    lengths = column.value_lengths().to_numpy()
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all rows, by falling singular value."""

    def moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = matrix(batch["v"], width)
            total += x.T @ x
        i = np.repeat(np.arange(width), width)
        j = np.tile(np.arange(width), width)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "m"])

    sums = map_batches(vectors.select("v"), moments, "i long, j long, m double").groupBy("i", "j")
    total = np.zeros((width, width))
    for row in sums.agg(F.sum("m").alias("m")).collect():  # width x width numbers
        total[row["i"], row["j"]] = row["m"]
    if not np.isfinite(total).all():
        return np.eye(width)
    return np.linalg.eigh((total + total.T) / 2)[1][:, ::-1]


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of whole numbers as 64-bit whole numbers."""
    bound = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if bound < EXACT:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    sums = [sum(int(x) * int(y) for x, y in zip(p, q)) for p, q in zip(a, b)]
    return np.array([max(-(2**63), min(2**63 - 1, s)) for s in sums], np.int64)


def best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best, ties to the smaller id."""
    order = np.lexsort((ids, ~scores, query))  # ~x falls as x rises, without overflow
    starts = np.flatnonzero(np.r_[True, query[order][1:] != query[order][:-1]])
    sizes = np.diff(np.r_[starts, len(order)])
    return order[np.arange(len(order)) - np.repeat(starts, sizes) < k]


def _cut(width: int, rows: int) -> Callable:
    """Rows of each ``key``, in order, as blocks: key, greatest length, ids and vectors."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["key"]):
            for part in batches_of([group], rows):
                v = matrix(part["v"], width)
                ids = part["vec_id"].to_numpy().astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [
                        part["key"].slice(0, 1).cast(pa.int64()),
                        pa.array([max(part["norm"].to_pylist())], pa.float64()),
                        pa.array([ids.tobytes()], pa.binary()),
                        pa.array([v.astype("<f8").tobytes()], pa.binary()),
                    ],
                    ["key", "longest", "ids", "v"],
                )

    return cut


def _floors(ids: np.ndarray, known: list[tuple[int, int]] | None) -> np.ndarray:
    """Thresholds of queries; minus infinity where there is none."""
    found = dict(known or ())
    return np.array([found.get(i, -np.inf) for i in ids.tolist()], float)


def _needed(width: int) -> Callable:
    """The least length at which a candidate can reach a threshold of a block of queries."""

    def needed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = []
            for row in batch.to_pylist():
                ids, q = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["v"], "<f8").reshape(-1, width)
                floors, norms = _floors(ids, row["floors"]), np.sqrt((q * q).sum(axis=1))
                with np.errstate(all="ignore"):
                    lengths = np.where(floors > 0, floors / norms, 0.0)
                least.append(float(np.nan_to_num(lengths, nan=0.0).min(initial=np.inf) * (1 - SLACK)))
            yield pa.RecordBatch.from_arrays([batch["part"], pa.array(least, pa.float64())], ["part", "least"])

    return needed


def _compare(width: int, turn: np.ndarray, head: int, k: int) -> Callable:
    """The k best of each query within a pair of blocks."""

    def pair(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, other = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["c_ids"], "<i8")
        q, c = (np.frombuffer(row[n], "<f8").reshape(-1, width) for n in ("v", "c_v"))
        floors = _floors(ids, row["floors"])
        q_head, c_head = q @ turn[:, :head], c @ turn[:, :head]
        q_all, c_all = (q * q).sum(axis=1), (c * c).sum(axis=1)
        q_rest = np.sqrt(np.maximum(q_all - (q_head**2).sum(axis=1), 0))
        c_rest = np.sqrt(np.maximum(c_all - (c_head**2).sum(axis=1), 0))
        q_all, c_all = np.sqrt(q_all), np.sqrt(c_all)
        dense = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * width < EXACT
        at, near, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for start in range(0, len(c), STEP):
            part = slice(start, start + STEP)
            bound = q_head @ c_head[part].T + np.outer(q_rest, c_rest[part])
            bound += SLACK * np.outer(q_all, c_all[part])
            # A bound that is no number counts as reached.
            reached = ~(bound < floors[:, None]) & (ids[:, None] != other[None, part])
            i, j = np.nonzero(reached)
            if not len(i):
                continue
            if dense and 8 * len(i) > reached.size:
                new = (q @ c[part].T)[i, j].astype(np.int64)
            else:
                new = np.concatenate([
                    exact_scores(q[i[n : n + AT_ONCE]], c[part][j[n : n + AT_ONCE]]) for n in range(0, len(i), AT_ONCE)
                ])
            at, near, score = np.r_[at, i], np.r_[near, other[part][j]], np.r_[score, new]
            kept = best(at, near, score, k)
            at, near, score = at[kept], near[kept], score[kept]
            full = np.bincount(at, minlength=len(ids)) == k
            lowest = np.full(len(ids), np.iinfo(np.int64).max)
            np.minimum.at(lowest, at, score)
            floors = np.where(full, np.maximum(floors, lowest), floors)
        return ids[at], near, score

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, 1):
            row = batch.to_pylist()[0]
            with np.errstate(all="ignore"):
                query, near, score = pair(row)
            part = np.full(len(query), row["part"], np.int64)
            yield pa.RecordBatch.from_arrays(list(map(pa.array, (part, query, near, score))), ["part", "query_id", "vec_id", "score"])

    return compare


def top_k(
    rows: DataFrame, k: int = K, scale: int = SCALE, query_every: int = QUERY_EVERY,
    block: int = BLOCK, queries: int = QUERIES, head: int = HEAD,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best candidates."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c))
    vectors = written(whole_vectors(rows, scale).withColumn("norm", norm), "vectors")
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    n, width = size["n"], max(1, size["width"] or 1)
    turn, head = rotation(vectors, width), min(head, width)

    # Ranges of falling length, one or more blocks each; block 0 has the longest.
    by_length = vectors.repartitionByRange(max(1, -(-n // block)), F.desc("norm"), "vec_id")
    by_length = by_length.sortWithinPartitions(F.desc("norm"), "vec_id").withColumn("key", F.spark_partition_id())
    schema = "key long, longest double, ids binary, v binary"
    blocks = written(map_batches(by_length, _cut(width, block), schema), "blocks")
    blocks = blocks.select(F.col("key").alias("block"), "longest", F.col("ids").alias("c_ids"), F.col("v").alias("c_v"))
    ranges = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    # Queries by a hash of their id, so that every block of them has all lengths.
    parts = max(1, -(-n // (query_every * queries)))
    asked = vectors.filter(F.col("vec_id") % query_every == 0)
    asked = asked.withColumn("key", F.pmod(F.xxhash64("vec_id"), F.lit(parts)))
    asked = asked.repartition(parts, "key").sortWithinPartitions("key", "vec_id")
    asked = written(map_batches(asked, _cut(width, queries), schema), "queries")
    asked = asked.select(F.col("key").alias("part"), "ids", "v")

    # The longest candidates set the thresholds.
    compare, pair_schema = _compare(width, turn, head, k), "part long, query_id long, vec_id long, score long"
    columns = ["part", "ids", "v", "c_ids", "c_v", "floors"]
    first = max(1, min(ranges, ranges * block // max(1, n)))
    none = F.lit(None).cast("array<struct<query_id:bigint,floor:bigint>>")
    start = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(first - 1)))).withColumn("floors", none)
    start = start.join(blocks.filter(F.col("block") < first), "block")
    found = written(map_batches(start.select(*columns), compare, pair_schema), "first_found")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    floors = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") == k)
    floors = floors.groupBy("part").agg(F.collect_list(F.struct("query_id", F.col("score").alias("floor"))).alias("floors"))
    asked = written(asked.join(floors, "part", "left"), "asked")

    # A block is visited if its greatest length can still reach a threshold.
    least = map_batches(asked.select("part", "ids", "v", "floors"), _needed(width), "part long, least double")
    least = least.groupBy("part").agg(F.min("least").alias("least"))
    pairs = least.withColumn("block", F.explode(F.sequence(F.lit(first), F.lit(max(first, ranges - 1)))))
    longest = blocks.filter(F.col("block") >= first).groupBy("block").agg(F.max("longest").alias("longest"))
    pairs = pairs.join(longest, "block").filter("longest >= least").select("part", "block")
    pairs = pairs.join(asked, "part").join(blocks, "block").select(*columns)
    more = map_batches(pairs, compare, pair_schema)
    ranked = found.unionByName(more).withColumn("rank", F.row_number().over(place))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
