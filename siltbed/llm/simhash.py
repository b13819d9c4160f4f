r"""SimHash near-duplicates by anchor-point covering.

Fingerprints: 64 bits; a bit is 1 if it is set in over half of the XXH64 hashes of a
text's 4-word shingles. Two texts link at ``MAX_BITS`` or fewer differing bits.

Covering: the 64 bits are split into blocks of 22, 21 and 21. Of two fingerprints with
at most 4 differing bits, one block has at most 1 of them. The anchors of a block are
the 4,096 words of the binary Golay code, whose covering radius is 3: every block value
is within 3 of an anchor, and a value that differs from it by 1 is within 4 of the same
anchor. So each distinct fingerprint goes to all anchors within 4 of each of its blocks
(5.3 on average, 16 in all), and every link is found at an anchor both have.

Only distinct fingerprints are compared, so exact copies cost nothing. An anchor's
fingerprints are compared in one task up to ``CHUNK``; beyond that they are dealt into
chunks by hash and every two chunks are compared in a task of their own. A task returns
a spanning forest of its links (at most one edge for each of its fingerprints), never
all pairs of a group; connected components join the forests.

``drop_near_duplicates``, the stage, proposes by the same fingerprints, anchors and forests, and verifies each
link by the whole shingle sets (a similarity of 0.8). So few bits don't show all similar texts, and an exact
way finds the rest; see ``shingles``.

Null and empty texts, and texts of white space, have fingerprint zero and link like any
others. Rows without an id don't name a component, but do link. Repeated rows get the
same result each. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from siltbed.llm.common import batches_of, map_batches, sorted_groups, written
from siltbed.llm.components import connected_components
from siltbed.llm.shingles import similar_groups

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
#: First bit and number of bits of each block.
BLOCKS = ((0, 22), (22, 21), (43, 21))
RADIUS = 3
#: Generator polynomial of the binary Golay code of length 23 (fixed value).
GOLAY = 0b110001110101
CHUNK = 2048
#: Shingles hashed at once.
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Fingerprint of a whole text."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(parts) - words + 1].tolist()
    ends = ends[words - 1 :].tolist()
    digest, set_bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        spans = zip(starts[at : at + SHINGLES_AT_ONCE], ends[at : at + SHINGLES_AT_ONCE])
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` without its text, with fingerprint, second (0) and their node as longs."""
    others = [c for c in docs.columns if c != "text"]

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            texts = batch["text"].to_pylist()
            one = np.array([fingerprint(t) for t in texts], np.uint64)
            two = np.zeros_like(one)
            added = [pa.array(x.view(np.int64)) for x in (one, two, nodes(one, two))]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in others), *added], [*others, "fingerprint", "second", "node"]
            )

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in others), "fingerprint long, second long, node long"])
    return map_batches(docs, compute, schema)


def nodes(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """A name for each pair of fingerprints; the first itself where there is no second."""
    out = two * np.uint64(0x9E3779B97F4A7C15)
    return one ^ out ^ (out >> np.uint64(29))


@functools.cache
def _golay(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the 23 bits, and by remainder the errors of at most so many bits."""
    remainders = []
    for i in range(23):
        value = 1 << i
        for shift in range(value.bit_length() - 12, -1, -1):
            if value >> (shift + 11) & 1:
                value ^= GOLAY << shift
        remainders.append(value)
    by_rest: list[list[int]] = [[] for _ in range(2048)]

    def add(first: int, error: int, rest: int, left: int) -> None:
        by_rest[rest].append(error)
        if left:
            for i in range(first, 23):
                add(i + 1, error | 1 << i, rest ^ remainders[i], left - 1)

    add(0, 0, 0, most)
    width = max(map(len, by_rest))
    table = np.full((2048, width), -1, np.int64)
    for rest, errors in enumerate(by_rest):
        table[rest, : len(errors)] = errors
    return np.array(remainders, np.int64), table


def anchors(values: np.ndarray, apart: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and anchor of each anchor within RADIUS + apart of the given block values."""
    remainders, table = _golay(RADIUS + apart)
    rest = np.zeros(len(values), np.int64)
    for i in range(23):
        rest ^= np.where(values >> i & 1, remainders[i], 0)
    errors = table[rest]
    rows, places = np.nonzero(errors >= 0)
    return rows, values[rows] ^ errors[rows, places]


def forest(one: np.ndarray, two: np.ndarray, bits: int, both: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges between the nodes of a spanning forest of the links between fingerprints."""

    def near(i: int, places: np.ndarray) -> np.ndarray:
        first = np.bitwise_count(one[places] ^ one[i])
        return (first <= bits) & (first + np.bitwise_count(two[places] ^ two[i]) <= both)

    linked = np.zeros(len(one), bool)
    for at in range(0, len(one), 512):
        apart = np.bitwise_count(one[at : at + 512, None] ^ one[None, :])
        linked[at : at + 512] = (apart <= bits).sum(axis=1) > 1
    left = np.flatnonzero(linked)
    a, b = [], []
    while len(left):
        root, left = left[0], left[1:]
        reached = [root]
        while reached and len(left):
            hit = near(reached.pop(), left)
            if hit.any():
                found, left = left[hit], left[~hit]
                reached.extend(found)
                a.extend(found)
                b.extend([root] * len(found))
    names = nodes(one, two)
    return names[np.array(a, np.int64)], names[np.array(b, np.int64)]


def links(prints: DataFrame, bits: int = MAX_BITS, both: int = 2 * 64, chunk: int = CHUNK) -> DataFrame:
    """Edges ``a``, ``b`` that join all linked nodes of distinct fingerprint and second."""

    def replicate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, 8192):
            one, two = (batch[c].to_numpy() for c in ("fingerprint", "second"))
            for block, (first, width) in enumerate(BLOCKS):
                values = one.view(np.uint64) >> np.uint64(first) & np.uint64((1 << width) - 1)
                rows, near = anchors(values.astype(np.int64), bits // len(BLOCKS))
                anchor = (block << 23 | near).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, (anchor, one[rows], two[rows]))], ["anchor", "fingerprint", "second"]
                )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["anchor", "p", "q"]):
            one, two = (group[c].to_numpy().view(np.uint64) for c in ("fingerprint", "second"))
            a, b = forest(one, two, bits, both)
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
                )

    near = written(map_batches(prints, replicate, "anchor int, fingerprint long, second long"), "replicas")
    # One row an anchor: at most 3 x 4,096, whatever the input.
    sizes = near.groupBy("anchor").count().filter("count > 1")
    chunks = F.ceil(F.col("count") / chunk)
    near = near.join(F.broadcast(sizes.select("anchor", chunks.alias("chunks"))), "anchor")
    own = F.pmod(F.xxhash64("fingerprint", "second"), F.col("chunks"))
    near = near.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = near.select(
        "anchor", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "fingerprint", "second"
    )
    dealt = dealt.repartition("anchor", "p", "q").sortWithinPartitions("anchor", "p", "q")
    return map_batches(dealt, compare, "a long, b long")


def near_duplicates(docs: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """Each document's columns but ``text``, fingerprint (long), part (a long), component_id."""
    own = written(fingerprints(docs), "fingerprints")
    prints, most = own.groupBy("node", "fingerprint", "second").agg(F.min("doc_id").alias("first_id")), own.count()
    prints = written(prints, "distinct", most)
    edges = links(prints.select("fingerprint", "second"), bits)
    parts = connected_components(edges).withColumnRenamed("node", "of")
    # Nodes without links are components of their own.
    linked = prints.join(parts, prints["node"] == parts["of"], "left")
    linked = written(linked.select("node", "first_id", F.coalesce("component", "node").alias("part")), "parts", most)
    # Both sides of these joins are written, so that a component with very many fingerprints,
    # or a fingerprint with very many documents, is a hot key Spark splits.
    least = written(linked.groupBy("part").agg(F.min("first_id").alias("component_id")), "least", most)
    first = written(linked.join(least, "part").select("node", "part", "component_id"), "components", most)
    return own.join(first, "node").drop("node", "second")


def simhash_components(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, fingerprint (16 hex digits), component_id."""
    found = near_duplicates(docs.select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def anchored_pairs(docs: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of rows (structs of doc_id and __hash) to verify, from doc_id, text and __hash.

    The links between fingerprints, each shown by the least row that has it, and that row with each other one.
    """
    own = fingerprints(docs).withColumn("row", F.struct(F.col("doc_id").alias("k_id"), F.col("__hash").alias("k_hash")))
    own = written(own.select("row", "node", "fingerprint", "second"), "fingerprints")
    prints = own.groupBy("node", "fingerprint", "second").agg(F.min("row").alias("least"), F.max("row").alias("last"))
    prints = written(prints, "distinct", own.count())
    one, two = (prints.select(F.col("node").alias(f"node_{x}"), F.col("least").alias(x)) for x in "ab")
    edges = links(prints.select("fingerprint", "second"))
    linked = edges.select(F.col("a").alias("node_a"), F.col("b").alias("node_b")).join(one, "node_a").join(two, "node_b")
    several = prints.filter("least != last").select("node", F.col("least").alias("a"))
    alike = own.select("node", F.col("row").alias("b")).join(several, "node").filter("a != b")
    return linked.select("a", "b").unionByName(alike.select("a", "b"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component of similar texts stays, the one with the smallest id, with all columns.

    Documents are told apart by their id and a hash of all columns; of rows alike in both,
    one stays. Only the ids and hashes of those that go are joined to the documents.
    """
    columns = docs.columns
    names = {c: f"__in_{i}" for i, c in enumerate(columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    rows = rows.withColumn("__hash", F.xxhash64(*names.values()))
    narrow = rows.select(F.col(names["doc_id"]).alias("doc_id"), F.col(names["text"]).alias("text"), "__hash")
    found = similar_groups(narrow, propose=anchored_pairs)
    # The smallest id names the component; without any id the hash of all columns does.
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__hash")
    found, most = found.withColumn("key", key).select("part", "key"), docs.count()
    first = found.groupBy("part").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = written(first, "first", most)
    grouped = written(found.join(first, "part").withColumn("same", F.col("key") == F.col("first")), "grouped", most)

    def matched(keys: DataFrame, how: str, of: DataFrame) -> DataFrame:
        keys = keys.select(F.col("key.doc_id").alias("k_id"), F.col("key.__hash").alias("k_hash")).distinct()
        on = F.col(names["doc_id"]).eqNullSafe(F.col("k_id")) & (F.col("__hash") == F.col("k_hash"))
        return of.join(written(keys, "keys", most), on, how)

    kept = matched(grouped.filter("not same"), "left_anti", rows)
    alike = grouped.filter("same").groupBy("part", "key").count().filter("count > 1")
    if alike.limit(1).count():
        alike = written(alike, "alike", most)
        once = matched(alike, "left_semi", kept).dropDuplicates(["__hash", names["doc_id"]])
        kept = matched(alike, "left_anti", kept).unionByName(once)
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])
