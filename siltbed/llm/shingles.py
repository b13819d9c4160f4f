r"""Groups of texts whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more.

Proposing: two sets of a similarity of 0.8 share at least four fifths of the larger one, so,
with all shingles in one order, they share one of the first floor(size / 5) + 1 of each. These
are a set's keys; sets without a common key are not similar, by proof. Shingles that many
documents share come last in that order, so templates are no keys and few sets that differ
meet. How often shingles occur is counted in all documents, but a task
only tells those that ``OFTEN`` of its ``COUNTED`` shingles repeat, and the ``COMMON`` most frequent come last:
the counts decide how much is compared, never what is found.

Keys with the same sets are one key, and so are keys with the same least set if the sets of all of them make no more
pairs than the keys did one by one: a crowd of long texts shares hundreds of keys, with other sets each. Two
sets are looked at under the least of the keys that they share, and only
there. They are compared by a byte of each of ``HASHES`` minimum hashes, and are likely if
they agree in ``LEAST_SAME`` of them or more. A pair at exactly 0.8 agrees in less with a
probability of about 1 in 5 million, pairs above it still less often.

First, a spanning forest of each key's sets that look similar enough, the least node as its
root, is verified pair by pair: n near-copies give about n pairs, not n squared. Edges join
sets to components. Then keys whose sets are in several components are looked at once more:
sets with a likely partner in another component are sent there whole, and all such pairs
are compared by their whole sets within the task, which gives a spanning forest of edges, a row at
most for each set. A key's sets meet in one task up to ``CHUNK`` sets and ``CHUNK_SIZE`` shingles; beyond that they are dealt
into chunks by hash and every two chunks meet in a task of their own.

Sets are told apart by a 64-bit hash of theirs, shingles by one of 64 bits. Texts below
five words have one shingle; null and empty texts and white space have the same one.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from siltbed.llm.common import map_batches, removed, sized_batches, sorted_groups, written
from siltbed.llm.components import connected_components

WORDS, SEED = 5, 43
#: Similarity as a fraction.
PART, WHOLE = 4, 5
HASHES = 150
LEAST_SAME = 93
#: Shingles that a task counts at once, repeats that it tells, and frequent shingles at most.
COUNTED, OFTEN, COMMON = 1 << 20, 3, 1 << 17
CHUNK, CHUNK_SIZE = 1024, 1 << 20
#: Rows of documents are picked by this many hashes first, so that few texts are shuffled.
PICKED = 1 << 20
BATCH_BYTES = 4 << 20
#: Whole sets that one task writes.
SETS_A_FILE = 1 << 13


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    parts = (text or "").encode().lower().split()
    joined = b" ".join(parts)
    if len(parts) <= WORDS:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    spans = zip((ends - lengths)[: len(parts) - WORDS + 1].tolist(), ends[WORDS - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64))


@functools.cache
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    some = rng.integers(0, 1 << 63, (2, HASHES), np.uint64)
    return some[0], some[1] << np.uint64(1) | np.uint64(1)


def sketch_of(shingles: np.ndarray) -> bytes:
    """A byte of the least hash of the set under each of HASHES hash functions."""
    flips, factors = _multipliers()
    least = np.full(len(flips), np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 256):
        mixed = (shingles[at : at + 256, None] ^ flips) * factors
        least = np.minimum(least, mixed.min(axis=0))
    # The least hashes have small high bytes, so a byte is taken after another mixing.
    mixed = least ^ least >> np.uint64(32)
    return (mixed * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(56)).astype(np.uint8).tobytes()


def prefix_keys(shingles: np.ndarray, common: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The first shingles of a sorted set: those in ``common`` (sorted) come last, by rank."""
    n = len(shingles) - -(-PART * len(shingles) // WHOLE) + 1
    if not len(common):
        return shingles[:n].view(np.int64)
    at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
    known = common[at] == shingles
    first = shingles[~known]
    if len(first) < n:
        last = np.flatnonzero(known)
        first = np.r_[first, shingles[last[np.argsort(ranks[at[last]], kind="stable")]]]
    return first[:n].view(np.int64)


def common_shingles(docs: DataFrame, most: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and their ranks from the rarest on."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def told() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= OFTEN
            columns = [pa.array(found[often].view(np.int64)), pa.array(n[often])]
            return pa.RecordBatch.from_arrays(columns, ["shingle", "n"])

        for batch in sized_batches(batches, "text", BATCH_BYTES):
            held += [shingle_set(t) for t in batch["text"].to_pylist()]
            if sum(map(len, held)) >= COUNTED:
                yield told()
                held = []
        if held:
            yield told()

    counted = map_batches(docs.select("text"), count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    # Bounded: at most ``most`` rows, of which only the order of keys depends.
    top = counted.orderBy(F.desc("n"), "shingle").limit(most).toArrow()
    shingles, n = (top[c].to_numpy() for c in ("shingle", "n"))
    shingles = shingles.view(np.uint64)
    order = np.argsort(shingles)
    ranks = np.empty(len(n), np.int64)
    ranks[np.lexsort((shingles, n))] = np.arange(len(n))
    return shingles[order], ranks[order]


def similar(one: Column, two: Column) -> Column:
    """Whether two sets, arrays without repeats, have the similarity."""
    common = F.size(F.array_intersect(one, two))
    return WHOLE * common >= PART * (F.size(one) + F.size(two) - common)


def sketched(docs: DataFrame, common: np.ndarray, ranks: np.ndarray) -> DataFrame:
    """``docs`` without its text, with node, size, keys and sketch."""
    others = [c for c in docs.columns if c != "text"]

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches, "text", BATCH_BYTES):
            out, keys = [], []
            for text in batch["text"].to_pylist():
                own = shingle_set(text)
                node = np.uint64(xxhash.xxh64_intdigest(own.tobytes())).astype(np.int64)
                out.append((node, len(own), sketch_of(own)))
                keys.append(prefix_keys(own, common, ranks))
            node, size, sketch = (pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary())))
            added = [node, size, _lists(keys), sketch]
            names = [*others, "node", "size", "keys", "sketch"]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in others), *added], names)

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in others), "node long, size long, keys array<long>, sketch binary"])
    return map_batches(docs, compute, schema)


def _lists(several: list[np.ndarray]) -> pa.Array:
    offsets = np.r_[0, np.cumsum(list(map(len, several)))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(several)))


def sets_of(texts: DataFrame) -> DataFrame:
    """node and set (of signed numbers), from node and text."""

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches, "text", BATCH_BYTES):
            sets = _lists([shingle_set(t).view(np.int64) for t in batch["text"].to_pylist()])
            yield pa.RecordBatch.from_arrays([batch["node"], sets], ["node", "set"])

    return map_batches(texts.select("node", "text"), compute, "node long, set array<long>")


def forest(size: np.ndarray, sketch: np.ndarray) -> tuple[list[int], list[int]]:
    """Places of the pairs of a spanning forest of sets that look similar enough."""
    a, b, left = [], [], np.arange(len(size))
    likely = len(sketch[0]) * PART // WHOLE
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            i = reached.pop()
            hit = (sketch[left] == sketch[i]).sum(axis=1) >= likely
            hit &= WHOLE * np.minimum(size[left], size[i]) >= PART * np.maximum(size[left], size[i])
            found, left = left[hit], left[~hit]
            reached.extend(found.tolist())
            a.extend([int(i)] * len(found))
            b.extend(found.tolist())
    return a, b


def first_shared(keys: list[np.ndarray], key: int) -> np.ndarray:
    """For every two sets of ``key`` whether no smaller key has both."""
    smaller = [k[k < key] for k in keys]
    owner = np.repeat(np.arange(len(keys)), list(map(len, smaller)))
    _, column = np.unique(np.concatenate(smaller), return_inverse=True)
    common = np.zeros((len(keys), len(keys)), np.float32)
    for at in range(0, int(column.max(initial=-1)) + 1, 4096):
        own = (column >= at) & (column < at + 4096)
        has = np.zeros((len(keys), 4096), np.float32)
        has[owner[own], column[own] - at] = 1
        common += has @ has.T
    return common == 0


def dealt(members: DataFrame, chunk: int, size: int, *columns: str) -> DataFrame:
    """Members by key and pair of chunks (p, q), each group in one partition and together."""
    chunks = F.greatest(F.ceil(F.col("n") / chunk), F.ceil(F.col("total") / size))
    own = F.pmod(F.xxhash64("node"), F.col("chunks"))
    rows = members.withColumn("chunks", chunks).withColumn("own", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "node", *columns)
    return rows.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "node")


def _arrays(column: pa.Array) -> list[np.ndarray]:
    flat, offsets = column.flatten().to_numpy(), np.r_[0, np.cumsum(column.value_lengths().to_numpy())]
    return [flat[a:b] for a, b in zip(offsets, offsets[1:])]


def _sketches(group: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(group["sketch"].to_pylist()), np.uint8).reshape(group.num_rows, -1)


def proposed(members: DataFrame, chunk: int, total: int) -> DataFrame:
    """a, b: pairs to verify, a forest under each key, of key, n, total, node, size, sketch and keys."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["key", "p", "q"]):
            if group.num_rows < 2:
                continue
            node, size = (group[c].to_numpy() for c in ("node", "size"))
            a, b = (np.asarray(x, np.int64) for x in forest(size, _sketches(group)))
            if len(a):
                # What a smaller key has is joined there: pairs are told once.
                own = first_shared(_arrays(group["keys"]), group["key"][0].as_py())[a, b]
                yield pa.RecordBatch.from_arrays([pa.array(node[x[own]]) for x in (a, b)], ["a", "b"])

    rows = dealt(members, chunk, total, "size", "sketch", "keys")
    return map_batches(rows, compare, "a long, b long").distinct()


def left_over(members: DataFrame, chunk: int, total: int) -> DataFrame:
    """key, p, q and node of sets with a likely partner in another component (part)."""

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["key", "p", "q"]):
            node, size, part = (group[c].to_numpy() for c in ("node", "size", "part"))
            if len(np.unique(part)) < 2:
                continue
            sketch, hit = _sketches(group), np.zeros(len(node), bool)
            first = first_shared(_arrays(group["keys"]), group["key"][0].as_py())
            for at in range(0, len(node), 64):
                rows = slice(at, at + 64)
                near = first[rows] & (part[rows, None] != part[None, :])
                small, large = np.minimum(size[rows, None], size[None, :]), np.maximum(size[rows, None], size[None, :])
                i, j = np.nonzero(near & (WHOLE * small >= PART * large))
                for k in range(0, len(i), 8192):
                    one, two = i[k : k + 8192] + at, j[k : k + 8192]
                    enough = (sketch[one] == sketch[two]).sum(axis=1) >= LEAST_SAME
                    hit[one[enough]] = hit[two[enough]] = True
            if hit.any():
                kept = group.filter(pa.array(hit))
                yield pa.RecordBatch.from_arrays([kept[c] for c in ("key", "p", "q", "node", "part")], ["key", "p", "q", "node", "part"])

    rows = dealt(members, chunk, total, "size", "sketch", "keys", "part")
    return map_batches(rows, look, "key long, p long, q long, node long, part long")


def similar_pairs(sets: list[np.ndarray], part: np.ndarray) -> tuple[list[int], list[int]]:
    """Places of a forest that joins components (part) with sets that are similar."""
    sizes = np.array(list(map(len, sets)))
    flat, starts = np.concatenate(sets), np.cumsum(sizes) - sizes
    _, number = np.unique(flat, return_inverse=True)
    present = np.zeros(int(number.max()) + 1, bool)
    part, a, b = part.copy(), [], []
    for i in range(len(sets) - 1):
        own = number[starts[i] : starts[i] + sizes[i]]
        later = np.arange(i + 1, len(sets))
        near = WHOLE * np.minimum(sizes[later], sizes[i]) >= PART * np.maximum(sizes[later], sizes[i])
        later = later[near & (part[later] != part[i])]
        if not len(later):
            continue
        present[own] = True
        places = np.repeat(starts[later] - np.r_[0, np.cumsum(sizes[later])[:-1]], sizes[later]) + np.arange(int(sizes[later].sum()))
        common = np.add.reduceat(present[number[places]], np.r_[0, np.cumsum(sizes[later])[:-1]], dtype=np.int64)
        present[own] = False
        for j in later[WHOLE * common >= PART * (sizes[later] + sizes[i] - common)].tolist():
            if part[i] != part[j]:
                a.append(i), b.append(j)
                part[part == part[j]] = part[i]
    return a, b


def compared(rows: DataFrame) -> DataFrame:
    """a, b: similar pairs that join components, from key, p, q, node, part and set."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["key", "p", "q"]):
            node, part = (group[c].to_numpy() for c in ("node", "part"))
            a, b = similar_pairs(_arrays(group["set"]), part)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(node[x]) for x in (a, b)], ["a", "b"])

    rows = rows.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "node")
    return map_batches(rows, compare, "a long, b long")


def sets_of_nodes(docs: DataFrame, known: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and set of some nodes. Texts that can't be one of theirs are left out before any shuffle."""
    wanted = written(known.join(nodes, "node").select("node", "row.k_id", "row.k_hash"), "wanted", known.count())
    pick = F.pmod(F.xxhash64("k_hash"), F.lit(PICKED)).alias("pick")
    picks = F.broadcast(wanted.select(pick).distinct())  # PICKED rows at most
    some = docs.withColumn("pick", F.pmod(F.xxhash64("__hash"), F.lit(PICKED))).join(picks, "pick", "left_semi")
    on = F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("__hash") == F.col("k_hash"))
    # Rows alike in doc_id and __hash have the same text, so any of them will do.
    return sets_of(some.join(wanted, on).select("node", "text")).groupBy("node").agg(F.first("set").alias("set"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b whose whole sets are similar."""
    one = sets.select(F.col("node").alias("a"), F.col("set").alias("one"))
    two = sets.select(F.col("node").alias("b"), F.col("set").alias("two"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").filter(similar(F.col("one"), F.col("two"))).select("a", "b")


def joined_keys(members: DataFrame) -> DataFrame:
    """key and node, with keys of the same least node as one, from key, node, n (nodes of the key) and least.

    The nodes of two sets with a common key still have one. Keys are joined where that makes no more pairs of nodes
    than they have one by one, so a node whose keys have little else in common joins nothing.
    """
    nodes = members.select("least", "node").distinct().groupBy("least").agg(F.count(F.lit(1)).alias("nodes"))
    keys = members.select("key", "n", "least").distinct().groupBy("least")
    # As doubles: squares of counts don't overflow.
    keys = keys.agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs"), F.min("key").alias("joined"))
    fewer = nodes.join(keys, "least").filter(F.col("nodes").cast("double") * F.col("nodes") <= F.col("pairs"))
    fewer = written(fewer.select("least", "joined"), "joined_keys", members.count())
    return members.join(fewer, "least", "left").select(F.coalesce("joined", "key").alias("key"), "node").distinct()


def shared_keys(own: DataFrame) -> DataFrame:
    """key and node, for keys that several sets have; of keys with the same sets, and of many with alike ones, only one."""
    each = own.select(F.explode("keys").alias("key"), "node", "size")
    # Sets are only similar if their sizes are, so one without a neighbour in size under its key is not kept.
    within = Window.partitionBy("key").orderBy("size")
    near = (WHOLE * F.lag("size").over(within) >= PART * F.col("size")) | (WHOLE * F.col("size") >= PART * F.lead("size").over(within))
    met = each.withColumn("near", F.coalesce(near, F.lit(False))).filter("near").select("key", "node").distinct()
    met = written(met, "met", own.agg(F.sum(F.size("keys"))).first()[0] or 0)
    # Sums of two 31-bit hashes and the number of sets tell sets of sets apart.
    alike = [F.sum(F.pmod(F.xxhash64("node", F.lit(i)), F.lit((1 << 31) - 1))).alias(f"sum_{i}") for i in (0, 1)]
    groups = met.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("least"), *alike).filter("n > 1")
    groups = groups.groupBy("n", "sum_0", "sum_1").agg(F.min("key").alias("key"), F.min("least").alias("least"))
    most = met.count()
    kept = written(groups.select("key", "n", "least"), "kept_keys", most)
    several = written(met.join(kept, "key"), "several", most)
    out = written(joined_keys(several), "members", several.count())
    removed(met, kept, several)
    return out


def similar_groups(
    docs: DataFrame, chunk: int = CHUNK, total: int = CHUNK_SIZE, propose: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """``docs`` (doc_id, text, __hash) without text, with ``part``, a long for each group.

    Rows alike in doc_id and __hash have the same text. ``propose`` gives the first pairs ``a``, ``b`` of
    rows' structs of doc_id and __hash (``k_id``, ``k_hash``); those whose whole sets are similar join them,
    and the keys are looked at for the rest.
    """
    wide = written(sketched(docs, *common_shingles(docs)), "sketches")
    texts = wide.count()
    members = shared_keys(wide)
    most = members.count()  # a row for each key of a set
    row = F.struct(F.col("doc_id").alias("k_id"), F.col("__hash").alias("k_hash"))
    keys = members.groupBy("node").agg(F.collect_list("key").alias("shared"))
    known = wide.select("node", "size", "sketch", row.alias("row")).join(keys, "node")
    known = known.groupBy("node").agg(*[F.first(c).alias(c) for c in ("size", "sketch", "shared")], F.min("row").alias("row"))
    known = written(known.withColumnRenamed("shared", "keys"), "known", texts, SETS_A_FILE)
    # Keys and sketches of all texts are the largest table here; from now on those in ``known`` will do.
    own = written(wide.drop("size", "keys", "sketch"), "nodes", texts)
    removed(wide, members)

    def by_key(parts: DataFrame | None) -> DataFrame:
        """Members of keys with several components, with all that is needed to compare them."""
        # Joined set by set, before a row is made for each key.
        each = known.select("node", "size", "keys")
        each = each.withColumn("of", F.lit(None).cast("long")) if parts is None else each.join(parts, "node", "left")
        placed = each.select(F.explode("keys").alias("key"), "node", "size", F.coalesce("of", "node").alias("part"))
        placed = written(placed, "placed", most)
        open_ = placed.groupBy("key").agg(
            F.min("part").alias("low"), F.max("part").alias("high"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("total")
        )
        open_ = written(open_.filter("low < high").select("key", "n", "total"), "open", most)
        return placed.drop("size").join(open_, "key").join(known.drop("row"), "node")

    def in_components(edges: DataFrame) -> DataFrame:
        # Edges are read from tables written before, so that counting them costs little.
        parts = connected_components(edges, edges.count())
        return written(parts.withColumnRenamed("component", "of"), "parts", texts)

    def similar_of(pairs: DataFrame) -> DataFrame:
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        sets = written(sets_of_nodes(docs, known_rows, nodes), "sets", min(texts, 2 * pairs.count()), SETS_A_FILE)
        out = written(verified(pairs, sets), "similar", pairs.count(), SETS_A_FILE)
        removed(sets)
        return out

    every = own.select("node", row.alias("row"))
    known_rows = written(every.groupBy("node").agg(F.min("row").alias("row")), "rows", texts)
    edges, parts = None, None
    if propose is not None:
        first = propose(docs)
        one, two = (every.select(F.col("row").alias(x), F.col("node").alias(f"node_{x}")) for x in "ab")
        first = first.join(one.distinct(), "a").join(two.distinct(), "b")
        first = first.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).filter("a != b").distinct()
        edges = similar_of(written(first, "pairs"))
        parts = in_components(edges)
    more = similar_of(written(proposed(by_key(parts), chunk, total), "pairs"))
    edges = more if edges is None else edges.unionByName(more)
    parts = in_components(edges)

    rest = written(left_over(by_key(parts), chunk, total), "left_over")
    sets = written(sets_of_nodes(docs, known_rows, rest.select("node").distinct()), "sets", min(texts, rest.count()), SETS_A_FILE)
    more = written(compared(rest.join(sets, "node")), "similar")
    removed(sets)
    if more.limit(1).count():
        parts = in_components(edges.unionByName(more))
    return own.join(parts, "node", "left").withColumn("part", F.coalesce("of", "node")).drop("of", "node")
