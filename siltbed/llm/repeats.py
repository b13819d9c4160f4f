"""Removal of repeated 100-byte strings by deep-shallow sorted suffixes.

Which suffixes to sort: of each 100-byte window, the 16-byte gram with the smallest hash
is the window's anchor (equal windows have equal anchors at equal places). Neighbouring
windows share anchors, so a document is a list of runs: an anchor with the windows that
chose it, about one for 43 bytes.

1. Runs shuffle by their gram's hash and meet the runs with the same gram. Of runs with
   equal bytes the first stays; all windows of the others are repeats. Before that,
   every batch of documents settles its own equal runs, so a passage that very many
   documents share sends one row a batch.
2. First runs that share a gram but not all bytes may still share some windows, those
   within a common part around the gram. Their bytes are fetched from the documents and
   shuffled by the hash of 58 bytes to the right of the gram's start (for windows that
   begin at most 42 bytes before it) or 43 bytes to the left (for the others), which any
   two equal windows have in common.
3. Each such group is sorted twice, by the suffixes from the anchor and by the reversed
   prefixes before it. The sort is deep-shallow: multikey quicksort on 8-byte words to a
   depth of 32 bytes, then a blind trie orders each group that is still equal. In these orders,
   the windows that begin d bytes before the anchor are equal where the suffixes have
   100 - d bytes in common and the prefixes d; all but the first of each class are repeats.
   A group of more than ``MOST_ROWS`` rows is not collected: its windows become hashes of
   128 bits, and Spark takes the first document and place of each.
4. Repeats are gathered by document and cut out of its bytes.

Hashes only propose; runs are equal if 128 bits of two hashes agree, windows in step 3 by
their bytes whatever the size of their group, in groups above ``MOST_ROWS`` by 128 bits. Documents are ordered by doc_id; documents that share an id by a hash of
their text, and those without an id come last. Null text counts as empty; texts below
100 bytes keep everything. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from siltbed.llm.common import batches_of, map_batches, sorted_groups, written

WINDOW = 100
GRAM = 16
#: Grams in a window.
WIDTH = WINDOW - GRAM + 1
#: Windows that begin at most this far before their anchor go by the bytes on its right.
TURN = 42
SHALLOW = 32
#: Windows looked at together in a long text; 21 bits of a key hold a place among them.
CHUNK = 1 << 20
PLACE = np.uint64((1 << 21) - 1)
#: Strings times distances that are classed at once.
DISTANCES = 1 << 16
#: Groups with more rows are not collected; Spark compares the hashes of their windows.
MOST_ROWS = 4096


def gram_hashes(data: bytes) -> np.ndarray:
    """A hash of the gram at each place."""
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    out = words[:-8] * np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(31)
    out += words[8:]
    out *= np.uint64(0xC2B2AE3D27D4EB4F)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0x165667B19E3779F9)
    return out ^ (out >> np.uint64(32))


def runs(data: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """First window, number of windows, anchor's place and gram hash of each run."""
    for base in range(0, len(data) - WINDOW + 1, CHUNK):
        part = data[base : base + CHUNK + WINDOW - 1]
        hashes = gram_hashes(part)
        windows = len(part) - WINDOW + 1
        keys = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
        padded = np.full(-(-len(keys) // WIDTH) * WIDTH, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(keys)] = keys
        rows = padded.reshape(-1, WIDTH)
        upto = np.minimum.accumulate(rows, axis=1).ravel()
        onward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(onward[:windows], upto[WIDTH - 1 : WIDTH - 1 + windows])
        anchor = (least & PLACE).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        place = anchor[first]
        yield first + base, np.diff(np.r_[first, windows]), place + base, hashes[place]


def packed(first: np.ndarray, before: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A run in one number: first window, its distance from the anchor, number of windows."""
    return first << 16 | before << 8 | count


#: Set in the count of a run that is settled: a repeat on its way to its document. Neighbouring
#: settled runs go as one, with the number of windows in place of the bytes' hash.
SETTLED = 128
#: Low bits of a repeat's number that hold its windows; the others hold the first.
COUNT_BITS = 24


def repeat(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Windows that are repeats, in one number."""
    return first << COUNT_BITS | count


def find_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_of(batches):
        columns: list[list[np.ndarray]] = [[] for _ in range(4)]
        for doc, text in zip(batch["doc"].to_pylist(), batch["text"].to_pylist()):
            data = (text or "").encode()
            if len(data) < WINDOW:
                continue
            for first, count, place, gram in runs(data):
                ends = (first + count + WINDOW - 1).tolist()
                digest = xxhash.xxh64_intdigest
                own = [digest(data[a:b], d) for a, b, d in zip(first.tolist(), ends, (place - first).tolist())]
                for column, values in zip(
                    columns,
                    (gram, np.array(own, np.uint64), np.full(len(first), doc), packed(first, place - first, count)),
                ):
                    column.append(values)
        if not columns[0]:
            continue
        gram, own, doc, at = map(np.concatenate, columns)
        order = np.lexsort((at, doc, gram, own))
        later = np.zeros(len(own), bool)
        later[order[1:]] = (own[order[1:]] == own[order[:-1]]) & (gram[order[1:]] == gram[order[:-1]])
        settled = np.flatnonzero(later)
        if len(settled):
            # Runs follow each other without gaps, so neighbours are one stretch of windows.
            first, row = at[settled] >> 16, doc[settled]
            apart = (np.diff(settled) > 1) | (np.diff(row) != 0) | (np.diff(first // CHUNK) != 0)
            starts = np.flatnonzero(np.r_[True, apart])
            count = np.add.reduceat(at[settled] & 127, starts)
            row, first = row[starts], first[starts] << 16 | SETTLED
            # They have no gram to meet others at; any place will do.
            gram = np.r_[gram[~later], spread(row, first)]
            own = np.r_[own[~later], count.astype(np.uint64)]
            doc, at = np.r_[doc[~later], row], np.r_[at[~later], first]
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram.view(np.int64)), pa.array(own.view(np.int64)), pa.array(doc), pa.array(at)],
            ["gram", "own", "doc", "at"],
        )


def spread(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = (a.astype(np.uint64) ^ (b.astype(np.uint64) << np.uint64(20))) * np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))


def meet_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From runs sorted by gram, bytes, document: repeats, and first runs that share a gram."""

    def out(gram: np.ndarray, doc: np.ndarray, at: np.ndarray, open_: bool) -> pa.RecordBatch:
        kind = np.full(len(doc), open_)
        return pa.RecordBatch.from_arrays([*map(pa.array, (gram, doc, at, kind))], ["gram", "doc", "at", "open"])

    held: tuple | None = None  # the last first run, and whether it was given out
    for batch in batches:
        if not batch.num_rows:
            continue
        gram, own, doc, at = (batch[c].to_numpy() for c in ("gram", "own", "doc", "at"))
        done = (at & SETTLED) > 0
        if done.any():
            yield out(gram[done], doc[done], repeat(at[done] >> 16, own[done]), False)
            gram, own, doc, at = gram[~done], own[~done], doc[~done], at[~done]
        if not len(gram):
            continue
        new = np.r_[held is None or (gram[0], own[0]) != held[:2], (gram[1:] != gram[:-1]) | (own[1:] != own[:-1])]
        if not new.all():
            yield out(gram[~new], doc[~new], repeat(at[~new] >> 16, at[~new] & 127), False)
        g, o, d, a = gram[new], own[new], doc[new], at[new]
        given = np.zeros(len(g), bool)
        if held is not None:
            g, o, d, a = (np.r_[h, x] for h, x in zip(held[:4], (g, o, d, a)))
            given = np.r_[held[4], given]
        if not len(g):
            continue
        same = g[1:] == g[:-1]
        share = np.r_[same, False] | np.r_[False, same]
        send = share & ~given
        if send.any():
            yield out(g[send], d[send], a[send], True)
        held = (g[-1], o[-1], d[-1], a[-1], bool(share[-1] or given[-1]))


def fetch_bytes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each open run, once for each side that has windows."""
    for batch in batches_of(batches, 64):
        out: list[tuple] = []
        for doc, text, wanted in zip(batch["doc"].to_pylist(), batch["text"].to_pylist(), batch["wanted"].to_pylist()):
            data = (text or "").encode()
            for at in wanted:
                first, most, count = at >> 16, at >> 8 & 255, at & 127
                place, least = first + most, most - count + 1
                if least <= TURN:
                    top = min(most, TURN)
                    key = xxhash.xxh64_intdigest(data[place : place + WINDOW - TURN], 1)
                    out.append((key, doc, place, least, top, data[place - top : place + WINDOW - least]))
                if most > TURN:
                    low = max(least, TURN + 1)
                    key = xxhash.xxh64_intdigest(data[place - TURN - 1 : place + GRAM], 2)
                    out.append((key, doc, place, low, most, data[place - most : place + WINDOW - low]))
        columns = list(zip(*out)) or [()] * 6
        keys = np.array(columns[0], np.uint64).view(np.int64)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), *map(pa.array, columns[1:], kinds)], ["key", "doc", "place", "least", "most", "bytes"]
        )


def common(a: bytes, b: bytes) -> int:
    """Bytes that two strings have in common at their start."""
    n = min(len(a), len(b))
    apart = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (apart.bit_length() + 7) // 8


def deep_shallow(strings: list[bytes]) -> list[int]:
    """Order of the strings: multikey quicksort, then blind tries."""
    out: list[int] = []
    todo = [([*range(len(strings))], 0)]
    while todo:
        some, depth = todo.pop()
        if len(some) < 2:
            out += some
        elif depth >= SHALLOW:
            out += blind_trie(strings, some)
        else:
            words = {i: strings[i][depth : depth + 8] for i in some}
            pivot = words[some[len(some) // 2]]
            less, same, more = [], [], []
            for i in some:
                (less if words[i] < pivot else more if words[i] > pivot else same).append(i)
            todo += [(more, depth), (less, depth)]
            # A word cut short by the end of its string has nothing after it.
            todo.insert(len(todo) - 1, (same, depth + 8 if len(pivot) == 8 else SHALLOW))
    return out


class Node:
    """A branch of a blind trie: its depth, and what follows each byte there."""

    __slots__ = ("depth", "next")

    def __init__(self, depth: int):
        self.depth, self.next = depth, {}


def blind_trie(strings: list[bytes], some: list[int]) -> list[int]:
    """Order of some strings, by a trie that keeps only branching depths and bytes.

    A string goes down blindly to any leaf below it, is compared with that leaf once, and
    branches where the two differ. A leaf holds equal strings; the end of a string sorts first.
    """

    def byte(i: int, depth: int) -> int:
        s = strings[i]
        return s[depth] if depth < len(s) else -1

    root: Node | list[int] = [some[0]]
    for i in some[1:]:
        node = root
        while isinstance(node, Node):
            node = node.next.get(byte(i, node.depth)) or next(iter(node.next.values()))
        leaf = node[0]
        split = common(strings[i], strings[leaf])
        if split == len(strings[i]) == len(strings[leaf]):
            node.append(i)
            continue
        above, node = None, root
        while isinstance(node, Node) and node.depth < split:
            above, node = node, node.next[byte(i, node.depth)]
        if isinstance(node, Node) and node.depth == split:
            node.next[byte(i, split)] = [i]
            continue
        branch = Node(split)
        branch.next = {byte(leaf, split): node, byte(i, split): [i]}
        if above is None:
            root = branch
        else:
            above.next[byte(i, above.depth)] = branch
    out: list[int] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, Node):
            stack += [node.next[b] for b in sorted(node.next, reverse=True)]
        else:
            out += node
    return out


def repeats_of(group: list[tuple[int, int, int, int, bytes]]) -> list[tuple[int, int, int]]:
    """Document, first window and number of windows of the repeats in a group.

    The group's runs (document, anchor, least and most distance of windows before it,
    bytes) are sorted by document and anchor.
    """
    right = [b[most:] for *_, most, b in group]
    left = [b[:most][::-1] for *_, most, b in group]
    found: list[tuple[int, int, int]] = []
    n = len(group)
    least, most = (np.array([g[k] for g in group]) for k in (2, 3))
    sides = []
    for strings in (right, left):
        order = deep_shallow(strings)
        shared = [0, *(common(strings[a], strings[b]) for a, b in zip(order, order[1:]))]
        sides.append((np.array(order), np.array(shared)))
    low, high = int(least.min()), int(most.max())
    step = max(1, DISTANCES // n)
    hits = []
    for at in range(low, high + 1, step):
        # A row of classes for each distance: equal windows have equal neighbours up to theirs.
        d = np.arange(at, min(at + step, high + 1))[:, None]
        classes = np.zeros((len(d), n), np.int64)
        for (order, shared), need in zip(sides, (WINDOW - d, d)):
            classes[:, order] = classes[:, order] * (n + 1) + np.cumsum(shared[None, :] < need, axis=1)
        # Strings outside a distance are in no class of it.
        outside = (d < least) | (d > most)
        classes[outside] = -1
        places = np.argsort(classes, axis=1, kind="stable")
        sorted_ = np.take_along_axis(classes, places, 1)
        again = np.zeros_like(outside)
        again[:, 1:] = (sorted_[:, 1:] == sorted_[:, :-1]) & (sorted_[:, 1:] >= 0)
        row, column = np.nonzero(again)
        hits.append((places[row, column], row + at))
    who, distance = (np.concatenate(x) for x in zip(*hits))
    order = np.lexsort((distance, who))
    who, distance = who[order], distance[order]
    starts = np.flatnonzero(np.r_[True, np.diff(who) != 0]).tolist() if len(who) else []
    for a, b in zip(starts, [*starts[1:], len(who)]):
        found += _spans(group[int(who[a])], distance[a:b].tolist())
    return found


def _spans(run: tuple, distances: list[int]) -> list[tuple[int, int, int]]:
    """Runs of neighbouring windows from their rising distances before the anchor."""
    out, start = [], 0
    for k in range(1, len(distances) + 1):
        if k == len(distances) or distances[k] != distances[k - 1] + 1:
            out.append((run[0], run[1] - distances[k - 1], k - start))
            start = k
    return out


def compare_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: list[tuple[int, int, int]] = []

    def flush() -> pa.RecordBatch:
        doc, first, count = (np.array(c, np.int64) for c in (zip(*found) if found else ((), (), ())))
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(repeat(first, count))], ["doc", "at"])

    for group in sorted_groups(batches, ["key"]):
        if group.num_rows > 1:
            columns = (group[c].to_pylist() for c in ("doc", "place", "least", "most", "bytes"))
            found += repeats_of(list(zip(*columns)))
            if len(found) > 50_000:
                yield flush()
    yield flush()


def hash_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document, first byte and 128 bits of hashes of each window of open runs."""
    for batch in batches_of(batches, 1024):
        out: list[tuple] = []
        for doc, place, least, most, data in zip(*(batch[c].to_pylist() for c in ("doc", "place", "least", "most", "bytes"))):
            for d in range(least, most + 1):
                window = data[most - d : most - d + WINDOW]
                out.append((doc, place - d, xxhash.xxh3_128_digest(window)))
        columns = list(zip(*out)) or [()] * 3
        kinds = (pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns, kinds)], ["doc", "first", "window"])


def repeats_of_large(rows: DataFrame) -> DataFrame:
    """``doc`` and ``at`` of repeated windows: all but the first of those with equal hashes.

    Firsts are combined before they shuffle, and are told from repeats by their place, so
    a window that very many documents share is no hot key.
    """
    windows = written(map_batches(rows, hash_windows, "doc long, first long, window binary"), "windows")
    first = windows.groupBy("window").agg(F.min(F.struct("doc", "first")).alias("at"))
    again = windows.select("doc", "first").join(written(first.select("at.doc", "at.first"), "firsts"), ["doc", "first"], "left_anti")
    return again.select("doc", F.shiftleft("first", COUNT_BITS).bitwiseOR(F.lit(1)).alias("at"))


def cut_out(batches: Iterable[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches_of(batches, 64):
        out: list[tuple] = []
        for text, wanted in zip(batch["text"].to_pylist(), batch["wanted"].to_pylist()):
            data = (text or "").encode()
            removed = spans = 0
            kept = data
            if wanted:
                at = np.array(wanted, np.int64)
                edge = np.zeros(len(data) + 1, np.int64)
                first, count = at >> COUNT_BITS, at & ((1 << COUNT_BITS) - 1)
                np.add.at(edge, first, 1)
                np.add.at(edge, first + count + WINDOW - 1, -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed = int(gone.sum())
                spans = int((np.diff(np.r_[False, gone].astype(np.int8)) == 1).sum())
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            row = (len(data), removed, spans, hashlib.sha256(kept).hexdigest(), kept)
            out.append(row if whole else row[:-1])
        columns = list(zip(*out))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *map(pa.array, columns, kinds)], names if whole else names[:-1])


def ordered(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``doc``, a number that orders documents: their id if that is unique."""
    ids = docs.groupBy("doc_id").count()
    if ids.filter("count > 1 or doc_id is null").limit(1).count() == 0:
        return docs.withColumn("doc", F.col("doc_id").cast("long"))
    keys = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    low = written(
        docs.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("low", F.monotonically_increasing_id()),
        "ordered",
    )
    return low.withColumnRenamed("low", "doc")


def found_repeats(docs: DataFrame, most_rows: int | None = None) -> DataFrame:
    """``doc`` and ``at`` (see ``repeat``) of repeated windows; ``docs`` has doc, text."""
    most_rows = MOST_ROWS if most_rows is None else most_rows
    every = map_batches(docs.select("doc", "text"), find_runs, "gram long, own long, doc long, at long")
    every = every.repartition("gram").sortWithinPartitions("gram", "own", "doc", "at")
    met = written(map_batches(every, meet_runs, "gram long, doc long, at long, open boolean"), "met_runs")
    wanted = met.filter("open").groupBy("doc").agg(F.collect_list("at").alias("wanted"))
    schema = "key long, doc long, place long, least int, most int, bytes binary"
    some = map_batches(docs.select("doc", "text").join(wanted, "doc"), fetch_bytes, schema)
    some = written(some, "open_runs")
    large = written(some.groupBy("key").count().filter(F.col("count") > most_rows).select("key"), "large")
    settled = None
    if large.limit(1).count():
        settled = repeats_of_large(some.join(large, "key"))
        some = some.join(large, "key", "left_anti")
    some = some.repartition("key").sortWithinPartitions("key", "doc", "place", "least")
    small = map_batches(some, compare_groups, "doc long, at long")
    settled = small if settled is None else small.unionByName(settled)
    return met.filter("not open").select("doc", "at").unionByName(settled)


def remove_repeats(docs: DataFrame, kept: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked, kept (the bytes that stay)."""
    docs = ordered(docs.select("doc_id", "text"))
    gone = found_repeats(docs).groupBy("doc").agg(F.collect_list("at").alias("wanted"))
    joined = docs.join(gone, "doc", "left").select("doc_id", "text", "wanted")
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * kept
    return map_batches(joined, partial(cut_out, whole=kept), schema)
