r"""Runs of repeated words in a document, found by recursive frequency splitting.

A run is a longest stretch of words with smallest period q that has at least
``max(least, TIMES * q)`` words. Each of its words occurs ``TIMES`` times in it, so a word
that occurs less often in a segment is in no run there and splits the segment. Segments are
counted and split again until none changes; those shorter than ``least`` go. No run crosses
a split, so the segments left hold every run whole.

A segment is then compared with itself at every lag q up to a ``TIMES``-th of it. A run of
period q covers a whole block of q words, aligned at a multiple of q, and the equal block
after it. Blocks are compared by differences of prefix hashes, so a segment of m words takes
m / q comparisons a lag, m ln m in all; what agrees is then compared word by word and
extended to its ends. A stretch inside a run whose period divides q is that same run.

Words are ``[^\x20\x09-\x0D]+``. Null, empty and white texts have no words, no runs and an empty
collapsed text. Rows, also repeated ones and null ids, give one row each; other columns are
left out. An empty table gives an empty result. Memory: the words of ``BATCH_BYTES`` of
text, or of one longer document.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from siltbed.llm.common import map_batches, sized_batches

LEAST, TIMES = 24, 3
BATCH_BYTES = 4 << 20
#: Pairs of blocks that are compared at once.
PAIRS = 1 << 20

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUN_SQL = "struct<start: bigint, length: bigint, period: bigint>"


def segments(words: np.ndarray, owner: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Starts and ends of what is left of each owner's words (numbers) by splitting."""
    at, left = np.arange(len(words)), owner
    settled: list[tuple[int, int]] = []
    kinds = int(words.max(initial=0)) + 1
    while len(at):
        places, _ = pd.factorize(left * kinds + words[at])
        often = np.bincount(places)[places] >= TIMES
        # Segments without a rare word are stable.
        first = np.flatnonzero(np.r_[True, left[1:] != left[:-1]])
        stable = np.logical_and.reduceat(often, first)
        sizes = np.diff(np.r_[first, len(at)])
        settled += [(int(at[f]), int(at[f] + n)) for f, n in zip(first[stable], sizes[stable]) if n >= least]
        going = often & ~np.repeat(stable, sizes)
        at, left = at[going], left[going]
        if not len(at):
            break
        left = np.cumsum(np.r_[0, (np.diff(at) > 1) | (np.diff(left) != 0)])
        long = np.bincount(left)[left] >= least
        at, left = at[long], left[long]
    return sorted(settled)


def _prefix_hashes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of mixed words times powers, before each place; and the powers."""
    mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(27)
    factors = np.full(len(words) + 1, 0xD1342543DE82EF95, np.uint64)
    factors[0] = 1
    powers = np.cumprod(factors, dtype=np.uint64)
    return np.r_[np.uint64(0), np.cumsum(mixed * powers[:-1], dtype=np.uint64)], powers


def _stretch(words: np.ndarray, start: int, end: int, q: int) -> tuple[int, int]:
    """The longest stretch of period q around ``start`` to ``end``, which has that period."""
    k = min(start, len(words) - q)
    for size in (q, k):
        size = min(size, k)
        differ = np.flatnonzero(words[start - size : start] != words[start - size + q : start + q])
        if len(differ):
            break
    start = start - size + (int(differ[-1]) + 1 if len(differ) else 0)
    k = len(words) - end
    for size in (q, k):
        size = min(size, k)
        differ = np.flatnonzero(words[end : end + size] != words[end - q : end + size - q])
        if len(differ):
            break
    return start, end + (int(differ[0]) if len(differ) else size)


def lag_scan(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """start, length and period of each run in one segment."""
    m = len(words)
    hashes, powers = _prefix_hashes(words)
    found: list[tuple[int, int, int]] = []
    low = 1
    while low <= m // TIMES:
        high = low + 1
        pairs = m // low
        while high <= m // TIMES and pairs + m // high <= PAIRS:
            pairs += m // high
            high += 1
        lags = np.arange(low, high)
        blocks = m // lags - 1
        q = np.repeat(lags, blocks)
        a = (np.arange(len(q)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * q
        b = a + q
        equal = (hashes[b] - hashes[a]) * powers[q] == hashes[b + q] - hashes[b]
        a, q = a[equal], q[equal]
        low = high
        if not len(a):
            continue
        # Neighbouring equal blocks of one lag belong together.
        first = np.flatnonzero(np.r_[True, (q[1:] != q[:-1]) | (np.diff(a) != q[1:])])
        last = np.r_[first[1:], len(a)] - 1
        for start, end, lag in zip(a[first].tolist(), (a[last] + 2 * q[last]).tolist(), q[first].tolist()):
            if any(s <= start and end <= s + n and lag % p == 0 for s, n, p in found):
                continue
            if not np.array_equal(words[start : end - lag], words[start + lag : end]):
                # Hashes that meet by chance: look at this lag word by word.
                same = np.flatnonzero(np.diff(np.r_[False, words[:-lag] == words[lag:], False].astype(np.int8)))
                stretches = [(s, e + lag) for s, e in zip(same[::2].tolist(), same[1::2].tolist())]
            else:
                stretches = [_stretch(words, start, end, lag)]
            for s, e in stretches:
                known = any(x == s and n == e - s for x, n, _ in found)
                if e - s >= max(least, TIMES * lag) and not known:
                    found.append((s, e - s, lag))
    return found


def collapse_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs, strongest, collapsed: a row for each of ``docs`` (doc_id, text).

    ``runs`` are by start and period; ``strongest`` has the greatest length for its period,
    then the least start. ``collapsed`` keeps the first period of each run, words joined by
    one space.
    """

    def collapse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches, "text", BATCH_BYTES):
            texts = [(t or "").encode().split() for t in batch["text"].to_pylist()]
            sizes = np.array(list(map(len, texts)), np.int64)
            bases = np.cumsum(sizes) - sizes
            every = np.empty(int(sizes.sum()), object)
            every[:] = [w for words in texts for w in words]
            numbers, _ = pd.factorize(every)
            gone = np.zeros(len(every), bool)
            runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            owner = np.repeat(np.arange(len(texts)), sizes)
            for start, end in segments(numbers, owner, least):
                i = int(owner[start])
                for s, length, period in lag_scan(numbers[start:end], least):
                    runs[i].append((start + s - int(bases[i]), length, period))
                    gone[start + s + period : start + s + length] = True
            collapsed = []
            for base, words, own in zip(bases.tolist(), texts, runs):
                if own:
                    own.sort(key=lambda run: (run[0], run[2]))
                    words = every[base : base + len(words)][~gone[base : base + len(words)]]
                collapsed.append(b" ".join(words))
            best = [_strongest(own) for own in runs]
            as_rows = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs]
            columns = [
                batch["doc_id"],
                pa.array(sizes),
                pa.array(as_rows, pa.list_(_RUN)),
                pa.array([b and dict(zip(("start", "length", "period"), b)) for b in best], _RUN),
                pa.array(collapsed, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "strongest", "collapsed"])

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_words long, runs array<{_RUN_SQL}>, strongest {_RUN_SQL}, collapsed string"
    return map_batches(docs.select("doc_id", "text"), collapse, schema)


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best
