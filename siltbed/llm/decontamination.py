r"""Benchmark phrases in training documents, found by FM-indexes over training shards.

A window is ``WINDOW`` consecutive words of a benchmark item; a shorter item is one window.
Each task turns its documents into shards of at most ``SHARD`` symbols and indexes each:
suffixes in order by prefix doubling, the Burrows-Wheeler text in a wavelet matrix that
answers ranks, and the text places of every ``SAMPLE``-th suffix. Backward search then
narrows all windows at once, word by word from their last; places come from steps of the
last-to-first map up to a sampled suffix, and overlapping occurrences merge into spans.

Words outside the block's windows are in no occurrence and end a stretch; stretches shorter
than the shortest window are left out of the shard. Stretches are cut into chunks of ``CHUNK``
words that overlap by one word less than a window. Each chunk ends in a mark of its own, so
no suffix has to be compared beyond a chunk, however many copies there are.

Windows are searched in blocks of about ``BLOCK`` pairs of window and item, which bounds what the driver and
a task hold: a larger benchmark means more passes over the documents, not larger ones.

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z. Null and empty texts
have no words. Items without words have no windows; those with a null id mark words but are
not listed. Rows, also repeated ones and null ids, give one row each. Without windows
nothing is hit, and an empty table gives an empty result.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from siltbed.llm.common import map_batches, sized_batches, written

WINDOW = 10
#: Symbols of a shard and kinds of words in a block: with marks, under 2 ** 21 together.
SHARD = 1 << 19
BLOCK = 50_000
CHUNK = 256
SAMPLE = 8
BATCH_BYTES = 8 << 20

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_FOLD = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_SPAN_SQL = "array<struct<start: bigint, end: bigint>>"


class FmIndex:
    """Ranks and sampled places over a text of words from 1 on; 0 ends each chunk."""

    def __init__(self, text: np.ndarray, kinds: int):
        order = suffix_order(text, kinds)
        self.n, self.kinds = len(text), kinds
        self.before = np.r_[0, np.cumsum(np.bincount(text, minlength=kinds + 1))]
        self.last = text[order - 1]
        self._build_ranks()
        # A step from the first word of a chunk would end at another chunk's mark.
        sampled = (order % SAMPLE == 0) | (text[order - 1] == 0)
        self.sampled, self.places = np.r_[0, np.cumsum(sampled)], order[sampled]

    def _build_ranks(self) -> None:
        bits, left = max(1, int(self.kinds).bit_length()), self.last
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for bit in range(bits - 1, -1, -1):
            zero = (left >> bit & 1) == 0
            zeros = np.r_[0, np.cumsum(zero, dtype=np.int32)].astype(np.int32)
            self.levels.append((bit, zeros, int(zeros[-1])))
            left = np.r_[left[zero], left[~zero]]
        kinds = np.arange(self.kinds + 1)
        self.first = self._descend(kinds, np.zeros(len(kinds), np.int64))

    def _descend(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, zeros, total in self.levels:
            below = zeros[at]
            at = np.where(word >> bit & 1, total + at - below, below)
        return at

    def rank(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each word occurs in the transformed text before ``at``."""
        return self._descend(word, at) - self.first[word]

    def search(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of phrases, whose rows hold their words from the last to the first."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n)
        for step in range(phrases.shape[1]):
            live = np.flatnonzero((sizes > step) & (low < high))
            word = phrases[live, step]
            low[live] = self.before[word] + self.rank(word, low[live])
            high[live] = self.before[word] + self.rank(word, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffixes."""
        out, at, steps = np.zeros(len(rows), np.int64), np.arange(len(rows)), 0
        while len(at):
            known = self.sampled[rows + 1] > self.sampled[rows]
            out[at[known]] = self.places[self.sampled[rows[known]]] + steps
            at, rows = at[~known], rows[~known]
            word = self.last[rows]
            rows = self.before[word] + self.rank(word, rows)
            steps += 1
        return out


def suffix_order(text: np.ndarray, kinds: int) -> np.ndarray:
    """Places of a text's suffixes in order; every 0 is a mark of its own."""
    n, marks = len(text), int((text == 0).sum())
    symbols = np.where(text == 0, np.cumsum(text == 0) - 1, text.astype(np.int64) + (marks - 1))
    size = marks + kinds + 1
    padded = np.r_[symbols, 0, 0]
    key = (padded[:-2] * size + padded[1:-1]) * size + padded[2:]
    order = np.argsort(key, kind="stable")
    rank, open_ = np.empty(n, np.int64), np.arange(n)
    key, ahead = key[order], 3
    while True:
        # Slots of suffixes that are still alike; a suffix's rank is its group's first slot.
        starts = np.r_[True, key[1:] != key[:-1]]
        group = np.cumsum(starts) - 1
        rank[order[open_]] = open_[np.flatnonzero(starts)[group]]
        open_ = open_[np.bincount(group)[group] > 1]
        if not len(open_):
            return order
        alike = order[open_]
        key = rank[alike] * n + rank[alike + ahead]
        sort = np.argsort(key, kind="stable")
        order[open_], key = alike[sort], key[sort]
        ahead *= 2


def chunks(numbers: np.ndarray, least: int, window: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shards: symbols, and their places in ``numbers`` (0: no word of a window)."""
    edges = np.flatnonzero(np.diff(np.r_[False, numbers > 0, False].astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    starts, ends = starts[long], ends[long]
    step = CHUNK - (window - 1)
    times = np.maximum(1, -(-(ends - starts - (window - 1)) // step))
    nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    low = np.repeat(starts, times) + nth * step
    high = np.minimum(low + CHUNK, np.repeat(ends, times))
    sizes = high - low + 1
    shard = np.cumsum(sizes) // SHARD
    for k in np.unique(shard):
        own = shard == k
        first, size = low[own], sizes[own]
        offsets = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        places = np.repeat(first, size) + offsets
        text = np.where(offsets == np.repeat(size, size) - 1, 0, numbers[np.minimum(places, len(numbers) - 1)])
        yield text, places


class Phrases:
    """A block of windows as numbers, with the items of each."""

    def __init__(self, pairs: list[tuple[str, str | None]], window: int):
        texts = sorted({w for w, _ in pairs})
        split = [t.encode().split(b" ") for t in texts]
        self.numbers = {w: i for i, w in enumerate(sorted({w for words in split for w in words}), 1)}
        self.sizes = np.array(list(map(len, split)), np.int64)
        self.words = np.zeros((len(texts), window), np.int64)
        for i, words in enumerate(split):
            self.words[i, : len(words)] = [self.numbers[w] for w in reversed(words)]
        at = {t: i for i, t in enumerate(texts)}
        self.items: list[list[str]] = [[] for _ in texts]
        for w, item in pairs:
            if item is not None:
                self.items[at[w]].append(item)


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct item (text or null) and window (words joined by a space) of item_id and text."""
    folded = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    words = F.filter(F.split(folded, _NOT_WORD), lambda w: w != "")
    split = benchmark.select(F.col("item_id").cast("string").alias("item"), words.alias("words")).filter("size(words) > 0")
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1))))
    return split.select("item", "words", start.alias("at")).select(
        "item", F.array_join(F.slice("words", F.col("at"), window), " ").alias("window")
    ).distinct()


def blocks_of(benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> list[list[tuple[str, str | None]]]:
    """Blocks of about ``block`` pairs of window and item, read one at a time."""
    pairs = written(windows(benchmark, window), "windows")
    count = -(-pairs.count() // block)
    dealt = pairs.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(max(count, 1))))
    return [[(r["window"], r["item"]) for r in dealt.filter(F.col("block") == k).collect()] for k in range(count)]


def search(found: DataFrame, phrases: Phrases, window: int) -> DataFrame:
    """Add one block's hits to n_words, spans (of words) and items of rows with a text."""
    kinds, least = len(phrases.numbers), int(phrases.sizes.min(initial=window))
    names = found.columns

    def hits(numbers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for text, places in chunks(numbers, least, window):
            index = FmIndex(text, kinds)
            low, high = index.search(phrases.words, phrases.sizes)
            count = high - low
            which = np.repeat(np.arange(len(low)), count)
            rows = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + low[which]
            yield places[index.locate(rows)], which

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = phrases.numbers.get
        for batch in sized_batches(batches, "text", BATCH_BYTES, 4096):
            texts = [(t or "").encode().translate(_FOLD).split() for t in batch["text"].to_pylist()]
            sizes = np.array(list(map(len, texts)), np.int64)
            ends = np.cumsum(sizes + 1)
            bases = ends - sizes - 1
            # A 0 after each document keeps phrases and spans within one.
            numbers = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
            for base, words in zip(bases.tolist(), texts):
                numbers[base : base + len(words)] = [number(w, 0) for w in words]
            change = np.zeros(len(numbers) + 1, np.int64)
            for i, own in enumerate(batch["spans"].to_pylist()):
                for span in own:
                    change[bases[i] + span["start"]] += 1
                    change[bases[i] + span["end"]] -= 1
            items = [set(own) for own in batch["items"].to_pylist()]
            for at, which in hits(numbers):
                change += np.bincount(at, minlength=len(change))
                change -= np.bincount(at + phrases.sizes[which], minlength=len(change))
                owner = np.searchsorted(ends, at, "right")
                pairs = np.unique(owner * len(phrases.items) + which)
                for i, k in zip((pairs // len(phrases.items)).tolist(), (pairs % len(phrases.items)).tolist()):
                    items[i].update(phrases.items[k])
            edges = np.flatnonzero(np.diff(np.r_[False, np.cumsum(change) > 0, False].astype(np.int8)))
            spans: list[list[dict]] = [[] for _ in texts]
            owners = np.searchsorted(ends, edges[::2], "right")
            for i, start, end in zip(owners.tolist(), edges[::2].tolist(), edges[1::2].tolist()):
                spans[i].append({"start": start - int(bases[i]), "end": end - int(bases[i])})
            new = {
                "n_words": pa.array(sizes),
                "spans": pa.array(spans, pa.list_(_SPAN)),
                "items": pa.array([sorted(own) for own in items], pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays([new[c] if c in new else batch[c] for c in names], names)

    types = dict(found.dtypes)
    return map_batches(found, run, ", ".join(f"`{c}` {types[c]}" for c in names))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """doc_id, text, n_words, spans, items for each of ``docs`` (doc_id, text).

    ``spans`` are hit words from start to before end; ``items`` the ids, as sorted text, of
    the ``benchmark`` rows (item_id, text) with an occurring window.
    """
    found = docs.select(
        "doc_id",
        "text",
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(_SPAN_SQL).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    # One pass counts words even if there is no window.
    for pairs in blocks_of(benchmark, window, block) or [[]]:
        found = search(found, Phrases(pairs, window), window)
    return found


def remove_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id and text without its hit words and what lies between the words of a span."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches, "text", BATCH_BYTES):
            texts = batch["text"].to_pylist()
            for i, spans in enumerate(batch["spans"].to_pylist()):
                if spans:
                    places = [m.span() for m in _WORD.finditer(texts[i])]
                    left, at = [], 0
                    for span in spans:
                        left.append(texts[i][at : places[span["start"]][0]])
                        at = places[span["end"] - 1][1]
                    texts[i] = "".join([*left, texts[i][at:]])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    found = contaminated(docs, benchmark, window).select("doc_id", "text", "spans")
    return map_batches(found, cut, f"doc_id {dict(docs.dtypes)['doc_id']}, text string")


ORACLE = r"""
WITH item AS (
    SELECT item_id, words, greatest(len(words) - 9, 1) AS starts, least(len(words), 10) AS size
    FROM (SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM benchmark)
    WHERE len(words) > 0
), win AS (
    SELECT DISTINCT item_id, size, array_to_string(words[pos:pos + size - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, starts + 1)) AS pos FROM item)
), doc AS (
    SELECT row_number() OVER () AS line, doc_id, coalesce(list_filter(string_split_regex(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
        lambda w: w <> ''), []) AS words FROM documents
), place AS (
    SELECT line, size, pos, array_to_string(words[pos:pos + size - 1], ' ') AS phrase
    FROM (SELECT line, words, size, unnest(range(1, len(words) - size + 2)) AS pos
          FROM doc, (SELECT DISTINCT size FROM win))
), hit AS (
    SELECT DISTINCT line, pos, place.size, item_id FROM place JOIN win ON place.phrase = win.phrase AND place.size = win.size
), word AS (
    SELECT line, count(DISTINCT pos) AS n_hit FROM (SELECT line, unnest(range(pos, pos + size)) AS pos FROM hit) GROUP BY line
), named AS (
    SELECT line, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT line, item_id::VARCHAR AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY line
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (line) LEFT JOIN named USING (line)
"""
