"""Best-fit packing of token sequences by sum of squares.

Documents are tokenised where they are read and cut into pieces of at most ``CAPACITY``
tokens. Pieces are dealt by the hash of their row number into buckets of about
``BUCKET_PIECES``, whatever the input: a bucket is packed by one task, and a bucket's
last open sequences are all that separate buckets cost. Within a bucket the longest come
first, and each piece goes where the sum over gaps of the squared number of open
sequences with that gap becomes smallest: a full sequence has no gap and costs nothing.
Ties go to the smallest gap, then to an open sequence before a new one. At the end the
sequences that are still open are emptied and their pieces placed again, longest first,
each into the smallest gap it fits; that stands if it takes fewer sequences.

Null text counts as empty and is one piece with the end id alone. Repeated rows are
packed each. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import tokenizers
from pyspark.sql import DataFrame, functions as F

from siltbed.llm.common import large_cache, map_batches, ship_package, sized_batches, written

MODEL = "word_bpe_49k.json"
CAPACITY = 2048
END = 0
BUCKET_PIECES = 65_536
#: Parts of texts whose ids a Python worker remembers, and their most characters.
REMEMBERED, LONGEST = 500_000, 64
#: Bytes of texts whose parts are looked up together.
BATCH_BYTES = 2 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@large_cache
def library(model: str) -> tokenizers.Tokenizer:
    return tokenizers.Tokenizer.from_file(public_tokenizers.path(model))


def normalized(text: str) -> str:
    """What the tokenizer splits: ASCII stays fast, the rest is normalised as it does."""
    return text if text.isascii() else unicodedata.normalize("NFC", text).lower()


class Ids(dict):
    """The library's ids of a text between spaces, as little-endian bytes.

    Pre-tokens of this tokenizer hold no white space, and normalising changes nothing
    across a space, so a text's ids are its parts' ids in order.
    """

    def __init__(self, model: str):
        super().__init__()
        self.library = library(model)
        self[""] = b""

    def __missing__(self, part: str) -> bytes:
        # The tokenizer lower-cases, so capitals of A-Z only matter in special strings.
        lower = part.lower() if part.isascii() and "<|" not in part else part
        if lower != part:
            ids = self[lower]
        elif part[-1] in ".,;:!?" and normalized(part[:-1]).isalpha():
            # A sign after a letter is a pre-token of its own, but not after a mark that
            # normalising splits off a letter.
            ids = self[part[:-1]] + self[part[-1]] if len(part) > 1 else self.of_library(part)
        else:
            ids = self.of_library(part)
        if len(part) <= LONGEST and len(self) < REMEMBERED:
            self[part] = ids
        return ids

    def of_library(self, part: str) -> bytes:
        return np.array(self.library.encode(part, add_special_tokens=False).ids, "<u4").tobytes()

    def of_text(self, text: str | None) -> bytes:
        return self.of_texts(pa.array([text], pa.string()))[0]

    def of_texts(self, texts: pa.Array) -> list[bytes]:
        """Each text's ids; a part that comes several times among the texts is looked up once."""
        texts = pa.compute.replace_substring(pa.compute.fill_null(texts.cast(pa.large_string()), ""), "\n", " ")
        parts = pa.compute.split_pattern(texts, " ")
        coded = parts.flatten().dictionary_encode()
        distinct = list(map(self.__getitem__, coded.dictionary.to_pylist()))
        lengths = np.fromiter(map(len, distinct), np.int64, len(distinct)) // 4
        pool, starts = np.frombuffer(b"".join(distinct), "<u4"), np.cumsum(lengths) - lengths
        which = coded.indices.to_numpy()
        own = lengths[which]
        ends = np.cumsum(own)
        ids = pool[np.repeat(starts[which] - (ends - own), own) + np.arange(own.sum())]
        # Each text has one part at least.
        ends = ends[np.cumsum(parts.value_lengths().to_numpy()) - 1].tolist()
        return [ids[a:b].tobytes() for a, b in zip([0, *ends], ends)]


@large_cache
def remembered(model: str) -> Ids:
    """What this Python worker knows; later tasks of this module in the same worker go on with it."""
    return Ids(model)


def pieces(docs: DataFrame, model: str = MODEL, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """The pieces of every document, with their token ids (binary) if wanted."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = remembered(model), np.array([END], "<u4").tobytes()
        for batch in sized_batches(batches, "text", BATCH_BYTES):
            out: list[tuple] = []
            for doc_id, own in zip(batch["doc_id"].to_pylist(), known.of_texts(batch["text"])):
                whole = own + end
                for n, at in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[at : at + 4 * capacity]
                    row = (doc_id, n, at // 4, len(part) // 4, zlib.crc32(part))
                    out.append((*row, part) if ids else row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names
            )

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 5 + ids]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + ids]
    return map_batches(docs.select("doc_id", "text"), cut, PIECES + ", ids binary" * ids)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length, in the order given.

    ``open_`` counts sequences by gap. A move from gap g to gap g - n changes the sum of
    squares by (1 - 2 open[g]) + (1 + 2 open[g - n]); a gap of 0 or of a whole new
    sequence counts nothing.
    """
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_ = np.zeros(capacity + 1, np.int64)
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    for i, n in enumerate(lengths.tolist()):
        new = 1 + 2 * open_[capacity - n] if n < capacity else 0
        here = open_[n:capacity]
        if here.size and here.any():
            gaps = np.flatnonzero(here)
            # After the move: gap g - n; the first entry may be an exact fit.
            cost = 2 * open_[gaps] + 2 - 2 * here[gaps]
            if gaps[0] == 0:
                cost[0] = 1 - 2 * here[0]
            k = int(cost.argmin())
            if cost[k] <= new:
                gap = int(gaps[k]) + n
                b = by_gap[gap].pop()
                open_[gap] -= 1
                sequence[i], offset[i] = b, capacity - gap
                if gap > n:
                    open_[gap - n] += 1
                    by_gap[gap - n].append(b)
                continue
        sequence[i], offset[i] = made, 0
        if n < capacity:
            open_[capacity - n] += 1
            by_gap[capacity - n].append(made)
        made += 1
    return sequence, offset


def smallest_gaps(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length, each in the smallest gap it fits."""
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    gaps: list[tuple[int, int]] = []
    made = 0
    for i, n in enumerate(lengths.tolist()):
        at = bisect.bisect_left(gaps, (n, -1))
        if at < len(gaps):
            gap, b = gaps.pop(at)
        else:
            gap, b = capacity, made
            made += 1
        sequence[i], offset[i] = b, capacity - gap
        if gap > n:
            bisect.insort(gaps, (gap - n, b))
    return sequence, offset


def packed_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of squares, then the open sequences again; ``lengths`` fall."""
    sequence, offset = sum_of_squares(lengths, capacity)
    if not len(lengths):
        return sequence, offset
    filled = np.bincount(sequence, lengths).astype(np.int64)
    again = filled[sequence] < capacity
    number, at = smallest_gaps(lengths[again], capacity)
    if len(number) and number.max() + 1 < (filled < capacity).sum():
        sequence[again], offset[again] = number + len(filled), at
    return sequence, offset


def pack(parts: DataFrame, capacity: int = CAPACITY, bucket_pieces: int = BUCKET_PIECES) -> DataFrame:
    """Adds sequence_id and offset to pieces with a ``length`` of at most ``capacity``."""
    columns = parts.columns
    rows = written(parts.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    ship_package(parts.sparkSession)
    buckets = max(1, -(-rows.count() // bucket_pieces))
    narrow = rows if "ids" not in columns else rows.drop("ids")
    narrow = narrow.withColumn("__bucket", F.pmod(F.xxhash64("__row"), F.lit(buckets)))

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "__row"], ascending=[False, True])
        number, at = packed_lengths(group["length"].to_numpy(), capacity)
        group["sequence_id"] = (group["__bucket"].to_numpy() << 32) + number
        group["offset"] = at
        return group

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields]
    schema = ", ".join([*fields, "sequence_id long", "offset long"])
    packed = narrow.groupBy("__bucket").applyInPandas(fill, schema).drop("__bucket")
    if "ids" in columns:
        packed = packed.join(rows.select("__row", "ids"), "__row")
    return packed.select(*columns, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence, from packed pieces that have them."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"),
        F.transform("parts", lambda p: F.struct(p["doc_id"], p["offset"])).alias("documents"),
    )
