"""Exact deduplication by two-pass Bloom filtering, in DataFrame functions only.

Pass one sends each row's hash through a blocked Bloom filter: 18 bits of the hash
choose three bits of one 64-bit word, the rest chooses the word. Codes (word and
bits) are counted with partial counts before the shuffle; the words of codes that
occur twice or more make up the filter of repeats. Pass two tests every row against
that filter. Only rows that hit it shuffle, to be compared by their SHA-256; the rest
pass straight through.

The broadcast filter has at most ``MAX_WORDS`` rows of two longs, whatever the input.
Beyond about 16 million rows it fills up and lets more unique rows through to the
exact comparison: that costs time, never rows.

Null text counts as empty; all texts that are empty after normalising form one group.
Rows without an id rank after rows with one. Of rows alike in id, text and length one
stays. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siltbed.llm.common import WHITE_SPACE, written

#: Bits of the filter for each row, before ``MAX_WORDS`` bounds it.
BITS_PER_ROW = 16
#: Most 64-bit words of the broadcast filter (about 40 MB as a hash table).
MAX_WORDS = 1 << 20

DIGEST, CHARS, ROW = "__digest", "__chars", "__row"
WORD, MASK, BITS = "__word", "__mask", "__bits"


def normalised(text: Column) -> Column:
    """``text`` without white space; null as empty text."""
    out = F.coalesce(text, F.lit(""))
    for character in WHITE_SPACE:
        out = F.replace(out, F.lit(character), F.lit(""))
    return out


def with_digest(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the digest of its normalised text and its length in code points."""
    return docs.withColumns(
        {
            DIGEST: F.unhex(F.sha2(normalised(F.col(text)).cast("binary"), 256)),
            CHARS: F.length(F.coalesce(F.col(text), F.lit(""))).cast("long"),
        }
    )


def _with_code(rows: DataFrame, words: int) -> DataFrame:
    """Adds the Bloom word of a digest and the three bits it sets there."""
    code = F.xxhash64(DIGEST)
    bit = "shiftleft(1L, cast(shiftrightunsigned(__code, {}) & 63 as int))"
    return (
        rows.withColumn("__code", code)
        .withColumns(
            {
                WORD: F.expr(f"shiftrightunsigned(__code, 18) % {words}"),
                MASK: F.expr(" | ".join(bit.format(6 * i) for i in range(3))),
            }
        )
        .drop("__code")
    )


def filter_words(rows: int) -> int:
    """Words of a filter for so many rows."""
    return min(MAX_WORDS, max(1 << 10, 1 << (max(1, rows * BITS_PER_ROW // 64) - 1).bit_length()))


def repeat_filter(rows: DataFrame, words: int) -> DataFrame:
    """Bloom filter of the digests that may occur more than once, one row a word."""
    seen = _with_code(rows.select(DIGEST), words).groupBy(WORD, MASK).count()
    return seen.filter("count > 1").groupBy(WORD).agg(F.bit_or(MASK).alias(BITS))


def mark_repeats(rows: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Adds keep_id, group_size and kept to rows that have a digest.

    ``rows`` is read three times; write it first if that is dear.
    """
    most = rows.count()
    words = filter_words(most)
    repeats = written(repeat_filter(rows, words), "repeats", min(most, words))
    tested = _with_code(rows, words).join(F.broadcast(repeats), WORD, "left")
    hit = F.coalesce(F.col(BITS), F.lit(0)).bitwiseAND(F.col(MASK)) == F.col(MASK)
    tested = tested.withColumn("__hit", hit).drop(WORD, MASK, BITS)

    unique = tested.filter(~F.col("__hit")).drop("__hit").withColumns(
        {
            "keep_id": F.col(id_column),
            "group_size": F.lit(1).cast("long"),
            "kept": F.lit(True),
        }
    )
    maybe = tested.filter("__hit").drop("__hit")
    maybe = written(maybe.withColumn(ROW, F.monotonically_increasing_id()), "maybe_repeated")
    # Of the longest, the smallest id: null ids are the least after negation.
    rank = F.struct(F.col(CHARS), -F.col(id_column), -F.col(ROW))
    best = maybe.groupBy(DIGEST).agg(F.max(rank).alias("__best"), F.count(F.lit(1)).alias("group_size"))
    best = best.select(
        DIGEST,
        (-F.col("__best.col2")).alias("keep_id"),
        (-F.col("__best.col3")).alias("__best_row"),
        "group_size",
    )
    # Written, so that both sides of the join are plain shuffles whose hot keys Spark splits.
    compared = maybe.join(written(best, "groups", maybe.count()), DIGEST)
    compared = compared.withColumn("kept", F.col(ROW) == F.col("__best_row")).drop(ROW, "__best_row")
    return unique.unionByName(compared)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = with_digest(docs.select("doc_id", "text")).select("doc_id", DIGEST, CHARS)
    return mark_repeats(written(rows, "digests")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex(DIGEST)).alias("text_sha256")
    )


def drop_repeats(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    columns = docs.columns
    extra = {c: f"__in_{i}" for i, c in enumerate(columns)}
    rows = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in extra.items()],
    )
    marked = mark_repeats(with_digest(rows, extra["text"]), extra["doc_id"]).filter("kept")
    return marked.select(*[F.col(n).alias(c) for c, n in extra.items()])


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g
"""
