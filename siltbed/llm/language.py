"""Language identification by interpolated Kneser-Ney character models.

Each language's model reads words: their letters in lower case between a start mark and
an end mark, contexts of at most ``ORDER - 1`` characters. The highest order uses counts,
lower orders the number of different characters before an n-gram; every order discounts
by ``DISCOUNT`` and gives that weight to the next lower one, the lowest to a uniform
choice of ``SYMBOLS``. N-grams are counted over all training documents by Spark.

The models are a table of sorted hash arrays: each row has, for one range of 64-bit n-gram hashes,
one language and one use, the hashes in order and their values, which are shares of
n-grams and back-off weights of contexts. The range is as small as ``CHUNK`` values ask for, so
neither a task nor the driver holds a model. Distinct words of the corpus are dealt into blocks of
about ``BLOCK``; a block asks each range for the n-grams that its words have, by
binary search, and adds up its words' nats with sorted arrays of the answers.

Tasks over texts get the nats of the most frequent words (``REMEMBERED`` numbers); the other
words of a text are joined with theirs, by 64-bit hashes.

A text's cross-entropy is the sum over its words divided by their characters and end
marks. The lowest wins.

Rejection: a language's limit is a high quantile of the cross-entropy of its own
training documents; ``accepted`` tells whether the winner is within its limit. ``score``
is a softmax over languages of the whole text's cross-entropies, sharpened with its
length, halved where it is not accepted.

Letters are what ``str.isalpha`` takes for such, so numerals of any kind are none. Null texts, texts without a letter, and all texts if nothing could be learned are
``und`` with score 0. Ties go to the first language by code point. Repeated rows get the
same result each. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from siltbed.llm.common import batches_of, crc32_of_id, map_batches, removed, ship_package, sized_batches, sorted_groups, written

ORDER = 5
DISCOUNT = 0.75
SYMBOLS = 1 << 12
#: Values of a hash range, asked n-grams of a range, and words of a block, about.
CHUNK, ASKED, BLOCK = 1 << 17, 1 << 20, 50_000
REMEMBERED = 800_000
BATCH_BYTES = 4 << 20
LIMIT_QUANTILE = 0.999
HELD_OUT_OF, HELD_OUT_REST = 3, 1
START, END = "\x02", "\x03"
#: Nats per character between two languages that make the better one e times as likely.
TEMPERATURE = 0.05

_WORDS = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    found = _WORDS.findall(text.lower()) if text else []
    if not found or text.isascii() or "".join(found).isalpha():
        return found
    # The pattern also takes numerals that are no decimal digits.
    return "".join(c if c.isalpha() else " " for c in " ".join(found)).split()


def hashes(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each row of character codes, which the models are sorted by."""
    # Lengths start far apart, as hashes of all lengths share a table.
    out = np.full(len(codes), codes.shape[1] + 1, np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    for i in range(codes.shape[1]):
        out = (out ^ codes[:, i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode()) - (1 << 63)


def ngrams(several: list[str]) -> np.ndarray:
    """Codes of the words' n-grams of the highest order: a row for each character and end."""
    text = "".join(START * (ORDER - 1) + w + END for w in several)
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    if not len(codes):
        return np.zeros((0, ORDER), np.uint32)
    windows = np.lib.stride_tricks.sliding_window_view(codes, ORDER)
    return windows[codes[ORDER - 1 :] != ord(START)]


def once(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, and for each row which of them it is."""
    _, first, which = np.unique(hashes(codes), return_index=True, return_inverse=True)
    return codes[first], which


def hashes_of_orders(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order the hashes of each row's context and n-gram."""
    return [(hashes(codes[:, ORDER - n : ORDER - 1]), hashes(codes[:, ORDER - n :])) for n in range(1, ORDER + 1)]


Sorted = tuple[np.ndarray, np.ndarray]


def nats_of(keys: list[tuple[np.ndarray, np.ndarray]], grams: Sorted, contexts: Sorted) -> np.ndarray:
    """Minus log probability of the last character of each row, by sorted hashes with their values."""
    p = np.full(len(keys[0][0]), 1 / SYMBOLS)
    for context, gram in keys:
        p = found(contexts, context, 1.0) * p + found(grams, gram, 0.0)
    return -np.log(np.clip(p, 1e-12, 1.0))


def found(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, missing: float) -> np.ndarray:
    known, values = table
    if not len(known):
        return np.full(len(keys), missing)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, values[at], missing)


def count_words(docs: DataFrame) -> DataFrame:
    """lang (null if not for training), word, n over all rows of lang and text."""

    def rows(counts: Counter) -> pa.RecordBatch:
        keys = [(*key, n) for key, n in counts.items()]
        columns = list(zip(*keys)) or [(), (), ()]
        kinds = (pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(list(map(pa.array, columns, kinds)), ["lang", "word", "n"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, Counter] = {}
        for batch in sized_batches(batches, "text", BATCH_BYTES):
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                held.setdefault(lang, Counter()).update(words(text))
            if sum(map(len, held.values())) > REMEMBERED:
                yield from (rows({(lang, w): n for w, n in c.items()}) for lang, c in held.items())
                held = {}
        yield from (rows({(lang, w): n for w, n in c.items()}) for lang, c in held.items())

    found = map_batches(docs.select("lang", "text"), count, "lang string, word string, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def count_ngrams(counted: DataFrame) -> DataFrame:
    """lang, gram, n: n-grams of the highest order from lang, word and n."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, 1 << 16):
            langs, several = (np.array(batch[c].to_pylist(), object) for c in ("lang", "word"))
            n = batch["n"].to_numpy()
            for lang in set(langs):
                own = several[langs == lang].tolist()
                codes = ngrams(own)
                times = np.repeat(n[langs == lang], [len(w) + 1 for w in own])
                _, first, which = np.unique(hashes(codes), return_index=True, return_inverse=True)
                text = codes[first].astype("<u4").tobytes().decode("utf-32-le")
                grams = [text[k : k + ORDER] for k in range(0, len(text), ORDER)]
                sums = np.bincount(which, times).astype(np.int64)
                columns = [pa.array([lang] * len(grams)), pa.array(grams, pa.string()), pa.array(sums)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

    rows = map_batches(counted.select("lang", "word", "n"), count, "lang string, gram string, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def keyed(rows: DataFrame, size: int, context: bool) -> DataFrame:
    """lang, key, context, value from lang, gram (``size`` characters) and value."""

    def key(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = "".join(batch["gram"].to_pylist())
            codes = np.frombuffer(text.encode("utf-32-le"), "<u4").reshape(batch.num_rows, size)
            columns = [batch["lang"], pa.array(hashes(codes)), pa.array([context] * batch.num_rows), batch["value"]]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "key", "context", "value"])

    return map_batches(rows.select("lang", "gram", "value"), key, "lang string, key long, context boolean, value double")


def learn(train: DataFrame) -> DataFrame:
    """lang, key, context, value: shares of n-grams and back-off weights of contexts of all orders."""
    counted, every, used = count_ngrams(train), None, []
    for n in range(ORDER, 0, -1):
        if n < ORDER:
            # What n-grams of the order above end in: the kinds of characters before.
            counted = counted.groupBy("lang", F.expr(f"right(gram, {n})").alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        counted = written(counted, f"order_{n}")
        used.append(counted)
        own = counted.withColumn("context", F.expr(f"left(gram, {n - 1})"))
        contexts = own.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        share = F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) / F.col("total")
        shares = own.join(contexts.drop("kinds"), ["lang", "context"]).withColumn("value", share)
        backs = contexts.withColumn("value", DISCOUNT * F.col("kinds") / F.col("total")).withColumnRenamed("context", "gram")
        rows = keyed(shares, n, False).unionByName(keyed(backs, n - 1, True))
        every = rows if every is None else every.unionByName(rows)
    model = written(every, "values")
    removed(*used)
    return model


def ranged(chunks: int) -> Column:
    """The number of a key's range among ``chunks`` of equal width."""
    upper = F.expr("shiftright(key, 32)") + F.lit(1 << 31)
    return F.shiftright(upper * F.lit(chunks), 32)


def stored(values: DataFrame, chunks: int) -> DataFrame:
    """chunk, lang, context, keys and values: the models as sorted arrays."""
    pairs = F.array_sort(F.collect_list(F.struct("key", "value")))
    rows = values.withColumn("chunk", ranged(chunks)).groupBy("chunk", "lang", "context").agg(pairs.alias("pairs"))
    return rows.select("chunk", "lang", "context", F.col("pairs.key").alias("keys"), F.col("pairs.value").alias("values"))


def asked_by_blocks(blocks: DataFrame) -> DataFrame:
    """block and key: the n-grams and contexts that each block's words (block, word) have."""

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["block"]):
            codes, _ = once(ngrams(group["word"].to_pylist()))
            distinct = np.unique(np.concatenate([k for pair in hashes_of_orders(codes) for k in pair]))
            columns = [pa.array(np.full(len(distinct), group["block"][0].as_py())), pa.array(distinct)]
            yield pa.RecordBatch.from_arrays(columns, ["block", "key"])

    return map_batches(blocks.select("block", "word"), ask, "block long, key long").distinct()


def answered(asked: DataFrame, model: DataFrame, chunks: int) -> DataFrame:
    """block, lang, context, keys and values: what each block asked for, range by range."""
    kinds = pa.schema(
        [
            ("block", pa.int64()),
            ("lang", pa.string()),
            ("context", pa.bool_()),
            ("keys", pa.list_(pa.int64())),
            ("values", pa.list_(pa.float64())),
        ]
    )

    def look_up(arrays: pa.Table, asks: pa.Table) -> pa.Table:
        out: list[tuple] = []
        blocks, keys = (asks[c].to_numpy() for c in ("block", "key"))
        order = np.argsort(blocks, kind="stable")
        blocks, keys = blocks[order], keys[order]
        for row in range(arrays.num_rows):
            known, values = (arrays[c][row].values.to_numpy() for c in ("keys", "values"))
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = np.flatnonzero(known[at] == keys)
            parts = np.flatnonzero(np.r_[True, np.diff(blocks[hit]) != 0]) if len(hit) else []
            for a, b in zip(parts, [*parts[1:], len(hit)]):
                own = hit[a:b]
                use = (int(blocks[own[0]]), arrays["lang"][row].as_py(), arrays["context"][row].as_py())
                out.append((*use, keys[own], values[at[own]]))
        columns = list(zip(*out)) or [()] * len(kinds)
        return pa.Table.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds)], schema=kinds)

    asked = asked.withColumn("chunk", ranged(chunks))
    return (
        model.groupBy("chunk")
        .cogroup(asked.groupBy("chunk"))
        .applyInArrow(look_up, "block long, lang string, context boolean, keys array<long>, values array<double>")
    )


def word_nats(every: DataFrame, train: DataFrame, languages: list[str]) -> DataFrame:
    """word, hash, n and nats, a number a language; ``every``: word and n, ``train``: lang, word, n."""
    ship_package(every.sparkSession)
    count = max(1, -(-every.count() // BLOCK))
    blocks = every.withColumn("block", F.pmod(F.xxhash64("word"), F.lit(count)))
    blocks = written(blocks.repartition("block").sortWithinPartitions("block"), "blocks")
    asked = written(asked_by_blocks(blocks), "asked")
    values = learn(train)
    chunks = max(1, -(-values.count() // CHUNK), -(-asked.count() // ASKED))
    model = written(stored(values, chunks), "model")
    answers = written(answered(asked, model, chunks), "answers")

    def add_up(several: pa.Table, answers: pa.Table) -> pa.Table:
        own = several["word"].to_pylist()
        codes, which = once(ngrams(own))
        asked = hashes_of_orders(codes)
        ends = np.cumsum([len(w) + 1 for w in own])
        starts = np.r_[0, ends[:-1]].astype(np.int64)
        uses = list(zip(answers["lang"].to_pylist(), answers["context"].to_pylist()))
        sums = []
        for lang in languages:
            tables = []
            for context in (False, True):
                rows = [i for i, use in enumerate(uses) if use == (lang, context)]
                keys = np.concatenate([np.zeros(0, np.int64), *(answers["keys"][i].values.to_numpy() for i in rows)])
                shares = np.concatenate([np.zeros(0), *(answers["values"][i].values.to_numpy() for i in rows)])
                order = np.argsort(keys)
                tables.append((keys[order], shares[order]))
            sums.append(np.add.reduceat(nats_of(asked, *tables)[which], starts) if own else np.zeros(0))
        flat = np.stack(sums, 1).ravel()
        offsets = pa.array(np.arange(0, len(flat) + 1, len(languages)), pa.int32())
        nats = pa.ListArray.from_arrays(offsets, pa.array(flat))
        named = pa.array([word_hash(w) for w in own], pa.int64())
        return pa.Table.from_arrays([several["word"], named, several["n"], nats], ["word", "hash", "n", "nats"])

    summed = (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(add_up, "word string, hash long, n long, nats array<double>")
    )
    known = written(summed, "word_nats")
    removed(blocks, asked, values, model, answers)
    return known


def frequent(known: DataFrame, most: int) -> DataFrame:
    """The most frequent words, at most ``most``."""
    known = known.withColumn("step", F.floor(F.log2("n") * 16).cast("int"))
    # At most 16 x 64 rows.
    total, least = 0, None
    for row in known.groupBy("step").count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > most:
            break
        least = row["step"]
    return known.filter(F.col("step") >= least if least is not None else F.lit(False)).drop("step")


def measured(docs: DataFrame, known: DataFrame | None, languages: list[str], most: int = REMEMBERED) -> DataFrame:
    """``docs`` without its text, with best (language or null), nats a character, score.

    The most frequent words' nats reach every task; the other words are joined.
    """
    others, of, kinds = [c for c in docs.columns if c != "text"], len(languages), dict(docs.dtypes)
    head = frequent(known, most // of).select("word", "nats").toArrow() if of else None
    names = head["word"].to_pylist() if of else []
    values = np.array(head["nats"].to_pylist(), np.float64).reshape(len(names), of) if of else np.zeros((0, 0))
    own = ", ".join(f"`{c}` {kinds[c]}" for c in others)

    def add_known(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {w: i for i, w in enumerate(names)}
        for batch in sized_batches(batches, "text", BATCH_BYTES):
            sizes, sums, rest, times = [], [], [], []
            for text in batch["text"].to_pylist():
                several = words(text)
                at = [places.get(w, -1) for w in several]
                sizes.append(len("".join(several)) + len(several))
                sums.append(values[[i for i in at if i >= 0]].sum(axis=0).tolist())
                left = Counter(w for w, i in zip(several, at) if i < 0) if of else {}
                rest.append([word_hash(w) for w in left]), times.append(list(left.values()))
            added = [
                pa.array(sizes, pa.int64()),
                pa.array(sums, pa.list_(pa.float64())),
                pa.array(rest, pa.list_(pa.int64())),
                pa.array(times, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in others), *added], [*others, "size", "sums", "rest", "times"])

    def rate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, entropy, score = [], [], []
            columns = (batch[c].to_pylist() for c in ("size", "sums", "more"))
            for size, sums, more in zip(*columns):
                if not size or not of:
                    best.append(None), entropy.append(None), score.append(0.0)
                    continue
                nats = np.array(sums) + (np.array(more) if more else 0.0)
                k = int(nats.argmin())
                apart = (nats - nats[k]) / size / TEMPERATURE * math.log1p(size)
                best.append(languages[k]), entropy.append(float(nats[k] / size))
                score.append(float(1 / np.exp(-apart).sum()))
            added = [pa.array(best, pa.string()), pa.array(entropy, pa.float64()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in others), *added], [*others, "best", "nats", "score"])

    schema = f"{own}, size long, sums array<double>, rest array<long>, times array<long>"
    part = map_batches(docs, add_known, schema)
    rated = f"{own}, best string, nats double, score double"
    if not of:
        alone = part.drop("rest", "times").withColumn("more", F.lit(None).cast("array<double>"))
        return written(map_batches(alone, rate, rated), "measured")
    part = written(part.withColumn("row", F.monotonically_increasing_id()), "known_words")
    rest = part.select("row", F.explode(F.arrays_zip("rest", "times")).alias("word"))
    rest = rest.select("row", F.col("word.rest").alias("hash"), F.col("word.times").alias("times"))
    met = rest.join(known.select("hash", "nats"), "hash")
    sums = [F.sum(F.get("nats", F.lit(k)) * F.col("times")) for k in range(of)]
    added = written(met.groupBy("row").agg(F.array(*sums).alias("more")), "other_nats")
    joined = part.drop("rest", "times").join(added, "row", "left").drop("row")
    out = written(map_batches(joined, rate, rated), "measured")
    removed(part, added)
    return out


def identify(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, held_out, lang_pred, score, nats, accepted."""
    docs = docs.select("doc_id", "text", "lang")
    held_out = crc32_of_id() % HELD_OUT_OF == HELD_OUT_REST
    learns = ~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull()
    counted = written(count_words(docs.withColumn("lang", F.when(learns, F.col("lang")))), "words")
    train = counted.filter("lang is not null")
    languages = sorted(r["lang"] for r in train.select("lang").distinct().collect())  # one row a language
    known = None
    if languages:
        every = written(counted.groupBy("word").agg(F.sum("n").alias("n")), "every_word")
        known = word_nats(every, train, languages)
        removed(every)
    removed(counted)
    rated = measured(docs.withColumn("held_out", held_out), known, languages)
    if known is not None:
        removed(known)
    own = rated.filter("not held_out and lang = best")
    limits = own.groupBy("best").agg(F.percentile_approx("nats", LIMIT_QUANTILE, 10_000).alias("limit")).collect()
    pairs = [F.lit(x) for row in limits for x in row]  # one a language
    limit = F.try_element_at(F.create_map(*pairs), F.col("best")) if pairs else F.lit(None).cast("double")
    accepted = F.coalesce(F.col("nats") <= limit, F.lit(False))
    return rated.select(
        "doc_id",
        "held_out",
        F.coalesce("best", F.lit("und")).alias("lang_pred"),
        F.when(accepted, F.col("score")).otherwise(F.col("score") / 2).alias("score"),
        "nats",
        accepted.alias("accepted"),
    )
