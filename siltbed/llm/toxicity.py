"""Toxicity by a weighted lexicon that is matched by Aho-Corasick on folded text.

Folding: lower case, accents and full-width forms to their base letter, look-alike
letters of other scripts and digits that stand for letters to the letter they imitate,
zero-width characters removed, separators to one space. A term is the start of a word
in folded text, so all endings of a stem are found.

Learning, from at most about ``TRAINING_ROWS`` labelled rows (a share of the ids by
hash, of all if there are fewer; the only bound here, and so one on what comes to the
driver: starts and phrases that pass a threshold of evidence in that sample): every word of their whole texts
counts once a document and class, and every start of a word of 3 to 12 letters sums its
words. A start becomes a term if its log-odds are at least ``MIN_LOG_ODDS`` and its
G-squared is at least ``MIN_G2``, unless nearly all of its toxic words go on with one and
the same letter: then the longer start stands for it. A word counts with the weight of
its longest term. Two-word phrases with a term that make up ``EXCEPTION_SHARE`` of the
clean documents with that term, and that toxic ones hardly use, become exceptions, where
the term counts nothing. Starts above ``MIN_RAW_ODDS`` and ``MIN_RAW_G2`` are tried as
terms, and measured again without the documents that only use them in exceptions.

The sum of a text's term weights is divided by 1 + log(1 + thousands of characters) and
calibrated by logistic regression over counts of rounded values, from all training rows.

Null and empty texts match nothing and get the score of a text without terms. Without
labels of both classes that is the share of toxic labels, 0 without any. Repeated
labels of an id count as toxic if one is. Repeated documents get the same score each.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from siltbed.llm.common import batches_of, crc32_of_id, map_batches, written

TRAINING_ROWS = 40_000
SHORTEST, LONGEST = 3, 12
MIN_RAW_ODDS, MIN_LOG_ODDS = 0.5, 2.5
MIN_RAW_G2, MIN_G2 = 10.0, 30.0
MIN_EXCEPTION, EXCEPTION_SHARE = 3, 0.05
HELD_OUT_OF = 5

# Letters and digits by the letter that they imitate.
LOOK_ALIKES = {
    "a": "а@4α", "b": "вЬ8β", "c": "сϲ", "d": "ԁ", "e": "еєё3ε", "g": "ɡ9", "h": "һн",
    "i": "іїı1ι¡", "j": "ј", "k": "кκ", "l": "ӏ|", "m": "м", "n": "пη", "o": "о0οσ",
    "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ$5", "t": "т7τ", "u": "υц", "v": "ѵν", "w": "ԝшω",
    "x": "хχ", "y": "уγү", "z": "2ᴢ",
}
ZERO_WIDTH = "­​‌‍⁠﻿"


class _Folds(dict):
    """A character's folded form, worked out when first met."""

    def __missing__(self, code: int) -> str:
        base = unicodedata.normalize("NFKD", chr(code)).lower()
        base = "".join(c for c in base if not unicodedata.combining(c))
        out = "".join(self.of_character(c) for c in base) if base else ""
        if len(self) < 100_000:
            self[code] = out
        return out

    @staticmethod
    def of_character(c: str) -> str:
        if c in ZERO_WIDTH:
            return ""
        if c in _IMITATED:
            return _IMITATED[c]
        return c if c.isalnum() else " "


_IMITATED = {c.lower(): letter for letter, many in LOOK_ALIKES.items() for c in many}
_FOLDS = _Folds()
_RUNS = re.compile(r" {2,}")
_ONE = re.compile(r"[^\W\d_]1|1[^\W\d_]")


def folded(text: str | None) -> str:
    """Words of letters only, one space around each."""
    return _RUNS.sub(" ", f" {text.translate(_FOLDS)} ") if text else " "


def readings(text: str | None) -> list[str]:
    """The folded text; where a 1 touches a letter, also with each 1 read as l, not i."""
    first = folded(text)
    return [first, folded(text.replace("1", "l"))] if text and _ONE.search(text) else [first]


@dataclass
class Lexicon:
    """Terms by weight, exception phrases, and the calibration of sums."""

    weights: dict[str, float]
    exceptions: frozenset[tuple[str, str]] = field(default_factory=frozenset)
    intercept: float = 0.0
    slope: float = 0.0
    prior: float | None = None

    @functools.cached_property
    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(" " + term, (len(term), weight))
        if len(found):
            found.make_automaton()
        return found

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "automaton"}

    def hits(self, text: str) -> list[tuple[int, int, float]]:
        """Start and end of each word that begins with a term, and its longest term's weight."""
        best: dict[int, tuple[int, float]] = {}
        if len(self.automaton):
            for end, (length, weight) in self.automaton.iter(text):
                best[end - length + 1] = max(best.get(end - length + 1, (0, 0.0)), (length, weight))
        return [(at, text.index(" ", at), weight) for at, (_, weight) in best.items()]

    def measure(self, text: str | None) -> float:
        """Sum of weights by length; the larger of two readings."""
        sums = []
        for reading in readings(text):
            found = self.hits(reading)
            if self.exceptions:
                found = [h for h in found if self.exceptions.isdisjoint(phrases(reading, *h[:2]))]
            sums.append(sum(weight for *_, weight in found) / (1 + math.log1p(len(reading) / 1000)))
        return max(sums)

    def score(self, text: str | None) -> float:
        if self.prior is not None:
            return self.prior
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.intercept + self.slope * self.measure(text)))))


def phrases(text: str, start: int, end: int) -> list[tuple[str, str]]:
    """The word at a place with the word before and the word after it."""
    word = text[start:end]
    out = []
    if start > 1:
        out.append((text[text.rfind(" ", 0, start - 1) + 1 : start - 1], word))
    if end + 1 < len(text):
        out.append((word, text[end + 1 : text.index(" ", end + 1)]))
    return out


def training_labels(labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """doc_id and toxic of a share of the labelled ids, about ``rows`` at most."""
    known = labels.filter("toxic is not null and doc_id is not null")
    known = known.filter(crc32_of_id() % HELD_OUT_OF != 0)
    most = known.count()
    known = written(known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "labels", most)
    share = int(min(1.0, rows / max(1, known.count())) * (1 << 30))
    return known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)


def learn(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """The lexicon of the labelled training rows of ``docs`` (doc_id, text)."""

    def count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            classes: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                # A space alone stands for the document itself.
                classes[int(toxic > 0)].update({w[:LONGEST] for w in folded(text).split()} | {" "})
            words = list(classes[0].keys() | classes[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string())]
                + [pa.array([classes[k][w] for w in words], pa.int64()) for k in (0, 1)],
                ["word", "clean", "toxic"],
            )

    # The sample's size has a bound, so it is broadcast and texts stay where they are read.
    train = docs.join(F.broadcast(training_labels(labels)), "doc_id").select("text", "toxic")
    train = written(train, "training")
    words = map_batches(train, count_words, "word string, clean long, toxic long")
    words = written(words.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "words")
    whole = words.filter("word = ' '").first()
    clean, toxic = (whole["clean"], whole["toxic"]) if whole else (0, 0)
    if not clean or not toxic:
        return Lexicon({}, prior=toxic / (clean + toxic) if clean + toxic else 0.0)

    starts = F.sequence(F.lit(SHORTEST), F.least(F.length("word"), F.lit(LONGEST)))
    starts = words.filter(F.length("word") >= SHORTEST).withColumn("n", F.explode(starts))
    starts = starts.groupBy(F.expr("substring(word, 1, n)").alias("start")).agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    share = toxic / (clean + toxic)
    sums = F.col("clean") + F.col("toxic")
    starts = starts.withColumns(
        {
            "odds": F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1)),
            "g2": 2 * F.col("toxic") * F.log(F.col("toxic") / (sums * share))
            + F.when(F.col("clean") > 0, 2 * F.col("clean") * F.log(F.col("clean") / (sums * (1 - share)))).otherwise(0),
        }
    )
    found = starts.filter((F.col("toxic") > 0) & (F.col("odds") >= MIN_RAW_ODDS) & (F.col("g2") >= MIN_RAW_G2))
    found = found.collect()
    counts = {r["start"]: (r["clean"], r["toxic"], r["odds"]) for r in found}
    tried = Lexicon(chosen(counts))
    exceptions = _exceptions(train, tried, {t: counts[t][0] for t in tried.weights})
    if exceptions:
        tried.exceptions = exceptions
        for term, (fewer, less) in _only_in_exceptions(train, tried).items():
            counts[term] = (counts[term][0] - fewer, counts[term][1] - less)
    weights = {}
    for term in tried.weights:
        odds, g2 = _measures(*counts[term][:2], clean, toxic)
        if odds >= MIN_LOG_ODDS and g2 >= MIN_G2:
            weights[term] = odds
    return _calibrated(train, Lexicon(weights, exceptions))


def _measures(clean: int, toxic: int, all_clean: int, all_toxic: int) -> tuple[float, float]:
    """Log-odds and G-squared of a term's documents by class."""
    odds = math.log((toxic + 0.5) / (all_toxic + 1)) - math.log((clean + 0.5) / (all_clean + 1))
    share, n = all_toxic / (all_clean + all_toxic), clean + toxic
    g2 = sum(2 * k * math.log(k / (n * p)) for k, p in ((toxic, share), (clean, 1 - share)) if k > 0)
    return odds, g2


def chosen(starts: dict[str, tuple[int, int, float]]) -> dict[str, float]:
    """Terms by log-odds, without starts that one start longer by a letter stands for."""
    most: dict[str, int] = {}
    for start, (_, toxic, _) in starts.items():
        most[start[:-1]] = max(most.get(start[:-1], 0), toxic)
    return {s: odds for s, (_, toxic, odds) in starts.items() if most.get(s, 0) < 0.95 * toxic}


def _count(train: DataFrame, lexicon: Lexicon, keys: Callable[[Lexicon, str], set]) -> DataFrame:
    """Clean and toxic training documents of each key (two strings) of a folded text."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            found: Counter = Counter()
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                found.update((*k, int(toxic > 0)) for k in keys(lexicon, folded(text)))
            columns = list(zip(*found)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
                 pa.array(columns[2], pa.int32()), pa.array(list(found.values()), pa.int64())],
                ["a", "b", "toxic", "n"],
            )

    counted = map_batches(train, count, "a string, b string, toxic int, n long")
    each = {name: F.sum(F.when(F.col("toxic") == k, F.col("n")).otherwise(0)) for k, name in enumerate(("n0", "n1"))}
    return counted.groupBy("a", "b").agg(*[c.alias(n) for n, c in each.items()])


def _phrases_of(lexicon: Lexicon, text: str) -> set[tuple[str, str]]:
    return {p for start, end, _ in lexicon.hits(text) for p in phrases(text, start, end)}


def _excepted(lexicon: Lexicon, text: str) -> set[tuple[str, str]]:
    """Terms that a text has in exceptions only."""
    inside, outside = set(), set()
    for start, end, _ in lexicon.hits(text):
        own = {text[start:n] for n in range(start + SHORTEST, min(end, start + LONGEST) + 1)} & lexicon.weights.keys()
        hit = not lexicon.exceptions.isdisjoint(phrases(text, start, end))
        (inside if hit else outside).update(own)
    return {(t, "") for t in inside - outside}


def _exceptions(train: DataFrame, lexicon: Lexicon, clean: dict[str, int]) -> frozenset[tuple[str, str]]:
    """Phrases that are a good part of a term's clean uses and occur in hardly any toxic document."""
    rows = _count(train, lexicon, _phrases_of).filter(f"n0 >= {MIN_EXCEPTION} and n0 > 4 * n1").collect()

    def enough(phrase: tuple[str, str], n: int) -> bool:
        uses = [clean[w[:k]] for w in phrase for k in range(SHORTEST, min(len(w), LONGEST) + 1) if w[:k] in clean]
        return bool(uses) and n >= EXCEPTION_SHARE * min(uses)

    return frozenset((r["a"], r["b"]) for r in rows if enough((r["a"], r["b"]), r["n0"]))


def _only_in_exceptions(train: DataFrame, lexicon: Lexicon) -> dict[str, tuple[int, int]]:
    return {r["a"]: (r["n0"], r["n1"]) for r in _count(train, lexicon, _excepted).collect()}


def _calibrated(train: DataFrame, lexicon: Lexicon) -> Lexicon:
    """Fits intercept and slope to counts by rounded measure: 401 values at most."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            values = [min(400, round(10 * lexicon.measure(t))) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.int32()), batch["toxic"]], ["x", "toxic"])

    counts = map_batches(train, measure, "x int, toxic int").groupBy("x").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("toxic") > 0).cast("long")).alias("toxic")
    )
    rows = counts.orderBy("x").collect()
    x = np.array([r["x"] / 10 for r in rows])
    n, toxic = (np.array([r[k] for r in rows], float) for k in ("n", "toxic"))
    design, fit = np.stack([np.ones_like(x), x], 1), np.array([math.log((toxic.sum() + 1) / (n.sum() - toxic.sum() + 1)), 0.0])
    ridge = np.diag([1e-3, 0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ fit, -50, 50)))
        gradient = design.T @ (toxic - n * p) - ridge @ fit
        step = np.linalg.solve(design.T @ (design * (n * p * (1 - p))[:, None]) + ridge, gradient)
        fit = fit + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    lexicon.intercept, lexicon.slope = float(fit[0]), float(max(0.0, fit[1]))
    return lexicon


def scores(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` without its text, with a ``score`` of each whole text."""
    others = [c for c in docs.columns if c != "text"]

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            found = pa.array([lexicon.score(t) for t in batch["text"].to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in others), found], [*others, "score"])

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in others), "score double"])
    return map_batches(docs, compute, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each document: doc_id, held_out, score, predicted."""
    docs = docs.select("doc_id", "text")
    found = scores(docs, learn(docs, labels))
    return found.select(
        "doc_id",
        (crc32_of_id() % HELD_OUT_OF == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is below 0.5, with all their columns."""
    columns = docs.columns
    lexicon = learn(docs.select("doc_id", "text"), labels)
    schema = docs.schema

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            texts = batch.column(columns.index("text")).to_pylist()
            yield batch.filter(pa.array([lexicon.score(t) < 0.5 for t in texts], pa.bool_()))

    return map_batches(docs, keep, schema)
