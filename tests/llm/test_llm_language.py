"""Language identification against a plain implementation with dictionaries of text."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltbed.llm import language


def plain_words(text):
    return "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()


class Plain:
    """Kneser-Ney probabilities by the book: dictionaries of n-grams as text."""

    def __init__(self, texts):
        top = {}
        for word in (w for t in texts for w in plain_words(t)):
            padded = "\x02" * 4 + word + "\x03"
            for i in range(len(word) + 1):
                top[padded[i : i + 5]] = top.get(padded[i : i + 5], 0) + 1
        self.counts = {5: top}
        for n in range(4, 0, -1):
            self.counts[n] = {}
            for gram in self.counts[n + 1]:
                self.counts[n][gram[1:]] = self.counts[n].get(gram[1:], 0) + 1
        self.total, self.kinds = {}, {}
        for n, counts in self.counts.items():
            for gram, count in counts.items():
                self.total[n, gram[:-1]] = self.total.get((n, gram[:-1]), 0) + count
                self.kinds[n, gram[:-1]] = self.kinds.get((n, gram[:-1]), 0) + 1

    def chance(self, gram):
        n = len(gram)
        lower = self.chance(gram[1:]) if n > 1 else 1 / 4096
        total = self.total.get((n, gram[:-1]))
        if total is None:
            return lower
        own = max(self.counts[n].get(gram, 0) - 0.75, 0) / total
        return own + 0.75 * self.kinds[n, gram[:-1]] / total * lower

    def nats(self, word):
        padded = "\x02" * 4 + word + "\x03"
        return -sum(math.log(self.chance(padded[i : i + 5])) for i in range(len(word) + 1))


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 3 == 1


def expected(rows):
    """doc_id, held_out, lang_pred, score and nats of each row by the docstring."""
    texts = {}
    for i, text, lang in rows:
        if not held_out(i) and lang is not None and text is not None:
            texts.setdefault(lang, []).append(text)
    models = {lang: Plain(own) for lang, own in sorted(texts.items()) if any(map(plain_words, own))}
    out = []
    for i, text, lang in rows:
        words = plain_words(text)
        size = sum(len(w) + 1 for w in words)
        if not size or not models:
            out.append([i, held_out(i), "und", 0.0, None, lang])
            continue
        sums = {k: sum(map(m.nats, words)) / size for k, m in models.items()}
        best = min(sums, key=sums.get)
        weights = [math.exp(-(s - sums[best]) / 0.05 * math.log1p(size)) for s in sums.values()]
        out.append([i, held_out(i), best, 1 / sum(weights), sums[best], lang])
    limits = {}
    for i, out_of, best, _, nats, lang in out:
        if nats is not None and not out_of and lang == best:
            limits.setdefault(best, []).append(nats)
    for row in out:
        own = sorted(limits.get(row[2], []))
        limit = own[math.ceil(0.999 * len(own)) - 1] if own else -1.0
        if row[4] is None or row[4] > limit + 1e-6:
            row[3] /= 2
    return sorted(out, key=repr)


def compare(spark, rows):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, size string")
    got = sorted((tuple(r) for r in language.identify(docs).drop("accepted").collect()), key=repr)
    want = expected(rows)
    assert [g[:3] for g in got] == [tuple(w[:3]) for w in want]
    for g, w in zip(got, want):
        assert (g[4] is None) == (w[4] is None)
        assert g[4] is None or math.isclose(g[4], w[4], rel_tol=1e-5)
        assert math.isclose(g[3], w[3], rel_tol=1e-3, abs_tol=1e-6)


def random_rows(seed, languages, n):
    rng = random.Random(seed)
    letters = {lang: rng.choices("abcdefghijklmnopqrstuvwxyzéßñжщ日本", k=6) for lang in languages}

    def text(lang):
        return " ".join("".join(rng.choices(letters[lang], k=rng.randint(1, 7))) for _ in range(rng.randint(1, 30)))

    return [(i, text(lang), lang) for i, lang in enumerate(rng.choices(languages, k=n))]


ODD = [
    (9000, None, "a"), (9001, "", "a"), (9002, "12 ½ ² ① Ⅷ !?_", "b"), (9003, "x²y ½ x", None), (None, "abc", "a"), (None, "abc", "a"),
    (9004, "İstanbul ǅ ﬁ \x00 a\u0301b", "b"), (9005, "qw" * 5000, None), (9006, "qw " * 5000, None),
]


@pytest.mark.parametrize("seed, block, chunk, most", [(1, 50_000, 1 << 17, 800_000), (2, 50_000, 1 << 17, 30)])
def test_whole_query_equals_the_plain_models(spark, monkeypatch, seed, block, chunk, most):
    monkeypatch.setattr(language.measured, "__defaults__", (most,))
    compare(spark, random_rows(seed, ["a", "b", "c"], 150) + ODD)


def test_many_blocks_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(language, "BLOCK", 40)
    monkeypatch.setattr(language, "CHUNK", 200)
    monkeypatch.setattr(language, "ASKED", 300)
    compare(spark, random_rows(3, ["a", "b"], 90) + ODD)


def test_hundreds_of_languages(spark):
    compare(spark, random_rows(4, [f"l{i:03}" for i in range(150)], 400))


def test_a_languages_chances_sum_to_one():
    model = Plain(["kato toka miru"])
    context, letters = "\x02\x02\x02t", sorted(set("katomiru\x03"))
    seen = sum(model.chance(context + c) for c in letters)
    # Letters that never occur share what is left of the uniform choice equally.
    assert seen + (4096 - len(letters)) * model.chance(context + "z") == pytest.approx(1)


def test_letters_are_what_isalpha_says():
    text = "".join(map(chr, [*range(0x3000), *range(0xFB00, 0xFFFF), *range(0x1D400, 0x1D800)]))
    assert language.words(text) == plain_words(text)
    assert language.words("ab1cd_e½f²") == ["ab", "cd", "e", "f"]


def test_hashes_keep_ngrams_apart():
    rng = np.random.default_rng(7)
    codes = np.unique(rng.integers(97, 1000, (200_000, 5)), axis=0)
    assert len(np.unique(language.hashes(codes))) == len(codes)
    low = np.arange(0x10FFFF, dtype=np.uint32)[:, None]
    marked = [np.c_[np.repeat([[2] * k], len(low), axis=0), low] for k in range(5)]
    every = np.concatenate([language.hashes(c) for c in marked])
    assert len(np.unique(every)) == len(every)


def test_scratch_tables_are_deleted(spark, monkeypatch):
    made, gone = [], []
    write, remove = language.written, language.removed
    monkeypatch.setattr(language, "written", lambda df, name: made.append(name) or write(df, name))
    monkeypatch.setattr(language, "removed", lambda *tables: gone.extend(tables) or remove(*tables))
    docs = spark.createDataFrame(random_rows(5, ["a", "b"], 40), "doc_id long, text string, lang string")
    assert language.identify(docs).count() == 40
    assert len(made) == len(gone) + 1 and made[-1] == "measured"
