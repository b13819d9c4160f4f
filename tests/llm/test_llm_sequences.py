"""Periodic runs, benchmark phrases and fill-in-middle: brute force, round trips, odd rows."""

import hashlib
import os
import random
import re
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltbed.llm import decontamination, fill_middle, runs
from siltbed.llm.queries import ORACLES, QUERIES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import oracle  # noqa: E402

ODD_TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r",
    "  two  spaces\x0band a tail \n",
    "Straße ÉTÉ ﬁ Å 日本語 😀 \x1f   x\u0085y",
    "a mark <S> inside",
    "nul\x00 zero​width　wide 12-34",
    "x" * 70_000,
    "the quick brown fox " * 4_000,
    "one " * 30,
]


def table(spark, texts, name="doc_id"):
    """Rows with ids, extra columns with names that the operators use, repeated and null ids."""
    rows = [(i if i % 7 else None, t, "clash", 1, "s") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"{name} long, text string, spans string, row long, place string")


def fixture(spark, tmp_path, docs, benchmark=()):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(benchmark), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_runs(words, least):
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def repetitive(rng):
    kinds, out = rng.choice([1, 2, 3, 5, 50]), []
    for _ in range(rng.randint(0, 6)):
        period = [rng.randrange(kinds) for _ in range(rng.randint(1, 15))]
        out += (period * rng.randint(1, 9))[: rng.randint(1, 9 * len(period))]
        out += [rng.randrange(3 * kinds) for _ in range(rng.randint(0, 30))]
    return out


@pytest.mark.parametrize("least", [4, 8, 24])
def test_split_and_scan_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(200):
        docs = [repetitive(rng) for _ in range(rng.randint(1, 4))]
        owner = np.repeat(np.arange(len(docs)), list(map(len, docs)))
        flat, base = np.array(sum(docs, []), np.int64), np.cumsum([0, *map(len, docs)])
        found = [[] for _ in docs]
        for s, e in runs.segments(flat, owner, least):
            found[owner[s]] += [(s + a - base[owner[s]], n, q) for a, n, q in runs.lag_scan(flat[s:e], least)]
        assert [sorted(f) for f in found] == [brute_runs(d, least) for d in docs]


def test_scan_in_small_steps_and_with_hashes_that_meet(monkeypatch):
    words = np.array(repetitive(random.Random(5)) * 3)
    monkeypatch.setattr(runs, "PAIRS", 1)
    assert sorted(runs.lag_scan(words, 4)) == brute_runs(words.tolist(), 4)
    monkeypatch.setattr(runs, "_prefix_hashes", lambda w: (np.zeros(len(w) + 1, np.uint64), np.ones(len(w) + 1, np.uint64)))
    assert sorted(runs.lag_scan(words, 4)) == brute_runs(words.tolist(), 4)


def expected_runs(doc_id, text):
    words = words_of(text)
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words, 24)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in sorted(found, key=lambda r: (r[0], r[2])))
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    values = [*best, 1000 * best[1] // best[2]] if best else [None] * 4
    return (doc_id, len(found), *values, *digests)


def test_periodic_runs_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "日本", "a b"]
    texts = [t for t in ODD_TEXTS if not t or len(t) < 10_000]
    for _ in range(120):
        numbers = repetitive(rng)
        texts.append(rng.choice([" ", "\n", "\t \x0b"]).join(vocabulary[x % len(vocabulary)] for x in numbers))
    docs = table(spark, texts + texts[:5])
    result = QUERIES["op11_periodic_runs"](spark, fixture(spark, tmp_path, docs))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert result.columns == names
    key = repr
    assert sorted(map(tuple, result.collect()), key=key) == sorted(
        (expected_runs(r["doc_id"], r["text"]) for r in docs.collect()), key=key
    )


def test_long_run_is_collapsed_and_empty_table_stays_empty(spark):
    rows = runs.collapse_runs(table(spark, ODD_TEXTS)).collect()
    assert rows[8]["collapsed"] == "the quick brown fox" and rows[8]["n_words"] == 16_000
    assert [tuple(r) for r in rows[8]["runs"]] == [(0, 16_000, 4)]
    assert rows[9]["collapsed"] == "one" and tuple(rows[9]["strongest"]) == (0, 30, 1)
    assert rows[0]["runs"] == [] and rows[0]["collapsed"] == "" and rows[0]["strongest"] is None
    assert runs.collapse_runs(table(spark, [])).count() == 0


def test_splitting_recurses_to_stability():
    # Words 1 to 4 occur three times only as long as the word between their groups is there.
    words = np.array(([1, 2, 3, 4] * 2 + [9] + [1, 2, 3, 4]) + [7] * 30)
    assert runs.segments(words, np.zeros(len(words), int), 24) == [(13, 43)]


def plain_fold(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def brute_hits(texts, items, window=10):
    found = {}
    for item, text in items:
        words = plain_fold(text)
        for i in range(max(len(words) - window, 0) + 1 if words else 0):
            found.setdefault(tuple(words[i : i + window]), set()).add(item)
    sizes = {len(w) for w in found}
    out = []
    for text in texts:
        words, hit, named = plain_fold(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                items_here = found.get(tuple(words[i : i + size]))
                if items_here is not None:
                    hit.update(range(i, i + size))
                    named |= {str(x) for x in items_here if x is not None}
        out.append((len(words), hit, sorted(named)))
    return out


def corpus(seed, docs=60, items=25):
    rng = random.Random(seed)
    vocabulary = ["Alpha", "beta", "GAMMA", "δέλτα", "e5", "İx", "zeta", "eta"]
    some = [rng.choices(vocabulary, k=rng.choice([0, 1, 3, 9, 10, 11, 40])) for _ in range(items)]
    texts = []
    for _ in range(docs):
        words = rng.choices(vocabulary + ["other"], k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            item = rng.choice(some)
            at = rng.randint(0, len(words))
            words[at:at] = item[: rng.randint(0, 40)]
        texts.append(rng.choice([" ", ", ", "\n--\x00"]).join(words))
    texts += texts[:8] * 3  # copies
    return texts, [(i % 20 if i else None, " ".join(words)) for i, words in enumerate(some)] + [(99, None), (98, "...")]


@pytest.mark.parametrize("shard, chunk, block", [(1 << 19, 256, 50_000), (64, 16, 40)])
def test_hits_equal_brute_force(spark, monkeypatch, shard, chunk, block):
    monkeypatch.setattr(decontamination, "SHARD", shard)
    monkeypatch.setattr(decontamination, "CHUNK", chunk)
    texts, items = corpus(shard)
    texts += ODD_TEXTS[:7]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    # Patched sizes reach the search through direct calls, as tasks have their own modules.
    blocks = decontamination.blocks_of(benchmark, 10, block)
    assert len(blocks) > 1 or block == 50_000
    got = [(0, set(), set()) for _ in texts]
    for pairs in blocks:
        phrases = decontamination.Phrases(pairs, 10)
        split = [t.encode().translate(decontamination._FOLD).split() for t in (x or "" for x in texts)]
        base = np.cumsum([0, *(len(s) + 1 for s in split)])
        numbers = np.array([n for s in split for n in [*(phrases.numbers.get(w, 0) for w in s), 0]], np.int32)
        for text, places in decontamination.chunks(numbers, int(phrases.sizes.min()), 10):
            index = decontamination.FmIndex(text, len(phrases.numbers))
            low, high = index.search(phrases.words, phrases.sizes)
            for k in np.flatnonzero(high > low):
                for at in places[index.locate(np.arange(low[k], high[k]))].tolist():
                    i = int(np.searchsorted(base, at, "right")) - 1
                    got[i][1].update(range(at - base[i], at - base[i] + int(phrases.sizes[k])))
                    got[i][2].update(phrases.items[k])
    assert [(hit, sorted(named)) for _, hit, named in got] == [(h, n) for _, h, n in brute_hits(texts, items)]


@pytest.mark.parametrize("block", [50_000, 60])
def test_contaminated_rows_equal_brute_force(spark, block):
    texts, items = corpus(7)
    texts += ODD_TEXTS
    docs = table(spark, texts)
    found = decontamination.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"), block=block)
    got = [
        (r["text"], r["n_words"], {i for s in r["spans"] for i in range(s["start"], s["end"])}, r["items"])
        for r in found.collect()
    ]
    assert got == [(t, *rest) for t, rest in zip(texts, brute_hits(texts, items))]


def test_suffixes_are_in_order():
    rng = random.Random(2)
    for _ in range(100):
        parts = [[rng.randint(1, 3) for _ in range(rng.randint(1, 12))] for _ in range(rng.randint(1, 8))]
        text = np.array([x for p in parts for x in [*p, 0]])
        marks = np.cumsum(text == 0) - (text == 0)
        plain = [(0, m) if x == 0 else (1, x) for x, m in zip(text.tolist(), marks.tolist())]
        order = decontamination.suffix_order(text, 3).tolist()
        assert order == sorted(range(len(text)), key=lambda i: plain[i:])
        index = decontamination.FmIndex(text, 3)
        assert index.locate(np.arange(len(text))).tolist() == order


def test_removal_cuts_whole_spans_only(spark):
    item = "one two three four five six seven eight nine ten eleven"
    texts = [f"Before, {item.upper().replace(' ', ' -- ')}; after.", "one two three four", None, "", item]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = [r["text"] for r in decontamination.remove_hits(table(spark, texts), benchmark).collect()]
    assert left == ["Before, ; after.", "one two three four", None, "", ""]


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(table(spark, []), none).count() == 0
    rows = decontamination.contaminated(table(spark, ["a b", None]), none).collect()
    assert [(r["n_words"], r["spans"], r["items"]) for r in rows] == [(2, [], []), (0, [], [])]


def expected_middle(doc_id, text, units=None):
    text = text or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(tokens)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:low], tokens[low:high], tokens[high:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        form, output, sizes = "plain", text, (None, None)
    elif h4 % 100 < 80:
        form, output, sizes = "spm", f"<S>{s}<P>{p}<M>{m}", (len(p), len(m))
    else:
        form, output, sizes = "psm", f"<P>{p}<S>{s}<M>{m}", (len(p), len(m))
    return (doc_id, n, form, *sizes, output, text)


def middle_texts():
    rng = random.Random(9)
    alphabet = ["a", "bb", "é日", "<P", ">", "<M", " ", "\n\t", "😀", "\x1f"]
    return ODD_TEXTS + ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(150)]


@pytest.mark.parametrize("units", [1, 3, fill_middle.UNITS])
def test_fill_in_middle_equals_brute_force(spark, tmp_path, units):
    path = str(tmp_path / "docs")
    table(spark, middle_texts() + middle_texts()[20:40]).write.parquet(path)
    docs = spark.read.parquet(path)
    want = [expected_middle(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert {w[2] for w in want} == {"plain", "spm", "psm"}
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    got = fill_middle.digests(docs, units=units).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((*w[:5], digest(w[5]), digest(w[6])) for w in want), key=repr)
    texts = fill_middle.fill_in_middle(docs, units=units).collect()
    assert sorted(map(tuple, texts), key=repr) == sorted(((w[0], w[2], w[5]) for w in want), key=repr)


def test_pieces_are_small_and_restored_by_marks_alone(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(200).withColumnRenamed("id", "doc_id").withColumn("text", F.repeat(F.lit("word \n"), 50)).write.parquet(path)
    rows = fill_middle.drawn(spark.read.parquet(path)).filter("form <> 'plain'")
    cut = fill_middle.pieces(rows, 4)
    assert cut.agg(F.max(F.length("piece"))).first()[0] <= 4 * len(" \nword")
    outputs = fill_middle.arranged(cut).withColumn("place", F.col("place") * 1000)  # places say nothing any more
    again = fill_middle._restored(fill_middle.arranged(fill_middle._returned(outputs))).collect()
    assert len(again) == rows.count() and {r["restored_sha256"] for r in again} == {hashlib.sha256(b"word \n" * 50).hexdigest()}


def test_fill_in_middle_of_an_empty_table(spark):
    empty = table(spark, [])
    assert fill_middle.digests(empty).count() == 0 and fill_middle.fill_in_middle(empty).count() == 0


@pytest.mark.parametrize("name", ["op12_decontamination", "op13_fill_in_middle"])
def test_query_equals_its_sql_on_odd_rows(spark, tmp_path, name):
    texts, items = corpus(11)
    folder = fixture(spark, tmp_path, table(spark, texts + [t for t in ODD_TEXTS if "\x00" not in (t or "")]), items)
    con = oracle.duckdb.connect()
    for own in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {own} AS SELECT * FROM '{folder}/{own}.parquet/*.parquet'")
    ours, theirs = oracle.compare(QUERIES[name](spark, folder), con, ORACLES[name])
    assert ours == theirs
