"""The other operators: brute force, round trips, held-out accuracy and edge cases."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from siltbed.llm import language, packing, repeats, simhash, token_counts, topk, toxicity
from siltbed.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"

ODD_TEXTS = [
    None,
    "",
    " ",
    "  two  spaces and a tail ",
    "line\nbreak\n\n  indented\ttab",
    "\n",
    "Straße ÉTÉ ﬁ Å 日本語 😀 ▁mark ▁▁ x",
    "<s> <|endoftext|> <|ENDOFTEXT|> it's DON'T ...!? 12345 a.b,c;d",
    "nul\x00 zero​width　wide",
    "x" * 70_000,
    "the quick brown fox " * 4_000,
]


def documents(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", 0, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def test_token_counts_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    rows = token_counts.count_tokens(documents(spark, ODD_TEXTS + ODD_TEXTS)).collect()
    assert len(rows) == 2 * len(ODD_TEXTS)
    for r in rows:
        text = ODD_TEXTS[r["doc_id"] % len(ODD_TEXTS)] or ""
        n = len(library.encode(text))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 4096)
    assert token_counts.count_tokens(documents(spark, [])).count() == 0


def test_shortcut_is_proven():
    words = token_counts.proven(token_counts.MODEL)
    counts = token_counts.Counts(token_counts.MODEL)
    assert len(words) > 10_000 and all(counts.of_text(w) == 1 for w in list(words)[:500])


def test_packing_round_trip(spark):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path(packing.MODEL))
    docs = documents(spark, ODD_TEXTS + ODD_TEXTS[:4] + ["a b c d"] * 300)
    docs = docs.unionByName(docs.filter("doc_id = 3"))
    packed = packing.pack(packing.pieces(docs, ids=True)).cache()
    rows = packed.collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    whole = {i: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t in texts.items()}
    for r in rows:
        part = whole[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        data = np.array(part, "<u4").tobytes()
        assert (len(part), zlib.crc32(data), data) == (r["length"], r["ids_crc32"], r["ids"])
    assert sum(r["length"] for r in rows) == sum(len(whole[i]) for i in whole) + len(whole[3])
    filled = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values()) <= 2048
    joined = {r["sequence_id"]: len(r["ids"]) // 4 for r in packing.sequences(packed).collect()}
    assert joined == filled
    assert packing.pack(packing.pieces(docs.limit(0))).count() == 0


def test_sum_of_squares_counts_every_gap():
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 51, 800))[::-1]
    number, offset = packing.sum_of_squares(lengths, 50)
    open_, fill = np.zeros(51, int), {}
    for n, b, at in zip(lengths.tolist(), number.tolist(), offset.tolist()):
        assert at == fill.get(b, 0) and at + n <= 50
        costs = {}
        for gap in [g for g in range(n, 50) if open_[g]] + [50]:
            after = open_.copy()
            if gap < 50:
                after[gap] -= 1
            if gap > n:
                after[gap - n] += 1
            costs[gap] = (after**2).sum()
        assert costs[50 - at] == min(costs.values())
        if at:
            open_[50 - at] -= 1
        if at + n < 50:
            open_[50 - at - n] += 1
        fill[b] = at + n
    # Each length over 25 needs a sequence of its own, so the sum alone is no bound here.
    plain = len(set(packing.smallest_gaps(lengths, 50)[0].tolist()))
    assert len(set(packing.packed_lengths(lengths, 50)[0].tolist())) <= min(plain + 1, len(set(number.tolist())))


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(n):
        words = rng.choices(vocabulary, k=rng.randint(1, 300))
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    return texts


def test_simhash_components_equal_brute_force(spark):
    texts = ODD_TEXTS[:9] + near_texts(3, 60) + ["A B c D e"] * 50
    docs = documents(spark, texts)
    docs = docs.unionByName(docs.filter("doc_id = 20")).unionByName(
        docs.filter("doc_id = 12").withColumn("doc_id", F.lit(None).cast("long"))
    )
    rows = simhash.simhash_components(docs).collect()
    assert len(rows) == len(texts) + 2
    prints = [plain_fingerprint(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(texts)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    for r in rows:
        i = 12 if r["doc_id"] is None else r["doc_id"]
        assert (int(r["fingerprint"], 16), r["component_id"]) == (prints[i], root(i))
    assert simhash.simhash_components(docs.limit(0)).count() == 0


@pytest.mark.parametrize("apart", [1, 2])
def test_near_values_share_an_anchor(apart):
    rng = np.random.default_rng(apart)
    for width in (22, 21):
        values = rng.integers(0, 1 << width, 300)
        flipped = values.copy()
        for _ in range(apart):
            flipped ^= 1 << rng.integers(0, width, 300)
        rows, anchor = simhash.anchors(np.concatenate([values, flipped]), apart)
        for i in range(300):
            assert set(anchor[rows == i]) & set(anchor[rows == 300 + i])


def test_dense_groups_are_split_without_losing_links(spark):
    base = 0x0123456789ABCDEF
    prints = sorted({base ^ 1 << i ^ 1 << j for i in range(24) for j in range(24)})
    far = [base ^ 0xFFFF << 32, base ^ 0xFFFF << 16]
    rows = [(int(np.uint64(p).astype(np.int64)), 0) for p in prints + far]
    edges = simhash.links(spark.createDataFrame(rows, "fingerprint long, second long"), chunk=40)
    sizes = connected_components(edges).groupBy("component").count().collect()
    assert [r["count"] for r in sizes] == [len(prints)]
    # At most an edge for each fingerprint in each of its tasks: 16 anchors, 7 to 8 chunks.
    assert edges.count() <= 16 * 8 * len(prints)


def test_components_of_paths_and_stars(spark):
    rng = random.Random(5)
    path = [(i, i + 1) for i in range(60)]
    star = [(100, 100 + i) for i in range(1, 200)] + [(7000, 7000), (100, 101)]
    edges = path + star + [(500, 501), (501, 502), (502, 500)]
    rng.shuffle(edges)
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 300)} | {500: 500, 501: 500, 502: 500}
    assert {r["node"]: r["component"] for r in found} == expected and len(found) == len(expected)


def test_near_stage_keeps_one_of_each_and_clean_documents(spark):
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(900)]
    clean = [" ".join(rng.choices(vocabulary, k=400)) for _ in range(30)]
    near = [" ".join("other" if i == 77 else w for i, w in enumerate(t.split())) for t in clean[:10]]
    docs = documents(spark, clean + near + [clean[0]])
    docs = docs.unionByName(docs.filter("doc_id = 5"))
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(30))
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0


def brute_top(vectors, ids, k=5):
    out = []
    for i, q in zip(ids, vectors):
        if i % 50 == 0:
            scores = sorted((-sum(int(a) * int(b) for a, b in zip(q, v)), j) for j, v in zip(ids, vectors) if j != i)
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"block": 16, "queries": 2, "head": 3}])
def test_top_k_equals_brute_force(spark, options):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 12)) * rng.lognormal(size=(200, 1))
    x[20:40], x[60] = x[10], 0
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1000, None), (1050, [float("nan")] * 12), (1100, [None] * 12), (1150, [float("inf")] * 12), (None, [1.0])]
    schema = "vec_id long, embedding array<double>, rank string"
    frame = spark.createDataFrame([(i, v, "x") for i, v in [*rows, *odd, rows[0], rows[7]]], schema)
    found = sorted(map(tuple, topk.top_k(frame, **options).collect()))
    assert found == brute_top(np.floor(x * 256), range(200))
    assert topk.top_k(frame.limit(0)).count() == 0


def test_top_k_of_huge_and_ragged_vectors(spark):
    rows = [(0, [2.0**40, 3.0]), (1, [2.0**41]), (2, [-(2.0**60), 1.0, 5.0]), (50, []), (51, [1e300, 1e300])]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    scores = {(r["query_id"], r["vec_id"]): r["score"] for r in found}
    assert scores[0, 1] == 2**63 - 1 and scores[0, 2] == -(2**63) and scores[50, 51] == 0
    assert [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == 50] == [0, 1, 2, 51]


def brute_repeats(texts, window=100):
    """Bytes kept, removed and spans of texts in order."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - window + 1):
            part = data[s : s + window]
            if part in seen:
                gone[s : s + window] = True
            seen.add(part)
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        out.append((np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), spans))
    return out


def repeated_texts(seed):
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choices("abcdefg é", k=n))
    shared = [noise(n) for n in (95, 100, 130, 180, 260, 700)]
    texts = [None, "", "a" * 99, "a" * 100, "a" * 350, "ab" * 400, noise(5000)]
    for _ in range(60):
        parts = [noise(rng.randint(0, 120))]
        for _ in range(rng.randint(1, 4)):
            piece = rng.choice(shared)
            cut = rng.randint(0, 60)
            parts += [piece[cut:] if rng.random() < 0.4 else piece, noise(rng.randint(0, 90))]
        texts.append("".join(parts))
    return texts + [texts[10], texts[11], "x" + texts[12] + "y"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_equal_brute_force(spark, seed):
    texts = repeated_texts(seed)
    docs = documents(spark, texts).repartition(5, "text")
    found = {r["doc_id"]: (bytes(r["kept"]), r["n_removed"], r["n_spans"]) for r in repeats.remove_repeats(docs).collect()}
    assert [found[i] for i in range(len(texts))] == brute_repeats(texts)


def test_repeats_of_long_texts_across_chunks(spark, monkeypatch):
    rng = random.Random(9)
    long = "".join(rng.choices("abcd", k=1_200_000))
    texts = [long, long[300_000:] + "tail", "head" + long[:700_000]]
    found = {r["doc_id"]: r for r in repeats.remove_repeats(documents(spark, texts)).collect()}
    assert [found[i]["n_removed"] for i in range(3)] == [0, 900_000, 700_000]


def test_repeats_of_rows_without_or_with_one_id(spark):
    text = "".join(random.Random(2).choices("abcd", k=300))
    rows = [(7, text), (7, text), (None, text + "z"), (3, None)]
    found = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in found) == [(0, 300), (3, 0), (7, 0), (7, 300)]
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_deep_shallow_sorts_any_strings():
    rng = random.Random(6)
    for _ in range(200):
        stem = bytes(rng.choices(b"ab", k=60))
        strings = [stem[: rng.randint(0, 60)] + bytes(rng.choices(b"ab\0", k=rng.randint(0, 9))) for _ in range(40)]
        order = repeats.deep_shallow(strings)
        assert [strings[i] for i in order] == sorted(strings) and sorted(order) == list(range(40))


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def held_out(i, of):
    return zlib.crc32(str(i).encode()) % of


def test_toxicity_learns_terms_exceptions_and_folding(spark):
    rng = random.Random(1)
    filler = [f"{a}{b}" for a in ("lo", "mi", "ra", "tu", "ve") for b in ("ka", "ne", "so", "pi")]
    words = lambda n: " ".join(rng.choices(filler, k=n))
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 5 == 0
        middle = rng.choice(["grumpf", "snarlo", "snarlitz"]) if toxic else "dear grumpf pie" if i % 7 == 1 else words(1)
        rows.append((i, f"{words(rng.randint(5, 60))} {middle} {words(20)}"))
        labels.append((i, 1, int(toxic)))
    extra = [None, "", "GRÜMPF " + words(9), "snаrlo " + words(9), "sn4rl0 " + words(9), "the dear grumpf pie " + words(9), "9" * 50_000]
    rows += [(9000 + i, t) for i, t in enumerate(extra)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, score string")
    found = {r["doc_id"]: r for r in toxicity.toxicity(docs, labelled(spark, [*labels, (1, 0, None), labels[0]])).collect()}
    assert len(found) == len(rows)
    test = [i for i in range(1500) if held_out(i, 5) == 0]
    assert all(found[i]["held_out"] == (held_out(i, 5) == 0) for i in found)
    assert np.mean([found[i]["predicted"] == int(i % 5 == 0) for i in test]) > 0.97
    assert [found[9000 + i]["predicted"] for i in range(7)] == [0, 0, 1, 1, 1, 0, 0]
    kept = toxicity.drop_toxic(docs, labelled(spark, labels))
    assert kept.columns == docs.columns and kept.filter("doc_id in (9002, 9003, 9004)").count() == 0


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (1, None), (None, "b")], "doc_id long, text string")
    none = toxicity.toxicity(docs, labelled(spark, [])).collect()
    assert [(r["score"], r["predicted"]) for r in none] == [(0.0, 0)] * 3
    assert toxicity.toxicity(docs.limit(0), labelled(spark, [])).count() == 0


def test_language_held_out_accuracy_and_rejection(spark):
    syllables = {"xx": ["ka", "to", "mi", "ru"], "yy": ["strä", "gen", "ung", "ver"], "zz": ["eau", "ille", "ç", "ou"]}
    rng = random.Random(2)

    def text(lang):
        return " ".join("".join(rng.choices(syllables[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(3, 60)))

    rows = [(i, text(lang), lang) for i, lang in enumerate(rng.choices(sorted(syllables), k=600))]
    rows += [(9000, None, "xx"), (9001, "", None), (9002, "12 34 !?", "yy"), (9003, text("zz").upper(), None)]
    rows += [(9004, "qwx " * 200, None), (9005, text("yy") * 500, None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows + rows[:1]], "doc_id long, text string, lang string, nats string")
    result = language.identify(docs).collect()
    found = {r["doc_id"]: r for r in result}
    assert len(result) == len(rows) + 1 and all(0 <= r["score"] <= 1 for r in result)
    assert all(r["held_out"] == (held_out(r["doc_id"], 3) == 1) for r in result)
    test = [(i, lang) for i, _, lang in rows[:600] if held_out(i, 3) == 1]
    assert np.mean([found[i]["lang_pred"] == lang for i, lang in test]) > 0.98
    assert [found[9000 + i]["lang_pred"] for i in range(4)] == ["und", "und", "und", "zz"]
    assert found[9004]["lang_pred"] in syllables and not found[9004]["accepted"]
    assert found[9005]["lang_pred"] == "yy"
    none = language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred").distinct()
    assert [r[0] for r in none.collect()] == ["und"]
    assert language.identify(docs.limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(3)
    clean = [" ".join(rng.choices([f"w{i}" for i in range(400)], k=120)) for _ in range(60)]
    toxic = [f"{t} snarlo" for t in clean[:12]]
    docs = documents(spark, clean + [clean[3], clean[4] + " ", None, None] + toxic)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, 0) for i in range(60)] + [(64 + i, 0, 1) for i in range(12)]
    labelled(spark, labels).write.parquet(str(tmp_path / "labels.parquet"))
    now, seen = docs, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert now.columns == docs.columns
        now.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        seen[name] = sorted(r["doc_id"] for r in now.select("doc_id").collect())
    assert seen["toxicity"] == list(range(64))
    assert seen["exact_dedup"] == [i for i in range(63) if i not in (4, 60)] or len(seen["exact_dedup"]) == 61
    assert seen["near_dedup"] == seen["exact_dedup"]
    assert set(seen["packing"]) == set(seen["mixing"])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(seen["packing"])
