"""Whole jobs: what shortcuts of these operators once left out."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from siltbed.llm import components, exact_dedup, packing, pii, repeats, shingles, simhash, toxicity
from siltbed.llm.common import map_batches, written


def words_of(text):
    parts = text.lower().split()
    return {tuple(parts[i : i + 5]) for i in range(len(parts) - 4)}


def similarity(a, b):
    a, b = words_of(a), words_of(b)
    return len(a & b) / len(a | b)


def pairs_from(seed, low, high, n):
    """Pairs of texts with a similarity in [low, high)."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    out = []
    while len(out) < n:
        words = rng.choices(vocabulary, k=600)
        other = list(words)
        for i in rng.sample(range(600), rng.randint(2, 40)):
            other[i] = rng.choice(vocabulary)
        pair = " ".join(words), " ".join(other)
        if low <= similarity(*pair) < high:
            out.append(pair)
    return out


@pytest.mark.parametrize("low, high, linked", [(0.8, 0.82, True), (0.82, 0.9, True), (0.6, 0.8, False)])
def test_near_stage_acts_at_similarity_from_0_8(spark, low, high, linked):
    pairs = pairs_from(int(100 * high), low, high, 60)
    rows = [(2 * i + k, t) for i, pair in enumerate(pairs) for k, t in enumerate(pair)]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in kept) == [i for i, _ in rows if not linked or i % 2 == 0]


@pytest.mark.parametrize("limits", [(9, 1 << 20), (1024, 1000), (1024, 1 << 20)])
def test_similar_groups_equal_brute_force_in_small_chunks(spark, limits):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(500)]
    base, texts = rng.choices(vocabulary, k=200), []
    for _ in range(70):  # a crowd around one text, many pairs just below and above 0.8
        other = list(base)
        for i in rng.sample(range(200), rng.randint(0, 5)):
            other[i] = rng.choice(vocabulary)
        texts.append(" ".join(other))
    rows = [(i, t, i) for i, t in enumerate(texts)]
    found = shingles.similar_groups(spark.createDataFrame(rows, "doc_id long, text string, __hash long"), *limits)
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(texts)):
        for b in range(a):
            if similarity(texts[a], texts[b]) >= 0.8:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    groups = {}
    for r in found.collect():
        groups.setdefault(r["part"], set()).add(r["doc_id"])
    expected = {}
    for i in range(len(texts)):
        expected.setdefault(root(i), set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_crowds_have_few_rows_of_keys_and_lose_no_pair(spark):
    rng = random.Random(6)
    base, texts = [f"w{i}" for i in range(400)], []
    for _ in range(40):  # long texts that share most of their keys, each key by other texts
        other = list(base)
        for i in rng.sample(range(400), 12):
            other[i] = f"x{rng.random()}"
        texts.append(" ".join(other))
    # One text with many keys, each of which it shares with another text only.
    parts = [" ".join(f"p{k}_{i}" for i in range(40)) for k in range(12)]
    texts += [" ".join(parts)] + [f"{part} {' '.join(f'q{k}_{i}' for i in range(400))}" for k, part in enumerate(parts)]
    rows = [(i, t, i) for i, t in enumerate(texts)]
    none = np.array([], np.uint64), np.array([], np.int64)
    own = written(shingles.sketched(spark.createDataFrame(rows, "doc_id long, text string, __hash long"), *none), "own")
    keys = {r["node"]: (r["size"], set(r["keys"])) for r in own.collect()}
    found, groups = shingles.shared_keys(own).collect(), {}
    for r in found:
        groups.setdefault(r["key"], set()).add(r["node"])
    assert len(found) == len({tuple(r) for r in found})
    for a, (size, one) in keys.items():
        for b, (other, two) in keys.items():
            if a != b and one & two and 4 * max(size, other) <= 5 * min(size, other):
                assert any({a, b} <= nodes for nodes in groups.values())
    # No more pairs than key by key, and rows by the text, not by its keys (85 or so for each).
    each = {}
    for node, (_, own_keys) in keys.items():
        for key in own_keys:
            each.setdefault(key, set()).add(node)
    alone = {frozenset(nodes) for nodes in each.values() if len(nodes) > 1}
    assert sum(len(n) ** 2 for n in groups.values()) <= sum(len(n) ** 2 for n in alone)
    assert len(found) <= sum(map(len, alone)) / 4


def test_stage_drops_its_largest_tables(spark, monkeypatch):
    made, write = {}, shingles.written

    def noted(df, name, *rest):
        out = write(df, name, *rest)
        made.setdefault(name, []).append(out.written_path)
        return out

    monkeypatch.setattr(shingles, "written", noted)
    pairs = pairs_from(8, 0.8, 0.9, 5)
    rows = [(i, t, i) for i, t in enumerate(t for pair in pairs for t in pair)]
    found = shingles.similar_groups(spark.createDataFrame(rows, "doc_id long, text string, __hash long"))
    for name in ("sketches", "met", "several", "members", "sets"):
        assert made[name] and not any(os.path.exists(path.removeprefix("file:")) for path in made[name])
    assert found.select("part").distinct().count() == 5


def test_proposals_miss_no_pair_at_0_8():
    pairs = [[shingles.shingle_set(t) for t in pair] for pair in pairs_from(5, 0.8, 0.82, 200)]
    every = np.unique(np.concatenate([s for pair in pairs for s in pair]))
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000, len(every)):  # whichever shingles come last
        common = np.sort(rng.choice(every, n, replace=False))
        ranks = rng.permutation(n)
        for a, b in pairs:
            assert np.intersect1d(shingles.prefix_keys(a, common, ranks), shingles.prefix_keys(b, common, ranks)).size
    for a, b in pairs:
        same = np.frombuffer(shingles.sketch_of(a), np.uint8) == np.frombuffer(shingles.sketch_of(b), np.uint8)
        assert same.sum() >= shingles.LEAST_SAME


def test_pairs_are_looked_at_under_one_key():
    rng = random.Random(3)
    keys = {k: [i for i in range(12) if rng.random() < 0.4] for k in range(-4, 30)}
    own = [np.array([k for k in keys if i in keys[k]], np.int64) for i in range(12)]
    seen = {}
    for k, group in keys.items():
        first = shingles.first_shared([own[i] for i in group], k) if group else []
        for x, i in enumerate(group):
            for y, j in enumerate(group):
                if i < j and first[x, y]:
                    seen.setdefault((i, j), []).append(k)
    assert seen == {(i, j): [min(k)] for i in range(12) for j in range(i + 1, 12) if (k := set(own[i]) & set(own[j]))}


def test_whole_sets_are_compared_exactly():
    rng = np.random.default_rng(5)
    base = np.arange(50)
    sets = [np.unique(np.r_[rng.choice(base, 43, replace=False), rng.integers(50, 60, 3)]) for _ in range(40)]
    part = np.arange(40) // 3
    a, b = shingles.similar_pairs(sets, part)
    linked = lambda i, j: 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))
    assert all(linked(i, j) for i, j in zip(a, b)) and len(a) < 40

    def components(pairs):
        group = part.copy()
        for i, j in pairs:
            group[group == group[j]] = group[i]
        return [sorted(np.flatnonzero(group == g).tolist()) for g in np.unique(group)]

    every = [(i, j) for i in range(40) for j in range(i) if linked(i, j)]
    assert sorted(components(zip(a, b))) == sorted(components(every)) and 1 < len(components(every)) < 14


def test_small_sets_have_keys():
    for n in range(1, 12):
        own = np.arange(10, 10 + n).astype(np.uint64)
        common = own[: n // 2]
        keys = shingles.prefix_keys(own, common, np.arange(len(common)))
        assert len(keys) == n // 5 + 1 and set(keys) <= set(own.astype(int))


def test_templates_in_every_text_are_no_keys(spark):
    """All texts share a template and none is similar: nothing meets. Pairs from 0.8 to 0.9 are all found."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(4000)]
    template = rng.choices(vocabulary, k=120)

    def text(words):
        return " ".join([*template, *words])

    rows = [(i, text(rng.choices(vocabulary, k=180)), i) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __hash long")
    own = shingles.sketched(docs, *shingles.common_shingles(docs)).cache()
    assert shingles.shared_keys(own).count() < 20
    near = []
    for i in range(0, 120, 2):
        words = rows[i][1].split()
        while True:
            other = list(words)
            for k in rng.sample(range(120, 300), rng.randint(4, 9)):
                other[k] = rng.choice(vocabulary)
            if 0.8 <= similarity(rows[i][1], " ".join(other)) < 0.9:
                break
        near.append((400 + i, " ".join(other), 400 + i))
    docs = spark.createDataFrame(rows + near, "doc_id long, text string, __hash long")
    groups = {}
    for r in shingles.similar_groups(docs).collect():
        groups.setdefault(r["part"], []).append(r["doc_id"])
    assert sorted(sorted(g) for g in groups.values() if len(g) > 1) == [[i, 400 + i] for i in range(0, 120, 2)]


def test_near_stage_on_odd_ids_and_names(spark):
    schema = "doc_id long, text string, __hash string, part long, key string, node long, size int"
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text, "x", 1, "k", 2, 3), (None, text, "y", 1, "k", 2, 3), (5, text + " more", "x", 1, "k", 2, 3), (6, None, "x", 1, "k", 2, 3)]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, schema))
    assert kept.columns == ["doc_id", "text", "__hash", "part", "key", "node", "size"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [5, 6]
    assert simhash.drop_near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_shortcut_of_words_before_signs_equals_the_library():
    library = packing.library(packing.MODEL)
    letters = ["হয়", "हक़", "אשׁ", "kitabİ", "é", "été", "abc", "ß"]
    for text in [w + sign for w in letters for sign in ".,;:!?"]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packing.Ids(packing.MODEL).of_text(text), "<u4").tolist() == ids, ascii(text)


def test_large_groups_of_repeats_are_not_collected(spark, monkeypatch):
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choices("abcdefg", k=n))
    shared = noise(300)
    texts = [noise(80) + shared + noise(80) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    plain = sorted((r["doc_id"], r["kept_sha256"], r["n_spans"]) for r in repeats.remove_repeats(docs).collect())
    seen, large = [], repeats.repeats_of_large
    monkeypatch.setattr(repeats, "MOST_ROWS", 5)
    monkeypatch.setattr(repeats, "repeats_of_large", lambda rows: large(seen.append(1) or rows))
    found = sorted((r["doc_id"], r["kept_sha256"], r["n_spans"]) for r in repeats.remove_repeats(docs).collect())
    assert seen and found == plain


def test_feature_counts_are_not_aggregated_in_one_task(spark, monkeypatch):
    plans = []

    class Stop(Exception):
        pass

    def record(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        raise Stop

    monkeypatch.setattr(pii, "written", record)
    columns = [f"1 as `{c}`" for c in pii.FEATURES] + ["id as row", "false as overlaps"]
    with pytest.raises(Stop):
        pii.selected(spark.range(10).selectExpr(*columns), None)
    assert "Aggregate" in plans[0] and "Repartition 1, false" not in plans[0]


def test_near_stage_proposes_by_fingerprint_anchors(spark, monkeypatch):
    pairs = pairs_from(11, 0.97, 1, 20)
    rows = [(2 * i + k, t) for i, pair in enumerate(pairs) for k, t in enumerate(pair)] + [(90, None), (91, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []

    def groups(narrow, propose):
        seen.extend((r["a"]["k_id"], r["b"]["k_id"]) for r in propose(narrow).collect())
        return narrow.select("doc_id", "__hash", narrow["doc_id"].alias("part"))

    monkeypatch.setattr(simhash, "similar_groups", groups)
    assert simhash.drop_near_duplicates(docs).count() == 42
    prints = {i: simhash.fingerprint(t) for i, t in rows}
    near = {(i, i + 1) for i in range(0, 40, 2) if (prints[i] ^ prints[i + 1]).bit_count() <= simhash.MAX_BITS}
    assert len(near) >= 10 and {tuple(sorted(p)) for p in seen} == near | {(90, 91)}


def test_texts_tokenised_together_have_the_librarys_ids():
    looked_up = []

    class Counted(packing.Ids):
        def __getitem__(self, part):
            looked_up.append(part)
            return super().__getitem__(part)

    texts = ["the cat, the cat\nthe  CAT!!", None, "", " ", "naïve cat the é", "the<|endoftext|> 12 the"] * 3
    library = packing.library(packing.MODEL)
    known = Counted(packing.MODEL)
    looked_up.clear()
    found = known.of_texts(pa.array(texts, pa.string()))
    expected = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(own, "<u4").tolist() for own in found] == expected
    assert looked_up.count("the") == 1
    assert known.of_texts(pa.array([], pa.string())) == []


def test_few_edges_get_few_files(spark, monkeypatch):
    files = []

    def noted(df, name, *args):
        out = written(df, name, *args)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(components, "written", noted)
    names = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, value in names.items():
            spark.conf.set(n, value)
        edges = spark.range(500).selectExpr("id a", "id + 1 + int(id % 100 = 99) * 1000 b")
        found = components.connected_components(edges).groupBy("component").count().collect()
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)
    assert sorted(r["component"] for r in found) == [0, 100, 200, 300, 400]
    assert len(files) > 4 and set(files[1:]) == {1}


def test_written_tables_grow_with_their_rows(spark):
    df = spark.range(1000).repartition(8)
    assert len(written(df, "grown", 1000, 300).inputFiles()) == 4
    assert len(written(df, "grown", 10**9).inputFiles()) == 8 and written(df, "grown", 0).count() == 1000


def test_python_workers_keep_large_caches_for_one_module_only(spark):
    docs = spark.range(400).selectExpr("id doc_id", "'some words ' || id text").repartition(8)
    assert packing.pieces(docs).count() == 400

    def look(batches):
        for batch in batches:
            held = [packing.remembered.cache_info().currsize, packing.library.cache_info().currsize]
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()) for n in held], ["texts", "libraries"])

    found = map_batches(docs, look, "texts long, libraries long").collect()
    assert len(found) >= 8 and {tuple(r) for r in found} == {(0, 0)}
    look.__module__ = packing.__name__
    assert packing.pieces(docs).count() == 400
    assert {tuple(r) for r in map_batches(docs, look, "texts long, libraries long").collect()} == {(1, 1)}


def test_small_tables_of_the_first_stages_get_few_files(spark, monkeypatch):
    files = {}

    def noted(df, name, *args):
        out = written(df, name, *args)
        files.setdefault(name, len(out.inputFiles()))
        return out

    for module in (components, exact_dedup, shingles, toxicity):
        monkeypatch.setattr(module, "written", noted)
    names = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, value in names.items():
            spark.conf.set(n, value)
        docs = spark.range(60).selectExpr("id doc_id", "array_join(sequence(id % 20, 30 + id % 20), ' ') text")
        labels = docs.selectExpr("doc_id", "int(doc_id % 2) toxic")
        assert toxicity.training_labels(labels).count() > 0
        assert exact_dedup.drop_repeats(docs).count() == 20
        rows = docs.withColumn("__hash", F.xxhash64("doc_id", "text"))
        assert shingles.similar_groups(rows).count() == 60
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)
    assert {files[n] for n in ("labels", "repeats", "groups", "met", "known", "edges")} == {1}
