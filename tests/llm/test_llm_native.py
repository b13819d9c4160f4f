"""Exact dedup, mixing and personal data: SQL, brute force, and edge cases."""

import hashlib
import os
import re

import pytest
from pyspark.sql import functions as F

import oracle
from siltbed.llm import exact_dedup, mixing, pii, queries

SF_DIR = os.environ.get("SILTBED_TEST_DATA", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, kept string"
WHITE = re.compile(r"[\x20\x09-\x0D]")


def documents(spark, rows):
    """Rows of id, text and source; a column clashes with a result's name."""
    return spark.createDataFrame([(i, t, "en", s, "x") for i, t, s in rows], DOCS)


ODD = [
    (1, "a b", "s"),
    (2, "ab", "s"),
    (2, "ab", "s"),
    (None, "a  b", None),
    (None, "a   b", None),
    (3, None, ""),
    (4, "", "s"),
    (5, " \t\n\x0b\x0c\r", "s"),
    (6, " ", "s"),
    (7, "é😀" * 5000, "long"),
    (8, "é😀 " * 5000, "long"),
]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    result = queries.QUERIES[name](spark, SF_DIR)
    ours, theirs = oracle.compare(result, oracle.connect(SF_DIR), queries.ORACLES[name])
    assert ours == theirs


@pytest.mark.parametrize("rows", [ODD, ODD * 40, []])
def test_exact_dedup_of_odd_rows(spark, rows):
    result = exact_dedup.exact_dedup(documents(spark, rows)).collect()
    assert len(result) == len(rows)
    groups = {}
    for doc_id, text, _ in rows:
        groups.setdefault(WHITE.sub("", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0))
    expected = {
        hashlib.sha256(k.encode()).hexdigest(): (len(v), None if min(v)[1] else min(v)[2]) for k, v in groups.items()
    }
    assert {r["text_sha256"]: (r["group_size"], r["keep_id"]) for r in result} == expected
    kept = [r["text_sha256"] for r in result if r["kept"]]
    assert sorted(kept) == sorted(expected)
    assert all(r["doc_id"] == r["keep_id"] for r in result if r["kept"])


def test_stage_keeps_one_of_each_and_all_columns(spark):
    docs = documents(spark, ODD * 3)
    kept = exact_dedup.drop_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == 3
    assert kept.filter("kept = 'x'").count() == 3


def test_a_full_filter_loses_no_rows(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "filter_words", lambda rows: 1)
    rows = [(i, f"t{i % 300}", "s") for i in range(600)]
    result = exact_dedup.exact_dedup(documents(spark, rows))
    assert result.filter("kept").count() == 300 and result.filter("group_size = 2").count() == 600


def water(sizes, weights, epochs=3):
    targets, total = {}, sum(sizes)
    free = set(range(len(sizes)))
    while True:
        room = total - sum(targets.values())
        share = sum(weights[i] for i in free)
        above = {i for i in free if room * weights[i] / share >= epochs * sizes[i]}
        if not above:
            return [targets.get(i, room * weights[i] / share if share else 0) for i in range(len(sizes))]
        targets |= {i: epochs * sizes[i] for i in above}
        free -= above
        if not free:
            return [targets[i] for i in range(len(sizes))]


def test_mixing_meets_capped_targets(spark):
    rows = [(i, "w " * (1 + i % 7), "big") for i in range(2000)]
    rows += [(3000 + 10 * k + i, "w w\tw", s) for k, s in enumerate(["a", "b", "", None, "z"]) for i in range(k + 1)]
    rows += [(4000, None, "none"), (4001, " ", "none")]
    source = {i: s for i, _, s in rows}
    result = mixing.mix_sizes(documents(spark, rows)).collect()
    assert len(result) == len(rows)
    again = mixing.mix_sizes(documents(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, result))
    size, taken, target, most = {}, {}, {}, {}
    for r in result:
        s = source[r["doc_id"]]
        assert r["taken"] <= 3 * r["size"]
        size[s] = size.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        most[s] = max(most.get(s, 0), r["size"])
        target[s] = r["target"]
    assert all(r["source_size"] == size[source[r["doc_id"]]] for r in result)
    names = sorted(size, key=lambda s: (s is None, s or ""))
    expected = water([size[n] for n in names], [1 + i % 3 for i in range(len(names))])
    for name, value in zip(names, expected):
        assert target[name] == pytest.approx(value)
        assert abs(taken[name] - value) <= most[name] / 2


def test_mixing_of_odd_rows(spark):
    result = mixing.mix_sizes(documents(spark, ODD)).collect()
    assert len(result) == len(ODD) and all(0 <= r["taken"] <= 3 * r["size"] for r in result)
    assert mixing.mix(documents(spark, ODD)).filter("kept = 'x'").count() > 0


def test_mixing_stage_repeats_whole_documents(spark):
    rows = [(i, "w w w", "big") for i in range(300)] + [(1000 + i, "w w w", "small") for i in range(20)]
    docs = documents(spark, rows)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix_sizes(docs).collect()}
    assert counts == {k: n for k, n in taken.items() if n}
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mix_sizes(docs.limit(0)).count() == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in match.split(".")),
        "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 8 <= len(digits) <= 15,
    }[kind]()


def base_spans(text):
    return {k: [m.span() for m in re.finditer(p, text) if passes(k, m[0])] for k, p in BASE.items()}


TEXTS = [
    None,
    "",
    "a@b.c_d@e.f a@b@c.d .@-.- x@y xé@z.w 😀 me@site.org😀",
    "1.2.3.4.5.6.7.8 256.1.1.1 000255.0.0.001 1.2.3 é9.9.9.9",
    "4111 1111 1111 1111 4111-1111-1111-1111, 41111111111111112222 4111  1111",
    "+1 (415) 555-2671. +12 +1 555 5 +49..30--1234567 ++1 222 333 44 + 1 222 333 4455",
    "+4111 1111 1111 1111 mail bob@x.io card 4111111111111111 ip 10.0.0.1",
    "1" * 60_000 + " " + "a" * 60_000 + "@ " + "9 " * 30_000,
    "call (415) 555-2671 or bob at home",
]


def test_base_spans_equal_the_patterns(spark):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] * 2
    result = pii.find(documents(spark, rows)).collect()
    assert len(result) == len(rows)
    for r in result:
        spans = base_spans(TEXTS[r["doc_id"]] or "")
        assert [r[f"n_{k}"] for k in BASE] == [len(spans[k]) for k in BASE]
        listed = [f"{k}:{a}:{b}" for k in BASE for a, b in spans[k]]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r["spans"].split(","))


def test_empty_table_has_no_spans(spark):
    assert pii.find(documents(spark, [])).count() == 0


def test_boosted_proposals_add_what_looks_alike(spark):
    rows = [(i, f"please call tel +1 (415) 555-{1000 + i} today", "s") for i in range(200)]
    rows += [(1000 + i, f"please call tel 1 (415) 555-{1000 + i} today", "s") for i in range(3)]
    rows += [(2000 + i, f"chapter {i} 12-34-5678 is long", "s") for i in range(200)]
    found = {r["doc_id"]: r["spans"] for r in pii.find(documents(spark, rows)).collect()}
    assert all(found[i].startswith("phone:16:33") for i in range(200))
    assert any(found[1000 + i].startswith("phone:") for i in range(3))
    assert not any(found[2000 + i] for i in range(200))


def test_redaction_covers_spans(spark):
    docs = documents(spark, [(1, "hi bob@x.io and 10.0.0.1!", "s"), (2, None, "s")])
    assert {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()} == {1: "hi ******** and ********!", 2: None}
