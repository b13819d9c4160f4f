"""Groups of repeated strings of any size go through the same sort."""

import hashlib
import random

import numpy as np
import pytest

from siltbed.llm import repeats


def noise(rng, n):
    return "".join(rng.choices("abcdefgh", k=n))


def brute(texts):
    seen, out = set(), []
    for i, text in enumerate(texts):
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - 99):
            window = data[at : at + 100]
            if window in seen:
                gone[at : at + 100] = True
            seen.add(window)
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.r_[False, gone].astype(np.int8)) == 1).sum())
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("copies", [2, 7, 60, 5000])
def test_passages_in_groups_of_all_sizes(spark, copies):
    rng = random.Random(copies)
    shared = noise(rng, 170)
    texts = [noise(rng, rng.randint(0, 40)) + shared + noise(rng, rng.randint(0, 40)) for _ in range(copies)]
    texts += [noise(rng, 300) for _ in range(5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = sorted(map(tuple, repeats.remove_repeats(docs, kept=False).collect()))
    assert got == brute(texts)


def strings(rng, n):
    base, out = noise(rng, 300).encode(), []
    for i in range(n):
        least = rng.randint(0, 84)
        most = rng.randint(least, 84)
        own = bytearray(base[100 - most : 200 - least])
        for _ in range(rng.choice([0, 0, 1, 2])):
            own[rng.randrange(len(own))] = 97 + rng.randrange(3)
        out.append((i, 1000, least, most, bytes(own)))
    return out


@pytest.mark.parametrize("n", [2, 3, 6, 7, 40])
@pytest.mark.parametrize("at_once", [1, 100, 1 << 16])
def test_classes_of_sorted_strings_equal_windows(monkeypatch, n, at_once):
    monkeypatch.setattr(repeats, "DISTANCES", at_once)
    sorts = []
    real = repeats.deep_shallow
    monkeypatch.setattr(repeats, "deep_shallow", lambda s: sorts.append(len(s)) or real(s))
    rng = random.Random(n)
    for _ in range(40):
        group, seen, want = strings(rng, n), set(), []
        for doc, place, least, most, data in group:
            for d in range(least, most + 1):
                window = (d, data[most - d : most - d + 100])
                want += [(doc, place - d)] if window in seen else []
                seen.add(window)
        found = repeats.repeats_of(group)
        assert sorted((doc, first + k) for doc, first, count in found for k in range(count)) == sorted(want)
    assert sorts == [n, n] * 40  # every group is sorted, from both sides
