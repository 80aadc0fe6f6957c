from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from textdata import by_id, docs, prose  # noqa: F401
from pyspark.sql import functions as F

from meterline.llm import simhash
from meterline.llm.components import components
from meterline.llm.simhash import covering_masks, fingerprint, near_links, one_of_each, signed, simhash_neighbours


def roots(values, radius):
    """Smallest member of each value's component, by brute force."""
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in combinations(sorted(set(values)), 2):
        if (a ^ b).bit_count() <= radius and find(a) != find(b):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


@pytest.mark.parametrize("fixed", [0, covering_masks(3)[4], covering_masks(3, covering_masks(3)[4])[7]])
def test_masks_cover_every_pair_within_the_radius(fixed):
    masks = covering_masks(3, fixed)
    free = [i for i in range(64) if not fixed >> i & 1]
    assert all(mask & fixed == fixed for mask in masks)
    for places in combinations(free, min(3, len(free))):
        difference = sum(1 << i for i in places)
        assert any(mask & difference == 0 for mask in masks)


@pytest.mark.parametrize("bucket", [1024, 12])
def test_links_of_a_dense_ball_lose_no_component(spark, bucket):
    rng = random.Random(8)
    centre = rng.getrandbits(64)
    values = {centre ^ sum(1 << i for i in rng.sample(range(64), rng.randrange(6))) for _ in range(60)}
    values |= {rng.getrandbits(64) for _ in range(40)}
    frame = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    links = near_links(frame, 3, bucket)
    assert all(((row["a"] ^ row["b"]) % (1 << 64)).bit_count() <= 3 for row in links.collect())
    placed = {row["node"] % (1 << 64): row["root"] % (1 << 64) for row in components(links).collect()}
    want: dict[int, int] = roots(sorted(values), 3)
    groups: dict[int, set[int]] = {}
    for v in values:
        groups.setdefault(placed.get(v, v), set()).add(want[v])
    assert all(len(found) == 1 for found in groups.values())
    assert len(groups) == len(set(want.values()))


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 4000), (4000, 4000)]
    found = {row["node"]: row["root"] for row in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)} | {5000: 4000}


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_by_definition(monkeypatch):
    rng = random.Random(9)
    texts = ["", " \n", "One", "One two", "a b c", "É É É", "a b c d", "w " * 50, *(prose(rng, n) for n in (3, 40, 700))]
    whole = [fingerprint(text, 3) for text in texts]
    assert whole == [slow_fingerprint(text) for text in texts]
    monkeypatch.setattr(simhash, "PIECE_BYTES", 7)
    assert [fingerprint(text, 3) for text in texts] == whole


def test_rows_equal_brute_force(docs):
    rng = random.Random(10)
    base = [prose(rng, 400) for _ in range(8)]
    texts = [None, "", "x", "X", *base]
    for text in base:
        words = text.split()
        for _ in range(8):
            changed = list(words)
            changed[rng.randrange(400)] = "new"
            texts.append(" ".join(changed))
    prints = [slow_fingerprint(text or "") for text in texts]
    want = roots(prints, 3)
    least = {}
    for i, v in enumerate(prints):
        least[want[v]] = min(least.get(want[v], i), i)
    found = by_id(simhash_neighbours(docs(*enumerate(texts))))
    for i, v in enumerate(prints):
        assert (found[i]["fingerprint"], found[i]["component_id"]) == (f"{v:016x}", least[want[v]])
    kept = {row["doc_id"] for row in one_of_each(docs(*enumerate(texts))).collect()}
    assert kept == set(least.values())


def test_null_ids_repeated_rows_and_other_columns(docs):
    frame = docs((None, "a b c d"), (None, "a b c d"), (3, "q r s t"), (3, "q r s t"), (None, "q r s t"))
    frame = frame.withColumns({"fp": F.lit(1), "root": F.lit(2), "n": F.lit(3)})
    rows = simhash_neighbours(frame).collect()
    assert sorted(str(row["component_id"]) for row in rows) == ["3", "3", "3", "None", "None"]
    assert sorted((str(row["doc_id"]), row["text"]) for row in one_of_each(frame).collect()) == [("3", "q r s t"), ("None", "a b c d")]
    assert simhash_neighbours(docs()).collect() == [] and one_of_each(docs()).collect() == []


def test_a_forest_spans_without_all_pairs(spark):
    near = [signed((1 << i) | (1 << j)) for i, j in combinations(range(10), 2)]
    links = near_links(spark.createDataFrame([(v,) for v in near], "fp long"), 3).count()
    assert links <= len(covering_masks(3)) * len(near)
    assert np.bitwise_count(np.uint64(7)) == 3
