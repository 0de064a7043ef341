"""SimHash fingerprints, vantage-point links and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from shelfmill.llm import simhash
from shelfmill.llm.components import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(points, bits=3):
    parent = {p: p for p in points}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(points):
        for b in points[:i]:
            if (a ^ b).bit_count() <= bits:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {p: root(p) for p in points}


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, shard string, least long")


def test_fingerprints_and_components(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}é" for i in range(300)]
    base = [rng.choices(vocabulary, k=120) for _ in range(6)]
    rows = [(0, None, "x", 1), (1, " \n", "x", 1), (2, "One", "x", 1), (3, "one two", "x", 1), (3, "one two", "x", 1), (None, "lone row here", "x", 1)]
    for i in range(90):
        words = list(base[i % 6])
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((10 + i, " ".join(words), "x", 1))
    got = simhash.near_duplicates(documents(spark, rows), simhash.SimHash(shard=4, leaf=2)).collect()
    assert len(got) == len(rows)
    prints = {r[0]: plain_fingerprint(r[1]) for r in rows if r[0] is not None}
    roots = plain_components(sorted(set(prints.values()) | {plain_fingerprint("lone row here")}))
    least = {}
    for doc, p in prints.items():
        least[roots[p]] = min(doc, least.get(roots[p], doc))
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert r.fingerprint & (1 << 64) - 1 == prints[r.doc_id]
            assert r.component_id == least[roots[prints[r.doc_id]]]
    kept = simhash.keep_one(documents(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(least.values())
    assert sum(r.doc_id is None for r in kept) == 1


@pytest.mark.parametrize("spread", [2, 6, 40])
def test_vantage_links_match_brute_force(spread):
    rng = np.random.default_rng(spread)
    centre = rng.integers(0, 1 << 63, 1, dtype=np.uint64)[0]
    points = {int(centre)}
    for _ in range(600):
        p = int(centre)
        for k in rng.integers(0, 64, rng.integers(1, spread)):
            p ^= 1 << int(k)
        points.add(p)
    points = sorted(points)
    label = simhash.vantage_links(np.array(points, np.uint64), simhash.SimHash(leaf=16))
    expected = plain_components(points)
    assert [points[k] for k in label] == [expected[p] for p in points]


def test_keys_of_shards_cover_all_pairs():
    rng = random.Random(1)
    for depth in (2, 3, 4):
        masks = simhash._masks(depth)
        for _ in range(300):
            flips = rng.sample(range(64), 3)
            assert any(not any(m >> b & 1 for b in flips) for m in masks)


def test_empty_table(spark):
    empty = documents(spark, [])
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0


def test_components_of_a_long_path(spark):
    path = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 1000: 1000, 1001: 1000}
