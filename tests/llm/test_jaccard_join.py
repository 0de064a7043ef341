"""Similar word sets against brute force over all pairs."""

import random

import numpy as np
import pytest

from shelfmill.llm import jaccard_join as jj

WHITE = " \t\n\x0b\x0c\r"


def plain_set(text, n=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in WHITE:
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def plain(rows, percent=85):
    sets = [plain_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        known = [x for x in (doc, least.get(root(i))) if x is not None]
        least[root(i)] = min(known, default=None)
    return sorted(((doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(rows)), key=str)


def similar(spark, rows, spec=jj.JaccardJoin()):
    documents = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, n string, key long")
    return sorted((tuple(r) for r in jj.similar_texts(documents, spec).collect()), key=str)


def corpus(seed, sizes, copies):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(400)]
    passage = rng.choices(vocabulary, k=30)
    rows = [(0, None), (1, " \n\t"), (2, "One"), (2, "one"), (3, "one two"), (None, "a row without an id"), (None, "a row without an id"), (4, "A ROW without an id")]
    for size in sizes:
        base = rng.choices(vocabulary, k=size)
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(1 + size // 60 + rng.randrange(2))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words = words[: len(words) - rng.randrange(1 + size // 8)]
            if rng.random() < 0.2:
                words += passage
            rows.append((10 + len(rows), (" " if rng.random() < 0.5 else "\n").join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("spec", [jj.JaccardJoin(), jj.JaccardJoin(buckets=64, largest_light=1), jj.JaccardJoin(buckets=64, check_cost=50.0)])
def test_components_equal_brute_force(spark, spec):
    rows = corpus(4, [5, 6, 9, 12, 20, 30, 47, 80, 150, 400], 14)
    assert similar(spark, rows, spec) == plain(rows)


def test_empty_tables(spark):
    assert similar(spark, []) == []
    assert similar(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]


def test_long_texts(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(50000)}" for _ in range(250_000)]
    edited = list(words)
    for _ in range(2000):
        edited[rng.randrange(len(words))] = "edited"
    rows = [(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(words[:200_000])), (4, " ".join(words[:125_000]))]
    assert similar(spark, rows) == plain(rows)


def test_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(0)
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 700))) for _ in range(2))
        assert jj.parity_distance(jj._parity(a), jj._parity(b)) <= len(np.setxor1d(a, b))


def test_fronts_of_similar_sets_meet():
    """Any two sets that link have a list in common on which places leave room for the link."""
    rng = np.random.default_rng(3)
    spec = jj.JaccardJoin()
    for light in (0, 12, 40, 1000):
        order = jj.Order(rng.integers(0, 5, 256), light)
        for _ in range(150):
            pool = rng.integers(0, 1 << 63, 120, dtype=np.uint64)
            a = np.unique(rng.choice(pool, rng.integers(2, 90), replace=False))
            b = np.unique(np.concatenate([rng.permutation(a)[: len(a) - rng.integers(0, 1 + len(a) // 8)], rng.integers(0, 1 << 63, rng.integers(0, 1 + len(a) // 10), dtype=np.uint64)]))
            shared = len(np.intersect1d(a, b))
            if 100 * shared < 85 * (len(a) + len(b) - shared):
                continue
            lists = [dict(zip(*(x.tolist() for x in jj._lists(s, order, spec)), strict=True)) for s in (a, b)]
            need = spec.needed(len(a) + len(b))
            assert len(a) == len(b) == 1 or any(min(lists[0][k], lists[1][k]) >= need for k in lists[0].keys() & lists[1].keys())


def test_boundary_follows_the_cost():
    spec = jj.JaccardJoin()
    sizes = np.full(spec.largest_light + 1, 100)
    short, long = np.ones(1024, np.int64), np.ones(1024, np.int64)
    long[:4] = 5000
    assert jj.boundary(sizes, short, spec) < jj.boundary(sizes, long, spec)


def test_members_of_lists_with_one_class_do_not_travel(spark):
    """Of the members, those of shared lists all pass the bitmap, and few others."""
    rows = [(i, text) for i, text in corpus(7, [20, 47, 80, 150], 10)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    spec = jj.JaccardJoin()
    prints = jj._prints(documents, jj._order(documents.select("text"), spec), spec).cache()
    members = [tuple(r) for r in jj._members(prints).collect()]
    classes = {}
    for name, key, _, _ in members:
        classes.setdefault(name, set()).add(key)
    shared = {name for name, keys in classes.items() if len(keys) > 1}
    ends = spark.createDataFrame([(name,) for name in shared], "key long")
    passed = [tuple(r) for r in jj._members(prints, jj._bitmap(ends, len(shared))).collect()]
    wanted = [m for m in members if m[0] in shared]
    assert wanted and not set(wanted) - set(passed)
    assert len(passed) - len(wanted) < 0.2 * (len(members) - len(wanted))


def test_cut_lists_hold_each_link_once():
    """Any two members of a list whose sizes and places allow a link meet in one part of it, the smaller one at home."""
    rng = np.random.default_rng(5)
    spec = jj.JaccardJoin()
    n = np.concatenate([rng.integers(2, 400, 300), [85, 100, 170, 200, 17, 20, 34, 40]])
    rest = np.maximum(1, n - rng.integers(0, 1 + n // 8))
    row, cut, guest, least = jj._by_size(np.full(len(n), 77, np.int64), n, rest, spec)
    parts = [{} for _ in n]
    for r, c, g, s in zip(row.tolist(), cut.tolist(), guest.tolist(), least.tolist(), strict=True):
        parts[r][c] = g, s
    met = 0
    for x in range(len(n)):
        for y in range(len(n)):
            if x == y or n[x] < n[y] or 100 * n[y] < 85 * n[x] or min(rest[x], rest[y]) < spec.needed(n[x] + n[y]):
                continue
            shared = [c for c in parts[x].keys() & parts[y].keys() if not (parts[x][c][0] and parts[y][c][0])]
            met += 1
            assert len(shared) == 1 and parts[y][shared[0]] == (False, True)
    assert met > 1000


def test_counts_between_tasks_are_packed():
    for counts in ([0, 3, 255], [0, 256, 1], [70000, 0, 0], [1 << 40, 5, 0]):
        packed = jj._packed(np.array(counts, np.int64))
        assert jj._unpacked(packed, 3).tolist() == counts
    assert len(jj._packed(np.array([0, 3, 255]))) == 3


def test_many_near_copies_are_not_compared_pair_by_pair(spark, monkeypatch):
    """Copies that link with some others only are joined by centres before pairs are made."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(200):
        words = list(base)
        for at in rng.sample(range(120), 3):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    left, remaining = [], jj._remaining

    def counted(*args):
        pairs = remaining(*args)
        left.append(pairs.count())
        return pairs

    monkeypatch.setattr(jj, "_remaining", counted)
    assert similar(spark, rows) == plain(rows)
    assert left and left[0] <= 4 * len(rows)
