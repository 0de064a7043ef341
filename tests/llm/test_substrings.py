"""Repeated substrings against brute force over all windows."""

import hashlib
import random
from collections import Counter

import numpy as np

from shelfmill.llm import substrings


def plain(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = [False] * len(r)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        left = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), sum(gone), spans, hashlib.sha256(left).hexdigest(), left))
    return out


def test_removal_matches_brute_force(spark):
    rng = random.Random(11)
    passages = ["".join(rng.choices("abcé \n", k=rng.randrange(20, 90))) for _ in range(8)]
    texts = [None, "", "short", "a" * 300, "a" * 40, "ab" * 60, "x" * 31 + "y" * 32, "é" * 33]
    for _ in range(60):
        parts = rng.choices(passages, k=rng.randrange(1, 5)) + ["".join(rng.choices("defg ", k=rng.randrange(50)))]
        rng.shuffle(parts)
        texts.append("".join(parts))
    texts += [texts[-1], texts[-2], texts[-3][1:], texts[-4][:-1]]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(5, texts[20], 2), (None, texts[21], 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, block long").repartition(3)
    spec = substrings.Repeats(length=32, gram=11, block=500, least_buckets=5)
    got = substrings.remove_repeats(df, spec).collect()
    expected = Counter((r[0], *x) for r, x in zip(rows, plain([r[1] for r in rows], 32), strict=True))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got) == expected


def test_empty_table(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_levels_find_all_repeated_keys():
    rng = np.random.default_rng(2)
    arrived, valued, at = [], [], 0
    levels, other = substrings.SuffixLevels(20000), substrings.SuffixLevels(20000)
    while at < 9000:
        keys = rng.permutation(np.unique(rng.integers(0, 4000, rng.integers(0, 200)).astype(np.uint64)))
        values = rng.integers(0, 9, len(keys)).astype(np.uint64) // 6
        levels.add(keys, at)
        other.add(keys, at, values)
        arrived += keys.tolist()
        valued += list(zip(keys.tolist(), values.tolist(), strict=True))
        at += len(keys)
    count = Counter(arrived)
    assert levels.marked[:at].tolist() == [count[k] > 1 for k in arrived]
    assert levels.first[:at].sum() == len(count)
    seen = {}
    for k, v in valued:
        seen.setdefault(k, set()).add(v)
    assert other.marked[:at].tolist() == [len(seen[k]) > 1 or 0 in seen[k] for k in arrived]
    sizes = [len(level[0]) for level in levels._levels]
    assert all(a > 2 * b for a, b in zip(sizes, sizes[1:], strict=False))


def test_keys_are_dealt_over_many_buckets_by_keys_alone():
    """Of 10**12 buckets only those present take room, and answers come back to their keys."""
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 5000).astype(np.uint64))
    dealt = substrings._Dealt(keys, 10**12, 7)
    rows = dealt.rows(4, keys + np.uint64(1))
    assert len(rows) <= len(keys) and sum(len(r["keys"]) for r in rows) == 8 * len(keys)
    odd = {r["bucket"]: [np.packbits(np.frombuffer(r["keys"], np.uint64) % np.uint64(2) == k).tobytes() for k in (1, 0)] for r in rows}
    marked, first = dealt.answers(odd)
    assert (marked == (keys % np.uint64(2) == 1)).all() and (first == ~marked).all()
    assert substrings._Dealt(keys[:0], 64).rows(1) == []
