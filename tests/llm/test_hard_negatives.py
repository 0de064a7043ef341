"""Hard negatives against brute force over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmill.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, anchor string"


def plain(rows, is_anchor, spec=hn.HardNegatives()):
    good = []
    for i, vector, label, _ in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        good.append((i, [max(-(1 << 23), min(1 << 23, math.floor(spec.scale * float(np.float32(x))))) for x in vector], label))
    out = []
    anchors = {(i, tuple(v), label) for i, v, label in good if is_anchor(i)}
    for i, v, label in anchors:
        score = [(-sum(a * b for a, b in zip(v, w)), j, own) for j, w, own in good]
        positives = sorted((s, j) for s, j, own in score if own == label and j != i)[: spec.positives]
        for s, p in positives:
            inside = sorted((t, j) for t, j, own in score if own != label and spec.low_percent * -s <= 100 * -t <= spec.high_percent * -s)
            out += [(i, p, rank + 1, j, -s, -t) for rank, (t, j) in enumerate(inside[: spec.negatives])]
    return sorted(out)


def mined(spark, rows, spec=hn.HardNegatives(), modulus=10):
    found = hn.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % modulus == 0, spec)
    return sorted(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("spec", [hn.HardNegatives(), hn.HardNegatives(block_rows=37, first_dimensions=1, wave_bytes=900, negatives=3)])
def test_mined_rows_equal_brute_force(spark, spec):
    rng = random.Random(3)
    centres = [[rng.gauss(0, 0.3) for _ in range(24)] for _ in range(4)]
    rows = []
    for i in range(500):
        label = rng.randrange(4)
        rows.append((i, [x + rng.gauss(0, 0.3) for x in centres[label]], label, "x"))
    for i in range(500, 620):  # equal vectors under many ids
        rows.append((i, rows[3][1], i % 5, "x"))
    rows += [(None, rows[0][1], 1, "x"), (700, None, 1, "x"), (710, rows[0][1], None, "x"), (720, [None] * 24, 1, "x"), (730, [float("nan")] * 24, 1, "x"), (740, [float("inf")] * 24, 1, "x"), (750, [], 1, "x"), (760, rows[0][1][:7], 1, "x"), (770, rows[0][1] + [1.0, 2.0], 2, None), rows[10], rows[10], rows[11]]
    assert mined(spark, rows, spec) == plain(rows, lambda i: i % 10 == 0, spec)


def test_extreme_components_and_few_rows(spark):
    big = [(0, [1e30, -3e38, 5.0], 1, "x"), (1, [1e30, -1e30, 7.0], 1, "x"), (2, [9e4, 2e4, 1.0], 2, "x"), (3, [3e4, -1e4, 1.0], 2, "x"), (4, [1.0, 0.0, 0.0], 2, "x")]
    assert mined(spark, big) == plain(big, lambda i: i % 10 == 0)
    assert mined(spark, [(0, [1.0], 1, "x")]) == []
    assert mined(spark, []) == []


def test_bounds_leave_out_components():
    rng = np.random.default_rng(1)
    rows = hn.Vectors(np.arange(4000), np.zeros(4000, np.int64), np.floor(256 * rng.normal(0, 0.2, (4000, 64)) / np.arange(1, 65)))
    block = hn.Columns(rows)
    anchor = rows.matrix[7] * 2
    best = hn.Best(-np.inf, np.inf, 5)
    read = hn.scan(block, anchor, np.arange(4000), [best], hn.HardNegatives())
    scores = rows.matrix @ anchor
    assert best.ids.tolist() == sorted(range(4000), key=lambda i: (-scores[i], i))[:5]
    assert read < 0.5 * 4000 * 64
