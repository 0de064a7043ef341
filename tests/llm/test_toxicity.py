"""Toxicity: exact nearest examples, held-out accuracy, folds and odd inputs."""

import zlib

import numpy as np
import pytest

from shelfmill.llm import toxicity
from shelfmill.llm.queries import TOXIC_FOLD, op2_toxicity
from shelfmill.llm.training import labelled_sample

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("common", [0, 1 / 24, 0.1, 1])
def test_index_finds_what_comparing_all_finds(common):
    rng = np.random.default_rng(8)
    vectors = []
    for _ in range(333):
        ids = np.sort(rng.choice(60, rng.integers(1, 9), replace=False))
        w = rng.integers(1, 4, len(ids)).astype(float)
        vectors.append((ids, w / np.sqrt((w * w).sum())))
    index = toxicity.BlockMaxIndex(vectors, 60, 16, common)
    dense = np.zeros((333, 60))
    for k, (ids, w) in enumerate(vectors):
        dense[k, ids] = w
    for ids, w in vectors[:80]:
        query = np.zeros(60)
        query[ids] = w
        cosine = np.round(dense @ query, 9)
        expected = np.lexsort((np.arange(333), -cosine))[:10]
        best, scores = index.nearest(ids, w, 10)
        assert best.tolist() == expected.tolist()
        assert np.allclose(scores, cosine[expected])


    text = np.repeat(np.arange(333), [len(ids) for ids, _ in vectors])
    ids, weights = (np.concatenate([v[k] for v in vectors]) for k in (0, 1))
    of, example, cosine = index.nearest_of_all(text, ids, weights, 334, 400, at_once=50)  # the last text has no terms
    assert np.bincount(of).tolist() == [333] * 334
    for k in range(0, 333, 20):
        expected = np.round(dense @ dense[k], 9)
        order = np.lexsort((np.arange(333), -expected))
        assert example[of == k].tolist() == order.tolist() and np.allclose(cosine[of == k], expected[order])


def test_index_without_examples():
    index = toxicity.BlockMaxIndex([], 5, 4)
    assert [len(part) for part in index.nearest_of_all(np.array([0]), np.array([2]), np.array([1.0]), 1, 3)] == [0, 0, 0]


def test_repeated_ids_give_one_sample(spark):
    """Of several texts of an id the same one is learnt from in any order of rows."""
    rows = [(k, f"t{k} v{j}" if j else None) for k in range(30) for j in range(4)]
    marked = spark.createDataFrame([(k, k % 2) for k in range(30)], "doc_id long, toxic int")
    got = []
    for some in (rows, rows[::-1]):
        documents = spark.createDataFrame(some, "doc_id long, text string").repartition(5)
        got.append(sorted(labelled_sample(documents, marked, "toxic", TOXIC_FOLD, 100).texts.collect()))
    assert got[0] == got[1] and all(r.text for r in got[0]) and len({r.doc_id for r in got[0]}) == len(got[0])


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = op2_toxicity(spark, SF).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.93
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


@pytest.mark.parametrize("labels", [[], [(1, None)], [(0, 1), (None, 0)], [(0, 1), (3, 0), (3, 0)]])
def test_odd_inputs(spark, labels):
    documents = spark.createDataFrame([(0, "a b c", 7), (3, None, 7), (3, "d e", 7), (None, "x", 7), (5, "a b c", 7)], "doc_id long, text string, label int")
    marked = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.rate(documents, marked, "toxic", TOXIC_FOLD).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.rate(documents.limit(0), marked, "toxic", TOXIC_FOLD).count() == 0


def test_copies_of_examples_with_rare_words_find_them(spark):
    """None of these words comes in four examples, so none can tell the classes apart."""
    rows = [(k, f"rare{k} odd{k} word{k} seldom{k // 2}", k % 2) for k in range(40) if not zlib.crc32(str(k).encode()) % 4 == 2]
    copies = [(1000 + k, text) for k, text, _ in rows]
    documents = spark.createDataFrame([r[:2] for r in rows] + copies + [(5000, "nothing known here")], "doc_id long, text string")
    marked = spark.createDataFrame([(k, t) for k, _, t in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.rate(documents, marked, "toxic", TOXIC_FOLD).collect()}
    for k, _, label in rows:
        for r in (got[k], got[1000 + k]):
            first, second = r.evidence[:2]
            assert (first.doc_id, first.toxic) == (k, label) and first.cosine == pytest.approx(1)
            assert second.cosine < 0.9999
    assert 0 < got[5000].evidence[0].cosine < 1
