"""Quality classifier: held-out accuracy, folds and odd inputs."""

import zlib

import pytest
from pyspark.sql import functions as F

from shelfmill.llm import subword_classifier
from shelfmill.llm.queries import QUALITY_FOLD, op10_quality_classifier

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = op10_quality_classifier(spark, SF).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.93
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_held_out_labels_change_nothing(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("label", F.lit(1))
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.withColumn("quality", F.when(QUALITY_FOLD.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    spec = subword_classifier.SubwordModel(epochs=2, bucket_bits=12)
    scores = [sorted((r.doc_id, r.score) for r in subword_classifier.classify(documents, x, "quality", QUALITY_FOLD, spec=spec).collect()) for x in (labels, turned)]
    assert scores[0] == scores[1]


@pytest.mark.parametrize("labels", [[], [(1, None)], [(2, 1), (None, 0)], [(0, 1), (2, 0), (2, 0)]])
def test_odd_inputs(spark, labels):
    documents = spark.createDataFrame([(0, "a b c"), (2, None), (2, ""), (None, "x"), (5, "a b c")], "doc_id long, text string")
    marked = spark.createDataFrame(labels, "doc_id long, quality int")
    got = subword_classifier.classify(documents, marked, "quality", QUALITY_FOLD).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert subword_classifier.classify(documents.limit(0), marked, "quality", QUALITY_FOLD).count() == 0
