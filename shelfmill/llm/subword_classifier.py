"""Quality classifier: supervised embeddings of hashed words and byte n-grams.

A text's features are its words, how long ago each came before, and byte
n-grams, hashed into a fixed number of buckets. Each bucket has a learned vector; a text is the mean of the vectors
of all its features, and a softmax layer turns it into class probabilities.
Vectors and layer are trained together by stochastic gradient descent in numpy
on a bounded sample of labelled texts, the same number of each class; the bias
is then moved to the classes' true shares. The model's size is fixed by its
parameters. To score, the layer is applied to the vectors once, after which a
text costs one addition a feature.

Defined cases: a null or empty text has no features and gets the share of
class 1. Without labelled texts of both classes every text gets that share, or
0.5 without any label. Repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmill.llm import bytescan as bs
from shelfmill.llm.training import Fold, Sample, labelled_sample


@dataclass(frozen=True)
class SubwordModel:
    per_class: int = 1500  # labelled texts of each class that the model is fit on
    grams: tuple[int, ...] = (3, 5)
    bucket_bits: int = 16
    size: int = 8
    epochs: int = 8
    rate: float = 2.0
    seed: int = 1


def features(data: np.ndarray, offsets: np.ndarray, spec: SubwordModel) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of a block of texts and the text of each."""
    hashes = bs.byte_hash(data)
    shift = np.uint64(64 - spec.bucket_bits)
    starts, ends = bs.spaced_words(data, offsets)
    words, own = hashes(starts, ends), np.searchsorted(offsets, starts, "right") - 1
    buckets, texts = [words >> shift], [own]
    # How many words ago a word came before in its text, as a power of two, is a feature too.
    order = np.lexsort((words, own))
    again = np.flatnonzero((words[order[1:]] == words[order[:-1]]) & (own[order[1:]] == own[order[:-1]]))
    ago = np.log2(order[again + 1] - order[again]).astype(np.uint64)
    buckets.append(bs.mix(ago + np.uint64(1)) >> shift)
    texts.append(own[order[again]])
    stop = np.repeat(offsets[1:], np.diff(offsets))
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for n in spec.grams:
        rolled = hashes.rolling(n)
        inside = np.arange(len(rolled)) + n <= stop[: len(rolled)]
        buckets.append(rolled[inside] >> shift)
        texts.append(owner[: len(rolled)][inside])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(texts)


def _bags(sample: DataFrame, spec: SubwordModel) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(label, buckets, shares) of each sampled text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(0).to_pylist()
            rows = []
            for first, last, data, offsets in bs.blocks(batch.column(1)):
                buckets, texts = features(data, offsets, spec)
                keys, counts = np.unique((texts << spec.bucket_bits) | buckets, return_counts=True)
                cuts = np.searchsorted(keys >> spec.bucket_bits, np.arange(last - first + 1))
                for label, a, b in zip(labels[first:last], cuts, cuts[1:], strict=False):
                    own = (keys[a:b] & ((1 << spec.bucket_bits) - 1)).astype(np.uint32)
                    rows.append({"label": label, "buckets": own.tobytes(), "counts": counts[a:b].astype(np.float32).tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("label", pa.int32()), ("buckets", pa.binary()), ("counts", pa.binary())]))

    # Bounded: per_class rows of each class, each with at most one entry a bucket.
    made = sample.orderBy("doc_id").select("label", "text").mapInArrow(count, "label int, buckets binary, counts binary")
    out = []
    for row in made.toLocalIterator():
        counts = np.frombuffer(row.counts, np.float32)
        if len(counts):
            out.append((row.label, np.frombuffer(row.buckets, np.uint32).astype(np.int64), counts / counts.sum()))
    return out


def train(bags: list[tuple[int, np.ndarray, np.ndarray]], spec: SubwordModel) -> tuple[np.ndarray, float]:
    """Weight of each bucket for class 1 against class 0, and the bias."""
    rng = np.random.default_rng(spec.seed)
    vectors = rng.uniform(-1, 1, (1 << spec.bucket_bits, spec.size)).astype(np.float32) / spec.size
    layer, bias = np.zeros((2, spec.size), np.float32), np.zeros(2, np.float32)
    steps, step = max(1, spec.epochs * len(bags)), 0
    for _ in range(spec.epochs):
        for k in rng.permutation(len(bags)):
            label, buckets, shares = bags[k]
            rate = np.float32(spec.rate * (1 - step / steps))
            step += 1
            own = vectors[buckets]
            hidden = shares @ own
            scores = layer @ hidden + bias
            p = np.exp(scores - scores.max())
            p /= p.sum()
            p[label] -= 1
            back = p @ layer
            layer -= rate * np.outer(p, hidden)
            bias -= rate * p * np.float32(0.1)
            # As usual for averaged inputs, the gradient is shared by the features; the square root keeps rare ones alive.
            vectors[buckets] = own - rate * np.sqrt(shares)[:, None] * back
    return vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0])


def fit(sample: Sample, spec: SubwordModel = SubwordModel()) -> tuple[np.ndarray, float]:
    """Bucket weights and bias, moved from equal classes to the labelled rows' shares."""
    bags = _bags(sample.texts, spec)
    used = [sum(label == k for label, _, _ in bags) for k in (0, 1)]
    share = np.log((sample.totals[1] + 0.5) / (sample.totals[0] + 0.5))
    if not all(used):
        return np.zeros(1 << spec.bucket_bits, np.float32), float(share)
    weights, bias = train(bags, spec)
    return weights, float(bias + share - np.log(used[1] / used[0]))


def score(text: Column | str, documents: DataFrame, model: tuple[np.ndarray, float], empty: float, spec: SubwordModel = SubwordModel()) -> Column:
    """Probability of class 1; ``empty`` for texts without features."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        weights, bias = shared.value
        out = [np.zeros(0)]
        for first, last, data, offsets in bs.blocks(texts):
            buckets, owner = features(data, offsets, spec)
            n = np.bincount(owner, minlength=last - first)
            total = np.bincount(owner, weights=weights[buckets], minlength=last - first)
            p = 1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + bias, -30, 30)))
            out.append(np.where(n > 0, p, empty))
        return pa.array(np.concatenate(out))

    return probability(text)


def classify(documents: DataFrame, labels: DataFrame, label: str, fold: Fold, threshold: float = 0.5, spec: SubwordModel = SubwordModel()) -> DataFrame:
    """``doc_id, held_out, score, predicted``, a row per row of ``documents``."""
    sample = labelled_sample(documents, labels, label, fold, spec.per_class)
    total = sum(sample.totals.values())
    empty = (sample.totals[1] + 0.5) / (total + 1)
    p = score("text", documents, fit(sample, spec), empty, spec)
    scored = documents.select("doc_id", fold.held_out("doc_id").alias("held_out"), p.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
