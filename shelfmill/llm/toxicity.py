"""Toxicity by the nearest labelled examples in exact TF-IDF cosine.

Terms are all lower-cased words of a bounded sample of labelled texts, and the
telling ones among the beginnings of their words (4 to 7 bytes). A term tells
the classes apart if its G statistic is high; the other words weigh ``other``
times as much. One more term, the number of words, makes the share of telling
words matter. A word that comes in no example counts in the length of a text's
vector like one that a single document has. Document frequencies are counted
over all documents.

The examples form a block-max inverted index: the postings of a term are kept
by blocks of examples, with the largest weight in each block. A text is held
against the few blocks with the highest bounds that these maxima give, and then
only against those that can still hold one of the ``neighbours`` nearest, so
the result is that of comparing all examples; many texts are held against a
block at once. Their votes count by the square of the
cosine, and by class so that the sample's shares become those of all labelled
rows; with a weak prior the share of toxic votes is the score. The index's size
is bounded by the sample.

Defined cases: a null or word-less text has no vector and gets the prior, the
share of toxic rows; without labels that is 0.5. Equal cosines go to the
example with the smaller doc_id. Repeated rows get equal scores.
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
class NearestExamples:
    per_class: int = 1500  # labelled texts of each class in the index
    beginnings: tuple[int, ...] = (4, 5, 6, 7)
    least_texts: int = 4  # sampled texts that a telling term must come in
    least_g: float = 10.83  # one in a thousand terms without a tie to the label passes
    other: float = 0.05  # weight of words that do not tell the classes apart
    background: float = 1.0  # weight of the number of words
    neighbours: int = 41
    prior_votes: float = 0.5
    block: int = 64


def _terms(data: np.ndarray, offsets: np.ndarray, spec: NearestExamples) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all terms of a block of texts, the text of each, and words per text."""
    data = bs.lower_ascii(data)
    hashes = bs.byte_hash(data)
    starts, ends = bs.alnum_words(data, offsets)
    text = np.searchsorted(offsets, starts, "right") - 1
    found, owner = [hashes(starts, ends)], [text]
    for n in spec.beginnings:
        longer = ends - starts > n
        at = starts[longer]
        found.append(bs.mix(hashes(at, at + n)))  # not equal to the word of these bytes
        owner.append(text[longer])
    return np.concatenate(found), np.concatenate(owner), np.bincount(text, minlength=len(offsets) - 1)


class _Vocabulary:
    """Sorted term hashes with a quick test that most beginnings fail."""

    def __init__(self, hashes: np.ndarray, telling: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.telling = hashes[order], telling[order]
        self._maybe = np.zeros(1 << 22, bool)
        self._maybe[(self.hashes >> np.uint64(42)).astype(np.int64)] = True

    def known(self, found: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, count) of the known terms, by text and term."""
        n = len(self.hashes)
        keep = self._maybe[(found >> np.uint64(42)).astype(np.int64)]
        found, owner = found[keep], owner[keep]
        at = np.minimum(np.searchsorted(self.hashes, found), max(n - 1, 0))
        keep = self.hashes[at] == found if n else np.zeros(0, bool)
        keys, counts = np.unique(owner[keep] * max(n, 1) + at[keep], return_counts=True)
        return keys // max(n, 1), keys % max(n, 1), counts

    def unseen(self, words: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """Sum of the squared term frequency weights of each text's unknown words."""
        n = len(self.hashes)
        new = ~self._maybe[(words >> np.uint64(42)).astype(np.int64)]
        if n:
            rest = np.flatnonzero(~new)
            new[rest] = self.hashes[np.minimum(np.searchsorted(self.hashes, words[rest]), n - 1)] != words[rest]
        words, owner = words[new], owner[new]
        _, first, counts = np.unique(words + bs.mix(owner.astype(np.uint64)), return_index=True, return_counts=True)
        return np.bincount(owner[first], (1 + np.log(counts)) ** 2, minlength=texts)


def _select(sample: DataFrame, spec: NearestExamples) -> _Vocabulary:
    """All words of the sample and the beginnings that tell its classes apart."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(0).to_numpy(zero_copy_only=False)
            for first, last, data, offsets in bs.blocks(batch.column(1)):
                found, owner, words = _terms(data, offsets, spec)
                for label in (0, 1):
                    own = labels[first:last][owner] == label
                    pairs = np.unique(np.stack([found[own], owner[own].astype(np.uint64)]), axis=1) if own.any() else np.zeros((2, 0), np.uint64)
                    terms, texts = np.unique(pairs[0], return_counts=True)
                    whole = np.isin(terms, found[: words.sum()])
                    yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(whole), pa.array(texts if label else 0 * texts), pa.array(0 * texts if label else texts)], names=["term", "word", "toxic", "clean"])

    counted = sample.select("label", "text").mapInArrow(count, "term long, word boolean, toxic long, clean long").groupBy("term").agg(F.max("word").alias("word"), F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    sizes = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)

    def part(k: Column, n: int, all_k: Column) -> Column:
        return F.when((k > 0) & (n > 0), k * F.log(k * (n1 + n0) / (all_k * n))).otherwise(0.0)

    a, b = F.col("a"), F.col("b")
    g = 2 * (part(a, n1, a + b) + part(b, n0, a + b) + part(n1 - a, n1, n1 + n0 - a - b) + part(n0 - b, n0, n1 + n0 - a - b))
    telling = (a + b >= spec.least_texts) & (g >= spec.least_g)
    # Bounded by the sample's text.
    terms = counted.select("term", "word", telling.alias("telling")).where("word or telling").toArrow()
    return _Vocabulary(terms["term"].to_numpy().view(np.uint64), terms["telling"].to_numpy())


def _idf(documents: DataFrame, vocabulary: _Vocabulary, spec: NearestExamples) -> np.ndarray:
    """Inverse document frequencies of the terms over all documents, at the end that of a word in one document."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        n, texts = len(vocabulary.hashes), 0
        total = np.zeros(n + 1, np.int64)
        for batch in batches:
            for first, last, data, offsets in bs.blocks(batch.column(0)):
                found, owner, _ = _terms(data, offsets, spec)
                total[:n] += np.bincount(vocabulary.known(found, owner, last - first)[1], minlength=n)[:n]
                texts += last - first
        total[n] = texts
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "n"])

    rows = documents.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # one row a term
    total = np.zeros(len(vocabulary.hashes) + 1)
    total[rows["term"].to_numpy()] = rows["n"].to_numpy()
    return np.log((total[-1] + 1) / (np.append(total[:-1], min(1, total[-1])) + 1)) + 1e-6


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges, one range after the other, and the range of each."""
    n = ends - starts
    own = np.repeat(np.arange(len(n)), n)
    return np.arange(len(own)) + (starts - np.cumsum(n) + n)[own], own


class BlockMaxIndex:
    """Inverted index of weighted examples by blocks, with exact nearest neighbours.

    Examples with the same strongest term lie together, so that blocks differ.
    Terms that come in over ``common`` of the examples are held as dense rows
    with the largest weight in each block; they are read only in blocks that
    may still hold a nearest example. Postings of the other terms are short.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, block: int, common: float = 1 / 24):
        """``vectors``: terms and weights of each example."""
        self.examples = n = len(vectors)
        self.blocks, self.block = -(-n // block), block
        term, weight = (np.concatenate([v[k] for v in vectors]) if n else np.zeros(0, kind) for k, kind in ((0, np.int64), (1, np.float64)))
        example = np.repeat(np.arange(n), [len(ids) for ids, _ in vectors])
        used = np.bincount(term, minlength=terms)
        rarer = used * 2 <= n
        strongest = [int(ids[np.argmax(w * rarer[ids])]) if len(ids) else terms for ids, w in vectors]
        self.number = np.argsort(strongest, kind="stable")  # the example at each place
        place = np.argsort(self.number)[example]
        dense = used > common * n
        self.row = np.where(dense, np.cumsum(dense) - 1, -1)
        self.rows = np.zeros((self.blocks, int(dense.sum()), block))
        of_row = dense[term]
        self.rows[place[of_row] // block, self.row[term[of_row]], place[of_row] % block] = weight[of_row]
        self.most = self.rows.max(2, initial=0.0).T.copy()  # block maxima
        term, place, weight = term[~of_row], place[~of_row], weight[~of_row]
        order = np.lexsort((place, term))
        self.place, self.weight = place[order], weight[order]
        self.postings = np.searchsorted(term[order], np.arange(terms + 1))

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` nearest examples of a text and their cosines, ties to the smaller number."""
        return self.nearest_of_all(np.zeros(len(ids), np.int64), ids, weights, 1, k)[1:]

    def nearest_of_all(self, text: np.ndarray, ids: np.ndarray, weights: np.ndarray, texts: int, k: int, at_once: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, example, cosine) of the ``k`` nearest of each text, nearest first; ``text`` is sorted."""
        k = min(k, self.examples)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for first in range(0, texts if k else 0, at_once):
            last = min(first + at_once, texts)
            a, b = np.searchsorted(text, (first, last))
            own, example, cosine = self._nearest(text[a:b] - first, ids[a:b], weights[a:b], last - first, k)
            found.append((own + first, example, cosine))
        text, example, cosine = (np.concatenate(part) for part in zip(*found, strict=True))
        return text, example, cosine

    def _nearest(self, text: np.ndarray, ids: np.ndarray, weights: np.ndarray, texts: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = self.blocks * self.block
        row = self.row[ids]
        dense = row >= 0
        query = np.zeros((texts, len(self.most)))
        query[text[dense], row[dense]] = weights[dense]
        text, ids, weights = text[~dense], ids[~dense], weights[~dense]
        at, part = _ranges(self.postings[ids], self.postings[ids + 1])
        rare = np.bincount(text[part] * size + self.place[at], weights[part] * self.weight[at], minlength=texts * size)
        rare = rare.reshape(texts, self.blocks, self.block)
        bounds = rare.max(2) + query @ self.most
        cosine = np.full(rare.shape, -np.inf)

        def read(wanted: np.ndarray) -> np.ndarray:
            """Cosines in the wanted blocks; the ``k``th best of each text so far."""
            for block in np.flatnonzero(wanted.any(0)):
                some = np.flatnonzero(wanted[:, block])
                exact = rare[some, block] + query[some] @ self.rows[block]
                cosine[some, block, : self.examples - block * self.block] = np.round(exact, 9)[:, : self.examples - block * self.block]
            return np.partition(cosine.reshape(texts, size), size - k, axis=1)[:, size - k]

        best = min(self.blocks, 2 + -(-k // self.block))
        wanted = np.zeros(bounds.shape, bool)
        np.put_along_axis(wanted, np.argpartition(-bounds, best - 1, axis=1)[:, :best], True, axis=1)
        least = read(wanted)
        least = read(~wanted & (bounds >= least[:, None] - 1e-9))
        own, place = np.nonzero(cosine.reshape(texts, size) >= least[:, None])
        value, example = cosine.reshape(texts, size)[own, place], self.number[place]
        order = np.lexsort((example, -value, own))
        own = own[order]
        kept = np.arange(len(own)) - np.searchsorted(own, np.arange(texts))[own] < k
        return own[kept], example[order][kept], value[order][kept]


@dataclass
class Model:
    vocabulary: _Vocabulary
    idf: np.ndarray
    index: BlockMaxIndex
    example_ids: np.ndarray
    toxic: np.ndarray
    vote: np.ndarray  # worth of a vote of each class
    prior: float


def _vectors(found: tuple[np.ndarray, np.ndarray, np.ndarray], words: np.ndarray, unseen: np.ndarray, idf: np.ndarray, spec: NearestExamples) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, weight), by text; ``idf`` is scaled, its last place is for the ``unseen`` words."""
    text, term, count = found
    some = np.flatnonzero(words)
    text, term = np.append(text, some), np.append(term, np.full(len(some), len(idf) - 1))
    weight = np.append((1 + np.log(count)) * idf[found[1]], spec.background * np.log1p(words[some]))
    length = np.sqrt(np.bincount(text, weight**2, minlength=len(words)) + unseen * idf[-1] ** 2)
    order = np.argsort(text, kind="stable")
    text, term, weight = text[order], term[order], weight[order]
    return text, term, weight / length[text]


def fit(documents: DataFrame, sample: Sample, spec: NearestExamples) -> Model:
    vocabulary = _select(sample.texts, spec)
    idf = _idf(documents, vocabulary, spec) * np.where(np.append(vocabulary.telling, False), 1.0, spec.other)
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            ids, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, last, data, offsets in bs.blocks(batch.column(2)):
                found, owner, words = _terms(data, offsets, spec)
                text, term, n = vocabulary.known(found, owner, last - first)
                cuts = np.searchsorted(text, np.arange(last - first + 1))
                rows = [{"doc_id": ids[first + k], "label": labels[first + k], "words": int(words[k]), "terms": term[a:b].astype(np.int32).tobytes(), "counts": n[a:b].astype(np.int32).tobytes()} for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("words", pa.int64()), ("terms", pa.binary()), ("counts", pa.binary())]))

    # Bounded: per_class examples of each class with the numbers of their terms.
    rows = sample.texts.select(F.col("doc_id").cast("long"), "label", "text").mapInArrow(count, "doc_id long, label int, words long, terms binary, counts binary").orderBy("doc_id").collect()
    rows = [r for r in rows if r.words]
    text = np.repeat(np.arange(len(rows)), [len(r.terms) // 4 for r in rows])
    term, n = (np.frombuffer(b"".join(r[name] for r in rows), np.int32).astype(np.int64) for name in ("terms", "counts"))
    text, term, weight = _vectors((text, term, n), np.array([r.words for r in rows], np.int64), np.zeros(len(rows)), idf, spec)
    cuts = np.searchsorted(text, np.arange(len(rows) + 1))
    vectors = [(term[a:b], weight[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    toxic = np.array([r.label for r in rows], np.int64)
    used = np.bincount(toxic, minlength=2)
    total = np.array([sample.totals[0], sample.totals[1]])
    vote = np.where(used > 0, total / np.maximum(used, 1), 0.0)
    prior = (total[1] + 0.5) / (total.sum() + 1)
    return Model(vocabulary, idf, BlockMaxIndex(vectors, len(idf), spec.block), np.array([r.doc_id for r in rows], np.int64), toxic, vote / max(vote.min(), 1e-9) if vote.min() > 0 else np.ones(2), float(prior))


def score(text: Column | str, documents: DataFrame, model: Model, spec: NearestExamples = NearestExamples()) -> Column:
    """Struct of ``score`` and ``evidence``: the three nearest examples with cosine and label."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<score:double,evidence:array<struct<doc_id:long,cosine:double,toxic:int>>>")
    def nearest(texts: pa.Array) -> pa.Array:
        model = shared.value
        scores, evidence, sizes = [np.zeros(0)], [(np.zeros(0, np.int64), np.zeros(0))], [np.zeros(0, np.int64)]
        for first, last, data, offsets in bs.blocks(texts):
            found, owner, words = _terms(data, offsets, spec)
            n, count = words.sum(), last - first  # the words come before their beginnings
            unseen = model.vocabulary.unseen(found[:n], owner[:n], count)
            text, term, weight = _vectors(model.vocabulary.known(found, owner, count), words, unseen, model.idf, spec)
            text, example, cosine = model.index.nearest_of_all(text, term, weight, count, spec.neighbours)
            some = words[text] > 0
            text, example, cosine = text[some], example[some], cosine[some]
            toxic = model.toxic[example]
            votes = cosine**2 * model.vote[toxic]
            against = np.bincount(text, votes, minlength=count) + spec.prior_votes
            scores.append(np.clip((np.bincount(text, votes * toxic, minlength=count) + spec.prior_votes * model.prior) / against, 0, 1))
            shown = np.arange(len(text)) - np.searchsorted(text, np.arange(count))[text] < 3
            evidence.append((example[shown], cosine[shown]))
            sizes.append(np.bincount(text[shown], minlength=count))
        example, cosine = (np.concatenate(part) for part in zip(*evidence, strict=True))
        rows = pa.StructArray.from_arrays([pa.array(model.example_ids[example], pa.int64()), pa.array(cosine), pa.array(model.toxic[example], pa.int32())], names=["doc_id", "cosine", "toxic"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.concatenate(sizes))), pa.int32()), rows)
        return pa.StructArray.from_arrays([pa.array(np.concatenate(scores)), lists], names=["score", "evidence"])

    return nearest(text)


def rate(documents: DataFrame, labels: DataFrame, label: str, fold: Fold, threshold: float = 0.3, spec: NearestExamples = NearestExamples()) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence``, a row per row of ``documents``."""
    sample = labelled_sample(documents, labels, label, fold, spec.per_class)
    rated = score("text", documents, fit(documents, sample, spec), spec)
    scored = documents.select("doc_id", fold.held_out("doc_id").alias("held_out"), rated.alias("r"))
    return scored.select("doc_id", "held_out", "r.score", (F.col("r.score") >= threshold).cast("int").alias("predicted"), "r.evidence")
