"""Language of web pages from text, markup, address and host, fused by Bayes' rule.

Text: a naive Bayes model of hashed byte n-grams, fit on a sample of documents
with a known language, about ``per_language`` of each. N-grams of a text depend
on each other, so its likelihood counts as that of at most ``independent``
n-grams. Markup, suffix and path: how likely each declared language, each top
level of the host name and each two-letter path segment is for pages of a
language, from sums of the text's posteriors over all pages. Host: the share of
each language among the other pages of the host, smoothed by that of its
domain, which is smoothed by that of all pages; a page's own text is taken out,
so that it does not count twice. All these sums are grouped aggregates with
partial sums before the exchange; hot hosts only meet in joins, which can be
split.

Defined cases: a comment, script or tag that is not closed runs to the page's
end; pages without text are judged by the other evidence; a null or
odd address has the empty host; an unknown declaration is a value like others.
Without any document of known language the language is null. Equal
probabilities go to the language first in the alphabet. Repeated rows get a row
each; extra columns are ignored.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmill.llm import bytescan as bs
from shelfmill.session import stored


@dataclass(frozen=True)
class LanguageModel:
    per_language: int = 500
    gram: int = 3
    bucket_bits: int = 15
    independent: float = 40.0
    declared_smoothing: float = 2.0
    host_smoothing: float = 5.0


# What is not closed runs to the page's end, so that a scan never comes back to look for a close.
_MARKUP = (r"(?is)<script\b.*?(?:</script\s*+>|\z)", r"(?is)<style\b.*?(?:</style\s*+>|\z)", r"(?s)<!--.*?(?:-->|\z)", r"<[A-Za-z/!?][^>]*+(?:>|\z)", r"&[a-zA-Z]{2,8};")


def visible_text(html: Column) -> Column:
    """Text of a page: scripts, styles, comments and tags taken out; a ``<`` before anything else is text."""
    for pattern in _MARKUP:
        html = F.regexp_replace(html, pattern, " ")
    return html


def declared_language(html: Column) -> Column:
    """Primary part of the ``lang`` attribute of a page's first html tag, in lower case; empty if there is none."""
    tag = F.regexp_extract(html, r"(?i)<html\b([^>]*+)", 1)
    return F.lower(F.regexp_extract(tag, r"(?i)(?:^|[\s\"'/])(?:xml:)?lang\s*+=\s*+[\"']?([A-Za-z]+)", 1))


def _buckets(data: np.ndarray, offsets: np.ndarray, spec: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    rolled = bs.byte_hash(bs.lower_ascii(data)).rolling(spec.gram)
    stop = np.repeat(offsets[1:], np.diff(offsets))
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = np.arange(len(rolled)) + spec.gram <= stop[: len(rolled)]
    return (rolled[inside] >> np.uint64(64 - spec.bucket_bits)).astype(np.int64), owner[: len(rolled)][inside]


def fit(documents: DataFrame, spec: LanguageModel = LanguageModel()) -> tuple[list[str], np.ndarray]:
    """Languages, and the log likelihood of each bucket by language."""
    known = documents.where(F.col("lang").isNotNull())
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    languages = sorted(counts)
    if not languages:
        return [], np.zeros((0, 1 << spec.bucket_bits))
    # A share of each language by a hash of the id, so that the sample's size is bounded.
    place = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1_000_000))
    chosen = functools.reduce(operator.or_, [(F.col("lang") == k) & (place < int(1_000_000 * min(1.0, spec.per_language / n)) + 1) for k, n in counts.items()])
    number = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")).cast("int") - 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(languages) << spec.bucket_bits, np.int64)
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for first, last, data, offsets in bs.blocks(batch.column(1)):
                buckets, owner = _buckets(data, offsets, spec)
                total += np.bincount((own[first:last][owner] << spec.bucket_bits) + buckets, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    cells = known.where(chosen).select(number.alias("k"), "text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    total = np.full(len(languages) << spec.bucket_bits, 0.5)
    for row in cells.toLocalIterator():  # at most a row for each bucket and language
        total[row.cell] += row.n
    total = total.reshape(len(languages), -1)
    return languages, np.log(total / total.sum(axis=1, keepdims=True))


def _likelihoods(text: Column, pages: DataFrame, model: np.ndarray, spec: LanguageModel) -> Column:
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<double>")
    def likelihood(texts: pa.Array) -> pa.Array:
        model = shared.value
        parts = [np.zeros((0, len(model)))]
        for first, last, data, offsets in bs.blocks(texts):
            buckets, owner = _buckets(data, offsets, spec)
            n = np.bincount(owner, minlength=last - first)
            sums = np.stack([np.bincount(owner, weights=row[buckets], minlength=last - first) for row in model], axis=1)
            parts.append(sums * (spec.independent / (n + spec.independent))[:, None])
        flat = np.concatenate(parts)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * len(model)), pa.array(flat.ravel()))

    return likelihood(text)


def _posterior(logs: list[Column]) -> list[Column]:
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    weights = [F.exp(x - top) for x in logs]
    total = functools.reduce(operator.add, weights)
    return [w / total for w in weights]


def identify(pages: DataFrame, documents: DataFrame, spec: LanguageModel = LanguageModel()) -> DataFrame:
    """``page_id, lang, probability, text_lang, declared, host``, a row per row of ``pages``."""
    languages, model = fit(documents, spec)
    url = F.coalesce("url", F.lit(""))
    html = F.coalesce("html", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    seen = pages.select(
        "page_id",
        host.alias("host"),
        F.regexp_extract(host, r"(?<![^.])([^.]++\.[^.]++)$", 1).alias("domain"),
        F.regexp_extract(host, r"\.([^.]++)$", 1).alias("suffix"),
        F.lower(F.regexp_extract(url, r"^[^:]*://[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1)).alias("path"),
        declared_language(html).alias("declared"),
        visible_text(html).alias("text"),
    )
    if not languages:
        return seen.select("page_id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"), F.lit(None).cast("string").alias("text_lang"), "declared", "host")

    each = range(len(languages))
    logs = seen.withColumn("logs", _likelihoods(F.col("text"), pages, model, spec)).drop("text")
    named = logs.select("page_id", "host", "domain", "suffix", "path", "declared", *[F.col("logs")[k].alias(f"t{k}") for k in each])
    texts = stored(named.select("*", *[p.alias(f"p{k}") for k, p in zip(each, _posterior([F.col(f"t{k}") for k in each]), strict=True)]), "pages")

    sums = [F.sum(f"p{k}") for k in each]
    total = texts.agg(F.count("*").alias("n"), *[s.alias(f"s{k}") for k, s in zip(each, sums, strict=True)]).first()
    shares = [((total[f"s{k}"] or 0.0) + 1) / (total.n + len(languages)) for k in each]

    judged = texts
    for name in ("declared", "suffix", "path"):
        # log P(value | language): the value's part in the pages of the language, smoothed by its part in all pages.
        seen_with = texts.groupBy(name).agg(F.count("*").alias("n"), *[s.alias(f"s{k}") for k, s in zip(each, sums, strict=True)])
        agrees = [F.when(F.col(name) == language, spec.declared_smoothing).otherwise(0.0) for language in languages]
        c = spec.declared_smoothing
        rows = [F.log((F.col(f"s{k}") + c * F.col("n") / max(total.n, 1) + agrees[k]) / (shares[k] * total.n + 2 * c)).alias(f"{name}{k}") for k in each]
        judged = judged.join(seen_with.select(F.col(name).alias("_v"), *rows), judged[name] == F.col("_v"), "left").drop("_v")

    c = spec.host_smoothing
    by_domain = texts.groupBy("domain").agg(F.count("*").alias("dn"), *[s.alias(f"d{k}") for k, s in zip(each, sums, strict=True)]).withColumnRenamed("domain", "_d")
    by_host = texts.groupBy("host").agg(F.count("*").alias("hn"), *[s.alias(f"h{k}") for k, s in zip(each, sums, strict=True)]).withColumnRenamed("host", "_h")
    judged = judged.join(by_domain, judged.domain == by_domain._d, "left").join(by_host, judged.host == by_host._h, "left")
    prior = []
    for k in each:
        own = F.col(f"p{k}")
        domain = (F.greatest(F.lit(0.0), F.col(f"d{k}") - own) + c * shares[k]) / (F.col("dn") - 1 + c)
        prior.append((F.greatest(F.lit(0.0), F.col(f"h{k}") - own) + c * domain) / (F.col("hn") - 1 + c))
    fused = [F.col(f"t{k}") + F.log(prior[k]) + sum(F.col(f"{name}{k}") for name in ("declared", "suffix", "path")) for k in each]
    final = judged.select("page_id", "declared", "host", *[F.col(f"p{k}") for k in each], *[p.alias(f"q{k}") for k, p in zip(each, _posterior(fused), strict=True)])

    def best(prefix: str) -> Column:
        values = F.array(*[F.col(f"{prefix}{k}") for k in each])
        return F.element_at(F.array(*map(F.lit, languages)), F.array_position(values, F.array_max(values)).cast("int"))

    top = F.array_max(F.array(*[F.col(f"q{k}") for k in each]))
    return final.select("page_id", best("q").alias("lang"), top.alias("probability"), best("p").alias("text_lang"), "declared", "host")
