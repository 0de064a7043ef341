"""Bounded, documented samples of labelled rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmill.session import stored


@dataclass(frozen=True)
class Fold:
    """Rows whose crc32 of the doc_id as text leaves ``remainder`` by ``modulus`` are held out."""

    modulus: int
    remainder: int

    def held_out(self, doc_id: Column | str) -> Column:
        doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
        return F.coalesce(F.crc32(doc_id.cast("string")) % self.modulus == self.remainder, F.lit(False))


@dataclass(frozen=True)
class Sample:
    texts: DataFrame  # doc_id, label, text; at most per_class rows of each class
    totals: dict[int, int]  # labelled rows of each class outside the held-out fold


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, fold: Fold, per_class: int) -> Sample:
    """At most ``per_class`` labelled texts of each class, the first by a hash of the doc_id.

    Rows of the held-out fold and rows without an id or label are left out. Of
    several labels of one id the largest counts, of several texts the non-null one
    with the smallest hash.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~fold.held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    totals = {0: 0, 1: 0} | {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id", F.lit(label)), F.col("doc_id")]
    chosen = [known.where(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])  # at most 2 * per_class pairs of numbers: small enough to send
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    first = F.min(F.struct(F.col("text").isNull(), F.xxhash64("text"), F.col("text").alias("text")))
    texts = texts.groupBy("doc_id", "label").agg(first.alias("first")).select("doc_id", "label", "first.text")
    return Sample(stored(texts, f"sample-{label}"), totals)
