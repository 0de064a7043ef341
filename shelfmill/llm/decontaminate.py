"""Benchmark decontamination by winnowing.

A text is a list of words. Every benchmark item is cut into windows of
``window`` consecutive words (an item of fewer words is one window). Of each
window only the k-gram with the smallest hash is kept as a fingerprint, on both
sides, so a span shared over a whole window always shares a fingerprint. Text
and item fingerprints are joined on their hash and each hit is extended word
by word to both sides; a span that reaches the window's length is an
occurrence. The words decide, not the hashes.

Before the join, text fingerprints are looked up in a bitmap of the items'
hashes. Its size is fixed, so it can be sent to every task however many items
there are; what it lets through by chance is dropped by the join.

Defined cases: null and word-less texts have no words and no hits. A repeated
row gets a row of its own. A null item id counts as the id ``''``; repeated
items count once by id; items without words match nothing. Extra columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmill.llm import bytescan as bs
from shelfmill.session import stored


@dataclass(frozen=True)
class Winnowing:
    """``window`` words must agree; fingerprints are hashes of ``gram`` words."""

    window: int = 13
    gram: int = 5
    bitmap_bits: int = 24
    min_percent: int = 5  # hit words in percent of all words that make a text contaminated


_HIT = "struct<size:int,hash:long,at:int,before:array<string>,after:array<string>>"


class _Words:
    """Words of a block of texts with hashes of any run of them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = bs.lower_ascii(data)
        self.starts, self.ends = bs.alnum_words(self.data, offsets)
        self.bounds = bs.per_text(self.starts, offsets)
        self.last = np.repeat(self.bounds[1:], np.diff(self.bounds))  # end of each word's text
        self.first = np.repeat(self.bounds[:-1], np.diff(self.bounds))
        self.hash = bs.SpanHash(bs.byte_hash(self.data)(self.starts, self.ends))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of n words by their first, and which stay inside their text."""
        hashes = self.hash.rolling(n)
        return hashes, np.arange(len(hashes)) + n <= self.last[: len(hashes)]

    def winnowed(self, spec: Winnowing) -> tuple[np.ndarray, np.ndarray]:
        """Places of the fingerprints and their hashes."""
        hashes, _ = self.grams(spec.gram)
        span = spec.window - spec.gram + 1
        least = bs.sliding_min(hashes, span)
        if not len(least):
            return np.zeros(0, np.int64), hashes[:0]
        inside = np.arange(len(least)) + spec.window <= self.last[: len(least)]
        # The largest minimum of the windows around a place; zero where none is.
        padded = np.zeros(len(least) + 2 * (span - 1), np.uint64)
        padded[span - 1 : span - 1 + len(least)] = np.where(inside, least, 0)
        around = bs.sliding_max(padded, span)
        at = np.flatnonzero((around == hashes) & (around > 0))
        return at, hashes[at]

    def words(self, lo: int, hi: int) -> list[str]:
        return [self.data[self.starts[i] : self.ends[i]].tobytes().decode("utf-8", "replace") for i in range(lo, hi)]

    def context(self, at: int, size: int, spec: Winnowing) -> tuple[list[str], list[str]]:
        """Words before the place, nearest first, and from the place on, as far as a window can reach."""
        before = self.words(max(self.first[at], at - (spec.window - spec.gram)), at)[::-1] if size == spec.window else []
        return before, self.words(at, min(self.last[at], at + size))


def _hits(block: _Words, sizes: list[int], spec: Winnowing, bitmap: np.ndarray | None) -> list[tuple[int, dict]]:
    """(text, hit) of fingerprints, and of all short runs whose length an item has."""
    found = []
    for size in sizes:
        if size == spec.window:
            at, hashes = block.winnowed(spec)
        else:
            hashes, inside = block.grams(size)
            at = np.flatnonzero(inside)
            hashes = hashes[at]
        if bitmap is not None:
            slots = hashes >> np.uint64(64 - spec.bitmap_bits)
            known = (bitmap[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) == 1
            at, hashes = at[known], hashes[known]
        texts = np.searchsorted(block.bounds, at, "right") - 1
        for text, place, value in zip(texts.tolist(), at.tolist(), hashes.view(np.int64).tolist(), strict=True):
            before, after = block.context(place, size, spec)
            hit = {"size": size, "hash": value, "at": int(place - block.first[place]), "before": before, "after": after}
            found.append((text, hit))
    return found


_SCAN = f"struct<n_words:long,hits:array<{_HIT}>>"
_LIST = pa.list_(pa.string())
_KIND = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("size", pa.int32()), ("hash", pa.int64()), ("at", pa.int32()), ("before", _LIST), ("after", _LIST)])))])


def _scan(texts: pa.Array, spec: Winnowing, sizes: list[int] | None, bitmap: np.ndarray | None) -> pa.Array:
    """Words of each text and its hits. Without ``sizes``, the fingerprints of items."""
    out = []
    for _, _, data, offsets in bs.blocks(texts):
        block = _Words(data, offsets)
        counts = np.diff(block.bounds).tolist()
        rows = [{"n_words": n, "hits": []} for n in counts]
        own = sizes if sizes is not None else sorted({min(n, spec.window) for n in counts if n})
        for text, hit in _hits(block, own, spec, bitmap):
            # An item of few words is one window: only the run of its own length.
            if sizes is not None or hit["size"] == min(counts[text], spec.window):
                rows[text]["hits"].append(hit)
        out.extend(rows)
    return pa.array(out, _KIND)


def _agreeing(a: Column, b: Column) -> Column:
    """Length of the longest equal beginning of two arrays."""
    equal = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    at = F.array_position(equal, False)
    return F.when(at == 0, F.size(equal)).otherwise(at - 1).cast("int")


def item_fingerprints(items: DataFrame, spec: Winnowing = Winnowing()) -> DataFrame:
    """``item_id, size, hash, before, after`` of the fingerprints of ``items(item_id, text)``."""

    @F.arrow_udf(_SCAN)
    def scan(texts: pa.Array) -> pa.Array:
        return _scan(texts, spec, None, None)

    return (
        items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), scan("text").alias("s"))
        .select("item_id", F.explode("s.hits").alias("h"))
        .select("item_id", "h.size", "h.hash", "h.before", "h.after")
        .distinct()
    )


def occurrences(documents: DataFrame, items: DataFrame, spec: Winnowing = Winnowing()) -> tuple[DataFrame, DataFrame]:
    """Words per text and the item windows found in texts.

    Returns ``(doc_id, text_key, n_words)``, one row per row of ``documents``,
    and ``(doc_id, text_key, item_id, start, stop)`` in words. ``text_key`` is
    a hash of the text, so that repeated ids do not mix.
    """
    prints = stored(item_fingerprints(items, spec), "items")
    slot = F.shiftrightunsigned("hash", 64 - spec.bitmap_bits)
    cells = prints.select((slot / 64).cast("int").alias("cell"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - spec.bitmap_bits}) & 63 as int))").alias("bit"))
    bitmap = np.zeros(1 << (spec.bitmap_bits - 6), np.uint64)
    for row in cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toLocalIterator():  # at most 2**18 rows
        bitmap[row.cell] = np.uint64(row.bits & ((1 << 64) - 1))
    sizes = sorted(r.size for r in prints.select("size").distinct().toLocalIterator())  # at most one per word count up to the window
    shared = documents.sparkSession.sparkContext.broadcast(bitmap)

    @F.arrow_udf(_SCAN)
    def scan(texts: pa.Array) -> pa.Array:
        return _scan(texts, spec, sizes, shared.value)

    scanned = stored(
        documents.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), scan("text").alias("s")).select("doc_id", "text_key", "s.n_words", "s.hits"), "scanned"
    )
    hits = scanned.where(F.size("hits") > 0).select("doc_id", "text_key", F.explode("hits").alias("h"))
    hits = hits.select("doc_id", "text_key", "h.size", "h.hash", "h.at", F.col("h.before").alias("b"), F.col("h.after").alias("a"))
    joined = hits.join(prints, ["size", "hash"]).select("doc_id", "text_key", "item_id", "size", "at", _agreeing(F.col("b"), F.col("before")).alias("left"), _agreeing(F.col("a"), F.col("after")).alias("right"))
    found = joined.where(F.col("left") + F.col("right") >= F.col("size")).select("doc_id", "text_key", "item_id", (F.col("at") - F.col("left")).alias("start"), (F.col("at") + F.col("right")).alias("stop"))
    return scanned.select("doc_id", "text_key", "n_words"), found


def contamination(documents: DataFrame, items: DataFrame, spec: Winnowing = Winnowing()) -> DataFrame:
    """``doc_id, text_key, n_words, n_hit, n_items, item_ids, contaminated``, a row per row of ``documents``.

    ``n_hit`` counts words inside any occurrence, ``item_ids`` are the items
    found, sorted as strings.
    """
    texts, found = occurrences(documents, items, spec)
    # Spans and items of a text are bounded by the text; both are de-duplicated before the exchange.
    spans = F.array_sort(F.collect_set(F.struct("start", "stop")))
    per_text = found.groupBy("doc_id", "text_key").agg(spans.alias("spans"), F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    union = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("reach"), F.lit(0).cast("long").alias("words")),
        lambda acc, s: F.struct(
            F.greatest(acc.reach, s.stop).alias("reach"),
            (acc.words + F.greatest(F.lit(0), s.stop - F.greatest(acc.reach, s.start))).alias("words"),
        ),
        lambda acc: acc.words,
    )
    per_text = per_text.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), union.alias("n_hit"), "item_ids")
    joined = texts.join(per_text, texts.doc_id.eqNullSafe(per_text.d) & (texts.text_key == per_text.k), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id",
        "text_key",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((n_hit > 0) & (100 * n_hit >= spec.min_percent * F.col("n_words"))).alias("contaminated"),
    )


def remove_contaminated(documents: DataFrame, items: DataFrame, spec: Winnowing = Winnowing()) -> DataFrame:
    """Rows of ``documents`` whose text is not contaminated; all columns stay."""
    bad = contamination(documents, items, spec).where("contaminated").select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k")).distinct()
    key = F.xxhash64(F.coalesce(documents["text"], F.lit("")))
    return documents.join(bad, documents["doc_id"].eqNullSafe(bad["_d"]) & (key == bad["_k"]), "left_anti")
