"""Links between texts whose sets of word n-grams have a high Jaccard similarity.

A size-aware join of light and heavy sets. Two sets of similarity t share at
least t times the larger one's size, so under one order of all shingles, rare
ones first, the first shared ones lie near the front of both:

* of a light (small) set all subsets of two shingles of its front are listed;
  two light sets that link list one subset in common;
* of a heavy (large) set, and of light sets that may link with one, the
  shingles of the front are listed one by one in inverted lists, which are
  scanned for partners.

The boundary is the size with the least total cost, from the number of sets of
each size, the rows that their lists take and the mean length of a list, all
counted over all texts. The order comes from counts in ``buckets`` hashed
counters of fixed number; any order gives the same links.

Equal sets are one class from the start. In a list every member is first held
against one of them, the list's centre; the most alike centre of a set is
checked exactly. Lists whose members then belong to one component are done; the
others get new centres as long as that settles lists. Then the members of
different components that still share a list are compared with each other.
Sizes, places in the order and parity bitmaps of the sets give sure bounds that
drop pairs before shingles are compared, and each link is proven on the whole
sets. Sets travel only for classes in a pair that may link, and list members
only for lists with two classes, both picked by a bitmap of at most ``2**26``
bits; above some tens of millions of such classes or lists it lets more
through, which the joins then drop.

Defined cases: a text of fewer words than ``shingle`` is one shingle; null and
word-less texts have empty sets and are their own component. Rows stay as they
are, also repeated ones. A null doc_id names a component only if no member has
one. Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmill.llm import bytescan as bs
from shelfmill.llm.components import components
from shelfmill.session import stored


@dataclass(frozen=True)
class JaccardJoin:
    shingle: int = 4
    percent: int = 85
    buckets: int = 1 << 20
    largest_light: int = 1024  # the boundary is looked for up to this size
    check_cost: float = 0.01  # of a partner in a scanned list, against a row of a list
    centres: int = 4  # of a list at first, four times as many in later turns
    worth: float = 0.1  # share of centres that must prove similar for another turn

    def least_shared(self, size):
        """Shingles that a set of ``size`` shares at least with any partner."""
        return -(-self.percent * size // 100)

    def needed(self, total):
        """Shingles that two sets of together ``total`` must share."""
        return -(-self.percent * total // (100 + self.percent))


def _sets(texts: pa.Array, spec: JaccardJoin) -> Iterator[tuple[int, np.ndarray]]:
    """(text, its distinct shingles in ascending order) of the texts with words."""
    for first, last, data, offsets in bs.blocks(texts):
        data = bs.lower_ascii(data)
        starts, ends = bs.spaced_words(data, offsets)
        words = bs.SpanHash(bs.byte_hash(data)(starts, ends))
        rolled = words.rolling(spec.shingle)
        bounds = bs.per_text(starts, offsets)
        short = np.flatnonzero((np.diff(bounds) < spec.shingle) & (np.diff(bounds) > 0))
        whole = dict(zip(short.tolist(), words(bounds[short], bounds[short + 1]), strict=True))
        for k, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist(), strict=False)):
            if a == b:
                continue
            if k in whole:
                yield first + k, np.array([whole[k]], np.uint64)
                continue
            found = np.sort(rolled[a : b - spec.shingle + 1])
            fresh = np.ones(len(found), bool)
            fresh[1:] = found[1:] != found[:-1]
            yield first + k, found[fresh]


def _key(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


@dataclass
class Order:
    """Counts by hashed counter, and the largest size of a light set."""

    counts: np.ndarray
    light: int

    def front(self, shingles: np.ndarray, n: int) -> np.ndarray:
        """The first ``n`` shingles in the common order."""
        weight = self.counts[(shingles & np.uint64(len(self.counts) - 1)).astype(np.int64)]
        if n < len(weight):
            near = weight <= np.partition(weight, n - 1)[n - 1]
            shingles, weight = shingles[near], weight[near]
        return shingles[np.lexsort((shingles, weight))[:n]]


def boundary(sizes: np.ndarray, counts: np.ndarray, spec: JaccardJoin) -> int:
    """The size up to which listing subsets costs less than scanning lists; ``sizes[s]`` sets have s shingles."""
    total = float(counts.sum())
    # Mean length of a shingle's list, without what other shingles add to its counter.
    length = max(0.0, (counts.astype(float) ** 2).sum() / total - total / len(counts)) if total else 0.0
    size = np.arange(len(sizes))
    front = size - spec.least_shared(size)
    subsets = np.cumsum(sizes * ((front + 2) * (front + 1) / 2) * (size >= 2))
    scans = np.cumsum(sizes * (front + 1) * (1 + spec.check_cost * length) * (size >= 2))
    cost = [subsets[x] + scans[-1] - scans[max(spec.least_shared(x + 1) - 1, 0)] for x in range(len(sizes))]
    return int(np.argmin(cost))


_CHUNK = 1 << 12  # counters in a row between tasks


def _packed(counts: np.ndarray) -> bytes:
    return counts.astype(np.min_scalar_type(int(counts.max()))).tobytes()


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, f"u{len(packed) // n}").astype(np.int64)


def _order(texts: DataFrame, spec: JaccardJoin) -> Order:
    length = spec.buckets + spec.largest_light + 1
    ends = range(0, length, _CHUNK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros(length, np.int64)
        for batch in batches:
            for _, found in _sets(batch.column(0), spec):
                np.add.at(both, (found & np.uint64(spec.buckets - 1)).astype(np.int64), 1)
                if len(found) <= spec.largest_light:
                    both[spec.buckets + len(found)] += 1
        if both.any():
            yield pa.RecordBatch.from_arrays([pa.array(ends, pa.int32()), pa.array([_packed(both[k : k + _CHUNK]) for k in ends], pa.binary())], names=["at", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        at = rows["at"][0].as_py()
        n = min(_CHUNK, length - at)
        total = np.zeros(n, np.int64)
        for packed in rows["counts"]:
            total += _unpacked(packed.as_py(), n)
        return pa.table({"at": pa.array([at], pa.int32()), "counts": pa.array([_packed(total)], pa.binary())})

    kind = "at int, counts binary"
    rows = texts.mapInArrow(count, kind).groupBy("at").applyInArrow(add, kind).toArrow()  # a number for each counter
    both = np.zeros(length, np.int64)
    for at, packed in zip(rows["at"].to_pylist(), rows["counts"].to_pylist(), strict=True):
        both[at : at + _CHUNK] = _unpacked(packed, min(_CHUNK, length - at))
    counts = both[: spec.buckets]
    return Order(counts, boundary(both[spec.buckets :], counts, spec))


def _parity(shingles: np.ndarray) -> bytes:
    """For each of a power of two of bits, whether an odd number of shingles falls on it."""
    bits = 1 << max(6, (len(shingles) - 1).bit_length())
    odd = np.bincount((shingles >> np.uint64(20) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _coarse(shingles: np.ndarray) -> np.ndarray:
    odd = np.bincount((shingles >> np.uint64(20) & np.uint64(64 * _WORDS - 1)).astype(np.int64), minlength=64 * _WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def parity_distance(a: bytes, b: bytes) -> int:
    """At most the number of shingles that are in one of the two sets only."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


@functools.lru_cache(maxsize=512)
def _choices(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def _front(shingles: np.ndarray, order: Order, spec: JaccardJoin) -> np.ndarray:
    n = len(shingles)
    return order.front(shingles, min(n, n - spec.least_shared(n) + 2))


def _lists(shingles: np.ndarray, order: Order, spec: JaccardJoin, front: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Lists that a set is in, and the most that it can share there with a partner."""
    n = len(shingles)
    if n < 2:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    spare = n - spec.least_shared(n)
    front = _front(shingles, order, spec) if front is None else front
    names, rest = [], []
    if n <= order.light:
        i, j = _choices(len(front))
        names.append(bs.mix(bs.mix(front[i]) + front[j]))
        rest.append(n - j + 1)
    if n >= spec.least_shared(order.light + 1):
        names.append(front[: spare + 1])
        rest.append(n - np.arange(spare + 1))
    return np.concatenate(names), np.concatenate(rest)


_WORDS = 8  # of 64 bits in a coarse parity bitmap

_HEAD = 32  # shingles at most of the front that a set carries to its pairs

_PRINTS = "n long, key long, parity binary, lists binary, rest binary, head array<long>, " + ", ".join(f"p{k} long" for k in range(_WORDS))


def _prints(documents: DataFrame, order: Order, spec: JaccardJoin) -> DataFrame:
    """``doc_id, n, key, parity, lists, rest, head`` of each row; of equal sets in a task one has the lists."""
    shared = documents.sparkSession.sparkContext.broadcast(order)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            n, key = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            parity, lists, rest, head = ([None] * batch.num_rows for _ in range(4))
            coarse = np.zeros((batch.num_rows, _WORDS), np.int64)
            for k, found in _sets(batch.column(1), spec):
                n[k], key[k] = len(found), _key(found)
                if key[k] not in seen:
                    if len(seen) > 1 << 20:
                        seen.clear()  # a set that is described twice does no harm
                    seen.add(int(key[k]))
                    front = _front(found, shared.value, spec)
                    names, left = _lists(found, shared.value, spec, front)
                    head[k] = front[:_HEAD].view(np.int64)
                    parity[k], lists[k], rest[k] = _parity(found), names.tobytes(), left.astype(np.int32).tobytes()
                    coarse[k] = _coarse(found)
            columns = [batch.column(0), pa.array(n), pa.array(key), *(pa.array(x, pa.binary()) for x in (parity, lists, rest)), pa.array(head, pa.list_(pa.int64())), *map(pa.array, coarse.T)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "key", "parity", "lists", "rest", "head", *(f"p{k}" for k in range(_WORDS))])

    return documents.select("doc_id", "text").mapInArrow(describe, f"doc_id {kind}, {_PRINTS}")


def _bitmap(keys: DataFrame, n: int) -> np.ndarray:
    """Bitmap with a bit for each of about ``n`` values of ``key``, as 64-bit words."""
    bits = 1 << min(26, max(10, (16 * n).bit_length()))
    bit = F.pmod("key", F.lit(bits))
    words = keys.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, int(pmod(key, {bits}L) & 63))")).alias("word")).toArrow()  # at most 2**20 rows
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[words["at"].to_numpy()] = words["word"].to_numpy()
    return bitmap


def _unpack(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """``list, key, n, rest`` for each list of the classes ``key, n, lists, rest``, some classes at a time."""
    for first in range(0, batch.num_rows, 1024):
        key, n, lists, rest = batch.slice(first, 1024).columns
        names = np.frombuffer(b"".join(lists.to_pylist()), np.int64)
        sizes = np.array([len(x) // 8 for x in lists.to_pylist()], np.int64)
        yield names, np.repeat(key.to_numpy(), sizes), np.repeat(n.to_numpy(), sizes), np.frombuffer(b"".join(rest.to_pylist()), np.int32)


def _inside(names: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    at = names & (64 * len(bitmap) - 1)
    return (bitmap[at >> 6] >> (at & 63) & 1).astype(bool)


def _each_list(prints: DataFrame, rows, kind: str) -> DataFrame:
    """Arrow rows that ``rows(list, key, n, rest)`` gives for the lists of the classes."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members in _unpack(batch):
                yield pa.RecordBatch.from_pydict(rows(*members))

    return prints.where("lists is not null").select("key", "n", "lists", "rest").mapInArrow(unpack, kind)


def _members(prints: DataFrame, bitmap: np.ndarray | None = None) -> DataFrame:
    """``list, key, n, rest``, a row for each list of each class, or for those lists that a bitmap lets through."""
    chosen = None if bitmap is None else prints.sparkSession.sparkContext.broadcast(bitmap)

    def rows(names, key, n, rest):
        columns = {"list": names, "key": key, "n": n.astype(np.int32), "rest": rest}
        inside = slice(None) if chosen is None else _inside(names, chosen.value)
        return {name: column[inside] for name, column in columns.items()}

    return _each_list(prints, rows, "list long, key long, n int, rest int")


def _by_size(names: np.ndarray, n: np.ndarray, rest: np.ndarray, spec: JaccardJoin) -> tuple[np.ndarray, ...]:
    """``row, list, guest, least`` of the members of lists: rows of the lists when these are cut by size.

    Sets whose sizes allow a link are in one band of sizes or in two that follow
    one another. A set is in the list of its band, and as a guest in that of the
    band below. Any two members of a list are compared in one part of it, where
    the smaller one is no guest: so two guests are not. Rows without room for
    the least partner there are left out. The smaller one of a link shares at
    least what two sets of its size must; ``least`` tells who may be it.
    """
    step = np.log(100.0 / spec.percent)
    band = np.floor(np.log(n) / step + 1e-9).astype(np.int64)
    partner = spec.least_shared(n)  # the smallest
    lowest = np.floor(np.exp(step * (np.stack([band, band - 1]) - 1e-6))).astype(np.int64)
    room = rest >= spec.needed(n + np.maximum(partner, lowest))
    guest, row = np.nonzero(room)
    cut = bs.mix(names[row].view(np.uint64) + bs.mix((band[row] - guest).astype(np.uint64))).view(np.int64)
    return row, cut, guest.astype(bool), (guest == 0) & (rest[row] >= spec.needed(2 * n[row]))


_LIST, _MARK = np.uint64(30), np.uint64((1 << 30) - 2)  # where a list's 34 bits begin, and the bits of a mark


def _marks(names: np.ndarray, key: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Short names in one number: the list, a mark of the member that is another one in each list, and ``least``."""
    names = names.view(np.uint64)
    mark = bs.mix(names ^ bs.mix(key.view(np.uint64))) & _MARK
    return names << _LIST | mark | least.astype(np.uint64)


def _spans(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last mark of each list, both with ``least`` if any of its marks has it."""
    marks = np.sort(marks)
    new = np.flatnonzero(np.append(True, marks[1:] >> _LIST != marks[:-1] >> _LIST))[: len(marks)]
    if not len(new):
        return marks, marks
    least = np.bitwise_or.reduceat(marks & np.uint64(1), new)
    return marks[new] | least, marks[np.append(new[1:], len(marks)) - 1] | least


def _shared_lists(prints: DataFrame, rows, buckets: int) -> np.ndarray:
    """Bitmap of the lists with two marks and with a member that may be the smaller one of a link.

    ``rows(list, key, n, rest)`` gives the marks. Tasks send two of a list at
    most at a time; a list's marks meet in a bucket.
    """

    def deal(marks: list[np.ndarray]) -> pa.RecordBatch:
        low, high = _spans(np.concatenate(marks))
        sent = np.concatenate([low, high[low != high]])
        bucket = (sent >> _LIST) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        bucket, sent = bucket[order], sent[order]
        new = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))[: len(sent)]
        blobs = [sent[x:y].tobytes() for x, y in zip(new, [*new[1:], len(sent)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[new].astype(np.int32)), pa.array(blobs, pa.binary())], names=["bucket", "marks"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for members in _unpack(batch):
                held.append(rows(*members))
                n += len(held[-1])
                if n > 1 << 20:
                    yield deal(held)
                    held, n = [], 0
        if n:
            yield deal(held)

    def meet(sent: pa.Table) -> pa.Table:
        low, high = _spans(np.frombuffer(b"".join(sent["marks"].to_pylist()), np.uint64))
        several = low[(low != high) & (low & np.uint64(1) == 1)]
        return pa.table({"key": (several >> _LIST).astype(np.int64)})

    sent = prints.where("lists is not null").select("key", "n", "lists", "rest").mapInArrow(send, "bucket int, marks binary")
    several = stored(sent.groupBy("bucket").applyInArrow(meet, "key long"), "ends")
    return _bitmap(several, several.count())


def _shared(prints: DataFrame, spec: JaccardJoin) -> DataFrame:
    """``list, key, n, rest, guest`` of the members of lists by size; nearly all lists have two classes or more.

    Most lists have one member. First the lists, then their parts by size are
    counted by short names; only members that two bitmaps let through are kept.
    """
    context = prints.sparkSession.sparkContext
    buckets = 64 + ((prints.agg(F.sum(F.length("lists"))).first()[0] or 0) >> 23)  # a million members in each

    def whole(names, key, n, rest):
        return _marks(names, key, rest >= spec.needed(2 * n))

    lists = context.broadcast(_shared_lists(prints, whole, buckets))

    def parts(names, key, n, rest):
        names, key, n, rest = (c[_inside(names, lists.value)] for c in (names, key, n, rest))
        row, cut, guest, least = _by_size(names, n, rest, spec)
        return cut, key[row], n[row].astype(np.int32), rest[row], guest, least

    def counted(names, key, n, rest):
        cut, key, _, _, _, least = parts(names, key, n, rest)
        return _marks(cut, key, least)

    cuts = context.broadcast(_shared_lists(prints, counted, buckets))

    def kept(names, key, n, rest):
        cut, key, n, rest, guest, _ = parts(names, key, n, rest)
        inside = _inside(cut, cuts.value)
        return {name: c[inside] for name, c in zip(("list", "key", "n", "rest", "guest"), (cut, key, n, rest, guest), strict=True)}

    return stored(_each_list(prints, kept, "list long, key long, n int, rest int, guest boolean"), "lists")


def _with_distance(pairs: DataFrame, classes: DataFrame, spec: JaccardJoin) -> DataFrame:
    """Pairs ``a, b`` that their parity bitmaps do not rule out, with the bitmaps' ``distance``."""

    @F.arrow_udf("int")
    def distance(na: pa.Array, x: pa.Array, nb: pa.Array, y: pa.Array) -> pa.Array:
        out = []
        for m, p, n, q in zip(na.to_pylist(), x.to_pylist(), nb.to_pylist(), y.to_pylist(), strict=True):
            d = parity_distance(p, q)
            out.append(d if d <= m + n - 2 * spec.needed(m + n) else None)
        return pa.array(out, pa.int32())

    one, two = (classes.select(F.col("key").alias(k), F.col("n").alias(f"n{k}"), F.col("parity").alias(f"p{k}")) for k in "ab")
    joined = pairs.join(one, "a").join(two, "b").where(100 * F.least("na", "nb") >= spec.percent * F.greatest("na", "nb"))
    return joined.select("a", "b", distance("na", "pa", "nb", "pb").alias("distance")).where("distance is not null")


def _chosen_keys(pairs: DataFrame) -> np.ndarray:
    """Bitmap with a bit for each class in ``pairs``."""
    return _bitmap(pairs.select(F.explode(F.array("a", "b")).alias("key")), 2 * pairs.count())


def _sets_of(pairs: DataFrame, documents: DataFrame, spec: JaccardJoin) -> DataFrame:
    """``key, shingles``, the whole sets of the classes in ``pairs``."""
    bitmap = documents.sparkSession.sparkContext.broadcast(_chosen_keys(pairs))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        bits = 64 * len(bitmap.value)
        for batch in batches:
            keys, sets = [], []
            for _, found in _sets(batch.column(0), spec):
                key = _key(found)
                if int(bitmap.value[key % bits >> 6]) >> (key & 63) & 1 and key not in seen:
                    if len(seen) > 1 << 20:
                        seen.clear()
                    seen.add(key)
                    keys.append(key)
                    sets.append(found.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], names=["key", "shingles"])

    found = documents.select("text").mapInArrow(chosen, "key long, shingles binary")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    return stored(found.join(needed, "key", "left_semi").dropDuplicates(["key"]), "sets")


def _proven(pairs: DataFrame, sets: DataFrame, spec: JaccardJoin) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are similar enough."""

    @F.arrow_udf("boolean")
    def similar(x: pa.Array, y: pa.Array) -> pa.Array:
        out = []
        for p, q in zip(x, y, strict=True):
            a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (p, q))
            both = np.sort(np.concatenate([a, b]))
            shared = int((both[1:] == both[:-1]).sum())
            out.append(100 * shared >= spec.percent * (len(both) - shared))
        return pa.array(out, pa.bool_())

    one, two = (sets.select(F.col("key").alias(k), F.col("shingles").alias(f"s{k}")) for k in "ab")
    two = two.join(pairs.select("b").distinct(), "b", "left_semi")
    return pairs.join(one, "a").join(two, "b").where(similar("sa", "sb")).select("a", "b")


def _mixed(lists: DataFrame, found: DataFrame) -> DataFrame:
    """``list, key, n, rest, guest, root`` of the members of lists whose members are not all in one component."""
    roots = stored(components(found), "roots")
    named = lists.drop("root").join(roots, lists["key"] == roots["node"], "left")
    named = stored(named.select("list", "key", "n", "rest", "guest", F.coalesce("root", "key").alias("root")), "named")
    mixed = stored(named.groupBy("list").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("list"), "mixed")
    return stored(named.join(mixed, "list", "left_semi"), "named")


def _open_pairs(named: DataFrame) -> tuple[int, int]:
    """Pairs of members of different components, over all lists, and the members."""
    parts = named.groupBy("list", "root").agg(F.count("*").cast("double").alias("c")).groupBy("list").agg(F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("q"))
    seen = parts.agg(F.sum((F.col("s") * F.col("s") - F.col("q")) / 2).alias("pairs"), F.sum("s").alias("members")).first()
    return int(seen.pairs or 0), int(seen.members or 0)


def _stars(lists: DataFrame, classes: DataFrame, spec: JaccardJoin, turn: int, centres: int, tests: int) -> DataFrame:
    """Pairs of a set ``a`` with the ``tests`` nearest ``b`` of the centres of its lists that lie in other components.

    Each list has up to ``centres`` of them, others in each turn.
    """
    home = F.when(~F.col("guest"), F.struct("key", "root"))
    picks = [F.min_by(home, F.when(~F.col("guest"), F.xxhash64("key", F.lit(turn), F.lit(k)))) for k in range(centres)]
    middles = lists.groupBy("list").agg(F.array_distinct(F.array(*picks)).alias("c"))
    middles = stored(middles.select("list", F.explode("c").alias("c")).select("list", F.col("c.key").alias("centre"), F.col("c.root").alias("other")), "centres")
    pairs = lists.join(middles, "list").where("root != other").select(F.col("key").alias("a"), F.col("centre").alias("b")).distinct()
    near = F.slice(F.sort_array(F.collect_list(F.struct("distance", "b"))), 1, tests)
    nearest = _with_distance(pairs, classes, spec).groupBy("a").agg(near.alias("s"))
    return stored(nearest.select("a", F.explode("s.b").alias("b")), "stars")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _remaining(named: DataFrame, classes: DataFrame, prints: DataFrame, spec: JaccardJoin) -> DataFrame:
    """Pairs ``a, b`` of members of different components of a list that sizes, places and coarse parities allow.

    A pair that shares many lists is made in the first few: ``n - rest`` is the
    number of shingles before the list's (before the last but one of a subset),
    and two of them in common already put the pair into an earlier list.
    """
    folds = [f"p{k}" for k in range(_WORDS)]
    heads = prints.where("parity is not null").select("key", "head").join(named.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    named = named.join(classes.select("key", *folds), "key").join(heads, "key")
    one, two = named.alias("x"), named.alias("y")
    difference = sum((F.bit_count(F.col(f"x.{p}").bitwiseXOR(F.col(f"y.{p}"))) for p in folds), F.lit(0))
    total = F.col("x.n") + F.col("y.n")
    need = F.ceil(spec.percent * total / F.lit(100 + spec.percent))
    may_link = (F.col("x.root") < F.col("y.root")) & ~(F.col("x.guest") & F.col("y.guest")) & (F.least("x.rest", "y.rest") >= need) & (difference <= total - 2 * need)
    ahead = [F.slice(F.col(f"{s}.head"), F.lit(1), F.col(f"{s}.n") - F.col(f"{s}.rest")) for s in "xy"]
    fresh = F.size(F.array_intersect(*ahead)) < 2
    pairs = one.join(two, (F.col("x.list") == F.col("y.list")) & may_link & fresh)
    return _ordered(pairs.select(F.col("x.key").alias("a"), F.col("y.key").alias("b"))).distinct()


def links(prints: DataFrame, documents: DataFrame, spec: JaccardJoin = JaccardJoin()) -> DataFrame:
    """Links ``a, b`` between classes that connect every component of similar sets."""
    classes = stored(prints.where("parity is not null").select("key", "n", "parity", *[f"p{k}" for k in range(_WORDS)]).dropDuplicates(["key"]), "classes")
    lists = _shared(prints, spec)
    tried = _stars(lists.withColumn("root", F.col("key")), classes, spec, 0, spec.centres, 1)
    sets = _sets_of(tried, documents, spec)
    found = stored(_proven(tried, sets, spec), "links")
    # More turns are held among the sets at hand.
    near, tried, turn = stored(lists.join(sets.select("key"), "key", "left_semi"), "near"), _ordered(tried), 0
    while True:
        near = _mixed(near, found)
        pairs, members = _open_pairs(near)
        if pairs <= members:
            break
        turn += 1
        stars = _stars(near, classes, spec, turn, 4 * spec.centres, 2 * spec.centres)
        proven = stored(_proven(stars, sets, spec), "links")
        found, tried = stored(found.unionByName(proven), "links"), tried.unionByName(_ordered(stars))
        if proven.count() <= spec.worth * stars.count():
            break  # other centres hardly help: what is left is mostly unlike
    pairs = _remaining(_mixed(lists, found), classes, prints, spec).join(tried, ["a", "b"], "left_anti")
    pairs = stored(_with_distance(pairs, classes, spec).select("a", "b"), "pairs")
    return found.unionByName(_proven(pairs, _sets_of(pairs, documents, spec), spec))


def similar_texts(documents: DataFrame, spec: JaccardJoin = JaccardJoin()) -> DataFrame:
    """``doc_id, n_shingles, component_id``, a row per row of ``documents``."""
    prints = stored(_prints(documents, _order(documents.select("text"), spec), spec), "prints")
    rows = prints.select("doc_id", "n", "key")
    roots = components(links(prints, documents, spec))
    classes = rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    classes = stored(classes.join(roots, classes["key"] == roots["node"], "left").select("key", "least", F.coalesce("root", "key").alias("root")), "classes")
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(classes.join(least, "root").select("key", "component_id"), "components")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return rows.where("n > 0").join(named, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)
