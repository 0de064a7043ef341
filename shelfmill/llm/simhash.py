"""Near-duplicates by SimHash fingerprints, linked through vantage-point trees.

A fingerprint has a bit for each bit position that is set in over half of the
hashes of a text's word shingles. Texts link if their fingerprints differ in
at most ``bits`` bits, 3 by default; linked texts form components.

Only distinct fingerprints are compared. They are dealt into shards by Hamming
distance inside parts of the fingerprint: of four parts, a pair within three
bits has one without a difference, and the same holds for four parts of the
rest, so with the parts themselves as vantage points the branch bound is zero
and a pair always meets in one of 16 shards. In a shard, pairs are found with
a vantage-point tree over the whole fingerprint: fingerprints are split at the
median distance from a vantage point, and a branch is skipped where the
triangle inequality puts all its fingerprints out of reach; those near the
boundary are looked up on both sides. A shard of more than ``shard`` distinct
fingerprints is dealt again by four parts of its remaining bits. A shard
returns a spanning forest of its links, not all pairs.

Defined cases: null and word-less texts have fingerprint zero and link like
any other. Rows are kept as they are, also repeated ones; a null doc_id never
becomes a component id unless the whole component has none.
"""

from __future__ import annotations

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
class SimHash:
    shingle: int = 3
    seed: int = 42
    bits: int = 3
    leaf: int = 64  # fingerprints that are compared directly
    shard: int = 4096  # distinct fingerprints of a shard before it is dealt again


def _fingerprint(words: list[bytes], spec: SimHash) -> int:
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    n = min(spec.shingle, len(words))
    digest, seed = xxhash.xxh64_intdigest, spec.seed
    spans = zip(starts[: len(words) - n + 1].tolist(), (ends[n - 1 :] - 1).tolist(), strict=True)
    hashes = np.array([digest(joined[s:e], seed) for s, e in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[part : part + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column | str, spec: SimHash = SimHash()) -> Column:
    """SimHash of a text as a signed 64-bit number."""

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        out = []
        for _, _, data, offsets in bs.blocks(texts):
            lowered = bs.lower_ascii(data).tobytes()
            cuts = offsets.tolist()
            out.extend(_fingerprint(lowered[a:b].split(), spec) for a, b in zip(cuts, cuts[1:], strict=False))
        return pa.array(np.array(out, np.uint64).view(np.int64))

    return simhash(text)


def _parts(bits: list[int]) -> list[list[int]]:
    """Four runs of bit positions, as even as they get."""
    cuts = [round(len(bits) * k / 4) for k in range(5)]
    return [bits[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def _masks(depth: int) -> list[int]:
    """Bit masks of all shards' keys after ``depth`` choices of a part."""
    found = [[]]
    for _ in range(depth):
        found = [kept + part for kept in found for part in _parts([b for b in range(64) if b not in kept])]
    return [sum(1 << b for b in kept) for kept in found]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _forest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest member of each node's component, given links and earlier labels."""
    label = np.arange(n) if label is None else label
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        if (before == label).all():
            return label


def vantage_links(points: np.ndarray, spec: SimHash) -> np.ndarray:
    """Component label of each of the distinct ``points`` under links of at most ``spec.bits`` bits."""
    label = np.arange(len(points))
    pending: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> None:
        nonlocal label
        if pending:
            label = _forest(len(points), np.concatenate([p[0] for p in pending]), np.concatenate([p[1] for p in pending]), label)
            pending.clear()

    def compare(data: np.ndarray, queries: np.ndarray) -> None:
        for part in range(0, len(queries), 1024):
            q = queries[part : part + 1024]
            x, y = np.nonzero(_distances(points[q][:, None], points[data][None, :]) <= spec.bits)
            pending.append((q[x], data[y]))
            if sum(len(p[0]) for p in pending) > 1 << 18:
                flush()

    todo = [(np.arange(len(points)), np.arange(len(points)))]
    while todo:
        data, queries = todo.pop()
        if not len(data) or not len(queries):
            continue
        if len(data) <= spec.leaf:
            compare(data, queries)
            continue
        vantage = points[data[0]]
        d, q = _distances(points[data], vantage).astype(np.int64), _distances(points[queries], vantage).astype(np.int64)
        border = int(np.median(d))
        if (d <= border).all():
            border -= 1
        near, far = data[d <= border], data[d > border]
        to_near, to_far = queries[q <= border + spec.bits], queries[q > border - spec.bits]
        if len(near) * len(to_near) + len(far) * len(to_far) > 0.95 * len(data) * len(queries):
            for part in range(0, len(data), 4096):  # no vantage point tells them apart
                compare(data[part : part + 4096], queries)
            continue
        todo += [(near, to_near), (far, to_far)]
    flush()
    return label


def _small_groups(keys: np.ndarray, points: np.ndarray, spec: SimHash) -> tuple[np.ndarray, np.ndarray]:
    """Links among sorted small groups: each point with the ones after it in its group."""
    a, b = [points[:0]], [points[:0]]
    for lag in range(1, spec.leaf):
        same = keys[lag:] == keys[:-lag]
        if not same.any():
            break
        i = np.flatnonzero(same)
        i = i[_distances(points[i], points[i + lag]) <= spec.bits]
        a.append(points[i])
        b.append(points[i + lag])
    return np.concatenate(a), np.concatenate(b)


_OUT = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("again", pa.bool_())])


def _search(batches: Iterator[pa.RecordBatch], spec: SimHash, last_level: bool) -> Iterator[pa.RecordBatch]:
    """Links of the shards in a partition sorted by shard; or the members of shards to deal again."""

    def out(a, b, again: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(a).view(np.int64)), pa.array(np.asarray(b).view(np.int64)), pa.array(np.full(len(a), again))], schema=_OUT)

    def finish(keys: np.ndarray, points: np.ndarray) -> Iterator[pa.RecordBatch]:
        heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(heads, len(keys)))
        small = np.repeat(sizes <= spec.leaf, sizes)
        a, b = _small_groups(keys[small], points[small], spec)
        if len(a):
            yield out(a, b, False)
        for head, size in zip(heads[sizes > spec.leaf].tolist(), sizes[sizes > spec.leaf].tolist(), strict=True):
            group = points[head : head + size]
            if size > spec.shard and not last_level:
                yield out(group, group, True)
                continue
            label = vantage_links(group, spec)
            linked = np.flatnonzero(label != np.arange(size))
            if len(linked):
                yield out(group[linked], group[label[linked]], False)

    keys, points = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    passing = None  # shard that is already known to be dealt again
    for batch in batches:
        k = batch.column("shard").to_numpy(zero_copy_only=False)
        p = batch.column("point").to_numpy(zero_copy_only=False).view(np.uint64)
        if passing is not None:
            through = k == passing
            if through.any():
                yield out(p[through], p[through], True)
            k, p = k[~through], p[~through]
            if len(k):
                passing = None
        keys, points = np.concatenate([keys, k]), np.concatenate([points, p])
        if not len(keys):
            continue
        open_from = int(np.searchsorted(keys == keys[-1], True)) if keys[0] != keys[-1] else 0
        if open_from:
            yield from finish(keys[:open_from], points[:open_from])
            keys, points = keys[open_from:], points[open_from:]
        if len(keys) > spec.shard and not last_level:
            passing = keys[0]
            yield out(points, points, True)
            keys, points = keys[:0], points[:0]
    if len(keys):
        yield from finish(keys, points)


def links(points: DataFrame, spec: SimHash = SimHash()) -> DataFrame:
    """``a, b``: a spanning forest of the links of each shard of distinct ``points(point)``."""
    if spec.bits > 3:
        raise ValueError("shards are made for links of at most 3 bits")
    found, depths = None, (2, 3, 4)
    for depth in depths:
        last = depth == depths[-1]
        keys = F.array(*[F.xxhash64(F.lit(k), F.col("point").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m))) for k, m in enumerate(_masks(depth))])
        dealt = points.select("point", F.explode(keys).alias("shard")).repartition("shard").sortWithinPartitions("shard", "point")

        def search(batches, last=last):
            return _search(batches, spec, last)

        done = stored(dealt.mapInArrow(search, "a long, b long, again boolean"), "links")
        part = done.where(~F.col("again")).select("a", "b")
        found = part if found is None else found.unionByName(part)
        again = done.where("again").select(F.col("a").alias("point")).distinct()
        if last or not again.take(1):
            return found
        points = again
    return found


def near_duplicates(documents: DataFrame, spec: SimHash = SimHash()) -> DataFrame:
    """``doc_id, text_key, fingerprint, component_id``, a row per row of ``documents``."""
    prints = stored(
        documents.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), fingerprint("text", spec).alias("fingerprint")), "fingerprints"
    )
    nodes = stored(prints.groupBy(F.col("fingerprint").alias("point")).agg(F.min("doc_id").alias("least")), "points")
    roots = components(links(nodes.select("point"), spec))
    labelled = nodes.join(roots, nodes.point == roots.node, "left").select("point", "least", F.coalesce("root", "point").alias("root"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    named = labelled.select("point", "root").join(least, "root").select(F.col("point").alias("_p"), "component_id")
    return prints.join(named, prints.fingerprint == named._p, "left").select("doc_id", "text_key", "fingerprint", "component_id")


def keep_one(documents: DataFrame, spec: SimHash = SimHash()) -> DataFrame:
    """One row of each component, all columns kept: the one with the smallest doc_id.

    Ties between rows of one doc_id go to the smallest hash of the text; of
    equal rows any one stays.
    """
    members = near_duplicates(documents, spec)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    # A component whose rows all lack a doc_id is named by its fingerprints' root, so group by both.
    counted = members.groupBy("component_id", "doc_id", "text_key", F.when(F.col("component_id").isNull(), F.col("fingerprint")).alias("f")).agg(F.count("*").alias("n"))
    first = counted.groupBy("component_id", "f").agg(F.min_by(F.struct("doc_id", "text_key", "n"), order).alias("w")).select(F.col("w.doc_id").alias("_d"), F.col("w.text_key").alias("_k"), F.col("w.n").alias("_n"))
    # The row travels as one struct, so that its columns' names cannot clash with the others.
    whole = documents.select(F.struct(*[documents[c] for c in documents.columns]).alias("row"), F.xxhash64(F.coalesce(documents["text"], F.lit(""))).alias("key"))
    kept = whole.join(first, whole["row.doc_id"].eqNullSafe(first["_d"]) & (whole["key"] == first["_k"]))
    single = kept.where("_n = 1").select("row.*")
    # Equal rows are rare: only they are brought together.
    repeated = kept.where("_n > 1").dropDuplicates(["_d", "_k"]).select("row.*")
    return single.unionByName(repeated)
