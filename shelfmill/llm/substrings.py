"""Removal of long byte strings that occur more than once.

A byte goes if it lies in a string of ``length`` bytes that starts at two or
more places of the corpus. Equality of heads of ``length`` bytes is what
counts, so suffixes are sorted by 64-bit fingerprints of their heads.

Texts are packed into blocks. The suffixes of a block are first sampled: each
head is represented by its anchor, the k-gram in it with the smallest hash, and
neighbouring heads with one anchor form a run. Equal heads have equal anchors
at equal places, so

* a run whose whole content occurs again is repeated as a whole,
* an anchor with one content everywhere settles its runs by that,
* of an anchor with several contents, at the edges of repeated passages, the
  heads are looked up one by one: those of runs that are not repeated as a
  whole, and of one run for each repeated content.

A lookup is an exchange of sorted key arrays. Every block deals its unique keys
by value over buckets, and a bucket keeps a logarithmic family of suffix
arrays: each arriving array is merge-scanned against the levels for equal
heads, then what is new becomes a level, and levels of about equal size merge.
A passage that a third of all texts share adds one key per block. A bucket
answers each block with bits.

Fingerprints have 64 bits, of which the buckets' number adds some; different
strings are taken for equal with a chance of about n * n / 2**65 for n keys
in one bucket.

Defined cases: null texts are empty; texts shorter than ``length`` lose
nothing. Equal rows are separate texts, so each finds the other. Extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmill.llm import bytescan as bs
from shelfmill.session import stored


@dataclass(frozen=True)
class Repeats:
    length: int = 200
    gram: int = 64
    block: int = 1 << 20  # bytes of text in a block
    least_buckets: int = 64
    bucket_keys: int = 1 << 20  # keys that one bucket holds on average


_LOW = np.uint64(0xFFFFFFFF)


def _window_starts(offsets: np.ndarray, length: int) -> np.ndarray:
    """Mask of the places where a head lies inside its text."""
    n = int(offsets[-1])
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)
    return room >= length


def _runs(data: np.ndarray, offsets: np.ndarray, spec: Repeats):
    """Heads of a block in runs of one anchor: first and last head, keys of anchor and content, hashes."""
    hashes = bs.byte_hash(data)
    none = np.zeros(0, np.int64)
    if len(data) < spec.length:
        return none, none, none.astype(np.uint64), none.astype(np.uint64), hashes
    grams = hashes.rolling(spec.gram)
    # Smallest hash, the rightmost of equal ones: content alone decides.
    ranked = (grams & ~_LOW) | (_LOW - np.arange(len(grams), dtype=np.uint64))
    least = bs.sliding_min(ranked, spec.length - spec.gram + 1)
    anchor = (_LOW - (least & _LOW)).astype(np.int64)
    heads = np.flatnonzero(_window_starts(offsets, spec.length)[: len(anchor)])
    if not len(heads):
        return none, none, none.astype(np.uint64), none.astype(np.uint64), hashes
    at = anchor[heads]
    fresh = np.append(True, (at[1:] != at[:-1]) | (heads[1:] != heads[:-1] + 1))
    first = np.flatnonzero(fresh)
    a, b = heads[first], heads[np.append(first[1:], len(heads)) - 1]
    return a, b, grams[at[first]], hashes(a, b + spec.length), hashes


class _Block:
    def __init__(self, lengths: list[int], packed: bytes):
        self.offsets = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64))]).astype(np.int64)
        self.data = np.frombuffer(zstandard.decompress(packed) if packed else b"", np.uint8)


def pack(documents: DataFrame, spec: Repeats) -> DataFrame:
    """``block, doc_ids, lengths, packed``: texts in blocks, stored so that each keeps its number."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids = batch.column(0)
            for first, last, data, offsets in bs.blocks(batch.column(1), spec.block):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids.slice(first, last - first).to_pylist()], pa.list_(ids.type)),
                        pa.array([np.diff(offsets).tolist()], pa.list_(pa.int64())),
                        pa.array([packer.compress(data.tobytes())], pa.binary()),
                    ],
                    names=["doc_ids", "lengths", "packed"],
                )

    made = documents.select("doc_id", "text").mapInArrow(build, f"doc_ids array<{kind}>, lengths array<long>, packed binary")
    return stored(made.withColumn("block", F.monotonically_increasing_id()), "blocks")


_KEYS = "block long, bucket int, keys binary, values binary"
_KEY_TYPE = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("keys", pa.binary()), ("values", pa.binary())])


class _Dealt:
    """Unique keys of a block dealt by value over buckets numbered from ``first``.

    Work and memory go by the keys, not by the number of buckets.
    """

    def __init__(self, keys: np.ndarray, buckets: int, first: int = 0):
        bucket = (keys >> np.uint64(40)) % np.uint64(buckets)
        self._order = np.argsort(bucket, kind="stable")
        present, starts = np.unique(bucket[self._order], return_index=True)
        self._parts = list(zip((present.astype(np.int64) + first).tolist(), np.split(self._order, starts[1:]), strict=True)) if len(keys) else []
        self._keys = keys

    def rows(self, block: int, values: np.ndarray | None = None) -> list[dict]:
        return [{"block": block, "bucket": k, "keys": self._keys[o].tobytes(), "values": None if values is None else values[o].tobytes()} for k, o in self._parts]

    def answers(self, answers: dict[int, tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Which keys came more than once, and which were the first of their kind."""
        out = np.zeros((2, len(self._keys)), bool)
        for k, o in self._parts:
            for row, bits in zip(out, answers[k], strict=True):
                row[o] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(o))
        return out[0], out[1]


class SuffixLevels:
    """Logarithmic family of sorted key arrays.

    Without values, finds keys that come more than once; with values, keys
    that come with different ones. A value of zero differs from all.
    """

    def __init__(self, total: int):
        self._marked = np.zeros(total, bool)  # by number of arrival
        self._owner = np.arange(total)  # the first entry with the same key
        self._levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    @property
    def marked(self) -> np.ndarray:
        return self._marked[self._owner]

    @property
    def first(self) -> np.ndarray:
        return self._owner == np.arange(len(self._owner))

    def add(self, keys: np.ndarray, number: int, values: np.ndarray | None = None) -> None:
        """Scan unique keys, numbered from ``number``, against all levels and add the new ones."""
        order = np.argsort(keys, kind="stable")
        new = (keys[order], number + order, np.zeros(len(keys), np.uint64) if values is None else values[order])
        if values is not None:
            self._marked[new[1][new[2] == 0]] = True
        for level, owner, held in self._levels:
            at = np.minimum(np.searchsorted(level, new[0]), len(level) - 1)
            known = level[at] == new[0]
            first = owner[at[known]]
            self._owner[new[1][known]] = first
            differs = (held[at[known]] != new[2][known]) | (new[2][known] == 0)
            self._marked[first[differs]] = True
            new = tuple(x[~known] for x in new)
        if not len(new[0]):
            return
        self._levels.append(new)
        while len(self._levels) > 1 and len(self._levels[-2][0]) <= 2 * len(self._levels[-1][0]):
            last, before = self._levels.pop(), self._levels.pop()
            both = [np.concatenate(x) for x in zip(before, last, strict=True)]
            order = np.argsort(both[0], kind="stable")
            self._levels.append(tuple(x[order] for x in both))


def _look_up(keys: DataFrame) -> DataFrame:
    """``_b, answers``: for each block and bucket two bits a key, see ``_Dealt.answers``."""

    def scan(rows: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(x, np.uint64) for x in rows.column("keys").to_pylist()]
        values = [None if x is None else np.frombuffer(x, np.uint64) for x in rows.column("values").to_pylist()]
        cuts = np.concatenate([[0], np.cumsum([len(b) for b in blobs])]).tolist()
        levels = SuffixLevels(cuts[-1])
        for k in np.argsort(rows.column("block").to_numpy(), kind="stable").tolist():
            levels.add(blobs[k], cuts[k], values[k])
        bits = [[np.packbits(x[a:b]).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)] for x in (levels.marked, levels.first)]
        return pa.table({"block": rows.column("block"), "bucket": rows.column("bucket"), "marked": pa.array(bits[0], pa.binary()), "first": pa.array(bits[1], pa.binary())})

    found = keys.groupBy("bucket").applyInArrow(scan, "block long, bucket int, marked binary, first binary")
    return found.groupBy(F.col("block").alias("_b")).agg(F.collect_list(F.struct("bucket", "marked", "first")).alias("answers"))


def _by_bucket(answers: list[dict] | None) -> dict[int, tuple[bytes, bytes]]:
    return {a["bucket"]: (a["marked"], a["first"]) for a in answers or []}


class _RunKeys:
    """Keys of a block's runs: unique contents, and unique anchors with their content if it is one."""

    def __init__(self, grams: np.ndarray, contents: np.ndarray, buckets: int):
        self.contents, self._c, n = np.unique(bs.mix(contents), return_inverse=True, return_counts=True)
        self._several = n > 1
        _, at = np.unique(self._c, return_index=True)
        self._leads = np.zeros(len(contents), bool)
        self._leads[at] = True  # first run of its content in the block
        self.anchors, self._a = np.unique(bs.mix(grams ^ _LOW), return_inverse=True)
        low, high = np.full(len(self.anchors), len(self.contents)), np.full(len(self.anchors), -1)
        np.minimum.at(low, self._a, self._c)
        np.maximum.at(high, self._a, self._c)
        self.values = np.where(low == high, self.contents[np.minimum(low, len(self.contents) - 1)] | np.uint64(1), np.uint64(0)) if len(low) else np.zeros(0, np.uint64)
        self.dealt_contents = _Dealt(self.contents, buckets)
        self.dealt_anchors = _Dealt(self.anchors, buckets, buckets)

    def judged(self, answers: dict[int, tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Runs that are repeated as a whole, and runs whose heads must be looked up.

        Anchors of one content everywhere need no look-up. Of others, all runs
        take part that are not repeated as a whole, and one of each content.
        """
        repeated, first = self.dealt_contents.answers(answers)
        mixed, _ = self.dealt_anchors.answers(answers)
        whole = (repeated | self._several)[self._c]
        leads = self._leads & first[self._c]
        return whole, mixed[self._a] & (leads | ~whole)


def covered_bytes(documents: DataFrame, spec: Repeats = Repeats()) -> tuple[DataFrame, dict]:
    """Blocks with, for each, the mask of bytes that go; see ``remove_repeats``."""
    blocks = pack(documents, spec)
    total = blocks.agg(F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x)), F.lit(0)).alias("n")).first().n
    buckets = max(spec.least_buckets, -(-2 * total // (spec.length - spec.gram) * 2 // spec.bucket_keys))

    def run_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row["lengths"], row["packed"])
                keys = _RunKeys(*_runs(block.data, block.offsets, spec)[2:4], buckets)
                yield _rows(keys.dealt_contents.rows(row["block"]) + keys.dealt_anchors.rows(row["block"], keys.values))

    runs = _look_up(blocks.mapInArrow(run_keys, _KEYS))

    def head_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row["lengths"], row["packed"])
                a, b, grams, contents, hashes = _runs(block.data, block.offsets, spec)
                whole, asked = _RunKeys(grams, contents, buckets).judged(_by_bucket(row["answers"]))
                sure = bs.covered(a[whole], b[whole] + 1 - a[whole], len(block.data))
                maybe = bs.covered(a[asked], b[asked] + 1 - a[asked], len(block.data))
                heads = np.flatnonzero(maybe)
                state = zstandard.compress(np.concatenate([np.packbits(sure), np.packbits(maybe)]).tobytes())
                keys = np.unique(hashes(heads, heads + spec.length))
                whole_block = [{"block": row["block"], "bucket": bucket, "keys": blob, "values": None} for bucket, blob in ((-1, state), (0, keys.tobytes()))]
                yield _rows(whole_block if len(keys) else whole_block[:1])

    joined = blocks.join(runs, blocks.block == runs._b, "left").select("block", "lengths", "packed", "answers")
    heads = stored(joined.mapInArrow(head_keys, _KEYS), "heads")
    n_heads = heads.where("bucket = 0").agg(F.coalesce(F.sum(F.octet_length("keys")), F.lit(0)).alias("n")).first().n // 8
    head_buckets = max(spec.least_buckets, -(-n_heads // spec.bucket_keys))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _rows(_Dealt(np.frombuffer(row["keys"], np.uint64), head_buckets).rows(row["block"]))

    states = heads.where("bucket = -1").select(F.col("block").alias("_s"), F.col("keys").alias("state"))
    answers = _look_up(heads.where("bucket = 0").mapInArrow(deal, _KEYS))
    joined = states.join(answers, states._s == answers._b, "left").select("_s", "state", "answers")
    return blocks.join(joined, blocks.block == joined._s).drop("_s"), {"buckets": buckets, "head_buckets": head_buckets}


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_KEY_TYPE)


def remove_repeats(documents: DataFrame, spec: Repeats = Repeats(), texts: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``, a row per row of ``documents``.

    ``kept`` holds the remaining bytes (null without ``texts``); they need not
    be whole characters.
    """
    found, plan = covered_bytes(documents, spec)
    buckets = plan["head_buckets"]
    kind = documents.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_type = batch.schema.field("doc_ids").type.value_type
            for row in batch.to_pylist():
                block = _Block(row["lengths"], row["packed"])
                n = len(block.data)
                bits = np.frombuffer(zstandard.decompress(row["state"]), np.uint8)
                half = len(bits) // 2
                repeated = np.unpackbits(bits[:half], count=n).astype(bool)
                heads = np.flatnonzero(np.unpackbits(bits[half:], count=n))
                if len(heads):
                    keys, own, count = np.unique(bs.byte_hash(block.data)(heads, heads + spec.length), return_inverse=True, return_counts=True)
                    marked, _ = _Dealt(keys, buckets).answers(_by_bucket(row["answers"]))
                    repeated[heads[(marked | (count > 1))[own]]] = True
                at = np.flatnonzero(repeated)
                gone = bs.covered(at, np.full(len(at), spec.length), n)
                rows = []
                for doc, lo, hi in zip(row["doc_ids"], block.offsets[:-1].tolist(), block.offsets[1:].tolist(), strict=True):
                    own = gone[lo:hi]
                    left = block.data[lo:hi][~own].tobytes()
                    spans = int(own[:1].sum()) + int((own[1:] & ~own[:-1]).sum())
                    rows.append((doc, hi - lo, int(own.sum()), spans, hashlib.sha256(left).hexdigest(), left if texts else None))
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
                types = [id_type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], types[k]) for k in range(6)], names=names)

    columns = found.select("doc_ids", "lengths", "packed", "state", "answers")
    return columns.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
