"""Hard negatives by a branch-and-bound scan over decomposed vectors.

Vectors are rounded to integers, ``floor(scale * x)``, and rows are scored by
their integer inner product with an anchor. An anchor's positives are the best
rows of its own label; around each positive's score lies a window, and the best
rows of other labels inside it are the anchor's hard negatives.

Tasks turn their rows into blocks of columns, one array for each dimension with
its least and greatest value. For an anchor the dimensions are read in the
descending order of its magnitudes. After each few of them the least and the
greatest contribution that the unread ones can still make bound every row's
score, and rows that no open window can take leave the candidate bitmap. What
is left at the end has exact scores.

Anchors go out in waves of at most ``wave_bytes``, so neither the driver nor a
task holds more of them than that; each wave reads all rows twice, first for
the positives, then for the windows. A wave's result is written before the next
one starts.

Defined cases: rows without an id or label, with a null vector or a null or
non-finite component take no part; rounded components are held within 2**23 of
zero. Vectors of different lengths meet as if the shorter one went on with
zeros. Equal scores go by id. A row with the anchor's id is never its positive;
other repeated rows count each time; a repeated anchor is mined once. Anchors
without positives or with empty windows give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfmill.session import ensure_checkpoint_dir, stored

_LIMIT = float(1 << 23)


@dataclass(frozen=True)
class HardNegatives:
    scale: float = 256.0
    positives: int = 5
    negatives: int = 10
    low_percent: int = 30  # window around a positive's score, ends included
    high_percent: int = 90
    block_rows: int = 16384
    first_dimensions: int = 8  # read before the first bounds; each later step reads as many as all before it
    wave_bytes: int = 16 << 20  # anchors that are sent out at once


@dataclass
class Vectors:
    """Valid rows of a batch: ids, labels and a matrix of rounded components."""

    ids: np.ndarray
    labels: np.ndarray
    matrix: np.ndarray  # rows x dimensions

    @staticmethod
    def read(batch: pa.RecordBatch, scale: float) -> Vectors:
        ids, vectors, labels = (batch.column(k) for k in range(3))
        some = ids.is_valid().to_numpy(zero_copy_only=False) & labels.is_valid().to_numpy(zero_copy_only=False) & vectors.is_valid().to_numpy(zero_copy_only=False)
        keep = np.flatnonzero(some)
        vectors = vectors.take(pa.array(keep))
        values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null becomes not-a-number
        sizes = np.diff(vectors.offsets.to_numpy())
        row = np.repeat(np.arange(len(keep)), sizes)
        sound = np.bincount(row, ~np.isfinite(values), minlength=len(keep)) == 0
        starts = np.cumsum(sizes) - sizes
        matrix = np.zeros((len(keep), int(sizes.max(initial=0))))
        with np.errstate(over="ignore", invalid="ignore"):
            matrix[row, np.arange(len(values)) - starts[row]] = np.clip(np.floor(scale * values), -_LIMIT, _LIMIT)
        ids, labels = (x.take(pa.array(keep)).to_numpy(zero_copy_only=False).astype(np.int64) for x in (ids, labels))
        return Vectors(ids[sound], labels[sound], matrix[sound])

    @staticmethod
    def join(parts: list[Vectors]) -> Vectors:
        width = max((p.matrix.shape[1] for p in parts), default=0)
        wide = [np.pad(p.matrix, ((0, 0), (0, width - p.matrix.shape[1]))) for p in parts]
        return Vectors(*(np.concatenate(x) if parts else np.zeros(0, np.int64) for x in ([p.ids for p in parts], [p.labels for p in parts])), np.concatenate(wide) if parts else np.zeros((0, 0)))


class Columns:
    """A block of rows by dimension, rows of a label next to each other."""

    def __init__(self, rows: Vectors):
        order = np.lexsort((rows.ids, rows.labels))
        self.ids, self.labels = rows.ids[order], rows.labels[order]
        self.columns = np.ascontiguousarray(rows.matrix[order].T)
        self.least, self.most = (f(axis=1, initial=0) for f in (self.columns.min, self.columns.max))

    def span(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label, "left")), int(np.searchsorted(self.labels, label, "right"))

    def values(self, dimensions: np.ndarray, rows: np.ndarray) -> np.ndarray:
        whole = self.columns[dimensions]
        return whole if len(rows) == whole.shape[1] else whole[:, rows]


@dataclass
class Best:
    """The best rows found so far inside a window of scores."""

    low: float
    high: float
    wanted: int
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def floor(self) -> float:
        """Scores below it cannot enter any more."""
        return self.low if len(self.scores) < self.wanted else max(self.low, self.scores[-1])

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        inside = (scores >= self.floor) & (scores <= self.high)
        scores, ids = np.append(self.scores, scores[inside]), np.append(self.ids, ids[inside])
        order = np.lexsort((ids, -scores))[: self.wanted]
        self.scores, self.ids = scores[order], ids[order]


def scan(block: Columns, anchor: np.ndarray, rows: np.ndarray, windows: list[Best], spec: HardNegatives) -> int:
    """Bring the candidates ``rows`` of a block into the windows; returns how many components were read."""
    width = min(len(anchor), len(block.columns))
    anchor = anchor[:width]
    exact = np.abs(anchor).sum() * max(np.abs(block.least).max(initial=0), block.most.max(initial=0)) < 2**53
    kind = np.float64 if exact else np.int64  # products beyond a double's whole numbers need the slower one
    order = np.argsort(-np.abs(anchor), kind="stable")
    order = order[anchor[order] != 0]
    weights = anchor[order].astype(kind)
    ends = weights * block.least[:width][order].astype(kind), weights * block.most[:width][order].astype(kind)
    rest_low, rest_high = (np.append(np.cumsum(f(*ends)[::-1])[::-1], 0) for f in (np.minimum, np.maximum))
    score, read, done = np.zeros(len(rows), kind), 0, 0
    while len(rows):
        lowest, highest = score + rest_low[done], score + rest_high[done]
        alive = np.zeros(len(rows), bool)
        for window in windows:
            bar = window.floor
            if len(rows) > 8 * window.wanted:  # rows sure to be inside raise the bar for the others
                sure = lowest[(lowest >= window.low) & (highest <= window.high)]
                if len(sure) >= window.wanted:
                    bar = max(bar, np.partition(sure, len(sure) - window.wanted)[len(sure) - window.wanted])
            alive |= (highest >= bar) & (lowest <= window.high)
        if not alive.all():
            rows, score = rows[alive], score[alive]
        if done == len(order):
            break
        some = order[done : max(spec.first_dimensions, 2 * done)]
        score = score + weights[done : done + len(some)] @ block.values(some, rows).astype(kind, copy=False)
        read += len(some) * len(rows)
        done += len(some)
    for window in windows:
        window.add(score, block.ids[rows])
    return read


def _blocks(batches: Iterator[pa.RecordBatch], spec: HardNegatives) -> Iterator[Columns]:
    parts, n = [], 0
    for batch in batches:
        for first in range(0, batch.num_rows, spec.block_rows):
            parts.append(Vectors.read(batch.slice(first, spec.block_rows), spec.scale))
            n += len(parts[-1].ids)
            if n >= spec.block_rows:
                yield Columns(Vectors.join(parts))
                parts, n = [], 0
    if n:
        yield Columns(Vectors.join(parts))


def _positives(rows: DataFrame, anchors, spec: HardNegatives) -> DataFrame:
    """``anchor, id, score``: the best rows of each anchor's label."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = anchors.value
        found = [Best(-np.inf, np.inf, spec.positives) for _ in own.ids]
        for block in _blocks(batches, spec):
            for k, (i, label, vector) in enumerate(zip(own.ids, own.labels, own.matrix, strict=True)):
                candidates = np.arange(*block.span(label))
                scan(block, vector, candidates[block.ids[candidates] != i], [found[k]], spec)
        sizes = [len(x.ids) for x in found]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(found)), sizes)), pa.array(np.concatenate([x.ids for x in found])), pa.array(np.concatenate([x.scores for x in found]).astype(np.int64))], names=["anchor", "id", "score"])

    each = rows.mapInArrow(search, "anchor long, id long, score long")
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    return each.withColumn("slot", F.row_number().over(best)).where(F.col("slot") <= spec.positives)


def _negatives(rows: DataFrame, anchors, windows, spec: HardNegatives) -> DataFrame:
    """``anchor, low, high, id, score, rank``: the best rows of other labels in each window of an anchor."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = anchors.value
        found = {a: [Best(low, high, spec.negatives) for low, high in ranges] for a, ranges in windows.value.items()}
        for block in _blocks(batches, spec):
            for a, best in found.items():
                first, last = block.span(own.labels[a])
                candidates = np.append(np.arange(first), np.arange(last, len(block.ids)))
                scan(block, own.matrix[a], candidates, best, spec)
        flat = [(a, x) for a, best in found.items() for x in best]
        sizes = [len(x.ids) for _, x in flat]
        if sum(sizes):
            named = (np.repeat(np.array(v, np.int64), sizes) for v in ([a for a, _ in flat], [x.low for _, x in flat], [x.high for _, x in flat]))
            values = (np.concatenate([x.ids for _, x in flat]), np.concatenate([x.scores for _, x in flat]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (*named, *values)], names=["anchor", "low", "high", "id", "score"])

    each = rows.mapInArrow(search, "anchor long, low long, high long, id long, score long")
    best = Window.partitionBy("anchor", "low", "high").orderBy(F.desc("score"), "id")
    return each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= spec.negatives)


def mine(vectors: DataFrame, is_anchor: Column, spec: HardNegatives = HardNegatives()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` over ``vectors(vec_id, embedding, label)``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label"), is_anchor.alias("is_anchor"))
    chosen = stored(rows.where("is_anchor and vec_id is not null and label is not null and embedding is not null").drop("is_anchor").distinct(), "anchors")
    size = chosen.agg(F.sum(8 * F.size("embedding") + 16).alias("n")).first().n or 0
    waves = -(-size // spec.wave_bytes)
    wave = F.pmod(F.xxhash64("vec_id", "label", "embedding"), F.lit(max(waves, 1)))
    rows = rows.drop("is_anchor")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/hard-negatives-{uuid.uuid4().hex}"
    kind = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], kind).write.parquet(f"{base}/wave=-1")
    for k in range(waves):
        own = Vectors.join([Vectors.read(b, spec.scale) for b in chosen.where(wave == k).toArrow().to_batches()])  # at most wave_bytes
        anchors = spark.sparkContext.broadcast(own)
        pairs = _positives(rows, anchors, spec).toArrow()  # a few numbers for each anchor of the wave
        score = pairs["score"].to_numpy()
        low, high = -(-score * spec.low_percent // 100), score * spec.high_percent // 100
        windows: dict[int, set] = {}
        for a, x, y in zip(pairs["anchor"].to_pylist(), low.tolist(), high.tolist(), strict=True):
            if x <= y:
                windows.setdefault(a, set()).add((x, y))
        sent = spark.sparkContext.broadcast({a: sorted(w) for a, w in windows.items()})
        told = [pa.array(v) for v in (pairs["anchor"].to_numpy(), own.ids[pairs["anchor"].to_numpy()], pairs["id"].to_numpy(), score, low, high)]
        told = spark.createDataFrame(pa.Table.from_arrays(told, names=["anchor", "anchor_id", "positive_id", "positive_score", "low", "high"]))
        found = _negatives(rows, anchors, sent, spec).join(F.broadcast(told), ["anchor", "low", "high"])
        found = found.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        found.write.parquet(f"{base}/wave={k}")
        anchors.unpersist()
        sent.unpersist()
    return spark.read.schema(kind).parquet(*[f"{base}/wave={k}" for k in range(-1, waves)])
