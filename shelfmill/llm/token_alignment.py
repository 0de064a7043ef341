"""Alignment of the tokens that two tokenizers make of one text.

Both tokenizers cut a text's bytes into tokens. Places where tokens of both end
cut the text into groups, and every pair of tokens inside a group is linked.

Groups come by divide and conquer: in an interval of tokens a common end is
located near the middle, by bisecting the ends of the one tokenizer for those
of the other, first the middle one, then twice as many around it each time;
both halves are cut in the same way, and an interval without a common end is a
group. All intervals of a block of texts take each step together, so a block
needs as many steps as the logarithm of its longest text, not as it has tokens.

Neither tokenizer has a token that goes on over a single space between two
other characters, so the stretches between such spaces are encoded on their own
and a task encodes equal stretches once; it forgets all when ``remembered``
characters are kept. A vocabulary with such tokens is found when it is loaded,
and its texts are encoded whole.

``counted`` tells for each pair of token ids how many texts link it, over all
texts. Its frequent part, at most ``frequent`` pairs, is sent to the tasks, and
with it the highest count of each id of the first tokenizer; the rest is joined.

Defined cases: a null or empty text has no tokens, nor has one whose joined
token bytes are not a space and the text for both tokenizers. Special tokens
have no meaning; their strings are plain text. Repeated rows count each time
and get equal results. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmill.session import stored


@dataclass(frozen=True)
class Alignment:
    """Files of the tokenizers and how much is kept in memory."""

    first_path: str = public_tokenizers.path("byte_bpe_50k.json")
    second_path: str = public_tokenizers.path("piece_bpe_32k.model")
    remembered: int = 16 << 20  # characters of stretches
    block: int = 1 << 20  # characters of texts that are aligned together
    frequent: int = 1 << 20  # pairs that are sent to all tasks


# A space after and before another character that is no white space.
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_OTHER_SPACE = re.compile(r"\A | \Z|\s | \s")


def _stretches(text: str) -> list[str]:
    """The parts of a text between such spaces."""
    if not text:
        return []
    return _SINGLE_SPACE.split(text) if _OTHER_SPACE.search(text) else text.split(" ")


def _byte_values() -> dict[str, int]:
    """Byte that each character of a byte-level vocabulary stands for: visible Latin characters are themselves, the others follow from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers with the bytes of each of their tokens."""

    def __init__(self, first: bytes, second: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._first = Tokenizer.from_buffer(first)
        self._first.encode_special_tokens = True
        self._second = sentencepiece.SentencePieceProcessor(model_proto=second)
        value = _byte_values()
        entries = self._first.get_vocab(with_added_tokens=True)
        self.first_bytes = [b""] * (max(entries.values()) + 1)
        for entry, k in entries.items():
            self.first_bytes[k] = bytes(value[c] for c in entry) if all(c in value for c in entry) else entry.encode()
        n = self._second.get_piece_size()
        self.second_bytes = []
        for k in range(n):
            piece = self._second.id_to_piece(k)
            self.second_bytes.append(bytes([int(piece[3:5], 16)]) if self._second.is_byte(k) else piece.replace("▁", " ").encode())
        # Whether a token can go on over a single space.
        self.cuts_at_spaces = not any(re.search(rb"[^ ] ", t) for t in self.second_bytes)
        self.first_lengths, self.second_lengths = (np.array([len(t) for t in table], np.int64) for table in (self.first_bytes, self.second_bytes))

    def encode(self, stretches: list[str]) -> list[tuple[list[int], list[int], bool]]:
        """Ids of both tokenizers for a space and the stretch, and whether their bytes are just that."""
        first = [e.ids for e in self._first.encode_batch([f" {s}" for s in stretches], add_special_tokens=False)]
        second = self._second.encode(stretches, num_threads=1)
        out = []
        for s, a, b in zip(stretches, first, second, strict=True):
            raw = f" {s}".encode()
            out.append((a, b, b"".join([self.first_bytes[k] for k in a]) == raw == b"".join([self.second_bytes[k] for k in b])))
        return out


@functools.lru_cache(maxsize=2)
def _tokenizers(first: bytes, second: bytes) -> Tokenizers:
    return Tokenizers(first, second)


class Memory:
    """Token ids of the stretches that a task has met."""

    def __init__(self, tokenizers: Tokenizers, spec: Alignment):
        self.tokenizers, self.spec = tokenizers, spec
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.characters = 0
        self.sound = array("b")
        self.tokens = array("i"), array("i")  # of all stretches, one after the other
        self.ends = array("q", [0]), array("q", [0])

    def _learn(self, stretches: list[str]) -> None:
        for s, (*both, sound) in zip(stretches, self.tokenizers.encode(stretches), strict=True):
            self.known[s] = len(self.sound)
            self.characters += len(s) + 32  # what a short one takes besides
            self.sound.append(sound)
            for ids, tokens, ends in zip(both, self.tokens, self.ends, strict=True):
                tokens.extend(ids)
                ends.append(len(tokens))

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For both tokenizers the ids of all texts and the place after the last of each; texts without a sound encoding have none."""
        if self.characters > self.spec.remembered:
            self._forget()
        parts = [_stretches(t) if self.tokenizers.cuts_at_spaces else [t] if t else [] for t in texts]
        new = list(dict.fromkeys(s for p in parts for s in p if s not in self.known))
        for first in range(0, len(new), 4096):
            self._learn(new[first : first + 4096])
        known = self.known
        at = np.array([known[s] for p in parts for s in p], np.int64)
        text = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
        unsound = np.bincount(text, np.array(self.sound, np.int8)[at] == 0, minlength=len(texts)) > 0
        at, text = at[~unsound[text]], text[~unsound[text]]
        out = []
        for tokens, ends in zip(self.tokens, self.ends, strict=True):
            ends = np.array(ends, np.int64)
            place, own = _spread(ends[at], ends[at + 1])
            out.append((np.array(tokens, np.int32)[place], np.searchsorted(text[own], np.arange(len(texts)), "right")))
        return out


def _spread(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges, one range after the other, and the range of each."""
    n = np.maximum(ends - starts, 0)
    own = np.repeat(np.arange(len(n)), n)
    return np.arange(len(own)) + (starts - np.cumsum(n) + n)[own], own


def common_cuts(first: np.ndarray, second: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Ends in ``first`` that are also in ``second``, both ascending, as places in ``first``.

    ``bounds`` are the places after the last token of each text; texts' last
    ends are common. Intervals are halved at a common end near their middle.
    """
    low, high = np.append(0, bounds[:-1]), bounds - 1  # candidates inside each interval, without its last end
    found = [bounds - 1]
    keep = low < high
    low, high = low[keep], high[keep]
    while len(low):
        middle = (low + high - 1) // 2
        ends = first[middle]
        cut = np.where(second[np.minimum(np.searchsorted(second, ends), len(second) - 1)] == ends, middle, -1)
        left, right, width = middle, middle + 1, 1  # places already looked at, from left to before right
        seek = np.flatnonzero((cut < 0) & (high - low > 1))
        while len(seek):
            new_left, new_right = np.maximum(left[seek] - width, low[seek]), np.minimum(right[seek] + width, high[seek])
            before, own_before = _spread(new_left, left[seek])
            after, own_after = _spread(right[seek], new_right)
            at, owner = np.concatenate([before, after]), seek[np.concatenate([own_before, own_after])]
            left, right = left.copy(), right.copy()
            left[seek], right[seek] = new_left, new_right
            ends = first[at]
            hit = second[np.minimum(np.searchsorted(second, ends), len(second) - 1)] == ends
            # Of several common ends the one nearest to the middle counts.
            at, owner = at[hit], owner[hit]
            far = np.argsort(-np.abs(at - middle[owner]), kind="stable")
            cut[owner[far]] = at[far]
            seek = seek[(cut[seek] < 0) & ((left[seek] > low[seek]) | (right[seek] < high[seek]))]
            width *= 2
        split = np.flatnonzero(cut >= 0)
        found.append(cut[split])
        low, high = np.concatenate([low[split], cut[split] + 1]), np.concatenate([cut[split], high[split]])
        keep = low < high
        low, high = low[keep], high[keep]
    return np.sort(np.concatenate(found))


@dataclass
class Aligned:
    """Tokens and groups of a block of texts, one after the other."""

    first: np.ndarray
    second: np.ndarray
    first_bounds: np.ndarray  # after the last token of each text
    second_bounds: np.ndarray
    first_cuts: np.ndarray  # after the last token of each group
    second_cuts: np.ndarray
    group_bounds: np.ndarray  # after the last group of each text

    @staticmethod
    def of(tokens: list[tuple[np.ndarray, np.ndarray]], tokenizers: Tokenizers) -> Aligned:
        (first, first_bounds), (second, second_bounds) = tokens
        # Both tokenizers' bytes of a text are the same, so ends over all texts are, too.
        first_ends, second_ends = np.cumsum(tokenizers.first_lengths[first]), np.cumsum(tokenizers.second_lengths[second])
        texts = np.flatnonzero(np.diff(first_bounds, prepend=0) > 0)
        cuts = common_cuts(first_ends, second_ends, first_bounds[texts]) if len(texts) else np.zeros(0, np.int64)
        second_cuts = np.searchsorted(second_ends, first_ends[cuts]) + 1
        return Aligned(first, second, first_bounds, second_bounds, cuts + 1, second_cuts, np.searchsorted(cuts, first_bounds))

    def told(self, names: Names) -> list[bytes]:
        """Groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        parts = np.empty(len(self.first) + len(self.second), object)
        before = np.append(0, self.second_cuts)[:-1], self.first_cuts  # tokens of the other tokenizer before a group's own
        for ids, cuts, ahead, last in ((self.first, self.first_cuts, before[0], names.first_last), (self.second, self.second_cuts, before[1], names.second_last)):
            place = np.arange(len(ids)) + np.repeat(ahead, np.diff(cuts, prepend=0))
            parts[place] = names.inner[ids]
            parts[place[cuts - 1]] = last[ids[cuts - 1]]
        bounds = (self.first_bounds + self.second_bounds).tolist()
        return [b"".join(parts[a:b].tolist())[:-1] for a, b in zip([0, *bounds], bounds, strict=False)]

    def links(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, times) of the distinct pairs ``first * width + second`` of each text, in order."""
        text = np.repeat(np.arange(len(self.group_bounds)), np.diff(self.group_bounds, prepend=0)) << 32
        n_first, n_second = np.diff(self.first_cuts, prepend=0), np.diff(self.second_cuts, prepend=0)
        single = (n_first == 1) & (n_second == 1)
        once = text[single] | (self.first[self.first_cuts[single] - 1].astype(np.int64) * width + self.second[self.second_cuts[single] - 1])
        counted = []
        for ids, n in ((self.first, n_first), (self.second, n_second)):
            group = np.repeat(np.arange(len(n)), n)
            own = np.flatnonzero(~single[group])
            key, times = np.unique(group[own] << 32 | ids[own], return_counts=True)
            counted.append((key >> 32, key & 0xFFFFFFFF, times))
        (ga, a, na), (gb, b, nb) = counted
        partner, own = _spread(np.searchsorted(gb, ga, "left"), np.searchsorted(gb, ga, "right"))
        key, times = text[ga[own]] | (a[own] * width + b[partner]), na[own] * nb[partner]
        more = times > 1
        once = np.sort(np.concatenate([once, key[~more]]))
        heads = np.flatnonzero(np.append(True, once[1:] != once[:-1])) if len(once) else np.zeros(0, np.int64)
        key, times = np.append(once[heads], key[more]), np.append(np.diff(np.append(heads, len(once))), times[more])
        if more.any():  # few, so sorting again costs little
            order = np.argsort(key, kind="stable")
            key, times = key[order], times[order]
            heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            key, times = key[heads], np.add.reduceat(times, heads)
        return key >> 32, key & 0xFFFFFFFF, times


class Names:
    """Decimal ids with what follows them: inside a group, after its first part, after its second."""

    def __init__(self, n: int):
        self.inner, self.first_last, self.second_last = (np.array([b"%d%s" % (k, end) for k in range(n)], object) for end in (b",", b"|", b";"))


_ALIGNED = pa.schema([("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())])


class Aligner:
    """Alignment over the rows of a table; the tokenizers' files, a few MB, are sent to every task."""

    def __init__(self, documents: DataFrame, spec: Alignment = Alignment()):
        self.spec, self.spark = spec, documents.sparkSession
        with open(spec.first_path, "rb") as first, open(spec.second_path, "rb") as second:
            self._files = self.spark.sparkContext.broadcast((first.read(), second.read()))
        self.width = len(_tokenizers(*self._files.value).second_bytes)
        self.aligned = stored(self._align(documents), "aligned")

    def _align(self, documents: DataFrame) -> DataFrame:
        files, spec, width = self._files, self.spec, self.width

        def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tokenizers = _tokenizers(*files.value)
            memory = Memory(tokenizers, spec)
            names = Names(max(len(tokenizers.first_bytes), len(tokenizers.second_bytes)))

            def block(texts: list[str], ids: pa.Array) -> pa.RecordBatch:
                found = Aligned.of(memory.encode(texts), tokenizers)
                text, pair, times = found.links(width)
                cuts = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
                pair, times = pair.astype(np.uint32), times.astype(np.int64)
                n_links = np.add.reduceat(np.append(times, 0), np.minimum(cuts[:-1], len(times))) * (np.diff(cuts) > 0)
                digests = [hashlib.sha256(t).hexdigest() if t else "" for t in found.told(names)]
                each = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())
                counts = (np.diff(x, prepend=0) for x in (found.first_bounds, found.second_bounds, found.group_bounds))
                return pa.RecordBatch.from_arrays([ids, *(pa.array(c) for c in (*counts, n_links)), pa.array(digests), each(pair), each(times)], names=["doc_id", *_ALIGNED.names])

            for batch in batches:
                sizes = np.cumsum([len(t or "") for t in batch.column(1).to_pylist()]) if batch.num_rows else np.zeros(0, np.int64)
                first = 0
                while first < batch.num_rows:
                    done = sizes[first - 1] if first else 0
                    last = max(first + 1, int(np.searchsorted(sizes, done + spec.block, "right")))
                    yield block([t or "" for t in batch.column(1).slice(first, last - first).to_pylist()], batch.column(0).slice(first, last - first))
                    first = last

        kind = documents.schema["doc_id"].dataType.simpleString()
        fields = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
        return documents.select("doc_id", "text").mapInArrow(align, f"doc_id {kind}, {fields}").withColumn("row", F.monotonically_increasing_id())

    def counted(self) -> DataFrame:
        """``pair, n``: in how many texts a pair ``first * width + second`` is linked."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pending, size = [], 0

            def flush() -> pa.RecordBatch:
                pair, n = np.unique(np.concatenate(pending), return_counts=True)
                return pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int64)), pa.array(n)], names=["pair", "n"])

            for batch in batches:
                for pairs in batch.column(0):
                    pending.append(np.frombuffer(pairs.as_buffer(), np.uint32))
                    size += len(pending[-1])
                    if size > 1 << 23:
                        yield flush()
                        pending, size = [], 0
            if pending:
                yield flush()

        return self.aligned.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))

    def rated(self) -> DataFrame:
        """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each row."""
        counts = stored(self.counted(), "pair-counts")
        # The least power of two that no more than the allowed number of pairs reach.
        level = F.floor(F.log2(F.col("n").cast("double")) + 1e-9).cast("int")
        sizes = {r.level: r.c for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("c")).collect()}  # at most 63 rows
        bar = 0
        while sum(c for k, c in sizes.items() if k >= bar) > self.spec.frequent:
            bar += 1
        often = counts.where(level >= bar).toArrow()  # at most ``frequent`` rows
        pair, n = often["pair"].to_numpy(), often["n"].to_numpy()
        order = np.argsort(pair)
        top = counts.groupBy(F.expr(f"pair div {self.width}").alias("a")).agg(F.max("n").alias("n")).toArrow()  # a row for each id of the first tokenizer
        highest = np.zeros(int(top["a"].to_numpy().max(initial=0)) + 1, np.int64)
        highest[top["a"].to_numpy()] = top["n"].to_numpy()
        sent = self.spark.sparkContext.broadcast((pair[order].astype(np.uint32), n[order].astype(np.int64), highest))
        width = self.width
        kind = self.aligned.schema["doc_id"].dataType.simpleString()

        def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, count, highest = sent.value
            rest_kind = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))
            for batch in batches:
                best, total, rest = [], [], []
                for pairs, times in zip(batch.column("pairs"), batch.column("times"), strict=True):
                    pair, often = np.frombuffer(pairs.as_buffer(), np.uint32), np.frombuffer(times.as_buffer(), np.int64)
                    at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
                    hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
                    n = count[at[hit]] if len(known) else np.zeros(0, np.int64)
                    best.append(int(often[hit][n == highest[pair[hit] // width]].sum()))
                    total.append(int((n * often[hit]).sum()))
                    rest.append([{"pair": p, "times": t} for p, t in zip(pair[~hit].tolist(), often[~hit].tolist(), strict=True)])
                columns = [batch.column(k) for k in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(best, pa.int64()), pa.array(total, pa.int64()), pa.array(rest, rest_kind)], names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum", "rest"])

        rated = self.aligned.mapInArrow(rate, f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, rest array<struct<pair:long,times:long>>")
        columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        if bar == 0:
            return rated.select(columns)  # all pairs were sent
        rated = stored(rated, "rated")
        rare = rated.select("row", F.explode("rest").alias("r")).select("row", "r.pair", "r.times").join(counts.where(level < bar), "pair")
        ceiling = self.spark.createDataFrame(top.rename_columns(["a", "ceiling"]))
        rare = rare.withColumn("a", F.expr(f"pair div {width}")).join(F.broadcast(ceiling), "a")
        more = rare.groupBy("row").agg(F.sum(F.when(F.col("n") == F.col("ceiling"), F.col("times")).otherwise(0)).alias("b"), F.sum(F.col("n") * F.col("times")).alias("s"))
        whole = rated.drop("rest").join(more, "row", "left")
        return whole.withColumn("n_best", F.col("n_best") + F.coalesce("b", F.lit(0))).withColumn("count_sum", F.col("count_sum") + F.coalesce("s", F.lit(0))).select(columns)


def align(documents: DataFrame, spec: Alignment = Alignment()) -> DataFrame:
    """Token counts, groups and link counts of each row of ``documents``."""
    return Aligner(documents, spec).rated()
