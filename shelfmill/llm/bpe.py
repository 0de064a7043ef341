"""Byte-level BPE encoding and decoding with a published vocabulary.

A text is cut by the tokenizer's pattern into pre-tokens, and byte pairs are
merged inside each. Long texts are encoded in parallel: they are cut into
chunks that overlap, each chunk is pre-tokenised on its own, and neighbours are
stitched at the first place in the overlap where both see a boundary. From a
common boundary on both see the same pre-tokens, since a match depends on
nothing before it. The pieces between the cuts are encoded wherever they land
and their ids put together in order. A match that touches the end of a chunk
may go on, so it gives no boundary; nor does one that ends in white space, whose
split depends on what follows. If an overlap has no common boundary (a
pre-token longer than the overlap), the text from the last cut on is one piece.

Decoding concatenates the raw bytes of the ids.

Defined cases: a null text is empty; an empty text has no ids. Repeated rows
give repeated rows. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfmill.session import stored



@dataclass(frozen=True)
class Vocabulary:
    """Rank file of a tokenizer, its pattern, and how texts are chunked (characters)."""

    ranks_path: str = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    pattern: str = public_tokenizers.PATTERN
    chunk: int = 32768
    overlap: int = 1024


@functools.lru_cache(maxsize=2)
def _encoding(ranks_file: bytes, pattern: str) -> tuple[tiktoken.Encoding, list[bytes]]:
    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks_file.splitlines() if line)}
    raw = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        raw[rank] = token
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), raw


class Codec:
    """Column functions of one vocabulary; its file, a few hundred KB, is sent to every task."""

    def __init__(self, spark: SparkSession, vocabulary: Vocabulary = Vocabulary()):
        with open(vocabulary.ranks_path, "rb") as file:
            self._ranks = spark.sparkContext.broadcast(file.read())
        self.vocabulary = vocabulary

    def ids(self, text: Column | str) -> Column:
        """Token ids of a text."""
        ranks, pattern = self._ranks, self.vocabulary.pattern

        @F.arrow_udf("array<int>")
        def encode(texts: pa.Array) -> pa.Array:
            encoding, _ = _encoding(ranks.value, pattern)
            found = [encoding.encode_to_numpy(t.as_py() or "", disallowed_special=()).astype(np.int32) for t in texts]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)])
            return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))

        return encode(text)

    def raw(self, ids: Column | str) -> Column:
        """Bytes that ids stand for."""
        ranks, pattern = self._ranks, self.vocabulary.pattern

        @F.arrow_udf("binary")
        def decode(rows: pa.Array) -> pa.Array:
            _, table = _encoding(ranks.value, pattern)
            # One row at a time: Python integers take many times the room of the ids.
            ids, cuts = rows.values.to_numpy(), rows.offsets.to_pylist()
            return pa.array([b"".join([table[i] for i in ids[a:b].tolist()]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())

        return decode(ids)

    def _boundaries(self, chunk: Column | str, at: Column | str, last: Column | str) -> Column:
        """Boundaries of a chunk's pre-tokens near its two ends, as places in the text."""
        v = self.vocabulary

        @F.arrow_udf("struct<head:array<int>,tail:array<int>>")
        def boundaries(chunks: pa.Array, starts: pa.Array, lasts: pa.Array) -> pa.Array:
            find = regex.compile(v.pattern).finditer
            rows = []
            for text, start, is_last in zip(chunks.to_pylist(), starts.to_pylist(), lasts.to_pylist(), strict=True):
                ends = [m.end() for m in find(text) if not text[m.end() - 1].isspace()]
                if not is_last:
                    ends = [e for e in ends if e < len(text)]
                rows.append({"head": [start + e for e in ends if e <= v.overlap], "tail": [start + e for e in ends if e >= v.chunk]})
            return pa.array(rows, pa.struct([("head", pa.list_(pa.int32())), ("tail", pa.list_(pa.int32()))]))

        return boundaries(chunk, at, last)

    def _long(self, documents: DataFrame) -> DataFrame:
        """``doc_id, ids`` of texts longer than a chunk."""
        v = self.vocabulary

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row, doc, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                    starts = list(range(0, max(len(text) - v.overlap, 1), v.chunk))
                    rows = [{"row": row, "doc_id": doc, "n": n, "start": s, "last": n == len(starts) - 1, "chunk": text[s : s + v.chunk + v.overlap] if n < len(starts) - 1 else text[s:]} for n, s in enumerate(starts)]
                    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("row", pa.int64()), ("doc_id", batch.schema.field(1).type), ("n", pa.int32()), ("start", pa.int32()), ("last", pa.bool_()), ("chunk", pa.string())]))

        doc_type = documents.schema["doc_id"].dataType.simpleString()
        chunks = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(cut, f"row long, doc_id {doc_type}, n int, start int, last boolean, chunk string")
        chunks = stored(chunks, "chunks")  # fixes the row numbers

        seen = chunks.repartition("row", "n").withColumn("b", self._boundaries("chunk", "start", "last"))
        along = Window.partitionBy("row").orderBy("n")
        common = F.array_min(F.array_intersect("b.head", F.lag("b.tail").over(along)))
        seen = seen.withColumn("cut", F.when(F.col("n") == 0, F.lit(0)).otherwise(common))
        seen = seen.withColumn("stitched", F.min(F.col("cut").isNotNull()).over(along.rowsBetween(Window.unboundedPreceding, 0)))
        # After a failed stitch everything belongs to the piece of the last stitched chunk.
        seen = seen.withColumn("piece", F.max(F.when(F.col("stitched"), F.col("n"))).over(along.rowsBetween(Window.unboundedPreceding, 0)))
        begin = F.when(F.col("stitched"), F.col("cut")).otherwise(F.col("start"))
        seen = seen.withColumn("begin", begin)
        stop = F.lead("begin").over(along)
        part = F.when(F.col("last"), F.expr("substring(chunk, begin - start + 1)")).otherwise(F.expr("substring(chunk, begin - start + 1, stop - begin)"))
        parts = seen.withColumn("stop", stop).select("row", "doc_id", "piece", "n", part.alias("part"))
        pieces = parts.groupBy("row", "doc_id", "piece").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "part"))), lambda x: x.part), "").alias("text"))
        encoded = pieces.repartition("row", "piece").select("row", "doc_id", "piece", self.ids("text").alias("ids"))
        whole = encoded.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("p"))
        return whole.select("doc_id", F.flatten(F.transform("p", lambda x: x.ids)).alias("ids"))

    def encode(self, documents: DataFrame) -> DataFrame:
        """``doc_id, ids``, a row per row of ``documents(doc_id, text)``."""
        v = self.vocabulary
        text = F.coalesce("text", F.lit(""))
        is_long = F.length(text) > v.chunk + v.overlap
        short = documents.where(~is_long).select("doc_id", self.ids(text).alias("ids"))
        return short.unionByName(self._long(documents.where(is_long).select("doc_id", "text")))

    def decode(self, encoded: DataFrame) -> DataFrame:
        """``encoded`` with the decoded bytes as column ``raw``."""
        return encoded.withColumn("raw", self.raw("ids"))
