"""BPE against the library on whole texts, with small chunks, and round trips."""

import base64
import hashlib
import random

import public_tokenizers
import tiktoken

from shelfmill.llm import bpe
from shelfmill.llm.queries import bpe_digests

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
WHOLE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def texts():
    rng = random.Random(3)
    alphabet = ["a", "B", " ", "  ", "\n", "\t", "'s", "'", "9", "é", "ß", "日本", "🙂", ".", "<|endoftext|>", "don't", " "]
    made = ["".join(rng.choices(alphabet, k=rng.randrange(1, 400))) for _ in range(80)]
    return [None, "", " ", "x" * 500, " " * 300 + "a", "'s" * 200, "ab " * 200, "\n \n" * 150, "word" + "9" * 100 + " " * 90 + "!" * 200, *made]


def test_chunks_stitch_to_the_same_ids(spark):
    rows = [(i, t, 1) for i, t in enumerate(texts())] + [(1, "", 1), (None, "no id", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    codec = bpe.Codec(spark, bpe.Vocabulary(chunk=40, overlap=12))
    got = codec.decode(codec.encode(df)).collect()
    assert len(got) == len(rows)
    expected = sorted((str(i), WHOLE.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows)
    assert sorted((str(r.doc_id), list(r.ids), bytes(r.raw)) for r in got) == expected


def test_query_on_a_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in bpe_digests(df).collect()}
    for r in df.collect():
        ids = WHOLE.encode_ordinary(r.text)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_digests(df).count() == 0
