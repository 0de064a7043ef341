"""Token alignment against a plain version that encodes whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shelfmill.llm import token_alignment as ta

FIRST = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
FIRST.encode_special_tokens = True
SECOND = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_level(entry, table={}):
    if not table:
        shown = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
        others = iter(range(256, 512))
        table.update({(chr(b) if b in shown else chr(next(others))): b for b in range(256)})
    return bytes(table[c] for c in entry)


def plain_groups(text):
    if not text:
        return []
    raw = f" {text}".encode()
    a = FIRST.encode(f" {text}", add_special_tokens=False).ids
    b = SECOND.encode(text)
    pieces = [SECOND.id_to_piece(k) for k in b]
    ends, joined = [], []
    for tokens in ([byte_level(FIRST.id_to_token(k)) for k in a], [bytes([int(p[3:5], 16)]) if SECOND.is_byte(k) else p.replace("▁", " ").encode() for k, p in zip(b, pieces)]):
        joined.append(b"".join(tokens))
        ends.append(np.cumsum([len(t) for t in tokens]).tolist())
    if joined != [raw, raw]:
        return []
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        p, q = ends[0].index(cut) + 1, ends[1].index(cut) + 1
        groups.append((a[i:p], b[j:q]))
        i, j = p, q
    return groups


def plain(rows):
    groups = [plain_groups(text) for _, text in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count = Counter(pair for c in links for pair in c)
    highest = {}
    for (x, _), n in count.items():
        highest[x] = max(n, highest.get(x, 0))
    out = []
    for (doc, _), g, c in zip(rows, groups, links):
        told = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        n_best = sum(n for (x, y), n in c.items() if count[x, y] == highest[x])
        out.append((doc, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()), n_best, sum(n * count[p] for p, n in c.items()), hashlib.sha256(told.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


def aligned(spark, rows, spec=ta.Alignment()):
    documents = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, n_a long, pairs string")
    return sorted((tuple(r) for r in ta.align(documents, spec).collect()), key=str)


HARD = [
    None, "", " ", "  ", " a", "a ", "a  b", "\n a\tb \n\n c", "it's o'clock 's 'll", "<|endoftext|> <s> </s> <unk> <0x41>", "▁ mixed ▁", "naïve café 東京タワー 😀😀 é",
    " x  y z \x1c q\x00r", "123456 7890,12.5%", "===== ----- ////", "a" * 3000, "😀" * 400, "กำ" * 200, " " * 500, "x\r\ny", "Ⅷ ﬁ ½ ㍿", "﻿bom", "\U0001fae8 new \U00010d40",
]


@pytest.mark.parametrize("spec", [ta.Alignment(), ta.Alignment(remembered=200, block=300, frequent=8)])
def test_alignment_equals_whole_text_encoding(spark, spec):
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()[:60]
    rng = random.Random(1)
    alphabet = "ab  \n'.,é東😀1▁\t-"
    texts += HARD + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[4]), (None, None)]
    assert aligned(spark, rows, spec) == plain(rows)


def test_empty_table(spark):
    assert aligned(spark, []) == []
    assert aligned(spark, [(1, None)]) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_common_cuts_are_all_common_ends():
    rng = np.random.default_rng(2)
    for share in (0.0, 0.01, 0.3, 0.9):
        ends, bounds, first, second = 0, [], [], []
        for _ in range(20):
            n = int(rng.integers(1, 400))
            a = np.flatnonzero(rng.random(n) < 0.5)
            b = np.where(rng.random(len(a)) < share, a, a + 1)
            first += sorted({*(a + 1 + ends).tolist(), ends + n})
            second += sorted({*(x + 1 + ends for x in b.tolist() if x < n), ends + n})
            bounds.append(len(first))
            ends += n
        first, second = np.array(first), np.array(second)
        assert ta.common_cuts(first, second, np.array(bounds)).tolist() == np.flatnonzero(np.isin(first, second)).tolist()


def test_long_cutless_text_takes_few_steps(spark):
    """A text without an inner common end is one group, found in steps that grow with the logarithm of its length."""
    first, second = np.arange(2, 400_002, 2), np.append(np.arange(1, 400_000, 2), 400_000)
    assert ta.common_cuts(first, second, np.array([len(first)])).tolist() == [len(first) - 1]
