"""The pipeline against a brute-force version of all its stages."""

import hashlib
import random
import re
from collections import Counter

import corpus_pipeline
from shelfmill.session import stored
from tests.llm.test_bpe import WHOLE
from tests.llm.test_pii import PLAIN, passes
from tests.llm.test_simhash import plain_components, plain_fingerprint

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def repeats(words, n):
    at = {}
    for i in range(len(words) - n + 1):
        at.setdefault(tuple(words[i : i + n]), []).append(i)
    return {k for places in at.values() if len(places) > 1 for p in places for k in range(p, p + n)}


def good(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if n < 10 or 100 * len(repeats(words, 5)) > 15 * n or 100 * len(repeats(words, 20)) > 5 * n:
        return False
    return not repeats(words, 101)


def contaminated(text, items):
    def cut(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))

    words, hit = cut(text), set()
    for item in items:
        own = cut(item)
        size = min(13, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
    return bool(hit) and 20 * len(hit) >= len(words)


def clean(text):
    spans = sorted((m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text) if passes(kind, m.group()))
    spans += [(m.start(), 9, m.end(), "secret") for m in re.finditer(r"(?<![A-Za-z0-9])[0-9A-Fa-f]{32,128}(?![A-Za-z0-9])", text) if re.search(r"\b(token|secret|key|password)", text[max(0, m.start() - 32) : m.start()].lower())]
    out, reach = [], 0
    for a, _, b, kind in sorted(spans):
        if a >= reach:
            out.append(text[reach:a] + f"[{kind.upper()}]")
        reach = max(reach, b)
    return "".join(out) + text[reach:]


def brute_force(rows, items):
    rows = [r for r in rows if good(r[1])]
    roots = plain_components(sorted({plain_fingerprint(r[1]) for r in rows}))
    first = {}
    for r in sorted(rows, key=lambda r: r[0]):
        first.setdefault(roots[plain_fingerprint(r[1])], r)
    kept = [r for r in first.values() if not contaminated(r[1], items)]
    out = []
    for r in kept:
        text = clean(r[1])
        ids = WHOLE.encode_ordinary(text)
        out.append((r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


def test_run_matches_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    assert got == brute_force(rows, items)


def test_stages_with_odd_rows(spark, tmp_path):
    rng = random.Random(9)
    words = [f"word{i}" for i in range(400)]
    passage = " ".join(rng.sample(words, 30))
    plain = " ".join(rng.sample(words, 60))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, plain, "en", "s", 1), (3, plain, "en", "s", 1), (4, plain, None, "t", 1), (5, passage + " mail a@b.co", "en", "s", 1), (6, " ".join(rng.sample(words, 90)) + " mail a@b.co", "en", "s", 1), (None, " ".join(rng.sample(words, 50)), "en", "s", 1)]
    spark.createDataFrame([(0, passage), (1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, COLUMNS)
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, str(tmp_path)), name)
        if name != "byte_bpe":
            assert out.columns == docs.columns
        docs = out
        seen.append(sorted(str(r.doc_id) for r in out.collect()))
    assert seen == [["3", "3", "4", "5", "6", "None"], ["3", "5", "6", "None"], ["3", "6", "None"], ["3", "6", "None"], ["3", "6", "None"]]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
