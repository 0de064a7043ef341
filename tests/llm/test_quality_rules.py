"""Quality rules and suffix arrays against plain counting."""

import random

import numpy as np

import corpus_pipeline
from shelfmill.llm import quality_rules
from tests.llm.test_pipeline import good, repeats


def test_longest_repeats_match_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        texts = [rng.choices(range(rng.choice([2, 5, 40])), k=rng.randrange(60)) for _ in range(rng.randrange(1, 5))]
        bounds = np.cumsum([0] + [len(t) for t in texts])
        got = quality_rules.longest_repeats(np.array([w for t in texts for w in t], np.uint64), bounds)
        expected = []
        for t in texts:
            for i in range(len(t)):
                best = 0
                for j in range(len(t)):
                    n = 0
                    while i != j and max(i, j) + n < len(t) and t[i + n] == t[j + n]:
                        n += 1
                    best = max(best, n)
                expected.append(best)
        assert got.tolist() == expected


def test_measures_and_verdict(spark):
    rng = random.Random(6)
    words = ["the", "ä#1", "日本|", "x", "y", "$z", "w%", "q"]
    texts = [None, "", " \t\n", "one", "a b " * 400, "line one here\nline one here\n\n\nline one here \n", "x\r\ny\r\nx\r\n"]
    texts += ["".join(rng.choice(words) + rng.choice([" ", "\n", "  ", "\x0b"]) for _ in range(rng.randrange(60))) for _ in range(120)]
    texts += [" ".join(f"u{i}" for i in range(n)) + " " + " ".join(f"u{i}" for i in range(k)) for n, k in ((100, 7), (100, 19), (100, 40), (9, 0), (10, 0))]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id int, text string, kept string")
    for r in df.select("doc_id", quality_rules.quality("text").alias("q")).collect():
        text, q = texts[r.doc_id] or "", r.q
        own = text.encode().split()
        assert q.n_words == len(own)
        assert q.word_chars == sum(len(w.decode()) for w in own)
        assert q.n_symbols == sum(c in "#*$%&|<>" for c in text)
        lines = [line for line in text.split("\n") if line.encode().split()]
        assert q.n_dup_lines == len(lines) - len(set(lines))
        assert q.n_repeat_words == len(repeats(own, 5))
        assert q.base_failed == (len(own) < 10 or 100 * q.n_repeat_words > 20 * len(own))
        assert q.kept == good(text)
    kept = quality_rules.keep_good(df)
    assert kept.columns == df.columns and kept.count() == sum(map(good, texts))
    assert quality_rules.keep_good(df.limit(0)).count() == 0


def test_verdict_rejects_repeats_that_the_base_rule_passes(spark):
    def text(name, n, *again):
        """``n`` distinct words, after them each (start, size) block once more."""
        words = [f"{name}{i}" for i in range(n)]
        return " ".join(words + [w for k, (a, size) in enumerate(again) for w in [*words[a : a + size], f"{name}end{k}"]])

    rejected = {
        "block": text("a", 91_000, (500, 9_000)),  # 18 % in one block twice
        "longest only": text("b", 10_000, (500, 101)),
        "long share only": text("c", 900, *((200 * k, 20) for k in range(4))),
        "covered only": text("h", 90, *((10 * k, 5) for k in range(2))),  # 20 of 112 words
    }
    clean = {
        "no repeat": text("d", 300),
        "lines said twice": text("e", 130, (10, 9)),
        "longest at its limit": text("f", 10_000, (500, 100)),
        "share below its limit": text("g", 900, (0, 20)),
        "19 words": text("i", 900, *((200 * k, 19) for k in range(3))),
    }
    df = spark.createDataFrame(list((rejected | clean).items()), "doc_id string, text string")
    rows = {r.doc_id: r.q for r in df.select("doc_id", quality_rules.quality("text").alias("q")).collect()}
    assert not any(q.base_failed for q in rows.values())
    assert {k for k, q in rows.items() if not q.kept} == set(rejected)
    assert {k for k, t in (rejected | clean).items() if len(t) < 100_000 and not good(t)} == set(rejected) - {"block"}
    stage = dict(corpus_pipeline.STAGES)["quality_rules"]
    assert {r.doc_id for r in stage(spark, df, "").collect()} == set(clean)
