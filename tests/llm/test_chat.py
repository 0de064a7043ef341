"""Chat formatting: every conversation comes back, the mask covers the trained texts."""

import random
import time

from pyspark.sql import functions as F

from shelfmill.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, turns string"


def made():
    rng = random.Random(4)
    bits = ["<turn ", "</turn>", "</turn>\n", "\\", "\\\\</turn", "\n", "<turn user>\n", "é", "🙂", "$1", "%3C", "### ", " ", "ok"]
    rows = [(1, 0, None, None, "x"), (1, 1, "assistant", "", "x"), (2, 0, "assistant", "\\", "x"), (3, None, "a%0A<b\n>c", "t\\", "x"), (4, 0, "assistant", "twice", "x"), (4, 0, "assistant", "twice", "x")]
    for conv in range(10, 160):
        for turn in range(rng.randrange(1, 6)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "</turn>", "x<turn "]), "".join(rng.choices(bits, k=rng.randrange(12))), "x"))
    rows.append((None, 0, "user", "no id", "x"))
    return rows


def test_every_conversation_comes_back(spark):
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = chat.format_chats(df).withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()
    source = {}
    for conv, turn, role, text, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        source.setdefault(conv, []).append((role or "", text or ""))
    assert {r.conv_id for r in got} == set(source) and len(got) == len(source)
    for r in got:
        assert r.exact
        assert [(t.role, t.text) for t in r.turns] == source[r.conv_id]
        assert r.loss == "".join(t for role, t in source[r.conv_id] if role == "assistant")
        parts = [r.formatted[s.start : s.stop] for s in r.loss_spans]
        assert len(parts) == sum(role == "assistant" for role, _ in source[r.conv_id])
        assert r.formatted.count("<turn ") >= len(r.turns)


def test_texts_without_control_strings_stay_as_they_are(spark):
    df = spark.createDataFrame([(1, 0, "user", "a\\b", "x")], SCHEMA)
    assert chat.format_chats(df).first().formatted == "<turn user>\na\\b\n</turn>\n"
    assert chat.format_chats(df.limit(0)).count() == 0


def test_long_runs_of_backslashes(spark):
    run = "\\" * 1_000_000
    texts = [run, run + "</turn>", "</turn" + run, "\\</turn" * 100_000, "a" + run + "<turn x" + run + "b"]
    df = spark.createDataFrame([(i, 0, "assistant", t, "x") for i, t in enumerate(texts)], SCHEMA)
    start = time.monotonic()
    got = {r.conv_id: r for r in chat.format_chats(df).collect()}
    assert time.monotonic() - start < 30
    assert all(got[i].exact and got[i].turns[0].text == t for i, t in enumerate(texts))
