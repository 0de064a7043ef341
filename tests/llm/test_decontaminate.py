"""Decontamination against a scan of all windows, with odd rows and hot passages."""

import random

import pytest

from shelfmill.llm import decontaminate
from tests.llm.test_pipeline import contaminated

ITEMS = "item_id long, text string, hash string"
DOCS = "doc_id long, text string, size string, spans string"


def plain_words(text):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(text, items):
    words, hit, found = plain_words(text), set(), set()
    for item, body in items:
        own = plain_words(body)
        size = min(13, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            for j in range(len(words) - size + 1):
                if words[j : j + size] == own[i : i + size]:
                    hit.update(range(j, j + size))
                    found.add(str(item) if item is not None else "")
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("gram", [2, 5, 13])
def test_hits_match_a_scan_of_all_windows(spark, gram):
    rng = random.Random(gram)
    words = ["a", "b", "Straße", "é2", "日本", "x"]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 2, 5, 12, 13, 14, 30])))) for i in range(25)] + [(3, "a b a b a"), (None, "x x x"), (50, None), (51, "?!"), (52, items_text(words))]
    docs = [(0, None), (1, ""), (2, "..."), (3, "A"), (3, "A"), (4, items_text(words).upper()), (None, "b " * 20)]
    for i in range(120):
        parts = [rng.choice(items)[1] or "" for _ in range(rng.randrange(3))] + [" ".join(rng.choices(words, k=rng.randrange(40)))]
        rng.shuffle(parts)
        docs.append((10 + i, ", ".join(parts)))
    found = decontaminate.contamination(
        spark.createDataFrame([(*d, "s", "t") for d in docs], DOCS).repartition(3),
        spark.createDataFrame([(*i, "h") for i in items], ITEMS),
        decontaminate.Winnowing(gram=gram),
    ).collect()
    assert len(found) == len(docs)
    texts = {}
    for doc, text in docs:
        texts.setdefault(doc, text)
    for r in found:
        n, hit, ids = plain(texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, sorted(r.item_ids)) == (n, hit, ids)
        assert r.contaminated == contaminated(texts[r.doc_id], [b for _, b in items])


def items_text(words):
    return " ".join(words * 4)


def test_removal_keeps_columns_and_empty_tables(spark):
    passage = " ".join(f"w{i}" for i in range(15))
    docs = spark.createDataFrame([(1, passage, "s", "t"), (2, "clean text", "s", "t"), (None, passage, "s", "t"), (2, None, "s", "t")], DOCS)
    items = spark.createDataFrame([(1, passage, "h")], ITEMS)
    left = decontaminate.remove_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in left.collect()) == [(2, ""), (2, "clean text")]
    assert decontaminate.remove_contaminated(docs, items.limit(0)).count() == 4
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
