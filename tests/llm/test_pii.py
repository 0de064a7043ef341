"""Personal data spans against plain Python."""

import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from shelfmill.llm import pii
from shelfmill.llm.queries import op6_pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d *= 1 + k % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if passes(kind, m.group())]
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found))


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "pii int, text string").coalesce(2)
    rows = df.select("pii", pii.spans("text").alias("s"), pii.redacted(F.col("text"), pii.spans("text")).alias("r")).orderBy("pii")
    return rows.select(pii.listed(F.filter("s", lambda x: x.basic)).alias("base"), pii.listed(F.col("s")).alias("all"), "r").collect()


def test_base_spans_match_plain_python(spark):
    rng = random.Random(7)
    bits = ["a.b@c.de", "x@y", "é", "🙂", " ", "_q+1@m-n.org.", "10.0.0.255", "1.2.3.256", ".7", "0001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (415) 555-2671", "+49 30 1234567", "+1.", "-", "(", "12345", "378282246310005", "@", "%", ".com", "+"]
    texts = [None, "", "@" * 50, "1" * 500, "a" * 3000, "a@a" + ".a" * 3000, "1.1.1.1 " * 700, "+1" * 100, *("".join(rng.choices(bits, k=rng.randrange(1, 14))) for _ in range(400))]
    for text, row in zip(texts, found(spark, texts), strict=True):
        assert row.base == plain(text), text


def test_checksums_context_and_redaction(spark):
    good, bad = "GB82 WEST 1234 5698 7654 32", "GB83 WEST 1234 5698 7654 32"
    hexes = "0123456789abcdef" * 2
    texts = [f"iban {good}.", f"iban {bad}.", f'token = "{hexes}"', f"sum {hexes}", "mail a@b.co, call +1 415 555 2671 now", None, "none"]
    rows = found(spark, texts)
    assert rows[0]["all"] == "iban:5:32"
    assert rows[1]["all"] == "" and rows[3]["all"] == ""
    assert rows[2]["all"] == "secret:9:41"
    assert rows[4].r == "mail [EMAIL], call [PHONE] now"
    assert rows[5].r is None and rows[6].r == "none"


def test_overlapping_spans_are_replaced_once(spark):
    text = "+4111111111111111 x"
    row = found(spark, [text])[0]
    assert row.base == plain(text)
    assert not any(c.isdigit() for c in row.r) and row.r.endswith(" x")


def test_redact_keeps_columns_and_rows(spark):
    df = spark.createDataFrame([(1, "a@b.co", "x"), (1, "a@b.co", "x"), (None, None, "y")], "doc_id long, text string, s string")
    rows = pii.redact(df).collect()
    assert sorted((r.doc_id or 0, r.text or "", r.s) for r in rows) == [(0, "", "y"), (1, "[EMAIL]", "x"), (1, "[EMAIL]", "x")]
    assert pii.find_pii(df.limit(0)).count() == 0


def test_query_on_a_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = op6_pii(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        base = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [base.count(k + ":") for k in PLAIN]
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
    assert sum(r.n_email + r.n_card for r in got) > 0


def test_many_spans_are_redacted_in_linear_time(spark):
    many = " ".join(f"ä{i} a{i}@b.co" for i in range(50_000))
    overlapping = "+" + "1.1.1.1 " * 3000
    df = spark.createDataFrame([(0, many, 0, "k"), (1, overlapping, 1, "k"), (2, "", 2, "k")], "doc_id int, text string, n int, k string")
    start = time.monotonic()
    got = {r.doc_id: r.text for r in pii.redact(df).select("doc_id", "text").collect()}
    assert time.monotonic() - start < 40
    assert got[0] == " ".join(f"ä{i} [EMAIL]" for i in range(50_000))
    assert got[1] == plain_redaction(overlapping) and got[2] == ""


def plain_redaction(text):
    spans = sorted((m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text) if passes(kind, m.group()))
    out, reach = [], 0
    for a, _, b, kind in spans:
        if a >= reach:
            out.append(text[reach:a] + f"[{kind.upper()}]")
        reach = max(reach, b)
    return "".join(out) + text[reach:]
