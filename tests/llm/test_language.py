"""Language of pages: accuracy, the pull of each kind of evidence, odd inputs."""

import re
import time

from pyspark.sql import functions as F

from shelfmill.llm import language
from shelfmill.llm.queries import op9_language_id

SF = "/root/testdata/sf0.01"


def test_accuracy_on_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op9_language_id(spark, SF).collect()
    assert len(got) == len(pages)
    truth = {k: re.search(r"://[^/]*/([a-z]{2})/", p.url) for k, p in pages.items()}
    told = [r for r in got if truth[r.page_id]]
    assert sum(r.lang == truth[r.page_id].group(1) for r in told) / len(told) > 0.95
    assert all(0 < r.probability <= 1 for r in got)


def documents(spark):
    rows = [(i, f"the and of with {i} this", "en") for i in range(40)] + [(100 + i, f"le la des une {i} dans", "fr") for i in range(40)] + [(200, "x", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_evidence_besides_text(spark):
    french, english = "<p>le la des une dans</p>", "<p>the and of with this</p>"
    rows = [(i, f"http://a.fr/fr/{i}", f'<html lang="fr">{french}') for i in range(30)] + [(50 + i, f"http://b.com/{i}", f'<html lang="en">{english}') for i in range(30)]
    rows += [(100, "http://a.fr/fr/x", '<html lang="fr">'), (101, "http://b.com/", "<html>"), (102, None, None), (103, "odd", french), (103, "odd", french)]
    pages = spark.createDataFrame([(*r, "n") for r in rows], "page_id long, url string, html string, n string")
    got = {}
    for r in language.identify(pages, documents(spark)).collect():
        got.setdefault(r.page_id, []).append(r)
    assert all(got[i][0].lang == "fr" for i in range(30)) and all(got[50 + i][0].lang == "en" for i in range(30))
    assert got[100][0].lang == "fr" and got[101][0].lang == "en"
    assert got[102][0].lang in ("en", "fr") and [r.lang for r in got[103]] == ["fr", "fr"]


def test_without_languages_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.fr/", "<p>le")], "page_id long, url string, html string")
    nothing = documents(spark).limit(0)
    assert language.identify(pages, nothing).first().lang is None
    assert language.identify(pages.limit(0), documents(spark)).count() == 0


def test_markup_is_taken_out(spark):
    cases = [
        ("a<script>x</script >b<style>y</style>c<!-- d --> e<p class='f'>g&amp;h", "a b c  e g h"),
        ("1 < 2 <b>3", "1 < 2  3"),
        ("a<!-- never closed <p>b", "a "),
        ("a<script>never closed", "a "),
        ("a<p never closed", "a "),
    ]
    df = spark.createDataFrame(cases, "html string, expected string")
    assert all(r.got == r.expected for r in df.select("expected", language.visible_text(F.col("html")).alias("got")).collect())
    tags = [("<html lang=en>", "en"), ("<HTML data-x='1' LANG = 'FR-ca'>", "fr"), ('<html data-lang="de">', ""), ('<html class="x"lang="it">', "it"), ('<html xml:lang="es">', "es"), ("<html><p lang=en>", ""), ("", "")]
    df = spark.createDataFrame(tags, "html string, expected string")
    assert all(r.got == r.expected for r in df.select("expected", language.declared_language(F.col("html")).alias("got")).collect())


def test_hostile_pages_are_read_in_linear_time(spark):
    size = 1_000_000
    units = ["<", "<a", "<!--", "<script ", "<style", "<html ", "<html lang", "lang ", "</script ", "&am"]
    df = spark.createDataFrame([(u * (size // len(u)),) for u in units], "html string").repartition(len(units))
    start = time.monotonic()
    df.select(language.visible_text(F.col("html")).alias("t"), language.declared_language(F.col("html")).alias("d")).agg(F.sum(F.length("t")), F.max("d")).collect()
    assert time.monotonic() - start < 20
    pages = spark.createDataFrame([(1, "http://" + "a" * size, ""), (2, "http://" + "a." * (size // 2) + "fr", "")], "page_id long, url string, html string")
    start = time.monotonic()
    assert language.identify(pages, documents(spark)).count() == 2
    assert time.monotonic() - start < 40
