"""Value tables of the scalar functions, quirks included."""

import random
import re
import time
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from shelfmill.functions import filters, prices, text, urls

CASES = {
    "strip": (
        text.strip_ws,
        {"  a b ": "a b", " x　": "x", "\x1cy\x1f": "y", "\n": "", "": "", None: None},
    ),
    "slug": (
        text.slugify,
        {
            "Blue Shirt": "blue-shirt",
            "  --Été à  Paris!! ": "t-paris",
            "İstanbul": "i-stanbul",
            "###": "",
            "A_B": "a-b",
            "": "",
        },
    ),
    "price": (
        prices.clean_price,
        {
            "$ 12.50 ": "12.50",
            "$5 - $9": "59",
            "1.299,00": "1.29900",
            "Rs. 99": ".99",
            "free": "0.00",
            "": "0.00",
            "٣٤": "٣٤",
            None: "0.00",
        },
    ),
    "normalize": (
        lambda c: prices.normalize_price(c, F.lit("D")),
        {
            "999": "999.00",
            "1000": "1000.00",
            "1299": "12.99",
            "12.5": "12.50",
            "0.125": "0.12",
            "2.675": "2.67",
            "1e4": "100.00",
            " 7 ": "7.00",
            "12d": "D",
            "abc": "D",
            "": "D",
            None: "D",
        },
    ),
    "tags": (
        text.strip_tags,
        {
            "<p>a</p><p>b &amp; c</p>": "a b &amp; c",
            " <img src='x'> ": "<img src='x'>",
            "no tags": "no tags",
            "a\n\n <b>c</b>": "a c",
            "a <b>c</b> < d < e": "a c < d < e",
            "1 < 2 > 3": "1 3",
            "<<": "<<",
            "": "",
        },
    ),
    "label": (
        text.attribute_label,
        {
            "attribute_pa_shoe-size": "Shoe-Size",
            "attribute_3d": "3D",
            "pa_color": "Pa_Color",
            "attribute_COLOR": "Color",
            "": "",
        },
    ),
    "fallback": (
        text.fallback_html,
        {
            "a\n\nb\nc": "<p>a</p><p>b c</p>",
            " \n ": "<p>No description available.</p>",
            "": "<p>No description available.</p>",
            "1 < 2": "<p>1 < 2</p>",
        },
    ),
    "fences": (
        text.clean_response,
        {
            "```html\n<p>x</p>\n```": "<p>x</p>",
            " <p>x</p> ": "<p>x</p>",
            "```\na\n```\n": "a",
            "``````": "",
            "a```b": "a```b",
        },
    ),
    "link": (
        text.image_link,
        {
            "http://a/b.png": '=HYPERLINK("http://a/b.png","View Image")',
            'http://a/"b': '=HYPERLINK("http://a/%22b","View Image")',
            "/rel": "/rel",
            "": "",
        },
    ),
    "image_url": (urls.clean_image_url, {"//a/b": "https://a/b", "/c": "/c", "": "", None: ""}),
    "cdn": (
        urls.full_size_url,
        {
            "https://cdn.shopify.com/a_1024x.jpg": "https://cdn.shopify.com/a.jpg",
            "https://cdn.shopify.com/a_600x600.png?v=1": "https://cdn.shopify.com/a.png?v=1",
            "https://cdn.shopify.com/a_x600.jpeg": "https://cdn.shopify.com/a.jpeg",
            "https://cdn.shopify.com/a_600x600.PNG": "https://cdn.shopify.com/a_600x600.PNG",
            "https://other.com/a_600x600.png": "https://other.com/a_600x600.png",
        },
    ),
    "srcset": (
        urls.srcset_best,
        {
            "a 100w, b 200w, c 200w": "b",
            "a 1x, b 2x": "",
            "a 300w, bare, b 200w": "bare",
            "bare": "bare",
            "a 300w, bare, b 400w": "b",
            " a  10ww ": "a",
            "": "",
            None: "",
        },
    ),
    "noise": (
        filters.is_image_noise,
        {"/a/Placeholder.png": True, "data:image/png": True, "/x.svg": False, "/i.svg+xml": True},
    ),
    "width": (
        filters.is_wide_enough,
        {"79": False, "80": True, "50px": True, "": True, None: True, "0": False},
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_value_table(evaluate, name):
    fn, table = CASES[name]
    assert evaluate(fn, list(table)) == list(table.values())


def test_minor_unit_option(evaluate):
    fn = lambda c: prices.normalize_price(c, F.lit("D"), always_minor_units=True)
    assert evaluate(fn, ["999", "1299"]) == ["9.99", "12.99"]


def test_root_only_rule(evaluate):
    fn = lambda c: urls.resolve_root_url(c, F.lit("https://h.com/a/b"))
    assert evaluate(fn, ["/x", "y", "//z/w", "http://q", ""]) == [
        "https://h.com/x", "y", "https://z/w", "http://q", "",
    ]


def test_real_options(evaluate):
    given = [["Choose", "Red", "red", "Red", "", "Please Select", "Blue", None]]
    assert evaluate(filters.real_options, given, "array<string>") == [["Red", "red", "Blue"]]


def test_card_handle(spark):
    df = spark.createDataFrame([("A b", 1), ("", 2), (None, 3)], "t string, s bigint")
    got = [r.h for r in df.select(text.card_handle("t", "s").alias("h")).collect()]
    assert got == ["a-b", "item-2", "item-3"]


def test_strings_agree_with_python(evaluate):
    rng = random.Random(5)
    alphabet = list(" \t\n\x1c\x85  aBé1<>$.٣") + ["</p>", "\n\n"]
    words = ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(500)]
    assert evaluate(text.strip_ws, words) == [w.strip() for w in words]
    assert evaluate(text.slugify, words) == [
        re.sub("[^a-z0-9]+", "-", w.lower()).strip("-") for w in words
    ]
    assert evaluate(text.strip_tags, words) == [
        re.sub(r"\s+", " ", re.sub("<[^>]+>", " ", w.strip())).strip() or w.strip() for w in words
    ]
    assert evaluate(prices.clean_price, words) == [
        re.sub(r"[^\d.]", "", w) or "0.00" for w in words
    ]


def test_resolution_agrees_with_urllib(spark):
    rng = random.Random(7)
    bits = ["a", "b", "..", ".", "/", "//", "?", "#", "x=1", ";p", "%20", "c d", "é", ":", "mailto:"]
    hrefs = ["".join(rng.choices(bits, k=rng.randint(1, 6))) for _ in range(400)]
    hrefs += ["#f", "?q", "?", "../../../g", "HTTPS://B/x", "javascript:void(0)", " /x", ".", "x//y"]
    bases = ["http://a.com", "http://a.com/", "https://a.com/b/c/d;p?q=1#z", "http://a.com/b/../c/./d", ""]
    pairs = [(h, b) for h in hrefs for b in bases]

    def expected(h, b):
        if not h or h.startswith("http"):
            return h
        return "https:" + h if h.startswith("//") else urljoin(b, h)

    df = spark.createDataFrame(pairs, "h string, b string")
    got = df.select("h", "b", urls.resolve_url("h", "b").alias("r")).collect()
    wrong = [(r.h, r.b, r.r) for r in got if r.r != expected(r.h, r.b)]
    assert not wrong


def test_long_runs_take_linear_time(evaluate):
    long = ["<" * 400_000, " " * 400_000 + "x" + " " * 400_000, "a" + " " * 400_000 + "b"]
    start = time.perf_counter()
    assert evaluate(text.strip_tags, long) == ["<" * 400_000, "x", "a b"]
    assert time.perf_counter() - start < 20


def test_plain_references_take_the_short_way(spark):
    """Without taking both addresses apart, and with the result of doing so."""
    bases = ["https://shop.example" + p for p in ("/", "/list", "/list/7", "/a/b/c", "/a/b/")]
    refs = ["p", "p/1", "/p/1.html", "../p/1", "p/?a=b&c=d", "/p"]
    odd = ["./p", "../../p", "/../p", "p;q", "a b", "c:d", "?x", "#f", "/", "//h/p", "p//q", "", "p/..", "p/.", "/p#f"]
    rows = [(h, b) for h in refs + odd for b in [*bases, "https://shop.example", "/rel", "https://h/a//b", "https://h/a/../b", "https://h/?q=/x"]]
    df = spark.createDataFrame(rows, "h string, b string")
    found = df.select("h", "b", urls.resolve_url("h", "b").alias("u"), urls._plain_url(F.col("h"), F.col("b")).alias("plain")).collect()
    for r in found:
        assert r.plain in (None, r.u)
        expected = urljoin(r.b, r.h)
        if r.h and r.b.startswith("http") and r.plain is not None:
            assert r.plain == expected, (r.h, r.b)
    short = {(r.h, r.b) for r in found if r.plain is not None}
    assert {h for h, b in short} == set(refs) and ("../p/1", "https://shop.example/list") not in short
    assert len(short) >= 20
