"""Registered queries: every operator run over the whole given tables.

Product and card data that the tables lack is derived from their columns, so
each query grows with its tables. ``plans.oracle`` holds the matching SQL.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmill.functions import filters, prices, text, urls
from shelfmill.operators import batches, dedup, dom, extract, formatter, images, merge, navigation
from shelfmill.operators import rows as product_rows
from shelfmill.operators import running, stats, variants
from shelfmill.plans.catalogue import CatalogueJob, SharedWalk, build_catalogue, export_catalogue
from shelfmill.schemas import DEFAULT_PRICE, VARIANT_FIELDS
from shelfmill.session import cut_lineage, ensure_checkpoint_dir, spread, tune
from shelfmill.sinks import commits
from shelfmill.sinks.files import (
    append_to_export,
    derive_review_path,
    write_failed_urls,
    write_import,
    write_review,
    write_summary,
)
from shelfmill.sources.tables import (
    exported_handles,
    read_export,
    read_pages,
    read_seeds,
    stream_pages,
)
from shelfmill.streaming.export import distinct_handles as stream_distinct_handles
from shelfmill.streaming.export import start_export, start_handle_export, use_disk_state

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(sf_dir, f"{name}.parquet"))


def _spread(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table for costly work per row, over all cores."""
    return spread(_table(spark, sf_dir, name).select(*columns))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_pages(spark, posixpath.join(sf_dir, "pages.parquet"))


def _scratch(spark: SparkSession) -> str:
    """New folder below the shared checkpoint folder."""
    return posixpath.join(ensure_checkpoint_dir(spark), f"export-{uuid.uuid4().hex}")


def _str(c: str) -> Column:
    return F.col(c).cast("string")


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)").cast("string")


def _cat(*parts: Column | str) -> Column:
    """Concatenation; plain strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _joined(c: str) -> Column:
    return F.array_join(c, "|")


# -- pages: parsing, selectors, text ------------------------------------------
ARTICLE_SELECTORS = dom.build_selectors({"title": "h1", "desc": "article"})


def _page_titles(pages: DataFrame) -> DataFrame:
    return dom.parse_pages(pages).select(
        "page_id",
        "url",
        F.coalesce(dom.element_text(dom.first_match("h1")), F.lit("")).alias("title"),
    )


def _page_products(pages: DataFrame) -> DataFrame:
    """Pages read as products: heading, article text, address."""
    found = extract.product_pages(pages, ARTICLE_SELECTORS)
    return found.withColumn("handle", text.slugify("title")).withColumn("seq", F.col("page_id"))


@query
def page_handles(spark, sf_dir):
    titles = _page_titles(_pages(spark, sf_dir))
    return titles.select("page_id", "title", text.slugify("title").alias("handle"))


@query
def page_links(spark, sf_dir):
    parsed = dom.parse_pages(_pages(spark, sf_dir))
    links = F.transform(dom.all_matches("a[href]"), lambda e: F.struct(e.attrs["href"].alias("href")))
    return dom.explode_records(parsed.select("page_id", links.alias("l")), "l", "page_id")


@query
def resolved_links(spark, sf_dir):
    parsed = dom.parse_pages(_pages(spark, sf_dir))
    links = F.transform(dom.all_matches("a"), lambda e: F.struct(dom.first_attr(e, ["href"]).alias("href")))
    found = dom.explode_records(parsed.select("page_id", "url", links.alias("l")), "l", "page_id", "url")
    return found.select(
        "page_id",
        "pos",
        urls.resolve_url("href", "url").alias("link"),
        urls.resolve_root_url("href", "url").alias("root_link"),
    )


@query
def relative_links(spark, sf_dir):
    """Reference resolution with dot segments, queries and fragments."""
    pages = _pages(spark, sf_dir).select("page_id", "url")
    href = F.expr(
        "stack(5, 'next', '../up/./x', '?p=2', '#top', concat('/a/../b/', page_id)) as href"
    )
    return pages.select("page_id", "url", href).select(
        "page_id", "href", urls.resolve_url("href", "url").alias("link")
    )


@query
def article_text(spark, sf_dir):
    parsed = dom.parse_pages(_pages(spark, sf_dir))
    article = dom.inner_html(dom.first_match("article"))
    return parsed.select("page_id", article.alias("a")).select(
        "page_id", text.strip_tags("a").alias("article")
    )


@query
def element_counts(spark, sf_dir):
    found = dom.elements(_pages(spark, sf_dir), content=False)
    return found.groupBy("tag").agg(F.count("*").alias("n"))


@query
def selector_counts(spark, sf_dir):
    """Matches per page of each selector form."""
    parsed = dom.parse_pages(_pages(spark, sf_dir))
    forms = {
        "by_tag": "li",
        "by_class": ".ad",
        "by_attr": "[href]",
        "by_attr_value": "meta[charset='utf-8']",
        "by_substring": "a[href*='/t']",
        "negated": "a:not([href*='/t'])",
        "descendant": "nav a",
        "child": "ul > li",
        "listed": "h1, footer",
    }
    return parsed.select(
        "page_id", *[F.size(dom.all_matches(s)).alias(name) for name, s in forms.items()]
    )


@query
def records(spark, sf_dir):
    return dom.extract_records(_pages(spark, sf_dir), "nav li", {"label": "a"})


@query
def first_in_document(spark, sf_dir):
    """A selector list yields the earliest element, not the earliest alternative."""
    parsed = dom.parse_pages(_pages(spark, sf_dir))
    first = dom.first_match("h1, div.ad, footer")
    return parsed.select("page_id", first.tag.alias("tag"), dom.element_text(first).alias("text"))


@query
def cards_per_page(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    cards = extract.cards(pages, dom.build_selectors({"card": "li", "title": "a"}))
    return stats.cards_per_page(pages, cards)


@query
def page_cards(spark, sf_dir):
    """List items read as cards, with an overridden selector set."""
    found = extract.cards(_pages(spark, sf_dir), dom.build_selectors({"card": "li", "title": "a"}))
    return found.select("page_id", "seq.place", "title", "price", "image", "descr", "url")


@query
def dedup_first(spark, sf_dir):
    cards = _page_titles(_pages(spark, sf_dir)).select(
        "page_id", F.col("page_id").alias("seq"), text.slugify("title").alias("handle"), "title"
    )
    return dedup.first_per_handle(cards).select("handle", "page_id", "title")


@query
def hyperlinks(spark, sf_dir):
    return _pages(spark, sf_dir).select(
        "page_id",
        text.image_link("url").alias("image_link"),
        text.source_link("url").alias("source_link"),
        text.source_link(F.lit("")).alias("blank_link"),
    )


def _import_rows(spark, sf_dir) -> DataFrame:
    unique = dedup.first_per_handle(_page_products(_pages(spark, sf_dir)))
    products = formatter.format_descriptions(unique.withColumnRenamed("url", "source_url"))
    return product_rows.import_rows(products)


@query
def import_rows(spark, sf_dir):
    return _import_rows(spark, sf_dir)


@query
def review_rows(spark, sf_dir):
    return product_rows.review_rows(_import_rows(spark, sf_dir))


@query
def profile_rows(spark, sf_dir):
    return product_rows.profile_rows(_import_rows(spark, sf_dir), "card_only").drop("pos")


@query
def csv_round_trip(spark, sf_dir):
    """Import rows written as CSV and read back."""
    path = _scratch(spark)
    write_import(_import_rows(spark, sf_dir), path)
    return read_export(spark, path).na.fill("")


@query
def review_round_trip(spark, sf_dir):
    path = _scratch(spark)
    write_review(_import_rows(spark, sf_dir), path)
    return read_export(spark, path).na.fill("")


@query
def resume_from_export(spark, sf_dir):
    """Pages whose handle an earlier export of half the languages lacks."""
    path = _scratch(spark)
    cards = cut_lineage(
        _page_products(_pages(spark, sf_dir)).withColumn(
            "lang", F.regexp_extract("url", r"^https?://[^/]+/([a-z]+)/", 1)
        )
    )
    earlier = formatter.format_descriptions(
        cards.where(F.col("lang").isin("en", "de")).withColumnRenamed("url", "source_url")
    )
    write_import(product_rows.import_rows(earlier), path)
    new = dedup.not_exported(cards, exported_handles(spark, path))
    return dedup.first_per_handle(new).select("page_id", "handle")


@query
def appended_export(spark, sf_dir):
    """Rows of two languages appended to an export of the others."""
    rows = cut_lineage(
        _import_rows(spark, sf_dir).withColumn(
            "lang", F.regexp_extract("Source URL", r"^https?://[^/]+/([a-z]+)/", 1)
        )
    )
    is_new = F.col("lang").isin("fr", "es")
    path = _scratch(spark)
    write_import(rows.where(~is_new), path)
    prior = read_export(spark, path).na.fill("")
    both = append_to_export(prior, rows.where(is_new))
    return both.select("Handle", "Title", "Variant Price")


@query
def stream_export(spark, sf_dir):
    """Handles of a streamed page table, exported once each."""
    pages = stream_pages(spark, sf_dir, glob="pages.parquet")
    cards = _page_titles(pages).select(
        F.col("page_id").alias("seq"), "title", text.slugify("title").alias("handle")
    )
    folder = _scratch(spark)
    ledger = posixpath.join(folder, "ledger")
    start_handle_export(cards, ledger, posixpath.join(folder, "state")).awaitTermination()
    return spark.read.parquet(ledger).select("handle", "title", "seq")


@query
def stream_catalogue(spark, sf_dir):
    """Both outputs written from a stream of pages, read back as rows."""
    folder = _scratch(spark)
    output = posixpath.join(folder, "upload.csv")
    job = CatalogueJob(
        limit=None,
        use_product_pages=False,
        selectors={"card": "article", "title": "h1", "price": "h6", "desc": "h6"},
    )
    start_export(
        stream_pages(spark, sf_dir, glob="pages.parquet"),
        output,
        posixpath.join(folder, "ledger"),
        posixpath.join(folder, "state"),
        job,
    ).awaitTermination()
    written = read_export(spark, output).na.fill("")
    return written.select("Handle", "Title", "Body (HTML)", "Option1 Value", "Variant Price")


@query
def stream_late_products(spark, sf_dir):
    """Lists in one batch, product pages after a restart in another: the rows of one batch run."""
    folder = _scratch(spark)
    source, output = posixpath.join(folder, "pages"), posixpath.join(folder, "upload.csv")
    crawl = _part_crawl(spark, sf_dir)
    is_list = F.contains("url", F.lit("/list/"))
    job = CatalogueJob(limit=None, selectors={"card": "li[data-product-id]"})
    for part in (crawl.where(is_list), crawl.where(~is_list)):
        part.write.mode("append").parquet(source)
        start_export(
            stream_pages(spark, source),
            output,
            posixpath.join(folder, "ledger"),
            posixpath.join(folder, "state"),
            job,
            wait_batches=1,
        ).awaitTermination()
    written = read_export(spark, output).na.fill("")
    return written.select(
        "Handle", "Title", "Body (HTML)", "Option1 Name", "Option1 Value", "Variant Price", "Image Src"
    )


@query
def export_and_resume(spark, sf_dir):
    """Half of the lists exported to files, the rest by a resumed run; both files read back.

    The first list of the second run begins with a card that the first exported.
    """
    output = posixpath.join(_scratch(spark), "upload.csv")
    crawl = _part_crawl(spark, sf_dir)
    n = _table(spark, sf_dir, "part").count()
    for start, end, resume in ((1, n // 2, False), (n // 2 + 1, n, True)):
        job = CatalogueJob(
            limit=None,
            resume=resume,
            url_pattern="https://shop.example/list/{}",
            page_start=start,
            page_end=end,
        )
        export_catalogue(crawl, output, job)
    written = read_export(spark, output).na.fill("")
    review = read_export(spark, derive_review_path(output)).na.fill("")
    titles = review.groupBy(F.col("Product Handle (URL Slug)").alias("Handle")).agg(
        F.count("*").alias("n_review_rows")
    )
    return written.join(titles, "Handle").select(
        "Handle", "Title", "Body (HTML)", "Option1 Name", "Option1 Value", "Variant Price", "Image Src", "n_review_rows"
    )


@query
def committed_export(spark, sf_dir):
    """Half of the lists exported, then a run that died between its files, then a resumed run.

    What the dead run wrote of the second half is not read; the resumed run writes it to both files.
    """
    output = posixpath.join(_scratch(spark), "upload.csv")
    crawl = _part_crawl(spark, sf_dir)
    n = _table(spark, sf_dir, "part").count()
    job = CatalogueJob(limit=None, url_pattern="https://shop.example/list/{}", page_end=n // 2)
    export_catalogue(crawl, output, job, as_unit=True)
    rest = replace(job, resume=True, page_start=n // 2 + 1, page_end=n)
    lost = build_catalogue(crawl, rest, commits.committed_handles(spark, output))
    write_import(lost.rows, commits.run_folder(output, "died"))
    export_catalogue(crawl, output, rest, files=4, as_unit=True)
    written = commits.read_committed(spark, output).na.fill("")
    review = commits.read_committed(spark, output, derive_review_path(output)).na.fill("")
    titles = review.groupBy(F.col("Product Handle (URL Slug)").alias("Handle")).agg(
        F.count("*").alias("n_review_rows")
    )
    return written.join(titles, "Handle").select(
        "Handle", "Title", "Body (HTML)", "Option1 Name", "Option1 Value", "Variant Price", "Image Src", "n_review_rows"
    )


@query
def seed_list(spark, sf_dir):
    """A written seed list with odd lines: usable seeds and rejects."""
    path = posixpath.join(_scratch(spark), "seeds")
    key = _str("page_id")
    line = F.when(F.col("page_id") % 7 == 0, _cat("ftp://host/", key)).when(
        F.col("page_id") % 11 == 0, F.lit("  ")
    ).otherwise(_cat("  ", F.col("url"), " "))
    _pages(spark, sf_dir).select(line.alias("value")).write.text(path)
    usable, rejects = read_seeds(spark, path)
    return usable.withColumn("usable", F.lit(True)).unionByName(rejects.withColumn("usable", F.lit(False)))


@query
def page_seeds(spark, sf_dir):
    """Seed check on page addresses: usable ones and their scheme."""
    seeds = _pages(spark, sf_dir).select(text.strip_ws("url").alias("seed"))
    return seeds.select("seed", F.col("seed").startswith("http").alias("usable"))


# -- scalars -------------------------------------------------------------------
@query
def clean_prices(spark, sf_dir):
    raw = _cat(" $", _money("p_retailprice"), " - was ", F.lit(None).cast("string"))
    return _table(spark, sf_dir, "part").select(
        "p_partkey",
        prices.clean_price(_cat("USD ", _money("p_retailprice"), " ")).alias("price"),
        prices.clean_price(_cat("$", _str("p_size"), " - $", _str("p_partkey"))).alias("joined"),
        prices.clean_price(F.col("p_name")).alias("without_digits"),
        prices.clean_price(raw).alias("missing"),
    )


@query
def normalized_prices(spark, sf_dir):
    orders = _spread(spark, sf_dir, "orders", "o_orderkey", "o_totalprice", "o_orderpriority", "o_custkey")
    return orders.select(
        "o_orderkey",
        prices.normalize_price(_str("o_totalprice"), F.lit("9.99")).alias("price"),
        prices.normalize_price(
            (F.col("o_totalprice") / 1000).cast("string"), F.lit("9.99")
        ).alias("fine_price"),
        prices.normalize_price("o_orderpriority", F.lit("9.99")).alias("unparsable"),
        prices.normalize_price(_str("o_custkey"), F.lit("9.99"), always_minor_units=True).alias(
            "minor_units"
        ),
    )


@query
def price_amounts(spark, sf_dir):
    items = _table(spark, sf_dir, "lineitem")
    return items.groupBy("l_returnflag").agg(
        F.sum(prices.price_amount(prices.clean_price(_cat("$", _money("l_extendedprice")))))
        .cast("decimal(28,2)")
        .alias("amount")
    )


@query
def cdn_urls(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    slug = text.slugify("p_name")
    return part.select(
        "p_partkey",
        urls.full_size_url(
            _cat("https://cdn.shopify.com/s/", slug, "_", _str("p_size"), "x", _str("p_partkey"), ".jpg?v=1")
        ).alias("both"),
        urls.full_size_url(_cat("https://cdn.shopify.com/s/", slug, "_x", _str("p_size"), ".png")).alias("height"),
        urls.full_size_url(_cat("https://img.example/s/", slug, "_", _str("p_size"), "x.png")).alias("other_host"),
    )


@query
def srcset_best(spark, sf_dir):
    part = _spread(spark, sf_dir, "part", "p_partkey", "p_size")
    srcset = _cat(
        "/s/", _str("p_partkey"), ".jpg ", _str("p_size"), "w, /m/", _str("p_partkey"), ".jpg 25w,/d.jpg 2x"
    )
    return part.select(
        "p_partkey",
        urls.srcset_best(srcset).alias("widest"),
        urls.srcset_best(_cat(srcset, ", /bare.jpg")).alias("bare_last"),
        urls.clean_image_url(_cat("//img.example/", _str("p_partkey"))).alias("with_scheme"),
    )


@query
def image_filter(spark, sf_dir):
    """Noise, width and duplicate rules on lists of image attributes."""
    part = _spread(spark, sf_dir, "part", "p_partkey", "p_size")
    key = _str("p_partkey")

    def attrs(src: Column, width: Column | None = None) -> Column:
        pairs = [F.lit("src"), src]
        return F.create_map(*pairs, *([F.lit("width"), width] if width is not None else []))

    listed = F.array(
        attrs(_cat("/i/", key, ".png"), (F.col("p_size") * 4).cast("string")),
        attrs(_cat("/Icon/", key, ".png")),
        attrs(_cat("//img.example/", _str("p_size"), ".svg"), F.lit("50px")),
        attrs(_cat("//img.example/", _str("p_size"), ".svg")),
        attrs(F.when(F.col("p_size") > 25, "loading.gif").otherwise("")),
    )
    found = images.usable_images(listed, F.lit("https://shop.example/p/1"))
    return part.select("p_partkey", found.alias("u")).select(
        "p_partkey",
        images.main_image(F.col("u")).alias("main_image"),
        F.array_join(images.extra_images(F.col("u")), "|").alias("extra_images"),
    )


@query
def fallback_html(spark, sf_dir):
    return _spread(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", text.fallback_html("text").alias("body_html")
    )


@query
def fence_cleanup(spark, sf_dir):
    return _spread(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id",
        text.clean_response(_cat("\n```html\n", F.col("text"), "\n```\n")).alias("fenced"),
        text.clean_response("text").alias("plain"),
    )


@query
def document_handles(spark, sf_dir):
    """Whole texts as titles: handle and visible text."""
    return _spread(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", text.slugify("text").alias("handle"), text.squeeze_ws("text").alias("squeezed")
    )


@query
def prompts(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select(
        "doc_id", text.prompt("text", "Rewrite as HTML.\n").alias("prompt")
    )


@query
def formatted_descriptions(spark, sf_dir):
    """User formatter on documents; it rejects texts in one language."""

    def shout(batch):
        return [None if " und " in t else "```html\n<p>" + str(len(t)) + "</p>\n```" for t in batch]

    docs = _spread(spark, sf_dir, "documents", "doc_id", "text").withColumn("seq", F.col("doc_id"))
    done = formatter.format_descriptions(docs, shout, text="text", instructions="")
    return done.select("doc_id", "body_html", "used_ai")


@query
def kept_answers(spark, sf_dir):
    """A second run asks only for the texts that the first, on one language, did not."""
    path = _scratch(spark)
    docs = _spread(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("seq", F.col("doc_id"))

    def run(products, name):
        def fn(batch):
            return [f"<p>{name} {len(t)}</p>" for t in batch]

        return formatter.format_descriptions(products, fn, text="text", instructions="", answers=path)

    run(docs.where(F.col("lang") == "en"), "first")
    return run(docs, "second").select("doc_id", "body_html", "used_ai")


@query
def card_handles(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    title = F.when(F.col("p_size") > 5, F.col("p_name")).otherwise("")
    return part.select("p_partkey", text.card_handle(title, F.col("p_partkey")).alias("handle"))


@query
def attribute_labels(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    key = _cat("attribute_pa_", F.col("event_type"), "-kind_3d")
    return events.groupBy(text.attribute_label(key).alias("label")).agg(F.count("*").alias("n"))


# -- cards and product pages built from part and orders -----------------------------
def _order_pages(spark, sf_dir) -> DataFrame:
    """A catalogue page per order with two cards; the second lacks its title."""
    orders = _table(spark, sf_dir, "orders")
    key = _str("o_orderkey")
    html = _cat(
        '<html><body><div class="grid"><div class="product-card"><a href="/o/', key,
        '"><img data-src="//img.example/', key, '.jpg"><h1>Order ', key, " ", F.col("o_orderpriority"),
        '</h1></a><span class="compare-price">$1</span><span class="price">$ ', _money("o_totalprice"),
        '</span><p class="product-description">Status <b>', F.col("o_orderstatus"),
        '</b></p></div><div class="old product-tile" data-url="c/', _str("o_custkey"),
        '"><a><span data-price="">', _str("o_custkey"), "</span></a></div></div></body></html>",
    )
    return orders.select(
        F.col("o_orderkey").alias("page_id"),
        _cat("https://shop.example/list/", key).alias("url"),
        html.alias("html"),
    )


@query
def order_cards(spark, sf_dir):
    found = extract.cards(_order_pages(spark, sf_dir))
    return found.select("page_id", "seq.place", "title", "price", "image", "descr", "url")


def _part_title() -> Column:
    return _cat(F.col("p_name"), " ", F.col("p_brand"), " ", _str("p_partkey"))


def _part_pages(spark, sf_dir) -> DataFrame:
    """A product page per part; its options come in one of four forms."""
    part = _table(spark, sf_dir, "part")
    key, size = _str("p_partkey"), _str("p_size")
    price_cents = (F.col("p_partkey") * 10 + 500).cast("string")
    script = _cat(
        '<script type="application/json">{broken</script>'
        '<script id="product-meta">{"variants":[]}</script>'
        '<script id="product-json">{"options":["Size",{"name":"Type"}],"variants":'
        '[{"option1":"', size, '","option2":"', F.col("p_type"), '","sku":"S', key, '","price":', price_cents,
        '},{"option1":"XL","option2":null,"price":null}]}</script>',
    )
    form = _cat(
        '<form class="cart variations_form" data-product_variations="[{&quot;attributes&quot;:'
        "{&quot;attribute_pa_frame-size&quot;:&quot;", size, "&quot;,&quot;attribute_type&quot;:&quot;",
        F.col("p_type"), "&quot;},&quot;sku&quot;:&quot;F", key, "&quot;,&quot;display_price&quot;:", size,
        '}]"></form>',
    )
    select = _cat(
        '<select name="options[size]"><option>Choose<option value="', size, '">S</option><option>Blue'
        '<option value="', size, '">T</select>',
    )
    options = (
        F.when(F.col("p_size") <= 10, script)
        .when(F.col("p_size") <= 20, form)
        .when(F.col("p_size") <= 40, select)
        .otherwise("")
    )
    html = _cat(
        '<html><body><h1 class="product-title"> ', _part_title(), '\n</h1><span class="price">$',
        _money("p_retailprice"), '</span><div id="product-description"><p>A ', F.lower("p_type"),
        " part.<p>By ", F.col("p_brand"), '</div><div class="product-gallery"><img src="/img/', key,
        '.png" width="', (F.col("p_size") * 10).cast("string"), '"><img srcset="//cdn.shopify.com/s/', key,
        "_100x.jpg 100w, //cdn.shopify.com/s/", key, '_900x.jpg 900w"><img src="/img/blank.gif"></div>',
        options, "</body></html>",
    )
    return part.select(
        F.col("p_partkey").alias("page_id"),
        _cat("https://shop.example/p/", key).alias("url"),
        html.alias("html"),
        "p_size",
        _part_title().alias("p_title"),
    )


@query
def part_product_pages(spark, sf_dir):
    found = extract.product_pages(_part_pages(spark, sf_dir))
    return found.select(
        "page_id", "url", "title", "price", "raw_desc", "main_image",
        _joined("extra_images").alias("extra_images"),
        F.size("variants").cast("bigint").alias("n_variants"),
    )


@query
def part_page_variants(spark, sf_dir):
    found = extract.product_pages(_part_pages(spark, sf_dir)).select("page_id", "variants")
    return dom.explode_records(found, "variants", "page_id")


def _part_crawl(spark, sf_dir) -> DataFrame:
    """Numbered list pages with two cards each, and the product pages of most
    parts. Lists overlap, so every part but the first is seen twice."""
    products = _part_pages(spark, sf_dir)
    part = _table(spark, sf_dir, "part")

    def card(key: Column, title: Column) -> Column:
        return _cat(
            '<li data-product-id="', key, '"><a href="../p/', key, '"><h1>', title,
            '</h1></a><i class="price">$7.50</i><img src="/thumb/', key, '.png"></li>',
        )

    following = part.select(
        (F.col("p_partkey") - 1).alias("p_partkey"),
        _str("p_partkey").alias("next_key"),
        _part_title().alias("next_title"),
    )
    lists = part.join(following, "p_partkey", "left").select(
        (F.col("p_partkey") + (1 << 40)).alias("page_id"),
        _cat("https://shop.example/list/", (F.col("p_partkey") + 1).cast("string")).alias("url"),
        _cat(
            "<ul>", card(_str("p_partkey"), _part_title()),
            F.coalesce(card(F.col("next_key"), F.col("next_title")), F.lit("")), "</ul>",
        ).alias("html"),
    )
    stored = products.where(F.col("p_size") > 3).select("page_id", "url", "html")
    # A stored crawl has many files; this one is built from a single small file.
    return lists.unionByName(stored).repartition(spark.sparkContext.defaultParallelism)


def _part_catalogue(spark, sf_dir):
    """Job over the list pages of the part crawl.

    The list lengths vary with the data, so the range ends at the last list.
    """
    n_lists = _table(spark, sf_dir, "part").count()
    job = CatalogueJob(
        limit=None, url_pattern="https://shop.example/list/{}", page_start=1, page_end=n_lists
    )
    return build_catalogue(_part_crawl(spark, sf_dir), job)


_CATALOGUE_COLUMNS = [
    "seq.page_num", "seq.place", "pos", "Handle", "Title", "Body (HTML)", "Option1 Name", "Option1 Value",
    "Variant Price", "Image Src", "Source URL",
]


@query
def catalogue_rows(spark, sf_dir):
    return _part_catalogue(spark, sf_dir).rows.select(*_CATALOGUE_COLUMNS)


@query
def catalogue_limited(spark, sf_dir):
    """The same job with a row limit that cuts at every scale: one row for each part."""
    n = _table(spark, sf_dir, "part").count()
    job = CatalogueJob(
        limit=n, url_pattern="https://shop.example/list/{}", page_start=1, page_end=n
    )
    return build_catalogue(_part_crawl(spark, sf_dir), job).rows.select(*_CATALOGUE_COLUMNS)


@query
def catalogue_rejects(spark, sf_dir):
    """Catalogue pages that a run could not use: no HTML, a failed or a late fetch."""
    key = F.col("page_id")
    pages = _pages(spark, sf_dir).select(
        "page_id",
        "url",
        F.when(key % 7 > 0, F.col("html")).alias("html"),
        F.when(key % 11 == 0, "timeout").when(key % 5 == 0, "Error").alias("status"),
    )
    return build_catalogue(pages, CatalogueJob(limit=None, use_product_pages=False)).rejects


def _many_catalogues(spark, sf_dir) -> DataFrame:
    """List pages of several catalogues with equal page numbers, negative and very large ids.

    A page has a titled card, one whose title other pages have too, and an untitled one.
    """
    key = _str("p_partkey")
    html = _cat(
        '<ul><li class="product"><h2>Own ', key, '</h2></li><li class="product"><h2>Shared ',
        (F.col("p_partkey") % 37).cast("string"), '</h2></li><li class="product"><b>', key, "</b></li></ul>",
    )
    return _table(spark, sf_dir, "part").select(
        F.when(F.col("p_partkey") % 2 == 0, F.col("p_partkey") * (1 << 40)).otherwise(-F.col("p_partkey")).alias("page_id"),
        _cat("https://", F.lower(F.regexp_replace("p_brand", "[^A-Za-z0-9]", "")), ".example/list/", key).alias("url"),
        html.alias("html"),
        F.when(F.col("p_brand") != "Brand#1", F.col("p_brand")).alias("catalogue"),
        F.when(F.col("p_size") > 5, F.col("p_size").cast("bigint")).alias("page_num"),
    )


@query
def multi_catalogue_rows(spark, sf_dir):
    """Both policies over several catalogues; without a limit, with the least one and with one that cuts at every scale."""
    pages = _many_catalogues(spark, sf_dir)
    n = _table(spark, sf_dir, "part").count()
    found, shared = None, SharedWalk()
    for policy in ("first", "sequential"):
        for limit in (None, 1, n):
            job = CatalogueJob(
                limit=limit, dedup=policy, use_product_pages=False,
                selectors={"card": "li.product", "title": "h2", "price": "b"},
            )
            rows = build_catalogue(pages, job, shared=shared).rows.select(
                F.lit(policy).alias("policy"), F.lit(limit or 0).cast("bigint").alias("row_limit"),
                "seq.page_id", "seq.place", "Handle", "Title", "Variant Price",
            )
            found = rows if found is None else found.unionByName(rows)
    return found


@query
def catalogue_status(spark, sf_dir):
    """Every fifth page fetched again without success: the rows stay, under both policies."""
    crawl = _part_crawl(spark, sf_dir).withColumn("status", F.when(F.col("page_id") % 3 > 0, "OK"))
    crawl = crawl.withColumn("fetched_at", F.lit("2026-01-01").cast("timestamp"))
    again = crawl.where(F.col("page_id") % 5 == 0).select(
        (F.col("page_id") + (1 << 41)).alias("page_id"),
        "url",
        F.lit("<h1>503 Service Unavailable</h1>").alias("html"),
        F.when(F.col("page_id") % 2 == 0, "error").otherwise("timeout").alias("status"),
        F.lit("2026-02-01").cast("timestamp").alias("fetched_at"),
    )
    pages = crawl.unionByName(again)
    n = _table(spark, sf_dir, "part").count()
    found = []
    for policy in ("first", "sequential"):
        job = CatalogueJob(
            limit=None, dedup=policy, url_pattern="https://shop.example/list/{}", page_start=1, page_end=n
        )
        rows = build_catalogue(pages, job).rows.select(*_CATALOGUE_COLUMNS)
        found.append(rows.withColumn("policy", F.lit(policy)))
    return found[0].unionByName(found[1])


@query
def deep_pages(spark, sf_dir):
    """Headings below more than 600 nested blocks."""
    depth = F.col("p_size") + 600
    pages = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("page_id"),
        F.lit("https://shop.example/deep").alias("url"),
        _cat(
            "<div id=a>", F.repeat(F.lit("<div>"), depth), "<h1>", F.col("p_name"), " <b>x</b></h1>",
            F.repeat(F.lit("</div>"), depth), "</div><h1>outside</h1>",
        ).alias("html"),
    )
    return dom.elements(pages, "#a h1").select("page_id", "node", "parent", "text", "inner_html")


@query
def variant_fall_through(spark, sf_dir):
    """Product records and variation forms that break off, and the page's options behind them."""
    key = _str("p_partkey")
    good = _cat('{"attributes":{"attribute_color":"c', key, '"},"display_price":5}')
    form = (
        F.when(F.col("p_size") % 4 == 1, F.lit('[{"attributes":[]}]'))
        .when(F.col("p_size") % 4 == 2, _cat("[", good, ',"x"]'))
        .otherwise(_cat("[", good, "]"))
    )
    record = F.when(
        F.col("p_size") % 4 == 3,
        _cat('<script type="application/json">{"options":["Size"],"variants":[{"option1":"L', key, '"},7]}</script>'),
    ).otherwise(F.lit(""))
    pages = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("page_id"),
        F.lit("https://shop.example/p").alias("url"),
        _cat(
            record, "<form class='variations_form' data-product_variations='", form, "'></form>",
            '<select name="option"><option value="">Choose</option><option value="Red ', key, '">r</option></select>',
        ).alias("html"),
    )
    found = extract.product_pages(pages).select("page_id", "variants")
    return dom.explode_records(found, "variants", "page_id").select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "opt1_name", "opt1_value"
    )


@query
def image_suffixes(spark, sf_dir):
    """Two size suffixes in one name, behind the filters and as the fallback."""
    base = _cat("https://cdn.shopify.com/s/", _str("p_partkey"))
    twice = F.create_map(F.lit("src"), F.concat(base, F.lit("_100x_200x.jpg")))
    narrow = F.create_map(F.lit("src"), F.concat(base, F.lit("_n.jpg")), F.lit("width"), F.lit("1"))
    spare = F.create_map(F.lit("src"), F.concat(base, F.lit("_m_300x_400x.jpg")))
    listed = F.when(F.col("p_size") % 2 == 0, F.array(twice, narrow)).otherwise(F.array(narrow))
    found = images.usable_images(listed, F.lit("https://shop.example/"), fallback_attrs=spare)
    return _table(spark, sf_dir, "part").select("p_partkey", F.array_join(found, ",").alias("found"))


@query
def catalogue_stats(spark, sf_dir):
    return _part_catalogue(spark, sf_dir).stats


@query
def next_button_state(spark, sf_dir):
    """Next links of order pages: present, disabled or missing."""
    orders = _table(spark, sf_dir, "orders")
    key = _str("o_orderkey")
    link = F.when(
        F.col("o_orderstatus") == "F",
        _cat('<a class="next" href="/list/', key, '?p=2">Next</a>'),
    ).when(
        F.col("o_orderstatus") == "O",
        _cat('<a class="next is-disabled" href="/list/', key, '?p=3">Next</a>'),
    ).otherwise(_cat('<a class="next" aria-disabled="', F.lower(
        F.when(F.col("o_custkey") > 500, "TRUE").otherwise("FALSE")), '" href="?p=4">Next</a>'))
    pages = orders.select(
        F.col("o_orderkey").alias("page_id"),
        _cat("https://shop.example/list/", key).alias("url"),
        _cat('<div class="product-item">x</div>', link).alias("html"),
    )
    return navigation.next_links(dom.parse_pages(pages), "a.next", ".product-item")


# -- joins -------------------------------------------------------------------------
def _merge_inputs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Cards from part with gaps, product records from lineitem by part."""
    part = _table(spark, sf_dir, "part")
    cards = part.select(
        F.col("p_partkey").alias("seq"),
        F.when(F.col("p_size") > 5, F.col("p_name")).otherwise("").alias("title"),
        F.when(F.col("p_size") > 8, _money("p_retailprice")).otherwise("").alias("price"),
        F.when(F.col("p_size") > 25, _cat("/i/", _str("p_partkey"))).otherwise("").alias("image"),
        F.col("p_type").alias("descr"),
        F.when(F.col("p_brand") == "Brand#1", "").otherwise(_cat("/p/", _str("p_partkey"))).alias("url"),
    )
    # Parts without a large order have no page; all lines are read to tell.
    large = F.col("l_quantity") >= 45
    top = (
        _table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.count_if(large).alias("n"),
            F.max(F.when(large, F.col("l_extendedprice"))).alias("top_price"),
        )
        .where(F.col("n") > 0)
    )
    products = top.select(
        _cat("/p/", _str("l_partkey")).alias("url"),
        F.when(F.col("n") > 2, _cat("Part ", _str("l_partkey"))).otherwise("").alias("title"),
        F.when(F.col("n") > 1, _money("top_price")).otherwise(DEFAULT_PRICE).alias("price"),
        F.lit("").alias("raw_desc"),
        F.when(F.col("n") > 3, _cat("/m/", _str("l_partkey"))).otherwise("").alias("main_image"),
        F.when(F.col("n") > 4, F.array(F.lit("/x/1"), F.lit("/x/2"))).otherwise(
            F.array().cast("array<string>")
        ).alias("extra_images"),
        F.when(
            F.col("n") > 2,
            F.array(variants.make_variant(F.lit("1.00"), opt1_name="Size", opt1_value="L")),
        ).alias("variants"),
    )
    return cards, products


@query
def card_page_merge(spark, sf_dir):
    cards, products = _merge_inputs(spark, sf_dir)
    merged = merge.merge_cards(cards, products)
    return merged.select(
        "seq", "handle", "title", "price", "raw_desc", "main_image",
        F.size("extra_images").cast("bigint").alias("n_extra"),
        F.col("variants")[0].opt1_value.alias("first_option"),
        F.col("variants")[0].price.alias("first_price"),
        "source_url",
        F.coalesce("failed_url", F.lit("")).alias("failed_url"),
    )


@query
def card_only_merge(spark, sf_dir):
    cards, _ = _merge_inputs(spark, sf_dir)
    merged = merge.merge_cards(cards, None)
    return merged.select(
        "seq", "title", "price", "main_image", F.col("variants")[0].price.alias("first_price")
    )


@query
def failed_urls(spark, sf_dir):
    cards, products = _merge_inputs(spark, sf_dir)
    return merge.failed_pages(cards, products)


def _part_cards(spark, sf_dir) -> DataFrame:
    title = _cat(F.col("p_name"), " ", F.col("p_brand"), " ", _str("p_size"))
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("seq"), text.slugify(title).alias("handle")
    )


def _sold_handles(spark, sf_dir) -> DataFrame:
    sold = (
        _table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("seq"))
        .agg(F.max("l_quantity").alias("most"))
        .where(F.col("most") == 50)
    )
    return dedup.known_handles(_part_cards(spark, sf_dir).join(sold, "seq", "left_semi"))


@query
def resume_anti(spark, sf_dir):
    return dedup.not_exported(_part_cards(spark, sf_dir), _sold_handles(spark, sf_dir))


@query
def known_handles(spark, sf_dir):
    """Exported and newly accepted handles together."""
    new = _table(spark, sf_dir, "part").select(text.slugify("p_name").alias("handle"))
    return dedup.known_handles(_sold_handles(spark, sf_dir), new)


@query
def dedup_reference(spark, sf_dir):
    """Sequential acceptance: tested on one handle, recorded under another."""
    cards = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("seq"),
        _cat("size-", _str("p_size")).alias("handle"),
        _cat("size-", (F.col("p_partkey") * 7 % 50 + 1).cast("string")).alias("final_handle"),
    )
    return dedup.accept_in_order(cards)


@query
def handle_collisions(spark, sf_dir):
    products = _table(spark, sf_dir, "part").select(
        text.slugify("p_name").alias("handle"), _str("p_partkey").alias("source_url")
    )
    return dedup.handle_collisions(products)


# -- rows and variants ---------------------------------------------------------------
def _array_products(spark, sf_dir) -> DataFrame:
    """Products with one to four variants and zero to five extra images."""
    key = _str("p_partkey")
    variant_numbers = F.sequence(F.lit(1), F.col("p_size") % 4 + 1)
    image_numbers = F.sequence(F.lit(0), F.col("p_size") % 6)
    product = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("seq"),
        text.slugify("p_name").alias("handle"),
        F.col("p_name").alias("title"),
        _cat("<p>", F.col("p_type"), "</p>").alias("body_html"),
        _cat("https://shop.example/p/", key).alias("source_url"),
        _cat("/main/", key).alias("main_image"),
        F.transform(
            F.slice(image_numbers, 2, 6), lambda i: _cat("/extra/", key, "/", i.cast("string"))
        ).alias("extra_images"),
        F.transform(
            variant_numbers,
            lambda i: variants.make_variant(
                _money("p_retailprice"),
                opt1_name="Size",
                opt1_value=i.cast("string"),
                opt2_name="Brand",
                opt2_value=F.col("p_brand"),
                sku=_cat(key, "-", i.cast("string")),
                price=F.when(i > 1, _cat(i.cast("string"), ".00")),
            ),
        ).alias("variants"),
    )
    return product.withColumn("n_rows", product_rows.n_rows())


@query
def variant_rows(spark, sf_dir):
    return product_rows.import_rows(_array_products(spark, sf_dir))


@query
def merged_axes(spark, sf_dir):
    """Older eight-column profile: option values joined into one axis."""
    products = _array_products(spark, sf_dir)
    merged = products.withColumn("variants", variants.merge_axes(F.col("variants")))
    return product_rows.profile_rows(product_rows.import_rows(merged), "single_axis")


@query
def variant_priority(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    base = _money("p_retailprice")

    def one(name: str) -> Column:
        return F.array(variants.make_variant(base, opt1_name=name, opt1_value=_str("p_size")))

    none = F.array().cast(f"array<struct<{','.join(f'{f}:string' for f in VARIANT_FIELDS)}>>")
    picked = variants.pick_variants(
        [
            F.when(F.col("p_size") > 40, one("json")).otherwise(none),
            F.when(F.col("p_size") > 25, one("form")),
            F.when(F.col("p_size") > 10, one("option")).otherwise(none),
        ],
        base,
    )
    return part.select("p_partkey", picked.alias("v")).select(
        "p_partkey",
        F.col("v")[0].opt1_name.alias("name"),
        F.col("v")[0].opt1_value.alias("value"),
        F.col("v")[0].price.alias("price"),
    )


@query
def option_overflow(spark, sf_dir):
    """Five option axes: axes three to five joined, with and without axis three."""
    part = _spread(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    doc = _cat(
        '{"options":["Size","Brand",{"name":"Type"},{"label":"Key"},null],"variants":[{"option1":"',
        _str("p_size"), '","option2":"', F.col("p_brand"), '","option3":"', F.col("p_type"),
        '","option4":', _str("p_partkey"), ',"option5":"',
        F.when(F.col("p_size") > 25, "big").otherwise(""), '","sku":"K', _str("p_partkey"), '","price":"',
        _money("p_retailprice"), '"}]}',
    )
    base = F.lit("5.00")
    return part.select(
        "p_partkey",
        variants.product_json_variants(doc, base)[0].alias("v"),
        variants.product_json_variants(doc, base, strict=True)[0].alias("s"),
    ).select(
        "p_partkey", "v.*", F.col("s.opt3_name").alias("strict_name"),
        F.col("s.opt3_value").alias("strict_value"),
    )


@query
def json_variants(spark, sf_dir):
    """Product records built around the JSON of events."""
    events = _spread(spark, sf_dir, "events", "event_id", "event_type", "props")
    doc = _cat(
        '{"options":[{"name":"Kind"}],"variants":[{"option1":"', F.col("event_type"),
        '","sku":null,"price":', F.get_json_object("props", "$.k"), "},", F.col("props"), "]}",
    )
    found = events.select(
        "event_id", variants.product_json_variants(doc, F.lit("1500.00")).alias("v")
    )
    return dom.explode_records(found, "v", "event_id").select(
        "event_id", "pos", "opt1_name", "opt1_value", "sku", "price"
    )


@query
def form_variants(spark, sf_dir):
    """Variation forms with none, two or four attributes."""
    part = _spread(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    two = _cat('"attribute_pa_shoe-size":"', _str("p_size"), '","attribute_brand":"', F.col("p_brand"), '"')
    four = _cat(two, ',"attribute_type":"', F.col("p_type"), '","attribute_pa_3d":"', _str("p_partkey"), '"')
    attrs = F.when(F.col("p_size") <= 10, "").when(F.col("p_size") <= 30, two).otherwise(four)
    doc = _cat('[{"attributes":{', attrs, '},"sku":"F', _str("p_partkey"), '","display_price":',
               _money("p_retailprice"), "}]")
    found = part.select(
        "p_partkey", variants.variation_form_variants(doc, F.lit("3.00"))[0].alias("v")
    )
    return found.select("p_partkey", "v.*")


@query
def dom_options(spark, sf_dir):
    """Option values from event kinds: placeholders and repeats dropped."""
    events = _spread(spark, sf_dir, "events", "event_id", "event_type", "props")
    kind = F.col("event_type")
    values = F.array(
        F.lit("Select"), kind, F.initcap(kind), F.lit(""), kind, F.lit("please select"),
        F.get_json_object("props", "$.k"),
    )
    found = events.select(
        "event_id", variants.option_variants(values, F.lit("2.00")).alias("v")
    )
    return dom.explode_records(found, "v", "event_id").select(
        "event_id", "pos", "opt1_name", "opt1_value", "price"
    )


@query
def image_widths(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    width = F.when(F.col("p_size") > 25, _cat(_str("p_size"), "px")).otherwise(
        (F.col("p_size") * 5).cast("string")
    )
    return part.select(
        "p_partkey",
        filters.is_wide_enough(width).alias("wide"),
        filters.is_wide_enough(width, 100).alias("wide_v1"),
        filters.is_image_noise(_cat("/", F.upper("p_type"), "ICON.png")).alias("noise"),
    )


# -- order, limits, statistics ---------------------------------------------------------
def _order_sizes(spark, sf_dir) -> DataFrame:
    """Orders as products: as many rows as lines, at least one."""
    lines = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("seq"),
        "o_orderstatus",
        "o_custkey",
        F.coalesce("n", F.lit(1)).alias("n_rows"),
    )


@query
def row_numbers(spark, sf_dir):
    sized = cut_lineage(_order_sizes(spark, sf_dir))
    return running.row_numbers(sized).select("seq", "n_rows", "row_number")


@query
def row_numbers_by_customer(spark, sf_dir):
    sized = cut_lineage(_order_sizes(spark, sf_dir))
    return running.sum_before(sized, "seq", "n_rows", "rows_before", by=["o_custkey"]).select(
        "seq", "o_custkey", "rows_before"
    )


@query
def limit_rows(spark, sf_dir):
    sized = cut_lineage(_order_sizes(spark, sf_dir))
    return running.limit_products(sized, 1000).select("seq", "n_rows")


@query
def limit_rows_large(spark, sf_dir):
    """A limit that cuts at every scale: half of all rows."""
    sized = cut_lineage(_order_sizes(spark, sf_dir))
    half = sized.agg((F.sum("n_rows") / 2).cast("long").alias("n")).first().n
    return running.limit_products(sized, half).select("seq", "n_rows")


@query
def limit_products(spark, sf_dir):
    sized = cut_lineage(_order_sizes(spark, sf_dir))
    return running.limit_products(sized, 1000, unit="products").select("seq", "n_rows")


@query
def first_cards(spark, sf_dir):
    cards = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("seq"), "p_name")
    return running.first_cards(cards, 50)


def _event_pages(spark, sf_dir, new_above: int) -> DataFrame:
    """Events bucketed to catalogue pages of one kind each; large values are new."""
    return (
        _table(spark, sf_dir, "events")
        .groupBy("event_type", F.floor(F.col("event_id") / 100).alias("page_num"))
        .agg(
            F.count("*").alias("n_cards"),
            F.count_if(F.col("value") > new_above).alias("n_new"),
            F.when(F.min("value") < 0.05, "error").otherwise("ok").alias("status"),
        )
    )


@query
def catalogue_cut(spark, sf_dir):
    return navigation.end_of_catalogue(_event_pages(spark, sf_dir, 100), by=("event_type",))


@query
def catalogue_cut_single(spark, sf_dir):
    pages = _event_pages(spark, sf_dir, 200).groupBy("page_num").agg(
        F.sum("n_cards").alias("n_cards"), F.sum("n_new").alias("n_new"),
        F.max("status").alias("status"),
    )
    return navigation.end_of_catalogue(pages)


@query
def page_range(spark, sf_dir):
    """Pages of a numbered catalogue read back from their address."""
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("page_id"),
        _cat("https://shop.example/c/", _str("o_custkey"), "/page/").alias("url"),
    )
    last = _table(spark, sf_dir, "customer").count() // 2
    found = navigation.pattern_pages(orders, "https://shop.example/c/{}/page/", 10, last)
    return found.select("page_id", "page_num")


@query
def single_page(spark, sf_dir):
    """The page at one address: here the first in the alphabet."""
    pages = _pages(spark, sf_dir)
    seed = pages.agg(F.min("url")).first()[0]
    return navigation.single_page(pages, seed).select("page_id", "url", "page_num")


@query
def pattern_urls(spark, sf_dir):
    """Numbered list addresses of every customer, ten orders to a page."""
    catalogues = (
        _table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.ceil(F.count("*") / 10).alias("end"))
        .select(
            "o_custkey",
            _cat("https://shop.example/c/", _str("o_custkey"), "?page={}").alias("template"),
            F.lit(1).cast("bigint").alias("start"),
            "end",
        )
    )
    return navigation.expand_patterns(catalogues).select("o_custkey", "page_num", "url")


@query
def next_chain(spark, sf_dir):
    """Chains of parts; a part of the largest size has a disabled next link."""
    part = _table(spark, sf_dir, "part")
    links = cut_lineage(part.select(
        _cat("/p/", _str("p_partkey")).alias("url"),
        F.when(F.col("p_size") < 50, _cat("/p/", (F.col("p_partkey") + 1).cast("string"))).alias("next_url"),
    ))
    targets = links.where(F.col("next_url").isNotNull()).select(F.col("next_url").alias("url"))
    seeds = links.join(targets, "url", "left_anti").select(F.col("url").alias("seed"))
    return navigation.follow_links(links, seeds)


@query
def converging_seeds(spark, sf_dir):
    """Chains of 500 parts that suppliers lead into; parts of size 1 and every second supplier are seeds."""
    part, supplier = _table(spark, sf_dir, "part"), _table(spark, sf_dir, "supplier")
    n = part.agg(F.max("p_partkey")).scalar()
    parts = part.select(
        _cat("/p/", _str("p_partkey")).alias("url"),
        F.when(F.col("p_partkey") % 500 != 0, _cat("/p/", (F.col("p_partkey") + 1).cast("string"))).alias("next_url"),
        (F.col("p_size") == 1).alias("is_seed"),
    )
    suppliers = supplier.select(
        _cat("/s/", _str("s_suppkey")).alias("url"),
        _cat("/p/", (F.col("s_suppkey") * 37 % n + 1).cast("string")).alias("next_url"),
        (F.col("s_suppkey") % 2 == 0).alias("is_seed"),
    )
    links = cut_lineage(parts.unionByName(suppliers))
    return navigation.nearest_seeds(links, links.where("is_seed").select(F.col("url").alias("seed")))


def _run_products(spark, sf_dir) -> DataFrame:
    return _order_sizes(spark, sf_dir).select(
        "seq",
        "n_rows",
        (F.col("o_orderstatus") == "F").alias("used_ai"),
        F.when(F.col("o_orderstatus") == "P", _cat("/o/", _str("seq"))).alias("failed_url"),
    )


@query
def run_stats(spark, sf_dir):
    return stats.run_stats(_run_products(spark, sf_dir), 20_000)


@query
def run_failures(spark, sf_dir):
    return stats.failed_urls(_run_products(spark, sf_dir))


@query
def failed_file(spark, sf_dir):
    """URLs of failed pages, written one a line and read back."""
    path = _scratch(spark)
    write_failed_urls(stats.failed_urls(_run_products(spark, sf_dir)), path)
    return spark.read.text(path).withColumnRenamed("value", "url")


@query
def summary_file(spark, sf_dir):
    """Counters of two runs appended to one table, with how many runs it holds."""
    path = _scratch(spark)
    products = _run_products(spark, sf_dir)
    for part in (products.where(~F.col("used_ai")), products):
        made = stats.run_stats(part, 20_000)
        write_summary(made, path, datetime.now(timezone.utc))
    runs = spark.read.schema(made.schema.add("finished_at", "timestamp")).json(path)
    return runs.where("finished_at is not null").drop("finished_at")


@query
def distinct_handles(spark, sf_dir):
    """Handles of a stream of pages, kept once in operator state on disk."""
    folder = _scratch(spark)
    use_disk_state(spark)
    titles = _page_titles(stream_pages(spark, sf_dir, glob="pages.parquet"))
    cards = titles.select(text.slugify("title").alias("handle"))
    written = posixpath.join(folder, "handles")
    stream = stream_distinct_handles(cards).writeStream.format("parquet").trigger(availableNow=True)
    stream.option("checkpointLocation", posixpath.join(folder, "state")).start(written).awaitTermination()
    return spark.read.schema("handle string").parquet(written)


@query
def acceptance_chain(spark, sf_dir):
    """Every part records the handle of the next one, so each hangs on the part before it."""
    part = _table(spark, sf_dir, "part").where(F.col("p_partkey") % 1000 > 0)
    cards = part.select(
        F.col("p_partkey").alias("seq"),
        _cat("part-", _str("p_partkey")).alias("handle"),
        _cat("part-", (F.col("p_partkey") + 1).cast("string")).alias("final_handle"),
    )
    return dedup.accept_in_order(cards)


@query
def batch_rows(spark, sf_dir):
    """Orders as products, closed to a batch at 100 rows."""
    sized = cut_lineage(_order_sizes(spark, sf_dir))
    batched = batches.form_batches(sized, 100)
    return batches.batch_report(batched, handle="o_custkey")


@query
def batch_rows_by_status(spark, sf_dir):
    """The same for each status on its own."""
    sized = cut_lineage(_order_sizes(spark, sf_dir))
    batched = batches.form_batches(sized, 25, by=["o_orderstatus"])
    return batches.batch_report(batched, handle="o_custkey", by=["o_orderstatus"])


@query
def batch_stats(spark, sf_dir):
    rows = _spread(spark, sf_dir, "documents", "source", "text").select(
        F.col("source").alias("batch"), text.slugify("text").alias("Handle")
    )
    return stats.batch_stats(rows, "batch")
