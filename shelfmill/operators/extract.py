"""Cards of catalogue pages and records of product pages.

Both work inside the row of a parsed page; cards are exploded only after they
shrank to a few strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmill.functions.prices import clean_price
from shelfmill.functions.text import first_non_blank, strip_tags
from shelfmill.functions.urls import clean_image_url, let, resolve_url
from shelfmill.operators.dom import (
    all_matches,
    build_selectors,
    descendants,
    element_text,
    explode_records,
    first_attr,
    first_match,
    inner_html,
    parse_pages,
)
from shelfmill.operators.images import extra_images, main_image, page_images
from shelfmill.operators.variants import page_variants
from shelfmill.schemas import (
    CARD_IMAGE_ATTRS,
    CARD_LINK_ATTRS,
    DEFAULT_PRICE,
    LINK_ATTRS,
    PAGE_COLUMNS,
)
from shelfmill.session import per_session

# Columns of a page that its cards keep.
CARD_PAGE = ("page_id", "catalogue", "page_num", "base")


def _parsed(pages: DataFrame) -> DataFrame:
    return pages if "els" in pages.columns else parse_pages(pages)


def walk_columns(pages: DataFrame) -> list[Column]:
    """What orders pages in a walk besides their id; null where the pages do not tell."""
    kinds = {"catalogue": "string", "page_num": "bigint"}
    return [
        (F.col(c) if c in pages.columns else F.lit(None)).cast(kind).alias(c)
        for c, kind in kinds.items()
    ]


def card_seq() -> Column:
    """Place of a card in the walk, as a struct that orders like the walk.

    Catalogues follow one another, inside one the pages by number, then by id,
    and on a page the cards by place. Ids and numbers may be any longs. Pages
    without a catalogue or number come before those that have one.
    """
    return F.struct(
        F.col("catalogue"),
        F.col("page_num"),
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("pos").cast("int").alias("place"),
    )


def card_name(seq: Column | str = "seq") -> Column:
    """Text that names a card by its page and its place there, the same in every run and batch."""
    seq = F.col(seq) if isinstance(seq, str) else seq
    return F.concat_ws("-", seq["catalogue"], seq["page_id"].cast("string"), seq["place"].cast("string"))


@per_session
def page_cards(selectors: dict[str, str]) -> Column:
    """Array of the cards of a parsed page, in document order."""
    els = F.col("els")

    def in_scope(card: Column) -> Column:
        def fields(scope: Column) -> Column:
            price = first_match(selectors["price"], els, within=scope)
            link = first_match(selectors["link"], els, within=scope)
            image = first_match("img", els, within=scope)
            return F.struct(
                element_text(first_match(selectors["title"], els, within=scope)).alias("title"),
                element_text(price).alias("price"),
                first_attr(image, CARD_IMAGE_ATTRS).alias("image"),
                element_text(first_match(selectors["desc"], els, within=scope)).alias("descr"),
                first_non_blank(
                    first_attr(link, LINK_ATTRS), first_attr(card, CARD_LINK_ATTRS)
                ).alias("href"),
            )

        return let(descendants(card), fields)

    return F.transform(all_matches(selectors["card"]), in_scope)


@per_session
def _card_columns() -> tuple[Column, list[Column]]:
    links = F.transform(
        F.array(clean_image_url("image"), F.col("href")), lambda u: resolve_url(u, F.col("base"))
    )
    return links, [
        F.col("page_id"),
        F.col("page_num"),
        card_seq().alias("seq"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce(clean_price("price"), F.lit(DEFAULT_PRICE)).alias("price"),
        F.get("_links", F.lit(0)).alias("image"),
        F.coalesce("descr", F.lit("")).alias("descr"),
        F.get("_links", F.lit(1)).alias("url"),
    ]


def finish_cards(raw: DataFrame) -> DataFrame:
    """Clean the raw strings of exploded cards (columns of ``page_cards``)."""
    links, columns = _card_columns()
    return raw.withColumn("_links", links).select(*columns)


def cards(pages: DataFrame, selectors: dict[str, str] | None = None) -> DataFrame:
    """Card table: page_id, page_num, seq, title, price, image, descr, url."""
    sels = selectors or build_selectors()
    parsed = _parsed(pages)
    found = parsed.select(
        "page_id", *walk_columns(parsed), F.col("url").alias("base"), page_cards(sels).alias("cards")
    )
    return finish_cards(explode_records(found, "cards", *CARD_PAGE))


@per_session
def _product_columns(
    selectors: dict[str, str], strict: bool, has_globals: bool, image_options: dict
) -> tuple[list[Column], list[Column]]:
    """Columns of the two steps of ``product_pages``."""
    window_json = F.col("window_json") if has_globals else None
    price = element_text(first_match(selectors["price"]))
    first = [
        F.coalesce(element_text(first_match(selectors["title"])), F.lit("")).alias("title"),
        F.coalesce(clean_price(price), F.lit(DEFAULT_PRICE)).alias("price"),
        inner_html(first_match(selectors["desc"])).alias("desc_html"),
        page_images(selectors, **image_options).alias("images"),
    ]
    second = [
        F.col("title"),
        F.col("price"),
        F.coalesce(strip_tags("desc_html"), F.lit("")).alias("raw_desc"),
        main_image(F.col("images")).alias("main_image"),
        extra_images(F.col("images")).alias("extra_images"),
        page_variants(selectors, F.col("price"), window_json, strict).alias("variants"),
    ]
    return first, second


def product_pages(
    pages: DataFrame,
    selectors: dict[str, str] | None = None,
    strict: bool = False,
    **image_options,
) -> DataFrame:
    """Product record of each page: title, price, raw_desc, images, variants."""
    sels = selectors or build_selectors()
    parsed = _parsed(pages).where(F.col("els").isNotNull())
    carried = [c for c in PAGE_COLUMNS if c in parsed.columns and c not in ("html", "window_json")]
    source = [c for c in ("html", "els", "texts", "window_json") if c in parsed.columns]
    first, second = _product_columns(sels, strict, "window_json" in source, image_options)
    return parsed.select(*carried, *source, *first).select(*carried, *second)
