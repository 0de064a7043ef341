"""Cards merged with the product pages they link to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmill.functions.text import blank_to_null, first_non_blank, slugify
from shelfmill.operators.variants import default_variants
from shelfmill.schemas import DEFAULT_PRICE, DEFAULT_TITLE, VARIANT
from shelfmill.session import scatter_key

PRODUCT_FIELDS = ["title", "price", "raw_desc", "main_image", "extra_images", "variants"]


def one_per_url(products: DataFrame) -> DataFrame:
    """Latest record of each URL (highest fetch time, then lowest page id)."""
    recency = [
        F.col("fetched_at") if "fetched_at" in products.columns else F.lit(None).cast("timestamp"),
        -F.col("page_id") if "page_id" in products.columns else F.lit(0),
    ]
    return (
        products.groupBy("url")
        .agg(F.max_by(F.struct(*PRODUCT_FIELDS), F.struct(*recency)).alias("p"))
        .select("url", "p.*")
    )


def merge_cards(cards: DataFrame, products: DataFrame | None) -> DataFrame:
    """Field-wise fallback: product page, then card, then a default.

    ``products`` has one row per URL; None means card data only. A card with a
    link but no product page reports that link in ``failed_url``. A page price
    of "0.00" counts as a price and wins over the card. A ``handle`` of the
    cards is kept as ``card_handle``.
    """
    if "handle" in cards.columns:
        cards = cards.withColumnRenamed("handle", "card_handle")
    if products is None:
        held = cards.select("*", F.lit(None).cast("string").alias("_hit"), *[
            F.lit(None).cast(kind).alias(f"_{name}")
            for name, kind in zip(
                PRODUCT_FIELDS,
                ["string"] * 4 + ["array<string>", f"array<{VARIANT}>"],
            )
        ])
        failed = F.lit(None).cast("string")
    else:
        # Cards without a link cannot match; their keys spread them out.
        left = cards.withColumn("_link", scatter_key(blank_to_null("url"), F.col("seq")))
        right = products.select(
            F.col("url").alias("_link"),
            F.col("url").alias("_hit"),
            *[F.col(name).alias(f"_{name}") for name in PRODUCT_FIELDS],
        )
        held = left.join(right, "_link", "left")
        failed = F.when(F.col("_hit").isNull(), blank_to_null("url"))
    own = [c for c in ("page_id", "page_num", "card_handle") if c in held.columns]
    merged = held.select(
        *own,
        "seq",
        first_non_blank("_title", "title", default=DEFAULT_TITLE).alias("title"),
        first_non_blank("_price", "price", default=DEFAULT_PRICE).alias("price"),
        first_non_blank("_raw_desc", "descr").alias("raw_desc"),
        first_non_blank("_main_image", "image").alias("main_image"),
        F.coalesce("_extra_images", F.array().cast("array<string>")).alias("extra_images"),
        F.when(F.size("_variants") > 0, F.col("_variants")).alias("_found"),
        F.coalesce("url", F.lit("")).alias("source_url"),
        failed.alias("failed_url"),
    )
    return merged.select(
        *own,
        "seq",
        slugify("title").alias("handle"),
        "title",
        "price",
        "raw_desc",
        "main_image",
        "extra_images",
        F.coalesce("_found", default_variants(F.col("price"))).alias("variants"),
        "source_url",
        "failed_url",
    )


def final_handles(cards: DataFrame, products: DataFrame | None) -> DataFrame:
    """Cards with ``final_handle``, the handle that their merged record gets.

    The card travels through the join, nothing is joined back by its place.
    """
    if products is None:
        title = first_non_blank("title", default=DEFAULT_TITLE)
        return cards.withColumn("final_handle", slugify(title))
    left = cards.withColumn("_link", scatter_key(blank_to_null("url"), F.col("seq")))
    right = products.select(F.col("url").alias("_link"), F.col("title").alias("_title"))
    title = first_non_blank("_title", "title", default=DEFAULT_TITLE)
    held = left.join(right, "_link", "left")
    return held.select(*cards.columns, slugify(title).alias("final_handle"))


def failed_pages(cards: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct linked URLs without a product record."""
    links = cards.where(F.col("url") != "").select("url").distinct()
    return links.join(products.select("url"), "url", "left_anti")
