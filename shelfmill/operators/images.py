"""Image lists of product pages, as array expressions inside the page row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmill.functions.filters import is_image_noise, is_wide_enough
from shelfmill.functions.text import first_non_blank
from shelfmill.functions.urls import (
    clean_image_url,
    full_size_url,
    let,
    resolve_url,
    srcset_best,
)
from shelfmill.operators.dom import all_matches, first_match
from shelfmill.schemas import CDN_HOST, IMAGE_ATTRS, IMAGE_NOISE_WORDS, MIN_IMAGE_WIDTH


def image_candidate(
    attrs: Column, attr_order: list[str] = IMAGE_ATTRS, cdn_host: str = CDN_HOST
) -> Column:
    """Best source of an image element: srcset first, then single attributes."""
    chosen = first_non_blank(srcset_best(attrs["srcset"]), *[attrs[a] for a in attr_order])
    return let(
        let(chosen, clean_image_url), lambda url: full_size_url(url, cdn_host)
    )


def usable_images(
    image_attrs: Column,
    base_url: Column,
    noise_words: list[str] = IMAGE_NOISE_WORDS,
    min_width: int = MIN_IMAGE_WIDTH,
    attr_order: list[str] = IMAGE_ATTRS,
    cdn_host: str = CDN_HOST,
    fallback_attrs: Column | None = None,
) -> Column:
    """Distinct absolute image URLs, first seen first.

    ``image_attrs`` is an array of attribute maps in document order. The noise
    and width filters see the URL before it is made absolute. If nothing is
    left, the image with ``fallback_attrs`` is taken without filters.
    """
    found = F.transform(
        image_attrs,
        lambda a: F.struct(
            image_candidate(a, attr_order, cdn_host).alias("src"),
            a["width"].alias("width"),
        ),
    )
    kept = F.filter(
        found,
        lambda i: (i.src != "")
        & ~is_image_noise(i.src, noise_words)
        & is_wide_enough(i.width, min_width),
    )
    # The CDN rule runs once more behind the filters: a name may end in two size suffixes.
    sources = F.transform(kept, lambda i: full_size_url(i.src, cdn_host))
    if fallback_attrs is not None:
        spare = F.filter(
            F.array(full_size_url(image_candidate(fallback_attrs, attr_order, cdn_host), cdn_host)), lambda u: u != ""
        )
        sources = let(sources, lambda u: F.when(F.size(u) > 0, u).otherwise(spare))
    return F.array_distinct(F.transform(sources, lambda u: resolve_url(u, base_url)))


def page_images(
    selectors: dict[str, str],
    els: Column | str = "els",
    base_url: Column | str = "url",
    **options,
) -> Column:
    """Image list of a page; an empty list falls back to the main image."""
    base = F.col(base_url) if isinstance(base_url, str) else base_url
    return usable_images(
        F.transform(all_matches(selectors["extra_imgs"], els), lambda e: e.attrs),
        base,
        fallback_attrs=first_match(selectors["main_img"], els).attrs,
        **options,
    )


def main_image(images: Column) -> Column:
    return F.coalesce(F.get(images, F.lit(0)), F.lit(""))


def extra_images(images: Column) -> Column:
    return F.slice(images, 2, F.greatest(F.size(images) - 1, F.lit(0)))
