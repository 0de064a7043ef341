"""Predicates on images and option values."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmill.functions.text import as_col
from shelfmill.schemas import (
    IMAGE_NOISE_WORDS,
    MIN_IMAGE_WIDTH,
    OPTION_PLACEHOLDERS,
)


def is_image_noise(src: Column | str, words: list[str] = IMAGE_NOISE_WORDS) -> Column:
    return F.lower(as_col(src)).rlike("|".join(re.escape(w) for w in words))


def is_wide_enough(width: Column | str, minimum: int = MIN_IMAGE_WIDTH) -> Column:
    """False only for an all-digit width below the minimum."""
    w = as_col(width)
    return ~F.coalesce(
        w.rlike(r"\A[0-9]+\z") & (w.try_cast("decimal(38,0)") < minimum), F.lit(False)
    )


def is_option_placeholder(value: Column | str) -> Column:
    return F.lower(as_col(value)).isin(OPTION_PLACEHOLDERS)


def real_options(values: Column | str) -> Column:
    """Distinct option values in first-seen order, placeholders removed."""
    kept = F.filter(
        as_col(values), lambda v: v.isNotNull() & ~is_option_placeholder(v)
    )
    return F.array_distinct(kept)
