"""Price expressions. Exported prices are strings, as the file format wants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmill.functions.text import as_col, first_non_blank
from shelfmill.schemas import DEFAULT_PRICE

_NUMBER = r"\A\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"


def clean_price(raw: Column | str) -> Column:
    """Keep digits and dots only; nothing left means the default price."""
    return first_non_blank(
        F.regexp_replace(as_col(raw), r"(?U)[^\d.]", ""), default=DEFAULT_PRICE
    )


def number_or_null(raw: Column | str) -> Column:
    """Double value of a plain decimal literal, else null."""
    c = as_col(raw).cast("string")
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def normalize_price(
    raw: Column | str, default: Column | str, always_minor_units: bool = False
) -> Column:
    """Two-decimal price text; large numbers are read as minor units.

    Numbers above 1000 are divided by 100 (``always_minor_units`` divides every
    number). The pattern formatter rounds the exact binary value half-even.
    """
    n = number_or_null(raw)
    in_minor = F.lit(True) if always_minor_units else n > 1000
    amount = F.when(in_minor, n / 100).otherwise(n)
    return F.coalesce(
        F.call_function("format_number", amount, F.lit("0.00")), as_col(default)
    )


def price_amount(price: Column | str) -> Column:
    """Typed twin of an exported price, for analytics."""
    return as_col(price).try_cast("decimal(18,2)")
