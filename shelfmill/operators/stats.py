"""Counters of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _whole_percent(part: Column, whole: Column) -> Column:
    """Integer percentage, computed on integers; 0 for an empty whole."""
    ratio = F.call_function("div", part * 100, F.nullif(whole, F.lit(0)))
    return F.coalesce(ratio, F.lit(0)).cast("bigint")


def run_stats(products: DataFrame, limit: int) -> DataFrame:
    """One row of run counters over the accepted products.

    Needs ``n_rows``, ``used_ai`` and ``failed_url``.
    """
    counted = products.agg(
        F.count("*").alias("total_products"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count_if("used_ai").alias("ai_success"),
        F.count_if(~F.col("used_ai")).alias("ai_fallback"),
        F.count("failed_url").alias("page_failures"),
    )
    tried = F.col("ai_success") + F.col("ai_fallback")
    progress = (
        F.least(F.lit(100).cast("bigint"), _whole_percent(F.col("total_products"), F.lit(limit)))
        if limit > 0
        else F.lit(0).cast("bigint")
    )
    return counted.select(
        "*",
        _whole_percent(F.col("ai_success"), tried).alias("ai_rate"),
        progress.alias("progress_pct"),
    )


def failed_urls(products: DataFrame) -> DataFrame:
    return products.where(F.col("failed_url").isNotNull()).select(
        F.col("failed_url").alias("url")
    )


def batch_stats(rows: DataFrame, batch: str, handle: str = "Handle") -> DataFrame:
    """Distinct handles and rows per batch."""
    return rows.groupBy(batch).agg(
        F.countDistinct(handle).alias("n_products"), F.count("*").alias("n_rows")
    )


def cards_per_page(pages: DataFrame, cards: DataFrame) -> DataFrame:
    """Card count of every page; pages without cards count zero."""
    counts = cards.groupBy("page_id").agg(F.count("*").alias("n_cards"))
    return (
        pages.select("page_id")
        .join(counts, "page_id", "left")
        .select("page_id", F.coalesce("n_cards", F.lit(0)).alias("n_cards"))
    )
