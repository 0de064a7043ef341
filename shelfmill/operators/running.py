"""Order-dependent totals without gathering the table in one task.

A plain window without partitions would sort everything in a single task.
Here rows are range-partitioned by their order key, which may be any orderable
column, also a struct of several. Each range has a total, the totals before a
range are a window over one row per range, and every other window runs inside
one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfmill.session import stored


def _sum_before(value: str, by: Sequence[str], order: Sequence[str]) -> Column:
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0).cast("bigint"))


def sum_before(
    df: DataFrame, order: str, value: str, out: str, by: Sequence[str] = ()
) -> DataFrame:
    """Add the running sum of ``value`` over all earlier rows (exclusive).

    ``order`` may be of any orderable type; nulls come first. Rows with an
    equal key within a ``by`` group are ordered by a hash of the whole row, so
    that a key which many rows share is still split over the ranges. ``df`` is
    read twice, so callers pass a stored or cheap table.

    The ranges are written down once: their borders come from a sample, and a
    task that runs again must not see others.
    """
    by = list(by)
    keys = [*by, order, "_tie"]
    tied = df.withColumn("_tie", F.xxhash64(*df.columns))
    ranges = tied.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id())
    ranges = stored(ranges, "ranges")
    totals = ranges.groupBy(*by, "_range").agg(F.sum(value).cast("bigint").alias("_total"))
    # One row per range and group: without groups as many rows as ranges.
    starts = totals.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.col("_range").alias("_at"),
        _sum_before("_total", by, ["_range"]).alias("_start"),
    )
    same = F.col("_range") == F.col("_at")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    inside = ranges.withColumn("_inside", _sum_before(value, [*by, "_range"], [order, "_tie"]))
    return inside.join(starts, same).select(
        *df.columns, (F.col("_start") + F.col("_inside")).alias(out)
    )


def row_numbers(products: DataFrame, order: str = "seq", n_rows: str = "n_rows") -> DataFrame:
    """Number of the first output row of each product, counted over rows."""
    numbered = sum_before(products, order, n_rows, "_before")
    return numbered.withColumn("row_number", F.col("_before") + 1).drop("_before")


def limit_cutoff(
    products: DataFrame,
    limit: int,
    unit: str = "rows",
    order: str = "seq",
    n_rows: str = "n_rows",
) -> DataFrame:
    """One row with the order key of the last product the limit admits.

    ``unit='rows'`` admits a product while fewer than ``limit`` rows precede
    it, so products stay whole and the last may overshoot; ``'products'``
    counts products. The totals are the same for every limit, and no task
    gathers the leading rows.
    """
    if unit not in ("rows", "products"):
        raise ValueError(f"unknown limit unit {unit!r}")
    size = F.col(n_rows) if unit == "rows" else F.lit(1)
    narrow = products.select(F.col(order).alias("_key"), size.cast("bigint").alias("_size"))
    counted = sum_before(narrow, "_key", "_size", "_before")
    return counted.where(F.col("_before") < limit).agg(F.max("_key").alias("cutoff"))


def limit_products(
    products: DataFrame,
    limit: int,
    unit: str = "rows",
    order: str = "seq",
    n_rows: str = "n_rows",
) -> DataFrame:
    """Products the run limit admits; the cut-off is a scalar subquery."""
    cutoff = limit_cutoff(products, limit, unit, order, n_rows)
    return products.where(F.col(order) <= cutoff.scalar())


def first_cards(cards: DataFrame, n: int, order: str = "seq") -> DataFrame:
    """First ``n`` cards in order; zero keeps all."""
    return cards if n == 0 else limit_products(cards, n, unit="products", order=order)


def catalogue_cut(
    pages: DataFrame, stop: str = "stop", by: Sequence[str] = (), order: str = "page_num"
) -> DataFrame:
    """Pages up to and including the first one that ends the catalogue.

    The end is the smallest stopping page number: an aggregate, no window.
    """
    ends = pages.where(F.col(stop)).groupBy(*by).agg(F.min(order).alias("_end"))
    if not by:
        last = F.coalesce(ends.scalar(), F.lit((1 << 63) - 1))
        return pages.where(F.col(order) <= last)
    joined = pages.join(ends, list(by), "left")
    return joined.where(F.col("_end").isNull() | (F.col(order) <= F.col("_end"))).drop("_end")
