"""Batches of a run: products in order, closed as soon as they hold enough rows.

A batch begins behind the one before it, so where batches lie follows from a
chain: each product that could begin one leads to the product behind the one
that would close it. The chain is followed inside blocks of rows first, for
every number of rows that the batch open at a block's begin may still need. What
leads from block to block is followed by pointer doubling: a few states a block,
not a link a product. Batches longer than a block may be are found from links of
products, by an equi-join on slices of the running row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfmill.operators.blocks import block_steps, number_blocks
from shelfmill.operators.navigation import follow_links
from shelfmill.operators.running import sum_before
from shelfmill.session import stored

# Rows of a slice: a start is compared with no more products than that.
SLICE = 64
# Rows of a block, which one task follows at a time; batches may have a quarter of that.
BLOCK = 1 << 18


def _next_starts(counted: DataFrame, size: int) -> DataFrame:
    """``start, next``: the product behind the one that closes a batch begun at ``start``.

    Products are named by group and by the rows before them. The closing one
    holds the batch's row number ``size``.
    """
    first, last = F.col("_before"), F.col("_before") + F.col("_n") - 1
    held = counted.select(
        "_group",
        (last + 1).alias("stop"),
        first.alias("low"),
        last.alias("high"),
        F.explode(F.sequence(F.floor(first / SLICE), F.floor(last / SLICE))).alias("slice"),
    )
    wanted = counted.select(
        F.col("_group").alias("g"), first.alias("start"), (first + size - 1).alias("row")
    ).withColumn("at", F.floor(F.col("row") / SLICE))
    same = (F.col("_group") == F.col("g")) & (F.col("slice") == F.col("at"))
    found = wanted.join(held, same & F.col("row").between(F.col("low"), F.col("high")))
    return found.select(F.struct("g", "start").alias("start"), F.struct("g", F.col("stop").alias("start")).alias("next"))


def form_batches(
    products: DataFrame,
    size: int,
    order: str = "seq",
    n_rows: str = "n_rows",
    by: Sequence[str] = (),
) -> DataFrame:
    """Add ``batch``, the number of a product's batch from 0 within each ``by`` group.

    The first product with which a batch has ``size`` rows or more closes it;
    products are never split, and the last batch may be smaller. Every product
    has a row at least: smaller counts are taken as one. ``products`` is read
    twice, so callers pass a stored or cheap table.
    """
    if size < 1:
        raise ValueError("a batch needs a size of one row at least")
    n = F.greatest(F.coalesce(F.col(n_rows), F.lit(1)), F.lit(1)).cast("bigint")
    sized = products.withColumn("_n", n)
    counted = sum_before(sized, order, "_n", "_before", by)
    group = F.xxhash64(*by) if by else F.lit(0).cast("bigint")
    counted = stored(counted.withColumn("_group", group), "counted")

    number = _number_in_blocks if size <= BLOCK // 4 else _number_by_links
    return number(counted, size, order, by, products.columns)


def _number_in_blocks(counted: DataFrame, size: int, order: str, by: Sequence[str], columns: list[str]) -> DataFrame:
    keys = ["_group", "_block"]
    placed = counted.withColumn("_block", F.floor(F.col("_before") / BLOCK))

    def in_blocks(df: DataFrame) -> DataFrame:
        return df.repartition(*keys).sortWithinPartitions(*keys, "_before")

    steps = in_blocks(placed.select(*keys, "_before", "_n")).mapInArrow(
        block_steps(size), "_group bigint, _block bigint, state bigint, to_state bigint, n_starts bigint"
    )
    steps = stored(steps, "steps")
    # One row a block.
    after = F.lead("_block").over(Window.partitionBy("_group").orderBy("_block"))
    following = steps.where("state = 0").select(*keys, after.alias("_after"))
    url = F.struct("_group", "_block", "state")
    next_url = F.struct("_group", F.col("_after").alias("_block"), F.col("to_state").alias("state"))
    links = steps.join(following, keys).select(url.alias("url"), F.when(F.col("_after").isNotNull(), next_url).alias("next_url"))
    seeds = steps.where("_block = 0").select(url.alias("seed"))
    walk = follow_links(stored(links, "block-links"), seeds).select("url.*", "position")
    before = Window.partitionBy("_group").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    entered = walk.join(steps, [*keys, "state"]).select(
        *keys, F.col("state").alias("_state"), F.coalesce(F.sum("n_starts").over(before), F.lit(0)).alias("_earlier")
    )
    known = placed.join(stored(entered, "entered"), keys)
    schema = counted.select(*columns).schema.add("batch", "long")
    return in_blocks(known).mapInArrow(number_blocks(size, columns), schema)


def _number_by_links(counted: DataFrame, size: int, order: str, by: Sequence[str], columns: list[str]) -> DataFrame:
    links = _next_starts(counted, size)
    ends = counted.select(F.struct(F.col("_group").alias("g"), F.col("_before").alias("start")).alias("url"))
    links = ends.join(links.select(F.col("start").alias("url"), F.col("next").alias("next_url")), "url", "left")
    links = stored(links, "next-starts")
    seeds = links.where("url.start = 0").select(F.col("url").alias("seed"))
    starts = follow_links(links, seeds).select(
        F.col("url.g").alias("_g"), F.col("url.start").alias("_start"), F.lit(1).alias("_starts")
    )
    marked = counted.join(
        starts, (F.col("_group") == F.col("_g")) & (F.col("_before") == F.col("_start")), "left"
    ).select(*columns, F.coalesce("_starts", F.lit(0)).alias("_starts"))
    numbered = sum_before(stored(marked, "starts"), order, "_starts", "_earlier", by)
    return numbered.withColumn("batch", F.col("_earlier") + F.col("_starts") - 1).select(*columns, "batch")


def batch_report(batched: DataFrame, handle: str = "handle", n_rows: str = "n_rows", by: Sequence[str] = ()) -> DataFrame:
    """Distinct handles and rows of each batch of ``form_batches``."""
    return batched.groupBy(*by, "batch").agg(
        F.countDistinct(handle).alias("n_products"), F.sum(n_rows).cast("bigint").alias("n_rows")
    )
