"""Walking a stored crawl: numbered pages, next links, single pages."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmill.functions.text import blank_to_null
from shelfmill.functions.urls import resolve_url
from shelfmill.operators.dom import all_matches, first_match
from shelfmill.operators.running import catalogue_cut
from shelfmill.schemas import DEFAULT_PAGE_END, DEFAULT_PAGE_START
from shelfmill.session import cut_lineage, stored


def expand_pattern(
    spark: SparkSession,
    template: str,
    start: int = DEFAULT_PAGE_START,
    end: int = DEFAULT_PAGE_END,
) -> DataFrame:
    """Numbered page URLs of a template with ``{}``; the end is included."""
    return spark.range(start, end + 1).select(
        F.col("id").alias("page_num"), pattern_url(F.lit(template), F.col("id")).alias("url")
    )


def pattern_url(template: Column | str, number: Column) -> Column:
    column = F.col(template) if isinstance(template, str) else template
    return F.replace(column, F.lit("{}"), number.cast("string"))


def expand_patterns(catalogues: DataFrame) -> DataFrame:
    """Page URLs of many catalogues (columns ``template``, ``start``, ``end``)."""
    return (
        catalogues.where(F.col("start") <= F.col("end"))
        .withColumn("page_num", F.explode(F.sequence("start", "end")))
        .withColumn("url", pattern_url("template", F.col("page_num")))
        .drop("start", "end")
    )


def pattern_pages(
    pages: DataFrame,
    template: str,
    start: int = DEFAULT_PAGE_START,
    end: int = DEFAULT_PAGE_END,
) -> DataFrame:
    """Stored pages of a numbered catalogue, with their ``page_num``.

    The number is read back from the URL, so the pages are not joined with the
    expected URLs and their HTML is never shuffled. A page the crawl does not
    hold is skipped, like a failed one.
    """
    head, *tail = template.split("{}")
    if not tail:
        raise ValueError("the template needs a {} for the page number")
    pattern = rf"\A{re.escape(head)}(\d+){'.*' if len(tail) > 1 else re.escape(tail[0])}\z"
    number = F.regexp_extract("url", pattern, 1).try_cast("bigint")
    return (
        pages.where(F.col("url").startswith(head))
        .withColumn("page_num", number)
        .where(F.col("page_num").between(start, end))
        .where(F.col("url") == pattern_url(F.lit(template), F.col("page_num")))
    )


def single_page(pages: DataFrame, seed: str) -> DataFrame:
    return pages.where(F.col("url") == seed).withColumn("page_num", F.lit(1).cast("bigint"))


def single_pages(pages: DataFrame, seeds: DataFrame) -> DataFrame:
    """The pages of a table of seeds, each a catalogue of its own."""
    wanted = seeds.select(F.col("seed").alias("url")).distinct()
    own = pages.join(wanted, "url", "left_semi").select(*pages.columns)
    return own.withColumn("catalogue", F.col("url")).withColumn("page_num", F.lit(1).cast("bigint"))


STATUSES = ("ok", "error", "timeout")


def page_status(pages: DataFrame) -> Column:
    """Status of a fetch in lower case; null means ok, another value raises.

    A crawl with other codes is mapped to these three before the job.
    """
    if "status" not in pages.columns:
        return F.lit("ok")
    status = F.lower(F.coalesce("status", F.lit("ok")))
    unknown = F.raise_error(F.concat(F.lit("unknown page status "), status)).cast("string")
    return F.when(status.isin(*STATUSES), status).otherwise(unknown)


def loaded(pages: DataFrame) -> DataFrame:
    """Pages that were fetched."""
    return pages.where(page_status(pages) == "ok") if "status" in pages.columns else pages


def page_stops(walked: DataFrame) -> Column:
    """Does this page end the catalogue?

    A failed page is only skipped. A page that timed out, has no cards or
    brought no new product ends the walk. Columns: ``status`` (optional),
    ``n_cards``, ``n_new``.
    """
    nothing = (F.coalesce("n_cards", F.lit(0)) == 0) | (F.coalesce("n_new", F.lit(0)) == 0)
    if "status" not in walked.columns:
        return nothing
    status = F.lower(F.coalesce("status", F.lit("ok")))
    return F.when(status == "error", F.lit(False)).otherwise((status == "timeout") | nothing)


def end_of_catalogue(walked: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Pages that are still visited when the walk ends at the first stop."""
    return catalogue_cut(walked.withColumn("_stop", page_stops(walked)), "_stop", by).drop("_stop")


def is_disabled(attrs: Column) -> Column:
    """Is a next link marked as disabled?"""
    aria = F.coalesce(attrs["aria-disabled"] == "true", F.lit(False))
    return aria | F.coalesce(F.contains(attrs["class"], F.lit("disabled")), F.lit(False))


def next_link(next_selector: str, base: Column | str = "url") -> Column:
    """URL behind the first next link of a parsed page; null if there is none
    or it is disabled."""
    attrs = first_match(next_selector).attrs
    return F.when(~is_disabled(attrs), blank_to_null(resolve_url(attrs["href"], base)))


def next_links(parsed: DataFrame, next_selector: str, card_selector: str) -> DataFrame:
    """Narrow link table of parsed pages: url, next_url, n_cards."""
    return parsed.select(
        "url",
        next_link(next_selector).alias("next_url"),
        F.size(all_matches(card_selector)).alias("n_cards"),
    )


def follow_links(links: DataFrame, seeds: DataFrame, max_doublings: int = 40) -> DataFrame:
    """Walk order of the pages reached from each seed.

    Input: ``links(url, next_url)`` with one row per URL and ``seeds(seed)``.
    Output: seed, url, position (0 for the seed). A page already visited ends
    the walk, so cycles are safe.

    Pointer doubling: after round k the walk is known up to 2^k steps and
    ``jump`` leads 2^k steps ahead, so a chain of n pages takes log2(n) rounds
    instead of n. Rows per seed never exceed the chain itself.
    """
    known = links.select("url").distinct()
    inner = links.join(known.select(F.col("url").alias("next_url")), "next_url", "left_semi")
    jump = cut_lineage(inner.select("url", "next_url"))
    walk = cut_lineage(
        seeds.select(F.col("seed"), F.col("seed").alias("url"))
        .distinct()
        .join(known, "url", "left_semi")
        .select("seed", "url", F.lit(0).cast("bigint").alias("position"))
    )
    size = walk.count()
    for k in range(max_doublings):
        ahead = walk.join(jump, "url").select(
            "seed", F.col("next_url").alias("url"), (F.col("position") + (1 << k)).alias("position")
        )
        walk = cut_lineage(
            walk.unionByName(ahead).groupBy("seed", "url").agg(F.min("position").alias("position"))
        )
        grown = walk.count()
        if grown == size:
            return walk
        size = grown
        hop = jump.select(F.col("url").alias("next_url"), F.col("next_url").alias("far"))
        jump = cut_lineage(
            jump.join(hop, "next_url").select("url", F.col("far").alias("next_url"))
        )
    raise RuntimeError(f"walk not finished after {max_doublings} doublings")


def nearest_seeds(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """Every page that a seed leads to, once, with the nearest seed before it.

    Input: ``links(url, next_url)`` with one row per URL and ``seeds(seed)``.
    Output: seed, url, position (0 for the seed). Of two seeds as near the
    smaller counts. Walks that meet, seeds inside other walks and cycles add no
    rows: the result has a row for each URL at most.

    Pointer doubling with jumps of 2^k steps in round k, after which all pages
    less than 2^(k+1) steps behind a seed are settled. A jump to a settled page
    can bring it nothing nearer and leads on to nothing that page does not lead
    to, so only jumps to pages still open are kept.
    """
    known = links.select("url").distinct()
    settled = seeds.select(F.col("seed").alias("url"), "seed").distinct()
    settled = settled.join(known, "url", "left_semi").withColumn("position", F.lit(0).cast("bigint"))
    settled = new = stored(settled, "settled")
    inner = links.select("url", "next_url").join(known.withColumnRenamed("url", "next_url"), "next_url", "left_semi")
    jump, step = stored(_open_jumps(inner, new), "jumps"), 1
    while True:
        reached = F.struct((F.col("position") + step).alias("position"), "seed")
        new = jump.join(settled, "url").groupBy(F.col("next_url").alias("url")).agg(F.min(reached).alias("_to"))
        new = stored(new.select("url", "_to.seed", "_to.position"), "settled")
        if not new.take(1):
            return settled.select("seed", "url", "position")
        settled = settled.unionByName(new)
        hop = jump.select(F.col("url").alias("next_url"), F.col("next_url").alias("far"))
        longer = jump.join(hop, "next_url").select("url", F.col("far").alias("next_url"))
        jump, step = stored(_open_jumps(longer, new), "jumps"), 2 * step


def _open_jumps(jumps: DataFrame, settled: DataFrame) -> DataFrame:
    return jumps.join(settled.select(F.col("url").alias("next_url")), "next_url", "left_anti").select("url", "next_url")


def walk_next_links(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """Walk that also ends before the first page without cards.

    A link into or out of a page without cards is not followed. Of several
    seeds each page belongs to the nearest one before it.
    """
    with_cards = links.where(F.col("n_cards") > 0)
    return nearest_seeds(with_cards.select("url", "next_url"), seeds)
