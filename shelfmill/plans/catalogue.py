"""The whole job: stored pages in, import rows, statistics and files out."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmill.functions.text import card_handle
from shelfmill.operators.dedup import accept_in_order, first_per_handle, not_exported
from shelfmill.operators.dom import (
    build_selectors,
    explode_records,
    parse_pages,
)
from shelfmill.operators.extract import (
    CARD_PAGE,
    card_name,
    finish_cards,
    page_cards,
    product_pages,
    walk_columns,
)
from shelfmill.operators.formatter import BatchFormatter, format_descriptions
from shelfmill.operators.merge import final_handles, merge_cards, one_per_url
from shelfmill.operators.navigation import (
    end_of_catalogue,
    loaded,
    next_link,
    page_status,
    page_stops,
    pattern_pages,
    single_page,
    single_pages,
    walk_next_links,
)
from shelfmill.operators.rows import import_rows, n_rows
from shelfmill.operators.running import limit_products
from shelfmill.operators.variants import merge_axes
from shelfmill.operators.stats import failed_urls, run_stats
from shelfmill.schemas import DEFAULT_LIMIT, DEFAULT_PAGE_END, DEFAULT_PAGE_START
from shelfmill.session import cut_lineage, stored
from shelfmill.sinks.commits import commit_run, committed_handles, run_folder
from shelfmill.sinks.files import (
    derive_review_path,
    write_failed_urls,
    write_import,
    write_review,
    write_summary,
)
from shelfmill.sources.tables import exported_handles

@dataclass(frozen=True)
class CatalogueJob:
    """Settings of one run.

    The walk is by ``url_pattern`` if given, else by ``next_selector`` from
    ``seed``, else the single page ``seed``; with none of them every page is a
    catalogue page, in order of catalogue, page number and page id.
    """

    limit: int | None = DEFAULT_LIMIT
    limit_unit: Literal["rows", "products"] = "rows"
    dedup: Literal["first", "sequential"] = "first"
    resume: bool = False
    use_product_pages: bool = True
    selectors: dict[str, str] = field(default_factory=dict)
    url_pattern: str | None = None
    page_start: int = DEFAULT_PAGE_START
    page_end: int = DEFAULT_PAGE_END
    next_selector: str | None = None
    seed: str | None = None
    strict_axes: bool = False
    first_wave: int = 64  # numbered pages parsed at first if there is a limit
    answers: str | None = None  # table of a formatter's answers that later runs use again


@dataclass(frozen=True)
class CatalogueResult:
    products: DataFrame
    rows: DataFrame
    stats: DataFrame
    failed: DataFrame
    rejects: DataFrame | None = None  # catalogue pages without cards because they failed


def _page_facts(pages: DataFrame, job: CatalogueJob, sels: dict[str, str]) -> DataFrame:
    """What the walk needs of each catalogue page, parsed once and stored.

    A page that failed to load or to parse contributes no cards.
    """
    parsed = parse_pages(pages)
    unread = F.col("els").isNull() & (page_status(parsed) == "ok")
    status = F.when(F.col("unread"), "error").otherwise(page_status(parsed))
    parsed = parsed.withColumn("unread", unread).withColumn("status", status)
    carried = [c for c in ("fetched_at",) if c in parsed.columns]
    link = next_link(job.next_selector) if job.next_selector else F.lit(None).cast("string")
    cards = F.when(F.col("status") == "ok", page_cards(sels))
    facts = cut_lineage(
        parsed.select(
            "page_id",
            F.col("url").alias("base"),
            "status",
            "unread",
            *walk_columns(parsed),
            *carried,
            link.alias("next_url"),
            cards.alias("cards"),
        )
    )
    # Counted from the stored cards, so that they are picked once.
    return facts.withColumn("n_cards", F.when(F.col("cards").isNotNull(), F.size("cards")).otherwise(0))


def _latest_facts(facts: DataFrame) -> DataFrame:
    """One row per URL: the last fetch that loaded, else the last; then the lowest page id."""
    fetched = F.col("fetched_at") if "fetched_at" in facts.columns else F.lit(None).cast("timestamp")
    rest = [c for c in facts.columns if c != "base"]
    latest = facts.groupBy("base").agg(
        F.max_by(
            F.struct(*rest), F.struct(F.col("status") == "ok", fetched, -F.col("page_id"))
        ).alias("_page")
    )
    return latest.select("base", "_page.*")


def _walked_facts(
    pages: DataFrame, job: CatalogueJob, sels: dict[str, str], seeds: DataFrame | None = None
) -> DataFrame:
    """Facts of the visited pages, numbered in walk order.

    With a table of seeds each seed is a catalogue; a page that several walks
    reach belongs to the nearest seed before it.
    """
    if job.url_pattern:
        numbered = pattern_pages(pages, job.url_pattern, job.page_start, job.page_end)
        return _latest_facts(_page_facts(numbered, job, sels))
    if job.next_selector:
        if seeds is None and not job.seed:
            raise ValueError("following next links needs a seed")
        facts = _latest_facts(_page_facts(pages, job, sels))
        links = facts.select(F.col("base").alias("url"), "next_url", "n_cards")
        of_job = pages.sparkSession.range(1).select(F.lit(job.seed).alias("seed"))
        walk = walk_next_links(links, of_job if seeds is None else seeds)
        catalogue = [] if seeds is None else [F.col("seed").alias("catalogue")]
        walk = walk.select(F.col("url").alias("base"), (F.col("position") + 1).alias("page_num"), *catalogue)
        return facts.drop(*walk.drop("base").columns).join(walk, "base")
    if seeds is not None:
        return _latest_facts(_page_facts(single_pages(pages, seeds), job, sels))
    if job.seed:
        return _latest_facts(_page_facts(single_page(pages, job.seed), job, sels))
    return _page_facts(pages, job, sels)


def accepted_cards(
    pages: DataFrame,
    job: CatalogueJob,
    exported: DataFrame | None,
    products: DataFrame | None,
    seeds: DataFrame | None = None,
) -> DataFrame:
    """New cards of the walk, with duplicates and exported handles removed."""
    return walk_cards(pages, job, exported, products, seeds)[0]


def _in_waves(job: CatalogueJob) -> bool:
    return bool(job.url_pattern) and job.limit is not None and job.page_end - job.page_start >= job.first_wave


class SharedWalk:
    """What several jobs over the same pages have in common, computed for the first of them.

    Jobs that differ in their limit or policy only read the same pages, so
    these are parsed once; with one policy they accept the same cards, and the
    limit cuts those behind the walk. Jobs in waves keep to themselves, since
    their limit tells how far they read.
    """

    def __init__(self):
        self._facts: list[tuple[CatalogueJob, DataFrame]] = []
        self._cards: list[tuple[CatalogueJob, tuple[DataFrame, DataFrame]]] = []

    @staticmethod
    def _once(known: list, job: CatalogueJob, make):
        for other, made in known:
            if other == job:
                return made
        known.append((job, make()))
        return known[-1][1]

    def facts(self, job: CatalogueJob, make) -> DataFrame:
        return self._once(self._facts, replace(job, limit=None, limit_unit="rows", dedup="first"), make)

    def cards(self, job: CatalogueJob, make) -> tuple[DataFrame, DataFrame]:
        return self._once(self._cards, replace(job, limit=None, limit_unit="rows"), make)


class LinkedProducts:
    """Product records of the pages that cards link to, read once."""

    def __init__(self, pages: DataFrame, job: CatalogueJob):
        self.pages, self.job, self.records = pages, job, None

    def of(self, cards: DataFrame) -> DataFrame:
        if self.records is None:
            found = product_pages(wanted_pages(self.pages, cards), build_selectors(self.job.selectors), self.job.strict_axes)
            self.records = cut_lineage(one_per_url(found))
        return self.records


def walk_cards(
    pages: DataFrame,
    job: CatalogueJob,
    exported: DataFrame | None,
    products: DataFrame | LinkedProducts | None,
    seeds: DataFrame | None = None,
    shared: SharedWalk | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Accepted cards, and the facts of the pages that were read for them.

    Numbered pages of a job with a limit are parsed in waves: after each one
    the walk ends if its cards fill the limit or one of its pages ends the
    catalogue. What a page adds depends on pages before it only, so the cards
    up to the limit are those of the whole walk. The next wave is as long as
    the cards so far suggest; the least length doubles, so waves stay few.
    """
    sels = build_selectors(job.selectors)
    if not _in_waves(job):
        shared = shared or SharedWalk()
        facts = shared.facts(job, lambda: _walked_facts(pages, job, sels, seeds))
        new, per_page = shared.cards(job, lambda: _new_cards(facts, job, exported, products))
        return (_before_end(new, per_page) if job.url_pattern else new), facts
    # One scan of the crawl; in order, so that a wave reads little beyond its own pages.
    own = pattern_pages(pages, job.url_pattern, job.page_start, job.page_end)
    own = stored(own.sortWithinPartitions("page_num"), "numbered")
    newest = own.agg(F.max("page_num").alias("n")).first().n
    page_end = job.page_start if newest is None else newest  # the crawl holds none behind it
    facts, start = None, job.page_start
    length = least = job.first_wave
    while True:
        end = min(page_end, start + length - 1)
        wave = _latest_facts(_page_facts(own.where(F.col("page_num").between(start, end)), job, sels))
        facts = wave if facts is None else facts.unionByName(wave)
        new, per_page = _new_cards(facts, job, exported, products)
        stops = F.count_if(page_stops(per_page)).alias("stops")
        seen = per_page.agg(stops, F.coalesce(F.sum("n_new"), F.lit(0)).alias("cards")).first()
        if end == page_end or seen.stops or seen.cards >= job.limit:
            return _before_end(new, per_page), facts
        missing = (job.limit - seen.cards) * (end - job.page_start + 1) // max(seen.cards, 1)
        start, least = end + 1, 2 * least
        length = max(least, missing + 1)


def _new_cards(
    facts: DataFrame, job: CatalogueJob, exported: DataFrame | None, products: DataFrame | LinkedProducts | None
) -> tuple[DataFrame, DataFrame]:
    """Accepted cards of the pages, stored, and how many each page brought."""
    found = finish_cards(explode_records(facts, "cards", *CARD_PAGE))
    found = found.withColumn("handle", card_handle("title", card_name()))
    if job.dedup == "first":
        new = first_per_handle(found)
        new = not_exported(new, exported) if exported is not None else new
    else:
        fresh = not_exported(found, exported) if exported is not None else found
        if isinstance(products, LinkedProducts):
            fresh = stored(fresh, "fresh")
            products = products.of(fresh)
        finals = stored(final_handles(fresh, products), "finals")
        new = accept_in_order(finals).drop("final_handle")
    new = cut_lineage(new)
    if not job.url_pattern:
        return new, facts
    counted = new.groupBy("page_num").agg(F.count("*").alias("n_new"))
    return new, facts.select("page_num", "n_cards", "status").join(counted, "page_num", "left")


def _before_end(new: DataFrame, per_page: DataFrame) -> DataFrame:
    """Cards of the pages that are still visited."""
    last = end_of_catalogue(per_page).agg(F.max("page_num").alias("last"))
    return new.where(F.col("page_num") <= last.scalar())


def rejected_pages(facts: DataFrame) -> DataFrame:
    """``page_id, url, reason`` of pages read in vain: unreadable, error or timeout."""
    reason = F.when(F.col("unread"), "unreadable").otherwise(F.col("status"))
    failed = facts.where(F.col("status") != "ok")
    return failed.select("page_id", F.col("base").alias("url"), reason.alias("reason"))


def wanted_pages(pages: DataFrame, cards: DataFrame) -> DataFrame:
    """Loaded product pages that the cards link to.

    The links are stored first, so Spark knows their size and picks the join:
    it sends them to the pages only if they are below its broadcast threshold.
    """
    wanted = stored(cards.where(F.col("url") != "").select("url").distinct(), "wanted")
    return loaded(pages).join(wanted, "url", "left_semi")


def build_catalogue(
    pages: DataFrame,
    job: CatalogueJob = CatalogueJob(),
    exported: DataFrame | None = None,
    product_table: DataFrame | None = None,
    formatter: BatchFormatter | None = None,
    seeds: DataFrame | None = None,
    shared: SharedWalk | None = None,
) -> CatalogueResult:
    """Run the job on a page table without writing files.

    ``product_table`` may hold product records extracted earlier; otherwise
    they come from ``pages``. ``seeds`` (column ``seed``) may name any number
    of catalogues in place of the job's one seed. Jobs over the same ``pages``,
    ``exported``, ``product_table`` and ``seeds`` may be given one ``shared``.
    """
    sels = build_selectors(job.selectors)
    products = product_table if job.use_product_pages else None
    if job.use_product_pages and job.dedup == "sequential" and products is None:
        # Waves find their cards one after another, so all pages are read for them.
        products = LinkedProducts(pages, job)
        if _in_waves(job):
            products = cut_lineage(one_per_url(product_pages(loaded(pages), sels, job.strict_axes)))
    new, facts = walk_cards(pages, job, exported, products, seeds, shared)
    if isinstance(products, LinkedProducts):
        products = products.records
    if job.limit is not None:
        # Each product has a row at least, so no card behind these can pass.
        new = cut_lineage(limit_products(new, job.limit, "products"))
    if job.use_product_pages and products is None:
        candidates = wanted_pages(pages, new)
        products = one_per_url(product_pages(candidates, sels, job.strict_axes))
    return replace(finish_catalogue(new, products, job, formatter), rejects=rejected_pages(facts))


def finish_catalogue(
    cards: DataFrame,
    products: DataFrame | None,
    job: CatalogueJob,
    formatter: BatchFormatter | None = None,
) -> CatalogueResult:
    """Accepted cards with their product records: limit, descriptions, rows."""
    merged = merge_cards(cards, products).withColumn("n_rows", n_rows())
    if job.limit is not None or formatter is not None:
        merged = cut_lineage(merged)  # read more than once below
    if job.limit is not None:
        merged = limit_products(merged, job.limit, job.limit_unit)
    final = cut_lineage(format_descriptions(merged, formatter, answers=job.answers))
    limit = job.limit if job.limit is not None else 0
    return CatalogueResult(
        products=final,
        rows=import_rows(final),
        stats=run_stats(final, limit),
        failed=failed_urls(final),
    )


def export_catalogue(
    pages: DataFrame,
    output: str,
    job: CatalogueJob = CatalogueJob(),
    formatter: BatchFormatter | None = None,
    failed_path: str | None = None,
    summary_path: str | None = None,
    profile: str = "full",
    files: int | None = None,
    seeds: DataFrame | None = None,
    as_unit: bool = False,
    rejects_path: str | None = None,
) -> CatalogueResult:
    """Run the job and write both CSV outputs.

    A fresh run replaces both; a resumed run skips exported handles and
    appends to both. With ``as_unit`` both become visible together or not at
    all, and are read by ``read_committed``.
    """
    started_at = datetime.now(timezone.utc)
    spark = pages.sparkSession
    exported = None
    if job.resume:
        # The append below changes the folder this table reads.
        exported = cut_lineage(committed_handles(spark, output) if as_unit else exported_handles(spark, output))
    result = build_catalogue(pages, job, exported, formatter=formatter, seeds=seeds)
    if profile.startswith("single_axis"):
        # The older files have one option axis: all values of a variant in one.
        merged = result.products.withColumn("variants", merge_axes(F.col("variants")))
        result = replace(result, rows=import_rows(merged))
    mode = "append" if job.resume else "overwrite"
    paths = [output, derive_review_path(output)]
    run = uuid.uuid4().hex
    import_path, review_path = [run_folder(p, run) for p in paths] if as_unit else paths
    write_import(result.rows, import_path, mode, profile, files)
    write_review(result.rows, review_path, mode, profile, files)
    if as_unit:
        commit_run(spark, output, run, fresh=not job.resume)
    if failed_path:
        write_failed_urls(result.failed, failed_path, mode)
    if rejects_path:
        result.rejects.write.mode(mode).json(rejects_path)
    if summary_path:
        write_summary(result.stats, summary_path, started_at)
    return result
