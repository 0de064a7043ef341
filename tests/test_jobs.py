"""Whole runs: golden shape, resume, walks, files, streams, registered queries."""

import csv
import glob
import math
import os
from dataclasses import replace

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from shelfmill.operators import dom, running
from shelfmill.plans import catalogue
from shelfmill.plans.catalogue import CatalogueJob, build_catalogue, export_catalogue
from shelfmill.plans.oracle import ORACLE_SQL
from shelfmill.plans.queries import QUERIES
from shelfmill.schemas import IMPORT_COLUMNS, REVIEW_COLUMNS
from shelfmill.sinks import commits
from shelfmill.sinks.files import derive_review_path, write_failed_urls
from shelfmill.sources.tables import exported_handles, page_schema, read_export, read_pages, read_seeds, stream_pages
from shelfmill.streaming.export import distinct_handles, start_export, use_disk_state

SHOP = "https://shop.example"
IMAGES = {"Ant": 7, "Bee": 6, "Cat": 7, "Dog": 3}


def list_page(names):
    return "<ul>" + "".join(
        f'<li class="product-item"><a href="/p/{n}/"><img src="/t/{n}.png"><h1>{n}</h1></a>'
        f'<span class="price">${60 + i}.00</span></li>'
        for i, n in enumerate(names)
    ) + "</ul>"


def product_page(name, title="Description"):
    images = "".join(f'<img src="/i/{name}-{k}.png">' for k in range(IMAGES.get(name, 1)))
    return (
        f'<h1>{title}</h1><span class="price">$6{len(name)}.00</span>'
        f'<div class="product-gallery">{images}</div>'
    )


def crawl(spark, pages):
    columns = ["page_id", "url", "html"]
    return spark.createDataFrame(
        [(i, u, h) for i, (u, h) in enumerate(pages)], page_schema(columns)
    )


@pytest.fixture(scope="module")
def golden(spark):
    """Three products of 7, 6 and 7 images, a limit of 20 rows, a fourth behind it."""
    pages = [(f"{SHOP}/page/1/", list_page(IMAGES))]
    pages += [(f"{SHOP}/p/{n}/", product_page(n)) for n in IMAGES]
    return crawl(spark, pages)


JOB = CatalogueJob(limit=20, url_pattern=SHOP + "/page/{}/", page_start=1, page_end=2)


def read_csv(folder):
    out = []
    for path in sorted(glob.glob(f"{folder}/**/*.csv", recursive=True)):
        raw = open(path, "rb").read()
        assert raw.startswith(b"\xef\xbb\xbf")
        with open(path, encoding="utf-8-sig", newline="") as f:
            out += list(csv.DictReader(f))
    return out


def test_golden_run(spark, golden, tmp_path):
    out = str(tmp_path / "upload.csv")
    result = export_catalogue(golden, out, JOB, files=1, summary_path=str(tmp_path / "summary"))
    stats = result.stats.collect()[0].asDict()
    assert stats == {
        "total_products": 3, "total_rows": 20, "ai_success": 0, "ai_fallback": 3,
        "page_failures": 0, "ai_rate": 0, "progress_pct": 15,
    }
    numbered = running.row_numbers(result.products).orderBy("seq").collect()
    assert [r.row_number for r in numbered] == [1, 8, 14]
    rows = read_csv(out)
    assert list(rows[0]) == IMPORT_COLUMNS[:-1] and len(rows) == 20
    assert {r["Handle"] for r in rows} == {"description"}
    assert [i for i, r in enumerate(rows) if r["Title"]] == [0, 7, 13]
    first = rows[0]
    assert first["Body (HTML)"] == "<p>No description available.</p>"
    assert (first["Option1 Name"], first["Option1 Value"]) == ("Title", "Default Title")
    assert first["Variant Price"] == "63.00" and first["Image Src"] == f"{SHOP}/i/Ant-0.png"
    assert set(v for k, v in rows[1].items() if k not in ("Handle", "Image Src")) == {""}
    review = read_csv(derive_review_path(out))
    assert list(review[0]) == REVIEW_COLUMNS and len(review) == 20
    assert review[0]["Original Source Link"] == f'=HYPERLINK("{SHOP}/p/Ant/","View Original")'
    assert review[1]["Original Source Link"] == ""
    assert review[1]["Image URL (Click to Preview)"] == f'=HYPERLINK("{SHOP}/i/Ant-1.png","View Image")'
    assert spark.read.json(str(tmp_path / "summary")).count() == 1


def test_result_does_not_depend_on_partitioning(golden):
    job = CatalogueJob(limit=None, url_pattern=JOB.url_pattern)
    whole = build_catalogue(golden, job).rows.orderBy("seq", "pos").collect()
    shuffled = build_catalogue(golden.repartition(9, F.rand(3)), job).rows.orderBy("seq", "pos").collect()
    assert whole == shuffled and len(whole) == sum(IMAGES.values())


def unique_titles(spark, names, first=1):
    pages = [(f"{SHOP}/page/{first + i}/", list_page([n])) for i, n in enumerate(names)]
    return crawl(spark, pages + [(f"{SHOP}/p/{n}/", product_page(n, n)) for n in names])


def test_resume_equals_one_run(spark, tmp_path):
    names = ["Ant", "Bee", "Cat", "Dog", "Elk"]
    both = unique_titles(spark, names)
    once = str(tmp_path / "once.csv")
    job = CatalogueJob(limit=None)
    export_catalogue(both, once, job)
    split = str(tmp_path / "split.csv")
    export_catalogue(unique_titles(spark, names[:2]), split, job)
    export_catalogue(both, split, CatalogueJob(limit=None, resume=True))
    key = lambda r: tuple(r.values())
    assert sorted(map(key, read_csv(split))) == sorted(map(key, read_csv(once)))
    fresh = export_catalogue(unique_titles(spark, names[:1]), split, job)
    assert len(read_csv(split)) == fresh.rows.count() == len(read_csv(derive_review_path(split)))


def test_a_run_that_dies_between_its_files_is_not_seen(spark, tmp_path, monkeypatch):
    names = ["Ant", "Bee", "Cat"]
    both, out = unique_titles(spark, names), str(tmp_path / "upload.csv")
    job = CatalogueJob(limit=None)
    resumed = CatalogueJob(limit=None, resume=True)

    def rows(path):
        return sorted(tuple(r) for r in commits.read_committed(spark, out, path).na.fill("").collect())

    def die(*args, **kwargs):
        raise RuntimeError("lost")

    assert commits.read_committed(spark, out) is None and commits.committed_handles(spark, out).count() == 0
    with monkeypatch.context() as broken, pytest.raises(RuntimeError, match="lost"):
        broken.setattr(catalogue, "write_review", die)
        export_catalogue(both, out, job, as_unit=True)
    assert commits.read_committed(spark, out) is None
    export_catalogue(unique_titles(spark, names[:1]), out, resumed, as_unit=True)
    with monkeypatch.context() as broken, pytest.raises(RuntimeError, match="lost"):
        broken.setattr(catalogue, "write_review", die)
        export_catalogue(both, out, resumed, as_unit=True)
    assert len({r[0] for r in rows(out)}) == 1
    export_catalogue(both, out, resumed, as_unit=True)
    export_catalogue(both, out, resumed, as_unit=True)  # nothing new
    once = str(tmp_path / "once.csv")
    export_catalogue(both, once, job)
    assert rows(out) == sorted(tuple(r) for r in read_export(spark, once).na.fill("").collect())
    review = derive_review_path(out)
    assert rows(review) == sorted(tuple(r) for r in read_export(spark, derive_review_path(once)).na.fill("").collect())
    assert len(commits.committed_runs(spark, out)) == 3
    export_catalogue(unique_titles(spark, names[:1]), out, job, as_unit=True)  # a fresh run replaces all
    assert len(commits.committed_runs(spark, out)) == 1 and {r[0] for r in rows(out)} == {"ant"}


def test_several_seeds(spark):
    def page(n, names, link=""):
        return (f"{SHOP}/l/{n}", list_page(names) + link)

    pages = crawl(spark, [
        page("a1", ["Ant"], '<a class="next" href="a2">n</a>'),
        page("a2", ["Bee"], '<a class="next" href="a3">n</a>'),
        page("a3", ["Cat", "Ant"]),
        page("b1", ["Dog", "Cat"], '<a class="next" href="a3">n</a>'),
        page("c1", ["Elk"]),
    ])
    seeds = spark.createDataFrame([(f"{SHOP}/l/a1",), (f"{SHOP}/l/b1",), (f"{SHOP}/l/none",)], "seed string")
    job = CatalogueJob(limit=None, next_selector="a.next", use_product_pages=False)
    got = build_catalogue(pages, job, seeds=seeds).products.orderBy("seq").collect()
    # Page a3 is nearer to b1, so it is the second page of that catalogue.
    assert [(r.title, r.seq.catalogue[-2:], r.page_num) for r in got] == [("Ant", "a1", 1), ("Bee", "a1", 2), ("Dog", "b1", 1), ("Cat", "b1", 1)]
    single = build_catalogue(pages, CatalogueJob(limit=None, use_product_pages=False), seeds=seeds).products.orderBy("seq")
    assert [r.title for r in single.collect()] == ["Ant", "Dog", "Cat"]


def test_next_link_walk(spark):
    def page(n, names, link):
        return (f"{SHOP}/l/{n}", list_page(names) + link)

    pages = crawl(spark, [
        page(3, ["Cat"], '<a class="next is-disabled" href="/l/1">n</a>'),
        page(1, ["Ant"], '<a class="next" href="2">n</a>'),
        page(2, ["Bee", "Ant"], '<a class="next" href="/l/3">n</a>'),
        page(9, ["Elk"], ""),
    ])
    job = CatalogueJob(limit=None, next_selector="a.next", seed=f"{SHOP}/l/1", use_product_pages=False)
    got = build_catalogue(pages, job).products.orderBy("seq").collect()
    assert [(r.title, r.page_num) for r in got] == [("Ant", 1), ("Bee", 2), ("Cat", 3)]


def test_single_page_and_failed_product_pages(spark, golden, tmp_path):
    pages = golden.where(~F.col("url").contains("/p/Bee/"))
    job = CatalogueJob(limit=None, seed=f"{SHOP}/page/1/")
    result = build_catalogue(pages, job)
    assert [r.url for r in result.failed.collect()] == [f"{SHOP}/p/Bee/"]
    bee = [r for r in result.products.collect() if r.failed_url]
    assert [(r.title, r.price, r.main_image) for r in bee] == [("Bee", "61.00", f"{SHOP}/t/Bee.png")]
    assert write_failed_urls(result.failed, str(tmp_path / "failed"))
    assert not write_failed_urls(result.failed.limit(0), str(tmp_path / "none"))
    assert not os.path.exists(tmp_path / "none")


def test_catalogue_ends_at_a_page_without_new_products(spark):
    pages = crawl(spark, [
        (f"{SHOP}/page/1/", list_page(["Ant", "Bee"])),
        (f"{SHOP}/page/2/", list_page(["Bee"])),
        (f"{SHOP}/page/3/", list_page(["Cat"])),
    ])
    job = CatalogueJob(limit=None, url_pattern=JOB.url_pattern, page_end=9, use_product_pages=False)
    assert sorted(r.title for r in build_catalogue(pages, job).products.collect()) == ["Ant", "Bee"]


def test_pages_that_failed_to_load(spark):
    """An error page is skipped, a timed-out page ends the catalogue."""
    rows = [
        (0, f"{SHOP}/page/1/", list_page(["Ant"]), "ok"),
        (1, f"{SHOP}/page/2/", list_page(["Bad"]), "error"),
        (2, f"{SHOP}/page/3/", None, None),
        (3, f"{SHOP}/page/4/", list_page(["Bee"]), None),
        (4, f"{SHOP}/page/5/", list_page(["Cat"]), "timeout"),
        (5, f"{SHOP}/page/6/", list_page(["Dog"]), "ok"),
        (6, f"{SHOP}/p/Ant/", product_page("Ant"), "error"),
    ]
    pages = spark.createDataFrame(rows, page_schema(["page_id", "url", "html", "status"]))
    job = CatalogueJob(limit=None, url_pattern=JOB.url_pattern)
    result = build_catalogue(pages, job)
    assert sorted(r.title for r in result.products.collect()) == ["Ant", "Bee"]
    assert sorted(r.url for r in result.failed.collect()) == [f"{SHOP}/p/Ant/", f"{SHOP}/p/Bee/"]


def test_pages_fetched_twice_count_once(spark):
    rows = [
        (0, f"{SHOP}/page/1/", list_page(["Old"]), "2026-01-01 00:00:00"),
        (1, f"{SHOP}/page/1/", list_page(["New"]), "2026-02-01 00:00:00"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, at string")
    pages = pages.withColumn("fetched_at", F.col("at").cast("timestamp")).drop("at")
    job = CatalogueJob(limit=None, url_pattern=JOB.url_pattern, use_product_pages=False)
    assert [r.title for r in build_catalogue(pages, job).products.collect()] == ["New"]


def test_wanted_pages_are_the_linked_ones_whatever_the_join(spark, golden):
    from shelfmill.plans.catalogue import wanted_pages

    cards = spark.createDataFrame([(f"{SHOP}/p/{n}/",) for n in IMAGES], "url string")
    few = wanted_pages(golden, cards)
    assert few.count() == len(IMAGES) and "BroadcastHashJoin" in few._jdf.queryExecution().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert wanted_pages(golden, cards).count() == len(IMAGES)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_status_rules(spark):
    rows = [
        (0, f"{SHOP}/page/1/", list_page(["Ant", "Bee"]), "OK", "2026-01-01 00:00:00"),
        (1, f"{SHOP}/page/1/", "<h1>503</h1>", "error", "2026-02-01 00:00:00"),
        (2, f"{SHOP}/p/Ant/", "<h1>503 Service Unavailable</h1>", "error", None),
        (3, f"{SHOP}/p/Bee/", product_page("Bee"), None, None),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, status string, at string")
    pages = pages.withColumn("fetched_at", F.col("at").cast("timestamp")).drop("at")
    for dedup in ("first", "sequential"):
        result = build_catalogue(pages, CatalogueJob(limit=None, url_pattern=JOB.url_pattern, dedup=dedup))
        assert sorted(r.title for r in result.products.collect()) == ["Ant", "Description"]
        assert [r.url for r in result.failed.collect()] == [f"{SHOP}/p/Ant/"]
    odd = pages.withColumn("status", F.lit("200"))
    with pytest.raises(Exception, match="unknown page status 200"):
        build_catalogue(odd, CatalogueJob(limit=None, url_pattern=JOB.url_pattern)).rows.count()


def test_product_pages_behind_the_limit_are_not_parsed(spark, golden, monkeypatch):
    from shelfmill.plans import catalogue

    seen = []
    plain = catalogue.wanted_pages

    def watched(pages, cards):
        seen.append(cards.count())
        return plain(pages, cards)

    monkeypatch.setattr(catalogue, "wanted_pages", watched)
    assert build_catalogue(golden, CatalogueJob(limit=1, url_pattern=JOB.url_pattern)).products.count() == 1
    assert seen == [1]


def test_formatter_in_a_job(spark, golden):
    job = CatalogueJob(limit=None, url_pattern=JOB.url_pattern, selectors={"desc": "h1"})
    result = build_catalogue(golden, job, formatter=lambda batch: ["<p>new</p>" for _ in batch])
    assert {r.body_html for r in result.products.collect()} == {"<p>new</p>"}
    stats = result.stats.collect()[0]
    assert (stats.ai_success, stats.ai_fallback, stats.ai_rate) == (4, 0, 100)


def numbered_lists(spark, statuses):
    """List page n holds the products n and n + 1, so each brings one that the page before lacks."""
    rows = [
        (n, f"{SHOP}/page/{n}/", list_page([f"P{n}", f"P{n + 1}"]), status)
        for n, status in enumerate(statuses, 1)
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, status string")


@pytest.mark.parametrize("dedup, limit", [("first", 1), ("first", 30), ("sequential", 9)])
def test_walk_in_waves(spark, dedup, limit):
    """The waves give the products of the whole walk; pages behind the last wave are never looked at."""
    job = CatalogueJob(limit=limit, limit_unit="products", dedup=dedup, url_pattern=JOB.url_pattern, page_end=100, use_product_pages=False)
    whole = replace(job, first_wave=1000)
    pages = numbered_lists(spark, ["ok"] * 100)
    expected = sorted(r.handle for r in build_catalogue(pages, whole).products.collect())
    assert len(expected) == limit
    # An unknown status raises as soon as a page is read.
    unread = numbered_lists(spark, ["ok"] * (limit + 25) + ["never read"] * (75 - limit))
    assert sorted(r.handle for r in build_catalogue(unread, replace(job, first_wave=5)).products.collect()) == expected
    with pytest.raises(Exception, match="never read"):
        build_catalogue(unread, whole).products.collect()


def test_waves_end_with_the_catalogue(spark):
    """A late page inside a wave ends the walk; failed pages are skipped, also at the end of a wave."""
    statuses = ["ok", "ok", "error", "error", "ok", "timeout"] + ["ok"] * 3 + ["never read"] * 91
    job = CatalogueJob(limit=8, url_pattern=JOB.url_pattern, page_end=100, use_product_pages=False, first_wave=3)
    result = build_catalogue(numbered_lists(spark, statuses), job)
    assert sorted(r.title for r in result.products.collect()) == ["P1", "P2", "P3", "P5", "P6"]
    assert {r.page_id: r.reason for r in result.rejects.collect()} == {3: "error", 4: "error", 6: "timeout"}
    empty = build_catalogue(numbered_lists(spark, []), job)
    assert empty.products.count() == empty.rejects.count() == 0


def test_rejects_of_a_run(spark, tmp_path):
    rows = [(1, "a", list_page(["A"]), None), (2, "b", None, "ok"), (3, "c", None, "ERROR"), (4, "d", "<p>no card", "timeout")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, status string")
    path = str(tmp_path / "rejects")
    job = CatalogueJob(limit=None, use_product_pages=False)
    export_catalogue(pages, str(tmp_path / "out.csv"), job, rejects_path=path)
    got = {r.page_id: (r.url, r.reason) for r in spark.read.json(path).collect()}
    assert got == {2: ("b", "unreadable"), 3: ("c", "error"), 4: ("d", "timeout")}


def test_sequential_policy(spark):
    """A final handle recorded earlier skips a later card with that handle."""
    names = ["Ant", "Description", "Bee"]
    pages = crawl(spark, [(f"{SHOP}/page/1/", list_page(names))] + [
        (f"{SHOP}/p/{n}/", product_page(n)) for n in names
    ])
    job = CatalogueJob(limit=None, dedup="sequential", url_pattern=JOB.url_pattern)
    got = build_catalogue(pages, job).products.orderBy("seq").collect()
    assert [r.source_url for r in got] == [f"{SHOP}/p/Ant/", f"{SHOP}/p/Bee/"]


def test_export_handles_of_odd_files(spark, tmp_path):
    assert exported_handles(spark, str(tmp_path / "missing.csv")).count() == 0
    numbers = tmp_path / "numbers.csv"
    numbers.write_text('﻿Handle,Title\n007,"a\nb"\nnull,x\n,y\n007,z\n', encoding="utf-8")
    assert {r.handle for r in exported_handles(spark, str(numbers)).collect()} == {"007", "null"}
    other = tmp_path / "other.csv"
    other.write_text("Name\nx\n")
    assert exported_handles(spark, str(other)).count() == 0


def test_seed_lists(spark, tmp_path):
    path = tmp_path / "seeds.txt"
    path.write_text("  https://a.example/x \n\nftp://b\nhttp://c\n")
    good, bad = read_seeds(spark, str(path))
    assert sorted(r.seed for r in good.collect()) == ["http://c", "https://a.example/x"]
    assert [r.seed for r in bad.collect()] == ["ftp://b"]


def test_page_table_needs_its_columns(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError):
        read_pages(spark, str(tmp_path / "t"))


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    names = ["Ant", "Bee", "Cat", "Dog"]
    source = str(tmp_path / "pages")
    job = CatalogueJob(limit=None, use_product_pages=False)
    out, ledger, state = (str(tmp_path / n) for n in ("out.csv", "ledger", "state"))

    def arrive(part):
        crawl(spark, [(f"{SHOP}/page/{n}/", list_page([n])) for n in part]).coalesce(1).write.mode(
            "append"
        ).parquet(source)

    def run():
        start_export(stream_pages(spark, source), out, ledger, state, job).awaitTermination()

    arrive(names[:2])
    run()
    arrive(names[1:])
    run()
    run()
    expected = {n.lower() for n in names}
    handles = [r["Handle"] for r in read_csv(out)]
    assert sorted(handles) == sorted(expected)
    assert len(read_csv(derive_review_path(out))) == len(names)
    assert {r.handle for r in spark.read.parquet(ledger).collect()} == expected


@pytest.mark.parametrize("dedup,exports", [("first", 2), ("sequential", 3)])
def test_stream_records_by_the_rule_of_the_job(spark, golden, tmp_path, dedup, exports):
    """All product pages share one title; Ant is listed again in batch two."""
    source = str(tmp_path / "pages")
    ledger, state = str(tmp_path / "ledger"), str(tmp_path / "state")
    job = CatalogueJob(limit=None, dedup=dedup, seed=f"{SHOP}/page/1/")
    for names in (["Ant"], ["Ant", "Bee"]):
        pages = [(f"{SHOP}/page/1/", list_page(names))]
        pages += [(f"{SHOP}/p/{n}/", product_page(n)) for n in names]
        crawl(spark, pages).coalesce(1).write.mode("append").parquet(source)
        start_export(
            stream_pages(spark, source), str(tmp_path / "out.csv"), ledger, state, job
        ).awaitTermination()
    written = [r for r in read_csv(str(tmp_path / "out.csv")) if r["Title"]]
    assert len(written) == exports


def test_stream_state_keeps_each_handle_once(spark, tmp_path):
    use_disk_state(spark)
    source = str(tmp_path / "pages")
    spark.read.parquet("/root/testdata/sf0.001/pages.parquet").repartition(3).write.parquet(source)
    titles = dom.parse_pages(stream_pages(spark, source)).select(
        dom.element_text(dom.first_match("h1")).alias("handle")
    )
    query = (
        distinct_handles(titles).writeStream.format("parquet")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = [r.handle for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    batch = dom.parse_pages(read_pages(spark, source)).select(
        dom.element_text(dom.first_match("h1")).alias("handle")
    )
    assert sorted(got) == sorted(r.handle for r in batch.distinct().collect())


# -- registered queries against their SQL ------------------------------------------------
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [
        tuple(None if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in rows
    ]
    return [columns[i] for i in order], sorted(plain, key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLE_SQL) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, tables, name):
    df = QUERIES[name](spark, SMALL)
    twin = tables.sql(ORACLE_SQL[name])
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(
        twin.columns, twin.fetchall()
    )


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_single_axis_files_hold_all_values_and_the_summary_times(spark, tmp_path):
    form = '[{"attributes":{"attribute_size":"Small","attribute_color":"Red"},"display_price":5}]'
    html = f"<h1>Ant</h1><form class='variations_form' data-product_variations='{form}'></form>"
    pages = crawl(spark, [(f"{SHOP}/page/1/", list_page(["Ant"])), (f"{SHOP}/p/Ant/", html)])
    out, summary = str(tmp_path / "old.csv"), str(tmp_path / "runs")
    job = CatalogueJob(limit=None, url_pattern=JOB.url_pattern)
    export_catalogue(pages, out, job, profile="single_axis", summary_path=summary)
    rows = read_csv(out)
    assert "Small / Red" in rows[0].values() and "Option2 Value" not in rows[0]
    run = spark.read.json(summary).first()
    assert run.started_at and run.finished_at and run.run_seconds >= 0


@pytest.mark.parametrize("policy", ["first", "sequential"])
def test_equal_page_numbers_and_any_page_ids(spark, policy):
    """Two list pages with one number, negative and large ids, with and without products pages and limits."""
    def page(i, names, number, catalogue=None):
        return (i, f"{SHOP}/c{i}/list", list_page(names), number, catalogue)

    pages = spark.createDataFrame(
        [page(10, ["Ant", "Bee"], 1), page(11, ["Cat", "Dog"], 1), page(-5, ["Elk", "Fox"], None), page(2**62, ["Gnu", "Ant"], 1, "late")],
        "page_id bigint, url string, html string, page_num bigint, catalogue string",
    )
    for use in (True, False):
        job = CatalogueJob(limit=None, dedup=policy, use_product_pages=use)
        got = build_catalogue(pages, job).products.orderBy("seq").collect()
        assert [r.title for r in got] == ["Elk", "Fox", "Ant", "Bee", "Cat", "Dog", "Gnu"]
    for limit in (1, 3):
        job = CatalogueJob(limit=limit, dedup=policy)
        got = build_catalogue(pages, job).products.orderBy("seq").collect()
        assert [r.title for r in got] == ["Elk", "Fox", "Ant"][:limit]


@pytest.mark.parametrize("name", ["stream_export", "stream_catalogue", "distinct_handles"])
def test_streams_read_page_tables_that_are_folders(spark, tmp_path, name):
    """Large tables are folders of part files; a table in one file gives the same rows."""
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    pages.repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    of_file, of_folder = (QUERIES[name](spark, folder).collect() for folder in (SMALL, str(tmp_path)))
    assert of_folder and sorted(map(tuple, of_folder)) == sorted(map(tuple, of_file))


def test_an_empty_handle_counts_as_exported(spark, tmp_path):
    """Titles without any letter or digit of a handle share the empty one."""
    pages = crawl(spark, [(f"{SHOP}/page/1/", list_page(["日本", "Ant"])), (f"{SHOP}/page/2/", list_page(["中国", "Bee"]))])
    out = str(tmp_path / "out.csv")
    job = CatalogueJob(limit=None, url_pattern=JOB.url_pattern, use_product_pages=False)
    export_catalogue(pages, out, replace(job, page_end=1))
    assert {r.handle for r in exported_handles(spark, out).collect()} == {"", "ant"}
    export_catalogue(pages, out, replace(job, page_start=2, page_end=2, resume=True))
    rows = read_export(spark, out).select("Handle", "Title", "Variant SKU").collect()
    assert sorted(map(tuple, rows)) == [("", "日本", None), ("ant", "Ant", None), ("bee", "Bee", None)]


def test_sequential_rule_reads_only_linked_pages(spark, monkeypatch):
    """Every loaded page, lists too, was read as a product page."""
    from shelfmill.plans import catalogue

    card = '<li data-product-id="1"><a href="/p/{0}"><h1>C{0}</h1></a></li>'
    rows = [(1, "https://s.example/list", "".join(card.format(k) for k in (1, 2, 3)))]
    rows += [(10 + k, f"https://s.example/p/{k}", f'<h1 class="product-title">T{k % 2}</h1>') for k in range(1, 6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    seen, read = [], catalogue.product_pages
    monkeypatch.setattr(catalogue, "product_pages", lambda p, *rest: seen.append(sorted(r.url for r in p.collect())) or read(p, *rest))
    job = CatalogueJob(limit=None, dedup="sequential", seed="https://s.example/list")
    rows = build_catalogue(pages, job).products.orderBy("seq").collect()
    assert seen == [[f"https://s.example/p/{k}" for k in (1, 2, 3)]]
    assert [(r.card_handle, r.handle) for r in rows] == [("c1", "t1"), ("c2", "t0"), ("c3", "t1")]


def test_jobs_that_differ_in_limit_or_policy_parse_the_pages_once(spark, golden, monkeypatch):
    parsed, parse = [], catalogue.parse_pages

    def counted(pages):
        parsed.append(pages)
        return parse(pages)

    monkeypatch.setattr(catalogue, "parse_pages", counted)
    shared = catalogue.SharedWalk()
    for dedup in ("first", "sequential"):
        for limit, unit in ((None, "rows"), (8, "rows"), (2, "products")):
            job = CatalogueJob(limit=limit, limit_unit=unit, dedup=dedup)
            ours = build_catalogue(golden, job, shared=shared).rows.collect()
            before = len(parsed)
            alone = build_catalogue(golden, job).rows.collect()
            assert len(parsed) == before + 1
            parsed.pop()
            assert sorted(map(str, ours)) == sorted(map(str, alone)) and ours
    assert len(parsed) == 1


def test_policies_over_several_catalogues_parse_the_pages_once(spark, monkeypatch):
    parsed, parse = [], catalogue.parse_pages
    monkeypatch.setattr(catalogue, "parse_pages", lambda pages: parsed.append(pages) or parse(pages))
    assert QUERIES["multi_catalogue_rows"](spark, entry_point.FLAGSHIP_DIR).count() > 0
    assert len(parsed) == 1
