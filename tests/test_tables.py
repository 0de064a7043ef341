"""Joins, de-duplication, running totals, walks, statistics: against brute force."""

import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from shelfmill.operators import batches, dedup, formatter, merge, navigation, rows, running, stats
from shelfmill.schemas import VARIANT
from tests.conftest import plan_text


def test_first_per_handle_with_a_hot_handle(spark):
    data = [(i, "hot" if i % 3 == 0 else f"h{i % 40}", f"t{i}") for i in range(900)]
    df = spark.createDataFrame(data, "seq bigint, handle string, title string").repartition(7)
    expected = {}
    for seq, handle, title in data:
        expected.setdefault(handle, (seq, title))
    got = {r.handle: (r.seq, r.title) for r in dedup.first_per_handle(df).collect()}
    assert got == expected


def accepted(cards):
    seen, out = set(), []
    for seq, card, final in sorted(cards):
        if card not in seen:
            seen.add(final)
            out.append(seq)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_sequential_acceptance(spark, seed):
    rng = random.Random(seed)
    cards = [(i, f"h{rng.randint(0, 12)}", f"h{rng.randint(0, 12)}") for i in range(120)]
    if seed == 3:  # a chain where every second card is skipped
        cards = [(i, f"h{i}", f"h{i + 1}") for i in range(30)]
    df = spark.createDataFrame(cards, "seq bigint, handle string, final_handle string").repartition(5)
    got = sorted(r.seq for r in dedup.accept_in_order(df).collect())
    assert got == accepted(cards)


def test_not_exported(spark):
    cards = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "seq bigint, handle string")
    known = spark.createDataFrame([("a",), ("z",)], "handle string")
    assert sorted(r.seq for r in dedup.not_exported(cards, known).collect()) == [2, 3]


def test_sum_before_of_several_columns(spark):
    """Struct keys with nulls and negative ids, a key that a third of all rows share, empty input."""
    rng = random.Random(8)
    rows = [(rng.choice([None, "a", "b"]), rng.randrange(-40, 40), rng.randrange(3), rng.randrange(4)) for _ in range(600)]
    rows += [("a", -1, 0, 1)] * 300
    df = spark.createDataFrame(rows, "cat string, id bigint, place int, n bigint").repartition(6)
    got = running.sum_before(df.withColumn("key", F.struct("cat", "id", "place")), "key", "n", "before").collect()
    assert len(got) == len(rows)
    key = lambda r: (r.key.cat is not None, r.key.cat or "", r.key.id, r.key.place)
    total = 0
    for r in sorted(got, key=lambda r: (key(r), r.before, r.n)):
        assert r.before == total
        total += r.n
    assert running.sum_before(df.where("id > 99"), "id", "n", "before").collect() == []


def plain_batches(sizes, size):
    out, batch, held = [], 0, 0
    for n in sizes:
        out.append(batch)
        held += n
        if held >= size:
            batch, held = batch + 1, 0
    return out


@pytest.mark.parametrize("size", [1, 10, 95, 10_000])
def test_batches(spark, size):
    rng = random.Random(size)
    groups = {"x": [7, 6, 7], "y": [rng.choice([1, 2, 3, 9, 200]) for _ in range(300)], None: [1] * 70, "z": [500]}
    rows = [(g, -1000 + 3 * i, n, "h") for g, sizes in groups.items() for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "g string, seq bigint, n_rows int, handle string").repartition(5)
    got = batches.form_batches(df, size, by=["g"])
    for g, sizes in groups.items():
        mine = sorted((r.seq, r.batch) for r in got.collect() if r.g == g)
        assert [b for _, b in mine] == plain_batches(sizes, size)
    assert got.count() == len(rows)
    assert batches.form_batches(df.where("seq > 10000"), size).collect() == []


def test_batches_of_the_sample_run(spark):
    df = spark.createDataFrame([(0, 7, "a"), (5, 6, "a"), (9, 7, "b")], "seq bigint, n_rows int, handle string")
    report = batches.batch_report(batches.form_batches(df, 10)).orderBy("batch").collect()
    assert [tuple(r) for r in report] == [(0, 1, 13), (1, 1, 7)]


def test_long_chains_take_few_rounds(spark, monkeypatch):
    """Rounds grow with the logarithm of a chain, not with its length."""
    rounds = []
    real = dedup.stored
    monkeypatch.setattr(dedup, "stored", lambda df, name: rounds.append(name) or real(df, name))
    for n in (16, 256):
        rounds.clear()
        cards = spark.createDataFrame([(i, f"h{i}", f"h{i + 1}") for i in range(n)], "seq bigint, handle string, final_handle string")
        got = dedup.accept_in_order(cards).collect()
        assert sorted(r.seq for r in got) == list(range(0, n, 2))
        assert len(rounds) <= 12 + n.bit_length()


@pytest.mark.parametrize("spacing", [1, 1 << 19, 1 << 40])
def test_sum_before(spark, spacing):
    rng = random.Random(2)
    data = [(i * spacing, rng.randint(1, 9), i % 3) for i in range(400)]
    df = spark.createDataFrame(data, "seq bigint, n_rows bigint, g bigint").repartition(6)
    total, expected = 0, {}
    for seq, n, _ in data:
        expected[seq], total = total, total + n
    got = {r.seq: r.b for r in running.sum_before(df, "seq", "n_rows", "b").collect()}
    assert got == expected
    by_group = {r.seq: r.b for r in running.sum_before(df, "seq", "n_rows", "b", by=["g"]).collect()}
    sums = {0: 0, 1: 0, 2: 0}
    for seq, n, g in data:
        assert by_group[seq] == sums[g]
        sums[g] += n


@pytest.mark.parametrize("limit", [0, -1, 1, 20, 37, 10_000])
def test_limit_counts_rows_and_keeps_products_whole(spark, limit):
    sizes = [7, 6, 7, 1, 1, 30, 2, 5]
    df = spark.createDataFrame(list(enumerate(sizes)), "seq bigint, n_rows bigint").repartition(3)
    expected, total = [], 0
    for i, n in enumerate(sizes):
        if total < limit:
            expected.append(i)
        total += n
    got = sorted(r.seq for r in running.limit_products(df, limit).collect())
    assert got == expected
    by_product = sorted(r.seq for r in running.limit_products(df, limit, unit="products").collect())
    assert by_product == list(range(len(sizes)))[: max(limit, 0)]


def test_row_numbers(spark):
    df = spark.createDataFrame([(0, 7), (5, 6), (9, 7)], "seq bigint, n_rows bigint")
    got = running.row_numbers(df).orderBy("seq").collect()
    assert [r.row_number for r in got] == [1, 8, 14]


def test_catalogue_cut(spark):
    data = [(1, 5, 5, "ok"), (2, 0, 0, "error"), (3, 4, 2, "ok"), (4, 4, 0, "ok"), (5, 4, 4, "ok")]
    df = spark.createDataFrame(data, "page_num bigint, n_cards bigint, n_new bigint, status string")
    assert sorted(r.page_num for r in navigation.end_of_catalogue(df).collect()) == [1, 2, 3, 4]
    endless = df.where("page_num <> 4")
    assert navigation.end_of_catalogue(endless).count() == 4
    two = df.withColumn("shop", F.lit("a")).union(endless.withColumn("shop", F.lit("b")))
    assert navigation.end_of_catalogue(two, by=("shop",)).groupBy("shop").count().collect()
    counts = {r["shop"]: r["count"] for r in navigation.end_of_catalogue(two, by=("shop",)).groupBy("shop").count().collect()}
    assert counts == {"a": 4, "b": 4}


def test_follow_links(spark):
    links = [(f"u{i}", f"u{i + 1}") for i in range(37)] + [("u37", None), ("c0", "c1"), ("c1", "c2"), ("c2", "c0"), ("x", "gone")]
    df = spark.createDataFrame(links, "url string, next_url string")
    seeds = spark.createDataFrame([("u0",), ("u30",), ("c1",), ("x",), ("missing",)], "seed string")
    got = {}
    for r in navigation.follow_links(df, seeds).collect():
        got.setdefault(r.seed, []).append((r.position, r.url))
    nexts = dict(links)
    for seed in ["u0", "u30", "c1", "x"]:
        walk, url = [], seed
        while url in nexts and url not in walk:
            walk.append(url)
            url = nexts[url]
        assert [u for _, u in sorted(got[seed])] == walk
    assert "missing" not in got


def test_nearest_seeds_match_a_plain_walk(spark):
    rng = random.Random(12)
    for case in range(4):
        n = 120
        nexts = {i: rng.choice([None, rng.randrange(n), i + 1, i + 1, i + 1]) for i in range(n)}
        chosen = rng.sample(range(n + 5), (3, 20, 60, 1)[case])
        links = spark.createDataFrame([(f"u{i}", None if j is None else f"u{j}") for i, j in nexts.items()], "url string, next_url string")
        seeds = spark.createDataFrame([(f"u{i}",) for i in chosen] * 2 + [(None,)], "seed string")
        expected = {}
        for seed in chosen:
            at, position, seen = seed, 0, set()
            while at in nexts and at not in seen:
                seen.add(at)
                expected[f"u{at}"] = min(expected.get(f"u{at}", (n, "")), (position, f"u{seed}"))
                at, position = nexts[at], position + 1
        rows = navigation.nearest_seeds(links, seeds).collect()
        assert len(rows) == len(expected)
        assert {r.url: (r.position, r.seed) for r in rows} == expected
    assert navigation.nearest_seeds(links, seeds.limit(0)).count() == 0


def test_many_seeds_on_one_chain_give_a_row_per_page(spark):
    chain = spark.range(301).select(F.format_string("u%03d", "id").alias("url"), F.when(F.col("id") < 300, F.format_string("u%03d", F.col("id") + 1)).alias("next_url"))
    seeds = chain.limit(100).select(F.col("url").alias("seed"))
    got = navigation.nearest_seeds(chain, seeds).orderBy("url").collect()
    assert [(r.seed, r.position) for r in got] == [(f"u{min(i, 99):03d}", max(0, i - 99)) for i in range(301)]


def test_walk_stops_before_a_page_without_cards(spark):
    df = spark.createDataFrame(
        [("a", "b", 3), ("b", "c", 1), ("c", "d", 0), ("d", None, 4)],
        "url string, next_url string, n_cards int",
    )
    seeds = spark.createDataFrame([("a",)], "seed string")
    got = navigation.walk_next_links(df, seeds).orderBy("position").collect()
    assert [r.url for r in got] == ["a", "b"]


def test_page_patterns(spark):
    urls = [r.url for r in navigation.expand_pattern(spark, "https://s/p/{}/", 2, 4).collect()]
    assert urls == ["https://s/p/2/", "https://s/p/3/", "https://s/p/4/"]
    stored = [(i, u) for i, u in enumerate(urls + ["https://s/p/03/", "https://s/p/9/", "https://s/p/x/", "https://t/p/3/"])]
    pages = spark.createDataFrame(stored, "page_id bigint, url string")
    got = navigation.pattern_pages(pages, "https://s/p/{}/", 3, 8).collect()
    assert sorted((r.page_id, r.page_num) for r in got) == [(1, 3), (2, 4)]


NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@contextmanager
def settings(spark, changed):
    saved = {k: spark.conf.get(k, None) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


CARD = "seq bigint, title string, price string, image string, descr string, url string"
PRODUCT = (
    "url string, title string, price string, raw_desc string, main_image string, "
    f"extra_images array<string>, variants array<{VARIANT}>"
)
ONE = ("Size", "L", "", "", "", "", "", "4.00")


def test_merge_falls_back_field_by_field(spark):
    cards = spark.createDataFrame(
        [
            (1, "Card", "5.00", "/i", "cd", "u1"),
            (2, "Card", "5.00", "/i", "cd", "u2"),
            (3, "", "", "", "", ""),
            (4, "Lost", "6.00", "", "", "u9"),
        ],
        CARD,
    )
    products = spark.createDataFrame(
        [("u1", "Page", "0.00", "pd", "/m", ["/x"], [ONE]), ("u2", "", "8.00", "", "", [], [])], PRODUCT
    )
    got = {r.seq: r for r in merge.merge_cards(cards, products).collect()}
    assert (got[1].title, got[1].price, got[1].raw_desc, got[1].main_image) == ("Page", "0.00", "pd", "/m")
    assert (got[2].title, got[2].price, got[2].raw_desc, got[2].main_image) == ("Card", "8.00", "cd", "/i")
    assert (got[3].title, got[3].price, got[3].handle) == ("Untitled Product", "0.00", "untitled-product")
    assert got[2].variants[0].opt1_value == "Default Title" and got[2].variants[0].price == "8.00"
    assert [got[i].failed_url for i in (1, 2, 3, 4)] == [None, None, None, "u9"]
    alone = {r.seq: r for r in merge.merge_cards(cards, None).collect()}
    assert alone[1].title == "Card" and alone[4].failed_url is None
    assert [r.url for r in merge.failed_pages(cards, products).collect()] == ["u9"]


def test_one_record_per_url(spark):
    rows_ = [(9, "u", None, "old"), (3, "u", None, "first"), (7, "v", "2026-01-01", "a"), (8, "v", "2026-02-01", "b")]
    df = spark.createDataFrame(rows_, "page_id bigint, url string, f string, title string").select(
        "page_id", "url", F.col("f").cast("timestamp").alias("fetched_at"), "title",
        F.lit("").alias("price"), F.lit("").alias("raw_desc"), F.lit("").alias("main_image"),
        F.lit("").alias("extra_images"), F.lit("").alias("variants"),
    )
    assert {r.url: r.title for r in merge.one_per_url(df).collect()} == {"u": "first", "v": "b"}


def loop_rows(variants, main, extras):
    """Row layout by a plain loop: (first?, variant or None, image)."""
    out = []
    for i, v in enumerate(variants):
        image = main if i == 0 else (extras[i - 1] if i - 1 < len(extras) else "")
        out.append((i == 0, v, image))
    out += [(False, None, x) for x in extras[max(0, len(variants) - 1):]]
    return out


@pytest.mark.parametrize("n_variants,n_extras", [(1, 0), (1, 6), (4, 2), (3, 2), (2, 5)])
def test_import_rows(spark, n_variants, n_extras):
    variants = [("Size", f"v{i}", "", "", "", "", f"s{i}", "1.00") for i in range(n_variants)]
    extras = [f"/x{i}" for i in range(n_extras)]
    df = spark.createDataFrame(
        [(1, "h", "T", "<p>", "src", "/m", extras, variants)],
        "seq bigint, handle string, title string, body_html string, source_url string, "
        f"main_image string, extra_images array<string>, variants array<{VARIANT}>",
    )
    out = rows.import_rows(df)
    got = out.orderBy("seq", "pos").collect()
    expected = loop_rows([v[1] for v in variants], "/m", extras)
    assert [(r["Title"] == "T", r["Option1 Value"] or None, r["Image Src"]) for r in got] == expected
    assert all(r["Handle"] == "h" for r in got)
    assert [r["Source URL"] for r in got] == ["src"] + [""] * (len(got) - 1)
    assert df.select(rows.n_rows().alias("n")).collect()[0].n == len(got)
    assert "Exchange" not in plan_text(out)


def test_stats(spark):
    data = [(7, True, None), (6, False, "u"), (7, False, None)]
    df = spark.createDataFrame(data, "n_rows bigint, used_ai boolean, failed_url string")
    got = stats.run_stats(df, 20).collect()[0].asDict()
    assert got == {
        "total_products": 3, "total_rows": 20, "ai_success": 1, "ai_fallback": 2,
        "page_failures": 1, "ai_rate": 33, "progress_pct": 15,
    }
    assert [r.url for r in stats.failed_urls(df).collect()] == ["u"]
    empty = stats.run_stats(df.where("n_rows < 0"), 0).collect()[0]
    assert (empty.total_rows, empty.ai_rate, empty.progress_pct) == (0, 0, 0)
    assert stats.run_stats(df, 2).collect()[0].progress_pct == 100


def test_formatter_sends_each_text_once(spark, tmp_path):
    log = str(tmp_path / "calls")

    def fn(batch):
        with open(log, "a") as f:
            f.writelines(t + "\n" for t in batch)
        if len(batch) > 1:
            raise RuntimeError("batches not supported")
        if "bad" in batch[0]:
            raise RuntimeError("refused")
        return ["```html\n<p>" + batch[0].upper() + "</p>\n```"]

    texts = ["aa", "bad", "aa", "", " \n", None, "cc"]
    df = spark.createDataFrame(list(enumerate(texts)), "seq bigint, raw_desc string").repartition(4)
    got = formatter.format_descriptions(df, fn, instructions="").orderBy("seq").collect()
    none = "<p>No description available.</p>"
    assert [(r.body_html, r.used_ai) for r in got] == [
        ("<p>AA</p>", True), ("<p>bad</p>", False), ("<p>AA</p>", True), (none, False),
        (none, False), (none, False), ("<p>CC</p>", True),
    ]
    sent = open(log).read().split()
    assert set(sent) == {"aa", "bad", "cc"}
    plain = formatter.format_descriptions(df).orderBy("seq").collect()
    assert plain[0].body_html == "<p>aa</p>" and not plain[0].used_ai


def test_native_expressions_stay_in_the_jvm(spark):
    from shelfmill.functions import text, urls

    df = spark.range(5).select(F.col("id").cast("string").alias("t"))
    plan = plan_text(
        df.select(text.slugify("t"), text.strip_tags("t"), urls.resolve_url("t", F.lit("http://a/")))
    )
    assert "Python" not in plan and "Exchange" not in plan


def test_only_one_python_stage_and_pruned_scan(spark):
    from shelfmill.operators import extract

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    plan = plan_text(extract.product_pages(pages))
    assert plan.count("ArrowEvalPython") == 1
    links = plan_text(
        pages.select("page_id", "url").where(F.col("url").startswith("https://")).select("page_id")
    )
    assert "StringStartsWith" in links and "html" not in links.split("ReadSchema")[1]


def test_cards_without_a_link_are_spread(spark):
    cards = spark.range(20_000).select(
        F.col("id").alias("seq"), F.lit("t").alias("title"), F.lit("1").alias("price"),
        F.lit("").alias("image"), F.lit("").alias("descr"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("u"), F.col("id"))).otherwise("").alias("url"),
    )
    products = spark.createDataFrame([("u1", "Page", "2", "", "", [], [])], PRODUCT)
    # Adaptive coalescing would hide the spread of this small input.
    with settings(spark, {**NO_BROADCAST, "spark.sql.adaptive.enabled": "false"}):
        merged = merge.merge_cards(cards, products)
        per_task = merged.groupBy(F.spark_partition_id()).count().collect()
    assert merged.where("failed_url is null").count() == 20_000 // 3 + 2
    assert len(per_task) == 8 and max(r["count"] for r in per_task) < 20_000 / 8 * 1.5


def test_a_hot_link_is_split(spark):
    """A product page linked by most cards does not end up in one task."""
    cards = spark.range(60_000).select(
        F.col("id").alias("seq"), F.lit("t" * 200).alias("title"), F.lit("1").alias("price"),
        F.lit("").alias("image"), F.lit("").alias("descr"),
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("url"),
    ).repartition(16)
    products = spark.createDataFrame([("hot", "", "2", "", "", [], [])], PRODUCT)
    changed = {
        **NO_BROADCAST,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    with settings(spark, changed):
        merged = merge.merge_cards(cards, products)
        assert merged.where("price = '2'").count() == 40_000
        merged.collect()
        assert "skew=true" in plan_text(merged)


def test_failed_batches_are_halved():
    """One bad prompt of 64 costs two calls for each halving, not one for each prompt."""
    calls = []

    def fn(batch):
        calls.append(len(batch))
        if "bad" in batch:
            raise ValueError
        return [t.upper() for t in batch]

    prompts = [f"t{i}" for i in range(64)]
    prompts[37] = "bad"
    got = formatter._answers(fn, prompts)
    assert got == [None if t == "bad" else t.upper() for t in prompts]
    assert len(calls) == 1 + 2 * 6
    assert formatter._answers(lambda b: b[:1], ["a", "b", "c"]) == ["a", "b", "c"]
    assert formatter._answers(lambda b: [], ["a", "b"]) == [None, None]
    assert formatter._answers(fn, []) == []


def test_answers_are_kept_across_runs(spark, tmp_path):
    """Only prompts without an answer are sent; failed ones are sent again."""
    log, folder = tmp_path / "asked", str(tmp_path / "answers")
    log.mkdir()
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, " "), (5, None)], "seq long, raw_desc string")

    def run(products, word, fails=(), instructions=""):
        def fn(batch, log=str(log)):
            with open(f"{log}/{word}", "a") as out:
                out.writelines(t + "\n" for t in batch)
            return [None if t in fails else f"<p>{word}</p>" for t in batch]

        done = formatter.format_descriptions(products, fn, instructions=instructions, answers=folder)
        got = {r.seq: (r.body_html, r.used_ai) for r in done.collect()}
        path = log / word
        return got, sorted(path.read_text().split("\n")[:-1]) if path.exists() else []

    got, asked = run(df, "one", fails=("b",))
    assert asked == ["a", "b"] and got[1] == got[3] == ("<p>one</p>", True) and not got[2][1]
    got, asked = run(df, "two")
    assert asked == ["b"] and got[1] == ("<p>one</p>", True) and got[2] == ("<p>two</p>", True)
    assert run(df, "three")[1] == []
    got, asked = run(df, "four", instructions="say: ")  # another prompt
    assert asked == ["say: a", "say: b"] and got[1] == ("<p>four</p>", True) and not got[4][1]


def test_batches_in_blocks_agree_with_links_and_take_few_links(spark, monkeypatch):
    """Products larger than blocks, blocks smaller than batches; a link a block's state, not a product."""
    rng = random.Random(9)
    rows = [(g, i, rng.choice([1, 1, 2, 5, 40]), "h") for g in ("x", "y") for i in range(400)]
    df = spark.createDataFrame(rows, "g string, seq bigint, n_rows int, handle string").repartition(5)
    followed = []
    real = batches.follow_links
    monkeypatch.setattr(batches, "follow_links", lambda links, seeds: followed.append(links.count()) or real(links, seeds))
    for size in (1, 3, 17):
        per_size = []
        for block in (1, 24, 300, 1 << 18):  # a block of one row: links of products
            monkeypatch.setattr(batches, "BLOCK", block if block == 1 else max(block, 4 * size))
            got = batches.form_batches(df, size, by=["g"]).collect()
            per_size.append(sorted((r.g, r.seq, r.batch) for r in got))
        assert per_size[0] == per_size[1] == per_size[2] == per_size[3]
        assert followed[-1] == 2 and len(per_size[0]) == 800
        for g in ("x", "y"):
            assert [b for h, _, b in per_size[0] if h == g] == plain_batches([n for h, _, n, _ in rows if h == g], size)
