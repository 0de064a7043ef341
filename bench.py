"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the
local cores. Each query runs once after a warm-up of the Python workers; its
time covers planning, execution and reading every result column.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from shelfmill.plans.queries import QUERIES

HEADLINE = [
    "page_handles",
    "page_links",
    "resolved_links",
    "article_text",
    "element_counts",
    "records",
    "dedup_first",
    "import_rows",
    "review_rows",
    "csv_round_trip",
    "stream_export",
    "normalized_prices",
    "clean_prices",
    "srcset_best",
    "image_filter",
    "fallback_html",
    "document_handles",
    "formatted_descriptions",
    "order_cards",
    "part_product_pages",
    "part_page_variants",
    "catalogue_rows",
    "card_page_merge",
    "failed_urls",
    "resume_anti",
    "dedup_reference",
    "variant_rows",
    "option_overflow",
    "json_variants",
    "dom_options",
    "row_numbers",
    "limit_rows",
    "catalogue_cut",
    "next_chain",
    "run_stats",
    "batch_stats",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shelfmill-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("page_handles")
    times = {name: run(name) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total_time_headline_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
