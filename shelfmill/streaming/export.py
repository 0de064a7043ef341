"""Incremental export with Structured Streaming."""

from __future__ import annotations

import posixpath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfmill.operators.dedup import first_per_handle, not_exported
from shelfmill.operators.formatter import BatchFormatter
from shelfmill.operators.dom import build_selectors
from shelfmill.operators.extract import product_pages
from shelfmill.operators.merge import one_per_url
from shelfmill.operators.navigation import loaded
from shelfmill.plans.catalogue import (
    CatalogueJob,
    accepted_cards,
    build_catalogue,
    finish_catalogue,
)
from shelfmill.session import cut_lineage
from shelfmill.sinks.files import derive_review_path, write_import, write_review

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _batch_folder(path: str, batch_id: int) -> str:
    return posixpath.join(path, f"batch_id={batch_id}")


def ledger_handles(spark, path: str, before_batch: int) -> DataFrame | None:
    """Handles that earlier batches exported; later batches of a replay are
    left out, so that a repeated batch sees what it saw the first time."""
    try:
        ledger = spark.read.schema("handle string, batch_id bigint").parquet(path)
    except AnalysisException:
        return None
    return ledger.where(F.col("batch_id") < before_batch).select("handle")


def batches_before(spark, path: str, batch_id: int, first: int = 0) -> DataFrame | None:
    """What the batches from ``first`` up to ``batch_id``, that one left out, wrote."""
    try:
        rows = spark.read.parquet(path)
    except AnalysisException:
        return None
    return rows.where(F.col("batch_id").between(first, batch_id - 1)).drop("batch_id")


def write_once(df: DataFrame, path: str, batch_id: int) -> None:
    """Parquet output of a batch; a replay replaces its own folder."""
    df.write.mode("overwrite").parquet(_batch_folder(path, batch_id))


def start_export(
    pages: DataFrame,
    output: str,
    ledger: str,
    checkpoint: str,
    job: CatalogueJob = CatalogueJob(limit=None),
    formatter: BatchFormatter | None = None,
    product_table: DataFrame | None = None,
    trigger: dict | None = None,
    wait_batches: int = 0,
) -> StreamingQuery:
    """Export arriving pages batch by batch, once per handle.

    A card's product page may arrive later than the card. With ``wait_batches``
    a linked card stays open until its page has come, in any batch, or so many
    further batches have passed; then it is exported with its card data. Open
    cards and product records are kept in tables next to the ledger. Without a
    wait a card only sees product pages of its own batch.

    A run limit and the end of a numbered or linked walk concern a whole run,
    not a batch, so jobs with them are refused.

    Every batch writes its own folder below both outputs and adds its handles
    to the ledger table, all keyed by batch id, so a replay is idempotent and
    a restart from the checkpoint continues where the run ended. The ledger
    holds what the job's rule records: card handles for ``first``, so that the
    stream exports what one batch run would, final handles for ``sequential``.
    """
    if job.limit is not None or job.url_pattern or job.next_selector:
        raise ValueError("a stream takes no limit, numbered pattern or next links: they span batches")
    if wait_batches and (product_table is not None or job.dedup != "first"):
        raise ValueError("waiting needs product pages of the stream and the policy 'first'")
    recorded = "card_handle" if job.dedup == "first" else "handle"

    def waited(batch: DataFrame, batch_id: int, exported: DataFrame | None):
        """Result of the cards that are due: their page is there, or they waited long enough."""
        spark, sels = batch.sparkSession, build_selectors(job.selectors)
        arrived = one_per_url(product_pages(loaded(batch), sels, job.strict_axes))
        write_once(arrived.withColumn("page_id", F.lit(-batch_id).cast("bigint")), f"{ledger}_products", batch_id)
        products = batches_before(spark, f"{ledger}_products", batch_id + 1)
        products = cut_lineage(one_per_url(products))  # of several records the latest batch's

        was_open = batches_before(spark, f"{ledger}_open", batch_id, batch_id - 1)
        if was_open is not None:
            handles = was_open.select("handle")
            exported = handles if exported is None else exported.unionByName(handles)
        cards = accepted_cards(batch, job, exported, None).withColumn("since", F.lit(batch_id))
        cards = cards if was_open is None else was_open.unionByName(cards)
        known = products.select("url", F.lit(True).alias("_there"))
        due = (F.col("url") == "") | F.col("_there").isNotNull() | (F.col("since") + wait_batches <= batch_id)
        cards = cut_lineage(cards.join(known, "url", "left").withColumn("_due", due).drop("_there"))
        write_once(cards.where(~F.col("_due")).drop("_due"), f"{ledger}_open", batch_id)
        return finish_catalogue(cards.where("_due").drop("_due", "since"), products, job, formatter)

    def export(batch: DataFrame, batch_id: int) -> None:
        exported = ledger_handles(batch.sparkSession, ledger, batch_id)
        if wait_batches:
            result = waited(batch, batch_id, exported)
        else:
            result = build_catalogue(
                batch, job, exported, product_table=product_table, formatter=formatter
            )
        write_import(result.rows, _batch_folder(output, batch_id))
        write_review(result.rows, _batch_folder(derive_review_path(output), batch_id))
        handles = result.products.select(F.col(recorded).alias("handle")).distinct()
        write_once(handles, ledger, batch_id)

    return (
        pages.writeStream.foreachBatch(export)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_handle_export(
    cards: DataFrame, ledger: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append cards with handles not exported before to a parquet ledger.

    ``cards`` is a stream with ``handle`` and ``seq``; within a batch the
    earliest card of a handle is kept.
    """
    def export(batch: DataFrame, batch_id: int) -> None:
        new = first_per_handle(batch)
        seen = ledger_handles(batch.sparkSession, ledger, batch_id)
        write_once(not_exported(new, seen) if seen is not None else new, ledger, batch_id)

    return (
        cards.writeStream.foreachBatch(export)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def distinct_handles(cards: DataFrame) -> DataFrame:
    """Stream of cards with a handle not seen before, kept in operator state.

    State grows with the handles, so use the RocksDB state store
    (``use_disk_state``). Which card of a handle arrives first is kept.
    """
    return cards.dropDuplicates(["handle"])


def use_disk_state(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
