"""Outputs: import CSV, review CSV, failed URLs, run summary."""

from __future__ import annotations

import posixpath
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmill.functions.text import blank_to_null
from shelfmill.operators.rows import ORDER, import_columns, review_rows
from shelfmill.schemas import REVIEW_SUFFIX
from shelfmill.sources.tables import BOM

# Part files stay small enough for one task to read back, since quoted line
# breaks make a CSV file indivisible.
ROWS_PER_FILE = 1_000_000

_CSV = {
    "header": True,
    "escape": '"',
    "emptyValue": '""',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "encoding": "UTF-8",
}


def derive_review_path(output: str) -> str:
    """``dir/name.csv`` -> ``dir/name_client_review.csv``."""
    folder, name = posixpath.split(output)
    stem = posixpath.splitext(name)[0]
    return posixpath.join(folder, f"{stem}{REVIEW_SUFFIX}.csv")


def in_export_order(rows: DataFrame, files: int | None = None) -> DataFrame:
    """Rows in export order.

    By default each task sorts its own rows. ``files`` range-partitions them,
    so that the part files follow one another in order.
    """
    if files is not None:
        rows = rows.repartitionByRange(files, *ORDER)
    return rows.sortWithinPartitions(*ORDER)


def _write_csv(
    rows: DataFrame, path: str, columns: list[str], mode: str, rows_per_file: int | None
) -> None:
    # An empty handle is written in quotes: it is one, unlike a blank cell.
    bom_first = [F.col(f"`{columns[0]}`").alias(BOM + columns[0])]
    rest = [blank_to_null(f"`{c}`").alias(c) for c in columns[1:]]
    writer = rows.select(*bom_first, *rest).write.mode(mode).options(**_CSV)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.csv(path)


def write_import(
    rows: DataFrame,
    path: str,
    mode: str = "overwrite",
    profile: str = "full",
    files: int | None = None,
    rows_per_file: int | None = ROWS_PER_FILE,
) -> None:
    """Import CSV: UTF-8 with byte order mark, source link left out.

    Every part file has its own mark and header and can be imported alone.
    """
    ordered = in_export_order(rows, files)
    _write_csv(ordered, path, import_columns(rows, profile), mode, rows_per_file)


def write_review(
    rows: DataFrame,
    path: str,
    mode: str = "overwrite",
    profile: str = "full",
    files: int | None = None,
    rows_per_file: int | None = ROWS_PER_FILE,
) -> None:
    """Review CSV with readable labels and link formulas."""
    ordered = in_export_order(rows, files)
    review = review_rows(ordered, profile)
    labels = [c for c in review.columns if c not in ORDER]
    _write_csv(review, path, labels, mode, rows_per_file)


def append_to_export(prior: DataFrame, rows: DataFrame) -> DataFrame:
    """Union of a prior export and new rows, by column name."""
    return prior.unionByName(rows.select(*prior.columns))


def write_failed_urls(failed: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """One URL per line; nothing is written when no page failed."""
    if failed.isEmpty():
        return False
    failed.select("url").write.mode(mode).text(path)
    return True


def write_summary(stats: DataFrame, path: str, started_at: datetime | None = None) -> None:
    """Append the run's counters to a JSON table, with its start and run time if known."""
    timed = stats.withColumn("finished_at", F.current_timestamp())
    if started_at is not None:
        timed = timed.withColumn("started_at", F.lit(started_at)).withColumn(
            "run_seconds", F.unix_timestamp("finished_at") - F.unix_timestamp("started_at")
        )
    timed.write.mode("append").json(path)
