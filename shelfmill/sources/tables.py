"""Inputs: crawled pages, prior exports, seed lists."""

from __future__ import annotations

import posixpath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmill.functions.text import strip_ws
from shelfmill.schemas import IMPORT_COLUMNS, PAGE_COLUMNS

BOM = "﻿"


def page_schema(columns: list[str] | None = None) -> str:
    return ", ".join(f"{c} {t}" for c, t in PAGE_COLUMNS.items() if columns is None or c in columns)


def conform_pages(pages: DataFrame) -> DataFrame:
    """Known page columns with their types; other columns are not read."""
    missing = {"page_id", "url", "html"} - set(pages.columns)
    if missing:
        raise ValueError(f"page table lacks {sorted(missing)}")
    return pages.select(
        *[F.col(c).cast(t).alias(c) for c, t in PAGE_COLUMNS.items() if c in pages.columns]
    )


def read_pages(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    return conform_pages(spark.read.format(format).load(path))


def stream_pages(
    spark: SparkSession, path: str, glob: str | None = None, max_files: int = 1000
) -> DataFrame:
    """Page table that grows by files, as a stream.

    The columns are those of the files present at start; an empty folder is
    taken to get every known page column. ``glob`` names entries of ``path``:
    files, or tables that are folders of files.
    """
    if glob:
        # A path with a pattern may lead to files and to folders; a plain name becomes one.
        plain = not set(glob) & set("*?[{")
        path = posixpath.join(path, f"{glob[:-1]}[{glob[-1]}]" if plain else glob)
    known = page_schema()
    try:
        present = spark.read.parquet(path).schema
        known = T.StructType([f for f in present.fields if f.name in PAGE_COLUMNS])
    except AnalysisException:
        pass
    stream = spark.readStream.schema(known).options(maxFilesPerTrigger=max_files)
    return conform_pages(stream.parquet(path))


def empty_handles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "handle string")


def read_export(spark: SparkSession, path: str | list[str], format: str = "csv") -> DataFrame:
    """A written import or review file, or several, every column as string.

    Blank cells are null, quoted empty ones the empty string.
    """
    reader = spark.read
    if format == "csv":
        reader = reader.options(
            header=True,
            escape='"',
            multiLine=True,
            inferSchema=False,
            nullValue="\0",  # the default would make null of quoted empty cells too
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
    df = reader.format(format).load(path)
    first = df.columns[0] if df.columns else ""
    return df.withColumnRenamed(first, first.lstrip(BOM)) if first.startswith(BOM) else df


def export_handles(export: DataFrame, column: str = IMPORT_COLUMNS[0]) -> DataFrame:
    """Distinct handles of a read export; without their column an empty set."""
    if column not in export.columns:
        return empty_handles(export.sparkSession)
    handle = F.col(column).cast("string").alias("handle")
    return export.select(handle).where(F.col("handle").isNotNull()).distinct()


def exported_handles(
    spark: SparkSession, path: str, column: str = IMPORT_COLUMNS[0], format: str = "csv"
) -> DataFrame:
    """Distinct handles of a prior export as column ``handle``.

    Handles stay strings. A missing or unreadable export is an empty set.
    """
    try:
        export = read_export(spark, path, format)
    except AnalysisException:
        return empty_handles(spark)
    return export_handles(export, column)


def read_seeds(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Seed URLs of a text file and the rejected lines."""
    lines = spark.read.text(path).select(strip_ws(F.regexp_replace("value", BOM, "")).alias("seed"))
    valid = F.col("seed").startswith("http")
    return lines.where(valid), lines.where(~valid & (F.col("seed") != ""))
