"""Description formatting with an optional user function."""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmill.functions.text import clean_response, fallback_html, is_blank, prompt
from shelfmill.session import scatter_key

# Default instructions put before a description; callers may pass their own.
INSTRUCTIONS = (
    "Rewrite this product text as clean HTML. Put sentences into <p> and features "
    "into <ul><li>. Answer with the HTML only.\n\nTEXT:\n"
)

BatchFormatter = Callable[[Sequence[str]], Sequence[str | None]]


def _answers(fn: BatchFormatter, prompts: list[str]) -> list[str | None]:
    """Answers of a batch; one that fails is halved until the prompts that fail are alone."""
    done: list[str | None] = []
    waiting = [prompts]
    while waiting:
        batch = waiting.pop()
        try:
            answers = list(fn(batch)) if batch else []
        except Exception:
            answers = None
        if answers is not None and len(answers) == len(batch):
            done += answers
        elif len(batch) == 1:
            done.append(None)
        else:
            half = len(batch) // 2
            waiting += [batch[half:], batch[:half]]
    return done


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _ask(fn: BatchFormatter) -> Callable[[Column], Column]:
    def ask(prompts: pa.Array) -> pa.Array:
        return pa.array(_answers(fn, prompts.to_pylist()), pa.string())

    return F.arrow_udf(ask, "string").asNondeterministic()


def kept_answers(spark: SparkSession, path: str) -> DataFrame:
    """One answer a prompt; runs at one time may have asked for the same."""
    try:
        kept = spark.read.schema("_key string, _answer string").parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], "_key string, _answer string")
    return kept.groupBy("_key").agg(F.min("_answer").alias("_answer"))


def format_descriptions(
    products: DataFrame,
    fn: BatchFormatter | None = None,
    text: str = "raw_desc",
    row_id: str = "seq",
    instructions: str = INSTRUCTIONS,
    answers: str | None = None,
) -> DataFrame:
    """Add ``body_html`` and ``used_ai``.

    Without ``fn`` this is the fallback markup, a plain expression. With
    ``fn`` every distinct non-blank text is sent once; a null answer or an
    error gives the fallback. Blank texts never reach ``fn``. ``answers`` names
    a Parquet folder that keeps the answers by prompt: prompts that it holds
    are not sent again, in this or any later run, and failed ones are.
    """
    fallback = fallback_html(F.coalesce(text, F.lit("")))
    if fn is None:
        return products.withColumn("body_html", fallback).withColumn("used_ai", F.lit(False))
    key = F.when(~is_blank(text), F.sha2(prompt(text, instructions), 256))
    prompts = (
        products.select(key.alias("_key"), F.col(text).alias("_text"))
        .where(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.any_value("_text").alias("_text"))
    )
    if answers is not None:
        prompts = prompts.join(kept_answers(products.sparkSession, answers), "_key", "left_anti")
    asked = prompts.select("_key", _ask(fn)(prompt("_text", instructions)).alias("_answer"))
    if answers is not None:
        asked.where(F.col("_answer").isNotNull()).write.mode("append").parquet(answers)
        asked = kept_answers(products.sparkSession, answers)
    keyed = products.withColumn("_key", scatter_key(key, F.col(row_id)))
    return keyed.join(asked, "_key", "left").select(
        *[c for c in products.columns if c not in ("body_html", "used_ai")],
        F.coalesce(clean_response("_answer"), fallback).alias("body_html"),
        F.col("_answer").isNotNull().alias("used_ai"),
    )
