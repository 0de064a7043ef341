"""Outputs of a run that become visible together.

A run writes each output to a folder of its own below the output's path and
then appends one row to a table of commits next to the import file. One row is
one file, which a job's commit shows at once or never. Readers and resumed runs
go by that table, so a run that dies between its outputs has written neither:
the next run exports its products again, to both. A fresh run hides all runs
before it. Runs with the same output follow one another; folders of runs that
never committed stay where they are until their owner clears them.
"""

from __future__ import annotations

import posixpath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmill.sources.tables import empty_handles, export_handles, read_export

_COMMIT = "number bigint, run string, fresh boolean, committed_at timestamp"


def commits_path(output: str) -> str:
    """``dir/name.csv`` -> ``dir/name_commits``."""
    folder, name = posixpath.split(output)
    return posixpath.join(folder, f"{posixpath.splitext(name)[0]}_commits")


def run_folder(path: str, run: str) -> str:
    return posixpath.join(path, f"run={run}")


def _commits(spark: SparkSession, output: str) -> list:
    """Commits in order; one row a run."""
    try:
        return spark.read.schema(_COMMIT).json(commits_path(output)).orderBy("number").collect()
    except AnalysisException:
        return []


def committed_runs(spark: SparkSession, output: str) -> list[str]:
    """Runs that make up the output now: the last fresh one and those that resumed it."""
    commits = _commits(spark, output)
    first = max((i for i, c in enumerate(commits) if c.fresh), default=0)
    return [c.run for c in commits[first:]]


def commit_run(spark: SparkSession, output: str, run: str, fresh: bool) -> None:
    """Make all outputs of a run visible."""
    earlier = _commits(spark, output)
    number = earlier[-1].number + 1 if earlier else 0
    row = spark.range(0, 1, 1, 1).select(
        F.lit(number).cast("bigint").alias("number"),
        F.lit(run).alias("run"),
        F.lit(fresh).alias("fresh"),
        F.current_timestamp().alias("committed_at"),
    )
    row.write.mode("append").json(commits_path(output))


def read_committed(spark: SparkSession, output: str, path: str | None = None) -> DataFrame | None:
    """Rows of the committed runs in ``path``, the import file by default; None without a commit.

    All runs of an output use one profile.
    """
    folders = [run_folder(path or output, run) for run in committed_runs(spark, output)]
    return read_export(spark, folders) if folders else None


def committed_handles(spark: SparkSession, output: str) -> DataFrame:
    """Distinct handles of the committed runs as column ``handle``."""
    export = read_committed(spark, output)
    return empty_handles(spark) if export is None else export_handles(export)
