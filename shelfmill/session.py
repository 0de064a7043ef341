"""Session settings and lineage handling."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings the jobs rely on. None of them changes a result.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split hot join keys even where that costs one more exchange downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Pages are large rows: small Arrow batches bound the Python workers' memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}

# Default size of one scan task.
SPLIT_BYTES = 128 << 20


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Without the
    setting a folder below the warehouse is used, which is shared as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shelfmill_scratch"
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the checkpoint folder and read it back.

    Unlike a checkpoint it is columnar, and its size is known to the planner.
    The folder is scratch space; its owner clears it.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scatter_key(key: Column, row_id: Column, slots: int = 1024) -> Column:
    """Join key that spreads rows without a key over many tasks.

    A missing key becomes one of ``slots`` strings that start with a zero
    character and so match no real key. (A second join column with a literal
    on the other side would not do: the optimizer turns it into a filter.)
    """
    slot = F.pmod(F.xxhash64(row_id), F.lit(slots)).cast("string")
    return F.coalesce(key, F.concat(F.lit("\0"), slot))


def spread(df: DataFrame) -> DataFrame:
    """Spread a small input over all cores before costly work per row.

    An input of less than one scan task would run in one task; it is dealt
    over the cores. A larger one has several tasks and is never shuffled here,
    however many cores there are.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df if estimate >= SPLIT_BYTES else df.repartition(cores)


def per_session(build: Callable) -> Callable:
    """Keep the columns that ``build`` returns for the life of the session.

    Large expressions take thousands of calls to the JVM to build. Arguments
    must be plain values; micro-batches and repeated jobs reuse the columns.
    """
    kept: dict[tuple, object] = {}

    @functools.wraps(build)
    def cached(*args, **kwargs):
        context = SparkContext.getOrCreate()
        key = (context.applicationId, repr(args), repr(sorted(kwargs.items())))
        if key not in kept:
            kept[key] = build(*args, **kwargs)
        return kept[key]

    return cached
