"""What the operators share: tables, intermediate tables, Arrow helpers."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logsilt.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Most rows of a few numbers each that are broadcast (some 50 MB); beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(narrow: DataFrame) -> DataFrame:
    """A written table of narrow rows, to be broadcast if it is small, so that texts need not move."""
    return F.broadcast(narrow) if narrow.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else narrow


def on_path(spark: SparkSession) -> None:
    """Put this package on the workers' path where they share the file system.

    Elsewhere the package comes the usual way, by ``--py-files`` or as part of the image.
    """
    home = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in known:
        environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, known)])


#: Most bytes of rows that a task hands to its Python worker at once, give or take a row. Both sides hold
#: some batches outside the Java heap: with Spark's own 64 MB, texts take several hundred MB an executor.
BATCH_BYTES = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Limit the session's batches to ``BATCH_BYTES``, unless it was given a limit.

    The setting counts when a plan runs, which may be after our functions have returned, so it stays.
    """
    spark.conf.set(BATCH_SETTING, spark.conf.get(BATCH_SETTING, f"{BATCH_BYTES}b"))


def by_batch(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` in small batches, with this package on the workers' path."""
    on_path(df.sparkSession)
    small_batches(df.sparkSession)
    return df.mapInArrow(function, schema)
