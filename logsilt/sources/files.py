"""Readers that are one Spark call: Parquet, CSV, JSON with an inferred schema, globs, partitions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logsilt.layout import TIME_KEYS, Store, Subject


def as_paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_parquet_paths(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.parquet(*as_paths(paths))


def read_glob(spark: SparkSession, pattern: str, suffix: str | None = None) -> DataFrame:
    """Parquet files under a wildcard path; hidden files (``_x``, ``.x``) are skipped.

    ``suffix`` keeps only file names that end in it.
    """
    reader = spark.read
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return reader.parquet(pattern)


def read_csv_header(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV with a header line; every column is a string."""
    return spark.read.option("header", True).csv(as_paths(paths))


def union_files(frames: Sequence[DataFrame]) -> DataFrame:
    """Inputs of one batch under each other, matched by column name."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_partition(
    spark: SparkSession, store: Store, subject: Subject, action_time: str
) -> DataFrame:
    """One partition of a registered table, all its folders. Only these folders are listed."""
    df = spark.table(store.table_name(subject))
    for key, value in zip(TIME_KEYS, action_time.split("/")):
        df = df.where(F.col(key) == value)
    return df


def read_partition_folder(
    spark: SparkSession, store: Store, subject: Subject, action_time: str,
    schema: StructType | None = None,
) -> DataFrame:
    """The same from plain ``<db>/<table>/<action time>/<random>/`` folders, without a catalog."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{store.table_root(subject)}/{action_time}/*")
