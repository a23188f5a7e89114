"""Writers: partitioned Parquet folders, JSON lines, text lines."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsilt.layout import RANDOM_KEY, Store, Subject
from logsilt.session import apart

BACKUP = "_backup"
_SLOT = "__file_slot"
# Files a task may have open at once; rows of more partitions than that are sorted first.
_OPEN_FILES = 8


def write_id() -> str:
    return uuid.uuid4().hex


def write_folder(root: str, folder_id: str) -> str:
    return f"{root.rstrip('/')}/{RANDOM_KEY}={folder_id}"


def write_partition_parquet(
    df: DataFrame,
    root: str,
    keys: Sequence[str],
    files: int | None = None,
    spread_by: Column | None = None,
    folder_id: str | None = None,
) -> str:
    """Write all partitions of ``df`` in one job, each as at most ``files`` files; returns the folder.

    Every call writes its own ``<root>/randompath=<id>/``, so writers of one table never share a
    commit folder and a failed write leaves nothing a reader could see. Rows of a
    partition go to one of ``files`` slots by ``spread_by`` (default: by source task, which spreads
    a hot partition whatever its rows are and does not change when a task is run again). A slot is
    one task, so ``files`` is for partitions of a known, moderate size. Without it, the form for
    large partitions, Spark sizes files by bytes and gives a partition as many writers as it needs.
    Either way a task hands its rows on to its files as they come: sorted by ``keys`` beforehand, as is
    Spark's way otherwise, all rows of a slot would be held in memory.
    """
    path = write_folder(root, folder_id or write_id())
    if files is None:
        out = df.hint("rebalance", *keys) if keys else df.hint("rebalance")
    else:
        if files < 1:
            raise ValueError("files must be at least 1")
        source = F.spark_partition_id() if spread_by is None else F.xxhash64(spread_by)
        # no stated number of tasks: Spark may merge small slots into a task but never splits one
        slotted = df.withColumn(_SLOT, F.pmod(source, F.lit(files)))
        out = slotted.repartition(*keys, _SLOT).drop(_SLOT)
    with apart(out, {"spark.sql.maxConcurrentOutputFileWriters": str(_OPEN_FILES)}) as alone:
        alone.write.partitionBy(*keys).parquet(path)
    return path


def write_backup_parquet(
    df: DataFrame,
    store: Store,
    subject: Subject,
    keys: Sequence[str],
    files: int | None = None,
) -> str:
    """The same under the store's backup root, which no table points at."""
    root = f"{store.root.rstrip('/')}/{BACKUP}/{subject.db}/{subject.table}"
    return write_partition_parquet(df, root, keys, files)


def write_json(
    df: DataFrame,
    path: str,
    compression: str = "none",
    date_format: str = "yyyy-MM-dd",
    timestamp_format: str = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
) -> None:
    """JSON lines in UTF-8; fields that are NULL are left out."""
    df.write.options(
        compression=compression,
        dateFormat=date_format,
        timestampFormat=timestamp_format,
        ignoreNullFields="true",
    ).json(path)


def write_text(df: DataFrame, path: str, column: str | None = None) -> None:
    """One value per line; NULL is written as ``null``."""
    name = column or df.columns[0]
    df.select(F.coalesce(F.col(name).cast("string"), F.lit("null")).alias("value")).write.text(path)
