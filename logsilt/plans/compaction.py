"""Compaction: the many folders of a partition become one."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logsilt.catalog import ledger, tables
from logsilt.catalog.registry import load_rule
from logsilt.layout import RANDOM_KEY, Store, Subject, time_keys
from logsilt.session import delete_path, scratch_dir
from logsilt.sources.sinks import write_id, write_partition_parquet

_DELETE_THREADS = 16


def compact(
    spark: SparkSession,
    store: Store,
    subject: Subject,
    rule: str,
    files: int | None = None,
    partitions: Sequence[str] | None = None,
    min_folders: int = 2,
    max_bytes: int | None = None,
) -> int:
    """Rewrite each partition's live folders as one folder.

    Without ``partitions`` every partition that has ``min_folders`` live folders is taken; all of
    them in one plan. With ``max_bytes`` a partition's smallest folders are taken, as many as have so
    many bytes together, if these are ``min_folders`` at least; large folders are left alone, so that a
    row is not written again each time some small folders have come. Files are sized by bytes, or with ``files`` a partition has at most so many.
    Rows are kept as they are: nothing is deduplicated. One ledger entry swaps the folders, so ledger
    readers see either the old or the new ones; the catalog follows, new folders first, and a reader
    of the table may see both in between. Folders that are gone from storage are only unregistered.
    A partition that lost a folder to another writer meanwhile is left as that one made it. Old folders
    are deleted, or with ``store.keep_versions`` stay for readers of older entries until a vacuum.
    Returns the number of partitions taken.
    """
    keys = time_keys(rule)
    tables.sync_with_ledger(spark, store, subject)
    number = ledger.latest_number(spark, store, subject)
    events = ledger.ledger_events(spark, store, subject)
    if partitions is not None:
        wanted = spark.createDataFrame([(p,) for p in partitions], "partition string").distinct()
        events = events.join(wanted, "partition", "left_semi")
    least = 1 if partitions is not None and max_bytes is None else min_folders
    scratch = scratch_dir(spark, "compact")
    try:
        # exactly the folders of this snapshot; one that is registered meanwhile is left alone
        chosen_folders(events, least, max_bytes).write.parquet(f"{scratch}/old")
        old = spark.read.parquet(f"{scratch}/old")
        done = old.select("partition").distinct().count()
        if not done:
            return 0
        parts = F.split("partition", "/")
        chosen = old.where(F.col("partition") > "").select(
            *[F.get(parts, F.lit(i)).alias(k) for i, k in enumerate(keys)], RANDOM_KEY
        )
        table = spark.table(store.table_name(subject))
        rows = table.join(chosen, [*keys, RANDOM_KEY], "left_semi").select(*table.columns).drop(RANDOM_KEY)
        folder_id = write_id()
        # dealt by the number of the source task, which repeats itself over a file scan pruned by folder
        path = write_partition_parquet(rows, store.table_root(subject), keys, files, folder_id=folder_id)

        removed = old.select("partition", RANDOM_KEY, "path", F.lit(ledger.DELETE).alias("op"))
        added = ledger.written_events(spark, path, folder_id, keys)
        changes = added.unionByName(removed, allowMissingColumns=True).withColumn("kind", F.lit(ledger.MOVED))
        changes.write.parquet(f"{scratch}/changes")
        swap = spark.read.parquet(f"{scratch}/changes")
        outcome = ledger.commit(store, subject, swap, number, needed=old)
        while outcome.conflicts is not None:
            # another writer took folders out: its partitions are left as they are now
            lost = swap.where(F.col("op") == ledger.ADD).join(outcome.conflicts, "partition", "left_semi")
            for row in lost.collect():
                delete_path(spark, row.path)
            old, swap = (rows.join(outcome.conflicts, "partition", "left_anti") for rows in (old, swap))
            done = old.select("partition").distinct().count()
            outcome = ledger.commit(store, subject, swap, outcome.number, needed=old)
        tables.sync_with_ledger(spark, store, subject)
        if not store.keep_versions:
            with ThreadPoolExecutor(_DELETE_THREADS) as pool:
                list(pool.map(lambda r: delete_path(spark, r["path"]), old.select("path").toLocalIterator()))
    finally:
        delete_path(spark, scratch)
    ledger.trim(spark, store, subject)
    return done


def chosen_folders(events: DataFrame, min_folders: int, max_bytes: int | None = None) -> DataFrame:
    """Folders to rewrite (``partition, randompath, path``): of each partition all, or the smallest that
    have ``max_bytes`` together, where they are ``min_folders`` at least. A folder whose size the ledger
    does not know counts as empty."""
    live = ledger.own_folders(ledger.live_folders(events))
    if max_bytes is not None:
        size = F.coalesce("bytes", F.lit(0))
        smallest = Window.partitionBy("subject", "partition").orderBy(size, "path")
        live = live.withColumn("total", F.sum(size).over(smallest)).where(F.col("total") <= max_bytes)
    number = F.count("*").over(Window.partitionBy("subject", "partition"))
    return live.withColumn("folders", number).where(F.col("folders") >= min_folders).select("partition", RANDOM_KEY, "path")


def run_history(
    spark: SparkSession,
    store: Store,
    rules: DataFrame,
    subject: str,
    partition: str | None = None,
    files: int | None = None,
) -> int:
    """Compact one partition of a subject, or all that are due, by its registered rule.

    Files are sized by bytes, as a compacted partition may be large; ``files`` states a number.
    """
    rule = load_rule(rules, subject)
    names = None if partition is None else [partition]
    return compact(spark, store, Subject.parse(subject), rule.partition, files, names)
