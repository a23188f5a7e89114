"""Small jobs over landed data."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsilt.catalog import ledger
from logsilt.layout import RANDOM_KEY, Store, Subject, quoted, time_keys
from logsilt.operators.dedup import distinct_values
from logsilt.session import child_folders, delete_path, move_new
from logsilt.sources.files import read_glob
from logsilt.sources.sinks import write_text

# Sets of distinct values that are folded into one when there are more.
_FOLD = 16


def distinct_column(
    spark: SparkSession, pattern: str, column: str, out: str | None = None
) -> DataFrame:
    """Distinct values of one column over a wildcard path, written as text lines if asked."""
    found = distinct_values(read_glob(spark, pattern), column)
    if out:
        write_text(found, out)
    return found


def distinct_of_table(spark: SparkSession, store: Store, subject: Subject, column: str, rule: str) -> DataFrame:
    """Distinct values of a column of a landed table, from the sets kept of its folders.

    A run scans the folders that have come since the last one, and only their column. A folder made by
    compaction takes over the values of the folders it replaced, which its ledger entry names, and is
    not scanned either. Folders that have gone leave with their values, so the result is that of a full
    scan. NULL is a value. One run at a time per column may fold the kept sets.
    """
    home = f"{store.root.rstrip('/')}/_distinct/subject={subject}/column={column}"
    name = quoted(column)
    table = spark.table(store.table_name(subject))
    kind = table.select(name).schema[0].dataType
    schema = f"path string, present boolean, value {kind.simpleString()}"
    events = ledger.ledger_events(spark, store, subject)
    live = ledger.live_folders(events)

    def kept() -> DataFrame:
        sets = child_folders(spark, f"{home}/set=*")
        return spark.read.schema(schema).parquet(*sets) if sets else spark.createDataFrame([], schema)

    def keep(rows: DataFrame) -> None:
        """Add a set. It gets its name when it is complete, so that half of one is never read."""
        made = uuid.uuid4().hex
        rows.select("path", "present", "value").write.parquet(f"{home}/_staged-{made}")
        move_new(spark, f"{home}/_staged-{made}", f"{home}/set={made}")

    new = live.join(kept().select("path").distinct(), "path", "left_anti").select("path", "partition", RANDOM_KEY, "seq", "kind")
    # moved rows: the folders of the same entry and partition that went, if all their values are known
    went = events.where((F.col("op") == ledger.DELETE) & (F.col("kind") == ledger.MOVED)).select(
        "seq", "partition", F.col("path").alias("source")
    )
    known = kept().select(F.col("path").alias("source")).distinct().withColumn("known", F.lit(True))
    sources = new.where(F.col("kind") == ledger.MOVED).join(went, ["seq", "partition"]).join(known, "source", "left")
    complete = sources.groupBy("path").agg(F.bool_and(F.coalesce("known", F.lit(False))).alias("all")).where("all").select("path")
    moved = sources.join(complete, "path", "left_semi").select("path", "source")
    inherited = moved.join(kept().withColumnRenamed("path", "source"), "source").select("path", "present", "value").distinct()
    if not new.isEmpty():
        keep(inherited)
        unread = new.join(kept().select("path").distinct(), "path", "left_anti")
        if not unread.isEmpty():
            keys = [*time_keys(rule), RANDOM_KEY]
            parts = F.split("partition", "/")
            places = unread.select("path", RANDOM_KEY, *[F.get(parts, F.lit(i)).alias(k) for i, k in enumerate(time_keys(rule))])
            values = table.select(*keys, F.col(name).alias("value")).join(places, keys)
            read = values.select("path", F.lit(True).alias("present"), "value").distinct()
            # a folder without rows is known as well
            keep(read.unionByName(unread.select("path", F.lit(False).alias("present"), F.lit(None).cast(kind).alias("value"))))
    sets = child_folders(spark, f"{home}/set=*")
    if len(sets) > _FOLD:
        keep(kept().join(live.select("path"), "path", "left_semi").distinct())
        for folder in sets:
            delete_path(spark, folder)
    return kept().where("present").join(live.select("path"), "path", "left_semi").select(F.col("value").alias(column)).distinct()

