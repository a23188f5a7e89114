"""Reading a table as of a ledger entry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsilt.catalog import ledger
from logsilt.layout import RANDOM_KEY, Store, Subject, time_keys


def read_as_of(
    spark: SparkSession, store: Store, subject: Subject, rule: str, number: int | None = None
) -> DataFrame:
    """The rows of exactly the folders that were live right after an entry (default: the newest one).

    Whatever lands, is compacted or dropped afterwards, the rows stay the same, as long as the folders
    are kept (``store.keep_versions``); an entry whose folders may be deleted is an error. Folders are
    found by their names and semi-joined with the ledger's view, which Spark turns into a filter on the
    folders it lists; those that lie elsewhere are read through the catalog while it has them.
    """
    latest = ledger.latest_number(spark, store, subject)
    number = latest if number is None else number
    if not 0 < number <= latest:
        raise ValueError(f"{subject} has entries 1 to {latest}, not {number}")
    events = ledger.ledger_events(spark, store, subject)
    live = ledger.as_of(events, number)
    lost = live.where(F.col("removed") <= latest - store.keep_versions)
    if number < latest - store.keep_versions or not lost.isEmpty():
        raise ValueError(f"folders of entry {number} may be deleted; entries from {latest - store.keep_versions} on can be read")

    keys, root = time_keys(rule), store.table_root(subject)
    table = spark.table(store.table_name(subject))
    parts = F.split("partition", "/")
    named = live.select(*[F.get(parts, F.lit(i)).alias(k) for i, k in enumerate(keys)], RANDOM_KEY, "path")
    tail = F.concat_ws("/", F.concat(F.lit(f"{RANDOM_KEY}="), RANDOM_KEY), *[F.concat(F.lit(f"{k}="), k) for k in keys])
    own = named.where(F.endswith("path", F.concat(F.lit(f"{root}/"), tail)))
    other = named.where(~F.endswith("path", F.concat(F.lit(f"{root}/"), tail)))
    columns = [*keys, RANDOM_KEY]
    frames = []
    if not own.isEmpty():
        files = spark.read.schema(table.schema).option("basePath", root).parquet(f"{root}/{RANDOM_KEY}=*")
        frames.append(files.join(own.select(*columns), columns, "left_semi").select(*table.columns))
    if not other.isEmpty():
        frames.append(table.join(other.select(*columns), columns, "left_semi").select(*table.columns))
    return frames[0].unionByName(frames[1]) if len(frames) == 2 else (frames or [table.limit(0)])[0]
