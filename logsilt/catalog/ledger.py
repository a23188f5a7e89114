"""The partition ledger: which folders make up each partition of each subject.

The ledger of a subject is a row of numbered entries, each a small Parquet folder of add and delete
events, so a change of several folders (a compaction) becomes visible as a whole. An entry gets its
number in one step that only one writer can take. A writer names the number it has read up to and the
partitions its work depends on; if an entry since then has changed one of them, it does not get in and
is told which, so that it can redo these alone (``commit``).

The live view is the newest event per folder, and the view as of an older number the newest one up to
that (``as_of``). From time to time entries are folded into one, a checkpoint of the view, so that reading
it costs no more after many runs. The catalog is brought in line with the ledger afterwards and can be
again at any time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from logsilt.layout import RANDOM_KEY, TIME_KEYS, Store, Subject
from logsilt.operators.dedup import dedup_latest
from logsilt.session import child_folders, delete_path, move_new, path_exists, touch

ADD, DELETE = "add", "delete"
# Input files of a run are landed; the path is the run's manifest.
TAKEN = "taken"
# Kinds of events: rows that came or went, the same rows in other folders, a folder the catalog only has.
CHANGED, MOVED, CATALOGUED = "changed", "moved", "catalogued"
# An empty file beside a ledger file, there once the catalog has its changes.
_SYNCED = "_synced"
# Entries that are folded into one when there are more.
_ROLL_UP = 16

LEDGER_SCHEMA = StructType(
    [
        StructField("partition", StringType()),
        StructField(RANDOM_KEY, StringType()),
        StructField("path", StringType()),
        StructField("op", StringType()),
        StructField("kind", StringType()),
        StructField("bytes", LongType()),
        StructField("seq", LongType()),
        StructField("subject", StringType()),
        StructField("batch", StringType()),
    ]
)

_EVENT_COLUMNS = ("partition", RANDOM_KEY, "path", "op", "kind", "bytes", "seq")


@dataclass(frozen=True)
class Committed:
    """The entry a commit has made. If ``entry`` is None there is none: without ``conflicts`` because there
    were no events, else because entries up to ``number`` have changed these partitions (``partition``)."""

    number: int
    entry: str | None
    conflicts: DataFrame | None = None


def _folder(store: Store, subject: Subject) -> str:
    return f"{store.ledger_root()}/subject={subject}"


def number_of(batch: str) -> int:
    """The number of an entry's folder."""
    return int(batch.rsplit("=", 1)[1].split(".")[0])


def batches(spark: SparkSession, store: Store, subject: Subject) -> list[str]:
    """Folders of a subject's ledger entries, by listing."""
    return child_folders(spark, f"{_folder(store, subject)}/batch=*")


def latest_number(spark: SparkSession, store: Store, subject: Subject) -> int:
    """The number of the newest entry; 0 when there is none."""
    return max(map(number_of, batches(spark, store, subject)), default=0)


def record(store: Store, subject: Subject, events: DataFrame) -> str | None:
    """Append events (``partition, randompath, path, op``) of one subject, whatever else has changed; the
    entry, or None if there are none."""
    return commit(store, subject, events).entry


def commit(
    store: Store,
    subject: Subject,
    events: DataFrame,
    base: int | None = None,
    touched: DataFrame | None = None,
    needed: DataFrame | None = None,
    alone: bool = False,
    check: Callable[[DataFrame], None] | None = None,
) -> Committed:
    """Append events as the next entry, unless what they depend on has changed since entry ``base``.

    ``touched`` names partitions whose rows must not have changed; entries that only moved rows to other
    folders (a compaction) do not count. ``needed`` names folders (``partition, path``) that must still
    be live. With ``alone`` there must be no later entry at all. ``check`` is called with the events since
    ``base``, and may raise an error. Events may have columns ``kind`` (without it they are changes) and
    ``bytes`` (of the folder).
    """
    spark = events.sparkSession
    home = _folder(store, subject)
    optional = {"kind": F.lit(CHANGED), "bytes": F.lit(None).cast("long")}
    staged = f"{home}/_staged-{uuid.uuid4().hex}"
    # the number an entry gets is its events' sequence number
    rows = events.withColumns({c: v for c, v in optional.items() if c not in events.columns} | {"seq": F.lit(None).cast("long")})
    seen = Observation()
    rows.select(*_EVENT_COLUMNS).repartition(1).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(staged)
    try:
        if not seen.get["n"]:
            return Committed(0, None)
        while True:
            number = latest_number(spark, store, subject)
            if base is not None and number > base:
                if alone:
                    return Committed(number, None, spark.createDataFrame([], "partition string"))
                known = ledger_events(spark, store, subject)
                if check:
                    check(known.where(F.col("seq") > base))
                conflicts = _conflicts(known, base, touched, needed)
                if conflicts:
                    return Committed(number, None, spark.createDataFrame(conflicts, "partition string"))
                base = number
            entry = f"{home}/batch={number + 1:020d}"
            if not move_new(spark, staged, entry):
                continue
            if _folded_past(spark, store, subject, number + 1):
                # the number was taken, used and folded while we slept: step back and take a newer one
                move_new(spark, entry, staged)
                continue
            return Committed(number + 1, entry)
    finally:
        delete_path(spark, staged)


def _conflicts(events: DataFrame, base: int, touched: DataFrame | None, needed: DataFrame | None) -> list:
    """Partitions, of those that a writer depends on, that have changed since: some rows of metadata."""
    found = []
    if touched is not None:
        since = events.where((F.col("seq") > base) & (F.col("kind") == CHANGED)).select("partition").distinct()
        found += touched.select("partition").join(since, "partition", "left_semi").collect()
    if needed is not None:
        gone = needed.join(live_folders(events).select("path"), "path", "left_anti")
        found += gone.select("partition").distinct().collect()
    return [(row.partition,) for row in found]


def _folded_past(spark: SparkSession, store: Store, subject: Subject, number: int) -> bool:
    return any(_is_fold(b) and number_of(b) >= number for b in batches(spark, store, subject))


def unsynced(spark: SparkSession, store: Store, subject: Subject) -> list[str]:
    """Ledger entries whose changes have not reached the catalog: one after a stopped run, else none."""
    done = {p.rsplit("/", 1)[0] for p in child_folders(spark, f"{_folder(store, subject)}/batch=*/{_SYNCED}", True)}
    return [p for p in batches(spark, store, subject) if p not in done]


def mark_synced(spark: SparkSession, batch: str) -> None:
    touch(spark, f"{batch}/{_SYNCED}")


def forget(spark: SparkSession, store: Store, subject: Subject) -> None:
    """Remove all that the ledger holds about a subject."""
    delete_path(spark, _folder(store, subject))


def newest_events(events: DataFrame) -> DataFrame:
    """The newest event of every folder."""
    return dedup_latest(events, ["subject", "path"], ["seq", "op"])


def roll_up(spark: SparkSession, store: Store, subject: Subject) -> None:
    """Fold all entries of a subject into one and delete them. A reader that has just listed the old
    entries has to list again; ``trim`` spares it that."""
    old = batches(spark, store, subject)
    if len(old) > 1:
        _fold(spark, store, subject, old)
        for batch in old:
            delete_path(spark, batch)


def trim(spark: SparkSession, store: Store, subject: Subject) -> None:
    """Fold the entries once there are many since the last fold, so that no run reads more than some.

    What the fold before this one covers is deleted; the entries folded now stay until the next time,
    for readers that have just listed them. A writer that finds another one folding leaves it to that.
    """
    old = batches(spark, store, subject)
    last = max((number_of(b) for b in old if _is_fold(b)), default=0)
    if sum(number_of(b) > last for b in old) <= _ROLL_UP:
        return
    try:
        _fold(spark, store, subject, old)
    except (PySparkException, Py4JJavaError):
        if set(old) <= set(batches(spark, store, subject)):
            raise
        return  # entries went while they were read: they are folded already
    for batch in old:
        if number_of(batch) < last or (number_of(batch) == last and not _is_fold(batch)):
            delete_path(spark, batch)


def _is_fold(batch: str) -> bool:
    return "." in batch.rsplit("=", 1)[1]


def _fold(spark: SparkSession, store: Store, subject: Subject, old: list[str]) -> None:
    """One entry that says what these say: the newest event of every folder, and both events of folders
    that went within the last ``store.keep_versions`` numbers.

    A delete is kept as long as some entry still holds the add it undoes: such an entry may outlive a
    stopped run and must not bring the folder back.
    """
    pending = unsynced(spark, store, subject)
    number = max(map(number_of, old))
    events = ledger_events(spark, store, subject).where(F.col("batch").isin([b.rsplit("=", 1)[1] for b in old]))
    newest = newest_events(events)
    added = events.where(F.col("op") == ADD).select(*newest.columns).distinct()
    gone = newest.where(F.col("op") == DELETE).join(added.select("path").distinct(), "path", "left_semi").select(*newest.columns)
    late = gone.where(F.col("seq") > number - store.keep_versions).select("path")
    kept = newest.where(F.col("op").isin(ADD, TAKEN)).unionByName(gone).unionByName(added.join(late, "path", "left_semi").select(*newest.columns))
    # not one file: it repeats what the old entries say
    name = uuid.uuid4().hex
    staged = f"{_folder(store, subject)}/_staged-{name}"
    kept.select(*_EVENT_COLUMNS).write.parquet(staged)
    if not pending:
        mark_synced(spark, staged)
    move_new(spark, staged, f"{_folder(store, subject)}/batch={number:020d}.{name}")


def ledger_events(spark: SparkSession, store: Store, subject: Subject | None = None) -> DataFrame:
    """All events, ``seq`` being the number of the entry they came with."""
    root = store.ledger_root()
    path = root if subject is None else f"{root}/subject={subject}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    found = spark.read.schema(LEDGER_SCHEMA).option("basePath", root).parquet(path)
    return found.withColumn("seq", F.coalesce("seq", F.split_part("batch", F.lit("."), F.lit(1)).cast("long")))


def validity(events: DataFrame) -> DataFrame:
    """From which number on each folder was live, and up to which one it was not any more (or NULL):
    ``subject, partition, randompath, path, kind, bytes, added, removed``."""
    steps = Window.partitionBy("subject", "path").orderBy("seq", "op")
    turns = events.withColumn("was", F.lag("op").over(steps)).where(F.coalesce(F.col("was") != F.col("op"), F.col("op") == ADD))
    spans = turns.withColumn("removed", F.lead("seq").over(steps)).where(F.col("op") == ADD)
    return spans.select("subject", "partition", RANDOM_KEY, "path", "kind", "bytes", F.col("seq").alias("added"), "removed")


def as_of(events: DataFrame, number: int) -> DataFrame:
    """Folders that were live right after entry ``number``."""
    return validity(events).where((F.col("added") <= number) & F.coalesce(F.col("removed") > number, F.lit(True)))


def live_folders(events: DataFrame) -> DataFrame:
    """Folders whose newest event is an add."""
    return newest_events(events).where(F.col("op") == ADD)


def own_folders(folders: DataFrame) -> DataFrame:
    """Without folders that only the catalog has, which are read but never rewritten."""
    return folders.where(F.col("kind") != CATALOGUED) if "kind" in folders.columns else folders


def partition_folders(events: DataFrame, partition: str) -> DataFrame:
    """Live folders of one partition."""
    return live_folders(events.where(F.col("partition") == partition))


def due_for_compaction(events: DataFrame, min_folders: int = 2) -> DataFrame:
    """Partitions that have at least ``min_folders`` live folders, with their number."""
    counted = own_folders(live_folders(events)).groupBy("subject", "partition").agg(F.count("*").alias("folders"))
    return counted.where(F.col("folders") >= min_folders)


def spec_column(partition: str = "partition", random_key: str = RANDOM_KEY) -> Column:
    """``2024/01`` and a folder id to the catalog's ``year=2024/month=01/randompath=<id>``."""
    parts = F.split(F.col(partition), "/")
    named = [F.concat(F.lit(f"{key}="), F.get(parts, i)) for i, key in enumerate(TIME_KEYS)]
    return F.concat_ws("/", *named, F.concat(F.lit(f"{RANDOM_KEY}="), F.col(random_key)))


def written_events(
    spark: SparkSession, folder: str, folder_id: str, keys: list[str]
) -> DataFrame:
    """Add events for every partition found in a written folder, with its bytes, by listing files alone.

    Files become rows where they are listed; only names and sizes are read, never their bytes.
    """
    named = "".join(f"/{k}=[^/]+" for k in keys)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
    inside = F.regexp_extract("path", f"({named})/[^/]+$", 1)
    found = files.select(inside.alias("inside"), "length").groupBy("inside").agg(F.sum("length").alias("bytes"))
    return found.select(
        F.substring(F.regexp_replace("inside", "/[^/=]+=", "/"), 2, 1 << 30).alias("partition"), F.lit(folder_id).alias(RANDOM_KEY),
        F.concat(F.lit(folder), "inside").alias("path"), F.lit(ADD).alias("op"), "bytes",
    )
