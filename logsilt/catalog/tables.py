"""Catalog tables over the landed folders: create, add and drop partitions, drop, list."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logsilt.catalog import ledger
from logsilt.catalog.ledger import ADD, CATALOGUED, DELETE, commit, ledger_events, newest_events, record, spec_column
from logsilt.layout import RANDOM_KEY, TIME_KEYS, Store, Subject, partition_keys, quoted
from logsilt.session import delete_path, path_exists

# Partitions named in one ALTER TABLE statement.
_PER_STATEMENT = 200
# In place of a path, for a partition of which only the catalog knows where it lies.
_ADOPTED = "adopted:"
# One thread at a time makes or changes a table of the catalog.
_TABLE_LOCKS: defaultdict[str, threading.RLock] = defaultdict(threading.RLock)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(values: Iterable[tuple[str, str]]) -> str:
    return "PARTITION (" + ", ".join(f"{k}={_literal(v)}" for k, v in values) + ")"


def _batches(items: Iterable) -> Iterator[list]:
    source = iter(items)
    while batch := list(islice(source, _PER_STATEMENT)):
        yield batch


def table_exists(spark: SparkSession, store: Store, subject: Subject) -> bool:
    return spark.catalog.tableExists(store.table_name(subject))


def create_external_table(
    spark: SparkSession, store: Store, subject: Subject, schema: StructType, rule: str | None
) -> None:
    """Create the subject's external Parquet table, keyed by the partition rule.

    ``schema`` holds the stored columns only, keys excluded. A table that exists gets the columns it
    lacks; one that has a column of that name in another type is an error, as its files could not be
    read together.
    """
    with _TABLE_LOCKS[store.table_name(subject)]:
        if table_exists(spark, store, subject):
            _extend(spark, store.table_name(subject), schema)
        else:
            _create(spark, store, subject, schema, rule)


def _create(spark: SparkSession, store: Store, subject: Subject, schema: StructType, rule: str | None) -> None:
    keys = partition_keys(rule)
    database = quoted(store.database(subject))
    home = f"{store.root.rstrip('/')}/_catalog/{subject.db}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION {_literal(home)}")
    columns = [schema.toDDL(), *[f"{k} STRING" for k in keys]]
    partitioned = f" PARTITIONED BY ({', '.join(keys)})" if keys else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {store.table_name(subject)} ({', '.join(columns)})"
        f" USING parquet{partitioned} LOCATION {_literal(store.table_root(subject))}"
    )


def _extend(spark: SparkSession, table: str, schema: StructType) -> None:
    have = {f.name.lower(): f.dataType for f in spark.table(table).schema.fields}
    other = [
        f"{f.name}: {have[f.name.lower()].simpleString()} stored, {f.dataType.simpleString()} given"
        for f in schema.fields
        if have.get(f.name.lower(), f.dataType).simpleString() != f.dataType.simpleString()
    ]
    if other:
        raise ValueError(f"{table} has other column types ({'; '.join(other)})")
    missing = StructType([f for f in schema.fields if f.name.lower() not in have])
    if missing.fields:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({missing.toDDL()})")


def drop_table(spark: SparkSession, store: Store, subject: Subject, data: bool = True) -> None:
    """Drop the table and forget its ledger, and with ``data`` delete its folders too."""
    ledger.forget(spark, store, subject)
    spark.sql(f"DROP TABLE IF EXISTS {store.table_name(subject)}")
    if data:
        delete_path(spark, store.table_root(subject))


def add_partitions(
    spark: SparkSession,
    store: Store,
    subject: Subject,
    folders: Iterable[tuple[str, str, str]],
) -> None:
    """Register folders given as ``(partition, folder id, path)``, many per statement.

    The ledger notes them as folders that only the catalog has: they are read, and never rewritten.
    """
    for batch in _batches(folders):
        rows = [(*folder, ADD, CATALOGUED) for folder in batch]
        entry = record(store, subject, spark.createDataFrame(rows, f"{_FOLDER}, op string, kind string"))
        _add_to_catalog(spark, store, subject, batch)
        ledger.mark_synced(spark, entry)


_FOLDER = f"partition string, {RANDOM_KEY} string, path string"


def _add_to_catalog(
    spark: SparkSession, store: Store, subject: Subject, folders: Iterable[tuple[str, str, str]]
) -> None:
    table = store.table_name(subject)
    for batch in _batches(folders):
        clauses = [
            f"{_spec([*zip(TIME_KEYS, partition.split('/')), (RANDOM_KEY, folder_id)])}"
            f" LOCATION {_literal(path)}"
            for partition, folder_id, path in batch
        ]
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(clauses)}")


def adopt_partitions(spark: SparkSession, store: Store, subject: Subject) -> None:
    """Note partitions that others have registered in the catalog, so that the ledger knows all there is.
    Their data stays where it is, also when they are dropped."""
    known = ledger.live_folders(ledger_events(spark, store, subject)).select(spec_column().alias("spec"))
    bare = F.regexp_replace("spec", f"/{RANDOM_KEY}=.*$", "")
    found = partitions(spark, store, subject).join(known, "spec", "left_anti").select(
        F.regexp_replace(bare, "[a-z]+=", "").alias("partition"),
        F.split_part("spec", F.lit(f"{RANDOM_KEY}="), F.lit(2)).alias(RANDOM_KEY),
        F.concat(F.lit(_ADOPTED), "spec").alias("path"), F.lit(ADD).alias("op"), F.lit(CATALOGUED).alias("kind"),
    )
    if not found.isEmpty():
        ledger.mark_synced(spark, record(store, subject, found))


def add_partition(
    spark: SparkSession, store: Store, subject: Subject, partition: str, path: str
) -> None:
    """Register one folder; its id is the last component of the path."""
    add_partitions(spark, store, subject, [(partition, path.rstrip("/").split("/")[-1], path)])


def drop_partitions(
    spark: SparkSession, store: Store, subject: Subject, specs: Iterable[str]
) -> None:
    """Unregister partitions by full name, ``year=2024/month=01/randompath=x``."""
    table = store.table_name(subject)
    for batch in _batches(specs):
        clauses = [
            _spec([tuple(part.split("=", 1)) for part in spec.split("/")]) for spec in batch
        ]
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(clauses)}")


def drop_partition(
    spark: SparkSession,
    store: Store,
    subject: Subject,
    spec: str,
    path: str | None = None,
    data: bool = True,
) -> None:
    """Remove a partition from ledger and catalog, and with ``data`` delete its folders.

    A prefix such as ``year=2024/month=01`` removes everything below it; with
    ``.../randompath=<id>`` one folder goes. The ledger comes first, so that no later run brings the
    partition back. ``path`` is a folder to delete that the ledger may not know.
    """
    values = dict(part.split("=", 1) for part in spec.strip("/").split("/"))
    folder_id = values.pop(RANDOM_KEY, None)
    action_time = "/".join(values.values())
    partition = F.col("partition")
    while True:
        number = ledger.latest_number(spark, store, subject)
        live = ledger.live_folders(
            ledger_events(spark, store, subject).where(
                (partition == action_time) | partition.startswith(f"{action_time}/")
            )
        )
        if folder_id is not None:
            live = live.where(F.col(RANDOM_KEY) == folder_id)
        removed = live.select("partition", RANDOM_KEY, "path", F.lit(DELETE).alias("op"))
        # what came meanwhile may belong to the partition as well
        done = commit(store, subject, removed, number, alone=True)
        if done.conflicts is None:
            entry = done.entry
            break
    shown = partitions(spark, store, subject, spec)
    drop_partitions(spark, store, subject, (r.spec for r in shown.toLocalIterator()))
    if entry:
        ledger.mark_synced(spark, entry)
        if data and not store.keep_versions:
            gone = spark.read.parquet(entry).where(~F.startswith("path", F.lit(_ADOPTED)))
            for row in gone.select("path").toLocalIterator():
                delete_path(spark, row.path)
    if path:
        delete_path(spark, path)


def vacuum(spark: SparkSession, store: Store, subject: Subject) -> int:
    """Delete folders under the table's root that went more than ``store.keep_versions`` entries ago, and
    say how many. What is read as of an entry since then stays."""
    number = ledger.latest_number(spark, store, subject)
    spans = ledger.validity(ledger_events(spark, store, subject))
    live = spans.where("removed IS NULL").select("path")
    old = spans.where((F.col("removed") <= number - store.keep_versions) & F.startswith("path", F.lit(f"{store.table_root(subject)}/")))
    gone = old.join(live, "path", "left_anti").select("path").distinct()
    return sum(delete_path(spark, row.path) for row in gone.repartition(1).toLocalIterator())


def partitions(
    spark: SparkSession, store: Store, subject: Subject, spec: str | None = None
) -> DataFrame:
    """Registered partitions, one row each, as column ``spec``; of one (partial) spec only, if given."""
    show = f"SHOW PARTITIONS {store.table_name(subject)}"
    if spec:
        show += " " + _spec([tuple(part.split("=", 1)) for part in spec.strip("/").split("/")])
    return spark.sql(show).select(F.col("partition").alias("spec"))


def existing_action_times(spark: SparkSession, store: Store, subject: Subject) -> DataFrame:
    """Action times that have a registered folder, to semi-join with: from the ledger's live view, a table
    like any other, so no list of partitions passes through the driver."""
    live = ledger.live_folders(ledger_events(spark, store, subject))
    return live.where(F.col("partition") > "").select(F.col("partition").alias("action_time")).distinct()


def partition_exists(
    spark: SparkSession, store: Store, subject: Subject, action_time: str
) -> bool:
    """Whether a partition has a registered folder; asks for that partition only."""
    spec = "/".join(f"{k}={v}" for k, v in zip(TIME_KEYS, action_time.split("/")))
    return not partitions(spark, store, subject, spec).isEmpty()


def sync_with_ledger(spark: SparkSession, store: Store, subject: Subject) -> None:
    """Bring what the ledger has recorded since the last time to the catalog.

    Only the folders named in ledger entries without a mark are looked at, each by its newest event,
    and go to the catalog a batch at a time. Safe to repeat, so it also repairs a run that stopped
    between its ledger entry and its catalog calls. If another writer's entry comes in meanwhile, its
    calls may have been before ours, so the same folders are looked at again. File listings the session
    may have cached are dropped.
    """
    with _TABLE_LOCKS[store.table_name(subject)]:
        spark.catalog.refreshTable(store.table_name(subject))
        pending = set(ledger.unsynced(spark, store, subject))
        while pending:
            number = ledger.latest_number(spark, store, subject)
            events = ledger_events(spark, store, subject)
            known = fresh = events.where(F.col("batch").isin([p.rsplit("=", 1)[1] for p in pending]))
            if {ledger.number_of(p) for p in pending} != {number}:
                # of the newest entry all events are the newest ones of their folders
                known = newest_events(events.join(fresh.select("path").distinct(), "path", "left_semi"))
            # one task: a local iterator runs a job per task, and this is a few rows of metadata
            changes = known.select("op", "partition", RANDOM_KEY, "path", spec_column().alias("spec")).repartition(1).collect()
            added = [r for r in changes if r.op == ADD and not r.path.startswith(_ADOPTED)]
            _add_to_catalog(spark, store, subject, ((r.partition, r[RANDOM_KEY], r.path) for r in added))
            drop_partitions(spark, store, subject, (r.spec for r in changes if r.op == DELETE))
            for batch in pending:
                if path_exists(spark, batch):
                    ledger.mark_synced(spark, batch)
            if ledger.latest_number(spark, store, subject) == number:
                break
            pending |= set(ledger.unsynced(spark, store, subject))


def _folder_event(
    spark: SparkSession, partition: str, folder_id: str, path: str, op: str
) -> DataFrame:
    columns = f"partition string, {RANDOM_KEY} string, path string, op string"
    return spark.createDataFrame([(partition, folder_id, path, op)], columns)


def register_folder(
    spark: SparkSession, store: Store, subject: Subject, partition: str, path: str
) -> None:
    """Enter a folder that is there already in ledger and catalog; its id is its own name."""
    folder_id = path.rstrip("/").split("/")[-1]
    entry = record(store, subject, _folder_event(spark, partition, folder_id, path, ADD))
    _add_to_catalog(spark, store, subject, [(partition, folder_id, path)])
    ledger.mark_synced(spark, entry)


def unregister_folder(
    spark: SparkSession, store: Store, subject: Subject, partition: str, path: str
) -> None:
    """Take a folder out of ledger and catalog, and delete its data.

    Its id is the one the ledger has for the path, or else its own name.
    """
    known = ledger_events(spark, store, subject).where(F.col("path") == path)
    row = ledger.live_folders(known).first()
    folder_id = row[RANDOM_KEY] if row else path.rstrip("/").split("/")[-1]
    entry = record(store, subject, _folder_event(spark, partition, folder_id, path, DELETE))
    values = [*zip(TIME_KEYS, partition.split("/")), (RANDOM_KEY, folder_id)]
    drop_partitions(spark, store, subject, ["/".join(f"{k}={v}" for k, v in values)])
    ledger.mark_synced(spark, entry)
    delete_path(spark, path)
