"""Landing a batch: read, expand, merge, write, register."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from logsilt.catalog import ledger, tables
from logsilt.catalog.registry import load_rule, load_schema
from logsilt.functions.action_time import fits_rule
from logsilt.layout import Rule, Store, Subject, quoted, time_keys
from logsilt.operators.shape import (
    align_schema,
    expand_flat,
    expand_header,
    with_partition_keys,
)
from logsilt.plans.intake import Manifest, new_files
from logsilt.plans.merging import merge_new_rows
from logsilt.session import delete_path, scratch_dir
from logsilt.sources.avro import read_avro
from logsilt.sources.files import read_csv_header, read_parquet_paths
from logsilt.sources.json_lines import read_gbk_json_flat, read_json_lines
from logsilt.sources.lines import read_paragraph_records, read_pipe_text
from logsilt.sources.sinks import write_id, write_partition_parquet

# The text of an input line that could not be read, in batches from ``read_batch``.
MALFORMED = "_malformed"

# File types of online batches.
FILE_TYPES = ("txt", "avro", "csv", "json", "td", "json_gbk")


@dataclass(frozen=True)
class Landed:
    """What one ingest wrote. ``rejects`` is the folder of malformed rows and of those that have no
    valid action time."""

    subject: Subject
    folder_id: str
    path: str | None
    rejects: str | None


def layout_of(file_type: str) -> str:
    return "flat" if file_type.lower() == "avro" else "header"


def read_batch(
    spark: SparkSession,
    file_type: str,
    files: str | Sequence[str],
    schema: StructType | None = None,
    record_exprs: Sequence[str] = (),
    infer: bool = False,
) -> DataFrame:
    """Read an online batch by file type.

    ``txt``, ``csv``, ``json`` and ``json_gbk`` are brought to the registered schema. JSON is parsed
    with that schema right away; ``infer=True`` infers one first and aligns without casts. ``td``
    records are parsed by the caller's ``record_exprs``.

    The column ``_malformed`` has the text of a line (CSV: of the row, as JSON) that is not JSON, or
    holds a value its type cannot take, or of which no expression makes anything; else it is NULL.
    An ingest puts such rows among the rejects.
    """
    kind = file_type.lower()
    if kind not in FILE_TYPES:
        raise ValueError(f"file type must be one of {FILE_TYPES}: {file_type!r}")
    if kind == "avro":
        return read_avro(spark, files)
    if kind == "td":
        return _parsed_records(read_paragraph_records(spark, files), record_exprs)
    if schema is None:
        raise ValueError(f"{kind} input needs a registered schema")
    if kind == "txt":
        return read_pipe_text(spark, files, schema, MALFORMED)
    if kind == "csv":
        return _aligned_rows(read_csv_header(spark, files), schema)
    if infer:
        found = read_json_lines(spark, files, options={"columnNameOfCorruptRecord": MALFORMED})
        text = F.col(MALFORMED) if MALFORMED in found.columns else F.lit(None).cast("string")
        return align_schema(found.withColumn(MALFORMED, text), _with_text(schema))
    read = read_gbk_json_flat if kind == "json_gbk" else read_json_lines
    return read(spark, files, _with_text(schema), {"columnNameOfCorruptRecord": MALFORMED})


def _with_text(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(MALFORMED, StringType())])


def _aligned_rows(rows: DataFrame, schema: StructType) -> DataFrame:
    """CSV rows in the schema's types, with rows that hold an unreadable value as text."""
    given = {f.name: f.dataType for f in schema.fields}
    unread = [
        F.col(quoted(c)).isNotNull() & F.col(quoted(c)).try_cast(given[c]).isNull()
        for c in rows.columns if c in given
    ]
    bad = reduce(Column.__or__, unread, F.lit(False))
    text = F.when(bad, F.to_json(F.struct(*[F.col(quoted(c)) for c in rows.columns])))
    return align_schema(rows.withColumn(MALFORMED, text), _with_text(schema), cast=True)


def _parsed_records(records: DataFrame, record_exprs: Sequence[str]) -> DataFrame:
    """Records by the caller's expressions; one is malformed when all that they give is NULL."""
    if not record_exprs:
        return records.withColumn(MALFORMED, F.lit(None).cast("string"))
    parsed = records.selectExpr(*record_exprs, f"value AS {MALFORMED}")
    nothing = [
        field.isNull()
        for f in parsed.schema.fields if f.name != MALFORMED
        for field in (
            [F.col(quoted(f.name))[g.name] for g in f.dataType.fields]
            if isinstance(f.dataType, StructType) else [F.col(quoted(f.name))]
        )
    ]
    empty = reduce(Column.__and__, nothing, F.lit(True))
    return parsed.withColumn(MALFORMED, F.when(empty, F.col(MALFORMED)))


def ingest(
    spark: SparkSession,
    store: Store,
    rule: Rule,
    batch: DataFrame,
    layout: str = "header",
    now: int | None = None,
    null_safe: bool = False,
    stage: bool = True,
    run: str | None = None,
    taken_prefix: str | None = None,
    manifest: Manifest | None = None,
) -> Landed:
    """Add tracking columns to a batch and land its new rows.

    ``stage`` first writes the expanded batch to the shared scratch folder as Parquet, so that raw
    input is parsed once and a time key that falls back to the current time has one value in all
    steps. Turn it off for input that is cheap to read twice and has a fixed time key.

    ``run`` names the run: rejects go to a folder of that name and replace those of an earlier
    attempt. ``taken_prefix`` renames columns that have the name of a partition key. ``manifest`` names
    the input files, which count as taken from the ledger entry on that lands their rows.
    """
    expand = {"header": expand_header, "flat": expand_flat}[layout]
    expanded = expand(batch, rule.match_key, rule.time_key, store.names, now)
    match = store.names.match_path(layout)
    if not stage:
        return _land(spark, store, rule, expanded, match, null_safe, run, taken_prefix, manifest)
    scratch = scratch_dir(spark, "stage")
    try:
        expanded.write.parquet(scratch)
        staged = spark.read.schema(expanded.schema).parquet(scratch)
        return _land(spark, store, rule, staged, match, null_safe, run, taken_prefix, manifest)
    finally:
        delete_path(spark, scratch)


def offline_merge(
    spark: SparkSession,
    store: Store,
    rule: Rule,
    batch: DataFrame,
    null_safe: bool = False,
    run: str | None = None,
) -> Landed:
    """Land a batch that has flat tracking columns already."""
    return _land(spark, store, rule, batch, store.names.match_value, null_safe, run)


def _land(
    spark: SparkSession,
    store: Store,
    rule: Rule,
    expanded: DataFrame,
    match: str,
    null_safe: bool,
    run: str | None = None,
    taken_prefix: str | None = None,
    manifest: Manifest | None = None,
) -> Landed:
    subject = Subject.parse(rule.subject)
    keys = time_keys(rule.partition)
    readable = F.col(MALFORMED).isNull() if MALFORMED in expanded.columns else F.lit(True)
    fits = readable & fits_rule(F.col(quoted(store.names.action_time)), rule.partition)
    keyed = with_partition_keys(
        expanded.where(fits).drop(MALFORMED), store.names.action_time, rule.partition, taken_prefix
    )
    body = StructType([f for f in keyed.schema.fields if f.name not in keys])
    tables.create_external_table(spark, store, subject, body, rule.partition)

    folder_id = write_id()
    scratch = scratch_dir(spark, "touched")
    try:
        touched, times, unfit = _touched(expanded, fits, store.names.action_time, scratch)
        rejects = None
        if unfit:
            rejects = f"{store.table_root(subject)}/_rejects/{run or folder_id}"
            expanded.where(~fits).write.mode("overwrite").parquet(rejects)
        if not times:
            if manifest is not None:
                ledger.record(store, subject, manifest.event(spark))
            return Landed(subject, folder_id, None, rejects)
        path = _merge_and_commit(spark, store, rule, keyed, touched, keys, match, null_safe, folder_id, scratch, manifest)
    finally:
        delete_path(spark, scratch)
    tables.sync_with_ledger(spark, store, subject)
    ledger.trim(spark, store, subject)
    return Landed(subject, folder_id, path, rejects)


def _merge_and_commit(
    spark: SparkSession, store: Store, rule: Rule, keyed: DataFrame, touched: DataFrame, keys: list[str], match: str,
    null_safe: bool, folder_id: str, scratch: str, manifest: Manifest | None,
) -> str:
    """Write the new rows and enter them in the ledger, all partitions at once; the (first) folder.

    The merge holds for the entries there were when it read the stored rows. If other writers have
    changed some of its partitions by the time it commits, these alone are merged again, against what
    is stored now, and written to a folder of their own; the others stay as they are written.
    """
    subject = Subject.parse(rule.subject)
    partitions = touched.withColumnRenamed("action_time", "partition")
    todo, rows, done, first = touched, keyed, None, None
    while True:
        base = ledger.latest_number(spark, store, subject)
        tables.sync_with_ledger(spark, store, subject)
        stored = prune_partitions(spark.table(store.table_name(subject)), keys, todo)
        fresh = merge_new_rows(rows, stored, keys, match, order_by=rule.order_by, null_safe=null_safe)
        path = write_partition_parquet(fresh, store.table_root(subject), keys, rule.files, F.col(match), folder_id)
        written = ledger.written_events(spark, path, folder_id, keys)
        first = first or path
        done = written if done is None else done.unionByName(written, allowMissingColumns=True)
        if manifest is not None and first == path:
            done = done.unionByName(manifest.event(spark), allowMissingColumns=True)
        check = None if manifest is None else manifest.check
        outcome = ledger.commit(store, subject, done, base, partitions, check=check)
        if outcome.conflicts is None:
            return first
        known = f"{scratch}-{folder_id}"
        done.write.parquet(known)
        done = spark.read.parquet(known)
        # their folders are in no entry and so in no view
        for row in done.join(outcome.conflicts, "partition", "left_semi").collect():
            delete_path(spark, row.path)
        done = done.join(outcome.conflicts, "partition", "left_anti")
        todo = outcome.conflicts.withColumnRenamed("partition", "action_time")
        rows, folder_id = prune_partitions(keyed, keys, todo), write_id()


def touched_partitions(
    expanded: DataFrame, fits: Column, action_time: str, scratch: str
) -> tuple[DataFrame, bool]:
    """The action times of rows that fit, as a small table, and whether there are rows that do not."""
    found, _, unfit = _touched(expanded, fits, action_time, scratch)
    return found, unfit


def _touched(
    expanded: DataFrame, fits: Column, action_time: str, scratch: str
) -> tuple[DataFrame, int, bool]:
    """The same with the number of action times, all from the job that writes them."""
    spark = expanded.sparkSession
    times = expanded.select(F.when(fits, F.col(quoted(action_time))).alias("action_time")).distinct()
    seen = Observation()
    counted = times.observe(seen, F.count("action_time").alias("n"), F.count_if(F.col("action_time").isNull()).alias("unfit"))
    counted.write.parquet(scratch)
    found = spark.read.schema(times.schema).parquet(scratch)
    return found.where(F.col("action_time") > ""), seen.get["n"], seen.get["unfit"] > 0


def prune_partitions(table: DataFrame, keys: Sequence[str], touched: DataFrame) -> DataFrame:
    """Keep the touched partitions only: a semi join on the bare partition keys, which Spark turns
    into a filter on the folders it lists, however many partitions there are."""
    parts = F.split("action_time", "/")
    wanted = touched.select(*[F.get(parts, F.lit(i)).alias(k) for i, k in enumerate(keys)])
    return table.join(wanted, list(keys), "left_semi")


def register(
    spark: SparkSession, store: Store, subject: Subject, path: str, folder_id: str, keys: list[str]
) -> None:
    """Enter a written folder in the ledger, then in the catalog."""
    ledger.record(store, subject, ledger.written_events(spark, path, folder_id, keys))
    tables.sync_with_ledger(spark, store, subject)
    ledger.trim(spark, store, subject)


def run_online(
    spark: SparkSession,
    store: Store,
    rules: DataFrame,
    schemas: DataFrame,
    subject: str,
    files: str | Sequence[str],
    record_exprs: Sequence[str] = (),
    now: int | None = None,
    run: str | None = None,
    once: bool = True,
) -> Landed:
    """Ingest files of a subject by its registered rule and schema, each file once (see ``ingest_files``)."""
    Subject.parse(subject)
    rule = load_rule(rules, subject)
    kind = rule.file_type.lower()
    schema = None if kind in ("avro", "td") else load_schema(schemas, subject)
    if once:
        return ingest_files(spark, store, rule, files, schema, record_exprs, now, run)
    batch = read_batch(spark, kind, files, schema, record_exprs)
    return ingest(spark, store, rule, batch, layout_of(kind), now, run=run)


def ingest_files(
    spark: SparkSession,
    store: Store,
    rule: Rule,
    files: str | Sequence[str],
    schema: StructType | None = None,
    record_exprs: Sequence[str] = (),
    now: int | None = None,
    run: str | None = None,
) -> Landed:
    """Ingest those of the files that no earlier run has taken, as the rule's file type.

    A file is known by path, length and time of change. What a run takes is written down before and
    counts from the ledger entry that lands its rows, so a run that stops takes nothing, and a repeated
    one reads nothing: rows whose match value is NULL are not added again. If another run lands some of
    the same files first, this one fails and lands nothing.
    """
    subject, kind = Subject.parse(rule.subject), rule.file_type.lower()
    manifest = new_files(spark, store, subject, files)
    paths = manifest.paths(spark)
    if not paths:
        return Landed(subject, manifest.run, None, None)
    batch = read_batch(spark, kind, paths, schema, record_exprs)
    return ingest(spark, store, rule, batch, layout_of(kind), now, run=run, manifest=manifest)


def run_offline(
    spark: SparkSession, store: Store, rules: DataFrame, subject: str, files: str | Sequence[str]
) -> Landed:
    """Merge Parquet files that carry tracking columns, by the subject's registered rule."""
    return offline_merge(spark, store, load_rule(rules, subject), read_parquet_paths(spark, files))
