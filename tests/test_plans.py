"""Ingest, merge, compaction, catalog and ledger, end to end on small inputs."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from logsilt import Rule, Store, Subject, plans, sources
from logsilt.catalog import ledger, registry, tables
from logsilt.plans.landing import prune_partitions, touched_partitions
from logsilt.session import path_exists, scratch_dir
from logsilt.streaming import start_online

SUBJECT = Subject("web", "log")
RULE = Rule("web.log", "m", "t", "yyyy/MM/dd", files=2, order_by=("v",))


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "m string, t string, v int")


def table(spark, store, subject=SUBJECT):
    return spark.table(store.table_name(subject))


def stored(spark, store):
    rows = table(spark, store).select("year", "month", "day", "header.logMatchValue", "v").collect()
    return sorted(
        ((f"{r.year}/{r.month}/{r.day}", r.logMatchValue, r.v) for r in rows), key=lambda r: (r[0], r[1] or "", r[2])
    )


def test_ingest_then_rerun(spark, store):
    rows = batch(spark, ("a", "2024/01/01", 1), ("a", "2024/01/01", 2), ("a", "2024/01/02", 3))
    for stage in (True, False):
        landed = plans.ingest(spark, store, RULE, rows, now=7, stage=stage)
        assert stored(spark, store) == [("2024/01/01", "a", 2), ("2024/01/02", "a", 3)]
    assert landed.rejects is None
    assert table(spark, store).columns == ["header", "m", "t", "v", "year", "month", "day", "randompath"]


def test_stored_rows_win(spark, store):
    plans.ingest(spark, store, RULE, batch(spark, ("a", "2024/01/01", 1)))
    plans.ingest(spark, store, RULE, batch(spark, ("a", "2024/01/01", 9), ("b", "2024/01/01", 2)))
    assert stored(spark, store) == [("2024/01/01", "a", 1), ("2024/01/01", "b", 2)]


def test_one_batch_or_two_give_the_same_keys(spark, store, tmp_path):
    rows = [(f"k{i % 13}", f"2024/01/0{1 + i % 3}", i) for i in range(60)]
    plans.ingest(spark, store, RULE, batch(spark, *rows))
    other = Store(str(tmp_path / "other"), db_prefix=store.db_prefix + "o")
    plans.ingest(spark, other, RULE, batch(spark, *rows[:25]))
    plans.ingest(spark, other, RULE, batch(spark, *rows[25:]))
    assert [r[:2] for r in stored(spark, store)] == [r[:2] for r in stored(spark, other)]


def test_rows_without_a_partition_are_rejected(spark, store):
    rows = batch(spark, ("a", None, 1), ("b", "2024", 2), ("c", "2024/01/01", 3), ("d", "2024/01/x y", 4))
    landed = plans.ingest(spark, store, RULE, rows)
    assert stored(spark, store) == [("2024/01/01", "c", 3)]
    rejected = spark.read.parquet(landed.rejects)
    assert sorted(r.v for r in rejected.collect()) == [1, 2, 4]
    assert "logActionTime" in rejected.columns
    only_bad = plans.ingest(spark, store, RULE, batch(spark, ("a", None, 1)))
    assert only_bad.path is None and only_bad.rejects


def test_null_match_values(spark, store):
    rows = batch(spark, (None, "2024/01/01", 1), (None, "2024/01/01", 2), ("a", "2024/01/01", 3))
    plans.ingest(spark, store, RULE, rows)
    assert len(stored(spark, store)) == 2
    plans.ingest(spark, store, RULE, rows)  # NULL equals nothing: added once per run
    assert [r[1] for r in stored(spark, store)].count(None) == 2
    plans.ingest(spark, store, RULE, rows, null_safe=True)
    assert table(spark, store).count() == 3


def test_ingest_without_order_keeps_one_row_per_key(spark, store):
    rule = Rule("web.log", "m", "t", "yyyy/MM/dd")
    rows = [(f"k{i % 5}", "2024/01/01", i) for i in range(50)]
    plans.ingest(spark, store, rule, batch(spark, *rows))
    assert [r[1] for r in stored(spark, store)] == [f"k{i}" for i in range(5)]


def touched(spark, days):
    return spark.createDataFrame([(d,) for d in days], "action_time string").where("action_time > ''")


def test_stored_keys_are_read_from_touched_partitions_only(spark, store):
    rows = [("a", f"2024/01/{d:02d}", d) for d in range(1, 10)]
    plans.ingest(spark, store, RULE, batch(spark, *rows))
    keys = ["year", "month", "day"]
    for days in (["2024/01/03"], ["2024/01/03", "2024/01/04"], [f"{y}/{m:02d}/03" for y in range(1100, 2100) for m in range(1, 13)]):
        pruned = prune_partitions(table(spark, store), keys, touched(spark, days))
        assert "dynamicpruning" in pruned._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.v for r in pruned.collect()) == sorted(d for d in range(1, 10) if f"2024/01/{d:02d}" in days)


def test_touched_partitions_and_rejects(spark, store, tmp_path):
    from logsilt.functions.action_time import fits_rule

    df = spark.createDataFrame([("2024/01/01",), ("2024/01/01",), ("2024",), (None,)], "logActionTime string")
    fits = fits_rule(F.col("logActionTime"), "yyyy/MM/dd")
    found, unfit = touched_partitions(df, fits, "logActionTime", str(tmp_path / "a"))
    assert [r.action_time for r in found.collect()] == ["2024/01/01"] and unfit
    found, unfit = touched_partitions(df.limit(2).where(fits), fits, "logActionTime", str(tmp_path / "b"))
    assert not unfit


def test_rejects_of_a_run_are_written_once(spark, store):
    rows = [("a", "2024/01/01", 1), ("z", None, 0), ("y", "2024", 5)]
    for _ in range(2):
        landed = plans.ingest(spark, store, RULE, batch(spark, *rows), run="monday")
    assert landed.rejects.endswith("/_rejects/monday") and spark.read.parquet(landed.rejects).count() == 2
    everything = spark.read.parquet(landed.rejects.rsplit("/", 1)[0] + "/*")
    assert everything.count() == 2 and table(spark, store).count() == 1


def test_no_session_setting_changes_in_an_ingest(spark, store):
    settings = lambda: sorted((r.key, r.value) for r in spark.sql("SET").collect())
    before = settings()
    plans.ingest(spark, store, RULE, batch(spark, ("a", "2024/01/01", 1)))
    assert settings() == before


def test_columns_named_as_keys(spark, store):
    rows = batch(spark, ("a", "2024/01/01", 1)).withColumn("Year", F.lit("own"))
    with pytest.raises(ValueError, match="name of a partition key"):
        plans.ingest(spark, store, RULE, rows)
    plans.ingest(spark, store, RULE, rows, taken_prefix="in_")
    assert [tuple(r) for r in table(spark, store).select("in_Year", "year").collect()] == [("own", "2024")]


def test_offline_merge_flat_layout(spark, store):
    rows = batch(spark, ("a", "2024/01/01", 1), ("a", "2024/01/01", 2)).selectExpr(
        "v", "CAST(7 AS BIGINT) AS logUpdateTime", "m AS logMatchValue", "t AS logActionTime"
    )
    for _ in range(2):
        plans.offline_merge(spark, store, RULE, rows)
    assert [tuple(r) for r in table(spark, store).select("v", "logMatchValue").collect()] == [(2, "a")]


def test_compaction_keeps_the_rows(spark, store):
    for i in range(5):
        rows = [(f"k{i}", "2024/01/01", i), (f"k{i}", "2024/01/02", i)] + [("dup", f"2024/01/0{3}", i)]
        plans.ingest(spark, store, RULE, batch(spark, *rows))
    before = stored(spark, store)
    live = ledger.live_folders(ledger.ledger_events(spark, store, SUBJECT))
    paths = [r.path for r in live.collect()]
    assert len(paths) == 11
    gone = next(p for p in paths if p.endswith("day=01"))
    missing = [r for r in before if r[0] == "2024/01/01"]
    shutil.rmtree(gone)

    assert plans.compact(spark, store, SUBJECT, RULE.partition, files=1) == 2
    after = stored(spark, store)
    assert len(after) == len(before) - 1 and set(after) < set(before)
    assert len([r for r in after if r[0] == "2024/01/01"]) == len(missing) - 1
    folders = table(spark, store).select("day", "randompath").distinct().groupBy("day").count()
    assert all(r["count"] == 1 for r in folders.collect())
    assert sum(path_exists(spark, p) for p in paths) == 1  # day 3 had one folder and was left alone
    assert tables.partitions(spark, store, SUBJECT).count() == 3
    assert plans.compact(spark, store, SUBJECT, RULE.partition, files=1) == 0
    assert plans.compact(spark, store, SUBJECT, RULE.partition, 1, ["2024/01/03"]) == 1
    assert stored(spark, store) == after


def test_compaction_does_not_deduplicate(spark, store):
    df = batch(spark, *[("same", "2024/01/01", 1)] * 6).selectExpr("m", "v", "'2024' AS year")
    tables.create_external_table(spark, store, SUBJECT, df.drop("year").schema, "yyyy")
    from logsilt.plans.landing import register

    for _ in range(2):
        path = sources.write_partition_parquet(df, store.table_root(SUBJECT), ["year"], 3)
        register(spark, store, SUBJECT, path, path.rsplit("=", 1)[1], ["year"])
    plans.compact(spark, store, SUBJECT, "yyyy", files=2)
    assert table(spark, store).count() == 12


def test_compaction_when_every_folder_is_gone(spark, store):
    for i in range(2):
        plans.ingest(spark, store, RULE, batch(spark, (f"k{i}", "2024/01/01", i)))
    for row in ledger.live_folders(ledger.ledger_events(spark, store, SUBJECT)).collect():
        shutil.rmtree(row.path)
    assert plans.compact(spark, store, SUBJECT, RULE.partition, files=1) == 1
    assert tables.partitions(spark, store, SUBJECT).count() == 0


def test_catalog_is_repaired_from_the_ledger(spark, store):
    """A run that died between its ledger entry and the catalog calls."""
    plans.ingest(spark, store, RULE, batch(spark, ("a", "2024/01/01", 1)))
    keys = ["year", "month", "day"]
    late = batch(spark, ("b", "2024/01/01", 2)).selectExpr(
        "named_struct('logUpdateTime', 7L, 'logMatchValue', m) AS header", "m", "t", "v",
        "'2024' AS year", "'01' AS month", "'01' AS day",
    )
    path = sources.write_partition_parquet(late, store.table_root(SUBJECT), keys, 1)
    ledger.record(store, SUBJECT, ledger.written_events(spark, path, path.rsplit("=", 1)[1], keys))
    assert len(stored(spark, store)) == 1
    plans.ingest(spark, store, RULE, batch(spark, ("b", "2024/01/01", 3)))
    assert stored(spark, store) == [("2024/01/01", "a", 1), ("2024/01/01", "b", 2)]


def test_a_failed_write_leaves_nothing_visible(spark, store):
    plans.ingest(spark, store, RULE, batch(spark, ("a", "2024/01/01", 1)))
    broken = Rule("web.log", "if(m = 'x', raise_error('boom'), m)", "t", "yyyy/MM/dd", files=2)
    with pytest.raises(Exception, match="boom"):
        plans.ingest(spark, store, broken, batch(spark, ("x", "2024/01/01", 1), ("c", "2024/01/01", 2)))
    assert stored(spark, store) == [("2024/01/01", "a", 1)]


def test_folders_from_elsewhere_take_part(spark, store):
    """Folders of an existing table, laid out as <partition>/<id>, are registered where they lie."""
    plans.ingest(spark, store, RULE, batch(spark, ("a", "2024/01/01", 1)))
    rows = batch(spark, ("b", "2024/01/01", 2)).selectExpr(
        "named_struct('logUpdateTime', 7L, 'logMatchValue', m) AS header", "m", "t", "v"
    )
    paths = [f"{store.table_root(SUBJECT)}/2024/01/01/{name}" for name in ("u1", "u2", "u3")]
    for path in paths:
        rows.write.parquet(path)
    tables.register_folder(spark, store, SUBJECT, "2024/01/01", paths[0])
    tables.register_folder(spark, store, SUBJECT, "2024/01/01", paths[1])
    tables.add_partition(spark, store, SUBJECT, "2024/01/01", paths[2])  # in the catalog only
    plans.ingest(spark, store, RULE, batch(spark, ("b", "2024/01/01", 9), ("c", "2024/01/01", 3)))
    assert [r[1] for r in stored(spark, store)] == ["a", "b", "b", "b", "c"]
    tables.unregister_folder(spark, store, SUBJECT, "2024/01/01", paths[0])
    assert not path_exists(spark, paths[0]) and len(stored(spark, store)) == 4
    plans.compact(spark, store, SUBJECT, RULE.partition, files=1)
    assert [r[1] for r in stored(spark, store)] == ["a", "b", "b", "c"]
    assert [path_exists(spark, p) for p in paths] == [False, False, True]


def test_time_keys_of_other_types_are_read_as_text(spark, store):
    rule = Rule("web.log", "m", "2020 + v", "yyyy", order_by=("v",))
    plans.ingest(spark, store, rule, batch(spark, ("a", "", 1), ("a", "", 2)))
    assert sorted(r.year for r in table(spark, store).select("year").collect()) == ["2021", "2022"]


def test_ledger_views(spark, store):
    assert ledger.ledger_events(spark, store).count() == 0
    events = spark.createDataFrame(
        [("2024/01", "u1", "/p/u1", "add"), ("2024/01", "u2", "/p/u2", "add"), ("2024/02", "u3", "/p/u3", "add")],
        "partition string, randompath string, path string, op string",
    )
    ledger.record(store, SUBJECT, events)
    ledger.record(store, SUBJECT, events.where("randompath = 'u2'").withColumn("op", F.lit("delete")))
    ledger.record(store, Subject("web", "other"), events)
    mine = ledger.ledger_events(spark, store, SUBJECT)
    assert sorted(r.path for r in ledger.live_folders(mine).collect()) == ["/p/u1", "/p/u3"]
    assert [r.path for r in ledger.partition_folders(mine, "2024/01").collect()] == ["/p/u1"]
    assert ledger.due_for_compaction(mine).count() == 0
    everyone = ledger.ledger_events(spark, store)
    assert [tuple(r) for r in ledger.due_for_compaction(everyone).collect()] == [("web.other", "2024/01", 2)]


def test_ledger_roll_up_keeps_the_view_and_needed_deletes(spark, store):
    events = spark.createDataFrame(
        [("2024/01", "u1", "/p/u1", "add"), ("2024/01", "u2", "/p/u2", "add")],
        "partition string, randompath string, path string, op string",
    )
    live = lambda: [r.path for r in ledger.live_folders(ledger.ledger_events(spark, store, SUBJECT)).collect()]
    first = ledger.record(store, SUBJECT, events)
    left_over = shutil.copytree(first, f"{store.root}/left_over")  # a file a stopped run did not delete
    ledger.record(store, SUBJECT, events.where("randompath = 'u2'").withColumn("op", F.lit("delete")))
    ledger.roll_up(spark, store, SUBJECT)
    folded = ledger.ledger_events(spark, store, SUBJECT)
    assert folded.select("batch").distinct().count() == 1 and folded.count() == 2 and live() == ["/p/u1"]
    shutil.copytree(left_over, first)
    assert live() == ["/p/u1"]
    ledger.roll_up(spark, store, SUBJECT)
    assert live() == ["/p/u1"] and ledger.ledger_events(spark, store, SUBJECT).count() == 2
    ledger.record(store, SUBJECT, events.where("randompath = 'u1'"))
    ledger.roll_up(spark, store, SUBJECT)  # no file adds u2 any more, so its delete goes
    assert live() == ["/p/u1"] and ledger.ledger_events(spark, store, SUBJECT).count() == 1


def agree(spark, store):
    """Ledger, catalog and storage name the same folders."""
    live = {(r.partition, r.randompath, r.path) for r in ledger.live_folders(ledger.ledger_events(spark, store, SUBJECT)).collect()}
    shown = {r.spec for r in tables.partitions(spark, store, SUBJECT).collect()}
    names = ("year", "month", "day")
    assert shown == {"/".join([*(f"{k}={v}" for k, v in zip(names, p.split("/"))), f"randompath={i}"]) for p, i, _ in live}
    assert all(path_exists(spark, path) for *_, path in live)
    assert ledger.unsynced(spark, store, SUBJECT) == []
    return len(live)


def test_a_dropped_partition_stays_away(spark, store):
    plans.ingest(spark, store, RULE, batch(spark, ("a", "2024/01/01", 1), ("b", "2024/02/01", 2), ("c", "2024/02/02", 2)))
    paths = {r.partition: r.path for r in ledger.live_folders(ledger.ledger_events(spark, store, SUBJECT)).collect()}
    tables.drop_partition(spark, store, SUBJECT, "year=2024/month=02")
    assert agree(spark, store) == 1 and [path_exists(spark, p) for _, p in sorted(paths.items())] == [True, False, False]
    plans.ingest(spark, store, RULE, batch(spark, ("d", "2024/02/01", 4)))
    assert stored(spark, store) == [("2024/01/01", "a", 1), ("2024/02/01", "d", 4)] and agree(spark, store) == 2
    folder = table(spark, store).where("v = 4").select("randompath").first()[0]
    tables.drop_partition(spark, store, SUBJECT, f"year=2024/month=02/day=01/randompath={folder}", data=False)
    tables.drop_partition(spark, store, SUBJECT, "year=1999")  # nothing there: no error
    assert agree(spark, store) == 1


def test_a_landed_folder_is_unregistered_by_its_path(spark, store):
    plans.ingest(spark, store, RULE, batch(spark, ("a", "2024/01/01", 1), ("b", "2024/01/02", 2)))
    events = ledger.live_folders(ledger.ledger_events(spark, store, SUBJECT))
    path = events.where("partition = '2024/01/01'").first().path
    tables.unregister_folder(spark, store, SUBJECT, "2024/01/01", path)
    assert agree(spark, store) == 1 and stored(spark, store) == [("2024/01/02", "b", 2)]


def test_a_dropped_table_is_forgotten(spark, store):
    plans.ingest(spark, store, RULE, batch(spark, ("a", "2024/01/01", 1)))
    tables.drop_table(spark, store, SUBJECT)
    assert ledger.ledger_events(spark, store, SUBJECT).count() == 0
    plans.ingest(spark, store, RULE, batch(spark, ("b", "2024/01/01", 2)))
    assert stored(spark, store) == [("2024/01/01", "b", 2)] and agree(spark, store) == 1


def test_table_operations(spark, store):
    schema = spark.sql("SELECT named_struct('a', 1L) AS header, 'x' AS `odd name`").schema
    tables.create_external_table(spark, store, SUBJECT, schema, "yyyy/MM/dd/HH")
    assert tables.table_exists(spark, store, SUBJECT)
    assert table(spark, store).columns == ["header", "odd name", "year", "month", "day", "hour", "randompath"]
    assert all(table(spark, store).schema[k].dataType.simpleString() == "string" for k in ("year", "hour"))
    tables.create_external_table(spark, store, SUBJECT, schema, "yyyy/MM/dd/HH")  # again: no error

    root = Path(store.table_root(SUBJECT))
    for hour in ("01", "02"):
        folder = root / "2024/01/01" / hour / "u'1"
        spark.sql("SELECT named_struct('a', 1L) AS header, 'x' AS `odd name`").write.parquet(str(folder))
        tables.add_partition(spark, store, SUBJECT, f"2024/01/01/{hour}", str(folder))
    assert table(spark, store).count() == 2
    assert tables.partition_exists(spark, store, SUBJECT, "2024/01/01/01")
    assert not tables.partition_exists(spark, store, SUBJECT, "2024/01/01/03")
    assert sources.read_partition(spark, store, SUBJECT, "2024/01/01").count() == 2
    assert sources.read_partition(spark, store, SUBJECT, "2024/01/01/02").count() == 1

    tables.drop_partition(spark, store, SUBJECT, "year=2024/month=01/day=01/hour=01", str(root / "2024/01/01/01"))
    assert table(spark, store).count() == 1 and not (root / "2024/01/01/01").exists()
    tables.drop_table(spark, store, SUBJECT)
    assert not tables.table_exists(spark, store, SUBJECT) and not root.exists()


def test_a_table_grows_with_its_batches(spark, store):
    plans.ingest(spark, store, RULE, batch(spark, ("a", "2024/01/01", 1)))
    wider = batch(spark, ("b", "2024/01/01", 2)).withColumn("more", F.lit("x"))
    plans.ingest(spark, store, RULE, wider)
    plans.ingest(spark, store, RULE, batch(spark, ("c", "2024/01/01", 3)))
    rows = table(spark, store).select("v", "more", "day").collect()
    assert sorted(tuple(r) for r in rows if r.more) == [(2, "x", "01")] and len(rows) == 3
    with pytest.raises(ValueError, match="v: int stored, string given"):
        plans.ingest(spark, store, RULE, wider.withColumn("v", F.lit("text")))


def test_unpartitioned_table(spark, store):
    tables.create_external_table(spark, store, SUBJECT, spark.range(1).schema, None)
    assert table(spark, store).columns == ["id"]


AVRO = """{"type":"record","name":"r","fields":[{"name":"m","type":["null","string"]},
 {"name":"t","type":"string"},{"name":"v","type":"int"}]}"""


def test_online_job_by_registered_rule_and_schema(spark, store, tmp_path):
    rules = spark.createDataFrame(
        [("web.log", 2, "t", "t", "yyyy", 1, "txt", None), ("web.log", 1, "m", "t", "yyyy/MM/dd", 1, "TXT", ["v"])],
        "subject string, rule_id int, match_key string, time_key string, partition string, files int, "
        "file_type string, order_by array<string>",
    )
    schemas = spark.createDataFrame([("web.log", 1, "{}"), ("web.log", 2, AVRO)], "subject string, version int, schema string")
    Path(tmp_path, "f.txt").write_text("a|2024/01/01|1\na|2024/01/01|2\n|2024/01/01|3\nshort\n")
    landed = plans.run_online(spark, store, rules, schemas, "web.log", str(tmp_path / "f.txt"))
    assert stored(spark, store) == [("2024/01/01", "", 3), ("2024/01/01", "a", 2)]
    assert spark.read.parquet(landed.rejects).count() == 1
    Path(tmp_path, "g.txt").write_text("b|2024/01/01|4\n")
    plans.run_online(spark, store, rules, schemas, "web.log", str(tmp_path / "g.txt"))
    assert plans.run_history(spark, store, rules, "web.log", "2024/01/01") == 1
    assert plans.run_history(spark, store, rules, "web.log") == 0
    assert len(stored(spark, store)) == 3
    with pytest.raises(LookupError):
        plans.run_online(spark, store, rules, schemas, "web.none", "/x")
    with pytest.raises(LookupError):
        registry.load_schema(schemas, "web.none")
    with pytest.raises(ValueError):
        plans.run_online(spark, store, rules, schemas, "nodots", "/x")


def test_json_batch_with_inferred_schema(spark, tmp_path):
    from pyspark.sql.types import StructType

    Path(tmp_path, "f.json").write_text('{"b":"7","a":1}\n{"a":2,"z":0}\n')
    target = StructType.fromDDL("a string, b int, c string")
    inferred = plans.read_batch(spark, "json", str(tmp_path), target, infer=True)
    assert [f.dataType.simpleString() for f in inferred.schema] == ["bigint", "string", "string", "string"]
    typed = plans.read_batch(spark, "json", str(tmp_path), target)
    assert [f.dataType.simpleString() for f in typed.schema] == ["string", "int", "string", "string"]


def test_stream_lands_each_file_once(spark, store, tmp_path):
    from pyspark.sql.types import StructType

    inbox, checkpoint = tmp_path / "inbox", str(tmp_path / "checkpoint")
    inbox.mkdir()
    schema = StructType.fromDDL("m string, t string, v int")

    def run():
        parsed = sources.parse_pipe(spark.readStream.text(str(inbox)), schema)
        start_online(parsed, store, RULE, checkpoint).awaitTermination()

    (inbox / "1.txt").write_text("a|2024/01/01|1\n|2024/01/01|2\n")
    run()
    (inbox / "2.txt").write_text("a|2024/01/01|5\nb|2024/01/01|6\n")
    run()
    run()
    assert stored(spark, store) == [("2024/01/01", "", 2), ("2024/01/01", "a", 1), ("2024/01/01", "b", 6)]


def test_distinct_column_report(spark, tmp_path):
    for day in ("01", "02"):
        spark.range(10).selectExpr("id % 3 AS updateTime").write.parquet(str(tmp_path / "in" / day))
    plans.distinct_column(spark, f"{tmp_path}/in/*/*.parquet", "updateTime", str(tmp_path / "out"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["0", "1", "2"]


def test_scratch_follows_the_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    made = scratch_dir(spark, "x")
    assert made != scratch_dir(spark, "x")
    assert made.startswith(f"{base}/logsilt/x-" if base else tempfile.gettempdir())


def test_damaged_input_goes_to_the_rejects_with_its_text(spark, store, tmp_path):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("m string, t string, v int")
    tolerant = Rule("web.log", "m", "coalesce(t, '2024/01/01')", "yyyy/MM/dd", 2, order_by=("v",))
    good, wrong, broken = '{"m":"a","t":"2024/01/01","v":1}', '{"m":"b","t":"2024/01/01","v":"x"}', "{bad 誠"
    td = ("from_json(value, 'm string, t string, v int').m AS m", "from_json(value, 'm string, t string, v int').t AS t",
          "from_json(value, 'm string, t string, v int').v AS v")
    cases = {
        "json": ("\n".join([good, wrong, broken]), "utf-8", [wrong, broken]),
        "json_gbk": ("\n".join([good, broken]), "gbk", [broken]),
        "txt": ("a|2024/01/01|1\nb|2024/01/01|x\nc\n", "utf-8", ["b|2024/01/01|x"]),
        "csv": ("m,t,v\na,2024/01/01,1\nb,2024/01/01,x\n", "utf-8", ['{"m":"b","t":"2024/01/01","v":"x"}']),
        "td": ("\r\n\r\n".join([good, broken]), "utf-8", [broken]),
    }
    for i, (kind, (text, encoding, bad)) in enumerate(cases.items()):
        folder = tmp_path / kind
        folder.mkdir()
        (folder / "f.txt").write_bytes(text.encode(encoding))
        place = Store(str(tmp_path / f"store{i}"), db_prefix=f"{store.db_prefix}{i}_")
        rows = plans.read_batch(spark, kind, str(folder), schema, td if kind == "td" else ())
        landed = plans.ingest(spark, place, tolerant, rows)
        kept = [r for r in stored(spark, place) if r[1] is not None]
        assert kept == [("2024/01/01", "a", 1)] + ([("2024/01/01", "c", None)] if kind == "txt" else []), kind
        assert len(stored(spark, place)) == len(kept)
        assert sorted(r._malformed for r in spark.read.parquet(landed.rejects).collect()) == sorted(bad), kind


def test_a_joined_batch_lands_quickly(spark, store):
    """Its size estimate is far off, so nothing may be sized by that."""
    import time

    sf = "/root/testdata/sf0.001"
    lines, orders, customers = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("lineitem", "orders", "customer"))
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(customers, orders.o_custkey == customers.c_custkey)
    rows = joined.selectExpr(
        "l_linenumber", "1L AS logUpdateTime", "concat_ws('-', l_partkey, l_suppkey) AS logMatchValue",
        "date_format(l_shipdate, 'yyyy') AS logActionTime",
    )
    start = time.time()
    plans.offline_merge(spark, store, Rule("web.log", "m", "t", "yyyy", files=2), rows)
    assert time.time() - start < 60
    assert table(spark, store).count() == rows.select("logMatchValue", "logActionTime").distinct().count()
