"""Numbered ledger entries: writers at the same time, reads as of an entry, folds."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from logsilt import Rule, Store, Subject, plans
from logsilt.catalog import ledger, tables
from logsilt.plans import landing
from logsilt.session import path_exists

SUBJECT = Subject("web", "log")
RULE = Rule("web.log", "m", "t", "yyyy/MM/dd", files=1, order_by=("v",))
EVENT = "partition string, randompath string, path string, op string"


def batch(spark, *rows):
    return spark.createDataFrame(rows, "m string, t string, v int")


def rows_of(df):
    return sorted((f"{r.year}/{r.month}/{r.day}", r.m, r.v) for r in df.collect())


def stored(spark, store):
    return rows_of(spark.table(store.table_name(SUBJECT)))


def live(spark, store):
    return {(r.partition, r.path) for r in ledger.live_folders(ledger.ledger_events(spark, store, SUBJECT)).collect()}


def at_once(*actions):
    errors = []

    def run(action):
        try:
            action()
        except Exception as error:  # noqa: BLE001 - shown by the caller
            errors.append(error)

    threads = [threading.Thread(target=run, args=(action,)) for action in actions]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not errors, errors


@pytest.fixture
def together(monkeypatch):
    """Makes the first writes of some writers wait for each other, so that all have read the same entry."""

    def arm(writers):
        barrier, write, met = threading.Barrier(writers, timeout=60), landing.write_partition_parquet, threading.local()

        def waiting(*args, **kwargs):
            path = write(*args, **kwargs)
            if not getattr(met, "done", False):
                met.done = True
                barrier.wait()
            return path

        monkeypatch.setattr(landing, "write_partition_parquet", waiting)

    return arm


def test_two_ingests_at_once_add_no_key_twice(spark, store, together):
    plans.ingest(spark, store, RULE, batch(spark, ("a", "2024/01/01", 0)))
    together(2)
    one = [("a", "2024/01/01", 1), ("b", "2024/01/01", 1), ("c", "2024/01/02", 1), ("x", "2024/01/03", 1)]
    two = [("b", "2024/01/01", 2), ("d", "2024/01/01", 2), ("c", "2024/01/02", 2), ("y", "2024/01/04", 2)]
    at_once(*[lambda rows=rows: plans.ingest(spark, store, RULE, batch(spark, *rows)) for rows in (one, two)])
    found = stored(spark, store)
    assert [(p, m) for p, m, _ in found] == [
        ("2024/01/01", "a"), ("2024/01/01", "b"), ("2024/01/01", "d"), ("2024/01/02", "c"), ("2024/01/03", "x"), ("2024/01/04", "y"),
    ]
    # of a batch's partitions only those that clashed were written again
    events = ledger.ledger_events(spark, store, SUBJECT)
    assert [r.seq for r in events.select("seq").distinct().orderBy("seq").collect()] == [1, 2, 3]
    folders = {r.partition: r.randompath for r in events.where("seq = 3").collect()}
    alone = folders.get("2024/01/03") or folders["2024/01/04"]
    assert alone not in [folder for partition, folder in folders.items() if partition < "2024/01/03"]
    assert all(path_exists(spark, path) for _, path in live(spark, store))
    assert {r.spec.split("randompath=")[1] for r in tables.partitions(spark, store, SUBJECT).collect()} == {
        r.randompath for r in events.collect()
    }


def test_ingests_of_other_partitions_do_not_clash(spark, store, together, monkeypatch):
    together(3)
    merges = []
    merge = landing.merge_new_rows
    monkeypatch.setattr(landing, "merge_new_rows", lambda *a, **k: merges.append(1) or merge(*a, **k))
    at_once(*[lambda d=d: plans.ingest(spark, store, RULE, batch(spark, ("k", f"2024/01/0{d}", d))) for d in (1, 2, 3)])
    assert [m for _, m, _ in stored(spark, store)] == ["k"] * 3 and len(merges) == 3


def test_an_ingest_sees_a_drop_that_came_between(spark, store, monkeypatch):
    """Rows that were left out because they were stored are landed when the stored ones have gone."""
    plans.ingest(spark, store, RULE, batch(spark, ("a", "2024/01/01", 0), ("b", "2024/01/02", 0)))
    write, done = landing.write_partition_parquet, []

    def dropping(*args, **kwargs):
        path = write(*args, **kwargs)
        if not done:
            done.append(1)
            tables.drop_partition(spark, store, SUBJECT, "year=2024/month=01/day=01")
        return path

    monkeypatch.setattr(landing, "write_partition_parquet", dropping)
    plans.ingest(spark, store, RULE, batch(spark, ("a", "2024/01/01", 1), ("b", "2024/01/02", 1), ("c", "2024/01/02", 1)))
    assert stored(spark, store) == [("2024/01/01", "a", 1), ("2024/01/02", "b", 0), ("2024/01/02", "c", 1)]


def test_compaction_and_ingest_at_once(spark, tmp_path):
    import uuid

    store = Store(str(tmp_path / "s"), db_prefix=f"t{uuid.uuid4().hex[:8]}_", keep_versions=50)
    for i in range(3):
        plans.ingest(spark, store, RULE, batch(spark, (f"k{i}", "2024/01/01", i), (f"k{i}", "2024/01/02", i)))
    at_once(
        lambda: plans.compact(spark, store, SUBJECT, RULE.partition, files=1),
        lambda: plans.ingest(spark, store, RULE, batch(spark, ("k0", "2024/01/01", 9), ("new", "2024/01/01", 9))),
        lambda: plans.compact(spark, store, SUBJECT, RULE.partition, files=1),
    )
    expected = sorted([(f"2024/01/0{d}", f"k{i}", i) for i in range(3) for d in (1, 2)] + [("2024/01/01", "new", 9)])
    assert stored(spark, store) == expected
    assert rows_of(plans.read_as_of(spark, store, SUBJECT, RULE.partition)) == expected


def test_read_as_of_every_entry(spark, tmp_path):
    import uuid

    store = Store(str(tmp_path / "s"), db_prefix=f"t{uuid.uuid4().hex[:8]}_", keep_versions=4)
    seen = {}

    def note():
        seen[ledger.latest_number(spark, store, SUBJECT)] = stored(spark, store)

    plans.ingest(spark, store, RULE, batch(spark, ("a", "2024/01/01", 1), ("b", "2024/01/02", 1)))
    note()
    plans.ingest(spark, store, RULE, batch(spark, ("c", "2024/01/01", 2)))
    note()
    plans.compact(spark, store, SUBJECT, RULE.partition, files=1)
    note()
    tables.drop_partition(spark, store, SUBJECT, "year=2024/month=01/day=02")
    note()
    other = f"{store.table_root(SUBJECT)}/2024/01/01/old"
    spark.table(store.table_name(SUBJECT)).selectExpr("header", "m || '+' AS m", "t", "v").write.parquet(other)
    tables.add_partition(spark, store, SUBJECT, "2024/01/01", other)
    note()
    assert [len(seen[n]) for n in (1, 2, 3, 4, 5)] == [2, 3, 3, 2, 4]
    for fold in (lambda: None, lambda: ledger.roll_up(spark, store, SUBJECT)):
        fold()
        for number, rows in seen.items():
            assert rows_of(plans.read_as_of(spark, store, SUBJECT, RULE.partition, number)) == rows
        assert rows_of(plans.read_as_of(spark, store, SUBJECT, RULE.partition)) == seen[5]
    with pytest.raises(ValueError, match="has entries 1 to 5"):
        plans.read_as_of(spark, store, SUBJECT, RULE.partition, 6)

    assert tables.vacuum(spark, store, SUBJECT) == 0  # all removed within the last 4 entries
    closer = Store(store.root, store.db_prefix, keep_versions=1)
    assert tables.vacuum(spark, closer, SUBJECT) == 3  # the two compacted folders and the one it replaced
    assert rows_of(plans.read_as_of(spark, closer, SUBJECT, RULE.partition, 4)) == seen[4]
    with pytest.raises(ValueError, match="may be deleted"):
        plans.read_as_of(spark, closer, SUBJECT, RULE.partition, 2)


def test_validity(spark, store):
    events = spark.createDataFrame(
        [("p", "1", "/1", "add", 1), ("p", "1", "/1", "add", 2), ("p", "1", "/1", "delete", 3), ("p", "1", "/1", "delete", 4),
         ("p", "1", "/1", "add", 6), ("p", "2", "/2", "delete", 2), ("q", "3", "/3", "add", 5)],
        EVENT + ", seq long",
    ).withColumns({"subject": F.lit("s"), "kind": F.lit(ledger.CHANGED), "bytes": F.lit(1)})
    spans = {(r.path, r.added, r.removed) for r in ledger.validity(events).collect()}
    assert spans == {("/1", 1, 3), ("/1", 6, None), ("/3", 5, None)}
    alive = lambda n: sorted(r.path for r in ledger.as_of(events, n).collect())
    assert [alive(n) for n in range(8)] == [[], ["/1"], ["/1"], [], [], ["/3"], ["/1", "/3"], ["/1", "/3"]]


def test_many_entries_are_folded_and_stay_few(spark, store, monkeypatch):
    monkeypatch.setattr(ledger, "_ROLL_UP", 4)
    most = 0
    for i in range(14):
        entry = ledger.record(store, SUBJECT, spark.createDataFrame([(f"2024/01/{i:02d}", str(i), f"/p/{i}", "add")], EVENT))
        assert entry.endswith(f"batch={i + 1:020d}")
        if i % 5 == 4:
            ledger.record(store, Subject("web", "other"), spark.createDataFrame([("2024", "o", "/o", "add")], EVENT))
        ledger.trim(spark, store, SUBJECT)
        most = max(most, len(ledger.batches(spark, store, SUBJECT)))
        assert len(live(spark, store)) == i + 1
    assert most <= 12
    times = {r.action_time for r in tables.existing_action_times(spark, store, SUBJECT).collect()}
    assert times == {f"2024/01/{i:02d}" for i in range(14)}


def test_writers_take_turns_for_a_number(spark, store):
    rows = [spark.createDataFrame([("2024", str(i), f"/p/{i}", "add")], EVENT) for i in range(8)]
    at_once(*[lambda r=r: ledger.record(store, SUBJECT, r) for r in rows])
    numbers = [ledger.number_of(b) for b in ledger.batches(spark, store, SUBJECT)]
    assert sorted(numbers) == list(range(1, 9)) and len(live(spark, store)) == 8


def test_a_late_writer_does_not_take_a_folded_number(spark, store, monkeypatch):
    """It has listed entry 1, sleeps, and entry 2 is made and folded away meanwhile."""
    add = lambda i: spark.createDataFrame([("2024", str(i), f"/p/{i}", "add")], EVENT)
    ledger.record(store, SUBJECT, add(1))
    latest, calls = ledger.latest_number, []

    def sleeping(*args):
        number = latest(*args)
        if not calls:
            calls.append(1)
            ledger.record(store, SUBJECT, add(2))
            ledger.roll_up(spark, store, SUBJECT)
        return number

    monkeypatch.setattr(ledger, "latest_number", sleeping)
    entry = ledger.record(store, SUBJECT, add(3))
    assert entry.endswith(f"batch={3:020d}") and len(live(spark, store)) == 3


def test_partitions_of_others_are_adopted(spark, store):
    plans.ingest(spark, store, RULE, batch(spark, ("a", "2024/01/01", 1)))
    name = store.table_name(SUBJECT)
    spark.sql(f"ALTER TABLE {name} ADD PARTITION (year='2023', month='12', day='31', randompath='x') LOCATION '/tmp/none'")
    tables.adopt_partitions(spark, store, SUBJECT)
    tables.adopt_partitions(spark, store, SUBJECT)
    times = sorted(r.action_time for r in tables.existing_action_times(spark, store, SUBJECT).collect())
    assert times == ["2023/12/31", "2024/01/01"]
    assert ledger.due_for_compaction(ledger.ledger_events(spark, store, SUBJECT), 1).count() == 1
    tables.drop_partition(spark, store, SUBJECT, "year=2023")
    assert [r.action_time for r in tables.existing_action_times(spark, store, SUBJECT).collect()] == ["2024/01/01"]
    assert tables.partitions(spark, store, SUBJECT).count() == 1


def test_files_are_taken_once(spark, store, tmp_path):
    inbox = tmp_path / "in [1]"
    inbox.mkdir()
    pattern = str(tmp_path / "in*")
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("m string, t string, v int")
    rule = Rule("web.log", "m", "t", "yyyy/MM/dd", files=1, file_type="txt", order_by=("v",))
    land = lambda: plans.ingest_files(spark, store, rule, pattern, schema)
    (inbox / "a{1}.txt").write_text("k|2024/01/01|1\n|2024/01/01|2\n")
    (inbox / "b*.txt").write_text("||\n")
    assert land().path and land().path is None and land().path is None
    assert len(rejects := spark.read.parquet(f"{store.table_root(SUBJECT)}/_rejects/*").collect()) == 1, rejects
    (inbox / "c.txt").write_text("|2024/01/01|3\n")
    (inbox / "a{1}.txt").write_text("k|2024/01/01|1\n|2024/01/01|22\n")  # another length: another file
    ledger.roll_up(spark, store, SUBJECT)
    land()
    # NULL keys are kept one per run and partition, as ever; the key that is stored is not added again
    assert sorted(m or "" for _, m, _ in stored(spark, store)) == ["", "k"] or len(stored(spark, store)) == 2
    ledger.roll_up(spark, store, SUBJECT)
    assert land().path is None


def test_runs_that_take_the_same_file_at_once(spark, store, tmp_path, together):
    from pyspark.sql.types import StructType

    from logsilt.plans.intake import AlreadyTaken

    schema = StructType.fromDDL("m string, t string, v int")
    rule = Rule("web.log", "nullif(m, '')", "t", "yyyy/MM/dd", files=1, file_type="txt", order_by=("v",))
    (tmp_path / "f.txt").write_text("|2024/01/01|1\n")
    together(2)
    failed = []

    def land():
        try:
            plans.ingest_files(spark, store, rule, str(tmp_path / "f.txt"), schema)
        except AlreadyTaken as error:
            failed.append(error)

    at_once(land, land)
    assert len(failed) == 1 and len(stored(spark, store)) == 1


def test_large_folders_are_left_alone(spark, store):
    plans.ingest(spark, store, RULE, batch(spark, *[(f"k{i}" * 40, "2024/01/01", i) for i in range(5000)]))
    for i in range(3):
        plans.ingest(spark, store, RULE, batch(spark, (f"new{i}", "2024/01/01", i), (f"new{i}", "2024/01/02", i)))
    before = stored(spark, store)
    sizes = {r.path: r.bytes for r in ledger.live_folders(ledger.ledger_events(spark, store, SUBJECT)).collect()}
    large = max(sizes, key=sizes.get)
    assert all(sizes.values()) and sizes[large] > 10 * sorted(sizes.values())[-2]
    limit = sizes[large] - 1
    assert plans.compact(spark, store, SUBJECT, RULE.partition, 1, max_bytes=limit) == 2
    after = {r.path: r.bytes for r in ledger.live_folders(ledger.ledger_events(spark, store, SUBJECT)).collect()}
    assert large in after and len(after) == 3 and stored(spark, store) == before
    assert sum(b for p, b in after.items() if p not in sizes) <= 2 * limit
    assert plans.compact(spark, store, SUBJECT, RULE.partition, 1, max_bytes=limit) == 0
    assert plans.compact(spark, store, SUBJECT, RULE.partition, 1, ["2024/01/01"], max_bytes=sizes[large] * 2) == 1


def test_folders_are_chosen_by_running_totals(spark):
    from logsilt.plans.compaction import chosen_folders

    rows = [("s", "p", str(i), f"/p/{i}", "add", 1, b) for i, b in enumerate([50, 10, 20, None, 900, 15])]
    rows += [("s", "q", "9", "/q/9", "add", 1, 5), ("s", "r", "7", "/r/7", "add", 1, 500), ("s", "r", "8", "/r/8", "add", 1, 600)]
    events = spark.createDataFrame(rows, "subject string, partition string, randompath string, path string, op string, seq long, bytes long")
    chosen = lambda *a: sorted(r.path for r in chosen_folders(events, *a).collect())
    assert chosen(2, 100) == ["/p/0", "/p/1", "/p/2", "/p/3", "/p/5"]
    assert chosen(2, 45) == ["/p/1", "/p/2", "/p/3", "/p/5"] and chosen(5, 45) == []
    assert chosen(1, 45) == ["/p/1", "/p/2", "/p/3", "/p/5", "/q/9"]
    assert len(chosen(2)) == 8


def test_kept_distinct_values_equal_a_full_scan(spark, store, monkeypatch):
    from logsilt.plans import reports

    monkeypatch.setattr(reports, "_FOLD", 3)
    scanned, table = [], spark.table
    name = store.table_name(SUBJECT)

    def check():
        full = {r.v for r in spark.table(name).select("v").distinct().collect()}
        kept = plans.distinct_of_table(spark, store, SUBJECT, "v", RULE.partition)
        assert [r.v for r in kept.collect() if r.v is None] == [None] * (None in full)
        assert sorted(r.v for r in kept.where("v is not null").collect()) == sorted(full - {None})

    plans.ingest(spark, store, RULE, batch(spark, ("a", "2024/01/01", 1), ("b", "2024/01/02", 2), ("c", "2024/01/02", None)))
    check()
    plans.ingest(spark, store, RULE, batch(spark, ("d", "2024/01/01", 1), ("e", "2024/01/02", 5)))
    check()
    plans.compact(spark, store, SUBJECT, RULE.partition, files=1)
    monkeypatch.setattr(reports, "time_keys", lambda rule: scanned.append(rule) or ["year", "month", "day"])
    check()
    assert not scanned  # compacted folders inherit
    tables.drop_partition(spark, store, SUBJECT, "year=2024/month=01/day=02")
    check()
    for i in range(3):
        plans.ingest(spark, store, RULE, batch(spark, (f"z{i}", "2024/01/03", 10 + i)))
        check()
    assert scanned
