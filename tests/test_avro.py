"""Avro schemas and files."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from logsilt import Rule, Subject, plans
from logsilt.catalog.registry import struct_from_avro
from logsilt.sources import read_avro, write_avro
from logsilt.sources.avro import AVRO, avro_value


def record(*fields):
    return json.dumps({"type": "record", "name": "r", "fields": [{"name": n, "type": t} for n, t in fields]})


@pytest.mark.parametrize(
    "avro, spark_type, nullable",
    [
        ("int", "int", False), ("long", "bigint", False), ("float", "float", False),
        ("double", "double", False), ("boolean", "boolean", False), ("string", "string", False),
        ("bytes", "binary", False), (["null", "int"], "int", True), (["string", "null"], "string", True),
        (["int", "long"], "bigint", False), (["null", "long", "int"], "bigint", True),
        (["double", "float"], "double", False), (["string"], "string", False),
        (["int", "string"], "struct<member0:int,member1:string>", False),
        (["null", "int", "string", "long"], "struct<member0:int,member1:string,member2:bigint>", True),
        ({"type": "array", "items": ["null", "int"]}, "array<int>", False),
        ({"type": "map", "values": "long"}, "map<string,bigint>", False),
        ({"type": "fixed", "name": "h", "size": 4}, "binary", False),
        ({"type": "enum", "name": "e", "symbols": ["A"]}, "string", False),
        ({"type": "record", "name": "n", "fields": [{"name": "x", "type": "int"}]}, "struct<x:int>", False),
    ],
)
def test_avro_types(spark, avro, spark_type, nullable):
    field = struct_from_avro(spark, record(("f", avro)))["f"]
    assert (field.dataType.simpleString(), field.nullable) == (spark_type, nullable)


def test_named_types_can_be_used_again(spark):
    named = {"type": "record", "name": "p", "namespace": "x.y", "fields": [{"name": "a", "type": "int"}]}
    found = struct_from_avro(spark, record(("one", named), ("two", "x.y.p"), ("three", ["null", "x.y.p"])))
    assert [f.dataType.simpleString() for f in found] == ["struct<a:int>"] * 3


def test_element_nullability(spark):
    found = struct_from_avro(spark, record(("a", {"type": "array", "items": ["null", "int"]}), ("m", {"type": "map", "values": "int"})))
    assert found["a"].dataType.containsNull and not found["m"].dataType.valueContainsNull


def test_types_agree_with_the_reader(spark, tmp_path):
    """Logical types and names of the enclosing namespace."""
    text = json.dumps({"type": "record", "name": "r", "namespace": "com.x", "fields": [
        {"name": "a", "type": {"type": "enum", "name": "E", "symbols": ["A"]}}, {"name": "b", "type": "com.x.E"},
        {"name": "t", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "d", "type": {"type": "int", "logicalType": "date"}}]})
    found = struct_from_avro(spark, text)
    assert [f.dataType.simpleString() for f in found] == ["string", "string", "timestamp", "date"]
    path = str(tmp_path / "x")
    spark.sql("SELECT 'A' AS a, 'A' AS b, TIMESTAMP'2024-01-02' AS t, DATE'2024-01-02' AS d").write.format(AVRO).option("avroSchema", text).save(path)
    assert [f.dataType for f in read_avro(spark, path).schema] == [f.dataType for f in found]


@pytest.mark.parametrize("text", ['"string"', "nonsense", record(("a", "unknown")), record(("a", {"type": {"type": "string"}}))])
def test_unsupported_schemas(spark, text):
    with pytest.raises(ValueError):
        struct_from_avro(spark, text)


def test_values_as_written(spark):
    df = spark.sql(
        "SELECT named_struct('n', CAST(NULL AS DECIMAL(3,1)), 't', TIMESTAMP'1970-01-01 00:00:02') AS s, "
        "CAST(NULL AS STRUCT<x: DECIMAL(3,1)>) AS e"
    )
    found = df.select(*[avro_value(F.col(f.name), f.dataType).alias(f.name) for f in df.schema]).first()
    assert found.s.asDict() == {"n": None, "t": 2000} and found.e is None


TYPED = """SELECT CAST(1 AS TINYINT) AS b, CAST(2 AS SMALLINT) AS s, 3 AS i, CAST(4 AS BIGINT) AS l,
    CAST(1.5 AS FLOAT) AS f, CAST(2.25 AS DOUBLE) AS d, CAST(12.340 AS DECIMAL(10,3)) AS n, true AS y,
    TIMESTAMP'2024-01-02 03:04:05.678' AS t, CAST(NULL AS STRING) AS z, array(1, NULL) AS a, X'00ff' AS x,
    map('k', CAST(1.10 AS DECIMAL(4,2))) AS m,
    named_struct('u', 'ä"x', 'v', array(TIMESTAMP'1970-01-01 00:00:01')) AS r"""


@pytest.mark.parametrize("codec, level", [("snappy", None), ("deflate", 9), ("uncompressed", None)])
def test_typed_round_trip(spark, tmp_path, codec, level):
    path = str(tmp_path / "out")
    write_avro(spark.sql(TYPED), path, codec, level, "visit", "web.log")
    head = next(Path(path).glob("*.avro")).read_bytes()[:4000]
    assert codec.replace("uncompressed", "null").encode() in head
    assert b'"name":"visit"' in head and b'"namespace":"web.log"' in head
    assert spark.conf.get("spark.sql.avro.deflate.level", "-1") == "-1"
    row = read_avro(spark, path).first().asDict(recursive=True)
    assert row == {
        "b": 1, "s": 2, "i": 3, "l": 4, "f": 1.5, "d": 2.25, "n": "12.340", "y": True,
        "t": 1704164645678, "z": None, "a": [1, None], "x": bytearray(b"\x00\xff"), "m": {"k": "1.10"},
        "r": {"u": 'ä"x', "v": [1000]},
    }


def test_callers_schema_and_other_suffixes(spark, tmp_path):
    path = str(tmp_path / "out")
    write_avro(spark.sql(TYPED), path)
    Path(path, "notes.txt").write_text("not avro")
    wanted = json.dumps({"type": "record", "name": "topLevelRecord", "fields": [
        {"name": "l", "type": "long"}, {"name": "more", "type": ["null", "string"], "default": None}]})
    assert [tuple(r) for r in read_avro(spark, path, wanted).collect()] == [(4, None)]
    with pytest.raises(Exception):
        read_avro(spark, path, skip_other_suffixes=False).count()


def test_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="codec"):
        write_avro(spark.range(1), str(tmp_path / "x"), codec="zip")
    with pytest.raises(Exception):
        write_avro(spark.sql("SELECT map(1, 2) AS m"), str(tmp_path / "y"))


def test_avro_batches_land_flat(spark, store, tmp_path):
    df = spark.sql("SELECT * FROM VALUES (1, 'a', '2024/01/01'), (2, 'a', '2024/01/01'), (3, 'b', '2024/01/02') t(id, k, p)")
    write_avro(df, str(tmp_path / "in"))
    rule = Rule("web.avro", "k", "p", "yyyy/MM/dd", 2, "avro", ("id",))
    rules = spark.createDataFrame([("web.avro", 1, "k", "p", "yyyy/MM/dd", 2, "avro", ["id"])],
        "subject string, rule_id int, match_key string, time_key string, partition string, files int, "
        "file_type string, order_by array<string>")
    for _ in range(2):
        plans.run_online(spark, store, rules, spark.createDataFrame([], "subject string"), "web.avro", str(tmp_path / "in"), now=7)
    table = spark.table(store.table_name(Subject("web", "avro")))
    assert table.columns[:6] == ["id", "k", "p", "logUpdateTime", "logMatchValue", "year"]
    assert sorted(r.id for r in table.collect()) == [2, 3]
    assert rule.file_type == "avro"


def test_levels_of_writes_at_the_same_time_do_not_mix(spark, tmp_path):
    """Each write has its own level, whatever others run, and the session's settings never change."""
    import threading

    from logsilt.session import configure

    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    key = "spark.sql.avro.deflate.level"
    seen, stop = set(), threading.Event()
    watch = threading.Thread(target=lambda: [seen.add(spark.conf.get(key, None)) for _ in iter(stop.is_set, True)])
    try:
        rows = spark.range(20_000).selectExpr("id", "repeat(md5(cast(id % 500 AS string)), 4) AS t", "timestamp_seconds(id) AS at")
        watch.start()
        writers = [
            threading.Thread(target=write_avro, args=(rows, str(tmp_path / str(level)), "deflate", level)) for level in (1, 9)
        ]
        for writer in writers:
            writer.start()
        for writer in writers:
            writer.join()
        stop.set()
        watch.join()
        size = lambda level: sum(f.stat().st_size for f in (tmp_path / str(level)).glob("*.avro"))
        assert size(9) < size(1) and len(seen) == 1
        found = read_avro(spark, str(tmp_path / "9"))
        assert found.count() == 20_000 and found.where("at = 10000000").count() == 1
    finally:
        configure(spark)
