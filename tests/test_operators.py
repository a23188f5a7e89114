"""Shape, dedup and anti-join operators on edge rows, and the plans they give."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logsilt import TrackingNames, operators as op
from logsilt.plans import merge_new_rows


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_align_schema(spark):
    df = spark.sql("SELECT '7' AS b, 1 AS extra, 'x' AS a, 'up' AS C")
    target = StructType.fromDDL("a string, missing bigint, b int, c string")
    found = op.align_schema(df, target)
    assert found.dtypes == [("a", "string"), ("missing", "bigint"), ("b", "string"), ("c", "string")]
    assert tuples(found) == [("x", None, "7", None)]
    assert tuples(op.align_schema(df, target, cast=True)) == [("x", None, 7, None)]


def test_columns_with_dots_survive(spark):
    df = spark.sql("SELECT 1 AS `a.b`, 2 AS `c``d`")
    assert tuples(op.align_schema(df, df.schema)) == [(1, 2)]
    assert op.expand_header(df, "1", "'2024'").columns[2:] == ["a.b", "c`d"]


def test_expand_layouts(spark):
    df = spark.sql("SELECT 'k' AS a")
    flat = op.expand_flat(df, "upper(a)", "'2024/01'", now=5)
    assert flat.columns == ["a", "logUpdateTime", "logMatchValue", "logActionTime"]
    assert tuples(flat) == [("k", 5, "K", "2024/01")]
    names = TrackingNames.with_prefix("x")
    header = op.expand_header(df, "upper(a)", "'2024/01'", names, now=5)
    assert header.columns == ["header", "xActionTime", "a"]
    assert header.select("header.xUpdateTime", "header.xMatchValue").first() == (5, "K")


def test_header_of_its_own_takes_the_tracking_fields(spark):
    df = spark.sql(
        "SELECT if(i = 1, named_struct('hashcode', 'h', 'time', ''), NULL) AS header, i FROM VALUES (1), (2) t(i)"
    )
    found = op.expand_header(df, "coalesce(header.hashcode, 'none')", "'2024'", now=5)
    assert found.columns == ["header", "logActionTime", "i"]
    assert found.schema["header"].dataType.names == ["hashcode", "time", "logUpdateTime", "logMatchValue"]
    assert tuples(found.select("i", "header.hashcode", "header.logMatchValue")) == [
        (1, "h", "h"), (2, None, "none"),
    ]


def test_partition_key_names_are_taken(spark):
    with pytest.raises(ValueError, match="Year"):
        op.with_partition_keys(spark.sql("SELECT 1 AS Year, '2024' AS t"), "t", "yyyy")


def test_rows_from_map_and_array(spark):
    df = spark.sql("SELECT map('a', '1', 'b', 'x') AS m, array('1', 'x') AS v, 9 AS id")
    schema = StructType.fromDDL("a int, c string, b int")
    assert tuples(op.rows_from_map(df, "m", schema, "id")) == [(9, 1, None, None)]
    assert tuples(op.rows_from_array(df, "v", schema)) == [(1, "x", None)]


def test_dedup_treats_null_keys_as_one_group(spark):
    df = spark.sql("SELECT * FROM VALUES (NULL, 1), (NULL, 2), ('a', 3), ('a', 4) t(k, v)")
    assert op.dedup_any(df, ["k"]).count() == 2
    assert tuples(op.dedup_latest(df, ["k"], ["v"])) == [("a", 4), (None, 2)]
    assert tuples(op.dedup_latest(df, ["k"], ["v ASC"])) == [("a", 3), (None, 1)]
    assert tuples(op.dedup_latest(df, ["k"], [F.col("v").asc()])) == [("a", 3), (None, 1)]
    with pytest.raises(ValueError):
        op.dedup_latest(df, ["k"], [])


def test_dedup_keeps_whole_rows(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id AS a", "if(id % 2 = 0, NULL, id) AS b")
    assert all(r.b in (None, r.a) and (r.b is None) == (r.a % 2 == 0) for r in op.dedup_any(df, ["k"]).collect())


def test_dedup_nested_key(spark):
    df = spark.sql("SELECT named_struct('m', id % 3) AS header, id FROM range(10)")
    found = op.dedup_latest(df, ["header.m"], ["id"])
    assert found.columns == ["header", "id"]
    assert sorted(r.id for r in found.collect()) == [7, 8, 9]


def test_anti_join_keeps_null_keys_and_does_not_fan_out(spark):
    new = spark.sql("SELECT * FROM VALUES ('a', 1), ('b', 2), (NULL, 3), (NULL, 4), ('b', 5) t(k, v)")
    stored = spark.sql("SELECT * FROM VALUES ('a'), ('a'), (NULL) t(k)")
    kept = [("b", 2), ("b", 5), (None, 3), (None, 4)]
    for spread in (True, False):
        found = op.anti_join_existing(new, stored, ["k"], spread=spread)
        assert found.columns == ["k", "v"] and tuples(found) == kept
    found = op.anti_join_existing(new, stored, ["k"], null_safe=True)
    assert tuples(found) == [("b", 2), ("b", 5)]


def test_anti_join_with_other_key_types(spark):
    new = spark.sql("SELECT * FROM VALUES (1, 'x'), (2, 'y'), (NULL, 'z') t(k, v)")
    stored = spark.sql("SELECT CAST(2 AS BIGINT) AS kk")
    assert tuples(op.anti_join_existing(new, stored, ["k"], ["kk"])) == [(1, "x"), (None, "z")]


def test_anti_join_of_a_table_with_itself(spark):
    df = spark.range(10).selectExpr("id AS k", "id * 2 AS v")
    assert tuples(op.anti_join_existing(df, df.where("k < 8"), ["k", "v"])) == [(8, 16), (9, 18)]


def test_merge_scope_is_the_partition(spark):
    batch = spark.sql(
        "SELECT * FROM VALUES ('01', 'a', 1), ('02', 'a', 2), ('01', 'b', 3), ('01', 'b', 4), "
        "('01', NULL, 5), ('01', NULL, 6) t(hour, m, v)"
    )
    stored = spark.sql("SELECT * FROM VALUES ('01', 'a'), ('03', 'b'), ('01', NULL) t(hour, m)")
    found = merge_new_rows(batch, stored, ["hour"], "m", order_by=["v"])
    assert tuples(found) == [("01", "b", 4), ("01", None, 6), ("02", "a", 2)]
    found = merge_new_rows(batch, stored, ["hour"], "m", order_by=["v"], null_safe=True)
    assert tuples(found) == [("01", "b", 4), ("02", "a", 2)]
    assert tuples(merge_new_rows(batch, None, ["hour"], "m", order_by=["v ASC"])) == [
        ("01", "a", 1), ("01", "b", 3), ("01", None, 5), ("02", "a", 2),
    ]


@pytest.mark.parametrize("order_by", [(), ("v",)])
def test_merge_shuffles_each_side_once_and_combines_first(spark, tmp_path, order_by):
    spark.sql("SELECT '01' AS hour, 'a' AS m, 1 AS v, 'long' AS body").write.parquet(str(tmp_path / "b"))
    table = spark.read.parquet(str(tmp_path / "b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(merge_new_rows(table, table, ["hour"], "m", order_by=order_by))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2
    assert "LeftAnti" in text and "ReadSchema: struct<m:string,hour:string>" in text or "ReadSchema: struct<hour:string,m:string>" in text
    assert "WindowGroupLimit" in text and "Partial" in text


def test_hot_key_sends_one_row_per_map_task(spark):
    """One key holds a third of the rows; what reaches the shuffle is counted."""
    df = spark.range(0, 30_000, 1, 8).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS v")
    for found in (op.dedup_any(df, ["k"]), op.dedup_latest(df, ["k"], ["v"])):
        assert found.count() == 20_001
        text = plan(found)
        before_exchange = text[text.index("Exchange hashpartitioning"):]
        assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


def test_a_frequent_key_on_the_left_of_an_anti_join_is_split(spark, tmp_path):
    """A third of the rows has one key, another third NULL; partitions are split, not one task each."""
    spark.range(0, 60_000, 1, 6).selectExpr(
        "CASE id % 3 WHEN 0 THEN 0 WHEN 1 THEN id END AS k", "id AS v", "repeat('x', 50) || id AS body"
    ).write.parquet(str(tmp_path / "new"))
    new = spark.read.parquet(str(tmp_path / "new"))
    stored = spark.range(1, 30_000, 1, 4).selectExpr("id AS k")
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        for null_safe in (False, True):
            found = op.anti_join_existing(new, stored, ["k"], null_safe=null_safe)
            assert len(found.collect()) == 20_000 + 20_000 + 10_000
            assert "SortMergeJoin(skew=true)" in found._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" not in plan(op.anti_join_existing(new, stored, ["k"], spread=False))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_null_keys_reach_many_reducers(spark):
    new = spark.range(0, 8_000, 1, 8).selectExpr("if(id < 0, id, NULL) AS k", "id AS v")
    stored = spark.range(10).selectExpr("id AS k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = op.anti_join_existing(new, stored, ["k"])
        sizes = found.groupBy(F.spark_partition_id().alias("p")).count().collect()
        alone = op.anti_join_existing(new, stored, ["k"], spread=False)
        sizes_alone = alone.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in sizes) == 8_000 and len(sizes) > 2
    assert len(sizes_alone) == 1


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_null_keys_of_one_input_split_are_spread(spark, kind):
    new = spark.range(0, 40_000, 1, 1).selectExpr(f"CAST(if(id % 10 = 0, id, NULL) AS {kind}) AS k", "id AS v", "map('a', id) AS m")
    stored = spark.range(0, 40_000, 100).selectExpr("id AS k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = op.anti_join_existing(new, stored, ["k"])
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 40_000 - 400 and max(sizes) <= 2 * sum(sizes) / 8


def test_orderings_as_text(spark):
    df = spark.sql("SELECT * FROM VALUES (1, NULL), (1, 3), (1, 5) t(k, v)")
    first = lambda order: op.dedup_latest(df, ["k"], [order]).first().v
    assert [first(o) for o in ("v", "v desc nulls last", "v DESC NULLS FIRST", "v ASC NULLS LAST", "v asc", "-v NULLS LAST")] == [5, 5, None, 3, None, 3]
