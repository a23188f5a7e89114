"""Readers and writers on edge rows and round trips."""

from __future__ import annotations

import datetime as dt
import math
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logsilt import Store, Subject, sources

AB = StructType().add("a", "integer").add("b", "integer")
AB_CORRUPT = StructType([*AB.fields]).add("_corrupt_record", "string")


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_pipe_rows_by_position(spark):
    schema = StructType.fromDDL("x string, y string, z int")
    found = sources.parse_pipe(lines(spark, "a|b", "a|b|3|more", "||", "", "a|b|nope"), schema)
    assert tuples(found) == [
        ("a", "b", None), ("a", "b", 3), ("", "", None), ("", None, None), ("a", "b", None),
    ]


def test_gbk_pipe_file_is_safe_once_decoded(spark, tmp_path):
    text = "誠|億|榺|x"
    Path(tmp_path, "f.txt").write_bytes((text + "\n").encode("gbk"))
    decoded = sources.read_lines(spark, str(tmp_path), "GBK")
    schema = StructType.fromDDL("a string, b string, c string, d string")
    assert tuples(sources.parse_pipe(decoded, schema)) == [tuple(text.split("|"))]


MALFORMED = ("{bad", "   ", '[{"a":1},{"a":2}]', '{"a":"x","b":5}', '{"a":7,"c":1}', "[]", "null",
             "12", '[{"a":1},{"a":"x"}]', '[{"a":1}', '{"a":"","b":2}')


def test_json_permissive_nulls_the_whole_row_and_keeps_the_text(spark):
    found = sources.parse_json_lines(lines(spark, *MALFORMED), AB_CORRUPT)
    assert tuples(found) == [
        (None, None, "{bad"),
        (1, None, None),
        (2, None, None),
        (None, None, '{"a":"x","b":5}'),
        (7, None, None),
        (None, None, "null"),
        (None, None, "12"),
        (None, None, '[{"a":1},{"a":"x"}]'),
        (None, None, '[{"a":1}'),
        (None, 2, None),
    ]


def test_json_permissive_without_corrupt_column_keeps_null_rows(spark):
    found = sources.parse_json_lines(lines(spark, *MALFORMED), AB)
    assert tuples(found).count((None, None)) == 6 and found.columns == ["a", "b"]


def test_json_dropmalformed(spark):
    found = sources.parse_json_lines(lines(spark, *MALFORMED), AB, {"mode": "DROPMALFORMED"})
    assert tuples(found) == [(1, None), (2, None), (7, None), (None, 2)]


def test_json_failfast(spark):
    good = sources.parse_json_lines(lines(spark, '{"a":1}', " "), AB, {"mode": "FAILFAST"})
    assert tuples(good) == [(1, None)]
    bad = sources.parse_json_lines(lines(spark, '{"a":1}', "{bad"), AB, {"mode": "failfast"})
    with pytest.raises(Exception, match="FAILFAST"):
        bad.collect()


def test_json_unknown_mode_is_permissive(spark):
    found = sources.parse_json_lines(lines(spark, "{bad"), AB, {"mode": "whatever"})
    assert tuples(found) == [(None, None)]


def test_json_values(spark):
    schema = StructType.fromDDL(
        "d double, t timestamp, day date, s string, n decimal(30,9), m map<string,int>, "
        "k array<long>, _corrupt_record string"
    )
    texts = (
        '{"d":"NaN"}', '{"d":"Infinity"}', '{"d":"-Infinity"}', '{"d":"inf"}', '{"d":"abc"}',
        '{"t":1704067200}', '{"t":"2024-01-02T03:04:05.678Z"}', '{"day":"2024-01-02"}',
        '{"s":{"x":[1,2]}}', '{"s":12.50}', '[{"n":12345678901234567890.123456789}]',
        '{"m":{"x":1},"k":[1,2]}', '{"t":"2024-01-02 03:04:05"}', '{"day":"2024-1-2"}', '{"t":"soon"}',
    )
    r = sources.parse_json_lines(lines(spark, *texts), schema).collect()
    assert math.isnan(r[0].d) and r[1].d == math.inf and r[2].d == -math.inf
    assert r[3].d is None and r[3]._corrupt_record and r[4]._corrupt_record
    assert r[5].t == dt.datetime(2024, 1, 1) and r[6].t == dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    assert r[7].day == dt.date(2024, 1, 2)
    assert r[8].s == '{"x":[1,2]}' and r[9].s == "12.5"
    assert str(r[10].n) == "12345678901234567890.123456789"
    assert r[11].m == {"x": 1} and r[11].k == [1, 2]
    assert r[12].t == dt.datetime(2024, 1, 2, 3, 4, 5) and r[13].day == dt.date(2024, 1, 2)
    assert r[14].t is None and r[14]._corrupt_record


def test_json_parse_options(spark):
    text = lines(spark, "{a:1}", "{'a':2}", '{"a":03}')
    assert [r.a for r in sources.parse_json_lines(text, AB).collect()] == [None, 2, None]
    opts = {"allowUnquotedFieldNames": "true", "allowNumericLeadingZeros": "true", "allowSingleQuotes": "false"}
    assert [r.a for r in sources.parse_json_lines(text, AB, opts).collect()] == [1, None, 3]


def test_flat_json_modes(spark):
    schema = StructType.fromDDL("b int, a string, _corrupt_record string")
    text = lines(spark, '{"a":1,"b":"2"}', '{"a":"x"}', "{bad", " ", "[1]")
    assert tuples(sources.parse_json_flat(text, schema)) == [
        (2, "1", None), (None, "x", None), (None, None, "{bad"), (None, None, "[1]"),
    ]
    plain = StructType(schema.fields[:2])
    assert len(tuples(sources.parse_json_flat(text, plain, {"mode": "DROPMALFORMED"}))) == 2
    with pytest.raises(Exception, match="FAILFAST"):
        sources.parse_json_flat(text, plain, {"mode": "FAILFAST"}).collect()


def write(tmp_path, *texts, encoding="utf-8"):
    Path(tmp_path, "in.json").write_bytes("\n".join(texts).encode(encoding))
    return str(tmp_path)


def test_infer_merges_types_over_all_records(spark, tmp_path):
    path = write(
        tmp_path,
        '{"a":1,"b":1,"c":null,"d":{},"e":[1],"f":12345678901234567890123,"g":"","h":true}',
        '{"a":2.5,"b":"x","e":[2.5],"f":1.5,"g":"","h":false,"i":{"j":1}}',
    )
    found = dict(sources.schema_rows(sources.infer_json_schema(spark, path)))
    assert found == {
        "a": "double", "b": "string", "c": "string", "e": "array<double>", "f": "double",
        "g": "string", "h": "boolean", "i": "struct<j:bigint>", "i.j": "bigint",
    }


def test_infer_options_and_corrupt_column(spark, tmp_path):
    path = write(tmp_path, '{"a":1,"b":1.25,"n":123456789012345678901234567890123456789012}', "{bad")
    found = dict(sources.schema_rows(sources.infer_json_schema(spark, path)))
    assert found["_corrupt_record"] == "string" and found["n"] == "double"
    kept = sources.infer_json_schema(spark, path, options={"mode": "DROPMALFORMED", "prefersDecimal": "true"})
    assert dict(sources.schema_rows(kept))["b"] == "decimal(3,2)"
    assert "_corrupt_record" not in kept.names
    texts = sources.infer_json_schema(spark, path, options={"primitivesAsString": "true"})
    assert dict(sources.schema_rows(texts))["a"] == "string"
    with pytest.raises(ValueError):
        sources.infer_json_schema(spark, path, options={"samplingRatio": "0"})


def test_infer_gbk_names(spark, tmp_path):
    path = write(tmp_path, '{"名称":"誠億","n":1}', encoding="gbk")
    schema = sources.infer_json_schema(spark, path, "GBK")
    assert schema.names == ["n", "名称"]
    assert tuples(sources.read_gbk_json_typed(spark, path, schema)) == [(1, "誠億")]
    flat = StructType.fromDDL("`名称` string, n string")
    assert tuples(sources.read_gbk_json_flat(spark, path, flat)) == [("誠億", "1")]


def test_paragraph_records(spark, tmp_path):
    Path(tmp_path, "log").write_text("a=1\nb=2\n\na=3\nb=4\n\n\n\n")
    found = sources.read_paragraph_records(
        spark, str(tmp_path), "regexp_extract(value, 'a=([0-9]+)', 1) AS a",
        "regexp_extract(value, 'b=([0-9]+)', 1) AS b",
    )
    assert tuples(found) == [("1", "2"), ("3", "4")]


@pytest.mark.parametrize("gap", ["\n\n", "\r\n\r\n", "\n \t\n", "\n\n\n\n", "\r\n  \r\n\r\n"])
def test_paragraph_records_by_any_blank_line(spark, tmp_path, gap):
    texts = [f'{{"a":{i},{gap[:1]}"b":"x y"}}' for i in range(3)]
    Path(tmp_path, "log").write_bytes(("\n" + gap.join(texts) + gap).encode())
    for separator in ("\n\n", "\r\n\r\n"):
        found = sources.read_paragraph_records(spark, str(tmp_path), "from_json(value, 'a int').a AS a", separator=separator)
        assert sorted(tuples(found)) == [(0,), (1,), (2,)]


def test_json_files_by_the_built_in_source(spark, tmp_path):
    path = write(tmp_path, *MALFORMED)
    rows = tuples(sources.read_json_lines(spark, path, AB_CORRUPT))
    assert sorted(rows, key=str) == sorted([
        (None, None, "{bad"), (1, None, None), (2, None, None), (None, None, '{"a":"x","b":5}'), (7, None, None), (None, None, "null"),
        (None, None, "12"), (None, None, '[{"a":1},{"a":"x"}]'), (None, None, '[{"a":1},{"a":"x"}]'), (None, None, '[{"a":1}'), (None, 2, None),
    ], key=str)
    assert tuples(sources.read_json_lines(spark, path, AB, {"mode": "DROPMALFORMED"})) == [(1, None), (2, None), (7, None), (None, 2)]
    with pytest.raises(Exception, match="FAILFAST"):
        sources.read_json_lines(spark, path, AB, {"mode": "FAILFAST"}).collect()
    pruned = sources.read_json_lines(spark, path, AB_CORRUPT).select("a")
    assert "ReadSchema: struct<a:int,_corrupt_record:string>" in pruned._jdf.queryExecution().toString()


def test_pipe_rows_that_cannot_be_read(spark):
    schema = StructType.fromDDL("x string, z int")
    found = sources.parse_pipe(lines(spark, "a|1", "a|", "a", "b|x", "c|2|more"), schema, malformed="bad")
    assert tuples(found) == [("a", 1, None), ("a", None, None), ("a", None, None), ("b", None, "b|x"), ("c", 2, None)]


def test_csv_is_all_strings(spark, tmp_path):
    Path(tmp_path, "f.csv").write_text("a,b\n1,x\n2,\n")
    found = sources.read_csv_header(spark, str(tmp_path))
    assert found.dtypes == [("a", "string"), ("b", "string")]
    assert tuples(found) == [("1", "x"), ("2", None)]


def test_union_by_name_fills_gaps(spark):
    a, b = spark.sql("SELECT 1 AS x, 2 AS y"), spark.sql("SELECT 3 AS y")
    assert tuples(sources.union_files([a, b])) == [(1, 2), (None, 3)]


def test_json_writer_leaves_out_null_fields(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, TIMESTAMP'2024-01-02 03:04:05' AS t, DATE'2024-01-02' AS d, named_struct('x', NULL, 'y', 2) AS s")
    sources.write_json(df, path, compression="gzip")
    assert [r.value for r in spark.read.text(path).collect()] == [
        '{"a":1,"t":"2024-01-02T03:04:05.000Z","d":"2024-01-02","s":{"y":2}}'
    ]
    assert list(Path(path).glob("*.json.gz"))


def test_partition_writer_bounds_files_and_spreads_a_hot_partition(spark, tmp_path):
    # nine of ten rows in one partition, all of them equal
    df = spark.range(0, 20_000, 1, 16).select(
        F.when(F.col("id") % 10 == 0, F.lit("02")).otherwise(F.lit("01")).alias("month"),
        F.lit("same").alias("body"),
    )
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    for merged in ("true", "false"):
        spark.conf.set(merge, merged)
        try:
            path = sources.write_partition_parquet(df, str(tmp_path), ["month"], files=3)
        finally:
            spark.conf.unset(merge)
        for month in ("01", "02"):
            files = list(Path(path, f"month={month}").glob("*.parquet"))
            # slots this small may share a task; large ones do not
            assert (1 if merged == "true" else 2) <= len(files) <= 3
        assert spark.read.parquet(path).count() == 20_000


def test_partition_writer_without_file_count(spark, tmp_path):
    df = spark.range(100).select(F.lit("01").alias("month"), "id")
    path = sources.write_partition_parquet(df, str(tmp_path), ["month"])
    assert spark.read.parquet(path).count() == 100
    with pytest.raises(ValueError):
        sources.write_partition_parquet(df, str(tmp_path), ["month"], files=0)


def test_plain_partition_folders(spark, tmp_path):
    store, subject = Store(str(tmp_path)), Subject("web", "log")
    for name, low in (("u1", 0), ("u2", 10)):
        spark.range(low, low + 10).write.parquet(f"{store.table_root(subject)}/2024/01/{name}")
    found = sources.read_partition_folder(spark, store, subject, "2024/01")
    assert sorted(r.id for r in found.collect()) == list(range(20))


def test_batch_reader_rejects_unknown_types(spark):
    from logsilt.plans import read_batch

    with pytest.raises(ValueError, match="file type"):
        read_batch(spark, "xml", "/nowhere")
    with pytest.raises(ValueError, match="schema"):
        read_batch(spark, "txt", "/nowhere")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("block", [64, 1000, 50_000])
def test_paragraph_records_of_a_file_in_many_blocks(spark, tmp_path, end, block):
    """Records of no, one or many lines, longer than a block or many in one; any number of blank lines."""
    import random

    draw = random.Random(block)
    records, text = [], ""
    for i in range(300):
        lines = [f"{i} line {j} " + "x" * draw.choice([0, 3, 40, 700 if i % 50 == 0 else 5]) for j in range(draw.choice([1, 1, 2, 9]))]
        records.append(end.join(lines))
        text += records[-1] + end + "".join(draw.choice(["", " ", "\t "]) + end for _ in range(draw.choice([1, 1, 2, 30])))
    Path(tmp_path, "log").write_bytes((end * 3 + text).encode())
    Path(tmp_path, "other").write_bytes(b"alone")
    Path(tmp_path, "empty").write_bytes(b"")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        found = sources.read_paragraph_records(spark, str(tmp_path))
        assert sorted(r.value for r in found.collect()) == sorted([*records, "alone"])
        if block < 50_000:
            assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("blank", ["\r\n", " \n", "\t \r\n", "\n"])
def test_a_hundred_thousand_blank_lines(spark, tmp_path, blank):
    Path(tmp_path, "log").write_bytes(("first\n" + blank * 100_000 + "second\nline\n" + blank * 100_000).encode())
    found = sources.read_paragraph_records(spark, str(tmp_path))
    assert sorted(r.value for r in found.collect()) == ["first", "second\nline"]


def test_blank_lines_do_not_reach_python(spark, tmp_path, monkeypatch):
    from logsilt.sources import lines

    inner, seen = lines._pieces, spark.sparkContext.accumulator(0)

    def counted(batches):
        def each():
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return inner(each())

    monkeypatch.setattr(lines, "_pieces", counted)
    Path(tmp_path, "log").write_bytes(("first\n" + " \t\r\n" * 50_000 + "second\nline\n" + "\n" * 50_000).encode())
    found = sources.read_paragraph_records(spark, str(tmp_path))
    assert sorted(r.value for r in found.collect()) == ["first", "second\nline"]
    assert 3 <= seen.value < 100


_WRITE_AND_LOG = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
from logsilt import sources
config = {"spark.ui.enabled": "false", "spark.eventLog.enabled": "true", "spark.eventLog.dir": sys.argv[2],
          "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"}
builder = SparkSession.builder.master("local[2]")
for key, value in config.items():
    builder = builder.config(key, value)
spark = builder.getOrCreate()
rows = spark.range(300_000).select("id", (F.col("id") % 2 + 2024).cast("string").alias("year"))
for name, files in (("slots", 1), ("sized", None)):
    path = sources.write_partition_parquet(rows, f"{sys.argv[3]}/{name}", ["year"], files)
    assert spark.read.parquet(path).agg(F.countDistinct("id")).first()[0] == 300_000
    assert path.startswith(f"{sys.argv[3]}/{name}/randompath=")
spark.stop()
"""


def test_a_partition_is_written_without_holding_its_rows(spark, tmp_path):
    """The memory that a task takes to sort is in Spark's event log, of a session of its own."""
    import subprocess
    import sys

    log = tmp_path / "log"
    log.mkdir()
    home = str(Path(__file__).resolve().parents[1])
    subprocess.run([sys.executable, "-c", _WRITE_AND_LOG, home, str(log), str(tmp_path)], check=True, timeout=120, capture_output=True)
    peaks = []
    for line in next(log.iterdir()).read_text().splitlines():
        event = json.loads(line)
        if event["Event"] == "SparkListenerTaskEnd" and event["Task Metrics"]["Output Metrics"]["Records Written"]:
            peaks.append(event["Task Metrics"]["Peak Execution Memory"])
    assert peaks and max(peaks) == 0
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"
