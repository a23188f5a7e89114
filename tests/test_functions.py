"""Column functions on edge rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from logsilt import functions as fn
from logsilt.layout import Subject, partition_keys, time_keys


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize(
    "path, current, expected",
    [
        ("2021", "2024/01/31/10", True),  # 3 * 365 days, 2021-01-01 to 2024-01-01 is 1095 days
        ("2020", "2024/01/31/10", False),
        ("2023/10", "2024/01/31/10", True),  # 92 days
        ("2023/09", "2024/01/31/10", False),
        ("2023/12/31", "2024/01/31/10", True),  # exactly 31 days
        ("2023/12/30", "2024/01/31/10", False),
        ("2024/01/24/10", "2024/01/31/10", True),  # exactly 7 days
        ("2024/01/24/09", "2024/01/31/10", False),
        ("2021/02/01/00/00", "2024/01/31/10/00", True),
        ("2021/01/31/09/00", "2024/01/31/10/00", False),
        ("2025/01/01", "2024/01/31/10", True),  # ahead of time
        ("never", "2024/01/31/10", None),
        (None, "2024/01/31/10", None),
    ],
)
def test_late_window(spark, path, current, expected):
    assert one(spark, fn.within_late_window(F.lit(path).cast("string"), F.lit(current))) == (expected,)


def test_action_time_falls_back_to_now_on_empty_text(spark):
    now = F.lit(1_700_000_000)
    texts = ["1704067200123", "", "x", None]
    found = one(spark, *[fn.action_time(F.lit(t).cast("string"), "yyyy/MM/dd/HH", now) for t in texts])
    assert found == ("2024/01/01/00", "2023/11/14/22", None, None)


def test_format_and_parse_are_inverse(spark):
    millis = F.lit(1704069000000).cast("bigint")
    text = fn.format_partition(millis, "yyyy/MM/dd/HH")
    assert one(spark, text, fn.parse_partition(text, "yyyy/MM/dd/HH")) == (
        "2024/01/01/00",
        1704067200000,
    )


def test_rules_and_keys():
    assert partition_keys("yyyy/MM") == ["year", "month", "randompath"]
    assert partition_keys("") == [] and partition_keys(None) == []
    assert time_keys("yyyy/MM/dd/HH") == ["year", "month", "day", "hour"]
    with pytest.raises(ValueError):
        partition_keys("MM/dd")


def test_subject_needs_two_parts():
    assert Subject.parse("web.visits.extra") == Subject("web", "visits")
    for text in ("web", "web.", ".visits", ""):
        with pytest.raises(ValueError):
            Subject.parse(text)


@pytest.mark.parametrize(
    "path, fits",
    [("2024/01/02", True), ("2024/01", False), ("2024/01/02/03", False), ("2024//02", False),
     ("2024/01/a b", False), ("2024/01/../x", False), (None, False), ("", False)],
)
def test_fits_rule(spark, path, fits):
    column = F.lit(path).cast("string")
    values = fn.partition_values(column, "yyyy/MM/dd")
    found = one(spark, fn.fits_rule(column, "yyyy/MM/dd"), values["year"], values["day"])
    assert found[0] is fits
    assert (found[1] is not None) is fits and (found[2] is not None) is fits


def test_spec_round_trip(spark):
    spec = fn.partition_spec(F.lit("2016/08/09/09"))
    assert one(spark, spec, fn.spec_to_path(spec)) == (
        "year=2016/month=08/day=09/hour=09",
        "2016/08/09/09",
    )


@pytest.mark.parametrize(
    "text, kept, trimmed",
    [("a|b", ["a", "b"], ["a", "b"]), ("a|b||", ["a", "b", "", ""], ["a", "b"]),
     ("||", ["", "", ""], []), ("", [""], [""]), ("|a", ["", "a"], ["", "a"])],
)
def test_split_pipe(spark, text, kept, trimmed):
    column = F.lit(text)
    assert one(spark, fn.split_pipe(column), fn.split_pipe(column, True)) == (kept, trimmed)


def test_gbk_decodes_trail_bytes_and_replaces_bad_ones(spark):
    texts = ["誠|億\\", "plain", ""]
    rows = [(bytearray(t.encode("gbk")),) for t in texts] + [(bytearray(b"\xff\xffa"),), (None,)]
    df = spark.createDataFrame(rows, "b binary")
    assert [r.t for r in fn.decode_gbk(df, "b", "t").collect()] == [*texts, "��a", None]
    assert spark.conf.get("spark.sql.legacy.javaCharsets", "false") == "false"


def test_gbk_labels_have_separator_trail_bytes():
    assert "誠".encode("gbk")[1:] == b"\\" and "億".encode("gbk")[1:] == b"|"


def test_json_map_keeps_nested_text(spark):
    text = F.lit('{"a": 1, "b": {"c": [1]}, "d": null, "e": "x"}')
    assert one(spark, fn.json_map(text), fn.json_map(F.lit("{bad"))) == (
        {"a": "1", "b": '{"c":[1]}', "d": None, "e": "x"},
        None,
    )
