"""Random small inputs against a plain Python model of the merge."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logsilt import functions as fn
from logsilt import operators as op
from logsilt.plans import merge_new_rows

SETTINGS = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
KEY = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
HOUR = st.sampled_from(["01", "02", "03"])
BATCH = st.lists(st.tuples(HOUR, KEY), max_size=25)
DDL = "hour string, m string, v int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], DDL)


def expected(batch, stored, null_safe):
    newest = {}
    for i, key in enumerate(batch):
        newest[key] = i
    known = set(stored)
    kept = [
        (*key, i) for key, i in newest.items() if key not in known or (key[1] is None and not null_safe)
    ]
    return sorted(kept, key=repr)


@SETTINGS
@given(batch=BATCH, stored=BATCH, null_safe=st.booleans())
def test_merge_matches_the_model(spark, batch, stored, null_safe):
    found = merge_new_rows(
        frame(spark, batch), frame(spark, stored), ["hour"], "m", order_by=["v"], null_safe=null_safe
    )
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(batch, stored, null_safe)


@SETTINGS
@given(batch=BATCH, cut=st.integers(0, 25))
def test_two_batches_give_the_keys_of_one(spark, batch, cut):
    first, second = batch[:cut], batch[cut:]
    once = merge_new_rows(frame(spark, first), None, ["hour"], "m")
    twice = merge_new_rows(frame(spark, second), once, ["hour"], "m", null_safe=True)
    keys = sorted(((r.hour, r.m) for r in once.unionAll(twice).collect()), key=repr)
    assert keys == sorted(set(batch), key=repr)


@SETTINGS
@given(rows=st.lists(st.tuples(KEY, st.integers(0, 3)), max_size=25))
def test_anti_join_matches_the_model(spark, rows):
    new = spark.createDataFrame(rows, "k string, n int")
    stored = spark.createDataFrame([("a",), ("a",), (None,), ("c",)], "k string")
    for spread in (True, False):
        found = op.anti_join_existing(new, stored, ["k"], spread=spread)
        want = [r for r in rows if r[0] not in ("a", "c")]
        assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(want, key=repr)


@SETTINGS
@given(texts=st.lists(st.text(alphabet="ab|", max_size=8), max_size=20))
def test_split_pipe_matches_the_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select(fn.split_pipe(F.col("t")), fn.split_pipe(F.col("t"), True)).collect()

    def trimmed(text):
        parts = text.split("|")
        if text and not text.strip("|"):
            return []
        while len(parts) > 1 and parts[-1] == "":
            parts.pop()
        return parts

    assert [tuple(r) for r in found] == [(t.split("|"), trimmed(t)) for t in texts]
