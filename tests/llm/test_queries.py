"""Registered queries: names, and equality with their SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from logsilt.llm import queries
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"


def test_registered():
    names = list(queries.QUERIES)
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE_SQL) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, name):
    assert compare(spark, duck(SF), queries.QUERIES[name], queries.ORACLE_SQL[name], SF) is None
