"""Every registered query has an equivalent in SQL, and the two agree."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_contract(spark):
    assert set(entry.core_queries()) == set(entry.core_oracle_sql())
    assert set(entry.core_queries()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["event_id", "user_id", "event_type", "match_value", "action_time"]


@pytest.mark.parametrize("name", sorted(entry.core_queries()))
def test_query(spark, con, name):
    assert compare(spark, con, entry.core_queries()[name], entry.core_oracle_sql()[name], SF) is None
