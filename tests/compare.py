"""Compare the registered queries with their DuckDB equivalents.

``python tests/compare.py [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql, sf) -> str | None:
    """None when both sides agree, else what differs."""
    found = query(spark, sf)
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(found.columns) != sorted(names):
        return f"columns {sorted(found.columns)} != {sorted(names)}"
    left, right = rows_of(found.columns, found.collect()), rows_of(names, expected.fetchall())
    if left == right:
        return None
    return (
        f"{sum(left.values())} rows vs {sum(right.values())}; "
        f"only here {list((left - right).items())[:2]}; only there {list((right - left).items())[:2]}"
    )


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from tests.conftest import build_session

    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(entry.oracle_sql())
    spark, con = build_session(), duck(sf)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], sf)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv))
