from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from logsilt.llm.topk import best_of_block, exact_top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, k=5):
    usable = [
        (i, [math.floor(256 * float(x)) for x in v])
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = set()
    for query in {i for i, _ in usable if i % 50 == 0}:
        scores = {}
        for i, v in usable:
            if i != query:
                for j, q in usable:
                    if j == query and len(q) == len(v):
                        s = sum(a * b for a, b in zip(q, v, strict=True))
                        scores[i] = max(s, scores.get(i, s))
        ranked = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]
        found |= {(query, r, i, s) for r, (i, s) in enumerate(ranked, 1)}
    return found


def top(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return [tuple(r) for r in exact_top_k(df, F.col("vec_id") % 50 == 0).collect()]


def test_edge_rows(spark):
    f32 = lambda *v: [float(np.float32(x)) for x in v]
    rows = [
        (0, f32(0.5, -0.25), 1, "x"), (50, f32(0.1, 0.2), None, None), (1, f32(0.5, -0.25), 1, None), (2, f32(0.5, -0.25), 1, ""),
        (3, None, 1, "x"), (4, [0.5, None], 1, "x"), (5, [float("nan"), 0.5], 1, "x"), (6, [float("inf"), 0.5], 1, "x"),
        (None, f32(9, 9), 1, "x"), (7, f32(0.001, 0.002, 0.003), 1, "x"), (100, f32(0.3, 0.1, 0.2), 1, "x"),
        (150, [], 1, "x"), (8, [], 1, "x"), (9, f32(-0.0001, 0.9), 1, "x"), (9, f32(0.7, 0.9), 1, "x"), (50, f32(0.1, 0.2), 1, "y"),
        (10, f32(30000.5, -1), 1, "x"),
    ]
    found = top(spark, rows)
    assert len(found) == len(set(found))
    assert set(found) == brute(rows)


def test_empty_table(spark):
    assert top(spark, []) == []


def test_pruning_is_exact():
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 60, (6, 33))
    vectors = np.floor(centres[rng.integers(0, 6, 700)] + rng.normal(0, 4, (700, 33))).astype(np.int64)
    vectors[100:140] = vectors[7]
    ids = rng.permutation(700).astype(np.int64)
    queries, query_ids = vectors[:40], ids[:40]
    found = list(zip(*(a.tolist() for a in best_of_block(query_ids, queries, ids, vectors, 5)), strict=True))
    for q, query in zip(query_ids, queries, strict=True):
        scores = vectors @ query
        want = sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist(), strict=True) if i != q)[:5]
        assert [(-s, i) for _, i, s in found if _ == q] == want


def test_repeated_ids_leave_places_for_others(spark):
    values = [(1, 0.9 - i / 100) for i in range(300)] + [(2 + i, 0.4 - i / 100) for i in range(8)] + [(0, 1.0)]
    rows = [(i, [v, v / 2], 1, "x") for i, v in values]
    found = top(spark, rows)
    assert sorted(r[2] for r in found if r[0] == 0) == [1, 2, 3, 4, 5]
    assert set(found) == brute(rows)


def test_pruning_is_exact_with_repeated_ids():
    rng = np.random.default_rng(6)
    vectors = rng.integers(-200, 200, (900, 33))
    ids = np.where(rng.random(900) < 0.5, 7, rng.integers(0, 60, 900)).astype(np.int64)
    query_ids, queries = np.arange(40, dtype=np.int64), vectors[:40]
    found = list(zip(*(a.tolist() for a in best_of_block(query_ids, queries, ids, vectors, 5)), strict=True))
    for q, query in zip(query_ids.tolist(), queries, strict=True):
        best = {}
        for s, i in zip((vectors @ query).tolist(), ids.tolist(), strict=True):
            best[i] = max(s, best.get(i, s))
        want = sorted((-s, i) for i, s in best.items() if i != q)[:5]
        assert [(-s, i) for _, i, s in found if _ == q] == want
