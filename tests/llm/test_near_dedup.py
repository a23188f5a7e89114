from __future__ import annotations

import random

import numpy as np
import pytest

from logsilt.llm import near_dedup as nd
from logsilt.llm import queries, stages
from logsilt.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, key string, id int, source string"


def classes_of(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 1, "s") for i, t in rows], SCHEMA)
    return [(r.doc_id, r.class_id) for r in nd.near_duplicates(df).collect()]


def words(rng, n):
    return ["".join(rng.choices("abcdefghij", k=5)) for _ in range(n)]


def brute(spark, rows):
    """Components of all pairs by exact weighted Jaccard similarity."""
    df = spark.createDataFrame([(i, t, "x", 1, "s") for i, t in rows], SCHEMA)
    weights = nd.word_weights(df)
    known = nd._Words(weights)
    sets = [nd.shingles(nd.words_of(t), known) for _, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            same = nd.words_of(rows[a][1]) == nd.words_of(rows[b][1])
            if same or nd.similarity(sets[a], sets[b]) >= nd.SIMILARITY:
                x, y = root(rows[a][0]), root(rows[b][0])
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def test_planted_copies(spark):
    rng = random.Random(7)
    rows, passage = [], words(rng, 60)
    for group in range(40):
        original = words(rng, rng.randint(60, 400))
        for copy in range(rng.choice([1, 1, 2, 5, 30])):
            near = list(original)
            for _ in range(copy and max(1, len(near) // 150)):
                near[rng.randrange(len(near))] = "changed" + str(rng.random())
            rows.append((len(rows), " ".join(near)))
    rows += [(10_000 + i, " ".join(passage + words(rng, 200))) for i in range(60)]
    rng.shuffle(rows)
    got = dict(classes_of(spark, rows))
    assert got == brute(spark, rows)
    assert len({c for i, c in got.items() if i >= 10_000}) == 60


def test_one_large_group(spark):
    rng = random.Random(1)
    original = words(rng, 150)
    rows = [(i, " ".join(original)) for i in range(700)]
    for i in range(500):
        near = list(original)
        near[rng.randrange(150)] = f"w{i}"
        rows.append((1000 + i, " ".join(near)))
    rows += [(5000 + i, " ".join(words(rng, 80))) for i in range(400)]
    got = dict(classes_of(spark, rows))
    assert {got[i] for i, _ in rows if i < 5000} == {0}
    assert all(got[i] == i for i, _ in rows if i >= 5000)


def test_odd_rows(spark):
    long = " ".join(words(random.Random(2), 60_000))
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "two one"), (None, "one two"), (None, None), (7, long), (8, long),
        (9, "a b c d e f g"), (9, "a b c d e f g"), (10, "other text of its own kind here"), (10, "a b c d e f g"), (0, "other text of its own kind here"),
    ]
    got = classes_of(spark, rows)
    assert len(got) == len(rows) and sum(i is None and c is None for i, c in got) == 2
    known = {i: c for i, c in got if i is not None}
    assert known == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7, 8: 7, 9: 0, 10: 0, 0: 0}
    assert classes_of(spark, []) == []


def test_sampling_is_unbiased():
    rng = np.random.default_rng(3)
    sampler = nd.Sampler(samples=4000)
    for share in (0.3, 0.6, 0.9):
        keys = np.unique(rng.integers(0, 1 << 63, 300, np.uint64))
        weight = rng.uniform(0.5, 6, len(keys))
        other = np.where(rng.random(len(keys)) < share, weight, weight * rng.uniform(0.2, 3, len(keys)))
        a, b = (keys, weight), (keys[20:], other[20:])
        signed = sampler.signatures([a, b])
        assert abs((signed[0] == signed[1]).mean() - nd.similarity(a, b)) < 0.035


def test_signature_of_a_chunk_is_that_of_the_text(monkeypatch):
    rng = random.Random(4)
    table_ = nd._Words(nd.Weights(np.empty(0, np.uint64), np.empty(0), 2.0))
    texts = [nd.shingles(words(rng, n), table_) for n in (1, 3, 7, 50, 300, 2)]
    whole = nd.Sampler().signatures(texts)
    monkeypatch.setattr(nd, "_CHUNK", 40)
    assert (nd.Sampler().signatures(texts) == whole).all()


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(200)] + [(500, i) for i in range(300, 420)] + [(1000 + rng.randrange(80), 1000 + rng.randrange(80)) for _ in range(60)]
    rng.shuffle(edges)
    got = {r.id: r.class_id for r in nd.components(spark.createDataFrame(edges, "id long, other long")).collect()}
    parent = {x: x for e in edges for x in e}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    alone = {x for x in parent if all(x in e for e in edges if x in e and e[0] == e[1]) and all(e[0] == e[1] for e in edges if x in e)}
    assert got == {x: root(x) for x in parent if x not in alone}


@pytest.fixture(scope="module")
def truth(spark):
    return brute(spark, [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()])


def test_query(spark, truth):
    assert {r.doc_id: r.class_id for r in queries.op5_icws_near_dedup(spark, SF).collect()} == truth


def test_stage_keeps_one_of_each_class(spark, truth):
    docs = table(spark, SF, "documents")
    kept = stages.drop_near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(truth.values()))
    odd = spark.createDataFrame([(None, "x"), (None, "x"), (1, "b b"), (1, "a a"), (2, "c"), (3, "c"), (2, "c")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in stages.drop_near_duplicates(spark, odd, SF).collect()), key=str)
    assert got == [(1, "a a"), (2, "c"), (None, "x"), (None, "x")]


def test_no_pair_of_a_bucket_is_left_untested(spark, monkeypatch):
    """What the pass over leaders misses, here all of it, is found afterwards, also across blocks."""
    rng = random.Random(2)
    original, rows = words(rng, 120), []
    for i in range(150):
        near = list(original)
        for _ in range(rng.randint(0, 8)):
            near[rng.randrange(120)] = f"w{rng.random()}"
        rows.append((i, " ".join(near)))
    first = nd.candidates
    monkeypatch.setattr(nd, "candidates", lambda texts: first(texts).limit(0))
    monkeypatch.setattr(nd, "BLOCK", 16, raising=False)
    assert dict(classes_of(spark, rows)) == brute(spark, rows)
