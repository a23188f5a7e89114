"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from logsilt.llm import variants
from tests.llm.brute import as_rows

SF = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def apart(a, b):
    """Whether exactly one insertion, deletion or replacement makes one of the other."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    p = 0
    while p < len(a) and a[p] == b[p]:
        p += 1
    return a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else a[p:] == b[p + 1 :]


def brute_force(counts):
    deleted = defaultdict(set)
    for word in counts:
        for i in range(len(word)):
            deleted[word[:i] + word[i + 1 :]].add(word)
        deleted[word].add(word)
    near = defaultdict(set)
    for group in deleted.values():
        for a in group:
            near[a] |= {b for b in group if apart(a, b)}
    forms = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best is not None and counts[best] >= 10 * n else None
    rows = set()
    for word, n in counts.items():
        root = word
        while forms[root] is not None:
            root = forms[root]
        rows.add((word, forms[word], root, n, len(near[word]), counts.get(forms[word])))
    return rows


def result(spark, docs, **options):
    rows = variants.group_variants(docs, **options).collect()
    assert len({r.word for r in rows}) == len(rows)
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = brute_force(counted([(r.doc_id, r.text) for r in docs.collect()]))
    assert result(spark, docs) == expected
    assert sum(row[1] is not None for row in expected) > 5


@pytest.mark.parametrize("limit", [20_000, 3])
def test_dense_words(spark, monkeypatch, limit):
    """Words over few letters, all near each other; small limits split their groups to single letters."""
    monkeypatch.setattr(variants, "_FRONTIER", 500)
    monkeypatch.setattr(variants, "_CHUNK", 64)
    draw = random.Random(5)
    rows = []
    for i in range(400):
        word = "".join(draw.choice("abÿ") for _ in range(draw.randrange(6, 10)))
        rows.append((i, f"{word} " * draw.choice([1, 2, 25, 300, 3500])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = result(spark, docs, group_limit=limit)
    assert found == brute_force(counted(rows))
    assert any(form and root != form for _, form, root, *_ in found)


def test_edge_rows(spark):
    long = "".join(random.Random(3).choice("abcdefg") for _ in range(30_000))
    rows = [(None, None), (1, ""), (None, "Straßenbahn straßenbahn STRASSENBAHN"), (2, f"{long} {long} {long}x {long}x")]
    rows += [(3, "ÀÉÎõüÿç àéîõüÿç ÀÉÎõüÿç àéîõüÿç × ÷÷÷÷÷÷÷÷ ÷÷÷÷÷÷÷÷ ÷÷÷÷÷÷÷×")] * 3 + [(4, "combined'letters combined'letters Combined")]
    docs = as_rows(spark, rows, ["word", "n", "stem", "base", "low", "high", "middle", "root", "id", "run", "h"])
    assert result(spark, docs) == brute_force(counted(rows))
    assert variants.group_variants(docs.limit(0)).count() == 0
    assert variants.group_variants(docs.where("doc_id = 1")).count() == 0


def test_roots_follow_long_chains(spark):
    chain = [("aaaaaaa", 2), ("aaaaaab", 20), ("aaaaabb", 200), ("aaaabbb", 2_000), ("aaabbbb", 20_000), ("aabbbbb", 200_000)]
    forms = spark.createDataFrame([(a, b) for (a, _), (b, _) in zip(chain, chain[1:])], "word string, form string")
    roots = {r.word: r.root for r in variants._roots(forms, chain[-1][1]).collect()}
    assert roots == {word: "aabbbbb" for word, _ in chain[:-1]}
