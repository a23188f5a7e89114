"""Repeated windows against brute force, and what the rounds promise about equal substrings."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from logsilt.llm import recompression
from tests.llm.brute import as_rows

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows, width=20):
    """(doc_id, n_words, n_removed, digest of the kept words) of rows (doc_id, text)."""
    last = (1 << 63) - 1
    first = {}
    texts = [(last if i is None else i, i, WORD.findall(t or "")) for i, t in rows]
    for oid, _, words in texts:
        for p in range(len(words) - width + 1):
            key = tuple(words[p : p + width])
            first[key] = min(first.get(key, (oid, p)), (oid, p))
    found = []
    for oid, doc_id, words in texts:
        gone = [False] * len(words)
        for p in range(len(words) - width + 1):
            if first[tuple(words[p : p + width])] < (oid, p):
                gone[p : p + width] = [True] * width
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        found.append((doc_id, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(found, key=str)


def result(spark, rows, width=20, rounds=recompression.ROUNDS):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = recompression.without_repeats(docs, width=width, rounds=rounds).collect()
    return sorted(
        [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in kept], key=str
    )


@pytest.mark.parametrize("seed, letters, rounds", [(1, "ab", 3), (2, "abc", 2), (3, "abcdefgh", 5), (4, "a", 3)])
def test_few_words(spark, monkeypatch, seed, letters, rounds):
    """Texts of few different words: runs, periods, windows that overlap their own repeats."""
    monkeypatch.setattr(recompression, "_CROWD", 2)
    draw = random.Random(seed)
    rows = []
    for i in range(60):
        words = [draw.choice(letters) for _ in range(draw.randrange(60))]
        if i % 3 == 0 and rows:
            words += (rows[draw.randrange(len(rows))][1] or "").split()
        rows.append((draw.randrange(40), " ".join(words)))
    assert result(spark, rows, 6, rounds) == brute_force(rows, 6)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(spark, rows) == brute_force(rows)


def test_edge_rows(spark):
    passage = " ".join(f"w{i}" for i in range(50))
    rows = [
        (None, passage), (3, passage), (1, f"x {passage} y\u0085 z"), (3, None), (4, ""), (5, " \t\n "),
        (6, " ".join(f"w{i}" for i in range(19))), (6, passage), (7, passage), (7, passage), (8, "a\x00b " * 30),
        (9, f"{passage}\x0b{passage}"), (10, "été " * 100),
    ]
    found = result(spark, rows)
    assert found == brute_force(rows)
    assert (None, 50, 50, hashlib.sha256(b"").hexdigest()) in found
    assert spark.createDataFrame([], "doc_id long, text string, lang int").transform(recompression.without_repeats).count() == 0


def test_clashing_names(spark):
    rows = [(1, "one two " * 30), (2, "one two " * 30)]
    docs = as_rows(spark, rows, ["oid", "dk", "spans", "start", "kind", "name", "anchor"])
    found = {r.doc_id: r.n_removed for r in recompression.without_repeats(docs).collect()}
    assert found == {r[0]: r[2] for r in brute_force(rows)}


def test_long_text(spark):
    text = " ".join(str(i % 50_021) for i in range(300_000))
    rows = [(1, text), (2, text[: len(text) // 2])]
    assert result(spark, rows) == brute_force(rows)


def test_equal_substrings_have_equal_symbols():
    """Symbols whose deciding words lie in a substring are the same wherever the substring stands."""
    draw = random.Random(7)
    inner = [draw.choice("abcde") for _ in range(80)]
    texts = [[draw.choice("abcde") for _ in range(draw.randrange(30))] + inner + [draw.choice("abcde") for _ in range(9)] for _ in range(20)]
    seen = []
    for text in texts:
        words = recompression.fingerprints(pa.array([" ".join(text)]))
        at = len(text) - 9 - len(inner)
        symbols = set()
        for height, level in enumerate(recompression.levels(words, 6)):
            inside = np.flatnonzero((level.low >= at) & (level.high <= at + len(inner)))
            symbols |= {(height, int(level.name[i]), int(level.low[i] - at), int(level.high[i] - at)) for i in inside}
        seen.append(symbols)
    assert all(symbols == seen[0] for symbols in seen)
    assert {height for height, *_ in seen[0]} >= {0, 1, 2, 3, 4}
