"""Source divergence: odd rows and many sources against plain counting."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from logsilt.llm import divergence
from tests.llm.brute import as_rows

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, min_docs, top=50):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    found = set()
    for lang in {lang for lang, _ in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        shares = {}
        own = {s: counts[lang, s] for l, s in groups if l == lang}
        for name, count in [*own.items(), (None, sum(own.values(), Counter()))]:
            total = sum(count[t] for t in kept)
            shares[name] = {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}
        for source, count in own.items():
            pairs = [(-sum(abs(shares[source][t] - shares[o][t]) for t in kept), o.encode()) for o in own if o != source]
            terms = [
                (shares[None][t] - shares[source][t], t.encode()) for t in kept if count[t] and shares[source][t] > shares[None][t]
            ]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                found |= {(lang, source, part, item.decode(), -less, rank) for rank, (less, item) in enumerate(items, 1)}
    return found


def result(docs, **options):
    rows = divergence.audit(docs, **options).collect()
    found = {(r.lang, r.source, r.part, r["item"], r.value, r.rank) for r in rows}
    assert len(found) == len(rows)
    return found


ROWS = [
    ("en", "a", "The cat. the CAT-the dog"), ("en", "b", "ÄPFEL äpfel Äpfel 猫 cat\x00dog"), ("en", None, None), ("en", "", "dog dog"),
    (None, "a", "the the the"), (None, None, ""), ("de", "a", "1234 !!!"), ("de", "b", "das"), ("en", "a", "The cat. the CAT-the dog"),
    ("en", "z", "cat " * 200_000), ("fr", "a", "seul"),
]


@pytest.mark.parametrize("min_docs", [1, 2, 30])
def test_edge_rows(spark, monkeypatch, min_docs):
    monkeypatch.setattr(divergence, "_SLICE_BYTES", 40)
    docs = as_rows(spark, ROWS, ["term", "n", "docs", "sid", "p", "shard", "total"], "lang string, source string, text string")
    assert result(docs, min_docs=min_docs) == brute_force(ROWS, min_docs)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_more_sources_than_a_block(spark, monkeypatch):
    """Sources in several blocks, counts in several shards: all pairs, all ranks, exact sums."""
    monkeypatch.setattr(divergence, "_SHARD_ROWS", 300)
    rows = [("en", f"s{i:03d}", " ".join(f"{chr(97 + (i * j) % 26)}{chr(97 + j)}" for j in range(i % 23))) for i in range(300)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    found = result(docs, min_docs=3, top=4)
    assert found == brute_force(rows, 3, 4)
    assert sum(row[2] == "pair" for row in found) == 300 * 299


def test_task_lets_go_of_many_counts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "_PENDING_ROWS", 10)
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 40, "source": ["a"] * 40, "text": [f"t{chr(97 + i % 26)} same" for i in range(40)]})
    parts = pa.Table.from_batches(divergence.partial_counts(iter([batch, batch])))
    assert sum(parts["n"].to_pylist()) == 160
    assert sum(n for t, n in zip(parts["term"].to_pylist(), parts["docs"].to_pylist()) if t == "same") == 80
