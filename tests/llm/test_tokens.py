"""Encoding, decoding and packing."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from logsilt.llm import bpe, packing, queries
from logsilt.llm.common import table

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, task string, length int"
ODD = [None, "", " ", "a" * 3000, "\n" * 500 + "x", "日本語 テスト", "<|endoftext|>", "it's we'll\t\t x  ", "é" * 999, "\u0000\x7f"]


def reference():
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@settings(max_examples=60, deadline=None)
@given(st.one_of(st.text(max_size=200), st.text("ab ", max_size=400), st.text("ethinsr", max_size=120)))
def test_bpe_as_tiktoken(text):
    coder = bpe.bpe(RANKS, P.PATTERN)
    ids = coder.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == reference().encode_ordinary(text)
    assert coder.decode(ids) == text.encode()


def test_bpe_long_pretoken():
    random.seed(3)
    text = "".join(random.choices("etaoinshrdlu", k=40_000))
    assert np.frombuffer(bpe.bpe(RANKS, P.PATTERN).encode(text), "<u4").tolist() == reference().encode_ordinary(text)


def test_bpe_long_text_in_parts(monkeypatch):
    monkeypatch.setattr(bpe, "_LONG_TEXT", 64)
    text = "Some words, and   more words.\n" * 50
    assert np.frombuffer(bpe.bpe(RANKS, P.PATTERN).encode(text), "<u4").tolist() == reference().encode_ordinary(text)


def test_bpe_query(spark):
    coder = reference()
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = queries.op8_rank_queue_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.array(coder.encode_ordinary(texts[r.doc_id]), "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_odd_rows(spark):
    df = spark.createDataFrame([(i if i else None, t, "x", 1) for i, t in enumerate(ODD)] * 2, SCHEMA)
    rows = bpe.encode_documents(df, RANKS, P.PATTERN).collect()
    assert Counter(bytes(r.decoded) for r in rows) == Counter((t or "").encode() for t in ODD * 2)
    assert bpe.encoding_digests(df.limit(0), RANKS, P.PATTERN).collect() == []


def check_packing(rows, texts, capacity=1024):
    """Pieces give back every document, and bins have no gaps and are not too full."""
    t = Tokenizer.from_file(JSON)
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, text in texts.items():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        mine = sorted(pieces.pop(doc_id), key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(len(mine)))
        assert sum(r.length for r in mine) == len(ids) and all(r.length == capacity for r in mine[1:])
        for r in mine:
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    assert not pieces
    for inside in bins.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(r.length for r in rows) // capacity)


def test_packing_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    used, least = check_packing(queries.op7_best_two_fit(spark, SF).collect(), texts)
    assert used <= least * 1.02 + 1


def test_packing_odd_rows(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)]
    df = spark.createDataFrame([*rows, (100, " " * 1_200_000 + "x", "y", 2)], SCHEMA)
    found = packing.pack_documents(df, JSON, P.PATTERN).collect()
    assert len({(r.sequence_id, r.offset) for r in found}) == len(found)
    check_packing([r for r in found if r.doc_id != 100 or True], {r[0]: r[1] for r in rows} | {100: " " * 1_200_000 + "x"})
    twice = packing.pack_documents(df.where("doc_id IN (3, 5)").union(df.where("doc_id IN (3, 5)")), JSON, P.PATTERN).collect()
    assert Counter(r.doc_id for r in twice) == Counter({3: 2, 5: 2})
    assert packing.pack_documents(df.limit(0), JSON, P.PATTERN).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=25))
def test_plan_uses_every_document_once(histogram):
    plan = packing.plan_bins(histogram, 60)
    used = Counter()
    for times, inside in plan:
        assert times >= 1 and sum(inside) <= 60
        for n in inside:
            used[n] += times
    assert used == Counter(histogram)
    # no worse than twice the least, whatever the lengths; see the query for real ones
    assert sum(t for t, _ in plan) <= max(1, -(-2 * sum(n * c for n, c in histogram.items()) // 60)) if histogram else not plan


def test_two_for_one():
    # 6 + 3 leaves a gap of 1; the 3 gives way to 2 + 2, which fill it
    assert packing.fill_bin(Counter({6: 1, 3: 1, 2: 2}), [2, 3, 6], 10) == [6, 2, 2]


def test_vocabulary_is_the_rank_file():
    assert packing.byte_ranks(Tokenizer.from_file(JSON)) == bpe.read_ranks(RANKS)


def test_added_tokens_in_a_text_are_themselves(spark):
    texts = {1: "hi <|endoftext|> there", 2: "<|endoftext|>" * 700, 3: "<|endoftext|", 4: "\u00a0<|endoftext|>  x"}
    found = packing.pack_documents(spark.createDataFrame([(i, t, "x", 1) for i, t in texts.items()], SCHEMA), JSON, P.PATTERN).collect()
    check_packing(found, texts)
    one = np.array([5303, 220, 50256, 612, 2], "<u4")
    assert {r.ids_crc32 for r in found if r.doc_id == 1} == {zlib.crc32(one.tobytes())}
