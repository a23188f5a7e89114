"""Byte-level BPE with a hierarchical-bitmap rank queue.

The parts of a pre-token are a linked list of positions. A bucket per merge rank holds the positions
whose pair has that rank; three levels of 64-bit words mark the buckets in use, so that find-first-set
on each level gives the lowest rank. Positions whose pair has changed since are skipped when met.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsilt.llm.common import by_batch

#: Pre-tokens a worker remembers before it starts anew; bounds its memory, never the result.
REMEMBERED = 1 << 20
_LONG_TEXT = 1 << 20
_BIT = [1 << i for i in range(64)]


class Bpe:
    """Encoder and decoder for a table of ranks (token bytes to id) and a split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._ranks = ranks
        self._find = regex.compile(pattern)
        self._tokens = {i: token for token, i in ranks.items()}
        self._known = _Remembered(self._packed)
        # the queue, empty between calls: buckets by rank, a bit for each bucket, for each word of
        # bits, and (a local of merge) for each group of words
        words = (max(ranks.values()) >> 6) + 1
        self._buckets: dict[int, list[int]] = {}
        self._words = [0] * words
        self._groups = [0] * ((words >> 6) + 1)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token. The queue is written out here, as calls would take most of the time."""
        get = self._ranks.get
        whole = get(piece)
        if whole is not None:
            return [whole]
        n, buckets, words, groups, top = len(piece), self._buckets, self._words, self._groups, 0
        after = list(range(1, n + 2))
        before = list(range(-1, n))
        pair = [-1] * n
        for i in range(n - 1):
            rank = get(piece[i : i + 2])
            if rank is not None:
                pair[i] = rank
                if rank in buckets:
                    buckets[rank].append(i)  # positions rise, so this is a heap
                else:
                    buckets[rank] = [i]
                    word = rank >> 6
                    words[word] |= _BIT[rank & 63]
                    groups[word >> 6] |= _BIT[word & 63]
                    top |= 1 << (word >> 6)
        while top:
            # the first bit set on each level leads to the lowest rank
            group = (top & -top).bit_length() - 1
            marks = groups[group]
            word = (group << 6) | ((marks & -marks).bit_length() - 1)
            bits = words[word]
            rank = (word << 6) | ((bits & -bits).bit_length() - 1)
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                words[word] = bits = bits & (bits - 1)
                if not bits:
                    groups[group] = marks = marks & (marks - 1)
                    if not marks:
                        top &= top - 1
            if pair[i] != rank:
                continue  # stale: the pair at this position has changed or is gone
            gone = after[i]
            end = after[gone]
            after[i] = end
            pair[gone] = pair[i] = -1
            left = before[i]
            changed = []
            if end < n:
                before[end] = i
                changed.append((i, get(piece[i : after[end]])))
            if left >= 0:
                changed.append((left, get(piece[left:end])))
            for at, new in changed:
                if new is None:
                    pair[at] = -1
                elif new != pair[at]:
                    pair[at] = new
                    if new in buckets:
                        heappush(buckets[new], at)
                    else:
                        buckets[new] = [at]
                        word = new >> 6
                        words[word] |= _BIT[new & 63]
                        groups[word >> 6] |= _BIT[word & 63]
                        top |= 1 << (word >> 6)
        ids, i = [], 0
        while i < n:
            ids.append(get(piece[i : after[i]]))
            i = after[i]
        return ids

    def _packed(self, piece: str) -> bytes:
        ids = self.merge(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers, pre-token by pre-token."""
        known = self._known.__getitem__
        return b"".join(b"".join(map(known, pieces)) for pieces in split_text(self._find, text))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Remembered(dict):
    """What a function gave for each pre-token; starts anew when it holds many."""

    def __init__(self, made_by: Callable[[str], bytes]):
        super().__init__()
        self._made_by = made_by

    def __missing__(self, piece: str) -> bytes:
        made = self._made_by(piece)
        if len(piece) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = made
        return made


def split_text(find: regex.Pattern, text: str) -> Iterator[list[str]]:
    """All matches of the split pattern, in lists; a very long text never becomes one list."""
    if len(text) <= _LONG_TEXT:
        yield find.findall(text)
        return
    matches = (m[0] for m in find.finditer(text))
    while pieces := list(islice(matches, _LONG_TEXT // 8)):
        yield pieces


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def bpe(path: str, pattern: str) -> Bpe:
    """One encoder per worker process; the rank file lies at the same path on every machine."""
    return Bpe(read_ranks(path), pattern)


def encode_documents(df: DataFrame, ranks_path: str, pattern: str, text: Column | None = None) -> DataFrame:
    """(doc_id, ids, decoded): ids as packed 32-bit integers, and the bytes they decode to.

    A null or empty text has no ids; a null doc_id is kept; repeated rows are encoded each; other
    columns are ignored. An empty table gives no rows.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(ranks_path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = [coder.encode(t) for t in part.column("text").to_pylist()]
                decoded = [coder.decode(i) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                    ["doc_id", "ids", "decoded"],
                )

    text = F.col("text") if text is None else text
    return df.select("doc_id", F.coalesce(text, F.lit("")).alias("text")).transform(
        by_batch, encode, "doc_id long, ids binary, decoded binary"
    )


def encoding_digests(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), digested where the ids are made."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(ranks_path, pattern)
        for batch in batches:
            counts, id_hex, text_hex = [], [], []
            for text in batch.column("text"):
                ids = coder.encode(text.as_py())
                counts.append(len(ids) // 4)
                id_hex.append(hashlib.sha256(ids).hexdigest())
                text_hex.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_hex), pa.array(text_hex)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).transform(
        by_batch, digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
