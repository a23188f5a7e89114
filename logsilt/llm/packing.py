"""Best-two-fit packing of token sequences into as few bins as it can.

Bins depend on lengths only, so the greedy fill and the exchange of a bin's smallest document for two
unpacked ones work on the histogram of lengths, which has at most ``capacity`` entries at any size of
the corpus. A filling found once is used as often as the counts allow. Documents are then numbered
within their length by Spark and looked up in the list of fillings.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logsilt.llm.bpe import split_text
from logsilt.llm.common import by_batch, written

CAPACITY = 1024
END_ID = 2


def _tightest_pair(lengths: list[int], left: Counter, low: int, high: int) -> tuple[int, int] | None:
    """Two available lengths with the largest sum in (low, high]; sorted ``lengths``."""
    i, j = 0, bisect_right(lengths, high) - 1
    best, found = low, None
    while i <= j:
        both = lengths[i] + lengths[j]
        if both > high or (i == j and left[lengths[i]] < 2):
            j -= 1
            continue
        if both > best:
            best, found = both, (lengths[j], lengths[i])
        i += 1
    return found


def fill_bin(counts: Counter, lengths: list[int], capacity: int) -> list[int]:
    """Lengths of one bin: greedy, longest first, then the smallest one gives way to two others as
    long as they fill its place and the gap more tightly. ``lengths`` are those available, sorted.
    """
    left = Counter()  # what the bin has taken, negative
    available = lambda n: counts[n] + left[n]
    inside: list[int] = []
    gap = capacity

    def greedy() -> None:
        nonlocal gap
        at = bisect_right(lengths, gap) - 1
        while gap and at >= 0:
            n = lengths[at]
            take = min(available(n), gap // n)
            if take:
                inside.extend([n] * take)
                left[n] -= take
                gap -= n * take
            at = min(at - 1, bisect_right(lengths, gap) - 1)

    greedy()
    while gap and len(inside) > 1:
        smallest = min(inside)
        open_lengths = [n for n in lengths[: bisect_right(lengths, gap + smallest)] if available(n) > 0]
        pair = _tightest_pair(open_lengths, Counter({n: available(n) for n in open_lengths}), smallest, gap + smallest)
        if pair is None:
            break
        inside.remove(smallest)
        left[smallest] += 1
        for n in pair:
            inside.append(n)
            left[n] -= 1
        gap += smallest - sum(pair)
    return sorted(inside, reverse=True)


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(how often, lengths) of every filling; together they use up the histogram."""
    counts = Counter({n: c for n, c in histogram.items() if c})
    lengths = sorted(counts)
    plan = []
    while lengths:
        inside = fill_bin(counts, lengths, capacity)
        used = Counter(inside)
        times = min(counts[n] // k for n, k in used.items())
        plan.append((times, inside))
        for n, k in used.items():
            counts[n] -= k * times
        lengths = [n for n in lengths if counts[n]]
    return plan


def places(plan: list[tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: where runs of document numbers start, their first bin, their offset in the bin."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    taken: Counter = Counter()
    first = 0
    for times, inside in plan:
        at = 0
        for n in inside:
            runs.setdefault(n, []).append((taken[n], first, at))
            taken[n] += times
            at += n
        first += times
    return {n: tuple(np.array(c, np.int64) for c in zip(*r, strict=True)) for n, r in runs.items()}


def byte_ranks(tokenizer: Tokenizer) -> dict[bytes, int]:
    """Token bytes to id for a byte-level tokenizer, without its special tokens.

    Its vocabulary writes bytes as characters: printable Latin-1 ones as themselves, the others, in
    order, as those from U+0100 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    of_char = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    return {bytes(of_char[c] for c in token): i for token, i in vocabulary.items() if token not in special}


class _Ids:
    """Ids of whole texts by the tokenizer file.

    Its vocabulary is a byte-level BPE whose ids rise in the order of its merges, so they are ranks
    that tiktoken encodes by, to the same ids in a quarter of the time. Texts with stretches of white
    space that its pattern engine gives up on go through the tokenizer, one match of the pattern at a
    time: merges never cross these. Texts that hold one of the file's added tokens go through it whole.
    """

    def __init__(self, path: str, pattern: str):
        self._tokenizer = Tokenizer.from_file(path)
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._find = regex.compile(pattern)
        self._fast = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=byte_ranks(self._tokenizer), special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if any(token in text for token in self._added):
            return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        try:
            return self._fast.encode_to_numpy(text, disallowed_special=()).astype("<u4")
        except ValueError:
            pieces = chain.from_iterable(split_text(self._find, text))
            ids = [i for p in pieces for i in self._tokenizer.encode(p, add_special_tokens=False).ids]
            return np.array(ids, "<u4")


@lru_cache(maxsize=2)
def _ids(path: str, pattern: str) -> _Ids:
    return _Ids(path, pattern)


def _cut(capacity: int, end_id: int, path: str, pattern: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _ids(path, pattern)
        end = np.array([end_id], "<u4")
        seen: Counter = Counter()  # pieces of each length in this task so far
        for batch in batches:
            rows: dict[str, list] = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32", "task", "nth")}
            for doc_id, task, text in zip(*(batch.column(c) for c in ("doc_id", "task", "text")), strict=True):
                ids = np.concatenate([coder.encode(text.as_py()), end])
                # only the first piece is shorter
                stops = range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)
                start = 0
                for piece, stop in enumerate(stops):
                    length = stop - start
                    values = (doc_id.as_py(), piece, start, length, zlib.crc32(ids[start:stop].tobytes()), task.as_py(), seen[length])
                    for column, value in zip(rows.values(), values, strict=True):
                        column.append(value)
                    seen[length] += 1
                    start = stop
            yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in rows.items()})

    return cut


def cut_documents(
    df: DataFrame, tokenizer_path: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens; ``nth`` counts pieces of a length within a task."""
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.spark_partition_id().cast("long").alias("task"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).transform(
        by_batch, _cut(capacity, end_id, tokenizer_path, pattern),
        "doc_id long, piece long, start long, length long, ids_crc32 long, task long, nth long",
    )


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces that have (length, task, nth); drops task and nth.

    (length, task, nth) must name a piece, so ``pieces`` is to be a written table.
    """
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    # one row per task and length: what the tasks before hold of the length
    offsets = counts.withColumn(
        "before",
        F.coalesce(
            F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).select("length", "task", "before")
    # at most ``capacity`` rows
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    found = places(plan_bins(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for n in np.unique(length):
                mine = length == n
                starts, first, at = found[int(n)]
                run = np.searchsorted(starts, number[mine], "right") - 1
                sequence[mine] = first[run] + number[mine] - starts[run]
                offset[mine] = at[run]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    numbered = pieces.join(offsets, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("number")
    )
    return numbered.transform(
        by_batch, place, "doc_id long, piece long, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def pack_documents(
    df: DataFrame, tokenizer_path: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of ``df``.

    A null or empty text is one piece that holds the end id alone. A null doc_id is kept and repeated
    rows are packed each; other columns are ignored. An empty table gives no rows.
    """
    return pack_pieces(written(cut_documents(df, tokenizer_path, pattern, capacity, end_id), "pieces"), capacity)
