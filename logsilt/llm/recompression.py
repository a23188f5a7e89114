"""Substring dedup by recompression: words that stand in a window seen earlier are removed.

A text's words are named by fingerprint and then compressed in rounds: the first names maximal runs of
one word, each further one names pairs, where a bit of every name says whether it may open a pair or
close one. Names are fingerprints of what they stand for, so they mean the same everywhere and a round
needs no table of names. Whether two neighbours merge depends on these two alone, so equal substrings
get the same interior symbols; every symbol carries the stretch of words that decides it.

A window of words is known by its anchor, one of the highest symbols that the window's words alone
decide: equal windows have the same anchor in the same place. Neighbouring windows with one anchor are a
block. Spark then works in two rounds over what stands where first:

1. Blocks, one row per some windows, meet by their anchor and are named by all their words. A block that
   stands earlier too is a repeat with all its windows; long copies are settled here. An anchor with one
   block left has nothing more to compare.
2. Windows can only repeat between different blocks of one anchor; these are named one by one.

Names are compared as 128 bits, the fingerprint of the anchor's words and another one of all words. A
task settles repeats among its own rows first, so a name that is everywhere sends a row per some hundred
thousand rows, not one per document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsilt.llm.common import BROADCAST_ROWS, by_batch, written

#: Words of a window.
WIDTH = 20
#: Rounds of pairs after the round of runs. More rounds give longer anchors, until none fits a window.
ROUNDS = 3

# Bytes of text that are compressed at once, and rows a task holds before it settles them.
_SLICE_BYTES = 2 << 20
_PENDING_ROWS = 1 << 20

_ODD = tuple(np.array([x], np.uint64) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_ROWS = "oid long, dk long, start int, stop int, anchor long, name long, kind byte"
# What a row is: a block to compare, a span that stands earlier, a block whose windows are to be compared,
# a mark that an anchor has several blocks.
OPEN, AGAIN, SUSPECT, MARK = range(4)
# Blocks under one anchor, among the rows a task settles at once, that go on by themselves.
_CROWD = 16


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A fingerprint of two fingerprints; order matters."""
    x = a * _ODD[0] + b * _ODD[1]
    x ^= x >> np.uint64(32)
    x *= _ODD[2]
    x ^= x >> np.uint64(29)
    return x


class Words(NamedTuple):
    """The words of some texts, one after the other, as two lanes of fingerprints."""

    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray
    doc: np.ndarray


def fingerprints(texts: pa.Array) -> Words:
    """Fingerprints of the words of texts; words are what ASCII white space separates."""
    parts = pc.ascii_split_whitespace(texts)
    words, doc = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.not_equal(words, "")
    coded = words.filter(real).dictionary_encode()
    doc = doc.filter(real).to_numpy().astype(np.int64)
    hashed = b"".join(xxhash.xxh3_128_digest(w.as_buffer()) for w in coded.dictionary)
    lanes = np.frombuffer(hashed, np.uint64).reshape(-1, 2)[coded.indices.to_numpy()]
    return Words(lanes[:, 0].copy(), lanes[:, 1].copy(), np.bincount(doc, minlength=len(texts)), doc)


class Level(NamedTuple):
    """Symbols of one round: name, text, and the words ``[low, high)`` that decide the symbol."""

    name: np.ndarray
    doc: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _runs(words: Words) -> Level:
    """Maximal runs of one word. The words beside a run decide that it ends; where a text ends, nothing
    does, which the place beside it, outside of the text, says."""
    place = np.arange(len(words.doc) + 1)
    opens = np.ones(len(words.doc), bool)
    opens[1:] = (words.first[1:] != words.first[:-1]) | (words.doc[1:] != words.doc[:-1])
    start = np.flatnonzero(opens)
    stop = np.append(start[1:], place[-1])
    name, length = words.first[start], (stop - start).astype(np.uint64)
    name = np.where(length > 1, _mix(name, length), name)
    return Level(name, words.doc[start], start - 1, stop + 1)


def _pairs(level: Level, number: int) -> Level:
    """One round of pairs: a name that opens and the one behind it that closes become one symbol."""
    name, doc, low, high = level
    opens = (name >> np.uint64(5 * number % 61)) & np.uint64(1) == 1
    beside = doc[1:] == doc[:-1]
    merged = np.zeros(len(name), bool)
    merged[:-1] = opens[:-1] & ~opens[1:] & beside
    closed = np.zeros(len(name), bool)
    closed[1:] = merged[:-1]
    # a symbol that stays alone was decided by the neighbour it could have merged with as well
    alone_close, alone_open = ~opens & ~closed, opens & ~merged
    named, lows, highs = name.copy(), low.copy(), high.copy()
    at = np.flatnonzero(merged)
    named[at] = _mix(name[at], name[at + 1])
    highs[at] = high[at + 1]
    at = np.flatnonzero(alone_close[1:] & beside) + 1
    lows[at] = low[at - 1]
    at = np.flatnonzero(alone_open[:-1] & beside)
    highs[at] = high[at + 1]
    kept = ~closed
    return Level(named[kept], doc[kept], lows[kept], highs[kept])


def levels(words: Words, rounds: int = ROUNDS) -> list[Level]:
    found = [_runs(words)]
    for number in range(rounds):
        found.append(_pairs(found[-1], number))
    return found


class Stretches(NamedTuple):
    """Fingerprints of every 1, 2, 4, ... words that follow each other, whatever texts they are in."""

    lanes: list[np.ndarray]

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Fingerprints of stretches of any length up to twice the longest one kept."""
        size = (stop - start).astype(np.int64)
        step = np.minimum(np.frexp(size)[1] - 1, len(self.lanes) - 1)
        named = np.empty(len(start), np.uint64)
        for k in np.unique(step):
            at = np.flatnonzero(step == k)
            lane = self.lanes[k]
            named[at] = _mix(lane[start[at]], lane[stop[at] - (1 << int(k))])
        return _mix(named, size.view(np.uint64))


def stretches(lane: np.ndarray, width: int = WIDTH) -> Stretches:
    lanes = [lane]
    while 2 << len(lanes) - 1 <= width and len(lanes[-1]) > 1 << len(lanes) - 1:
        size = 1 << len(lanes) - 1
        lanes.append(_mix(lanes[-1][:-size], lanes[-1][size:]))
    return Stretches(lanes)


def window_starts(words: Words, width: int = WIDTH) -> np.ndarray:
    """Places where a window of one text starts."""
    ends = np.cumsum(words.counts)[words.doc]
    return np.flatnonzero(np.arange(len(words.doc)) + width <= ends)


def anchors(
    words: Words, starts: np.ndarray, named: Stretches, width: int = WIDTH, rounds: int = ROUNDS
) -> tuple[np.ndarray, np.ndarray]:
    """Name and number of every window's anchor.

    Of the highest round that has any, the symbol of smallest name (then the leftmost) whose deciding
    words lie in the window, named by these words; if no round has one, the window itself.
    """
    names, numbers = np.empty(len(starts), np.uint64), starts.astype(np.int64)
    found = levels(words, rounds)
    left = np.arange(len(starts))
    for height in range(rounds, -1, -1):
        level = found[height]
        # bounds never fall from one symbol to the next, so those inside a window follow each other
        first = np.cumsum(np.bincount(level.low + 1, minlength=len(words.doc) + 1))[starts[left]]
        last = np.cumsum(np.bincount(level.high, minlength=len(words.doc) + 2))[starts[left] + width] - 1
        some = last >= first
        hit, first, last = left[some], first[some], last[some]
        best = _smallest(level.name, first, last)
        names[hit] = _mix(named.of(level.low[best], level.high[best]), np.array([height + 1], np.uint64))
        numbers[hit] = (height + 1) * (len(words.doc) + 1) + best
        left = left[~some]
    names[left] = named.of(starts[left], starts[left] + width)
    return names, numbers


def _smallest(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Place of the smallest value, then the leftmost, in each range ``first`` to ``last``."""
    step = np.frexp(last - first + 1)[1] - 1
    best, place = np.empty(len(first), np.int64), np.arange(len(values))
    for k in range(int(step.max(initial=0)) + 1):
        at = np.flatnonzero(step == k)
        one, two = place[first[at]], place[last[at] - (1 << k) + 1]
        best[at] = np.where(values[one] <= values[two], one, two)
        one, two = place[: max(len(place) - (1 << k), 0)], place[1 << k :]
        place = np.where(values[one] <= values[two], one, two)
    return best


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, base + _SLICE_BYTES, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def _merge_spans(oid: np.ndarray, dk: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of each document, with those that touch or overlap joined. Spans of a kind have starts and
    stops in the same order."""
    order = np.lexsort((stop, start, dk, oid))
    oid, dk, start, stop = oid[order], dk[order], start[order], stop[order]
    fresh = np.ones(len(oid), bool)
    fresh[1:] = (oid[1:] != oid[:-1]) | (dk[1:] != dk[:-1]) | (start[1:] > stop[:-1])
    last = np.append(np.flatnonzero(fresh)[1:], len(oid)) - 1
    return oid[fresh], dk[fresh], start[fresh], stop[last] if len(oid) else stop


def _settled(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows of a task: those that stand earlier among them as spans, of the others the first of a name.

    An anchor with many blocks here has several for certain. They need not meet by their anchor any
    more, so that no anchor gathers more than some rows a task: a mark tells the anchor's other blocks.
    """
    order = np.lexsort((rows["start"], rows["oid"], rows["name"], rows["anchor"]))
    rows = {name: values[order] for name, values in rows.items()}
    anchor, name, oid, start, dk = (rows[column] for column in ("anchor", "name", "oid", "start", "dk"))
    other = np.ones(len(name), bool)
    other[1:] = anchor[1:] != anchor[:-1]
    fresh = other.copy()
    fresh[1:] |= name[1:] != name[:-1]
    head = np.maximum.accumulate(np.where(fresh, np.arange(len(name)), 0))
    again = (oid != oid[head]) | (start != start[head])
    # one row listed twice is one row; two texts of one id are two
    listed = np.zeros(len(name), bool)
    listed[1:] = ~fresh[1:] & ~again[1:] & (dk[1:] == dk[:-1])
    spans = _merge_spans(oid[again], dk[again], start[again], rows["stop"][again])
    if len(spans[0]):
        # anchors that are the spans' own, so that they spread
        own = _mix(_mix(spans[0].view(np.uint64), spans[1].view(np.uint64)), spans[2].astype(np.uint64)).view(np.int64)
        yield _batch(*spans, own, own, AGAIN)
    kept = ~again & ~listed
    group = np.cumsum(other) - 1
    crowded = np.bincount(group, weights=fresh)[group] > _CROWD
    for some, kind in ((kept & ~crowded, OPEN), (kept & crowded, SUSPECT), (other & crowded, MARK)):
        if some.any():
            columns = [rows[column][some] for column in ("oid", "dk", "start", "stop", "anchor", "name")]
            if kind == SUSPECT:
                columns[4] = columns[5]
            yield _batch(*columns, kind)


def _batch(oid, dk, start, stop, anchor, name, kind: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "oid": pa.array(oid, pa.int64()), "dk": pa.array(dk, pa.int64()),
        "start": pa.array(start.astype(np.int32)), "stop": pa.array(stop.astype(np.int32)),
        "anchor": pa.array(anchor, pa.int64()), "name": pa.array(name, pa.int64()),
        "kind": pa.array(np.full(len(oid), kind, np.int8)),
    })


def _collected(parts: Iterator[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    pending, size = [], 0
    for part in parts:
        pending.append(part)
        size += len(part["name"])
        if size >= _PENDING_ROWS:
            yield from _settled({name: np.concatenate([p[name] for p in pending]) for name in pending[0]})
            pending, size = [], 0
    if size:
        yield from _settled({name: np.concatenate([p[name] for p in pending]) for name in pending[0]})


def _rows(
    batch: pa.RecordBatch, words: Words, first: np.ndarray, last: np.ndarray, width: int, anchor: np.ndarray, name: np.ndarray
) -> dict[str, np.ndarray]:
    """Names and places of stretches from the window at ``first`` to the window at ``last``."""
    base = np.cumsum(words.counts) - words.counts
    doc = words.doc[first]
    return {
        "oid": batch.column("oid").to_numpy()[doc], "dk": batch.column("dk").to_numpy()[doc],
        "start": first - base[doc], "stop": last - base[doc] + width,
        "anchor": anchor.view(np.int64), "name": name.view(np.int64),
    }


def _block_rows(width: int, rounds: int) -> Callable:
    """Blocks of all texts, under their anchors, named by all their words."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        for batch in batches:
            for part in _slices(batch):
                words = fingerprints(part.column("text"))
                starts = window_starts(words, width)
                if not len(starts):
                    continue
                anchor, number = anchors(words, starts, stretches(words.first, width), width, rounds)
                opens = np.ones(len(starts), bool)
                opens[1:] = (number[1:] != number[:-1]) | (words.doc[starts[1:]] != words.doc[starts[:-1]])
                at = np.flatnonzero(opens)
                first, last = starts[at], starts[np.append(at[1:], len(starts)) - 1]
                # the first and the last window have all words of a block, as both hold its anchor
                window = stretches(words.second, width)
                name = _mix(window.of(first, first + width), window.of(last, last + width))
                name = _mix(name, (last - first).astype(np.uint64))
                yield _rows(part, words, first, last, width, anchor[at], name)

    return lambda batches: _collected(parts(batches))


def _window_rows(width: int) -> Callable:
    """Single windows within the stretches named in ``spans``, under one fingerprint, named by another."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        for batch in batches:
            for part in _slices(batch):
                words = fingerprints(part.column("text"))
                base = np.cumsum(words.counts) - words.counts
                spans = part.column("spans")
                inner, doc = pc.list_flatten(spans), pc.list_parent_indices(spans).to_numpy()
                start = inner.field("start").to_numpy() + base[doc]
                size = inner.field("stop").to_numpy() + base[doc] - width + 1 - start
                place = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
                one, two = (stretches(lane, width).of(place, place + width) for lane in words[:2])
                yield _rows(part, words, place, place, width, one, two)

    return lambda batches: _collected(parts(batches))


def _keyed(docs: DataFrame, doc_id: str, text: str, *others: Column) -> DataFrame:
    """``oid, dk, text``: the id, null behind all others, and a hash that tells texts of one id apart."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    oid = F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1))
    return docs.select(*others, oid.alias("oid"), F.xxhash64(value).alias("dk"), value.alias("text"))


def _judged(rows: DataFrame) -> DataFrame:
    """Spans that stand earlier too (kind AGAIN), and blocks whose anchor has others (SUSPECT).

    Rows are dealt by anchor once, which serves both windows.
    """
    by_name, by_anchor = Window.partitionBy("anchor", "name"), Window.partitionBy("anchor")
    place = F.struct("oid", "start")
    return (
        rows.repartition("anchor").withColumn("again", (F.col("kind") == OPEN) & (place > F.min(F.when(F.col("kind") == OPEN, place)).over(by_name)))
        .withColumn("several", (F.min("name").over(by_anchor) != F.max("name").over(by_anchor)) | (F.max(F.col("kind") == MARK).over(by_anchor)))
        .withColumn("kind", F.when(F.col("again"), AGAIN).when((F.col("kind") == OPEN) & F.col("several"), SUSPECT).otherwise(F.col("kind")))
        .where(F.col("kind").isin(AGAIN, SUSPECT))
        .select("oid", "dk", "start", "stop", "kind")
    )


def _per_doc(spans: DataFrame) -> DataFrame:
    """``oid, dk, spans``: the spans of each document in order, those that touch or overlap as one."""
    def joined(found: Column, span: Column) -> Column:
        last = F.get(found, F.size(found) - 1)
        apart = (F.size(found) == 0) | (span["start"] > last["stop"])
        wider = F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))
        return F.when(apart, F.array_append(found, span)).otherwise(
            F.array_append(F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0))), wider)
        )

    none = F.expr("CAST(array() AS array<struct<start: int, stop: int>>)")
    sorted_spans = F.array_sort(F.collect_list(F.struct("start", "stop")))
    return spans.groupBy("oid", "dk").agg(F.aggregate(sorted_spans, none, joined).alias("spans"))


def _with_spans(docs: DataFrame, per_doc: DataFrame, how: str) -> DataFrame:
    """Documents with an array of their spans. If all spans are few, by a count, texts need not move."""
    some = per_doc.select(F.explode("spans")).limit(BROADCAST_ROWS + 1)
    few = some.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(per_doc) if few else per_doc, ["oid", "dk"], how)


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, rounds: int = ROUNDS) -> DataFrame:
    """``oid, dk, spans``: of each document that has any, the stretches of words whose windows all stand
    earlier too, as an array of ``start, stop`` in words.

    ``oid`` is the id (null: the largest long) and ``dk`` Spark's xxhash64 of the text (null: empty).
    """
    keyed = _keyed(docs, doc_id, text)
    blocks = written(_judged(by_batch(keyed, _block_rows(width, rounds), _ROWS)), "repeat_blocks")
    suspects = _with_spans(keyed, written(_suspects(blocks), "repeat_suspects"), "inner")
    windows = _judged(by_batch(suspects, _window_rows(width), _ROWS))
    spans = [rows.where(F.col("kind") == AGAIN).select("oid", "dk", "start", "stop") for rows in (blocks, windows)]
    return written(_per_doc(spans[0].unionByName(spans[1])), "repeat_spans")


def _suspects(blocks: DataFrame) -> DataFrame:
    """Blocks whose windows are to be named, per document. They hold windows that no other block has, so
    they are not joined: a window across two blocks is in neither."""
    spans = F.array_sort(F.collect_set(F.struct("start", "stop")))
    return blocks.where(F.col("kind") == SUSPECT).groupBy("oid", "dk").agg(spans.alias("spans"))


def _stripped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, counts, removed = [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans")):
            words = text.as_buffer().to_pybytes().split()
            rest, place = [], 0
            for span in spans.as_py() or ():
                rest += words[place : span["start"]]
                place = max(place, span["stop"])
            rest += words[place:]
            kept.append(b" ".join(rest))
            counts.append(len(words))
            removed.append(len(words) - len(rest))
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "text": pa.array(kept, pa.binary()).cast(pa.string()),
            "n_words": pa.array(counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "spans": batch.column("spans"),
        })


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, rounds: int = ROUNDS) -> DataFrame:
    """Documents without the words of any window of ``width`` words that starts earlier too, in a document
    of smaller id or earlier in the same one: ``doc_id, text, n_words, n_removed, spans``.

    ``text`` has the kept words, one space between; ``spans`` what was removed, in words. Windows are
    judged on the input. A null text has no words; texts of fewer than ``width`` words stay; a null id
    comes after all others. Rows of one id are one document: where a window starts at the same place
    in two of them, neither is earlier. So repeated rows have equal results. Other columns are ignored;
    an empty table gives no row. A text is one task's work, in memory of some times its size.
    """
    spans = repeated_spans(docs, doc_id, text, width, rounds)
    keyed = _keyed(docs, doc_id, text, F.col(doc_id).cast("long").alias("doc_id"))
    joined = _with_spans(keyed, spans, "left").select("doc_id", "text", "spans")
    kind = "doc_id long, text string, n_words long, n_removed long, spans array<struct<start:int,stop:int>>"
    return by_batch(joined, _stripped, kind)
