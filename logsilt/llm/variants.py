"""Spelling variants: words one edit apart, and the frequent form that each rare one stands for.

Spark counts the words of all texts. Two words one edit apart share all that stands before the edit and
all behind it. So a word joins, for its own length and for the next smaller one as the length of the
shorter partner, a group for every stretch its edit may lie in: the group's words have the same letters
outside of the stretch, and only their middles are compared. Stretches are halves of a word; groups that
are too large by a count are split into groups of shorter stretches, as often as it takes, and end at one
letter, where a group is bounded by the alphabet.

Within a group the sorted list of middles is scanned for all its words at once: a row of the edit
matrix, banded to one cell beside the diagonal, is computed once per prefix that neighbours in the list
share, its successors are extended from it, and the range of all words with a prefix is skipped as soon
as every cell of its row is above one edit. A pair is reported only in the stretch that holds its first
difference, so none is found twice.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsilt.llm.common import by_batch, written

#: Code points of a word and its occurrences, at least; how much more frequent a form is.
MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: One code point of a run is deleted where its checksum is a multiple of this.
DELETE_EVERY = 31

# Words of a group that are compared at once; larger groups are split into so many.
_GROUP = 20_000
_SPLIT = 4
# Rows of a task that are scanned at once, whole groups.
_CHUNK = 50_000
# Query and prefix pairs in memory, about.
_FRONTIER = 1 << 21

_UPPER, _LOWER = (bytes(range(a, a + 26)).decode() for a in (65, 97))
_KEYS = ["stem", "base", "low", "high"]
_FAR = 2


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", delete_every: int = DELETE_EVERY) -> DataFrame:
    """``word, n``: runs of letters up to U+00FF, A-Z lower-cased, with typing errors as the rule has them.

    A run's checksum, with its document's id, says whether it loses a code point and which one.
    """
    run = F.explode(F.regexp_extract_all(F.col(text), F.lit(f"[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}"), F.lit(0)))
    runs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), run.alias("run"))
    # lower() would reach accented letters, which only some runs have
    plain = F.octet_length("run") == F.char_length("run")
    low = runs.select("id", F.when(plain, F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER)).alias("run"))
    hashed = low.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.left("run", at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(F.col("h") % delete_every == 0, shorter).otherwise(F.col("run"))
    kept = hashed.select(word.alias("word")).where(F.char_length("word") >= MIN_LENGTH)
    return kept.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


def _member(before: Column, middle: Column, behind: Column, base: Column, low: Column, high: Column) -> Column:
    return F.struct(
        F.concat(before, F.lit("|"), behind).alias("stem"), base.cast("int").alias("base"), low.cast("int").alias("low"),
        high.cast("int").alias("high"), middle.alias("middle"),
    )


def _halves(vocabulary: DataFrame) -> DataFrame:
    """Every word in its groups: ``base`` is the length of the shorter word of a pair, the edit lies in
    the stretch from ``low`` to ``high`` of it, ``stem`` is what stands outside."""
    word, length = F.col("word"), F.char_length("word")
    members = []
    for base in (length, length - 1):
        half = F.floor(base / 2).cast("int")
        for low, high in ((F.lit(0), half), (half, base)):
            members.append(_member(
                F.left(word, low), F.substring(word, low + 1, length - low - (base - high)), F.right(word, base - high),
                base, low, high,
            ))
    return vocabulary.select("n", F.explode(F.array(*members)).alias("m")).select("n", "m.*")


def _shorter(groups: DataFrame) -> DataFrame:
    """The same groups by stretches of a quarter."""
    width, low = F.col("high") - F.col("low"), F.col("low")
    before, behind = F.left("stem", low), F.substring("stem", F.col("low") + 2, F.char_length("stem"))
    members = []
    for i in range(_SPLIT):
        a, b = F.floor(width * i / _SPLIT).cast("int"), F.floor(width * (i + 1) / _SPLIT).cast("int")
        rest = width - b
        members.append(F.when(b > a, _member(
            F.concat(before, F.left("middle", a)), F.substring("middle", a + 1, F.char_length("middle") - a - rest),
            F.concat(F.right("middle", rest), behind), F.col("base"), low + a, low + b,
        )))
    split = F.explode(F.array_compact(F.array(*members))).alias("m")
    return groups.select("n", split).select("n", "m.*")


def _groups(vocabulary: DataFrame, limit: int) -> DataFrame:
    """Members of groups of at most ``limit`` words, or of stretches of one letter."""
    ready, rows = [], _halves(vocabulary)
    while True:
        keyed = rows.withColumn("key", F.xxhash64(*_KEYS))
        sizes = keyed.where(F.col("high") - F.col("low") > 1).groupBy("key").agg(F.count("*").alias("words"))
        large = written(sizes.where(F.col("words") > limit).select("key"), "large_groups")
        if large.isEmpty():
            break
        ready.append(keyed.join(large, "key", "left_anti").drop("key"))
        rows = written(_shorter(keyed.join(large, "key", "left_semi").drop("key")), "split_groups")
    for other in ready:
        rows = rows.unionByName(other)
    return rows


def one_edit_pairs(text: np.ndarray, start: np.ndarray, length: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pairs of words of a group that are one edit apart, both ways, and where they first differ.

    Words are sorted in their groups, all different; word i is ``text[start[i]:][:length[i]]``.
    """
    query = np.arange(len(start))
    found = []
    heads = np.ones(len(start), bool)
    heads[1:] = group[1:] != group[:-1]
    sizes = np.bincount(np.cumsum(heads) - 1)[np.cumsum(heads) - 1]
    # so many queries at once as their groups' lists have room for
    turn = np.cumsum(np.minimum(sizes, 128)) // _FRONTIER
    for number in range(int(turn[-1]) + 1 if len(turn) else 0):
        found.append(_scan(text, start, length, heads, query[turn == number]))
    return tuple(np.concatenate(parts) for parts in zip(*found)) if found else (query,) * 3


def _scan(text: np.ndarray, start: np.ndarray, length: np.ndarray, heads: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, ...]:
    """All prefixes of the sorted lists, one letter longer at a time, with the queries near them.

    ``left``, ``diagonal`` and ``right`` are the cells of a prefix of d letters at d-1, d and d+1
    letters of the query; cells beyond the band or the query are far.
    """
    rows, fresh = np.arange(len(start)), heads.copy()
    first = np.flatnonzero(fresh)
    node = (np.cumsum(heads) - 1)[query]
    left = np.full(len(query), _FAR, np.uint8)
    diagonal = np.zeros(len(query), np.uint8)
    right = np.where(length[query] > 0, 1, _FAR).astype(np.uint8)
    differ = np.full(len(query), -1, np.int32)
    found, depth = [], 0
    padded = np.append(text, np.uint8(0))
    while len(query):
        # a word that ends here is the first one of its prefix
        end = rows[first]
        word = end[node]
        beyond = length[query] - depth
        cell = np.where(beyond == 0, diagonal, np.where(beyond == 1, right, np.where(beyond == -1, left, _FAR)))
        hit = (length[word] == depth) & (cell == 1)
        if hit.any():
            found.append((query[hit], word[hit], np.where(differ[hit] < 0, depth, differ[hit])))

        # prefixes of one more letter: where a word has another letter here than the word before it
        letter = padded[np.where(length[rows] > depth, start[rows] + depth, len(text))]
        fresh[1:] |= letter[1:] != letter[:-1]
        alive = letter > 0
        opens = fresh & alive
        before = np.concatenate(([0], np.cumsum(opens)))
        bounds = np.append(first, len(rows))
        low, high = before[bounds[node]], before[bounds[node + 1]]
        letters = letter[opens]

        count = high - low
        parent = np.repeat(np.arange(len(query)), count)
        node = np.arange(len(parent)) - np.repeat(np.cumsum(count) - count - low, count)
        query = query[parent]
        seen = letters[node]
        near = [_other(padded, start, length, query, depth + i, seen) for i in (-1, 0, 1)]
        a, z, b = left[parent], diagonal[parent], right[parent]
        left = np.minimum(np.minimum(z + 1, a + near[0]), _FAR).astype(np.uint8)
        diagonal = np.minimum(np.minimum(np.minimum(b, left) + 1, z + near[1]), _FAR).astype(np.uint8)
        right = np.minimum(np.minimum(diagonal + 1, b + near[2]), _FAR).astype(np.uint8)
        rest = length[query] - depth
        left[rest < 0] = _FAR
        diagonal[rest < 1] = _FAR
        right[rest < 2] = _FAR
        differ = np.where((z == 0) & (diagonal > 0), depth, differ[parent])
        kept = np.minimum(np.minimum(left, diagonal), right) < _FAR
        query, node, left, diagonal, right, differ = (x[kept] for x in (query, node, left, diagonal, right, differ))

        rows, fresh = rows[alive], opens[alive]
        first = np.flatnonzero(fresh)
        depth += 1
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(parts) for parts in zip(*found))


def _other(padded: np.ndarray, start: np.ndarray, length: np.ndarray, query: np.ndarray, at: int, seen: np.ndarray) -> np.ndarray:
    """1 where a query has another letter than the one seen, or none."""
    inside = (length[query] > at) & (at >= 0)
    return (padded[np.where(inside, start[query] + at, len(padded) - 1)] != seen).astype(np.uint8)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted members, the number of words near each one and the most frequent of them, per group."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows < _CHUNK:
            continue
        last = np.flatnonzero(_opens(held))[-1]
        if last:
            yield from _chunk_near(held.slice(0, last))
            held = held.slice(last)
    if held is not None and held.num_rows:
        yield from _chunk_near(held)


def _opens(table: pa.Table) -> np.ndarray:
    opens = np.ones(table.num_rows, bool)
    for name in _KEYS:
        values = table[name].combine_chunks()
        opens[1:] &= pc.equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
    opens[1:] = ~opens[1:]
    return opens


def _chunk_near(table: pa.Table) -> Iterator[pa.RecordBatch]:
    opens = _opens(table)
    group = np.cumsum(opens) - 1
    several = np.bincount(group)[group] > 1
    if not several.any():
        return
    table, group = table.filter(pa.array(several)), group[several]
    middles = table["middle"].to_pylist()
    length = np.fromiter(map(len, middles), np.int64, len(middles))
    text = np.frombuffer("".join(middles).encode("latin-1"), np.uint8)
    query, other, differ = one_edit_pairs(text, np.cumsum(length) - length, length, group)
    base, low, high, n = (table[name].to_numpy() for name in ("base", "low", "high", "n"))
    size = low + length + base - high
    wide = (high - low)[query]
    # pairs of this base, in the stretch that holds their first difference
    own = (np.minimum(size[query], size[other]) == base[query]) & ((differ < wide) | ((high == base)[query] & (differ == wide)))
    query, other = query[own], other[own]
    stems = table["stem"].to_pylist()

    def spelt(i: int) -> str:
        return stems[i][: low[i]] + middles[i] + stems[i][low[i] + 1 :]

    best: dict[int, list] = {}
    for q, o in zip(query.tolist(), other.tolist()):
        near = (-int(n[o]), spelt(o))
        entry = best.setdefault(q, [0, near])
        entry[0] += 1
        if near < entry[1]:
            entry[1] = near
    if best:
        yield pa.RecordBatch.from_pydict({
            "word": pa.array([spelt(q) for q in best], pa.string()),
            "n": pa.array([int(n[q]) for q in best], pa.int64()),
            "n_near": pa.array([entry[0] for entry in best.values()], pa.int64()),
            "best": pa.array(
                [{"less": entry[1][0], "near": entry[1][1]} for entry in best.values()],
                pa.struct([("less", pa.int64()), ("near", pa.string())]),
            ),
        })


def near_words(vocabulary: DataFrame, group_limit: int = _GROUP) -> DataFrame:
    """``word, n, n_near, near, near_n``: how many words are one edit away, and the most frequent one."""
    members = _groups(vocabulary, group_limit).repartition(*_KEYS).sortWithinPartitions(*_KEYS, "middle")
    kind = "word string, n long, n_near long, best struct<less: long, near: string>"
    found = by_batch(members.select(*_KEYS, "middle", "n"), _near, kind)
    alone = vocabulary.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("struct<less: long, near: string>").alias("best"))
    # struct order: the largest count, then the word that comes first
    merged = found.unionByName(alone).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return merged.select("word", "n", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def _roots(forms: DataFrame, largest: int) -> DataFrame:
    """``word, root`` of words that have a form, by doubling the way each round goes. A form is ``RATIO``
    times as frequent as its word, so the largest count bounds the way."""
    way = max(int(math.log(max(largest, 1) / MIN_COUNT, RATIO) + 1e-9), 1)
    jumps = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(way))):
        onward = jumps.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        jumps = written(jumps.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")), "roots")
    return jumps


def group_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group_limit: int = _GROUP) -> DataFrame:
    """Every word with its form and root: ``word, form, root, n, n_near, form_n``.

    Two words are near if they differ by one inserted, deleted or replaced code point. A word's form is
    the most frequent word near it (then the first in code-point order), if that is ``RATIO`` times as
    frequent; its root is the last of the forms that follow. A null text has no words, a null id counts
    as the empty string, repeated rows count each, other columns are ignored, an empty table or one
    without such words gives no row. A word of any length is compared whole.
    """
    vocabulary = written(words(docs, doc_id, text), "vocabulary")
    near = near_words(vocabulary, group_limit)
    formed = F.col("near_n") >= RATIO * F.col("n")
    forms = written(near.select(
        "word", "n", "n_near", F.when(formed, F.col("near")).alias("form"), F.when(formed, F.col("near_n")).alias("form_n")
    ), "forms")
    largest = vocabulary.agg(F.max("n")).first()[0] or 0
    roots = _roots(forms.where("form IS NOT NULL"), largest)
    joined = forms.join(roots, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
