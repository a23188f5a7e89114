"""Source divergence audit: how far the sources of a language are apart in the terms they use.

Tasks count terms with Arrow alone: ``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode`` and
the hash ``group_by``, slice by slice, merged before they leave the task. Spark sums these partial counts
by (language, term), which also gives the documents a term is in, and keeps the terms that enough
documents have. The distance of two sources sums over all kept terms, most of which a small source
lacks; so kept counts go into columnar shards of some terms each, a shard fills the gaps with the share
of a count of zero and sums the distances of all its source pairs, and Spark adds up the shards.

Shares are whole billionths, ``1 + floor(10^9 (count + 5) / (total + 5 V))``, in decimals that do not
overflow, so every figure is exact and does not depend on how rows are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsilt.llm.common import by_batch, on_path, written

#: What separates terms, after lower-casing: all of ASCII but letters.
BREAKS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents of a language that a kept term is in, at least.
MIN_DOCS = 30
#: Added to every count, and the unit of a share.
PRIOR, UNIT = 5, 1_000_000_000

# Bytes of text that are split at once, and rows of partial counts a task holds before it lets go.
_SLICE_BYTES = 8 << 20
_PENDING_ROWS = 1 << 20
# Kept counts of a shard (their number grows with the vocabulary), sources of a block, terms in memory.
_SHARD_ROWS = 100_000
_BLOCK = 128
_CHUNK = 4096

_COUNTS = "lang string, source string, term string, n bigint, docs bigint"
_KEYS = ["lang", "source", "term"]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``_SLICE_BYTES`` of text; one text is never cut."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, base + _SLICE_BYTES, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def _slice_counts(batch: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents per (lang, source, term) of one slice."""
    parts = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), pattern=BREAKS)
    terms, doc = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.not_equal(terms, "")
    coded = terms.filter(real).dictionary_encode()
    in_doc = pa.table({"doc": doc.filter(real), "term": coded.indices}).group_by(["doc", "term"]).aggregate([([], "count_all")])
    lang, source = (batch.column(name).dictionary_encode() for name in ("lang", "source"))
    summed = pa.table({
        "lang": lang.indices.take(in_doc["doc"]),
        "source": source.indices.take(in_doc["doc"]),
        "term": in_doc["term"],
        "n": in_doc["count_all"],
    }).group_by(_KEYS).aggregate([("n", "sum"), ("n", "count")])
    return pa.table({
        "lang": lang.dictionary.take(summed["lang"]),
        "source": source.dictionary.take(summed["source"]),
        "term": coded.dictionary.take(summed["term"]),
        "n": summed["n_sum"].cast(pa.int64()),
        "docs": summed["n_count"].cast(pa.int64()),
    })


def _merged(tables: list[pa.Table]) -> pa.Table:
    summed = pa.concat_tables(tables).group_by(_KEYS).aggregate([("n", "sum"), ("docs", "sum")])
    return summed.select([*_KEYS, "n_sum", "docs_sum"]).rename_columns([*_KEYS, "n", "docs"])


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's rows, merged up to a bound of memory."""
    pending, rows = [], 0
    for batch in batches:
        for part in _slices(batch):
            pending.append(_slice_counts(part))
            rows += pending[-1].num_rows
            if rows < _PENDING_ROWS:
                continue
            pending = [_merged(pending)]
            rows = pending[0].num_rows
            if rows > _PENDING_ROWS // 2:
                yield from pending[0].to_batches()
                pending, rows = [], 0
    if pending:
        yield from _merged(pending).to_batches()


def _share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(UNIT (count + PRIOR) / (total + PRIOR terms))``, exact beyond 64 bits."""
    wide = "decimal(20,0)"
    over = (count + PRIOR).cast(wide) * F.lit(UNIT).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", over, (total + terms * PRIOR).cast(wide))


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, term, n, lang_n, lead`` of terms in at least ``min_docs`` documents of their
    language; ``lang_n`` counts the language, ``lead`` marks one row per (lang, term)."""
    partial = by_batch(docs, partial_counts, _COUNTS)
    # dealt by (lang, term) once: tasks have combined their own counts, and both sums need no other shuffle
    summed = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    return (
        summed.withColumns({
            "lang_n": F.sum("n").over(term),
            "lang_docs": F.sum("docs").over(term),
            "lead": F.row_number().over(term.orderBy("source")) == 1,
        })
        .where(F.col("lang_docs") >= min_docs)
        .drop("docs", "lang_docs")
    )


def _groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Every (lang, source): its count, its language's terms and count, its number there, shards."""
    langs = kept.groupBy("lang").agg(
        F.count_if("lead").alias("terms"), F.sum("n").alias("lang_total"), F.ceil(F.count("*") / _SHARD_ROWS).alias("shards")
    )
    return (
        docs.select("lang", "source").distinct()
        .join(kept.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["total", "terms", "lang_total"]).na.fill(1, ["shards"])
        .withColumns({
            "sid": F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1,
            "sources": F.count("*").over(Window.partitionBy("lang")),
        })
    )


def _shard_sums(key: tuple[pa.Scalar, ...], shard: pa.Table) -> pa.Table:
    """What one shard adds to the distances of all source pairs of one block pair.

    Rows without a term name the sources and their share of a term they lack; shares are laid out
    densely, some thousand terms at a time. Terms that no source of the two blocks has are in no row: the
    first shard adds the distance of absent shares for all terms of the language, and each term that is
    there takes its own back.
    """
    head = shard.filter(pc.is_null(shard["term"]))
    order = np.argsort(head["sid"].to_numpy())
    sids, absent = head["sid"].to_numpy()[order], head["p"].to_numpy()[order]
    rows = shard.filter(pc.is_valid(shard["term"]))
    codes = rows["term"].combine_chunks().dictionary_encode().indices.to_numpy()
    by_term = np.argsort(codes, kind="stable")
    codes, column = codes[by_term], np.searchsorted(sids, rows["sid"].to_numpy()[by_term])
    shares = rows["p"].to_numpy()[by_term]

    first, second = key[2].as_py(), key[3].as_py()
    left, right = (np.flatnonzero(sids // _BLOCK == block) for block in (first, second))
    apart = np.abs(absent[left][:, None] - absent[right][None, :])
    sums = apart * (head["terms"][0].as_py() if key[1].as_py() == 0 else 0)
    last = int(codes[-1]) + 1 if len(codes) else 0
    for low in range(0, last, _CHUNK):
        a, b = np.searchsorted(codes, (low, low + _CHUNK))
        dense = np.tile(absent, (min(_CHUNK, last - low), 1))
        dense[codes[a:b] - low, column[a:b]] = shares[a:b]
        for i, place in enumerate(left):
            sums[i] += np.abs(dense[:, right] - dense[:, place, None]).sum(axis=0)
        sums -= apart * len(dense)
    i, j = np.nonzero(sids[left][:, None] < sids[right][None, :])
    return pa.table({
        "lang": pa.array([key[0].as_py()] * len(i), pa.string()),
        "a": pa.array(sids[left][i], pa.int32()),
        "b": pa.array(sids[right][j], pa.int32()),
        "value": pa.array(sums[i, j], pa.int64()),
    })


def _pair_distances(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, value``: the summed distance of every two sources of a language, by number."""
    def in_blocks(rows: DataFrame) -> DataFrame:
        """A row for every pair of blocks that its source's block is in; one, up to _BLOCK sources."""
        blocks = F.ceil(F.col("sources") / _BLOCK)
        other = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other")
        own = F.floor(F.col("sid") / _BLOCK)
        return rows.select("*", other).select(
            "lang", "shard", F.least(own, "other").alias("first"), F.greatest(own, "other").alias("second"), "sid", "term", "p", "terms"
        )

    heads = groups.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"), F.lit(None).cast("string").alias("term"),
        F.when(F.col("terms") > 0, _share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(0).alias("p"),
    )
    counts = kept.select("lang", "source", "term", "n").join(groups, ["lang", "source"]).withColumns({
        "shard": F.pmod(F.xxhash64("term"), F.col("shards")), "p": _share(F.col("n"), F.col("total"), F.col("terms")),
    })
    shards = in_blocks(heads).unionByName(in_blocks(counts)).groupBy("lang", "shard", "first", "second")
    on_path(kept.sparkSession)
    partial = shards.applyInArrow(_shard_sums, "lang string, a int, b int, value bigint")
    return partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = 50) -> DataFrame:
    """Divergence of sources: ``lang, source, part, item, value, rank``.

    Part ``pair`` has the distance of every source to every other one of its language; part ``term``
    its ``top`` terms that it uses more than its language does, by the difference of shares. Ranks go
    from 1, by value descending and item ascending.

    A null text, lang or source counts as the empty string; repeated rows count each; a group without
    terms is in part ``pair``; a language with no kept term has distances of 0; columns beyond
    ``text, lang, source`` are ignored; an empty table gives no row. A very long text is split whole,
    in memory of some times its size. Counts may reach 10^18.
    """
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = written(kept_counts(texts, min_docs), "term_counts")
    groups = written(_groups(texts, kept), "source_groups")

    distances = _pair_distances(kept, groups)
    both = distances.select("lang", F.explode(F.array(
        F.struct(F.col("a").alias("sid"), F.col("b").alias("other"), "value"),
        F.struct(F.col("b").alias("sid"), F.col("a").alias("other"), "value"),
    )).alias("d")).select("lang", "d.*")
    names = groups.select("lang", "sid", "source")
    pairs = both.join(names, ["lang", "sid"]).join(
        names.withColumnsRenamed({"sid": "other", "source": "item"}), ["lang", "other"]
    ).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    own = _share(F.col("n"), F.col("total"), F.col("terms"))
    whole = _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    terms = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (own - whole).alias("value")
    ).where("value > 0")

    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    return pairs.select("*", ranked).unionByName(terms.select("*", ranked).where(F.col("rank") <= top))
