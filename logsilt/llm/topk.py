"""Exact top-k search by inner product, pruned with segment means and deviations.

For two vectors cut into the same segments, Cauchy-Schwarz gives per segment
``<q, x> <= m * (mean_q * mean_x + dev_q * dev_x)``, so the sum over segments bounds the score from
above (the same inequality as a lower bound on the distance). Bounds of few long segments are looked
at first, those of many short ones next, and exact scores are computed for what is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsilt.llm.common import by_batch

SCALE = 256.0
LEVELS = (4, 16)
CANDIDATE_BLOCK = 2048
QUERY_BLOCK = 1024
BLOCKS_PER_TASK = 8

_BLOCK = "dim int, {key} ids binary, vectors binary"


def quantised(embedding: Column) -> Column:
    """floor(256 * x) of every component, x as double."""
    return F.transform(embedding, lambda x: F.floor(F.lit(SCALE) * x.cast("double")))


def usable(embedding: Column) -> Column:
    finite = F.forall(
        embedding,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return F.coalesce(embedding.isNotNull() & finite, F.lit(False))


def _pack(size: int, key: bool):
    """Rows (vec_id, vector[, query_block]) to blocks of ``size`` rows of equal length and key."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict[tuple, list] = {}

        def block(group, rows):
            ids, vectors = zip(*rows, strict=True)
            columns = {"dim": pa.array([group[0]], pa.int32())}
            if key:
                columns["query_block"] = pa.array([group[1]], pa.int32())
            columns["ids"] = pa.array([np.array(ids, np.int64).tobytes()], pa.binary())
            columns["vectors"] = pa.array([np.concatenate(vectors).tobytes()], pa.binary())
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            lists = batch.column("vector")
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            keys = batch.column("query_block").to_pylist() if key else [0] * len(ids)
            for i, vec_id in enumerate(ids):
                vector = values[ends[i] : ends[i + 1]].astype(np.int64)
                group = (len(vector), keys[i])
                rows = open_blocks.setdefault(group, [])
                rows.append((vec_id, vector))
                if len(rows) == size:
                    yield block(group, open_blocks.pop(group))
        for group, rows in open_blocks.items():
            yield block(group, rows)

    return pack


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations per segment, scaled so that the product of two rows is the bound."""
    parts = np.array_split(vectors, min(segments, vectors.shape[1]), axis=1)
    root = [np.sqrt(p.shape[1]) for p in parts]
    means = [p.mean(axis=1) * r for p, r in zip(parts, root, strict=True)]
    devs = [p.std(axis=1) * r for p, r in zip(parts, root, strict=True)]
    return np.stack(means + devs, axis=1)


def best_of_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vector id, score) of the k best ids of a block for each query of a block.

    An id with several rows counts once, with the best score of its rows.
    """
    dim = queries.shape[1]
    if dim == 0:
        exact_q, exact_x = queries, vectors
        stats = [(np.zeros((len(queries), 1)), np.zeros((len(vectors), 1)))]
    else:
        top = float(np.abs(queries).max()) * float(np.abs(vectors).max()) * dim
        real_q, real_x = queries.astype(np.float64), vectors.astype(np.float64)
        exact_q, exact_x = (real_q, real_x) if top < 2**52 else (queries, vectors)
        stats = [(segment_statistics(real_q, s), segment_statistics(real_x, s)) for s in LEVELS]
    repeated = len(np.unique(ids)) < len(ids)
    coarse = stats[0][0] @ stats[0][1].T
    slack = 1e-9 * (np.abs(coarse).max() + 1.0) if coarse.size else 0.0
    out_q, out_x, out_s = [], [], []
    for i, query_id in enumerate(query_ids):
        bound = coarse[i]
        left = np.flatnonzero(ids != query_id)
        if not len(left):
            continue
        if len(left) > k:
            # the most promising rows, of k ids, give a score that k ids reach
            if repeated:
                first = left[np.argsort(-bound[left], kind="stable")]
                first = first[np.sort(np.unique(ids[first], return_index=True)[1])[:k]]
            else:
                first = left[np.argpartition(-bound[left], k - 1)[:k]]
            if len(first) == k:
                reach = (exact_x[first] @ exact_q[i]).min() - slack
                left = left[bound[left] >= reach]
            else:
                reach = -np.inf  # fewer than k ids
            for mine, theirs in stats[1:]:
                if len(left) > 4 * k:
                    left = left[theirs[left] @ mine[i] >= reach - slack]
        scores = (exact_x[left] @ exact_q[i]).astype(np.int64)
        if repeated:
            order = np.lexsort((-scores, ids[left]))
            order = order[np.unique(ids[left][order], return_index=True)[1]]
            left, scores = left[order], scores[order]
        if len(left) > k:
            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
            left, scores = left[scores >= kth], scores[scores >= kth]
        order = np.lexsort((ids[left], -scores))[:k]
        out_q.append(np.full(len(order), query_id, np.int64))
        out_x.append(ids[left][order])
        out_s.append(scores[order])
    if not out_q:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(out_q), np.concatenate(out_x), np.concatenate(out_s)


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shape = (-1, row["dim"])
                query_ids, ids = (np.frombuffer(row[c], np.int64) for c in ("query_ids", "ids"))
                queries = np.frombuffer(row["queries"], np.int64).reshape(len(query_ids), shape[1])
                vectors = np.frombuffer(row["vectors"], np.int64).reshape(len(ids), shape[1])
                found = best_of_block(query_ids, queries, ids, vectors, k)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["query_id", "vec_id", "score"])

    return search


def exact_top_k(df: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """The k rows of highest integer inner product for each row that ``is_query`` holds for.

    ``df`` has ``vec_id`` and ``embedding``; other columns are ignored. Rows with a null id, and
    vectors that are null or hold null or non-finite components, take no part. Only vectors of equal
    length are compared; an empty vector scores 0 with other empty ones. A query's own id is no
    candidate. A repeated id is one query and one candidate, with the best score of its rows. Equal
    scores go to the smaller id. Scores are exact as long as they fit a long. An empty table gives
    no rows.
    """
    vectors = df.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        quantised(F.col("embedding")).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    n = vectors.agg(F.count("*").alias("rows"), F.count_if("is_query").alias("queries")).first()
    query_blocks = max(1, -(-n["queries"] // QUERY_BLOCK))
    salts = max(1, -(-n["rows"] // (CANDIDATE_BLOCK * BLOCKS_PER_TASK)))
    queries = (
        vectors.where("is_query")
        .select("vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int").alias("query_block"))
        .repartition("query_block")
        .transform(by_batch, _pack(QUERY_BLOCK, True), _BLOCK.format(key="query_block int,"))
        .select(
            "dim", "query_block", F.col("ids").alias("query_ids"), F.col("vectors").alias("queries"),
            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        )
    )
    blocks = (
        vectors.select("vec_id", "vector")
        .transform(by_batch, _pack(CANDIDATE_BLOCK, False), _BLOCK.format(key=""))
        .withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(salts)).cast("int"))
        .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    )
    # a stated query set against all rows, in blocks: each block of rows meets each block of queries once
    found = blocks.join(queries, ["dim", "query_block", "salt"]).transform(
        by_batch, _search(k), "query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
