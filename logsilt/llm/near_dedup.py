"""Near-duplicate classes: improved consistent weighted sampling over TF-IDF shingles, in bands.

The weight of a shingle of five words is how often it stands in the text, times the mean of its words'
inverse document frequencies, 1 for a word in every document to 2 for a rare one. Document frequencies are counted over the whole corpus. Only
words in at least a stated share of the documents need an entry, all rarer ones count as at that share,
so the table of frequencies is bounded by the mean number of distinct words of a text over that share.

Documents that agree on a band meet in a bucket. A bucket is worked through one document after the
other: each is compared, by signature, with the leaders so far, forms pairs with some leaders of every
cluster of leaders that it resembles, and is a leader itself, unless the cluster has many and one is
almost equal to it. So a bucket gives some pairs for each document, not one for each two. Tasks thin out
their own rows in the same way before the shuffle. Bands differ in the order of documents, so that they
differ in leaders. Candidate pairs are then verified by the exact weighted Jaccard
similarity of the whole texts.

Leaders can hide links. So once classes are known, every two documents of a bucket that resemble each
other by signature and are still in different classes are verified as well, in blocks of a bucket. A pair
is no row there: a task finds which documents of two blocks have a partner, their texts go to the task
of these two blocks, and it hands on the links of a spanning forest of the classes alone. Most pairs fall
to an upper bound of their similarity, from histograms of shingle weights.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsilt.llm.common import broadcast_if_small, by_batch, written

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 12, 3
SAMPLES = BANDS * ROWS
#: Words in a smaller share of the documents all have the weight of this share.
COMMON = 1e-3
#: Of the samples, how many must agree for two documents to be of one cluster and be verified. At a
#: similarity of 0.8 fewer than 19 of 36 agree once in 10,000 pairs.
AGREE = 19
#: In a cluster of so many leaders a document is no leader if so many samples agree with one of them;
#: before the shuffle, where a task sees a part of the bucket, only if nearly all agree.
MANY, ABSORB, ABSORB_EARLY = 64, 31, 35
#: Leaders of a cluster that a document is verified against, in each bucket: the most similar ones by
#: signature, and the most central ones, those most similar to all documents met so far. Copies that
#: were changed more or less link, if to any, to the least changed ones.
BEST, CENTRAL = 3, 3
#: Rows after which a task starts with new leaders in a bucket before the shuffle (not after it).
BUCKET_RUN = 4096
#: Orders of documents that the bands share; a pair is met in both directions in some of them.
ORDERS = 12

#: Followers of a leader whose texts are sent to one place to be verified; more are dealt to several.
FOLLOWERS = 256

#: Most rows of meetings (some 200 bytes each) that are broadcast, so that other texts need not move.
MEETINGS = 200_000

#: Documents of a block: a larger bucket is compared in pairs of blocks, each of which is a row group of its own.
BLOCK = 1024

_CHUNK = 1 << 15
_REMEMBERED = 1 << 19
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PLACES = (np.arange(1, 2 * WORDS, 2, dtype=np.uint64) * _M1 ^ _M2) | np.uint64(1)


class Weights(NamedTuple):
    """Sorted hashes of common words with their weights, and the weight of all other words."""

    words: np.ndarray
    weights: np.ndarray
    rare: float


class _Words(dict):
    """Numbers of words met by a worker, with hash and weight of each; starts anew when it holds many."""

    def __init__(self, weights: Weights):
        super().__init__()
        self._common = dict(zip(weights.words.tolist(), weights.weights.tolist(), strict=True))
        self._rare = weights.rare
        self._hashes, self._weights = np.empty(1 << 12, np.uint64), np.empty(1 << 12)

    def __missing__(self, word: str) -> int:
        number = len(self)
        if number == len(self._hashes):
            self._hashes, self._weights = (np.concatenate([a, np.empty_like(a)]) for a in (self._hashes, self._weights))
        value = xxhash.xxh3_64_intdigest(word)
        self._hashes[number] = value
        self._weights[number] = self._common.get(value, self._rare)
        self[word] = number
        return number

    def look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hash and weight of every word."""
        if len(self) > _REMEMBERED:
            self.clear()
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self._hashes[numbers], self._weights[numbers]


def words_of(text: str | None) -> list[str]:
    """Words are what white space parts, without case."""
    return (text or "").lower().split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M1
    return (x ^ (x >> np.uint64(29))) * _M2


def shingles(words: list[str], known: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the distinct shingles, and their weights. Fewer than five words are one shingle."""
    if not words:
        return np.empty(0, np.uint64), np.empty(0)
    hashes, own = known.look_up(words)
    size = min(WORDS, len(words))
    n = len(words) - size + 1
    keys, total = hashes[:n] * _PLACES[0], own[:n].copy()
    for i in range(1, size):
        keys += hashes[i : i + n] * _PLACES[i]
        total += own[i : i + n]
    keys = _mixed(keys)
    order = keys.argsort()
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    # equal shingles have equal weights, so their sum is the weight times the count
    return keys[first], np.add.reduceat(total[order], first) / size


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two texts' shingles; 0 if either has none."""
    _, in_a, in_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = float(np.minimum(a[1][in_a], b[1][in_b]).sum())
    total = float(a[1].sum() + b[1].sum()) - shared
    return shared / total if total else 0.0


def _gamma_quantiles() -> tuple[np.ndarray, np.ndarray]:
    """2 ** 16 quantiles of Gamma(2, 1), and their logarithms: samples by table look-up."""
    x = np.concatenate([[0.0], np.geomspace(1e-4, 40, 200_000)])
    quantiles = np.interp((np.arange(1 << 16) + 0.5) / (1 << 16), 1 - (1 + x) * np.exp(-x), x)
    return quantiles.astype(np.float32), np.log(quantiles).astype(np.float32)


class Sampler:
    """Signatures of texts: for each sample the shingle and level that the weights choose."""

    def __init__(self, samples: int = SAMPLES, seed: int = 1):
        self._seeds = np.random.default_rng(seed).integers(1, 1 << 63, samples, np.uint64) | np.uint64(1)
        self._gamma, self._log_gamma = _gamma_quantiles()

    def signatures(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """One row of 64-bit values for each text; texts must have shingles."""
        out = np.empty((len(texts), len(self._seeds)), np.uint64)
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop][0]) <= _CHUNK):
                size += len(texts[stop][0])
                stop += 1
            out[at:stop] = self._chunk(texts[at:stop])
            at = stop
        return out

    def _chunk(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        keys = np.concatenate([t[0] for t in texts])
        log_weight = np.log(np.concatenate([t[1] for t in texts])).astype(np.float32)
        sizes = np.array([len(t[0]) for t in texts])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        owner = np.repeat(np.arange(len(texts)), sizes)
        out = np.empty((len(texts), len(self._seeds)), np.uint64)
        # buffers for all samples; z gives three random numbers of 16 bits for a shingle and a sample
        z, shifted = np.empty_like(keys), np.empty_like(keys)
        bits = z.view(np.uint16).reshape(-1, 4)
        r, log_a, beta, level = (np.empty(len(keys), np.float32) for _ in range(4))
        for k, seed in enumerate(self._seeds):
            np.multiply(keys, seed, out=z)
            z ^= np.right_shift(z, np.uint64(32), out=shifted)
            z *= _M2
            z ^= np.right_shift(z, np.uint64(31), out=shifted)
            np.take(self._gamma, bits[:, 1], out=r, mode="clip")
            np.take(self._log_gamma, bits[:, 2], out=log_a, mode="clip")
            np.multiply(bits[:, 3], np.float32(2.0**-16), out=beta, casting="unsafe")
            # level = floor(ln w / r + beta); ln a = ln c - r * (level - beta + 1)
            np.divide(log_weight, r, out=level)
            level += beta
            np.floor(level, out=level)
            np.subtract(level, beta, out=beta)
            beta += np.float32(1)
            beta *= r
            log_a -= beta
            least = np.minimum.reduceat(log_a, starts)
            chosen = np.flatnonzero(log_a == least[owner])
            # of equal ones the first, which is the same for equal texts
            chosen = chosen[np.searchsorted(owner[chosen], np.arange(len(texts)))]
            out[:, k] = _mixed(keys[chosen] + level[chosen].astype(np.int64).astype(np.uint64) * _M1)
        return out


def word_weights(docs: DataFrame) -> Weights:
    """Document frequencies of all words, as the weights of those that are common."""
    n = docs.count()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def rows() -> Iterator[pa.RecordBatch]:
            items = iter(seen.items())
            while part := list(islice(items, 1 << 16)):
                hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w, _ in part), np.uint64, len(part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), pa.array([n for _, n in part], pa.int64())], ["word", "n"]
                )

        for batch in batches:
            for text in batch.column("text"):
                seen.update(set(words_of(text.as_py())))
                if len(seen) > _REMEMBERED:
                    yield from rows()
                    seen.clear()
        yield from rows()

    counts = docs.select("text").transform(by_batch, count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    least = COMMON * n
    # at most (mean distinct words of a text) / COMMON rows, whatever the number of documents
    common = counts.where(F.col("n") >= least).toArrow()
    words = common.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    weights = 1.0 + np.log(max(n, 1) / common.column("n").to_numpy()) / np.log(1 / COMMON)
    return Weights(words[order], weights[order], 2.0)


def signatures(docs: DataFrame, weights: Weights) -> DataFrame:
    """(doc_id, key, bands, signature): a hash of the words, band hashes, and a byte of each sample.

    A text without words has no bands.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, known = Sampler(), _Words(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                keys, new = [], {}
                for text in part.column("text"):
                    words = words_of(text.as_py())
                    key = xxhash.xxh3_128_digest(" ".join(words))
                    keys.append(key)
                    if words and key not in new:
                        new[key] = shingles(words, known)
                signed = dict(zip(new, sampler.signatures(list(new.values())), strict=True))
                bands, low = [], []
                for key in keys:
                    signature = signed.get(key)
                    if signature is None:
                        bands.append([])
                        low.append(b"")
                        continue
                    mixed = np.zeros(BANDS, np.uint64)
                    for row in signature.reshape(BANDS, ROWS).T:
                        mixed = _mixed(mixed + row)
                    bands.append(mixed.view(np.int64))
                    low.append((signature & np.uint64(255)).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(low, pa.binary())],
                    ["doc_id", "key", "bands", "signature"],
                )

    return docs.select("doc_id", "text").transform(by_batch, sign, "doc_id long, key binary, bands array<long>, signature binary")


class _Bucket:
    """The leaders of a bucket, in clusters of similar ones."""

    def __init__(self, absorb: int = ABSORB):
        self._absorb = absorb
        self._ids: list[int] = []
        self._held: np.ndarray | None = None
        self._clusters: np.ndarray | None = None
        self._met = 0  # documents so far
        self._since: np.ndarray | None = None  # how many of them before a leader
        self._agreed: np.ndarray | None = None  # samples that a leader had in common with those after it

    def add(self, doc: int, signature: np.ndarray) -> tuple[list[int], bool]:
        """The leaders that the document is to be compared with, and whether it is a leader now."""
        used = len(self._ids)
        self._met += 1
        if not used:
            # most buckets never hold more
            self._held, self._clusters = signature[None, :], np.zeros(1, np.int32)
            self._since, self._agreed = np.ones(1), np.zeros(1)
            self._ids.append(doc)
            return [], True
        same = (self._held[:used] == signature).sum(axis=1)
        self._agreed[:used] += same
        near = np.flatnonzero(same >= AGREE)
        near = near[np.lexsort((near, -same[near]))]
        clusters = self._clusters[near]
        pairs = []
        for c in np.unique(clusters):
            mine = near[clusters == c]
            chosen = mine[:BEST].tolist()
            if len(mine) > BEST:
                central = self._agreed[mine] / (self._met - self._since[mine])
                chosen += mine[np.argsort(-central, kind="stable")[:CENTRAL]].tolist()
            pairs += [self._ids[i] for i in dict.fromkeys(chosen) if self._ids[i] != doc]
        if len(near) >= MANY and same[near[0]] >= self._absorb:
            return pairs, False
        joined = np.unique(clusters)
        cluster = joined[0] if len(joined) else used
        if len(joined) > 1:
            self._clusters[:used][np.isin(self._clusters[:used], joined)] = cluster
        if used == len(self._held):
            more = max(used, 8)
            self._held = np.concatenate([self._held, np.empty((more, SAMPLES), np.uint8)])
            self._clusters = np.concatenate([self._clusters, np.zeros(more, np.int32)])
            self._since, self._agreed = (np.concatenate([a, np.zeros(more)]) for a in (self._since, self._agreed))
        self._held[used], self._clusters[used], self._since[used] = signature, cluster, self._met
        self._ids.append(doc)
        return pairs, True


def _lead(run: int | None, absorb: int):
    """Rows (band, bucket, id, signature), sorted by bucket: pairs (id, other), and leaders (other null).

    ``run`` is for the pass before the shuffle: the number of rows after which a bucket starts with new
    leaders. There only documents that are no leaders form pairs, as the others go on.
    """

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, rows, bucket_of = None, 0, None
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("band", "bucket", "id", "signature", "other")}
            columns = (batch.column(c).to_pylist() for c in ("band", "bucket", "id", "signature"))
            for band, bucket, doc, signature in zip(*columns, strict=True):
                if (band, bucket) != place or (run and rows >= run):
                    place, rows, bucket_of = (band, bucket), 0, _Bucket(absorb)
                rows += 1
                found, leads = bucket_of.add(doc, np.frombuffer(signature, np.uint8))
                for leader in () if run and leads else found:
                    for column, value in zip(out.values(), (band, bucket, leader, None, doc), strict=True):
                        column.append(value)
                if leads:
                    for column, value in zip(out.values(), (band, bucket, doc, signature, None), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["band"], pa.int32()), pa.array(out["bucket"], pa.int64()), pa.array(out["id"], pa.int64()),
                 pa.array(out["signature"], pa.binary()), pa.array(out["other"], pa.int64())], list(out)
            )

    return lead


_LED = "band int, bucket long, id long, signature binary, other long"


def candidates(texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of documents to verify, from (id, bands, signature) of different texts."""
    order = F.xxhash64("id", F.col("band") % ORDERS)
    rows = texts.select("id", "signature", F.posexplode("bands").alias("band", "bucket"))
    first = written(
        rows.sortWithinPartitions("band", "bucket", order, "id").select("band", "bucket", "id", "signature")
        .transform(by_batch, _lead(BUCKET_RUN, ABSORB_EARLY), _LED),
        "led",
    )
    leaders = first.where("other IS NULL").select("band", "bucket", "id", "signature")
    second = (
        leaders.repartition("band", "bucket").sortWithinPartitions("band", "bucket", order, "id")
        .transform(by_batch, _lead(None, ABSORB), _LED)
    )
    pairs = first.where("other IS NOT NULL").select("id", "other").unionByName(
        second.where("other IS NOT NULL").select("id", "other")
    )
    return pairs.distinct()


_DEALT = ("band", "bucket", "first", "second")
_MEETING = "band int, bucket long, first int, second int, block int, id long, class_id long, signature binary, bands array<long>"


class _Members(NamedTuple):
    """Documents of two blocks of a bucket, or of one; ``first`` and ``second`` say who is in which."""

    first: np.ndarray
    second: np.ndarray
    classes: np.ndarray
    signatures: np.ndarray
    bands: np.ndarray


def _members(table: pa.Table) -> _Members:
    signed = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(-1, SAMPLES)
    bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    block = table.column("block").to_numpy()
    first, second = (np.flatnonzero(block == table.column(c)[0].as_py()) for c in ("first", "second"))
    return _Members(first, second, table.column("class_id").to_numpy(), signed, bands)


def _resembling(m: _Members, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of members of different classes with enough equal samples, one from each block, that share
    no bucket of an earlier band; and their equal samples."""
    mine, theirs = m.first, m.second
    one = len(mine) == len(m.classes)
    none = np.empty(0, np.int64)
    a, b, same = [none], [none], [np.empty(0, np.uint8)]
    for at in range(0, len(mine), 256):
        part = mine[at : at + 256]
        equal = np.zeros((len(part), len(theirs)), np.uint8)
        for k in range(SAMPLES):
            equal += m.signatures[part, k][:, None] == m.signatures[theirs, k][None, :]
        near = (equal >= AGREE) & (m.classes[part][:, None] != m.classes[theirs][None, :])
        if one:
            near &= part[:, None] < theirs[None, :]
        x, y = np.nonzero(near)
        earlier = (m.bands[part[x], :band] == m.bands[theirs[y], :band]).any(axis=1)
        x, y = x[~earlier], y[~earlier]
        a.append(part[x])
        b.append(theirs[y])
        same.append(equal[x, y])
    return tuple(np.concatenate(c) for c in (a, b, same))


def _by_group(of_group: Callable[[pa.Table], pa.Table]) -> Callable:
    """Whole groups of rows sorted by ``_DEALT``, one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            place = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in _DEALT], axis=1)
            starts = np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1
            if left and any(left[-1].column(c)[-1].as_py() != table.column(c)[0].as_py() for c in _DEALT):
                yield from of_group(pa.concat_tables(left)).to_batches()
                left = []
            bounds = [0, *starts.tolist()]
            for low, high in zip(bounds, bounds[1:]):
                yield from of_group(pa.concat_tables([*left, table.slice(low, high - low)])).to_batches()
                left = []
            left.append(table.slice(bounds[-1]))
        if left:
            yield from of_group(pa.concat_tables(left)).to_batches()

    return run


def _with_partners(group: pa.Table) -> pa.Table:
    """Those documents of a group that resemble one of another class."""
    if group.num_rows < 2:
        return group.slice(0, 0)
    a, b, _ = _resembling(_members(group), group.column("band")[0].as_py())
    return group.take(pa.array(np.union1d(a, b)))


def meetings(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """Documents, per two blocks of a bucket, that resemble one of another class there.

    Members of the largest class of a bucket need not meet each other, all else does: a bucket of more
    than ``BLOCK`` documents is dealt by hash to counted blocks, and every two blocks are compared alone.
    """
    of = classes.select(F.col("id").alias("_id"), "class_id")
    rows = texts.join(of, F.col("id") == F.col("_id"), "left").select(
        "id", "signature", "bands", F.coalesce("class_id", "id").alias("class_id"), F.posexplode("bands").alias("band", "bucket")
    )
    largest = F.max(F.struct("n", "class_id")).alias("largest")
    mixed = (
        rows.groupBy("band", "bucket", "class_id").agg(F.count("*").alias("n"))
        .groupBy("band", "bucket").agg(F.sum("n").alias("n"), largest).where("largest.n < n")
    )
    split = F.col("n") > BLOCK
    mixed = written(
        mixed.select(
            "band", "bucket", F.when(split, F.col("largest.class_id")).alias("large"),
            F.when(split, F.ceil((F.col("n") - F.col("largest.n")) / BLOCK)).otherwise(F.lit(1)).cast("int").alias("others"),
            F.when(split, F.ceil(F.col("largest.n") / BLOCK)).otherwise(F.lit(0)).cast("int").alias("larges"),
        ),
        "mixed",
    )
    in_large = F.coalesce(F.col("class_id") == F.col("large"), F.lit(False))
    block = F.when(in_large, F.col("others") + F.pmod(F.xxhash64("id"), "larges")).otherwise(F.pmod(F.xxhash64("id"), "others"))
    # the blocks of the largest class meet the others only
    meets = F.expr(
        """concat(transform(sequence(0, least(block, others - 1)), i -> struct(i AS first, block AS second)),
        CASE WHEN block < others AND block + 1 < others + larges
        THEN transform(sequence(block + 1, others + larges - 1), j -> struct(block AS first, j AS second)) ELSE array() END)"""
    )
    return (
        rows.join(mixed, ["band", "bucket"]).withColumn("block", block.cast("int"))
        .select("band", "bucket", F.inline(meets), "block", "id", "class_id", "signature", "bands")
        .repartition(*_DEALT).sortWithinPartitions(*_DEALT, "block", "id")
        .transform(by_batch, _by_group(_with_partners), _MEETING)
    )


def _forest(group: pa.Table, known: _Words, least: float) -> pa.Table:
    """Links (id, other) that join classes of a group, no more than it takes, by exact similarity."""
    edges: list[tuple[int, int]] = []
    if group.num_rows > 1:
        m = _members(group)
        a, b, same = _resembling(m, group.column("band")[0].as_py())
        order = np.argsort(-same.astype(np.int16), kind="stable")
        a, b = a[order], b[order]
        ids = group.column("id").to_pylist()
        found = [shingles(words_of(text), known) for text in group.column("text").to_pylist()]
        totals = np.array([f[1].sum() for f in found])
        histograms = np.stack([np.bincount((k >> _HIGH).astype(np.int64), w, _CELLS) for k, w in found])
        parent: dict[int, int] = {}

        def root(c: int) -> int:
            while (up := parent.get(c, c)) != c:
                parent[c] = parent.get(up, up)
                c = up
            return c

        for at in range(0, len(a), 4096):
            x, y = a[at : at + 4096], b[at : at + 4096]
            # what two texts share in a cell of the histogram is at most the smaller weight there
            shared = np.minimum(histograms[x], histograms[y]).sum(axis=1)
            near = shared >= (least - 1e-9) * (totals[x] + totals[y] - shared)
            for i, j in zip(x[near].tolist(), y[near].tolist()):
                one, two = root(int(m.classes[i])), root(int(m.classes[j]))
                if one != two and similarity(found[i], found[j]) >= least:
                    parent[max(one, two)] = min(one, two)
                    edges.append((ids[i], ids[j]))
    columns = list(zip(*edges)) or [(), ()]
    return pa.table({"id": pa.array(columns[0], pa.int64()), "other": pa.array(columns[1], pa.int64())})


# Cells of a histogram of shingle weights, by the highest bits of a shingle's hash.
_CELLS, _HIGH = 256, np.uint64(56)


def hidden_links(docs: DataFrame, texts: DataFrame, classes: DataFrame, weights: Weights, least: float = SIMILARITY) -> DataFrame:
    """Links (id, other) between different classes that the leaders have not shown."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words(shared.value)
        return _by_group(lambda group: _forest(group, known, least))(batches)

    met = written(meetings(texts, classes), "meetings")
    if met.limit(MEETINGS + 1).count() <= MEETINGS:
        met = F.broadcast(met)
    held = docs.select("doc_id", "text").join(met, F.col("doc_id") == F.col("id")).drop("doc_id")
    return held.repartition(*_DEALT).sortWithinPartitions(*_DEALT, "block", "id").transform(by_batch, verify, "id long, other long")


def verified(docs: DataFrame, pairs: DataFrame, weights: Weights, least: float = SIMILARITY) -> DataFrame:
    """The pairs (id, other) whose texts have at least the given weighted Jaccard similarity.

    ``pairs`` is a written table. The texts of a leader's followers are sent to the leader's text, which
    is read once for all of them, or for every part of them where they are many.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    parts = written(
        pairs.groupBy("id").agg(F.ceil(F.count("*") / FOLLOWERS).alias("parts")).select(F.col("id").alias("leader"), "parts"),
        "parts",
    )
    followers = pairs.join(parts, F.col("id") == F.col("leader")).select(
        "leader", F.pmod(F.xxhash64("other"), "parts").alias("part"), F.col("other").alias("doc_id"), F.lit(False).alias("leads")
    )
    leaders = parts.select(
        "leader", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
        F.col("leader").alias("doc_id"), F.lit(True).alias("leads"),
    )
    wanted = broadcast_if_small(written(followers.unionByName(leaders), "wanted"))
    texts = docs.select("doc_id", "text").join(wanted, "doc_id").select("leader", "part", "leads", "doc_id", "text")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words(shared.value)
        leader, own = None, []
        for batch in batches:
            ids, others = [], []
            columns = (batch.column(c) for c in ("leader", "part", "leads", "doc_id", "text"))
            for at, part, leads, doc, text in zip(*columns, strict=True):
                at, doc = at.as_py(), doc.as_py()
                found = shingles(words_of(text.as_py()), known)
                if (at, part) != leader:
                    leader, own = (at, part), []
                if leads.as_py():
                    own.append(found)  # more than one only where an id is repeated
                elif any(similarity(o, found) >= least for o in own):
                    ids.append(at)
                    others.append(doc)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(others, pa.int64())], ["id", "other"])

    return (
        texts.repartition("leader", "part").sortWithinPartitions("leader", "part", F.desc("leads"), "doc_id")
        .transform(by_batch, verify, "id long, other long")
    )


def components(edges: DataFrame) -> DataFrame:
    """(id, class_id) of all nodes of the edges (id, other), class_id being the smallest of the component.

    Alternating large-star and small-star steps: each links a node's neighbours to the smallest of
    them, so that components become stars in a number of rounds that grows with the logarithm of
    their diameter. Every round is a written table.
    """
    a, b = F.col("id"), F.col("other")
    links = written(edges.select(F.least(a, b).alias("other"), F.greatest(a, b).alias("id")).where("id <> other").distinct(), "links")
    before = None
    while True:
        # large star: greater neighbours of a node go to the smallest of its neighbours and itself
        both = links.select("id", "other").unionByName(links.select(F.col("other").alias("id"), F.col("id").alias("other")))
        least = written(both.groupBy("id").agg(F.least(F.min("other"), F.col("id")).alias("least")), "least")
        large = written(
            both.where("other > id").join(least, "id").select(F.col("other").alias("id"), F.col("least").alias("other"))
            .where("id <> other").distinct(),
            "large",
        )
        # small star: smaller neighbours of a node, and the node, go to the smallest of them
        least = written(large.groupBy("id").agg(F.min("other").alias("least")), "least")
        small = large.join(least, "id").select(F.col("other").alias("id"), F.col("least").alias("other")).unionByName(
            least.select("id", F.col("least").alias("other"))
        ).where("id <> other").distinct()
        links = written(small, "links")
        state = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("id", "other").cast("decimal(38,0)")).alias("sum")).first()
        if state == before:
            break
        before = state
    stars = links.select("id", F.col("other").alias("class_id"))
    return stars.unionByName(stars.select(F.col("class_id").alias("id"), "class_id").distinct())


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id) of every row: documents linked by copies or by near copies share a class.

    class_id is the smallest doc_id of the class. Words are without case and parted by white space;
    fewer than five words are one shingle; texts without words (null ones too) are copies of each
    other. A row with a null doc_id takes no part and has a null class; rows that repeat a doc_id are
    one document. Other columns are ignored, an empty table gives no rows.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = slim.where("doc_id IS NOT NULL")
    weights = word_weights(named)
    signed = written(signatures(named, weights), "signatures")
    # copies are one text from here on
    texts = written(
        signed.groupBy("key").agg(
            F.min("doc_id").alias("id"), F.max("doc_id").alias("last"), F.max("signature").alias("signature"),
            F.max("bands").alias("bands"),
        ),
        "texts",
    )
    pairs = written(candidates(texts), "candidates")
    links = written(verified(named, pairs, weights, least), "verified")
    # an id that is repeated with another text links the two texts
    twice = signed.groupBy("doc_id").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high")
    first = texts.select(F.col("key").alias("low"), F.col("id").alias("id"))
    second = texts.select(F.col("key").alias("high"), F.col("id").alias("other"))
    more = twice.join(first, "low").join(second, "high").select("id", "other")
    classes = components(links.unionByName(more))
    links = written(hidden_links(named, texts, classes, weights, least), "hidden")
    if not links.isEmpty():
        classes = components(classes.select("id", F.col("class_id").alias("other")).unionByName(links))
    known = written(
        texts.join(classes, "id", "left").where("last <> id OR class_id IS NOT NULL")
        .select(F.col("key").alias("of"), F.coalesce("class_id", "id").alias("class_id")),
        "classes",
    )
    found = signed.select("doc_id", "key").join(known, F.col("key") == F.col("of"), "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id")
    )
    return found.unionByName(slim.where("doc_id IS NULL").select("doc_id", F.lit(None).cast("long").alias("class_id")))
