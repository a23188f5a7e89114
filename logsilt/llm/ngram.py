"""Quality rules: counting rules, and the perplexity of a modified Kneser-Ney model.

The model is one of 4-grams of the bytes of the texts in UTF-8, each byte a symbol of its own: case,
digits, marks and the letters of all scripts are told apart. Tasks hand on counts, not occurrences. The
finished model is a table; a task holds sorted arrays of it, all of them or, of a model with more than
SLICE 4-grams, a range at a time. Bands of accepted perplexity are set per language from exact
histograms over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logsilt.llm.common import broadcast_if_small, by_batch, written

ORDER = 4
BITS = 8
SYMBOLS = 1 << BITS
#: Most 4-grams of the model that a task holds at once, 64 MB of them. Of shorter grams and contexts there
#: are at most 64 ** 4 each, far fewer in UTF-8.
SLICE = 1 << 23
#: Log perplexity is counted in steps of this many nats.
STEP = 1e-3
#: A band is median - LOWER * spread to median + UPPER * spread, spread being the distance from the
#: median to the quartile on that side, and at least LEAST_SPREAD.
LOWER = UPPER = 8.0
LEAST_SPREAD = 0.02
#: Where no language has so many scored documents, all take the band of all documents; otherwise each
#: language, also a smaller one, has its own.
LEAST_DOCS = 200
#: Most languages for which the bands are broadcast; beyond, they are joined by shuffle.
BROADCAST_BANDS = 10_000

_CHUNK = 1 << 21
_ROW = "__row"
_SPACE = b" \t\n\r\x0b\x0c"
_MARKS = b"#*$%&|<>"
_FEATURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_grams long, log_perplexity double"
)


def _alphabet() -> np.ndarray:
    """Symbol of each byte: itself."""
    return np.arange(SYMBOLS, dtype=np.uint8)


ALPHABET = _alphabet()


def grams_of(data: bytes) -> Iterator[np.ndarray]:
    """Keys of the 4-grams that end at each byte; before the text stand bytes 0x01."""
    start = np.ones(ORDER - 1, np.uint8)
    for at in range(0, len(data), _CHUNK):
        symbols = np.concatenate([start, ALPHABET[np.frombuffer(data[at : at + _CHUNK], np.uint8)]])
        keys = np.zeros(len(symbols) - ORDER + 1, np.uint32)
        for i in range(ORDER):
            keys = (keys << BITS) | symbols[i : len(symbols) - ORDER + 1 + i]
        start = symbols[len(symbols) - ORDER + 1 :]
        yield keys


def _added(grams: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams in order, and the sum of the counts of each."""
    order = np.argsort(grams, kind="stable")
    grams, n = grams[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return grams[first], np.add.reduceat(n, first)


def count_grams(df: DataFrame) -> DataFrame:
    """(gram, n) over all texts: a task adds up its own counts before anything is shuffled, and hands them
    on whenever it has so many grams that they would fill its memory."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        waiting, size = [], 0
        texts = (t.as_buffer().to_pybytes() for batch in batches for t in batch.column("text").cast(pa.binary()))
        for keys in chain(chain.from_iterable(map(grams_of, texts)), [None]):
            if keys is not None:
                waiting.append(keys)
                size += len(keys)
            if size >= max(_CHUNK, len(total[0])) or (size and keys is None):
                new = np.unique(np.concatenate(waiting), return_counts=True)
                total = _added(*map(np.concatenate, zip(total, new, strict=True)))
                waiting, size = [], 0
            if len(total[0]) and (keys is None or len(total[0]) >= SLICE):
                for at in range(0, len(total[0]), 1 << 16):
                    gram, n = (part[at : at + (1 << 16)] for part in total)
                    yield pa.RecordBatch.from_arrays([pa.array(gram.astype(np.int64)), pa.array(n)], ["gram", "n"])
                total = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    counted = df.select(F.coalesce("text", F.lit("")).alias("text")).transform(by_batch, count, "gram long, n long")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(size, gram, log_p, log_backoff): for every gram of every size its interpolated modified
    Kneser-Ney log probability, and as a context the log weight of the next lower order.

    Lower orders count in how many contexts a gram continues, not how often. The discounts come from
    the counts of counts; where one of these is 0 the discount is the usual 0.5, 1, 1.5.
    """
    levels = {ORDER: counts}
    for size in range(ORDER - 1, 0, -1):
        lower = F.col("gram").bitwiseAND(F.lit(SYMBOLS**size - 1))
        levels[size] = levels[size + 1].groupBy(lower.alias("gram")).agg(F.count("*").alias("n"))
    lower, out = None, []
    for size in range(1, ORDER + 1):
        level = levels[size]
        of = level.agg(*[F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
        n1, n2, n3, n4 = (of[f"n{i}"] for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 and n2 else None
        steps = [(1, n1, n2, 0.5), (2, n2, n3, 1.0), (3, n3, n4, 1.5)]
        cuts = [
            min(max(i - (i + 1) * y * b / a, 0.05), i - 0.05) if y and a and b else plain for i, a, b, plain in steps
        ]
        cut = F.when(F.col("n") == 1, cuts[0]).when(F.col("n") == 2, cuts[1]).otherwise(cuts[2])
        rows = level.withColumns({"context": F.shiftright("gram", BITS), "cut": cut})
        contexts = rows.groupBy("context").agg(F.sum("n").alias("total"), F.sum("cut").alias("given"))
        rows = rows.join(contexts, "context").select(
            "gram", ((F.col("n") - F.col("cut")) / F.col("total")).alias("own"), (F.col("given") / F.col("total")).alias("rest"),
            F.col("gram").bitwiseAND(F.lit(SYMBOLS ** (size - 1) - 1)).alias("shorter"),
        )
        if lower is None:
            p = rows.withColumn("p", F.col("own") + F.col("rest") / SYMBOLS)
        else:
            p = rows.join(lower.select(F.col("gram").alias("shorter"), F.col("p").alias("p_lower")), "shorter")
            p = p.withColumn("p", F.col("own") + F.col("rest") * F.col("p_lower"))
        lower = written(p.select("gram", "p"), f"grams{size}")
        none = F.lit(None).cast("float")
        probabilities = lower.select(
            F.lit(size).cast("byte").alias("size"), "gram", F.log("p").cast("float").alias("log_p"), none.alias("log_backoff")
        )
        backoffs = contexts.select(
            F.lit(size - 1).cast("byte").alias("size"), F.col("context").alias("gram"), none.alias("log_p"),
            F.log(F.col("given") / F.col("total")).cast("float").alias("log_backoff"),
        )
        out += [probabilities, backoffs]
    union = out[0]
    for part in out[1:]:
        union = union.unionByName(part)
    return union


class SortedModel:
    """The model, or a range of its 4-grams, as sorted arrays: by size, gram keys with log probabilities and
    with backoffs."""

    def __init__(self, rows: pa.Table):
        # a missing value becomes NaN
        size, gram, log_p, backoff = (rows.column(c).to_numpy() for c in ("size", "gram", "log_p", "log_backoff"))

        def sorted_pair(mask: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            keys = gram[mask].astype(np.uint32)
            order = np.argsort(keys)
            return keys[order], values[mask][order].astype(np.float32)

        self.grams = [None] + [sorted_pair((size == n) & ~np.isnan(log_p), log_p) for n in range(1, ORDER + 1)]
        self.backoffs = [sorted_pair((size == n) & ~np.isnan(backoff), backoff) for n in range(ORDER)]

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known, values = table
        if not len(known):
            return np.zeros(len(keys), np.float32), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return values[at], known[at] == keys

    def log_probabilities(self, keys: np.ndarray) -> np.ndarray:
        """Of the last symbol of each gram, given those before it. All grams are of the range held."""
        keys = keys.astype(np.uint32, copy=False)
        out, found = self._find(self.grams[ORDER], keys)
        out = out.astype(np.float64)
        missing = np.flatnonzero(~found)
        out[missing] = 0.0
        for size in range(ORDER - 1, -1, -1):
            if not len(missing):
                return out
            left = keys[missing]
            # the weight of the lower order belongs to the context of the longer gram
            weight, known = self._find(self.backoffs[size], (left >> BITS) & (SYMBOLS**size - 1))
            out[missing] += np.where(known, weight, 0.0)
            if size == 0:
                out[missing] -= np.log(SYMBOLS)
                return out
            shorter, known = self._find(self.grams[size], left & (SYMBOLS**size - 1))
            out[missing] += np.where(known, shorter, 0.0)
            missing = missing[~known]
        return out


def train(df: DataFrame) -> DataFrame:
    """The model of all texts, a written table as from ``kneser_ney``."""
    return written(kneser_ney(written(count_grams(df), "grams")), "kneser_ney")


def ranges(model: DataFrame) -> list[tuple[int, int]]:
    """Ranges of 4-grams, from one key up to another, that hold SLICE grams of the model at most; all
    together every key there is. Counts of the first two bytes pass through the driver, not grams."""
    prefix = F.shiftright("gram", 2 * BITS).alias("prefix")
    counts = model.where(F.col("size") == ORDER).groupBy(prefix).agg(F.count("*").alias("n")).collect()
    bounds, held = [0], 0
    for at, n in sorted((r.prefix, r.n) for r in counts):
        if held and held + n > SLICE:
            bounds.append(at << 2 * BITS)
            held = 0
        held += n
    return list(zip(bounds, [*bounds[1:], SYMBOLS**ORDER], strict=True))


def load(model: DataFrame, low: int = 0, high: int = SYMBOLS**ORDER) -> SortedModel:
    """All shorter grams and contexts of the model, and its 4-grams of one range."""
    inside = (F.col("gram") >= low) & (F.col("gram") < high)
    return SortedModel(model.where((F.col("size") < ORDER) | inside).toArrow())


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of three words found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    windows = pairs[:-1] * len(numbers) + ids[2:]
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())


def text_counts(data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text in UTF-8."""
    words = data.split()  # on ASCII space and 0x09 to 0x0D, and on nothing else
    joined = data.translate(None, _SPACE)
    word_chars = len(joined) - int(np.count_nonzero((np.frombuffer(joined, np.uint8) & 0xC0) == 0x80))
    n_symbols = len(joined) - len(joined.translate(None, _MARKS))
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(words), word_chars, n_symbols, len(lines) - len(set(lines)), repeated_words(words)


def score(df: DataFrame, model: DataFrame) -> DataFrame:
    """Adds the counts of the rules and the mean negative log probability (``log_perplexity``).

    Every gram of a text belongs to one range of the model. If there are several, the rows are written
    with a number, read once per range, and the sums of a row over the ranges added in their order.
    """
    parts = ranges(model)
    if len(parts) == 1:
        return _scored(df, model, *parts[0])
    rows = written(df.withColumn(_ROW, F.monotonically_increasing_id()), "numbered")
    texts = rows.select(_ROW, "text")
    sums = [
        _scored(texts, model, *part).select(_ROW, F.lit(i).alias("part"), (F.col("log_perplexity") * F.col("n_grams")).alias("total"))
        for i, part in enumerate(parts[1:])
    ]
    others = reduce(DataFrame.unionByName, sums).groupBy(_ROW).agg(F.array_sort(F.collect_list(F.struct("part", "total"))).alias("others"))
    others = broadcast_if_small(written(others.select(
        F.col(_ROW).alias("_of"), F.aggregate("others", F.lit(0.0), lambda total, o: total + o["total"]).alias("_others")
    ), "sums"))
    joined = _scored(rows, model, *parts[0]).join(others, F.col(_ROW) == F.col("_of"))
    whole = F.col("log_perplexity") + F.col("_others") / F.col("n_grams")
    return joined.withColumn("log_perplexity", F.when(F.col("n_grams") > 0, whole)).drop(_ROW, "_of", "_others")


def _scored(df: DataFrame, model: DataFrame, low: int, high: int) -> DataFrame:
    """``score`` with the grams of one range alone: the others of a text add 0."""
    shared = df.sparkSession.sparkContext.broadcast(load(model, low, high))
    names = df.columns
    whole = high - low == SYMBOLS**ORDER

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm = shared.value
        for batch in batches:
            rows = []
            for text in batch.column(names.index("text")):
                data = (text.as_py() or "").encode()
                total, n = 0.0, 0
                for keys in grams_of(data):
                    n += len(keys)
                    inside = keys if whole else keys[(keys >= low) & (keys < high)]
                    total -= float(lm.log_probabilities(inside).sum())
                rows.append((*text_counts(data), n, total / n if n else None))
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            arrays = [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *arrays], schema=pa.schema([*batch.schema, *_fields()])
            )

    return df.transform(by_batch, scored, StructType([*df.schema.fields, *StructType.fromDDL(_FEATURES).fields]))


def _fields() -> list[pa.Field]:
    kinds = {"long": pa.int64(), "double": pa.float64()}
    return [pa.field(name, kinds[kind]) for name, kind in (f.split() for f in _FEATURES.split(", "))]


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def bands(scored: DataFrame) -> DataFrame:
    """(language, low, high): accepted log perplexity, from documents that pass the counting rules."""
    steps = scored.where(~base_failed()).groupBy(
        F.coalesce("lang", F.lit("")).alias("language"), F.floor(F.col("log_perplexity") / STEP).alias("step")
    ).agg(F.count("*").alias("n"))
    steps = steps.unionByName(steps.groupBy(F.lit(None).cast("string").alias("language"), "step").agg(F.sum("n").alias("n")))
    # a histogram is of log perplexities in steps, so its size for a language does not grow with the corpus
    per = steps.groupBy("language").agg(F.sort_array(F.collect_list(F.struct("step", "n"))).alias("steps"), F.sum("n").alias("docs"))

    def quantile(share: float) -> Column:
        """The lowest step below which at least this share of the documents lies."""
        reached = F.aggregate(
            "steps",
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("step")),
            lambda acc, s: F.struct(
                (acc["n"] + s["n"]).alias("n"),
                F.when(acc["step"].isNotNull(), acc["step"]).when(acc["n"] + s["n"] >= share * F.col("docs"), s["step"]).alias("step"),
            ),
        )
        return reached["step"] * STEP

    quartiles = per.select("language", "docs", quantile(0.25).alias("q1"), quantile(0.5).alias("q2"), quantile(0.75).alias("q3"))
    return quartiles.select(
        "language", "docs",
        (F.col("q2") - LOWER * F.greatest(F.col("q2") - F.col("q1"), F.lit(LEAST_SPREAD))).alias("low"),
        (F.col("q2") + UPPER * F.greatest(F.col("q3") - F.col("q2"), F.lit(LEAST_SPREAD))).alias("high"),
    )


def with_verdict(scored: DataFrame, band: DataFrame) -> DataFrame:
    """Adds base_failed and kept to scored rows. ``band`` is a written table."""
    own = band.where("language IS NOT NULL")
    # large languages set the band of all documents, which a rare one would fall out of as a whole
    some_large = not own.where(F.col("docs") >= LEAST_DOCS).isEmpty()
    own = own.where(F.lit(some_large)).select("language", "low", "high")
    of_all = band.where(F.col("language").isNull()).first()
    low, high = (of_all["low"], of_all["high"]) if of_all else (None, None)
    if own.limit(BROADCAST_BANDS + 1).count() <= BROADCAST_BANDS:
        own = F.broadcast(own)
    own = own.select(F.col("language").alias("_language"), F.col("low").alias("_low"), F.col("high").alias("_high"))
    joined = scored.join(own, F.coalesce("lang", F.lit("")) == F.col("_language"), "left")
    inside = F.col("log_perplexity").between(
        F.coalesce("_low", F.lit(low).cast("double")), F.coalesce("_high", F.lit(high).cast("double"))
    )
    return joined.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    ).drop("_language", "_low", "_high")


def judge(df: DataFrame) -> DataFrame:
    """Rows (doc_id, lang, text) with their counts, log_perplexity, base_failed and kept.

    A null text has no words and fails; a null language is a language of its own; repeated rows count
    each. Words are runs of anything but ASCII white space. An empty table gives no rows.
    """
    slim = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    scored = written(score(slim, train(slim)).drop("text"), "scored")
    return with_verdict(scored, written(bands(scored), "bands"))


def keep_good(df: DataFrame) -> DataFrame:
    """The rows of ``df`` (with at least lang and text) that the rules keep."""
    # other columns by number, as theirs may be the names of counts; each value goes to Python once
    held = [n.lower() if n.lower() in ("lang", "text") else f"_column{i}" for i, n in enumerate(df.columns)]
    counted = [f.split()[0] for f in _FEATURES.split(", ")]
    wide = score(df.toDF(*held), train(df))
    measured = written(wide.select("lang", *counted), "scored")
    kept = with_verdict(wide, written(bands(measured), "bands")).where("kept")
    return kept.select(*[F.col(own).alias(n) for own, n in zip(held, df.columns, strict=True)])
