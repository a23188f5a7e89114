"""Quality classifier: a sparse rule ensemble over text statistics, compiled to Spark columns.

Trees are grown on a bounded sample of labelled rows, every path from a root is a rule (a conjunction
of thresholds on statistics), a logistic regression with an L1 penalty weighs the rules, and those
with a weight become one Spark expression. Scoring runs no model code, only that expression.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsilt.llm.common import written
from logsilt.llm.secrets import let

#: Most labelled rows that the model is fitted on; scoring covers every row.
TRAINING_ROWS = 15_000
TREES, DEPTH, PENALTY, SEED = 24, 3, 0.002, 42
CUT = 0.7

_MARKS = "#*$%&|<>"
_DIGITS = "0123456789"

#: Names of the statistics, in the order of the model's inputs.
STATISTICS = (
    "log_words", "word_length", "marks", "shouts", "digits", "capitals", "pipes", "distinct_words", "echoes",
    "distinct_lines", "marked_words", "shout_words", "capital_words", "line_words", "stops",
)


class Rule(NamedTuple):
    """All conditions hold: (statistic, whether at most the threshold, threshold)."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self, of: Callable[[str], Column] = F.col) -> Column:
        tests = [of(s) <= F.lit(t) if below else of(s) > F.lit(t) for s, below, t in self.conditions]
        return reduce(lambda a, b: a & b, tests).cast("double")


class Ensemble(NamedTuple):
    bias: float
    rules: tuple[tuple[float, Rule], ...]

    def score(self, of: Callable[[str], Column] = F.col) -> Column:
        """Probability of label 1 from the statistics, which ``of`` gives by name."""
        total = reduce(lambda a, b: a + b, [F.lit(w) * r.column(of) for w, r in self.rules], F.lit(self.bias))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def score_text(self, text: Column) -> Column:
        """The same from a text, as one expression that computes each statistic once wherever Spark
        moves it (a filter on columns is pushed below them, and would compute them for every rule)."""
        return let(statistics(text), lambda s: self.score(lambda name: s[name]))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def statistics(text: Column) -> Column:
    """Struct of the statistics of a text; a null text counts as empty, and all are 0 for it."""
    text = F.coalesce(text, F.lit(""))

    def without(chars: str) -> Column:
        return F.length(text) - F.length(F.translate(text, chars, ""))

    def of_words(words: Column) -> Column:
        marked = F.filter(words, lambda w: F.rlike(w, F.lit(r"[#*$%&|<>]")))
        shouted = F.filter(words, lambda w: F.endswith(w, F.lit("!!")))
        capital = F.filter(words, lambda w: (F.length(w) > 1) & (F.upper(w) == w) & (F.lower(w) != w))
        echo = F.filter(words, lambda w, i: w == F.get(words, i - 1))
        return F.struct(
            F.size(words).alias("n"), F.size(F.array_distinct(words)).alias("distinct"), F.size(marked).alias("marked"),
            F.size(shouted).alias("shouted"), F.size(capital).alias("capital"), F.size(echo).alias("echo"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).alias("n"), F.size(F.array_distinct(lines)).alias("distinct"))

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line != "")
    counts = F.struct(
        let(words, of_words).alias("words"), let(lines, of_lines).alias("lines"), F.length(text).alias("chars"),
        without(_MARKS).alias("marks"), without("!").alias("shouts"), without(_DIGITS).alias("digits"),
        without("|").alias("pipes"), F.length(F.regexp_replace(text, r"\P{Lu}+", "")).alias("capitals"),
        without(".!?").alias("stops"),
    )

    def shares(c: Column) -> Column:
        n, chars = c["words"]["n"], c["chars"]
        found = {
            "log_words": F.log1p(n), "word_length": _share(chars, n), "marks": _share(c["marks"], chars),
            "shouts": _share(c["shouts"], chars), "digits": _share(c["digits"], chars),
            "capitals": _share(c["capitals"], chars), "pipes": _share(c["pipes"], n),
            "distinct_words": _share(c["words"]["distinct"], n), "echoes": _share(c["words"]["echo"], n),
            "distinct_lines": _share(c["lines"]["distinct"], c["lines"]["n"]),
            "marked_words": _share(c["words"]["marked"], n), "shout_words": _share(c["words"]["shouted"], n),
            "capital_words": _share(c["words"]["capital"], n), "line_words": _share(n, c["lines"]["n"]),
            "stops": _share(c["stops"], n),
        }
        return F.struct(*[found[name].alias(name) for name in STATISTICS])

    return let(counts, shares)


def _paths(tree) -> list[Rule]:
    """Rules of all paths from the root of a fitted tree; of tests on one side of a statistic the
    strictest is kept."""
    found = []

    def walk(node, held: dict[tuple[str, bool], float]) -> None:
        if held:
            found.append(Rule(tuple(sorted((s, below, t) for (s, below), t in held.items()))))
        if node.numDescendants() == 0:
            return
        split = node.split()
        statistic, threshold = STATISTICS[split.featureIndex()], float(split.threshold())
        for below, child in ((True, node.leftChild()), (False, node.rightChild())):
            before = held.get((statistic, below))
            tighter = threshold if before is None else (min if below else max)(before, threshold)
            walk(child, held | {(statistic, below): tighter})

    walk(tree._call_java("rootNode"), {})
    return found


def fit(sample: DataFrame) -> Ensemble:
    """The ensemble for a written table of statistics and ``label`` (0.0 or 1.0).

    Without rows the score is 0.5 everywhere; with one label only it is near that label.
    """
    counts = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return Ensemble({None: 0.0, 0.0: -5.0, 1.0: 5.0}[next(iter(counts), None)], ())
    data = VectorAssembler(inputCols=list(STATISTICS), outputCol="statistics").transform(sample)
    forest = RandomForestClassifier(
        featuresCol="statistics", labelCol="label", numTrees=TREES, maxDepth=DEPTH, maxBins=64, seed=SEED, subsamplingRate=0.7
    ).fit(data)
    rules = sorted({rule for tree in forest.trees for rule in _paths(tree)})
    if not rules:
        share = counts[1.0] / sum(counts.values())
        return Ensemble(math.log(share / (1 - share)), ())
    held = sample.select("label", F.array(*[r.column() for r in rules]).alias("held"))
    vectors = written(held, "rules").select("label", array_to_vector(F.col("held")).alias("held"))
    lasso = LogisticRegression(
        featuresCol="held", labelCol="label", elasticNetParam=1.0, regParam=PENALTY, standardization=False, maxIter=100
    ).fit(vectors)
    weights = lasso.coefficients.toArray()
    return Ensemble(
        float(lasso.intercept), tuple((float(w), r) for w, r in zip(weights, rules, strict=True) if abs(w) > 1e-6)
    )


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Ensemble:
    """Fit on at most ``rows`` labelled documents that are not held out, those of smallest hash.

    Of rows that repeat an id, the text of smallest hash counts, once per label.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = (
        usable.select("doc_id", F.col("quality").cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    )
    # at most ``rows`` narrow rows, so they are sent to the documents rather than the other way round
    texts = documents.select("doc_id", "text").join(F.broadcast(written(chosen, "labelled")), "doc_id")
    each = texts.select("doc_id", "label", F.struct(F.xxhash64("text"), statistics(F.col("text")).alias("s")).alias("one"))
    sample = each.groupBy("doc_id", "label").agg(F.min("one").alias("one")).select("label", "one.s.*")
    # at most ``rows`` narrow rows, in one file and a fixed order, make the fit repeatable
    one = written(sample, "statistics").coalesce(1).sortWithinPartitions("label", *STATISTICS)
    return fit(written(one, "training"))


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``documents``.

    Only ``quality`` of 0 or 1 is learned from; a null or empty text has all statistics 0 and gets
    the score of that; a null doc_id is not held out; repeated rows are scored each. Scores use the
    text alone.
    """
    ensemble = train(documents, labels)
    scored = documents.select("doc_id", ensemble.score_text(F.col("text")).alias("score"))
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` whose score reaches the cut."""
    ensemble = train(documents, labels)
    return documents.where(ensemble.score_text(F.col("text")) >= CUT)
