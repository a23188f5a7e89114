from __future__ import annotations

import zlib

from logsilt.llm import queries, rules, stages
from logsilt.llm.common import table, written
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, words string"


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_held_out_accuracy_and_contract(spark):
    scored = {r.doc_id: r for r in queries.op3_rule_ensemble(spark, SF).collect()}
    docs = table(spark, SF, "documents").collect()
    assert len(scored) == len(docs)
    assert all(r.held_out == is_held_out(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in scored.items())
    truth = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    held = [(truth[i], scored[i].predicted) for i in truth if is_held_out(i)]
    right = sum(a == b for a, b in held)
    assert len(held) > 50 and right / len(held) >= 0.95
    assert sum(1 for a, b in held if a == 1 and b == 0) <= 0.02 * len(held)


def test_score_is_of_the_text_alone(spark):
    docs = table(spark, SF, "documents").limit(120)
    labels = table(spark, SF, "labels")
    model = rules.train(table(spark, SF, "documents"), labels)
    assert len(model.rules) > 0 and {s for _, r in model.rules for s, _, _ in r.conditions} <= set(rules.STATISTICS)
    changed = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "doc_id": F.col("doc_id") + 1_000_000})
    score = lambda df: sorted(r[0] for r in df.select(model.score_text(F.col("text"))).collect())
    assert score(docs) == score(changed)


def test_held_out_labels_are_not_learned_from(spark):
    rows = [(i, "word " * 60 if i % 2 else "%%% " * 60, "en", "s", "") for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    honest = [(i, i % 2) for i in range(400)]
    # held-out labels turned round change nothing
    turned = [(i, 1 - q if is_held_out(i) else q) for i, q in honest]
    results = []
    for labels in (honest, turned):
        got = rules.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        results.append(sorted((r.doc_id, r.score) for r in got))
        assert all(r.predicted == r.doc_id % 2 for r in got)
    assert results[0] == results[1]


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "a b", "en", "s", "x"), (2, "", "en", "s", "x"), (2, "", "en", "s", "x"), (3, "y " * 200_000, "en", "s", "x")]
    docs = spark.createDataFrame(rows, DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = rules.classify(docs, none).collect()
    assert len(got) == 5 and {r.score for r in got} == {0.5}
    one = spark.createDataFrame([(1, 1), (3, 1), (4, None), (None, 0), (5, 7)], "doc_id long, quality int")
    assert all(r.score > 0.9 for r in rules.classify(docs, one).collect())
    assert rules.classify(docs.limit(0), one).collect() == []


def test_statistics(spark):
    df = spark.createDataFrame([(1, "AB ab ab\nAB ab!! #x", "", "", ""), (2, None, "", "", "")], DOCS)
    a, b = (r.s for r in df.orderBy("doc_id").select(rules.statistics(F.col("text")).alias("s")).collect())
    assert set(b) == {0.0} and len(b) == len(rules.STATISTICS)
    assert (a.distinct_words, a.echoes, a.distinct_lines) == (4 / 6, 1 / 6, 1.0)
    assert (a.capital_words, a.shout_words, a.marked_words) == (2 / 6, 1 / 6, 1 / 6)
    assert (a.marks, a.shouts, a.capitals, a.stops) == (1 / 19, 2 / 19, 4 / 19, 2 / 6)


def test_stage_keeps_columns(spark):
    docs = written(table(spark, SF, "documents").withColumn("score", F.lit("own")).withColumn("row", F.lit(1)), "docs")
    kept = stages.classify_quality(spark, docs, SF)
    assert kept.columns == docs.columns
    good = {r.doc_id for r in queries.op3_rule_ensemble(spark, SF).collect() if r.predicted}
    assert {r.doc_id for r in kept.collect()} == good


def test_the_bound_holds_for_repeated_ids(spark, monkeypatch):
    """Many rows of one labelled id, with two texts, count once; so do repeated labels."""
    one = next(i for i in range(20) if not is_held_out(i))
    rows = [(one, "good words " * 40 if i % 2 else "bad %% " * 30, "en", "s", "") for i in range(3000)]
    rows += [(i, "word " * (50 + i % 9) if i % 2 else "%%% " * 60, "en", "s", "") for i in range(100, 300)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(one, 1), (one, 1), *[(i, i % 2) for i in range(100, 300)]], "doc_id long, quality int")
    fitted, fit = [], rules.fit
    monkeypatch.setattr(rules, "fit", lambda frame: fitted.append(frame.count()) or fit(frame))
    rules.train(docs, labels, rows=50)
    rules.train(docs.union(docs), labels, rows=1000)
    assert fitted[0] <= 50 and fitted[1] == 1 + sum(not is_held_out(i) for i in range(100, 300))


def test_score_expression_equals_trees_and_weights(spark):
    """The compiled column against rules and weights taken one by one in Python."""
    import math

    documents = table(spark, SF, "documents")
    model = rules.train(documents, table(spark, SF, "labels"))
    stats = documents.select("doc_id", rules.statistics(F.col("text")).alias("s"), model.score_text(F.col("text")).alias("score"))
    for row in stats.collect():
        total = model.bias
        for weight, rule in model.rules:
            if all((row.s[name] <= cut) == below for name, below, cut in rule.conditions):
                total += weight
        assert math.isclose(row.score, 1 / (1 + math.exp(-total)), abs_tol=1e-9)
