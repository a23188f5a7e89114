"""The pipeline against its stages' operators, each on what the one before it kept."""

from __future__ import annotations

import corpus_pipeline
from logsilt.llm import near_dedup, ngram, rules, secrets
from logsilt.llm.common import table, written
from tests.llm.test_secrets import base_spans, entropy_spans
from tests.llm.test_tokens import check_packing

SF = "/root/testdata/sf0.001"


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "quality rules", "MinHash near-dedup", "secret scans", "best-fit packing",
    ]


def test_run(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    good = {r.doc_id for r in rules.classify(docs, labels).collect() if r.predicted}
    first = written(docs.where(docs.doc_id.isin(*good)), "first")
    kept = {r.doc_id for r in ngram.judge(first).collect() if r.kept}
    second = written(first.where(first.doc_id.isin(*kept)), "second")
    single = {r.doc_id for r in near_dedup.near_duplicates(second).collect() if r.doc_id == r.class_id}
    texts = {}
    for r in second.collect():
        if r.doc_id in single:
            text, at, out = r.text, 0, ""
            merged = []
            for a, _, b in sorted({*base_spans(text), *entropy_spans(text)}):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            for a, b in merged:
                out += text[at:a] + "[SECRET]"
                at = b
            texts[r.doc_id] = out + text[at:]
    assert secrets.KINDS[0] == "assign" and 0 < len(texts) < docs.count()
    used, least = check_packing(corpus_pipeline.run(spark, SF).collect(), texts)
    assert used <= least * 1.02 + 1


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels"):
        table(spark, SF, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
