"""The corpus pipeline: quality classifier, quality rules, near-dedup, secret scans, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logsilt.llm import stages
from logsilt.llm.common import table, written

STAGES = [
    ("quality classifier", stages.classify_quality),
    ("quality rules", stages.apply_rules),
    ("MinHash near-dedup", stages.drop_near_duplicates),
    ("secret scans", stages.redact_secrets),
    ("best-fit packing", stages.pack),
]

# Trained models, sampling by hash, iteration and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_").replace("-", "_"))
    return docs
