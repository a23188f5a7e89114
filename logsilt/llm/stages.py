"""The operators as stages of the corpus pipeline: (spark, docs, sf_dir) to the next docs.

All but the last return the columns of ``docs``, which may be more than those of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logsilt.llm import near_dedup, ngram, packing, rules, secrets
from logsilt.llm.common import broadcast_if_small, table, written


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, learned from ``labels``, predicts to be good."""
    return rules.keep_good(docs, table(spark, sf_dir, "labels"))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counting rules and their language's perplexity band accept."""
    return ngram.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each class. Rows without an id all stay."""
    classes = written(near_dedup.near_duplicates(docs), "near_duplicates").where("doc_id IS NOT NULL")
    others = written(classes.where("doc_id <> class_id").select("doc_id").distinct(), "others")
    kept = docs.join(broadcast_if_small(others), "doc_id", "left_anti").select(docs.columns)
    if classes.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return kept
    # of rows that repeat an id, the one with the smallest text; rows without an id are told apart by hash
    each = Window.partitionBy("doc_id", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())).orderBy("text")
    return kept.withColumn("_nth", F.row_number().over(each)).where("_nth = 1").drop("_nth")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the spans found in their texts masked and n_chars counted anew."""
    found = secrets.secret_spans(docs.select(F.struct("*").alias("row"), "text"))
    text = secrets.redacted(F.col("text"), F.col("spans"))
    masked = found.select("row", text.alias("text"), (F.size("spans") > 0).alias("hit"))
    columns = []
    for name in docs.columns:
        value = F.col("row").getField(name)
        if name == "text":
            value = F.col("text")
        elif name == "n_chars":
            kind = docs.schema["n_chars"].dataType
            value = F.when(F.col("hit"), F.length("text").cast(kind)).otherwise(value)
        columns.append(value.alias(name))
    return masked.select(columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
