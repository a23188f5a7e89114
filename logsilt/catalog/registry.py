"""Lookups that configure an ingest: rules and registered schemas, kept as tables."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logsilt.layout import Rule
from logsilt.operators.dedup import dedup_latest


def rule_lookup(rules: DataFrame, order: str = "rule_id") -> DataFrame:
    """The first rule row of every subject."""
    return dedup_latest(rules, ["subject"], [f"{order} ASC"])


def latest_schema(schemas: DataFrame, version: str = "version") -> DataFrame:
    """The newest schema row of every subject."""
    return dedup_latest(schemas, ["subject"], [version])


def load_rule(rules: DataFrame, subject: str) -> Rule:
    """The rule of one subject from columns ``subject, rule_id, match_key, time_key, partition,
    files, file_type`` and, optionally, ``order_by`` (an array of SQL expressions)."""
    row = rule_lookup(rules.where(F.col("subject") == subject)).first()
    if row is None:
        raise LookupError(f"no rule for subject {subject}")
    found = row.asDict()
    return Rule(
        subject=subject,
        match_key=found["match_key"],
        time_key=found["time_key"],
        partition=found["partition"],
        files=found.get("files"),
        file_type=found["file_type"],
        order_by=tuple(found.get("order_by") or ()),
    )


def load_schema(schemas: DataFrame, subject: str) -> StructType:
    """The newest registered schema of one subject, from columns ``subject, version, schema``."""
    row = latest_schema(schemas.where(F.col("subject") == subject)).first()
    if row is None:
        raise LookupError(f"no schema for subject {subject}")
    return struct_from_avro(schemas.sparkSession, row["schema"])


def struct_from_avro(spark: SparkSession, text: str) -> StructType:
    """The Spark schema of an Avro record schema given as JSON text, by Spark's own converter.

    So a subject has the same types whether its batches come as Avro or are read by this schema,
    logical types (dates, timestamps, decimals) included.
    """
    jvm = spark._jvm
    try:
        parsed = getattr(jvm.org.apache.avro, "Schema$Parser")().parse(text)
        converters = getattr(jvm.org.apache.spark.sql.avro, "SchemaConverters$")
        kind = json.loads(getattr(converters, "MODULE$").toSqlType(parsed).dataType().json())
    except Py4JJavaError as error:
        raise ValueError(f"not an Avro schema: {error.java_exception.getMessage()}") from error
    if not isinstance(kind, dict) or kind.get("type") != "struct":
        raise ValueError("the schema of a subject must be an Avro record")
    return StructType.fromJson(kind)
