"""What the tests of the operators share."""

from __future__ import annotations

from pyspark.sql import functions as F


def as_rows(spark, rows, clashing=(), schema="doc_id long, text string"):
    """Rows as a table with more columns, of names that an operator may use itself."""
    table = spark.createDataFrame(rows, schema)
    return table.withColumns({name: F.lit("x") for name in clashing})
