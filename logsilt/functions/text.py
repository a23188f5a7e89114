"""Text functions: pipe splitting, GBK, flat JSON maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsilt.layout import quoted
from logsilt.session import settings


def split_pipe(text: Column, drop_trailing_empty: bool = False) -> Column:
    """Fields between ``|``. Trailing empty fields are kept unless asked otherwise."""
    if not drop_trailing_empty:
        return F.split(text, "[|]", -1)
    only_bars = text.rlike("^[|]+$")
    return F.when(only_bars, F.array().cast("array<string>")).otherwise(
        F.split(F.regexp_replace(text, "[|]+$", ""), "[|]", -1)
    )


def json_map(text: Column, options: dict[str, str] | None = None) -> Column:
    """A flat JSON object as ``map<string,string>``; NULL when it is not an object."""
    return F.from_json(text, "map<string,string>", options or {})


# Allows Java charsets, with replacement of undecodable bytes. Spark fixes both choices in an expression
# when it is analysed, so nothing has to stay set while a query runs.
_JAVA_CHARSETS = {"spark.sql.legacy.javaCharsets": "true", "spark.sql.legacy.codingErrorAction": "true"}


def decode_gbk(df: DataFrame, source: str, target: str | None = None) -> DataFrame:
    """GBK bytes (binary, or a string column still holding raw bytes) to text.

    Decode before looking for ``|`` or parsing JSON: 0x7C and 0x5C can be the second byte of a
    character. Splitting into lines first is safe, 0x0A never is.
    """
    with settings(df.sparkSession, _JAVA_CHARSETS):
        raw = F.col(quoted(source)).cast("binary")
        return df.withColumn(target or source, F.decode(raw, "GBK"))


def encode_gbk(df: DataFrame, source: str, target: str | None = None) -> DataFrame:
    """Text to GBK bytes, the inverse of :func:`decode_gbk`."""
    with settings(df.sparkSession, _JAVA_CHARSETS):
        return df.withColumn(target or source, F.encode(F.col(quoted(source)), "GBK"))
