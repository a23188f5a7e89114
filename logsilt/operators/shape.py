"""Projections: tracking columns, schema alignment, rows from arrays and maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logsilt.functions.action_time import partition_parts
from logsilt.functions.tracking import header_struct, update_time
from logsilt.layout import TrackingNames, partition_keys, quoted, time_keys

_PARTS = "__parts"


def expand_flat(
    df: DataFrame,
    match_key: str,
    time_key: str,
    names: TrackingNames = TrackingNames(),
    now: int | None = None,
) -> DataFrame:
    """Add update time, match value and action time as last columns."""
    return df.select(
        "*",
        update_time(now).alias(names.update_time),
        F.expr(match_key).alias(names.match_value),
        F.expr(time_key).cast("string").alias(names.action_time),
    )


def expand_header(
    df: DataFrame,
    match_key: str,
    time_key: str,
    names: TrackingNames = TrackingNames(),
    now: int | None = None,
) -> DataFrame:
    """Put a header struct and the action time in front.

    An input that has a header struct of its own keeps it, with the tracking fields added, so the
    result never holds two columns of that name.
    """
    match_value = F.expr(match_key)
    if names.header in df.columns:
        header = (
            F.coalesce(F.col(quoted(names.header)), _empty_struct(df, names.header))
            .withField(names.update_time, update_time(now))
            .withField(names.match_value, match_value)
        )
    else:
        header = header_struct(names, match_value, now)
    body = [F.col(quoted(c)) for c in df.columns if c != names.header]
    return df.select(
        header.alias(names.header),
        F.expr(time_key).cast("string").alias(names.action_time),
        *body,
    )


def _empty_struct(df: DataFrame, name: str) -> Column:
    """A struct of NULL fields, so that a NULL header can still take the tracking fields."""
    fields = df.schema[name].dataType.fields
    return F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def align_schema(df: DataFrame, schema: StructType, cast: bool = False) -> DataFrame:
    """Exactly the target's columns, in its order: present ones as they are, absent ones NULL.

    Names are compared with case. ``cast=True`` also brings present columns to the target type,
    with NULL where a value cannot be read as that type.
    """
    have = set(df.columns)

    def column(field) -> Column:
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        kept = F.col(quoted(field.name))
        if cast and df.schema[field.name].dataType != field.dataType:
            kept = kept.try_cast(field.dataType)
        return kept.alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def project_exprs(df: DataFrame, *exprs: str) -> DataFrame:
    return df.selectExpr(*exprs)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def rows_from_array(df: DataFrame, column: str, schema: StructType, *keep: str) -> DataFrame:
    """Array elements by position to typed columns; missing ones NULL, extra ones ignored."""
    values = F.col(quoted(column))
    return df.select(
        *[F.col(quoted(k)) for k in keep],
        *[F.get(values, i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)],
    )


def rows_from_map(df: DataFrame, column: str, schema: StructType, *keep: str) -> DataFrame:
    """Map entries by field name to typed columns; missing ones NULL, extra ones ignored."""
    values = F.col(quoted(column))
    return df.select(
        *[F.col(quoted(k)) for k in keep],
        *[
            F.try_element_at(values, F.lit(f.name)).try_cast(f.dataType).alias(f.name)
            for f in schema.fields
        ],
    )


def filter_action_time(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows of one action time. Pushed to the scan, or to partition pruning on a partition key."""
    return df.where(F.col(column) == value)


def with_partition_keys(
    df: DataFrame, action_time: str, rule: str, taken_prefix: str | None = None
) -> DataFrame:
    """Replace the action time by the table's time keys; NULL keys mark rows that do not fit.

    A column that has the name of a key is an error, or with ``taken_prefix`` gets that in front.
    """
    keys = partition_keys(rule)
    if taken_prefix:
        df = df.withColumnsRenamed({c: taken_prefix + c for c in df.columns if c.lower() in keys})
    body = [c for c in df.columns if c != action_time]
    taken = sorted(c for c in body if c.lower() in keys)
    if taken:
        raise ValueError(f"columns {taken} have the name of a partition key; rename them first")
    parts = partition_parts(F.col(quoted(action_time)), rule)
    split = df.select(*[quoted(c) for c in body], parts.alias(_PARTS))
    return split.select(
        *[quoted(c) for c in body],
        *[F.get(_PARTS, F.lit(i)).alias(key) for i, key in enumerate(time_keys(rule))],
    )
