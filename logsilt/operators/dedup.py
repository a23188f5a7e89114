"""One row per key.

Both operators cut each map task's rows to one per key before the shuffle, so a key that holds a
large share of the input sends at most one row per map task.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_KEY = "__dedup_key_{}"
_RANK = "__dedup_rank"


def _with_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    """Keys as top-level columns; nested ones (``header.x``) get a helper column to drop later."""
    added = {_KEY.format(i): F.col(k) for i, k in enumerate(keys) if k not in df.columns}
    names = [k if k in df.columns else _KEY.format(i) for i, k in enumerate(keys)]
    return (df.withColumns(added) if added else df), names, list(added)


def dedup_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Any one row per key. Rows whose key is NULL form one group.

    Ordering a key's rows by the key itself leaves the choice open and still gives Spark the top-1
    form, which beats the sort-based aggregation behind ``dropDuplicates`` on wide rows.
    """
    return dedup_latest(df, keys, [F.col(k).asc() for k in keys])


def dedup_latest(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """The first row per key in the given order.

    A plain column name sorts descending (newest first); SQL like ``"ts ASC NULLS LAST"`` or a
    ``Column`` is taken as it is. Spark plans a top-1 group limit on both sides of the shuffle for this form.
    """
    if not order_by:
        raise ValueError("order_by must name at least one column")
    keyed, names, added = _with_keys(df, keys)
    window = Window.partitionBy(*names).orderBy(*[_ordering(o) for o in order_by])
    return (
        keyed.withColumn(_RANK, F.row_number().over(window))
        .where(F.col(_RANK) == 1)
        .drop(_RANK, *added)
    )


_ORDER = re.compile(r"(?is)^(.+?)(?:\s+(ASC|DESC))?(?:\s+NULLS\s+(FIRST|LAST))?$")


def _ordering(order: str | Column) -> Column:
    if isinstance(order, Column):
        return order
    expr, way, nulls = _ORDER.match(order.strip()).groups()
    name = f"{(way or 'desc').lower()}{f'_nulls_{nulls.lower()}' if nulls else ''}"
    return getattr(F.expr(expr), name)()


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct values of some columns, as a DataFrame."""
    return df.select(*[F.col(c) for c in columns]).distinct()
