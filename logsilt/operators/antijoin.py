"""Rows whose key is not stored yet."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from logsilt.layout import quoted

_LEFT = "__left_key_{}"
_RIGHT = "__right_key_{}"
_LEFT_SPREAD = "__left_spread"
_RIGHT_SPREAD = "__right_spread"


def anti_join_existing(
    new: DataFrame,
    stored: DataFrame,
    keys: Sequence[str],
    stored_keys: Sequence[str] | None = None,
    null_safe: bool = False,
    spread: bool = True,
) -> DataFrame:
    """Rows of ``new`` whose key does not occur in ``stored``.

    A NULL key equals nothing, so such rows are always kept; ``null_safe=True`` lets NULL match
    NULL instead. ``stored`` is cut to its distinct keys, combined before the shuffle, so a key that
    is stored many times costs one row per map task.

    ``spread=True`` is for a ``new`` in which one key may be frequent. Rows with NULL keys, which
    match nothing, are spread by a hash of the row. Other frequent keys, and equal rows, are split
    by Spark's adaptive skew join; it acts on a join that sits right on its two shuffles, so the
    distinct keys are shuffled once more for it. Turn it off when ``new`` has no frequent key.
    """
    stored_keys = list(stored_keys or keys)
    right_names = [_RIGHT.format(i) for i in range(len(keys))]
    right = stored.select(*[F.col(k).alias(n) for k, n in zip(stored_keys, right_names)])
    if not null_safe:
        right = right.where(reduce(Column.__and__, [F.col(n).isNotNull() for n in right_names]))
    right = right.distinct()

    left_names = [k if k in new.columns else _LEFT.format(i) for i, k in enumerate(keys)]
    added = {n: F.col(k) for n, k in zip(left_names, keys) if n != k}
    left = new.withColumns(added) if added else new

    if spread:
        # equal keys must hash alike, so both sides are hashed in the type they are compared in
        types = _common_types(left, left_names, right, right_names)
        by_key = F.xxhash64(*[F.col(n).cast(t) for n, t in zip(left_names, types)])
        if not null_safe:
            any_null = reduce(Column.__or__, [F.col(n).isNull() for n in left_names])
            by_row = F.xxhash64(*[F.col(quoted(f.name)) for f in left.schema.fields if _hashable(f.dataType)])
            by_key = F.when(any_null, by_row).otherwise(by_key)
        left = left.withColumn(_LEFT_SPREAD, by_key)
        right = right.withColumn(
            _RIGHT_SPREAD, F.xxhash64(*[F.col(n).cast(t) for n, t in zip(right_names, types)])
        )
        left_names, right_names = [*left_names, _LEFT_SPREAD], [*right_names, _RIGHT_SPREAD]

    def same(a: str, b: str) -> Column:
        return F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b)

    matched = reduce(Column.__and__, [same(a, b) for a, b in zip(left_names, right_names)])
    return left.join(right, matched, "left_anti").drop(_LEFT_SPREAD, *added)


def _common_types(
    left: DataFrame, left_names: Sequence[str], right: DataFrame, right_names: Sequence[str]
) -> list[DataType]:
    """The types in which Spark compares the keys of both sides."""
    pairs = [(left.schema[a].dataType, right.schema[b].dataType) for a, b in zip(left_names, right_names)]
    both = [F.coalesce(F.lit(None).cast(a), F.lit(None).cast(b)).alias(str(i)) for i, (a, b) in enumerate(pairs)]
    return [f.dataType for f in left.sparkSession.range(0).select(*both).schema.fields]


def _hashable(data_type: DataType) -> bool:
    if isinstance(data_type, StructType):
        return all(_hashable(f.dataType) for f in data_type.fields)
    if isinstance(data_type, ArrayType):
        return _hashable(data_type.elementType)
    return not isinstance(data_type, (MapType, VariantType))
