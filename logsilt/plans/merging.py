"""The merge as a plain plan: which rows of a batch are new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsilt.operators.antijoin import anti_join_existing
from logsilt.operators.dedup import dedup_any, dedup_latest

_MATCH = "__match"


def merge_new_rows(
    batch: DataFrame,
    stored: DataFrame | None,
    partition_cols: Sequence[str],
    match: str,
    stored_match: str | None = None,
    order_by: Sequence[str] = (),
    null_safe: bool = False,
) -> DataFrame:
    """One row per key of the batch, without keys that are stored already.

    The key is (partition, match value): the same match value in two partitions is kept twice.
    Stored rows win over new ones. Deduplication and anti join cluster by the same columns, so the
    batch is shuffled once; the stored side contributes its distinct keys only.
    """
    keyed = batch.withColumn(_MATCH, F.col(match))
    # the match value leads, because rows of one batch often share their partition values
    keys = [_MATCH, *partition_cols]
    unique = dedup_latest(keyed, keys, order_by) if order_by else dedup_any(keyed, keys)
    if stored is None:
        return unique.drop(_MATCH)
    fresh = anti_join_existing(
        unique,
        stored,
        keys,
        stored_keys=[stored_match or match, *partition_cols],
        null_safe=null_safe,
        spread=False,  # after deduplication no key is frequent, and each partition has one NULL at most
    )
    return fresh.drop(_MATCH)
