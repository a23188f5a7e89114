"""Expressions behind the tracking columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logsilt.layout import TrackingNames


def update_time(now: int | None = None) -> Column:
    """Ingest time in epoch seconds; pass ``now`` for reproducible runs."""
    return F.unix_timestamp() if now is None else F.lit(now).cast("bigint")


def header_struct(names: TrackingNames, match_value: Column, now: int | None = None) -> Column:
    return F.struct(
        update_time(now).alias(names.update_time), match_value.alias(names.match_value)
    )


def random_bucket(buckets: int = 100) -> Column:
    """A random whole number in ``[0, buckets)``. For sampling and display, never as a shuffle key:
    a task that is run again would send its rows elsewhere."""
    return F.floor(F.rand() * buckets)
