"""Pipelines: ingest, offline merge, compaction."""

from logsilt.plans.compaction import compact, run_history
from logsilt.plans.landing import (
    Landed,
    ingest,
    ingest_files,
    offline_merge,
    read_batch,
    run_offline,
    run_online,
)
from logsilt.plans.merging import merge_new_rows
from logsilt.plans.reports import distinct_column, distinct_of_table
from logsilt.plans.snapshots import read_as_of

__all__ = [
    "Landed",
    "compact",
    "distinct_column",
    "distinct_of_table",
    "ingest",
    "ingest_files",
    "merge_new_rows",
    "offline_merge",
    "read_as_of",
    "read_batch",
    "run_history",
    "run_offline",
    "run_online",
]
