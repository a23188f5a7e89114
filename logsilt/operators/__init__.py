"""DataFrame-to-DataFrame operators."""

from logsilt.operators.antijoin import anti_join_existing
from logsilt.operators.dedup import dedup_any, dedup_latest, distinct_values
from logsilt.operators.shape import (
    align_schema,
    drop_columns,
    expand_flat,
    expand_header,
    filter_action_time,
    project_exprs,
    rows_from_array,
    rows_from_map,
    with_partition_keys,
)

__all__ = [
    "align_schema",
    "anti_join_existing",
    "dedup_any",
    "dedup_latest",
    "distinct_values",
    "drop_columns",
    "expand_flat",
    "expand_header",
    "filter_action_time",
    "project_exprs",
    "rows_from_array",
    "rows_from_map",
    "with_partition_keys",
]
