"""Column functions."""

from logsilt.functions.action_time import (
    action_time,
    fits_rule,
    format_partition,
    parse_partition,
    partition_spec,
    partition_values,
    spec_to_path,
    within_late_window,
)
from logsilt.functions.text import decode_gbk, encode_gbk, json_map, split_pipe
from logsilt.functions.tracking import header_struct, random_bucket, update_time

__all__ = [
    "action_time",
    "decode_gbk",
    "encode_gbk",
    "fits_rule",
    "format_partition",
    "header_struct",
    "json_map",
    "parse_partition",
    "partition_spec",
    "partition_values",
    "random_bucket",
    "spec_to_path",
    "split_pipe",
    "update_time",
    "within_late_window",
]
