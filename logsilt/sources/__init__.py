"""Readers and writers."""

from logsilt.sources.avro import read_avro, write_avro
from logsilt.sources.files import (
    read_csv_header,
    read_glob,
    read_parquet_paths,
    read_partition,
    read_partition_folder,
    union_files,
)
from logsilt.sources.json_lines import (
    infer_json_schema,
    parse_json_flat,
    parse_json_lines,
    read_gbk_json_flat,
    read_gbk_json_typed,
    read_json_lines,
    read_lines,
    schema_rows,
)
from logsilt.sources.lines import parse_pipe, read_paragraph_records, read_pipe_text
from logsilt.sources.sinks import (
    write_backup_parquet,
    write_json,
    write_partition_parquet,
    write_text,
)

__all__ = [
    "infer_json_schema",
    "parse_json_flat",
    "parse_json_lines",
    "parse_pipe",
    "read_avro",
    "read_csv_header",
    "read_gbk_json_flat",
    "read_gbk_json_typed",
    "read_glob",
    "read_json_lines",
    "read_lines",
    "read_paragraph_records",
    "read_parquet_paths",
    "read_partition",
    "read_partition_folder",
    "read_pipe_text",
    "schema_rows",
    "union_files",
    "write_avro",
    "write_backup_parquet",
    "write_json",
    "write_partition_parquet",
    "write_text",
]
