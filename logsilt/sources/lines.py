"""Readers over text lines: pipe-separated rows and blank-line-separated records."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logsilt.functions.text import split_pipe
from logsilt.layout import quoted
from logsilt.operators.shape import rows_from_array
from logsilt.session import on_path
from logsilt.sources.files import as_paths

_FIELDS, _LINE = "__fields", "__line"


def parse_pipe(
    lines: DataFrame, schema: StructType, column: str = "value", malformed: str | None = None
) -> DataFrame:
    """``a|b|c`` to typed columns by position: missing fields NULL, extra fields ignored.

    A value that its type cannot take is NULL. The column ``malformed``, if named, has the line then.
    """
    text = F.col(quoted(column))
    split = lines.select(split_pipe(text).alias(_FIELDS), text.alias(_LINE))
    rows = rows_from_array(split, _FIELDS, schema, _LINE)
    if malformed is None:
        return rows.drop(_LINE)
    values = [(F.get(_FIELDS, F.lit(i)), f.dataType) for i, f in enumerate(schema.fields)]
    unread = reduce(
        Column.__or__, [(v != "") & v.try_cast(t).isNull() for v, t in values], F.lit(False)
    )
    bad = split.withColumn(malformed, F.when(F.coalesce(unread, F.lit(False)), F.col(_LINE)))
    return rows_from_array(bad, _FIELDS, schema, malformed).select(
        *[quoted(f.name) for f in schema.fields], quoted(malformed)
    )


def read_pipe_text(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType, malformed: str | None = None
) -> DataFrame:
    return parse_pipe(spark.read.text(as_paths(paths)), schema, malformed=malformed)


def read_paragraph_records(
    spark: SparkSession, paths: str | Sequence[str], *record_exprs: str, separator: str | None = None
) -> DataFrame:
    """Records separated by blank lines, each parsed by the caller's SQL over ``value``.

    ``read_paragraph_records(spark, p, "from_json(value, 'a int') AS r")``. Without expressions the
    records come back as text. A line that is empty or white space separates, whether lines end in LF
    or CRLF, so ``separator`` is not needed; a record keeps the line ends inside it.

    Files are read by line and cut into tasks anywhere. Blank lines are told and counted by Spark and go no
    further; a task joins the other lines of its blocks where no number is missing between them. Only the
    first and the last piece of a block, where a file has several, are left open; such pieces belong
    together if no blank line stands between them, which the blank lines counted per block say. For that,
    the lines are read three times.
    """
    start, stop = F.col("_metadata.file_block_start"), F.col("_metadata.file_block_start") + F.col("_metadata.file_block_length")
    lines = spark.read.option("lineSep", "\n").text(as_paths(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), start.alias("start"),
        ((start == 0) & (stop >= F.col("_metadata.file_size"))).alias("alone"),
        # within a task, lines are numbered as they are read
        F.monotonically_increasing_id().alias("line"), (F.ltrim("value", F.lit(" \t\r")) == "").alias("blank"),
    )
    on_path(spark)
    full = lines.where(~F.col("blank")).drop("blank")
    pieces = full.mapInArrow(_pieces, "value string, file string, start bigint, line bigint, full bigint, open boolean")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        lines.where(~F.col("alone")).groupBy("file", "start")
        .agg(F.min("line").alias("head"), F.count_if("blank").alias("blanks"))
        .select("file", "start", "head", F.coalesce(F.sum("blanks").over(before), F.lit(0)).alias("base"))
    )
    # the blank lines of the file before a piece
    record = F.col("base") + F.col("line") - F.col("head") - F.col("full")
    joined = (
        pieces.where("open").join(blocks, ["file", "start"]).groupBy("file", record.alias("record"))
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "value"))), lambda p: p["value"]), "\n").alias("value"))
    )
    records = pieces.where(~F.col("open")).select("value").unionByName(joined.select("value"))
    records = records.select(F.regexp_replace("value", "\r$", "").alias("value"))
    return records.selectExpr(*record_exprs) if record_exprs else records


@dataclass
class _Piece:
    """Lines without a gap, as far as they were read: the number of the first and of the next one, and how
    many lines of the block that are not blank come before."""

    file: str
    start: int
    alone: bool
    line: int
    next: int
    full: int
    first: bool
    texts: list[str]

    def row(self, last: bool) -> tuple:
        """The first and the last piece of a block may go on in its neighbours."""
        is_open = not self.alone and (self.first or last)
        return ("\n".join(self.texts), self.file, self.start, self.line, self.full, is_open)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    piece = None
    for batch in batches:
        if not batch.num_rows:
            continue
        value, file, start, alone, line = (batch.column(c) for c in ("value", "file", "start", "alone", "line"))
        other = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(start[1:], start[:-1])).to_numpy(zero_copy_only=False)
        numbers = line.to_numpy()
        begins = np.flatnonzero(np.concatenate([[True], other | (np.diff(numbers) > 1)]))
        ends = np.append(begins[1:], batch.num_rows)
        offsets = pa.array(np.append(begins, batch.num_rows), pa.int32())
        texts = pc.binary_join(pa.ListArray.from_arrays(offsets, value), "\n").to_pylist()
        of_block = np.concatenate([[0], np.cumsum(other)])[begins]
        rows: list[tuple] = []
        block = -1
        for text, at, end, number in zip(texts, begins.tolist(), ends.tolist(), of_block.tolist(), strict=True):
            if number != block:
                block, key = number, (file[at].as_py(), start[at].as_py(), alone[at].as_py())
            first = int(numbers[at])
            same = piece is not None and key == (piece.file, piece.start, piece.alone)
            if same and first == piece.next:
                piece.texts.append(text)
                piece.next += end - at
                continue
            if piece is not None:
                rows.append(piece.row(last=not same))
            full = piece.full + piece.next - piece.line if same else 0
            piece = _Piece(*key, first, first + end - at, full, not same, [text])
        yield _rows(rows)
    if piece is not None:
        yield _rows([piece.row(last=True)])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 6
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
    names = ("value", "file", "start", "line", "full", "open")
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
