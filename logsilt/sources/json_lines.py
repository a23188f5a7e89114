"""JSON lines, UTF-8 or GBK: typed parsing, flat maps, schema inference."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from logsilt.functions.text import decode_gbk, json_map
from logsilt.layout import quoted
from logsilt.operators.shape import rows_from_map
from logsilt.sources.files import as_paths

_log = logging.getLogger(__name__)

# Defaults of the JSON reader options.
JSON_DEFAULTS = {
    "samplingRatio": "1.0",
    "primitivesAsString": "false",
    "prefersDecimal": "false",
    "allowComments": "false",
    "allowUnquotedFieldNames": "false",
    "allowSingleQuotes": "true",
    "allowNumericLeadingZeros": "false",
    "allowNonNumericNumbers": "true",
    "allowBackslashEscapingAnyCharacter": "false",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    # dates and timestamps that do not fit the patterns are tried as plain ISO text
    "enableDateTimeParsingFallback": "true",
}
MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")
CORRUPT = "_corrupt_record"

_TEXT, _ONE, _MANY, _MAP, _BAD = "__text", "__one", "__many", "__map", "__bad"


def json_options(options: dict[str, str] | None = None) -> tuple[dict[str, str], str, str]:
    """Reader options over the defaults, the parse mode, and the corrupt-record column."""
    given = {k: str(v) for k, v in (options or {}).items()}
    merged = {**JSON_DEFAULTS, **given}
    mode = merged.pop("mode", "PERMISSIVE").upper()
    if mode not in MODES:
        _log.warning("%s is not a parse mode, using PERMISSIVE", mode)
        mode = "PERMISSIVE"
    if float(merged["samplingRatio"]) <= 0:
        raise ValueError("samplingRatio must be greater than 0")
    return merged, mode, merged.pop("columnNameOfCorruptRecord", CORRUPT)


def read_lines(
    spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8"
) -> DataFrame:
    """Text lines as column ``value``; GBK is decoded line by line."""
    lines = spark.read.text(as_paths(paths))
    if encoding.upper() == "GBK":
        return decode_gbk(lines, "value")
    if encoding.upper().replace("-", "") != "UTF8":
        raise ValueError(f"encoding must be UTF-8 or GBK: {encoding!r}")
    return lines


def parse_json_lines(
    lines: DataFrame,
    schema: StructType,
    options: dict[str, str] | None = None,
    column: str = "value",
) -> DataFrame:
    """One JSON object per line to typed columns; a top-level array gives one row per element.

    A line is malformed when it is not JSON, or when any field holds a value its type cannot take.
    By mode such a line becomes one all-NULL row (with the line in the corrupt-record column, if the
    schema has it), is dropped, or fails the query. Blank lines and unknown fields are skipped.
    """
    opts, mode, corrupt = json_options(options)
    body = StructType([StructField(f.name, f.dataType) for f in schema.fields if f.name != corrupt])
    probe = StructType([*body.fields, StructField(corrupt, StringType())])
    probe_opts = {**opts, "columnNameOfCorruptRecord": corrupt}

    def malformed(record: Column) -> Column:
        return record.isNull() | record[corrupt].isNotNull()

    text = F.col(_TEXT)
    is_list = F.ltrim(text).startswith("[")
    parsed = (
        lines.select(F.col(quoted(column)).alias(_TEXT))
        .where(F.trim(_TEXT) != "")
        .withColumns(
            {
                _ONE: F.when(~is_list, F.from_json(text, probe, probe_opts)),
                _MANY: F.when(is_list, F.from_json(text, "array<string>", opts)),
            }
        )
        .withColumn(
            _BAD,
            F.when(
                is_list,
                F.coalesce(
                    F.exists(_MANY, lambda r: malformed(F.from_json(r, probe, probe_opts))),
                    F.lit(True),
                ),
            ).otherwise(malformed(F.col(_ONE))),
        )
    )
    one = F.array(F.struct(*[F.col(_ONE)[f.name].alias(f.name) for f in body.fields]))
    # a list's values come from one parse of the whole line, which keeps numbers as written
    rows = F.when(is_list, F.from_json(text, ArrayType(body), opts)).otherwise(one)
    blank = F.array(F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in body.fields]))

    if mode == "DROPMALFORMED":
        parsed = parsed.where(~F.col(_BAD))
    elif mode == "FAILFAST":
        rows = F.when(F.col(_BAD), _fail(text)).otherwise(rows)
    else:
        rows = F.when(F.col(_BAD), blank).otherwise(rows)
    return parsed.select(
        F.when(F.col(_BAD), text).alias(_TEXT), F.inline(rows)
    ).select(*_output(schema, corrupt))


def _fail(text: Column) -> Column:
    return F.raise_error(F.concat(F.lit("malformed line in FAILFAST mode: "), text))


def _output(schema: StructType, corrupt: str) -> list[Column]:
    return [
        F.col(_TEXT if f.name == corrupt else quoted(f.name)).alias(f.name) for f in schema.fields
    ]


def parse_json_flat(
    lines: DataFrame,
    schema: StructType,
    options: dict[str, str] | None = None,
    column: str = "value",
) -> DataFrame:
    """One flat JSON object per line to columns by field name, each cast from its text.

    Missing fields are NULL, nested values keep their JSON text. Malformed lines are treated by
    mode as in :func:`parse_json_lines`.
    """
    opts, mode, corrupt = json_options(options)
    body = StructType([f for f in schema.fields if f.name != corrupt])
    text, entries = F.col(_TEXT), F.col(_MAP)
    parsed = (
        lines.select(F.col(quoted(column)).alias(_TEXT))
        .where(F.trim(_TEXT) != "")
        .withColumn(_MAP, json_map(text, opts))
    )
    if mode == "DROPMALFORMED":
        parsed = parsed.where(entries.isNotNull())
    elif mode == "FAILFAST":
        parsed = parsed.withColumn(_MAP, F.when(entries.isNull(), _fail(text)).otherwise(entries))
    parsed = parsed.withColumn(_TEXT, F.when(entries.isNull(), text))
    return rows_from_map(parsed, _MAP, body, _TEXT).select(*_output(schema, corrupt))


def read_gbk_json_typed(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """GBK JSON lines, decoded and then parsed once by Spark's own reader, as UTF-8 files are."""
    lines = read_lines(spark, paths, "GBK")
    return _typed_rows(lambda reader: _json_of(reader, lines), spark, schema, options)


def read_gbk_json_flat(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType,
    options: dict[str, str] | None = None,
) -> DataFrame:
    return parse_json_flat(read_lines(spark, paths, "GBK"), schema, options)


def read_json_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """JSON lines in UTF-8 by Spark's own source: one parse, and only of the columns a query uses.

    Without a schema it is inferred, which reads the input once more. With one, rows of a malformed
    line are all NULL (the source keeps what it could read), with the line in the corrupt-record
    column; a top-level array with a malformed element gives such a row for each element read.
    """
    if schema is None:
        opts, mode, corrupt = json_options(options)
        reader = spark.read.options(**opts, mode=mode, columnNameOfCorruptRecord=corrupt)
        return reader.json(as_paths(paths))
    return _typed_rows(lambda reader: reader.json(as_paths(paths)), spark, schema, options)


def _json_of(reader: DataFrameReader, lines: DataFrame) -> DataFrame:
    """Text lines through a JSON reader; the JVM takes the column as it is, without a pass through Python."""
    spark = lines.sparkSession
    text = lines._jdf.select("value", spark._jvm.PythonUtils.toSeq([]))
    strings = getattr(text, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(reader._jreader.json(strings), spark)


def _typed_rows(
    read: Callable[[DataFrameReader], DataFrame],
    spark: SparkSession,
    schema: StructType,
    options: dict[str, str] | None,
) -> DataFrame:
    """What a JSON reader gives for a schema, with rows of malformed lines all NULL."""
    opts, mode, corrupt = json_options(options)
    reader = spark.read.options(**opts, mode=mode, columnNameOfCorruptRecord=corrupt)
    body = [f for f in schema.fields if f.name != corrupt]
    if mode != "PERMISSIVE":
        found = read(reader.schema(StructType(body)))
        blank = F.lit(None).cast("string")
        return found.select(
            *[(blank if f.name == corrupt else F.col(quoted(f.name))).alias(f.name) for f in schema.fields]
        )
    found = read(reader.schema(StructType([*body, StructField(corrupt, StringType())])))
    text = F.col(quoted(corrupt))
    return found.select(
        *[
            (text if f.name == corrupt else F.when(text.isNull(), F.col(quoted(f.name)))).alias(f.name)
            for f in schema.fields
        ]
    )


def infer_json_schema(
    spark: SparkSession,
    paths: str | Sequence[str],
    encoding: str = "UTF-8",
    options: dict[str, str] | None = None,
) -> StructType:
    """The schema all records agree on; GBK input is decoded first, so its field names are too."""
    opts, mode, corrupt = json_options(options)
    reader = spark.read.options(**opts, mode=mode, columnNameOfCorruptRecord=corrupt)
    if encoding.upper() != "GBK":
        schema = reader.json(as_paths(paths)).schema
    else:
        schema = _json_of(reader, read_lines(spark, paths, encoding)).schema
    return schema


def schema_rows(schema: DataType, prefix: str = "") -> list[tuple[str, str]]:
    """``(path, type)`` of every field, nested ones by dotted path."""
    if isinstance(schema, ArrayType):
        return schema_rows(schema.elementType, f"{prefix}[]")
    if isinstance(schema, MapType):
        return schema_rows(schema.valueType, f"{prefix}{{}}")
    if not isinstance(schema, StructType):
        return []
    rows = []
    for f in schema.fields:
        path = f"{prefix}.{f.name}" if prefix else f.name
        rows += [(path, f.dataType.simpleString()), *schema_rows(f.dataType, path)]
    return rows
