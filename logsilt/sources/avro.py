"""Avro in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsilt.layout import quoted
from logsilt.session import apart
from logsilt.sources.files import as_paths

# The Avro source ships with Spark 4.1, but only the separate package registers its short name.
AVRO = "org.apache.spark.sql.avro.AvroFileFormat"
CODECS = ("snappy", "deflate", "uncompressed")
_DEFLATE_LEVEL = "spark.sql.avro.deflate.level"


def read_avro(
    spark: SparkSession,
    paths: str | Sequence[str],
    avro_schema: str | None = None,
    skip_other_suffixes: bool = True,
) -> DataFrame:
    """Avro files; the schema is the caller's, or the one in the header of a sample file."""
    reader = spark.read.format(AVRO)
    if avro_schema:
        reader = reader.option("avroSchema", avro_schema)
    if skip_other_suffixes:
        reader = reader.option("pathGlobFilter", "*.avro")
    return reader.load(as_paths(paths))


def avro_value(value: Column, data_type: T.DataType) -> Column:
    """A value in the form it is written in: decimals as text, timestamps as epoch millis."""
    if isinstance(data_type, T.DecimalType):
        return value.cast("string")
    if isinstance(data_type, T.TimestampType):
        return F.unix_millis(value)
    if isinstance(data_type, T.TimestampNTZType):
        return F.unix_millis(value.cast("timestamp"))
    if not _changes(data_type):
        return value
    if isinstance(data_type, T.StructType):
        fields = [avro_value(value[f.name], f.dataType).alias(f.name) for f in data_type.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda v: avro_value(v, data_type.elementType))
    return F.transform_values(value, lambda _, v: avro_value(v, data_type.valueType))


def _changes(data_type: T.DataType) -> bool:
    """Whether a type has a part that is written in another form."""
    if isinstance(data_type, T.StructType):
        return any(_changes(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _changes(data_type.elementType)
    if isinstance(data_type, T.MapType):
        return _changes(data_type.valueType)
    return isinstance(data_type, (T.DecimalType, T.TimestampType, T.TimestampNTZType))


def write_avro(
    df: DataFrame,
    path: str,
    codec: str = "snappy",
    deflate_level: int | None = None,
    record_name: str = "topLevelRecord",
    record_namespace: str = "",
) -> None:
    """Write Avro files, one per task."""
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}: {codec!r}")
    out = df.select(
        *[avro_value(F.col(quoted(f.name)), f.dataType).alias(f.name) for f in df.schema.fields]
    )
    options = {"compression": codec, "recordName": record_name, "recordNamespace": record_namespace}
    if deflate_level is None:
        out.write.format(AVRO).options(**options).save(path)
        return
    # the level is a setting, so the write gets a session of its own
    with apart(out, {_DEFLATE_LEVEL: str(deflate_level)}) as own:
        own.write.format(AVRO).options(**options).save(path)
