"""

Every query reads the given tables whole. Queries that land files do so in a fresh folder under the
session's shared scratch place and leave it there, because the result is evaluated after they
return.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logsilt import Rule, Store, Subject, TrackingNames, configure
from logsilt import functions as fn
from logsilt import operators as op
from logsilt import plans, sources
from logsilt.catalog import ledger, registry, tables
from logsilt.layout import partition_keys, time_keys
from logsilt.plans import compaction
from logsilt.plans.landing import register
from logsilt.session import scratch_dir
from logsilt.streaming import start_online

NOW = 1_700_000_000
DAY = "yyyy/MM/dd"
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# A label per event type with characters whose second GBK byte is 0x7C or 0x5C.
LABELS = {
    "view": "浏览",
    "click": "点击",
    "signup": "注册誠",
    "purchase": "购买億",
    "error": "错误東",
}

EVENTS_TEXT_SCHEMA = "event_id bigint, ts string, user_id bigint, event_type string, value double, props string"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _schema(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with their time as text, a form every file format keeps."""
    return _table(spark, sf, "events").select(
        "event_id", F.date_format("ts", TS_TEXT).alias("ts"), "user_id", "event_type", "value", "props"
    )


def _day() -> Column:
    return F.date_format("ts", DAY)


def _keyed_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a match value (user and type) and a day path."""
    return _table(spark, sf, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "ts",
        F.concat_ws("-", "user_id", "event_type").alias("match_value"),
        _day().alias("action_time"),
    )


def _labelled(df: DataFrame) -> DataFrame:
    label = F.col("event_type")
    for event_type, text in LABELS.items():
        label = F.when(F.col("event_type") == event_type, F.lit(text)).otherwise(label)
    return df.withColumn("label", label)


def _store(spark: SparkSession, name: str) -> Store:
    return Store(scratch_dir(spark, name), db_prefix=f"q{uuid.uuid4().hex[:12]}_")


def _write_lines(df: DataFrame, path: str, gbk: bool = False, separator: str = "\n") -> str:
    """Write column ``value`` as text; GBK bytes pass through a string column unchanged."""
    out = fn.encode_gbk(df, "value").select(F.col("value").cast("string")) if gbk else df
    out.select("value").write.option("lineSep", separator).text(path)
    return path


def _json_value(*columns: str | Column) -> Column:
    return F.to_json(F.struct(*columns)).alias("value")


def _registered(
    spark: SparkSession, store: Store, subject: Subject, df: DataFrame, rule: str
) -> DataFrame:
    """Land ``df`` (which holds the rule's time keys) as a registered table."""
    keys = time_keys(rule)
    body = StructType([f for f in df.schema.fields if f.name not in keys])
    tables.create_external_table(spark, store, subject, body, rule)
    path = sources.write_partition_parquet(df, store.table_root(subject), keys, files=2)
    folder_id = path.rsplit("=", 1)[1]
    register(spark, store, subject, path, folder_id, keys)
    return spark.table(store.table_name(subject))


def _events_by(spark: SparkSession, sf: str, rule: str) -> DataFrame:
    return _events(spark, sf).withColumns(fn.partition_values(_path_of_text(rule), rule))


def _path_of_text(rule: str) -> Column:
    return F.replace(F.substring("ts", 1, len(rule)), F.lit("-"), F.lit("/"))


# ---------------------------------------------------------------- sources


def read_parquet_paths(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "parquet_paths")
    events = _events(spark, sf)
    events.where("value < 20").write.parquet(f"{root}/low")
    events.where("NOT coalesce(value < 20, false)").write.parquet(f"{root}/high")
    return sources.read_parquet_paths(spark, [f"{root}/low", f"{root}/high"])


def read_pipe_text(spark: SparkSession, sf: str) -> DataFrame:
    part = _table(spark, sf, "part")
    path = _write_lines(part.select(F.concat_ws("|", *part.columns).alias("value")), scratch_dir(spark, "pipe"))
    return sources.read_pipe_text(spark, path, part.schema)


def read_csv_header(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    customer = _table(spark, sf, "customer")
    customer.write.option("header", True).csv(path)
    return op.align_schema(sources.read_csv_header(spark, path), customer.schema, cast=True)


def read_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "json")
    documents = _table(spark, sf, "documents")
    sources.write_json(documents, path)
    return sources.read_json_lines(spark, path).select(documents.columns)


def read_json_typed(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "json")
    pages = _table(spark, sf, "pages")
    sources.write_json(pages, path)
    return sources.read_json_lines(spark, path, pages.schema)


def read_gbk_json_flat(spark: SparkSession, sf: str) -> DataFrame:
    rows = _labelled(_events(spark, sf)).select(
        _json_value("event_id", "user_id", "label", "value", F.lit("x").alias("unused"))
    )
    path = _write_lines(rows, scratch_dir(spark, "gbk_flat"), gbk=True)
    schema = _schema("label string, event_id bigint, user_id bigint, value double, absent string")
    return sources.read_gbk_json_flat(spark, path, schema)


def read_gbk_json_typed(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the records sit in top-level arrays, one array of all its records per user."""
    rows = _labelled(_events(spark, sf)).select(
        "user_id",
        "value",
        F.struct(
            "event_id",
            F.struct(F.col("user_id").alias("id"), "label").alias("who"),
            F.array("event_type", "label").alias("tags"),
        ).alias("record"),
    )
    single = rows.where("value < 20").select(F.to_json("record").alias("value"))
    paired = (
        rows.where("NOT coalesce(value < 20, false)").groupBy("user_id")
        .agg(F.collect_list("record").alias("records"))
        .select(F.concat(F.lit(" "), F.to_json("records")).alias("value"))
    )
    path = _write_lines(single.unionByName(paired), scratch_dir(spark, "gbk_typed"), gbk=True)
    schema = _schema("event_id bigint, who struct<id: bigint, label: string>, tags array<string>")
    return sources.read_gbk_json_typed(spark, path, schema).select(
        "event_id",
        F.col("who.id").alias("user_id"),
        F.col("who.label").alias("label"),
        F.get("tags", F.lit(0)).alias("first_tag"),
        F.get("tags", F.lit(1)).alias("second_tag"),
        F.size("tags").alias("n_tags"),
    )


def infer_json_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Types differ from record to record: numbers widen, a number and a text make a text, a NULL
    takes any type, and fields that some records lack are there."""
    rows = _labelled(_events(spark, sf))
    user = F.struct(F.col("user_id").alias("id"), F.col("label").alias("名称")).alias("who")
    number = F.struct(
        "event_id", user, F.array("user_id").alias("readings"), F.col("event_id").alias("mixed"),
        F.col("user_id").alias("amount"), F.lit(None).cast("boolean").alias("maybe"), F.lit(None).cast("string").alias("never"),
    )
    text = F.struct(
        "event_id", F.struct(F.col("value").alias("extra")).alias("who"), F.array("value").alias("readings"),
        F.col("label").alias("mixed"), F.col("value").alias("amount"), (F.col("value") > 20).alias("maybe"),
    )
    keep = {"ignoreNullFields": "false"}
    rows = rows.select(
        F.when(F.col("event_type") == "view", F.to_json(number, keep)).otherwise(F.to_json(text, keep)).alias("value")
    )
    path = _write_lines(rows, scratch_dir(spark, "gbk_infer"), gbk=True)
    schema = sources.infer_json_schema(spark, path, "GBK")
    return spark.createDataFrame(sources.schema_rows(schema), "path string, type string")


def read_paragraph_records(spark: SparkSession, sf: str) -> DataFrame:
    """A quarter of the records each between blank lines, CRLF ones, lines of spaces, and two blank lines."""
    turns = _table(spark, sf, "conversations")
    root = scratch_dir(spark, "paragraphs")
    for i, gap in enumerate(("\n\n", "\r\n\r\n", "\n \t\n", "\n\n\n")):
        part = turns.where(F.col("conv_id") % 4 == i).select(_json_value(*turns.columns))
        _write_lines(part, f"{root}/{i}", separator=gap)
    ddl = "conv_id bigint, turn bigint, role string, text string"
    paths = [f"{root}/{i}" for i in range(4)]
    return sources.read_paragraph_records(spark, paths, f"from_json(value, '{ddl}') AS r").select("r.*")


def read_paragraphs_far_apart(spark: SparkSession, sf: str) -> DataFrame:
    """Records of several lines, with two thousand blank lines of three kinds between any two."""
    turns = _table(spark, sf, "conversations")
    path = scratch_dir(spark, "far_paragraphs")
    record = _json_value(*turns.columns)
    lines = turns.select(F.replace(record, F.lit('","'), F.lit('",\r\n"')).alias("value"))
    _write_lines(lines, path, separator="\r\n" + " \n\r\n\t\r\n" * 700)
    ddl = "conv_id bigint, turn bigint, role string, text string"
    return sources.read_paragraph_records(spark, path, f"from_json(value, '{ddl}') AS r").select("r.*")


def read_avro(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "avro")
    sources.write_avro(_table(spark, sf, "embeddings"), path)
    micros = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1_000_000).cast("string"))
    return sources.read_avro(spark, path).select("vec_id", "label", F.array_join(micros, ",").alias("micros"))


def union_files(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "union")
    events = _events(spark, sf)
    sources.write_json(events.where("event_type IN ('view', 'click')"), f"{root}/a")
    sources.write_json(events.where("event_type NOT IN ('view', 'click')"), f"{root}/b")
    frames = [sources.read_json_lines(spark, f"{root}/{name}") for name in "ab"]
    return sources.union_files(frames).select(events.columns)


def read_partition(spark: SparkSession, sf: str) -> DataFrame:
    store, subject = _store(spark, "read_partition"), Subject("web", "events")
    _registered(spark, store, subject, _events_by(spark, sf, DAY), DAY)
    found = sources.read_partition(spark, store, subject, "2024/01/15")
    return found.drop("randompath")


def read_glob(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "glob")
    folder = sources.write_partition_parquet(_events_by(spark, sf, DAY), root, time_keys(DAY), 1)
    return sources.read_glob(spark, f"{folder}/year=*/month=*/day=*", ".parquet")


# ---------------------------------------------------------------- sinks


def write_partition_parquet(spark: SparkSession, sf: str) -> DataFrame:
    keys = time_keys(DAY)
    events = _events_by(spark, sf, DAY)
    path = sources.write_partition_parquet(events, scratch_dir(spark, "k1"), keys, files=4)
    schema = StructType([f for f in events.schema.fields])
    back = spark.read.schema(schema).parquet(path)
    files = back.select(*keys, F.col("_metadata.file_path").alias("file")).distinct()
    per_partition = files.groupBy(*keys).agg((F.count("*") <= 4).alias("within_files"))
    return back.join(per_partition, keys)


def write_backup_parquet(spark: SparkSession, sf: str) -> DataFrame:
    store, subject = _store(spark, "backup"), Subject("web", "orders")
    orders = _table(spark, sf, "orders").withColumn("year", F.date_format("o_orderdate", "yyyy"))
    path = sources.write_backup_parquet(
        orders.drop("o_orderdate"), store, subject, ["year"], files=2
    )
    return spark.read.schema(orders.drop("o_orderdate").schema).parquet(path)


def write_avro(spark: SparkSession, sf: str) -> DataFrame:
    """Decimals are written as text and timestamps as epoch millis."""
    path = scratch_dir(spark, "write_avro")
    orders = _table(spark, sf, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(12,2)"))
    sources.write_avro(orders, path, codec="deflate", deflate_level=6)
    return sources.read_avro(spark, path)


def write_json(spark: SparkSession, sf: str) -> DataFrame:
    """NULL fields are left out of the written text."""
    path = scratch_dir(spark, "write_json")
    orders = _table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.expr("nullif(o_orderpriority, '5-LOW')").alias("priority"),
        F.col("o_orderdate").cast("timestamp").alias("placed"),
    )
    sources.write_json(orders, path)
    lines = spark.read.text(path)
    record = F.from_json("value", orders.drop("placed").schema)
    return lines.select(
        record.alias("r"), F.contains("value", F.lit('"priority"')).alias("has_field"),
        F.get_json_object("value", "$.placed").alias("placed"),
    ).select("r.*", "has_field", "placed")


def write_text(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "write_text")
    sources.write_text(_table(spark, sf, "customer"), path, "c_name")
    return spark.read.text(path)


# ---------------------------------------------------------------- projections and filters


def expand_flat(spark: SparkSession, sf: str) -> DataFrame:
    out = op.expand_flat(
        _table(spark, sf, "events"),
        "concat_ws('-', user_id, event_type)",
        f"date_format(ts, '{DAY}')",
        now=NOW,
    )
    return out.drop("ts")


def expand_header(spark: SparkSession, sf: str) -> DataFrame:
    out = op.expand_header(
        _table(spark, sf, "events"),
        "concat_ws('-', user_id, event_type)",
        "date_format(ts, 'yyyy/MM/dd/HH')",
        now=NOW,
    )
    return out.select("header.logUpdateTime", "header.logMatchValue", "logActionTime", "event_id", "value")


def align_schema(spark: SparkSession, sf: str) -> DataFrame:
    target = _schema("c_mktsegment string, c_phone string, c_custkey bigint, c_rank int")
    return op.align_schema(_table(spark, sf, "customer"), target)


def project_exprs(spark: SparkSession, sf: str) -> DataFrame:
    return op.project_exprs(
        _table(spark, sf, "lineitem"),
        "l_orderkey",
        "l_linenumber",
        "l_returnflag || l_linestatus AS flags",
        "l_extendedprice * (1 - l_discount) AS net",
    )


def drop_columns(spark: SparkSession, sf: str) -> DataFrame:
    return op.drop_columns(_table(spark, sf, "part"), "p_type", "p_retailprice")


def struct_field_access(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "struct_field")
    op.expand_header(
        _table(spark, sf, "events"), "user_id", f"date_format(ts, '{DAY}')", now=NOW
    ).write.parquet(path)
    return spark.read.parquet(path).select(
        F.col("header.logMatchValue").alias("match_value"), "event_id"
    )


def rows_from_split(spark: SparkSession, sf: str) -> DataFrame:
    lines = _table(spark, sf, "lineitem")
    texts = [F.date_format(c, TS_TEXT) if c == "l_shipdate" else F.col(c).cast("string") for c in lines.columns]
    joined = lines.select(fn.split_pipe(F.concat_ws("|", *texts, F.lit(""))).alias("fields"))
    fields = [f"{c} {'string' if c == 'l_shipdate' else t}" for c, t in lines.dtypes]
    schema = _schema(", ".join([*fields, "l_empty string", "l_missing string"]))
    return op.rows_from_array(joined, "fields", schema)


def filter_action_time(spark: SparkSession, sf: str) -> DataFrame:
    keyed = _keyed_events(spark, sf).drop("ts")
    return op.filter_action_time(keyed, "action_time", "2024/01/15")


def filter_top_row(spark: SparkSession, sf: str) -> DataFrame:
    lines = _table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey")
    return op.dedup_latest(
        lines, ["l_orderkey"], ["l_extendedprice", "l_linenumber", "l_partkey"]
    ).select("l_orderkey", "l_linenumber", "l_extendedprice")


def _damaged_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as JSON text: finished ones sound, open ones with a wrong type, others blank."""
    good = F.to_json(F.struct("o_orderkey", "o_totalprice"))
    wrong = F.to_json(F.struct(F.col("o_orderstatus").alias("o_orderkey"), "o_totalprice"))
    status = F.col("o_orderstatus")
    value = F.when(status == "F", good).when(status == "O", wrong).otherwise(F.lit("   "))
    return _table(spark, sf, "orders").select(value.alias("value"))


def drop_blank_malformed(spark: SparkSession, sf: str) -> DataFrame:
    path = _write_lines(_damaged_orders(spark, sf), scratch_dir(spark, "malformed"))
    return sources.read_json_lines(
        spark, path, _schema("o_orderkey bigint, o_totalprice double"), {"mode": "DROPMALFORMED"}
    )


def keep_malformed(spark: SparkSession, sf: str) -> DataFrame:
    path = _write_lines(_damaged_orders(spark, sf), scratch_dir(spark, "malformed"))
    return sources.read_json_lines(
        spark, path, _schema("o_orderkey bigint, o_totalprice double, _corrupt_record string")
    ).select("o_orderkey", "o_totalprice", F.col("_corrupt_record").isNotNull().alias("is_corrupt"))


def skip_hidden_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "hidden")
    customer = _table(spark, sf, "customer")
    customer.write.parquet(path)
    customer.write.parquet(f"{path}/_unfinished")
    customer.write.parquet(f"{path}/.trash")
    return sources.read_glob(spark, path, ".parquet")


# ---------------------------------------------------------------- joins, dedup


def anti_join_existing(spark: SparkSession, sf: str) -> DataFrame:
    orders = _table(spark, sf, "orders").drop("o_orderdate")
    returned = _table(spark, sf, "lineitem").where("l_returnflag = 'R'")
    return op.anti_join_existing(orders, returned, ["o_orderkey"], ["l_orderkey"])


def anti_join_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the keys is NULL; such rows are kept."""
    orders = _table(spark, sf, "orders").select(
        "o_orderkey", F.expr("if(o_orderstatus = 'P', NULL, o_custkey)").alias("cust")
    )
    rich = _table(spark, sf, "customer").where("c_acctbal > 0")
    return op.anti_join_existing(orders, rich, ["cust"], ["c_custkey"])


def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return op.distinct_values(_table(spark, sf, "orders"), "o_custkey")


def dedup_any(spark: SparkSession, sf: str) -> DataFrame:
    """Which row of a key survives is open, so only the keys are compared."""
    return op.dedup_any(_keyed_events(spark, sf), ["action_time", "match_value"]).select(
        "action_time", "match_value", "user_id", "event_type"
    )


def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    return op.dedup_latest(
        _keyed_events(spark, sf), ["action_time", "match_value"], ["ts", "event_id"]
    ).drop("ts")


def _hot_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items under a key that about a third of them, the returned ones, share."""
    return _table(spark, sf, "lineitem").select(
        F.expr("if(l_returnflag = 'R', -1, l_orderkey)").alias("k"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
    )


def dedup_hot_key(spark: SparkSession, sf: str) -> DataFrame:
    order = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"]
    return op.dedup_latest(_hot_lines(spark, sf), ["k"], order)


def anti_join_hot_key(spark: SparkSession, sf: str) -> DataFrame:
    finished = _table(spark, sf, "orders").where("o_orderstatus = 'F'")
    return op.anti_join_existing(_hot_lines(spark, sf), finished, ["k"], ["o_orderkey"])


# ---------------------------------------------------------------- functions


def fn_unix_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "events").select(
        "event_id",
        F.unix_timestamp("ts").alias("event_seconds"),
        (fn.update_time() > F.lit(NOW)).alias("is_now"),
        fn.update_time(NOW).alias("pinned"),
    )


def fn_named_struct(spark: SparkSession, sf: str) -> DataFrame:
    header = fn.header_struct(TrackingNames(), F.col("user_id"), NOW)
    return _table(spark, sf, "events").select("event_id", header.alias("h")).select("event_id", "h.*")


def fn_action_time(spark: SparkSession, sf: str) -> DataFrame:
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    text = F.when(F.col("event_type") == "error", "").when(F.col("event_type") == "view", "n/a").otherwise(millis)
    return _table(spark, sf, "events").select(
        "event_id", fn.action_time(text, "yyyy/MM/dd/HH", F.lit(NOW)).alias("action_time")
    )


def fn_format_partition(spark: SparkSession, sf: str) -> DataFrame:
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return _table(spark, sf, "events").select(
        "event_id",
        fn.format_partition(millis, "yyyy/MM/dd/HH").alias("hour_path"),
        fn.format_partition(millis, "yyyy/MM").alias("month_path"),
    )


def fn_parse_partition(spark: SparkSession, sf: str) -> DataFrame:
    orders = _table(spark, sf, "orders")
    path = F.date_format("o_orderdate", DAY)
    return orders.select(
        "o_orderkey",
        fn.parse_partition(path, DAY).alias("millis"),
        fn.parse_partition(F.col("o_orderpriority"), DAY).alias("unreadable"),
    )


def fn_split_pipe(spark: SparkSession, sf: str) -> DataFrame:
    joined = F.concat_ws("|", "p_name", "p_brand", "p_type", F.lit(""))
    parts = fn.split_pipe(joined)
    return _table(spark, sf, "part").select(
        "p_partkey",
        F.get(parts, F.lit(0)).alias("first"),
        F.get(parts, F.lit(2)).alias("third"),
        F.size(parts).alias("n"),
        F.size(fn.split_pipe(joined, drop_trailing_empty=True)).alias("n_trimmed"),
    )


def fn_rand_bucket(spark: SparkSession, sf: str) -> DataFrame:
    """Every bucket is met, and none far more often than the others."""
    buckets = _table(spark, sf, "events").select(fn.random_bucket(20).cast("bigint").alias("bucket"))
    counts = buckets.groupBy("bucket").agg(F.count("*").alias("n"))
    mean = buckets.agg((F.count("*") / 20).alias("mean"))
    return counts.join(F.broadcast(mean)).select("bucket", F.col("n").between(F.col("mean") / 4, F.col("mean") * 3).alias("usual"))


def fn_decode_gbk(spark: SparkSession, sf: str) -> DataFrame:
    labelled = _labelled(_table(spark, sf, "events")).select("event_id", "label")
    encoded = fn.encode_gbk(labelled, "label", "raw")
    out = fn.decode_gbk(encoded, "raw", "decoded")
    return out.select("event_id", "decoded", F.length("raw").alias("n_bytes"))


def fn_json_map(spark: SparkSession, sf: str) -> DataFrame:
    entries = fn.json_map(F.col("props"))
    return _table(spark, sf, "events").select(
        "event_id", F.try_element_at(entries, F.lit("k")).alias("k"), F.size(entries).alias("n")
    )


def fn_partition_keys(spark: SparkSession, sf: str) -> DataFrame:
    path = F.date_format("ts", "yyyy/MM/dd/HH")
    keys = fn.partition_values(path, "yyyy/MM/dd/HH")
    spec = fn.partition_spec(path)
    return _table(spark, sf, "events").select(
        "event_id",
        *[value.alias(key) for key, value in keys.items()],
        spec.alias("spec"),
        fn.spec_to_path(spec).alias("path"),
    )


def fn_rule_to_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The folder of every order, under the keys of each rule."""
    orders = _table(spark, sf, "orders").withColumn("id", F.col("o_custkey").cast("string"))
    path = F.date_format("o_orderdate", "yyyy/MM/dd/HH")
    values = {**fn.partition_values(path, "yyyy/MM/dd/HH"), "randompath": F.col("id")}

    def folder(rule: str) -> Column:
        return F.concat_ws("/", *[F.concat(F.lit(f"{k}="), values[k]) for k in partition_keys(rule)])

    return orders.select(
        "o_orderkey", folder("yyyy").alias("by_year"), folder("yyyy/MM/dd/HH").alias("by_hour"),
        F.lit(len(partition_keys(""))).alias("no_keys"),
    )


def late_filter(spark: SparkSession, sf: str) -> DataFrame:
    current = F.lit("1998/06/15/12")
    paths = {d: F.date_format("o_orderdate", p) for d, p in
             {1: "yyyy", 2: "yyyy/MM", 3: DAY, 4: "yyyy/MM/dd/HH", 5: "yyyy/MM/dd/HH/mm"}.items()}
    return _table(spark, sf, "orders").select(
        "o_orderkey",
        *[fn.within_late_window(path, current).alias(f"depth_{d}") for d, path in paths.items()],
    )


# ---------------------------------------------------------------- tables, ledger, lookups


def create_external_table(spark: SparkSession, sf: str) -> DataFrame:
    store, subject = _store(spark, "create"), Subject("web", "events")
    return _registered(spark, store, subject, _events_by(spark, sf, DAY), DAY).drop("randompath")


def add_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Folders that are there already, registered where they lie."""
    store, subject = _store(spark, "add"), Subject("web", "orders")
    orders = _table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy").alias("year")
    )
    tables.create_external_table(spark, store, subject, orders.drop("year").schema, "yyyy")
    orders.write.partitionBy("year").parquet(store.table_root(subject))
    folder = F.concat(F.lit(f"{store.table_root(subject)}/year="), "year")
    found = orders.select("year", F.concat(F.lit("year="), "year"), folder).distinct()
    tables.add_partitions(spark, store, subject, (tuple(r) for r in found.toLocalIterator()))
    return spark.table(store.table_name(subject)).drop("randompath")


def drop_partition(spark: SparkSession, sf: str) -> DataFrame:
    store, subject = _store(spark, "drop"), Subject("web", "events")
    table = _registered(spark, store, subject, _events_by(spark, sf, DAY), DAY)
    folder = table.select("randompath").first()[0]
    tables.drop_partition(
        spark, store, subject, f"year=2024/month=01/day=01/randompath={folder}",
        f"{store.table_root(subject)}/randompath={folder}/year=2024/month=01/day=01",
    )
    tables.drop_partition(spark, store, subject, "year=2024/month=01/day=02")
    return spark.table(store.table_name(subject)).drop("randompath")


def drop_table(spark: SparkSession, sf: str) -> DataFrame:
    """The name is free again after the drop, and the old rows are gone."""
    store, subject = _store(spark, "drop_table"), Subject("web", "log")
    _registered(spark, store, subject, _events_by(spark, sf, "yyyy"), "yyyy")
    tables.drop_table(spark, store, subject)
    orders = _table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy").alias("year"))
    return _registered(spark, store, subject, orders, "yyyy").drop("randompath")


def partition_exists(spark: SparkSession, sf: str) -> DataFrame:
    store, subject = _store(spark, "exists"), Subject("web", "events")
    _registered(spark, store, subject, _events_by(spark, sf, DAY), DAY)
    return tables.existing_action_times(spark, store, subject)


def _ledger_from_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders read as ledger events: a folder per customer and month, deleted by finished orders."""
    return _table(spark, sf, "orders").select(
        F.lit("web.orders").alias("subject"),
        F.date_format("o_orderdate", "yyyy/MM").alias("partition"),
        F.col("o_custkey").cast("string").alias("randompath"),
        F.concat_ws("/", F.date_format("o_orderdate", "yyyy/MM"), "o_custkey").alias("path"),
        F.when(F.col("o_orderstatus") == "F", ledger.DELETE).otherwise(ledger.ADD).alias("op"),
        F.col("o_orderkey").alias("seq"),
    )


def partition_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.live_folders(_ledger_from_orders(spark, sf)).select("partition", "path", "seq")


def ledger_due(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.due_for_compaction(_ledger_from_orders(spark, sf), min_folders=10)


def rule_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rules = _table(spark, sf, "events").select(
        F.col("event_type").alias("subject"), F.col("event_id").alias("rule_id"), F.col("user_id").alias("files")
    )
    return registry.rule_lookup(rules)


def latest_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Fields and Spark types of the newest Avro schema of every event type; versions differ in a name."""
    version = F.col("event_id")
    parts = (
        '{"type":"record","name":"r","namespace":"web","fields":[{"name":"v', version % 7, '","type":["null","int"]},'
        '{"name":"at","type":{"type":"long","logicalType":"timestamp-millis"}},'
        '{"name":"kind","type":{"type":"enum","name":"K","symbols":["A"]}},{"name":"was","type":"web.K"}]}',
    )
    text = F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    schemas = _table(spark, sf, "events").select(
        F.col("event_type").alias("subject"), version.alias("version"), text.alias("schema")
    )
    rows = [
        (row.subject, row.version, field.name, field.dataType.simpleString())
        for row in registry.latest_schema(schemas).toLocalIterator()
        for field in registry.struct_from_avro(spark, row.schema)
    ]
    return spark.createDataFrame(rows, "subject string, version bigint, field string, type string")


# ---------------------------------------------------------------- pipelines


def ingest_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The merge plan: a day's late batch against what the morning stored."""
    keyed = _keyed_events(spark, sf)
    stored = keyed.where(F.hour("ts") < 8)
    batch = keyed.where(F.hour("ts") >= 8)
    fresh = plans.merge_new_rows(
        batch, stored, ["action_time"], "match_value", order_by=["ts", "event_id"]
    )
    return fresh.drop("ts")


_RULE = Rule(
    subject="web.events",
    match_key="concat_ws('-', user_id, event_type)",
    time_key="replace(substring(ts, 1, 10), '-', '/')",
    partition=DAY,
    files=2,
    order_by=("ts", "event_id"),
)


def _landed_table(spark: SparkSession, store: Store) -> DataFrame:
    return spark.table(store.table_name(Subject.parse(_RULE.subject)))


def _two_batches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    events = _events(spark, sf)
    hour = F.substring("ts", 12, 2).cast("int")
    return events.where(hour < 8), events.where(hour >= 8)


def _ingest_as(file_type: str, write: Callable[[DataFrame, str], None]):
    """Land both batches of a day through files of one type; the stored table is the result."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        store = _store(spark, f"ingest_{file_type}")
        for batch in _two_batches(spark, sf):
            path = scratch_dir(spark, f"batch_{file_type}")
            write(batch, path)
            frame = plans.read_batch(spark, file_type, path, _schema(EVENTS_TEXT_SCHEMA))
            plans.ingest(spark, store, _RULE, frame, now=NOW)
        return _landed_table(spark, store).select(
            "event_id", "ts", "user_id", "event_type", "value", "props",
            "header.logMatchValue", "header.logUpdateTime", "year", "month", "day",
        )

    return query


def _write_pipe(df: DataFrame, path: str) -> None:
    _write_lines(df.select(F.concat_ws("|", *df.columns).alias("value")), path)


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def _write_gbk(df: DataFrame, path: str) -> None:
    _write_lines(df.select(_json_value(*df.columns)), path, gbk=True)


def ingest_avro(spark: SparkSession, sf: str) -> DataFrame:
    """The same through Avro files, which land in the flat layout."""
    store = _store(spark, "ingest_avro")
    for batch in _two_batches(spark, sf):
        path = scratch_dir(spark, "batch_avro")
        sources.write_avro(batch, path)
        frame = plans.read_batch(spark, "avro", path)
        plans.ingest(spark, store, _RULE, frame, layout="flat", now=NOW)
    return _landed_table(spark, store).drop("randompath")


def ingest_td(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraph records with a header of their own, keyed by its fields."""
    store = _store(spark, "ingest_td")
    rule = Rule(
        subject="web.events",
        match_key="header.hashcode",
        time_key="date_format(CASE WHEN header.time = '' THEN now() "
        "ELSE timestamp_millis(CAST(header.time AS BIGINT)) END, 'yyyy/MM/dd/HH')",
        partition="yyyy/MM/dd/HH",
        files=1,
        order_by=("header.time", "event_id"),
    )
    events = _table(spark, sf, "events").select(
        F.struct(
            F.concat_ws("-", "user_id", "event_type").alias("hashcode"),
            F.unix_millis(F.col("ts").cast("timestamp")).cast("string").alias("time"),
        ).alias("header"),
        "event_id",
    )
    ddl = "header struct<hashcode: string, time: string>, event_id bigint"
    path = scratch_dir(spark, "batch_td")
    _write_lines(events.select(_json_value(*events.columns)), path, separator="\n\n")
    records = plans.read_batch(spark, "td", path, record_exprs=[f"inline(array(from_json(value, '{ddl}')))"])
    plans.ingest(spark, store, rule, records, now=NOW)
    return _landed_table(spark, store).select(
        "event_id", "header.hashcode", "header.logMatchValue", "year", "month", "day", "hour"
    )


def offline_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Two Parquet batches that carry tracking columns, in the flat layout."""
    store = _store(spark, "offline")
    for batch in _two_batches(spark, sf):
        path = scratch_dir(spark, "batch_offline")
        op.expand_flat(batch, _RULE.match_key, _RULE.time_key, now=NOW).write.parquet(path)
        plans.offline_merge(spark, store, _RULE, sources.read_parquet_paths(spark, path))
    return _landed_table(spark, store).drop("randompath")


def rerun_adds_nothing(spark: SparkSession, sf: str) -> DataFrame:
    store = _store(spark, "rerun")
    events = _events(spark, sf)
    for _ in range(2):
        plans.ingest(spark, store, _RULE, events, now=NOW, stage=False)
    return _landed_table(spark, store).groupBy("year", "month", "day").agg(F.count("*").alias("n"))


def compact_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Two folders per day become one; the rows stay."""
    store, subject = _store(spark, "compact"), Subject("web", "events")
    for batch in _two_batches(spark, sf):
        _registered(spark, store, subject, batch.withColumns(fn.partition_values(_path_of_text(DAY), DAY)), DAY)
    plans.compact(spark, store, subject, DAY, files=2)
    table = spark.table(store.table_name(subject))
    folders = table.groupBy("year", "month", "day").agg(F.countDistinct("randompath").alias("folders"))
    return table.drop("randompath").join(folders, ["year", "month", "day"])


def distinct_update_times(spark: SparkSession, sf: str) -> DataFrame:
    root, out = scratch_dir(spark, "update_times"), scratch_dir(spark, "update_times_out")
    events = op.expand_flat(_events_by(spark, sf, DAY), "user_id", "ts", now=NOW)
    with_times = events.withColumn("updateTime", F.col("logUpdateTime") + F.col("user_id"))
    folder = sources.write_partition_parquet(with_times, root, time_keys(DAY), 1)
    plans.distinct_column(spark, f"{folder}/year=*/month=*/*/*.parquet", "updateTime", out)
    return spark.read.text(out)


def ingest_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same two batches arriving as JSON files of a streaming source."""
    store, inbox = _store(spark, "stream"), scratch_dir(spark, "inbox")
    checkpoint = scratch_dir(spark, "stream_checkpoint")
    for batch in _two_batches(spark, sf):
        sources.write_json(batch, f"{inbox}/{uuid.uuid4().hex}")
        lines = spark.readStream.option("recursiveFileLookup", True).text(inbox)
        parsed = sources.parse_json_lines(lines, _schema(EVENTS_TEXT_SCHEMA))
        start_online(parsed, store, _RULE, checkpoint).awaitTermination()
    return _landed_table(spark, store).select(
        "event_id", "ts", "user_id", "event_type", "value", "props", "year", "month", "day"
    )


def offline_merge_joined(spark: SparkSession, sf: str) -> DataFrame:
    """A batch that is a join of three tables."""
    store = _store(spark, "offline_joined")
    lines, orders, customers = (_table(spark, sf, n) for n in ("lineitem", "orders", "customer"))
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "c_mktsegment")
    batch = op.expand_flat(joined, "concat_ws('-', l_partkey, l_suppkey)", "date_format(l_shipdate, 'yyyy/MM')", now=NOW)
    rule = Rule("shop.lines", "x", "x", "yyyy/MM", files=2, order_by=("l_orderkey", "l_linenumber"))
    plans.offline_merge(spark, store, rule, batch.drop("l_shipdate"))
    return spark.table(store.table_name(Subject.parse(rule.subject))).drop("randompath", "logUpdateTime")


def _land(spark: SparkSession, store: Store, batch: DataFrame) -> None:
    plans.ingest(spark, store, _RULE, batch, now=NOW, stage=False)


def _landed_events(spark: SparkSession, store: Store) -> DataFrame:
    return _landed_table(spark, store).select(
        "event_id", "ts", "user_id", "event_type", "value", "props", "year", "month", "day"
    )


def drop_then_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """What two dropped days held does not come back with the next batch."""
    store = _store(spark, "drop_then_ingest")
    morning, later = _two_batches(spark, sf)
    _land(spark, store, morning)
    for day in ("01", "02"):
        tables.drop_partition(spark, store, Subject.parse(_RULE.subject), f"year=2024/month=01/day={day}")
    _land(spark, store, later)
    return _landed_events(spark, store)


def drop_table_then_ingest(spark: SparkSession, sf: str) -> DataFrame:
    store = _store(spark, "drop_table_then_ingest")
    morning, later = _two_batches(spark, sf)
    _land(spark, store, morning)
    tables.drop_table(spark, store, Subject.parse(_RULE.subject))
    _land(spark, store, later)
    return _landed_events(spark, store)


def ingest_parallel(spark: SparkSession, sf: str) -> DataFrame:
    """All events and half of them, landed by two writers at the same time: no key is there twice."""
    store = _store(spark, "parallel")
    events = _events(spark, sf)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda batch: _land(spark, store, batch), [events, events.where("event_id % 2 = 0")]))
    return _landed_table(spark, store).groupBy("year", "month", "day", "header.logMatchValue").agg(F.count("*").alias("n"))


def read_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """A table as of each of its entries: two batches, a compaction, a dropped day."""
    store, subject = Store(scratch_dir(spark, "as_of"), f"q{uuid.uuid4().hex[:12]}_", keep_versions=10), Subject.parse(_RULE.subject)
    for batch in _two_batches(spark, sf):
        _land(spark, store, batch)
    plans.compact(spark, store, subject, DAY, files=1)
    tables.drop_partition(spark, store, subject, "year=2024/month=01/day=02")
    views = [
        plans.read_as_of(spark, store, subject, DAY, number).select(F.lit(number).alias("number"), "event_id", "year", "month", "day")
        for number in range(1, 5)
    ]
    return reduce(DataFrame.unionByName, views)


def ledger_folds(spark: SparkSession, sf: str) -> DataFrame:
    """Action times by the ledger after a commit for every day; its entries are folded on the way."""
    store, subject = _store(spark, "folds"), Subject("web", "events")
    days = [r[0] for r in _table(spark, sf, "events").select(_day()).distinct().collect()]
    for day in days:
        folder = (day, "x", f"{store.table_root(subject)}/{day}", ledger.ADD)
        ledger.record(store, subject, spark.createDataFrame([folder], "partition string, randompath string, path string, op string"))
        ledger.trim(spark, store, subject)
    few = len(ledger.batches(spark, store, subject)) < 40
    return tables.existing_action_times(spark, store, subject).withColumn("few_entries", F.lit(few))


def ingest_files_once(spark: SparkSession, sf: str) -> DataFrame:
    """The same files given three times, with others in between; rows without a key are not added again."""
    store, inbox = _store(spark, "files_once"), scratch_dir(spark, "inbox")
    key = "CASE WHEN event_type <> 'error' THEN concat_ws('-', user_id, event_type) END"
    rule = replace(_RULE, match_key=key, file_type="json")
    for batch in _two_batches(spark, sf):
        sources.write_json(batch, f"{inbox}/{uuid.uuid4().hex}")
        for _ in range(2):
            plans.ingest_files(spark, store, rule, inbox, _schema(EVENTS_TEXT_SCHEMA), now=NOW)
    return _landed_table(spark, store).groupBy("year", "month", "day").agg(
        F.count("header.logMatchValue").alias("keyed"), F.count_if(F.col("header.logMatchValue").isNull()).alias("unkeyed")
    )


def compaction_by_size(spark: SparkSession, sf: str) -> DataFrame:
    """Which folders of which months are rewritten: the smallest ones that fit together."""
    events = _ledger_from_orders(spark, sf).withColumn("bytes", F.col("seq") % 1000)
    return compaction.chosen_folders(events, 5, 4000).select("partition", "randompath")


def compact_small(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches of a day, of which the two small ones become one folder; the rows stay."""
    store, subject = _store(spark, "compact_small"), Subject("web", "events")
    events = _events_by(spark, sf, "yyyy")
    for part in ("event_id % 20 > 1", "event_id % 20 = 0", "event_id % 20 = 1"):
        _registered(spark, store, subject, events.where(part), "yyyy")
    sizes = ledger.live_folders(ledger.ledger_events(spark, store, subject)).agg(F.max("bytes")).first()[0]
    plans.compact(spark, store, subject, "yyyy", files=2, max_bytes=sizes - 1)
    table = spark.table(store.table_name(subject))
    folders = table.groupBy("year").agg(F.countDistinct("randompath").alias("folders"))
    return table.drop("randompath").join(folders, "year")


def distinct_of_table(spark: SparkSession, sf: str) -> DataFrame:
    """Kept distinct values after two batches, a compaction and a dropped day, asked for after each."""
    store, subject = _store(spark, "distinct"), Subject.parse(_RULE.subject)
    for batch in _two_batches(spark, sf):
        _land(spark, store, batch)
        plans.distinct_of_table(spark, store, subject, "value", DAY)
    plans.compact(spark, store, subject, DAY, files=1)
    plans.distinct_of_table(spark, store, subject, "value", DAY)
    tables.drop_partition(spark, store, subject, "year=2024/month=01/day=02")
    return plans.distinct_of_table(spark, store, subject, "value", DAY)


def ingest_damaged(spark: SparkSession, sf: str) -> DataFrame:
    """A file with damaged lines, landed twice: the sound rows once, the damaged lines once, as text."""
    store = _store(spark, "damaged")
    path = _write_lines(_damaged_orders(spark, sf), scratch_dir(spark, "batch_damaged"))
    rule = Rule("shop.orders", "o_orderkey", "date_format(timestamp_seconds(coalesce(o_orderkey, 0)), 'yyyy')", "yyyy", files=1)
    for _ in range(2):
        batch = plans.read_batch(spark, "json", path, _schema("o_orderkey bigint, o_totalprice double"))
        landed = plans.ingest(spark, store, rule, batch, now=NOW, run="only")
    sound = spark.table(store.table_name(Subject.parse(rule.subject))).select(
        "o_orderkey", "o_totalprice", F.lit(None).cast("string").alias("status"), F.lit(None).cast("double").alias("price")
    )
    damaged = spark.read.parquet(landed.rejects).select(
        "o_orderkey", "o_totalprice", F.get_json_object("_malformed", "$.o_orderkey").alias("status"),
        F.get_json_object("_malformed", "$.o_totalprice").cast("double").alias("price"),
    )
    return sound.unionByName(damaged)


# ---------------------------------------------------------------- contract


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the merge plan on the smallest tables."""
    return ingest_merge(spark, "/root/testdata/sf0.001")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        read_parquet_paths, read_pipe_text, read_csv_header, read_json_lines, read_json_typed,
        read_gbk_json_flat, read_gbk_json_typed, infer_json_schema, read_paragraph_records, read_paragraphs_far_apart,
        read_avro, union_files, read_partition, read_glob,
        write_partition_parquet, write_backup_parquet, write_avro, write_json, write_text,
        expand_flat, expand_header, align_schema, project_exprs, drop_columns,
        struct_field_access, rows_from_split,
        filter_action_time, filter_top_row, drop_blank_malformed, keep_malformed, skip_hidden_files,
        anti_join_existing, anti_join_null_keys, anti_join_hot_key, dedup_hot_key, distinct_values, dedup_any, dedup_latest,
        fn_unix_timestamp, fn_named_struct, fn_action_time, fn_format_partition,
        fn_parse_partition, fn_split_pipe, fn_rand_bucket, fn_decode_gbk, fn_json_map,
        fn_partition_keys, fn_rule_to_keys, late_filter,
        create_external_table, add_partition, drop_partition, drop_table, partition_exists,
        partition_ledger, ledger_due, rule_lookup, latest_schema,
        ingest_merge, ingest_avro, ingest_td, offline_merge, rerun_adds_nothing, compact_partition,
        distinct_update_times, ingest_stream,
        offline_merge_joined, drop_then_ingest, drop_table_then_ingest, ingest_parallel, read_as_of, ledger_folds,
        ingest_files_once, compaction_by_size, compact_small, distinct_of_table, ingest_damaged,
    )
}
_QUERIES["ingest_txt"] = _ingest_as("txt", _write_pipe)
_QUERIES["ingest_csv"] = _ingest_as("csv", _write_csv)
_QUERIES["ingest_json"] = _ingest_as("json", lambda df, path: sources.write_json(df, path))
_QUERIES["ingest_json_gbk"] = _ingest_as("json_gbk", _write_gbk)


def _configured(query: Callable[[SparkSession, str], DataFrame]):
    return lambda spark, sf: query(configure(spark), sf)


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query per operator; each takes (spark, folder of the tables)."""
    return {name: _configured(query) for name, query in _QUERIES.items()}


# The same shapes in SQL.
_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts"
_YMD = "strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day"
_EVENTS = f"SELECT event_id, {_TS}, user_id, event_type, value, props FROM events"
_EVENTS_YMD = f"SELECT event_id, {_TS}, user_id, event_type, value, props, {_YMD} FROM events"
_KEYED = """SELECT event_id, user_id, event_type, ts,
 user_id || '-' || event_type AS match_value, strftime(ts, '%Y/%m/%d') AS action_time FROM events"""
_LABEL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LABELS.items()) + " ELSE event_type END"
# both batches landed: the stored (morning) row of a key wins, then the newest
_LANDED = f"""SELECT * FROM ({_KEYED}) QUALIFY row_number() OVER (PARTITION BY action_time, match_value
 ORDER BY extract(hour FROM ts) >= 8, ts DESC, event_id DESC) = 1"""
_LANDED = _LANDED.replace("FROM events", ", value, props FROM events")
_INGESTED = f"""SELECT event_id, {_TS}, user_id, event_type, value, props, match_value AS "logMatchValue",
 CAST({NOW} AS BIGINT) AS "logUpdateTime", {_YMD} FROM ({_LANDED})"""


def _late(depth: int, pattern: str, days: int, current: str) -> str:
    start = {1: "year", 2: "month", 3: "day", 4: "hour"}.get(depth)
    moment = f"date_trunc('{start}', o_orderdate)" if start else "date_trunc('minute', o_orderdate)"
    return (
        f"date_diff('millisecond', {moment}, TIMESTAMP '{current}') <= {days} * 86400000::BIGINT"
        f" AS depth_{depth}"
    )


def core_oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query."""
    hot_lines = """SELECT CASE WHEN l_returnflag = 'R' THEN -1 ELSE l_orderkey END AS k, l_orderkey, l_linenumber,
     l_partkey, l_extendedprice FROM lineitem"""
    ledger_rows = """SELECT strftime(o_orderdate, '%Y/%m') AS partition,
     strftime(o_orderdate, '%Y/%m') || '/' || o_custkey AS path, o_orderkey AS seq, o_orderstatus
     FROM orders QUALIFY row_number() OVER (PARTITION BY path ORDER BY seq DESC) = 1"""
    sql = {
        "read_parquet_paths": _EVENTS,
        "read_pipe_text": "SELECT * FROM part",
        "read_csv_header": "SELECT * FROM customer",
        "read_json_lines": "SELECT * FROM documents",
        "read_json_typed": "SELECT * FROM pages",
        "read_gbk_json_flat": f"SELECT {_LABEL} AS label, event_id, user_id, value, CAST(NULL AS VARCHAR) AS absent FROM events",
        "read_gbk_json_typed": f"""SELECT event_id, user_id, {_LABEL} AS label, event_type AS first_tag,
         {_LABEL} AS second_tag, CAST(2 AS INTEGER) AS n_tags FROM events""",
        "infer_json_schema": """SELECT * FROM (VALUES ('event_id', 'bigint'), ('mixed', 'string'), ('amount', 'double'),
         ('maybe', 'boolean'), ('never', 'string'), ('readings', 'array<double>'),
         ('who', 'struct<extra:double,id:bigint,名称:string>'), ('who.extra', 'double'), ('who.id', 'bigint'),
         ('who.名称', 'string')) v(path, type)
         WHERE (SELECT count(DISTINCT event_type = 'view') FROM events) = 2""",
        "read_paragraph_records": "SELECT * FROM conversations",
        "read_paragraphs_far_apart": "SELECT * FROM conversations",
        "read_avro": """SELECT vec_id, label, array_to_string(list_transform(embedding,
         lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000000) AS BIGINT)), ',') AS micros FROM embeddings""",
        "write_avro": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, epoch_ms(o_orderdate) AS o_orderdate,
         o_orderpriority, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price FROM orders""",
        "union_files": _EVENTS,
        "read_partition": _EVENTS_YMD + " WHERE strftime(ts, '%Y/%m/%d') = '2024/01/15'",
        "read_glob": _EVENTS,
        "write_partition_parquet": _EVENTS_YMD.replace(" FROM events", ", true AS within_files FROM events"),
        "write_backup_parquet": "SELECT * EXCLUDE (o_orderdate), strftime(o_orderdate, '%Y') AS year FROM orders",
        "write_json": """SELECT o_orderkey, o_totalprice, nullif(o_orderpriority, '5-LOW') AS priority,
         o_orderpriority <> '5-LOW' AS has_field, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS placed FROM orders""",
        "write_text": "SELECT c_name AS value FROM customer",
        "expand_flat": f"""SELECT event_id, user_id, event_type, value, props, CAST({NOW} AS BIGINT) AS "logUpdateTime",
         user_id || '-' || event_type AS "logMatchValue", strftime(ts, '%Y/%m/%d') AS "logActionTime" FROM events""",
        "expand_header": f"""SELECT CAST({NOW} AS BIGINT) AS "logUpdateTime", user_id || '-' || event_type AS "logMatchValue",
         strftime(ts, '%Y/%m/%d/%H') AS "logActionTime", event_id, value FROM events""",
        "align_schema": """SELECT c_mktsegment, CAST(NULL AS VARCHAR) AS c_phone, c_custkey,
         CAST(NULL AS INTEGER) AS c_rank FROM customer""",
        "project_exprs": """SELECT l_orderkey, l_linenumber, l_returnflag || l_linestatus AS flags,
         l_extendedprice * (1 - l_discount) AS net FROM lineitem""",
        "drop_columns": "SELECT * EXCLUDE (p_type, p_retailprice) FROM part",
        "struct_field_access": "SELECT user_id AS match_value, event_id FROM events",
        "rows_from_split": """SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate), '' AS l_empty,
         CAST(NULL AS VARCHAR) AS l_missing FROM lineitem""",
        "filter_action_time": f"SELECT * EXCLUDE (ts) FROM ({_KEYED}) WHERE action_time = '2024/01/15'",
        "filter_top_row": """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem QUALIFY row_number() OVER
         (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber DESC, l_partkey DESC) = 1""",
        "drop_blank_malformed": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
        "keep_malformed": """SELECT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS o_orderkey,
         CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice, o_orderstatus = 'O' AS is_corrupt
         FROM orders WHERE o_orderstatus IN ('F', 'O')""",
        "skip_hidden_files": "SELECT * FROM customer",
        "anti_join_existing": """SELECT o.* EXCLUDE (o_orderdate) FROM orders o LEFT JOIN
         (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') l ON o.o_orderkey = l.l_orderkey
         WHERE l.l_orderkey IS NULL""",
        "anti_join_null_keys": """SELECT a.* FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL
         ELSE o_custkey END AS cust FROM orders) a LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) b
         ON a.cust = b.c_custkey WHERE b.c_custkey IS NULL""",
        "dedup_hot_key": f"""SELECT * FROM ({hot_lines}) QUALIFY row_number() OVER (PARTITION BY k
         ORDER BY l_extendedprice DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC) = 1""",
        "anti_join_hot_key": f"""SELECT l.* FROM ({hot_lines}) l LEFT JOIN
         (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') o ON l.k = o.o_orderkey WHERE o.o_orderkey IS NULL""",
        "distinct_values": "SELECT DISTINCT o_custkey FROM orders",
        "dedup_any": f"SELECT DISTINCT action_time, match_value, user_id, event_type FROM ({_KEYED})",
        "dedup_latest": f"""SELECT * EXCLUDE (ts) FROM ({_KEYED}) QUALIFY row_number() OVER
         (PARTITION BY action_time, match_value ORDER BY ts DESC, event_id DESC) = 1""",
        "fn_unix_timestamp": f"""SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS event_seconds, true AS is_now,
         CAST({NOW} AS BIGINT) AS pinned FROM events""",
        "fn_named_struct": f"""SELECT event_id, CAST({NOW} AS BIGINT) AS "logUpdateTime",
         user_id AS "logMatchValue" FROM events""",
        "fn_action_time": """SELECT event_id, CASE event_type WHEN 'error' THEN '2023/11/14/22' WHEN 'view' THEN NULL
         ELSE strftime(ts, '%Y/%m/%d/%H') END AS action_time FROM events""",
        "fn_format_partition": """SELECT event_id, strftime(ts, '%Y/%m/%d/%H') AS hour_path,
         strftime(ts, '%Y/%m') AS month_path FROM events""",
        "fn_parse_partition": """SELECT o_orderkey, epoch_ms(date_trunc('day', o_orderdate)) AS millis,
         CAST(NULL AS BIGINT) AS unreadable FROM orders""",
        "fn_split_pipe": """SELECT p_partkey, p_name AS first, p_type AS third, CAST(4 AS INTEGER) AS n,
         CAST(3 AS INTEGER) AS n_trimmed FROM part""",
        "fn_rand_bucket": "SELECT range AS bucket, true AS usual FROM range(20) WHERE (SELECT count(*) FROM events) > 0",
        "fn_decode_gbk": f"""SELECT event_id, {_LABEL} AS decoded,
         CAST(2 * length({_LABEL}) AS INTEGER) AS n_bytes FROM events""",
        "fn_json_map": """SELECT event_id, json_extract_string(props, '$.k') AS k,
         CAST(len(json_keys(props)) AS INTEGER) AS n FROM events""",
        "fn_partition_keys": f"""SELECT event_id, {_YMD}, strftime(ts, '%H') AS hour,
         strftime(ts, 'year=%Y/month=%m/day=%d/hour=%H') AS spec, strftime(ts, '%Y/%m/%d/%H') AS path FROM events""",
        "fn_rule_to_keys": """SELECT o_orderkey, strftime(o_orderdate, 'year=%Y') || '/randompath=' || o_custkey AS by_year,
         strftime(o_orderdate, 'year=%Y/month=%m/day=%d/hour=%H') || '/randompath=' || o_custkey AS by_hour,
         CAST(0 AS INTEGER) AS no_keys FROM orders""",
        "late_filter": "SELECT o_orderkey, " + ", ".join(
            [
                _late(1, "%Y", 3 * 365, "1998-01-01 00:00:00"),
                _late(2, "%Y/%m", 3 * 31, "1998-06-01 00:00:00"),
                _late(3, "%Y/%m/%d", 31, "1998-06-15 00:00:00"),
                _late(4, "%Y/%m/%d/%H", 7, "1998-06-15 12:00:00"),
                _late(5, "%Y/%m/%d/%H/%M", 3 * 365, "1998-06-15 12:00:00"),
            ]
        ) + " FROM orders",
        "create_external_table": _EVENTS_YMD,
        "add_partition": "SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y') AS year FROM orders",
        "drop_partition": _EVENTS_YMD + " WHERE strftime(ts, '%Y/%m/%d') NOT IN ('2024/01/01', '2024/01/02')",
        "drop_table": "SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year FROM orders",
        "partition_exists": "SELECT DISTINCT strftime(ts, '%Y/%m/%d') AS action_time FROM events",
        "partition_ledger": f"SELECT partition, path, seq FROM ({ledger_rows}) WHERE o_orderstatus <> 'F'",
        "ledger_due": f"""SELECT 'web.orders' AS subject, partition, count(*) AS folders FROM ({ledger_rows})
         WHERE o_orderstatus <> 'F' GROUP BY partition HAVING count(*) >= 10""",
        "rule_lookup": """SELECT event_type AS subject, event_id AS rule_id, user_id AS files FROM events
         QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) = 1""",
        "latest_schema": """SELECT subject, version, f.field, f.type FROM (SELECT event_type AS subject, event_id AS version,
         unnest([{'field': 'v' || (event_id % 7), 'type': 'int'}, {'field': 'at', 'type': 'timestamp'},
         {'field': 'kind', 'type': 'string'}, {'field': 'was', 'type': 'string'}]) AS f FROM events
         QUALIFY dense_rank() OVER (PARTITION BY event_type ORDER BY event_id DESC) = 1)""",
        "ingest_merge": f"""SELECT * EXCLUDE (ts) FROM (SELECT b.* FROM (SELECT * FROM ({_KEYED}) WHERE extract(hour FROM ts) >= 8
         QUALIFY row_number() OVER (PARTITION BY action_time, match_value ORDER BY ts DESC, event_id DESC) = 1) b
         LEFT JOIN (SELECT DISTINCT action_time, match_value FROM ({_KEYED}) WHERE extract(hour FROM ts) < 8) s
         ON b.action_time = s.action_time AND b.match_value = s.match_value WHERE s.match_value IS NULL)""",
        "ingest_td": f"""SELECT event_id, hashcode, hashcode AS "logMatchValue", {_YMD}, strftime(ts, '%H') AS hour
         FROM (SELECT *, user_id || '-' || event_type AS hashcode FROM events) QUALIFY row_number() OVER
         (PARTITION BY strftime(ts, '%Y/%m/%d/%H'), hashcode ORDER BY epoch_ms(ts) DESC, event_id DESC) = 1""",
        "offline_merge": _INGESTED,
        "rerun_adds_nothing": f"""SELECT {_YMD}, count(DISTINCT match_value) AS n FROM ({_KEYED}) GROUP BY 1, 2, 3""",
        "compact_partition": _EVENTS_YMD.replace(" FROM events", ", CAST(1 AS BIGINT) AS folders FROM events"),
        "distinct_update_times": f"SELECT DISTINCT CAST({NOW} + user_id AS VARCHAR) AS value FROM events",
        "ingest_stream": f"SELECT event_id, {_TS}, user_id, event_type, value, props, {_YMD} FROM ({_LANDED})",
        "offline_merge_joined": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, c_mktsegment,
         l_partkey || '-' || l_suppkey AS "logMatchValue", strftime(l_shipdate, '%Y') AS year, strftime(l_shipdate, '%m') AS month
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
         QUALIFY row_number() OVER (PARTITION BY strftime(l_shipdate, '%Y/%m'), l_partkey, l_suppkey
         ORDER BY l_orderkey DESC, l_linenumber DESC) = 1""",
        "drop_then_ingest": f"SELECT event_id, {_TS}, user_id, event_type, value, props, {_YMD} FROM ("
        + _LANDED.replace("FROM events", "FROM events WHERE NOT (extract(hour FROM ts) < 8 AND strftime(ts, '%Y/%m/%d') IN ('2024/01/01', '2024/01/02'))")
        + ")",
        "drop_table_then_ingest": f"SELECT event_id, {_TS}, user_id, event_type, value, props, {_YMD} FROM ("
        + _LANDED.replace("FROM events", "FROM events WHERE extract(hour FROM ts) >= 8") + ")",
        "ingest_parallel": """SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
         user_id || '-' || event_type AS "logMatchValue", CAST(1 AS BIGINT) AS n FROM events GROUP BY ALL""",
        "read_as_of": f"""WITH e AS (SELECT event_id, {_YMD}, extract(hour FROM ts) >= 8 AS late FROM ({_LANDED}))
         SELECT CAST(n AS INTEGER) AS number, event_id, year, month, day FROM e, range(1, 5) AS r(n)
         WHERE (n > 1 OR NOT late) AND (n < 4 OR year || month || day <> '20240102')""",
        "ledger_folds": "SELECT DISTINCT strftime(ts, '%Y/%m/%d') AS action_time, true AS few_entries FROM events",
        "ingest_files_once": f"""SELECT {_YMD}, count(DISTINCT CASE WHEN event_type <> 'error' THEN match_value END) AS keyed,
         CAST(max(event_type = 'error' AND extract(hour FROM ts) < 8) AS BIGINT)
         + CAST(max(event_type = 'error' AND extract(hour FROM ts) >= 8) AS BIGINT) AS unkeyed FROM ({_KEYED}) GROUP BY 1, 2, 3""",
        "compaction_by_size": f"""SELECT partition, randompath FROM (SELECT *, count(*) OVER (PARTITION BY partition) AS n FROM
         (SELECT *, sum(seq % 1000) OVER (PARTITION BY partition ORDER BY seq % 1000, path) AS total
          FROM (SELECT *, split_part(path, '/', 3) AS randompath FROM ({ledger_rows}) WHERE o_orderstatus <> 'F'))
         WHERE total <= 4000) WHERE n >= 5""",
        "compact_small": f"""SELECT event_id, {_TS}, user_id, event_type, value, props, strftime(ts, '%Y') AS year,
         CAST(2 AS BIGINT) AS folders FROM events""",
        "distinct_of_table": f"SELECT DISTINCT value FROM ({_LANDED}) WHERE strftime(ts, '%Y/%m/%d') <> '2024/01/02'",
        "ingest_damaged": """SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS DOUBLE) AS price
         FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT NULL, NULL, o_orderstatus, o_totalprice FROM orders
         WHERE o_orderstatus = 'O'""",
    }
    for name in ("ingest_txt", "ingest_avro", "ingest_csv", "ingest_json", "ingest_json_gbk"):
        sql[name] = _INGESTED
    return sql


# ---------------------------------------------------------------- training-data operators, if present


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of ``logsilt.llm`` and of the pipeline; nothing where they are not installed."""
    try:
        import corpus_pipeline
        from logsilt.llm import queries as training
    except ModuleNotFoundError as missing:
        if (missing.name or "").split(".")[0] == "corpus_pipeline" or (missing.name or "").startswith("logsilt.llm"):
            return {}, {}
        raise
    found, sql = dict(training.QUERIES), dict(training.ORACLE_SQL)
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return core_queries() | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    return core_oracle_sql() | _training_data()[1]
