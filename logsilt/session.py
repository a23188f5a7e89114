"""Session settings and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Runtime settings under which results match the documented semantics.
RUNTIME_CONF = {
    # action times are wall-clock strings; pin the zone they are written in
    "spark.sql.session.timeZone": "UTC",
    # month=01 must stay '01'
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # "" for a non-string JSON field is null, not a malformed record
    "spark.sql.legacy.json.allowEmptyString.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings. Call once per session, before the first read."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


# Settings that an analysis needs for a moment are changed by one thread at a time.
_SETTINGS = threading.RLock()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Some settings of the session for the moment of an analysis, put back afterwards."""
    with _SETTINGS:
        before = {key: spark.conf.get(key, None) for key in values}
        try:
            for key, value in values.items():
                spark.conf.set(key, value)
            yield
        finally:
            for key, value in before.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def apart(df: DataFrame, values: dict[str, str]) -> Iterator[DataFrame]:
    """``df`` in a session of its own, with the settings of its session and some more, which that one never
    sees."""
    spark = df.sparkSession
    name = f"logsilt_{uuid.uuid4().hex}"
    other = spark.newSession()
    for row in spark.sql("SET").collect():
        if spark.conf.isModifiable(row.key):
            other.conf.set(row.key, row.value)
    for key, value in values.items():
        other.conf.set(key, value)
    df.createGlobalTempView(name)
    try:
        yield other.table(f"{spark.conf.get('spark.sql.globalTempDatabase')}.{name}")
    finally:
        spark.catalog.dropGlobalTempView(name)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder on storage that every executor can reach.

    The cluster names the shared place in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one machine, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="logsilt-")
    return f"{base.rstrip('/')}/logsilt/{name}-{uuid.uuid4().hex}"


def on_path(spark: SparkSession) -> None:
    """Put this package on the workers' path where they share the file system, for functions of ours that
    run in Python workers. Elsewhere it comes the usual way, by ``--py-files`` or as part of the image."""
    home = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in known:
        environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, known)])


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _hadoop_path(spark, path)
    return fs.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder and what it holds; False when it was not there."""
    hadoop_path, fs = _hadoop_path(spark, path)
    return fs.delete(hadoop_path, True)


def child_folders(spark: SparkSession, pattern: str, hidden: bool = False) -> list[str]:
    """Paths that match a wildcard pattern, by listing alone; hidden ones only if asked for."""
    hadoop_path, fs = _hadoop_path(spark, pattern)
    found = fs.globStatus(hadoop_path) or []
    paths = [status.getPath() for status in found]
    return [p.toString() for p in paths if hidden or not p.getName().startswith(("_", "."))]


def move_new(spark: SparkSession, folder: str, target: str) -> bool:
    """Give a folder that holds files its final name in one step; False if the name is taken.

    Of several that try the same name at once, one gets it. That takes a file system that renames in
    one step and not onto what is there: HDFS and its like, or a local one.
    """
    source, fs = _hadoop_path(spark, folder)
    final = spark._jvm.org.apache.hadoop.fs.Path(target)
    gateway = spark.sparkContext._gateway
    try:
        if fs.getUri().getScheme() == "file":
            # a folder is renamed onto an empty one only, and ours are not empty
            files = spark._jvm.java.nio.file
            paths = [files.Paths.get(p.toUri().getPath(), gateway.new_array(gateway.jvm.String, 0)) for p in (source, final)]
            options = gateway.new_array(files.CopyOption, 1)
            options[0] = files.StandardCopyOption.ATOMIC_MOVE
            files.Files.move(*paths, options)
        else:
            rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
            options = gateway.new_array(rename, 1)
            options[0] = rename.NONE
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
            context.rename(source, final, options)
    except Py4JJavaError:
        if fs.exists(final):
            return False
        raise
    return True


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file."""
    hadoop_path, fs = _hadoop_path(spark, path)
    fs.create(hadoop_path, True).close()
