"""Which input files have been landed: manifests of runs, valid from the ledger entry that names them."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsilt.catalog import ledger
from logsilt.layout import RANDOM_KEY, Store, Subject
from logsilt.session import path_exists
from logsilt.sources.files import as_paths

FILE = "path string, length bigint, modificationTime timestamp"
_KEYS = ["path", "length", "modificationTime"]
# Characters of file names that a path pattern would take for its own.
_GLOB = re.compile(r"([\[\]{}*?\\])")


class AlreadyTaken(RuntimeError):
    """Another run has landed some of the same files meanwhile."""


@dataclass(frozen=True)
class Manifest:
    """The files a run takes, as a small table ``<root>/run=<run>``."""

    root: str
    run: str

    def files(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(FILE).parquet(f"{self.root}/run={self.run}")

    def paths(self, spark: SparkSession) -> list[str]:
        """Paths to read. A reader takes them as patterns, so their own special characters are escaped."""
        rows = self.files(spark).select("path").orderBy("path").toLocalIterator()
        return [_GLOB.sub(r"\\\1", row.path) for row in rows]

    def event(self, spark: SparkSession) -> DataFrame:
        """The ledger event that makes the manifest count."""
        columns = f"partition string, {RANDOM_KEY} string, path string, op string"
        return spark.createDataFrame([(None, None, self.run, ledger.TAKEN)], columns)

    def check(self, since: DataFrame) -> None:
        """Fails if runs that have come in since took some of the same files."""
        spark = since.sparkSession
        other = taken_files(spark, self.root, since)
        if other is not None and not self.files(spark).join(other, _KEYS, "left_semi").isEmpty():
            raise AlreadyTaken(f"files of run {self.run} have been landed by another run")


def taken_files(spark: SparkSession, root: str, events: DataFrame) -> DataFrame | None:
    """Files of all manifests that events name."""
    if not path_exists(spark, root):
        return None
    runs = events.where(F.col("op") == ledger.TAKEN).select(F.col("path").alias("run"))
    files = spark.read.schema(f"{FILE}, run string").option("basePath", root).parquet(root)
    return files.join(runs, "run", "left_semi").select(*_KEYS)


def new_files(spark: SparkSession, store: Store, subject: Subject, files: str | Sequence[str]) -> Manifest:
    """A manifest of those files under paths or patterns that no landed run has taken.

    The listing is a table of names, lengths and times, anti-joined with the landed manifests.
    """
    manifest = Manifest(f"{store.root.rstrip('/')}/_manifests/subject={subject}", uuid.uuid4().hex)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(as_paths(files)).select(*_KEYS)
    taken = taken_files(spark, manifest.root, ledger.ledger_events(spark, store, subject))
    fresh = found if taken is None else found.join(taken, _KEYS, "left_anti")
    fresh.write.parquet(f"{manifest.root}/run={manifest.run}")
    return manifest
