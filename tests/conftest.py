from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def build_session():
    from pyspark.sql import SparkSession

    from logsilt import configure

    spark = (
        SparkSession.builder.master("local[8]")
        .appName("logsilt-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@pytest.fixture(scope="session")
def spark():
    session = build_session()
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    import uuid

    from logsilt import Store

    return Store(str(tmp_path / "store"), db_prefix=f"t{uuid.uuid4().hex[:10]}_")
