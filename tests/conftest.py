"""One local session for all tests; every catalog test gets its own schemas."""

from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from txnspark.settings import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("txnspark-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.checkpoint.dir", str(base / "checkpoint"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark):
    tag = uuid.uuid4().hex[:8]
    names = Lake(
        catalog="spark_catalog", bronze=f"b_{tag}", silver=f"s_{tag}", gold=f"g_{tag}", provider="parquet"
    )
    yield names
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP SCHEMA IF EXISTS {names.schema(layer)} CASCADE")


@pytest.fixture
def rows():
    """Sorted tuples of a frame, for comparison."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))

    return collect
