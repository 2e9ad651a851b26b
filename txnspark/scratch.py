"""Shared scratch space for intermediate tables.

A few operators need a result to be *fixed* before it is read twice (for example
the chunk number of a range-partitioned row).  They write it as Parquet below the
checkpoint folder of the cluster and read it back, so that a lost executor never
makes Spark recompute it differently.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Most bytes of a table that is sent to every executor.
BROADCAST_BYTES = 64 << 20
_CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_roots: dict[str, tempfile.TemporaryDirectory] = {}
_passing = threading.local()


def scratch_root(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables.

    Uses ``spark.checkpoint.dir``.  Only a local-mode session, where every task
    shares the driver's disk, may fall back to a temporary folder.
    """
    conf = spark.sparkContext.getConf()
    root = spark.conf.get(_CHECKPOINT_KEY, None) or conf.get(_CHECKPOINT_KEY, None)
    app = spark.sparkContext.applicationId
    if root:
        return f"{root.rstrip('/')}/txnspark/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            f"set {_CHECKPOINT_KEY} to a folder that all executors share before using this operator"
        )
    if app not in _local_roots:
        _local_roots[app] = tempfile.TemporaryDirectory(prefix="txnspark-")
    return _local_roots[app].name


def scratch_path(spark: SparkSession, label: str = "tmp") -> str:
    """A fresh, unused path below :func:`scratch_root`."""
    root = getattr(_passing, "root", None) or scratch_root(spark)
    return f"{root}/{label}-{uuid.uuid4().hex}"


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What this thread stores inside is deleted at the end, so its results must be read by then."""
    outer, _passing.root = getattr(_passing, "root", None), scratch_path(spark, "passing")
    root = _passing.root
    try:
        yield
    finally:
        _passing.root = outer
        _delete(spark, root)


def materialize(df: DataFrame, label: str = "tmp") -> tuple[DataFrame, int]:
    """Write ``df`` once, return the stored copy and its row count.

    The count comes from an observation on the write, not from a second job.
    """
    path = scratch_path(df.sparkSession, label)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]


def task_count(spark: SparkSession, rows: int, rows_a_task: int) -> int:
    """Tasks to deal ``rows`` to so that each gets about ``rows_a_task``: no fewer than Spark's shuffles have, more for large data."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_a_task))


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, marked for broadcast when its measured size allows it; beyond, joins shuffle.

    ``df`` is read to be measured, so it should be a stored table.
    """
    texts = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16 for c in df.columns]
    size = df.agg(F.sum(sum(texts[1:], texts[0]).cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to its scratch folder."""
    _delete(spark, scratch_root(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
