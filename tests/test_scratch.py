"""Where intermediate tables go."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest

from txnspark import scratch


def session(master, **conf):
    """Just enough of a session for the choice of a folder."""
    get = SimpleNamespace(get=lambda key, default=None: conf.get(key.replace(".", "_"), default))
    context = SimpleNamespace(master=master, applicationId="app-1", getConf=lambda: get)
    return SimpleNamespace(conf=get, sparkContext=context)


def test_checkpoint_folder_is_used():
    root = scratch.scratch_root(session("yarn", spark_checkpoint_dir="hdfs:///shared/"))
    assert root == "hdfs:///shared/txnspark/app-1"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(session("spark://host:7077"))
    assert scratch.scratch_root(session("local[2]"))


def test_materialize_counts_its_rows(spark):
    for n in (0, 5):
        stored, rows = scratch.materialize(spark.range(n))
        assert rows == n == stored.count()
    assert scratch.scratch_path(spark) != scratch.scratch_path(spark)


def test_passing_tables_are_deleted_and_others_stay(spark):
    with ThreadPoolExecutor(1) as other:
        with scratch.passing(spark):
            inside = scratch.materialize(spark.range(3))[0].inputFiles()[0]
            with scratch.passing(spark):
                nested = scratch.materialize(spark.range(3))[0].inputFiles()[0]
            assert not os.path.exists(nested.removeprefix("file://")) and os.path.exists(inside.removeprefix("file://"))
            beside = other.submit(lambda: scratch.materialize(spark.range(3))[0].inputFiles()[0]).result()
    after = scratch.materialize(spark.range(3))[0].inputFiles()[0]
    assert not os.path.exists(inside.removeprefix("file://"))
    assert all(os.path.exists(p.removeprefix("file://")) for p in (beside, after))
    with pytest.raises(ValueError), scratch.passing(spark):
        failed = scratch.materialize(spark.range(3))[0].inputFiles()[0]
        raise ValueError
    assert not os.path.exists(failed.removeprefix("file://"))
