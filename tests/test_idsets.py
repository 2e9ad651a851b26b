"""Bitmaps of ids: exact for any sign, sparse or dense, with NULLs."""

from __future__ import annotations

import random

import pytest

from txnspark.operators.idsets import containment, id_set, members
from txnspark.operators.joins import is_subset


def frame(spark, values):
    return spark.createDataFrame([(v, "x", 1) for v in values], "k long, a string, bits int").repartition(3)


@pytest.fixture
def numbers():
    rng = random.Random(1)
    edges = [0, 1, -1, 7, 8, 9, 32767, 32768, 32769, -32767, -32768, -32769, 65536, 2**40, -(2**40), 2**62, -(2**62)]
    pool = [*edges, *range(-300, 300), *(rng.randrange(-(2**50), 2**50) for _ in range(200))]
    return rng, pool


@pytest.mark.parametrize("max_bytes", [1 << 26, 0])
def test_members(spark, numbers, max_bytes):
    rng, pool = numbers
    ids = rng.sample(pool, 400) + [None, None]
    rows = pool + rng.choices(pool, k=200) + [None]
    held = id_set(frame(spark, ids + ids[:50]), "k")
    assert held.has_null
    df, known = frame(spark, rows), set(ids) - {None}
    kept = members(df, "k", held, max_bytes=max_bytes)
    assert kept.columns == df.columns
    assert sorted(r.k for r in kept.collect()) == sorted(v for v in rows if v in known)
    rest = members(df, "k", held, negate=True, max_bytes=max_bytes).collect()
    assert sorted((r.k for r in rest), key=str) == sorted((v for v in rows if v not in known), key=str)


def test_rows_are_not_shuffled(spark):
    held = id_set(spark.range(100_000).withColumnRenamed("id", "k"), "k")
    assert held.buckets == 5  # 0 has a bucket of its own
    plan = members(spark.range(10).withColumnRenamed("id", "k"), "k", held)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_containment(spark, numbers):
    rng, pool = numbers
    for part, whole in (
        (pool[:100], pool),
        (pool, pool[:300]),
        (pool[:50] + [None], pool),
        ([None], [None, 1]),
        ([], [1, 2]),
        ([1, 2, 2], []),
        (rng.sample(pool, 300), rng.sample(pool, 500)),
    ):
        a, b = frame(spark, part), frame(spark, whole)
        assert tuple(containment(id_set(a, "k"), id_set(b, "k")).first()) == tuple(is_subset(a, b, "k").first())


def test_no_ids(spark):
    none = id_set(frame(spark, []), "k")
    df = frame(spark, [1, None])
    assert members(df, "k", none).collect() == [] and members(df, "k", none, negate=True).count() == 2
