"""Running totals, quantiles, rank search and the time split."""

from __future__ import annotations

import itertools
import math
import random
import re
import struct
from datetime import date
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnspark.operators import ordered
from txnspark.operators.ordered import (
    at_or_before,
    cut_by_rank,
    first_rows,
    keys_at_ranks,
    quantiles,
    running_totals,
)
from txnspark.operators.split import split_report, time_split


@pytest.mark.parametrize("limit", [10_000, 50])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_totals_with_a_hot_group(spark, limit, inclusive):
    rng = random.Random(1)
    data = [("hot" if i % 2 else rng.choice(["x", None, "z"]), i, rng.randint(-5, 9)) for i in range(800)]
    df = spark.createDataFrame(data, "g string, o int, v int").repartition(5)
    out = running_totals(
        df, group=["g"], order=["o"], sums={"upto": "v"}, totals={"whole": "v"}, inclusive=inclusive, one_task_rows=limit
    )
    got = {r["o"]: (r["upto"], r["whole"]) for r in out.collect()}
    for g, part in itertools.groupby(sorted(data, key=lambda r: (str(r[0]), r[1])), key=lambda r: r[0]):
        part = list(part)
        total, seen = sum(v for _, _, v in part), 0
        for _, o, v in part:
            assert got[o] == (seen + v if inclusive else seen, total), g
            seen += v


@pytest.mark.parametrize("limit", [10_000, 40])
def test_running_totals_descending_without_group(spark, limit):
    df = spark.range(300).selectExpr("cast(id as double) as s", "1 as one")
    out = running_totals(df, order=["s"], descending=["s"], sums={"n": "one"}, one_task_rows=limit)
    assert all(r["n"] == 300 - r["s"] for r in out.collect())


@pytest.mark.parametrize("limit", [10_000, 30])
def test_quantiles_equal_linear_interpolation(spark, limit):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=301), rng.integers(0, 5, size=200).astype(float)
    data = [("a", float(v)) for v in a] + [("b", float(v)) for v in b] + [("b", None), ("a", float("nan"))]
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: list(r)[1:] for r in quantiles(df, "v", probs, group=["g"], one_task_rows=limit).collect()}
    assert np.allclose(got["a"], np.quantile(a, probs)) and np.allclose(got["b"], np.quantile(b, probs))
    everything = quantiles(df, "v", probs, one_task_rows=limit).first()
    assert np.allclose(list(everything), np.quantile(np.concatenate([a, b]), probs))


@pytest.mark.parametrize("limit", [10_000, 7])
@pytest.mark.parametrize(
    "keys", [["t", "i"], ["ts", "i"], ["d", "i"], ["x", "i"], ["s", "i"], ["t", "s", "i"], ["i"]]
)
def test_keys_at_ranks(spark, limit, keys):
    rng = random.Random(9)
    data = [(i, rng.choice([None, 1, 2, 2, 2, 900]), rng.choice(["p", "q", None]), rng.random()) for i in range(90)]
    df = spark.createDataFrame(data, "i int, t int, s string, x double").withColumns(
        {"ts": F.timestamp_seconds("t"), "d": F.date_add(F.lit("2020-01-01").cast("date"), F.col("t"))}
    )
    ordered = df.orderBy(*[F.col(k).asc_nulls_last() for k in keys]).select(*keys).collect()
    ranks = [1, 17, 45, 90]
    cuts = keys_at_ranks(df, keys, ranks, one_task_rows=limit)
    assert [c.key for c in cuts] == [tuple(ordered[r - 1]) for r in ranks]
    fixed, conditions = cut_by_rank(df, keys, ranks, one_task_rows=limit)
    assert [fixed.filter(c).count() for c in conditions] == ranks


@pytest.mark.parametrize("limit", [10_000, 5])
def test_first_rows(spark, limit):
    df = spark.range(100).selectExpr("id % 3 as k", "id")
    got = sorted((r["k"], r["id"]) for r in first_rows(df, 40, ["k", "id"], one_task_rows=limit).collect())
    assert got == sorted((i % 3, i) for i in range(100))[:40]
    assert first_rows(df, 40, ["k"], one_task_rows=limit).count() == 40
    assert first_rows(df, None, ["k"]).count() == first_rows(df, -1, ["k"]).count() == 100
    assert first_rows(df, 0, ["k"]).count() == 0
    assert first_rows(df, 1000, ["k"], one_task_rows=limit).count() == 100


# ---------------------------------------------------------------- time split


def split_frame(spark, pairs):
    return spark.createDataFrame([(i, dt, i % 2) for i, dt in pairs], "transaction_id long, transaction_dt int, is_fraud int")


def ids(df):
    return sorted(r["transaction_id"] for r in df.collect())


@pytest.mark.parametrize("limit", [10_000, 2])
def test_blocks_are_contiguous(spark, limit):
    df = split_frame(spark, [(5, 50), (1, 10), (2, 20), (3, 30), (4, 40), *[(i, 10 * i) for i in range(6, 11)]])
    out = time_split(df, ratios=(0.5, 0.2, 0.3), one_task_rows=limit)
    assert out.sizes == (5, 2, 3)
    assert (ids(out.train), ids(out.val), ids(out.test)) == ([1, 2, 3, 4, 5], [6, 7], [8, 9, 10])
    assert out.train.columns == df.columns


def test_tiebreaker_and_remainder(spark):
    out = time_split(split_frame(spark, [(2, 10), (1, 10), (3, 20)]), ratios=(1 / 3, 1 / 3, 1 / 3))
    assert (ids(out.train), ids(out.val), ids(out.test)) == ([1], [2], [3])
    assert time_split(split_frame(spark, [(i, i) for i in range(11)])).sizes == (7, 1, 3)


@pytest.mark.parametrize("limit", [10_000, 3])
def test_split_through_ties_keeps_sizes(spark, limit):
    """No tiebreaker and one time for most rows: the block sizes still hold."""
    df = split_frame(spark, [(i, 7 if i < 15 else 100 + i) for i in range(20)])
    out = time_split(df, tiebreaker_col=None, one_task_rows=limit)
    assert (out.train.count(), out.val.count(), out.test.count()) == out.sizes == (14, 3, 3)
    copies = df.unionByName(df).withColumn("transaction_id", F.lit(1).cast("long"))
    out = time_split(copies, one_task_rows=limit)
    assert (out.train.count(), out.val.count(), out.test.count()) == out.sizes == (28, 6, 6)


def test_missing_times_come_last(spark):
    out = time_split(split_frame(spark, [(1, None), *[(i, i) for i in range(2, 11)]]))
    assert 1 in ids(out.test)


def test_split_errors(spark):
    df = split_frame(spark, [(i, i) for i in range(10)])
    with pytest.raises(ValueError, match="when"):
        time_split(df, time_col="when")
    with pytest.raises(ValueError, match="sum to 1"):
        time_split(df, ratios=(0.5, 0.2, 0.2))
    with pytest.raises(ValueError, match="3 positive"):
        time_split(df, ratios=(0.5, 0.5))
    with pytest.raises(ValueError, match="positive"):
        time_split(df, ratios=(1.2, -0.1, -0.1))
    with pytest.raises(ValueError, match="empty partition"):
        time_split(df.limit(2))
    with pytest.raises(ValueError, match="empty DataFrame"):
        time_split(df.filter("false"))


def test_report(spark):
    out = time_split(split_frame(spark, [(i, i) for i in range(20)]))
    got = {r["split"]: tuple(r)[1:] for r in split_report(out.labelled).collect()}
    assert got == {"train": (14, 7, 0.5, 0, 13), "val": (3, 1, 1 / 3, 14, 16), "test": (3, 2, 2 / 3, 17, 19)}


@pytest.mark.parametrize(
    "kind, values",
    [
        ("double", [float("nan")] * 5 + [float("inf"), float("-inf")] * 6 + [1e308, -1e308, 0.0, -0.0, 5e-324] * 8 + [None] * 7),
        ("double", [10.0**k for k in range(-300, 300, 5)] + [-(10.0**k) for k in range(-300, 300, 7)]),
        ("long", [10**18] * 90 + [10**18 + 1] * 30 + [-(2**63), 2**63 - 1, 0, -1, 1]),
        ("decimal(12,3)", [Decimal(k) / 8 for k in range(-60, 60)] + [Decimal("0.125")] * 40),
        ("date", [date(1600 + 3 * (k % 90), 1, 1) for k in range(150)]),
        ("string", [f"{k % 37:03d}" for k in range(150)]),
    ],
)
def test_ranks_beyond_one_task(spark, kind, values):
    """The search ends and agrees with a sort, whatever the values."""
    df = spark.createDataFrame([(v, k) for k, v in enumerate(values)], f"v {kind}, id long")
    df = df.repartition(5)
    placed = df.orderBy(F.col("v").asc_nulls_last(), "id").collect()
    ranks = [1, 13, len(values) // 2, len(values) - 1, len(values)]
    cuts = keys_at_ranks(df, ["v", "id"], ranks, one_task_rows=10)
    for rank, cut in zip(ranks, cuts):
        row = placed[rank - 1]
        assert cut.key[1] == row.id
        assert cut.key[0] == row.v or (row.v != row.v and cut.key[0] != cut.key[0])
        assert df.filter(at_or_before(["v", "id"], cut)).count() == rank


@pytest.mark.parametrize("most", [None, 3])
def test_quantiles_of_odd_values(spark, most, monkeypatch):
    """Outliers, infinities, tiny and equal values, null groups; also when the driver gives up on groups."""
    if most is not None:
        monkeypatch.setattr(ordered, "_RANGES", most)
        monkeypatch.setattr(ordered, "_BINS_COLLECTED", 64)
    rng = np.random.default_rng(7)
    data = {
        "wide": [*(10.0 ** rng.uniform(-300, 300, 200)), *(-(10.0 ** rng.uniform(-300, 300, 150)))],
        "near": list(1e15 + rng.integers(0, 4000, 300) / 8),
        "tiny": [5e-324 * k for k in range(40)] + [-0.0, 0.0],
        "same": [3.25] * 50,
        "ends": [float("inf"), float("-inf"), 1.7976931348623157e308, -1.7976931348623157e308, 0.0, 1.0, 2.0],
        None: list(rng.normal(size=99)),
        "one": [4.5],
    }
    rows = [(g, float(v)) for g, vs in data.items() for v in vs] + [("lost", None), ("same", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.5, 1.0, 0.25, 1 / 3]
    got = {r["g"]: list(r)[1:] for r in quantiles(df, "v", probs, group=["g"]).collect()}
    assert set(got) == set(data)
    for g, vs in data.items():
        vs = sorted(vs)
        for p, q in zip(probs, got[g]):
            at = (len(vs) - 1) * p
            lo, hi = vs[int(np.floor(at))], vs[int(np.ceil(at))]
            want = lo + (hi - lo) * (at - np.floor(at)) if lo != hi else lo
            assert q == want or (np.isnan(q) and np.isnan(want)), (g, p)


def test_quantiles_shuffle_no_values(spark, monkeypatch):
    """Every shuffle is keyed by group and bin; none carries the values."""
    plans = []
    real = ordered._bins
    monkeypatch.setattr(ordered, "_bins", lambda d, k: plans.append(real(d, k)) or plans[-1])
    df = spark.range(20_000).selectExpr("id % 3 AS g", "CAST((id * 7919) % 20011 AS DOUBLE) / 7 AS v")
    assert quantiles(df, "v", [0.1, 0.5], group=["g"]).count() == 3
    assert 2 <= len(plans) <= 5
    for plan in plans:
        keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan._jdf.queryExecution().executedPlan().toString())
        assert keys and all("_v" not in k and "_x" not in k for k in keys)


def test_doubles_as_numbers(spark):
    rng = random.Random(2)
    values = [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3_000)] + [2.0**k for k in range(-1074, 1024)]
    values += [x for k in range(-1070, 1024, 13) for x in (math.nextafter(2.0**k, 0), math.nextafter(2.0**k, math.inf))]
    values += [0.0, -0.0, math.inf, -math.inf, math.nan, 5e-324, -5e-324, 1.7976931348623157e308]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    number = ordered._as_number(df, "x")
    for v, n in df.select("x", number.alias("n")).collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        assert n == (0x7FF0000000000001 if math.isnan(v) else bits if v >= 0 else -bits), v


def test_a_chunk_is_a_tasks_own(spark, monkeypatch):
    monkeypatch.setattr(ordered, "CHUNK_ROWS", 50)
    df = spark.range(1500).selectExpr("id % 3 = 0 AS g", "id AS x", "id % 7 AS v")
    out = running_totals(df, group=["g"], order=["x"], sums={"s": "v"}, one_task_rows=100)
    rows = sorted((r["g"], r["x"], r["s"]) for r in out.collect())
    want = []
    for g in (False, True):
        total = 0
        for x in range(1500):
            if (x % 3 == 0) == g:
                total += x % 7
                want.append((g, x, total))
    assert rows == want
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) <= 120 and len(sizes) >= 15
