"""Profiling, drift and ranking metrics against pandas, numpy and direct counting."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txnspark.functions.groups import column_groups
from txnspark.operators import drift, metrics, profile

SCHEMA = (
    "TransactionID long, isFraud int, TransactionAmt double, ProductCD string, card1 double, C1 double, "
    "D1 double, D2 double, V1 double, V2 float, id_01 double, DeviceType string"
)


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(7)
    n = 600

    def holes(values, share):
        out = values.astype(object)
        out[rng.random(n) < share] = None
        return out

    return pd.DataFrame(
        {
            "TransactionID": np.arange(n),
            "isFraud": (rng.random(n) < 0.2).astype(int),
            "TransactionAmt": np.round(rng.lognormal(3, 1, n), 2),
            "ProductCD": holes(rng.choice(list("WCHRS"), n, p=[0.5, 0.2, 0.15, 0.1, 0.05]), 0.1),
            "card1": rng.integers(1, 40, n).astype(float),
            "C1": np.ones(n),
            "D1": holes(rng.normal(size=n), 0.5),
            "D2": holes(rng.normal(size=n), 0.95),
            "V1": holes(rng.normal(size=n), 0.3),
            "V2": rng.normal(size=n),
            "id_01": holes(rng.normal(size=n), 0.7),
            "DeviceType": holes(rng.choice(["mobile", "desktop"], n), 0.6),
        }
    )


@pytest.fixture(scope="module")
def df(spark, pdf):
    rows = [tuple(None if v is None else (v.item() if hasattr(v, "item") else v) for v in r) for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, SCHEMA)


def test_groups():
    names = ["TransactionID", "card1", "addr2", "R_emaildomain", "C1", "Cx", "D15", "M9", "V339", "id_38", "DeviceInfo", "dist1"]
    assert column_groups(names) == {
        "core": ["TransactionID"], "card": ["card1"], "addr": ["addr2"], "email": ["R_emaildomain"], "C": ["C1"],
        "D": ["D15"], "M": ["M9"], "V": ["V339"], "id": ["id_38"], "device": ["DeviceInfo"], "other": ["Cx", "dist1"],
    }


def test_missing(df, pdf):
    want = pdf.isna().mean() * 100
    got = {r["column"]: r["pct_missing"] for r in profile.missing_rates(df).collect()}
    assert got.keys() == set(pdf.columns) and all(math.isclose(got[c], want[c], abs_tol=1e-9) for c in got)
    top = profile.missing_summary(df, top_n=3).collect()
    assert [r["column"] for r in top] == list(want.sort_values(ascending=False).index[:3])
    assert [r["column"] for r in profile.columns_missing_above(df).collect()] == ["D2"]
    groups = {r["group"]: (r["n_columns"], r["avg_pct_missing"]) for r in profile.missing_by_group(df).collect()}
    assert groups["D"][0] == 2 and math.isclose(groups["D"][1], want[["D1", "D2"]].mean())
    own = profile.missing_by_group(df, {"mine": ["V1", "absent"]}).collect()
    assert [(r["group"], r["n_columns"]) for r in own] == [("mine", 1)]
    blocks = {r["group"]: r["max_pct_missing"] for r in profile.missing_blocks(df).collect()}
    assert sorted(blocks) == ["C", "D", "V"] and math.isclose(blocks["D"], want["D2"])


def test_nan_counts_as_missing(spark):
    df = spark.sql("SELECT double('NaN') a, 1 `odd``name's` UNION ALL SELECT 2.0D, NULL")
    got = {r["column"]: r["pct_missing"] for r in profile.missing_rates(df).collect()}
    assert got == {"a": 50.0, "odd`name's": 50.0}


def test_wide_frames_are_batched(spark):
    df = spark.range(3).select(*[F.lit(i if i % 2 else None).cast("int").alias(f"V{i}") for i in range(250)])
    assert profile.missing_blocks(df).first()["avg_pct_missing"] == 50.0


def test_target_rate(df, pdf):
    want = pdf.groupby("ProductCD")["isFraud"].agg(["count", "mean"])
    want = want[want["count"] >= 60].sort_values("mean", ascending=False)
    got = profile.target_rate(df, "ProductCD", "isFraud", min_count=60).collect()
    assert [r["level"] for r in got] == list(want.index)
    assert np.allclose([r["mean"] for r in got], want["mean"])


def test_balance_and_coverage(df, pdf):
    got = {r["isFraud"]: r for r in profile.class_balance(df, "isFraud").collect()}
    counts = pdf["isFraud"].value_counts()
    assert got[1]["count"] == counts[1] and math.isclose(got[1]["majority_ratio"], counts[0] / counts[1])
    has = pdf["id_01"].notna()
    cover = {r["present"]: r for r in profile.coverage_rate(df, "id_01", "isFraud").collect()}
    assert math.isclose(cover[True]["pct_rows"], has.mean() * 100)
    assert math.isclose(cover[False]["rate"], pdf.loc[~has, "isFraud"].mean())


def test_describe(df, pdf):
    want = pdf.groupby("isFraud")["TransactionAmt"].describe()
    for r in profile.describe_by(df, "TransactionAmt", "isFraud").collect():
        assert np.allclose([r[c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")], want.loc[r["isFraud"]])
    one = profile.describe_by(df, "TransactionAmt").first()
    assert math.isclose(one["q50"], pdf["TransactionAmt"].median())
    many = {r["column"]: r for r in profile.describe_columns(df, ["V1", "card1"]).collect()}
    assert math.isclose(many["V1"]["std"], pdf["V1"].astype(float).std())


@pytest.mark.parametrize("column", ["TransactionAmt", "card1", "C1"])
def test_deciles(df, pdf, column):
    bins = pd.qcut(pdf[column], 10, duplicates="drop")
    got = sorted(profile.decile_rate(df, column, "isFraud").collect(), key=lambda r: r["bin"])
    if column == "C1":  # one value: a single bin
        assert [(r["count"], r["lo"], r["hi"]) for r in got] == [(600, 1.0, 1.0)]
        return
    want = pdf.groupby(bins, observed=True)["isFraud"].agg(["count", "mean"])
    assert [r["count"] for r in got] == list(want["count"]) and np.allclose([r["rate"] for r in got], want["mean"])


def test_cardinality_and_counts(df, pdf):
    want = {c: pdf[c].nunique() for c in ("card1", "ProductCD", "DeviceType", "D2")}
    assert {r["column"]: r["n_distinct"] for r in profile.cardinality(df, list(want)).collect()} == want
    approx = profile.cardinality(df, ["card1"], approx_rsd=0.01).first()
    assert abs(approx["n_distinct"] - want["card1"]) <= 1
    counts = pdf["DeviceType"].value_counts(dropna=False)
    got = profile.value_counts(df, "DeviceType").collect()
    assert [r["count"] for r in got] == list(counts) and got[0]["value"] is None
    assert math.isclose(sum(r["share"] for r in profile.value_counts(df, "DeviceType", drop_missing=True).collect()), 1)


def test_correlations(df, pdf):
    names = ["TransactionAmt", "C1", "D1", "D2", "V1", "V2", "id_01", "isFraud"]
    matrix = pdf[names].astype(float).astype({"V2": "float32"}).astype(float).corr()
    got = {(r["i"], r["j"]): r["r"] for r in profile.corr_matrix(df, names).collect()}
    assert len(got) == 64
    for pair, r in got.items():
        want = matrix.loc[pair]
        assert r is None if np.isnan(want) else math.isclose(r, want, abs_tol=1e-9), pair
    ranked = profile.corr_with_label(df, "isFraud", top_n=3).collect()
    order = matrix["isFraud"].drop("isFraud").abs().sort_values(ascending=False).index
    assert ranked[0]["abs_r"] >= ranked[1]["abs_r"] and len(ranked) == 3 and order[0] in {r["column"] for r in ranked}


@pytest.mark.parametrize("clip", [None, (0.01, 0.99)])
def test_histogram(df, pdf, clip):
    x = pdf["TransactionAmt"]
    lo, hi = (x.min(), x.max()) if clip is None else x.quantile(list(clip))
    got = profile.histogram_by_class(df, "TransactionAmt", "isFraud", bins=12, clip=clip).collect()
    for y in (0, 1):
        counts, _ = np.histogram(x[pdf["isFraud"] == y], bins=12, range=(lo, hi))
        density, _ = np.histogram(x[pdf["isFraud"] == y], bins=12, range=(lo, hi), density=True)
        mine = {r["bin"]: r for r in got if r["isFraud"] == y}
        assert [mine[b]["count"] if b in mine else 0 for b in range(12)] == list(counts)
        assert all(math.isclose(mine[b]["density"], density[b]) for b in mine)
    constant = profile.histogram_by_class(df, "C1", "isFraud", bins=4).collect()
    assert {(r["bin"], r["lo"]) for r in constant} == {(0, 1.0)}


def test_boxplot(df, pdf):
    for r in profile.boxplot_stats(df, "TransactionAmt", "isFraud").collect():
        x = pdf.loc[pdf["isFraud"] == r["isFraud"], "TransactionAmt"]
        q1, q2, q3 = x.quantile([0.25, 0.5, 0.75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert np.allclose([r["q1"], r["q2"], r["q3"], r["whisker_lo"], r["whisker_hi"]], [q1, q2, q3, inside.min(), inside.max()])
        assert r["outliers"] == len(x) - len(inside)


def test_keys_schema_shape(spark, df):
    assert tuple(profile.key_check(df, "card1").first())[1:2] == (600,)
    assert profile.key_check(df, "TransactionID", "t").first()["is_unique"]
    assert tuple(profile.key_check(df.filter("false"), "card1").first()) == ("table", 0, 0, 0, True)
    diff = {r["column"]: r["side"] for r in profile.schema_diff(df.select("V1", "C1"), df.select("V1", "D1"), ignore=("C1",)).collect()}
    assert diff == {"V1": "both", "D1": "right"}
    assert tuple(profile.frame_shape(df).first()) == (600, 12, 2, 8, 2, 0)


def test_sample_ignores_partitioning(df):
    a, b = (profile.hash_sample(d, 50, "TransactionID").collect() for d in (df, df.repartition(7)))
    assert sorted(a) == sorted(b) and len(a) == 50
    assert profile.hash_sample(df, 50, "TransactionID", seed=1).collect() != a
    assert profile.hash_sample(df, 5000, "TransactionID").count() == 600


def test_type_advice(spark, df):
    extra = df.select(
        "ProductCD", "V1", F.col("TransactionID").cast("string").alias("unique_text"),
        (F.col("TransactionID") % 100).alias("small"), (F.col("TransactionID") * -50).alias("medium"),
        (F.col("TransactionID") * 10**10).alias("big"), F.col("isFraud").alias("flag"),
    )
    advice = profile.type_advice(extra)
    assert {r["column"]: r["advised"] for r in advice.collect()} == {
        "ProductCD": "dictionary", "V1": "float", "unique_text": "string", "small": "tinyint",
        "medium": "smallint", "big": "bigint", "flag": "tinyint",
    }
    narrow = profile.apply_types(extra, advice)
    assert dict(narrow.dtypes)["small"] == "tinyint" and narrow.agg(F.sum("small")).first() == extra.agg(F.sum("small")).first()


def ks_direct(a, b):
    points = sorted(set(a) | set(b))
    return max(abs(sum(x <= p for x in a) / len(a) - sum(x <= p for x in b) / len(b)) for p in points)


@pytest.mark.parametrize("limit", [500_000, 40])
def test_ks(df, pdf, limit):
    left, right = df.filter("isFraud = 1"), df.filter("isFraud = 0")
    a, b = (pdf.loc[pdf["isFraud"] == y] for y in (1, 0))
    row = drift.ks_two_sample(left, right, "V1", one_task_rows=limit).first()
    x, y = (list(p["V1"].dropna().astype(float)) for p in (a, b))
    assert math.isclose(row["statistic"], ks_direct(x, y)) and (row["n_left"], row["n_right"]) == (len(x), len(y))
    row = drift.ks_two_sample(left, right, "V1", exact_rows=10, one_task_rows=limit).first()
    lam = math.sqrt(len(x) * len(y) / (len(x) + len(y))) * row["statistic"]
    tail = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 200))
    assert math.isclose(row["p_value"], min(1, tail), abs_tol=1e-9)
    row = drift.ks_two_sample(left, right, "ProductCD", one_task_rows=limit).first()
    x, y = (list(p["ProductCD"].fillna("nan")) for p in (a, b))
    assert math.isclose(row["statistic"], ks_direct(x, y))
    apart = drift.ks_two_sample(df.filter("TransactionID < 300"), df.filter("TransactionID >= 300"), "TransactionID").first()
    assert apart["statistic"] == 1.0 and apart["p_value"] < 1e-9


def test_exact_ks_tail_equals_enumeration():
    """Over all orders of two samples, for all sizes up to 8 by 8 and all gaps."""
    for m in range(1, 9):
        for n in range(1, 9):
            gaps, total = {}, math.comb(m + n, m)
            for left in itertools.combinations(range(m + n), m):
                a = b = most = 0
                for k in range(m + n):
                    a, b = (a + 1, b) if k in left else (a, b + 1)
                    most = max(most, abs(a * n - b * m))
                gaps[most] = gaps.get(most, 0) + 1
            for gap in range(m * n + 2):
                want = sum(c for g, c in gaps.items() if g >= gap) / total
                assert math.isclose(drift.exact_tail(m, n, gap), want, rel_tol=1e-9, abs_tol=1e-15), (m, n, gap)
    # Far out there is one path on either side; large samples come near the limit.
    assert math.isclose(drift.exact_tail(40, 60, 40 * 60), 2 / math.comb(100, 40), rel_tol=1e-9)
    assert abs(drift.exact_tail(900, 800, 900 * 800 // 15) - drift.kolmogorov_tail(math.sqrt(900 * 800 / 1700) / 15)) < 0.01


def test_ks_without_values(spark):
    rows = spark.createDataFrame([(1.0,), (None,)], "v double")
    none = drift.ks_two_sample(rows, rows.filter("v > 5"), "v").first()
    assert (none["statistic"], none["p_value"], none["n_left"]) == (None, None, 1)
    assert tuple(drift.ks_two_sample(rows, rows, "v").first()) == ("v", 0.0, 1.0, 1, 1)


def test_shares_and_missing_drift(df, pdf):
    left, right = df.filter("TransactionID < 300"), df.filter("TransactionID >= 300 and coalesce(ProductCD, '') <> 'W'")
    got = {r["value"]: (r["left_share"], r["right_share"]) for r in drift.share_comparison(left, right, "ProductCD", top_n=2).collect()}
    shares = pdf[:300]["ProductCD"].value_counts(normalize=True)
    assert set(got) == set(shares.index[:2]) and got["W"] == (pytest.approx(shares["W"]), 0.0)
    out = drift.missing_drift(df, df.withColumn("V1", F.lit(None).cast("double"))).first()
    assert out["group"] == "V" and out["missing_diff"] > 0


def ap_direct(y, s):
    total, tp, fp, out = sum(y), 0, 0, 0.0
    for value in sorted(set(s), reverse=True):
        p = sum(a for a, b in zip(y, s) if b == value)
        n = sum(1 - a for a, b in zip(y, s) if b == value)
        tp, fp = tp + p, fp + n
        out += p / total * tp / (tp + fp)
    return out


@pytest.mark.parametrize("limit", [500_000, 10])
def test_ranking_metrics(spark, limit):
    rng = np.random.default_rng(2)
    y, s = (rng.random(300) < 0.3).astype(int), np.round(rng.random(300), 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    row = metrics.ranking_metrics(df, "s", "y", one_task_rows=limit).first()
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(p > neg).mean() + (p == neg).mean() / 2 for p in pos])
    assert math.isclose(row["pr_auc"], ap_direct(y, s)) and math.isclose(row["roc_auc"], auc)
    single = metrics.ranking_metrics(df.filter("y = 0"), "s", "y").first()
    assert single["pr_auc"] is None and single["roc_auc"] is None
    weight = metrics.class_weight(df, "y").first()
    assert math.isclose(weight["weight"], (y == 0).sum() / (y == 1).sum())
    assert metrics.class_weight(df.filter("y = 0"), "y").first()["weight"] is None
