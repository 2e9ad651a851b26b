"""Prior-window features: boundaries, ties, missing values, hot entities, requests."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from txnspark.operators import joins, ordered, rolling
from txnspark.operators.rolling import (
    BEHAVIORAL_SPECS,
    RollingSpec,
    behavioral_features,
    hot_entities,
    point_features,
    prior_rows,
    rolling_features,
    score_requests,
)

T = datetime(2017, 12, 1, 12, tzinfo=timezone.utc)
A, B = "a" * 32, "b" * 32
NAMES = [s.name for s in BEHAVIORAL_SPECS]
SCHEMA = "transaction_id long, is_fraud int, derived_user_id string, transaction_at timestamp, transaction_amt double"
STRATEGIES = ["auto", "sweep", "chunked"]


def frame(spark, data):
    return spark.createDataFrame([(i, 0, u, at, amt) for i, u, at, amt in data], SCHEMA)


@pytest.fixture
def history(spark):
    return frame(
        spark,
        [
            (1, A, T - timedelta(days=45), 10.0),
            (2, A, T - timedelta(minutes=20), 20.0),
            (3, A, T - timedelta(minutes=10), 30.0),
            (4, A, T, 2000.0),
            (5, A, T, 40.0),
        ],
    )


def by_id(df, key="transaction_id"):
    return {r[key]: tuple(r[n] for n in NAMES) for r in df.collect()}


def same(a, b):
    return len(a) == len(b) and all(
        (x is None and y is None) or (x is not None and y is not None and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9))
        for x, y in zip(a, b)
    )


def brute(data, specs=BEHAVIORAL_SPECS, requests=None):
    """Direct reading of the definition."""
    out = {}
    for i, u, at, amt in requests if requests is not None else data:
        values = []
        for s in specs:
            prior = [
                (j, v)
                for j, w, t, v in data
                if u is not None and w == u and at - s.width <= t and (t < at or (t == at and i is not None and j < i))
            ]
            known = [v for _, v in prior if v is not None]
            mean = math.fsum(known) / len(known) if known else None
            if s.agg == "count":
                values.append(len(prior))
            elif s.agg == "sum":
                values.append(math.fsum(known))
            elif s.agg == "avg":
                values.append(mean)
            else:
                values.append(None if amt is None or not mean else amt / mean)
        out[i] = tuple(values)
    return out


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_published_example(history, strategy):
    got = by_id(rolling_features(history, strategy=strategy))
    assert same(got[4], (2, 50.0, 2000 / 25, 2000 / 20))
    assert got[5][:2] == (3, 2050.0)
    assert got[1] == (0, 0.0, None, None)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_edges_missing_amounts_and_zero_average(spark, strategy):
    data = [
        (1, A, T - timedelta(hours=1, microseconds=1), 5.0),  # just outside one hour
        (2, A, T - timedelta(hours=1), 7.0),  # exactly on the edge counts
        (3, A, T - timedelta(minutes=5), None),  # counts as a row only
        (4, A, T, 3.0),
        (5, B, T - timedelta(days=1), 5.1),
        (6, B, T - timedelta(hours=2), -5.1),
        (7, B, T, 9.0),  # average 0: no ratio
        (8, None, T, 9.0),
        (9, None, T + timedelta(minutes=1), 9.0),  # NULL users never meet
        (10, "c", T, None),
        (11, "c", T + timedelta(minutes=1), 4.0),
    ]
    got = by_id(rolling_features(frame(spark, data), strategy=strategy))
    want = brute(data)
    assert got.keys() == want.keys()
    assert all(same(got[k], want[k]) for k in want)
    assert got[4][0] == 2 and got[7][2:] == (None, None) and got[9] == (0, 0.0, None, None)
    assert got[11][:2] == (1, 0.0)


def random_history(n=1200, seed=3):
    """A third of the rows in one entity, many ties, some missing users and amounts."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        user = "hot" if i % 3 == 0 else rng.choice([None, "u1", "u2", "u3", "u4"])
        at = T + timedelta(hours=rng.randint(0, 24 * 120), minutes=30 * rng.randint(0, 1))
        data.append((i, user, at, None if rng.random() < 0.05 else round(rng.uniform(-20, 500), 2)))
    return data


@pytest.mark.parametrize(
    "options",
    [
        {"strategy": "sweep"},
        {"strategy": "chunked"},
        {"strategy": "chunked", "one_task_rows": 100},
        {"strategy": "auto"},
    ],
)
def test_random_history_equals_definition(spark, options):
    data = random_history()
    got, want = by_id(rolling_features(frame(spark, data), **options)), brute(data)
    assert got.keys() == want.keys()
    assert [k for k in want if not same(got[k], want[k])] == []


def test_hot_entity_is_split_off(spark):
    data = random_history()
    df = frame(spark, data)
    hot, rows = hot_entities(df, "derived_user_id", 300)
    assert [r[0] for r in hot.collect()] == ["hot"] and rows == sum(u == "hot" for _, u, _, _ in data)
    got = by_id(rolling_features(df, hot_rows=300, one_task_rows=200))
    want = brute(data)
    assert [k for k in want if not same(got[k], want[k])] == []


def test_entities_of_a_small_history_are_not_grouped(spark, monkeypatch):
    monkeypatch.setattr(joins, "materialize", None)  # what would store the grouped entities
    df = frame(spark, random_history())
    assert rolling._entity_sizes(df, "derived_user_id", df.count()) == (None, 0, df.count())


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_copies_of_a_row_do_not_see_each_other(spark, strategy):
    data = [(1, A, T, 5.0)] * 3 + [(2, A, T + timedelta(minutes=1), 8.0)]
    got = sorted(tuple(r) for r in rolling_features(frame(spark, data), strategy=strategy).select(*NAMES[:2]).collect())
    assert got == [(0, 0.0)] * 3 + [(3, 15.0)]


@pytest.mark.parametrize("strategy", ["sweep", "chunked"])
def test_amounts_with_many_digits(spark, strategy):
    data = [(i, u, at, None if v is None else round(v / 7, 8)) for i, u, at, v in random_history(400)]
    df = frame(spark, data)
    got, want = by_id(rolling_features(df, strategy=strategy)), brute(data)
    assert [k for k in want if not same(got[k], want[k])] == []


@pytest.mark.parametrize("one_task_rows", [500_000, 40])
def test_many_copies_of_a_hot_row(spark, one_task_rows):
    """A third of the rows are copies of one row; none of them sees another."""
    data = random_history(400) + [(77_777, "hot", T + timedelta(days=30), 2.5)] * 200
    df = frame(spark, data)
    got = rolling_features(df, strategy="chunked", one_task_rows=one_task_rows)
    assert got.count() == 600
    copies = got.filter("transaction_id = 77777").select(*NAMES).distinct().collect()
    assert len(copies) == 1 and same(tuple(copies[0]), brute(data)[77_777])


def test_custom_specs(spark):
    specs = [
        RollingSpec("n", "count", timedelta(hours=6)),
        RollingSpec("mean", "avg", timedelta(days=3)),
        RollingSpec("total", "sum", timedelta(days=3)),
    ]
    data = random_history(300)
    got = {r["transaction_id"]: (r["n"], r["mean"], r["total"]) for r in rolling_features(frame(spark, data), specs).collect()}
    want = brute(data, specs)
    assert [k for k in want if not same(got[k], want[k])] == []


def test_bad_specs():
    with pytest.raises(ValueError):
        RollingSpec("x", "median", timedelta(hours=1))
    with pytest.raises(ValueError):
        RollingSpec("x", "sum", timedelta(0))


def test_bulk_equals_point(history):
    bulk = by_id(rolling_features(history))
    for r in history.collect():
        one = point_features(
            history,
            entity=r["derived_user_id"],
            at=r["transaction_at"],
            amount=r["transaction_amt"],
            transaction_id=r["transaction_id"],
        ).collect()
        assert len(one) == 1 and same(tuple(one[0]), bulk[r["transaction_id"]])


def test_point_without_history_or_user(history):
    for entity in (B, None):
        row = point_features(history, entity=entity, at=T, amount=50.0, transaction_id=100).first()
        assert tuple(row) == (0, 0.0, None, None)


def test_prior_rows_without_id_are_strictly_earlier(history):
    got = prior_rows(history, entity=A, at=T, width=timedelta(hours=1))
    assert sorted(r["transaction_id"] for r in got.collect()) == [2, 3]


def test_limit_is_chronological_and_exact(history):
    out = behavioral_features(history, limit=2)
    assert [r["transaction_id"] for r in out.collect()] == [1, 2]
    full = by_id(rolling_features(history))
    assert by_id(out) == {k: full[k] for k in (1, 2)}
    assert behavioral_features(history, limit=-1).count() == 5
    assert out.columns == ["transaction_id", "is_fraud", *NAMES]


def test_ids_follow_the_caller(history):
    got = [r["transaction_id"] for r in behavioral_features(history, transaction_ids=[4, 1, 99, 2, 4]).collect()]
    assert got == [4, 1, 2, 4]
    none = behavioral_features(history, transaction_ids=[])
    assert none.columns == ["transaction_id", "is_fraud", *NAMES] and none.count() == 0


def test_types(history):
    kinds = dict(rolling_features(history).dtypes)
    assert [kinds[n] for n in NAMES] == ["int", "double", "double", "double"]


@pytest.mark.parametrize("options", [{}, {"hot_rows": 200, "one_task_rows": 150}])
def test_requests_equal_definition(spark, options):
    data = random_history(900, seed=5)
    rng = random.Random(8)
    asked = [
        (1000 + i, rng.choice(["hot", "u1", "u2", None, "new"]), T + timedelta(hours=rng.randint(0, 3000)), 25.0)
        for i in range(120)
    ]
    got = by_id(score_requests(frame(spark, asked), frame(spark, data), **options))
    want = brute(data, requests=asked)
    assert got.keys() == want.keys()
    assert [k for k in want if not same(got[k], want[k])] == []


def test_requests_without_id(spark, history):
    asked = frame(spark, [(4, A, T, 2000.0)]).drop("transaction_id").withColumn("name", F.lit("x"))
    row = score_requests(asked, history).first()
    assert (row["name"], row["velocity_1h"], row["cumulative_spend_24h"]) == ("x", 2, 50.0)


def test_empty_inputs(spark, history):
    empty = history.filter("false")
    assert rolling_features(empty).count() == 0
    assert score_requests(empty, history).count() == 0
    assert by_id(score_requests(history, empty))[4][:2] == (0, 0.0)


def test_one_exchange_per_sweep(history):
    plan = rolling_features(history, strategy="sweep")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Scan") == 1
    assert "Python" not in plan


ODD = [float("inf"), float("-inf"), float("nan"), 3e20, 1e-19, None, *[0.1] * 12, 5.0]


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("hot_rows", [1_000_000, 5])
def test_odd_amounts_and_null_ids_have_one_answer(spark, strategy, hot_rows):
    """Amounts that are not finite or too large are NULL; rows without an id are seen from later times only."""
    data = [(None if k % 4 == 3 else k, A, T + timedelta(seconds=k // 3), v) for k, v in enumerate(ODD)]
    data += [(None, A, T, 7.0), (None, None, T, 1.0), (90, A, None, 1.0), (91, B, T, 0.1)]
    df = frame(spark, data).withColumn("row", F.monotonically_increasing_id())
    features = rolling_features(df, strategy=strategy, hot_rows=hot_rows, one_task_rows=20).collect()
    assert len(features) == len(data)
    for r in features:
        if r.derived_user_id is None or r.transaction_at is None:
            assert tuple(r[n] for n in NAMES) == (0, 0.0, None, None)
            continue
        one = point_features(
            df, entity=r.derived_user_id, at=r.transaction_at.replace(tzinfo=timezone.utc), amount=r.transaction_amt,
            transaction_id=r.transaction_id,
        ).first()
        assert tuple(r[n] for n in NAMES) == tuple(one[n] for n in NAMES)
        amounts = [
            v if v is not None and abs(v) < 1e18 else None
            for i, u, at, v in data
            if u == r.derived_user_id and at is not None
            and (at < r.transaction_at.replace(tzinfo=timezone.utc)
                 or (at == r.transaction_at.replace(tzinfo=timezone.utc) and i is not None and r.transaction_id is not None and i < r.transaction_id))
        ]
        assert r.velocity_1h == len(amounts)
        assert r.cumulative_spend_24h == pytest.approx(sum(v for v in amounts if v is not None), abs=1e-8)


def _most_rows_in_a_task(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]


def many_entities(n=1200):
    rng = random.Random(8)
    return [(i, f"u{rng.randrange(200)}", T + timedelta(minutes=rng.randrange(5_000)), rng.choice([None, 1.5, 7.0])) for i in range(n)]


@pytest.mark.parametrize("strategy", ["auto", "sweep"])
def test_a_larger_table_is_swept_in_more_tasks(spark, monkeypatch, strategy):
    monkeypatch.setattr(rolling, "SWEEP_ROWS", 50)
    data = many_entities()
    out = rolling_features(frame(spark, data), strategy=strategy)
    got, want = by_id(out), brute(data)
    assert got.keys() == want.keys() and all(same(got[k], want[k]) for k in want)
    assert _most_rows_in_a_task(out) <= 150  # a quarter of all, 300, when dealt by Spark's default


def test_hot_entities_are_joined_in_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(rolling, "SWEEP_ROWS", 50)
    monkeypatch.setattr(ordered, "CHUNK_ROWS", 100)
    data = [(i if i % 7 else None, "hot" if i % 2 else u, at, amt) for i, u, at, amt in many_entities()]
    numbered = frame(spark, data).withColumn("row", F.monotonically_increasing_id())
    out = rolling_features(numbered, hot_rows=300, one_task_rows=100)
    plain = rolling_features(numbered, strategy="sweep")
    got, want = by_id(out, "row"), by_id(plain, "row")
    assert len(got) == len(data) and all(same(got[k], want[k]) for k in want)
    assert _most_rows_in_a_task(out) <= 150


@pytest.mark.parametrize("ids", [True, False])
def test_more_requests_are_scored_in_more_tasks(spark, monkeypatch, ids):
    monkeypatch.setattr(rolling, "SWEEP_ROWS", 100)
    data = many_entities()
    later = [(i, u, at + timedelta(minutes=30), amt) for i, u, at, amt in data]
    requests = frame(spark, later).withColumn("request_id", F.col("transaction_id"))
    requests = requests if ids else requests.drop("transaction_id")
    out = score_requests(requests, frame(spark, data))
    asked = later if ids else [(None, *r[1:]) for r in later]
    got = by_id(out, "request_id")
    want = {i: brute(data, requests=[r])[r[0]] for i, r in enumerate(asked)}
    assert got.keys() == want.keys() and all(same(got[k], want[k]) for k in want)
    assert _most_rows_in_a_task(out) <= 150
