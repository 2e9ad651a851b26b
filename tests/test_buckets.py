"""Upserts that touch only their buckets, the MERGE statement, and replacing tables without a gap."""

from __future__ import annotations

import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from txnspark.sources import buckets as B
from txnspark.sources import tables

SCHEMA = "k long, a string, b double"


@pytest.fixture
def name(spark):
    table = f"bucketed_{uuid.uuid4().hex}"
    yield table
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def places(spark, table):
    out = {}
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        bucket = row["partition"].partition("=")[2]
        told = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (_bucket = '{bucket}')")
        out[bucket] = told.filter("col_name = 'Location'").first()["data_type"]
    return out


def merged(target, batch, listed=("k", "a", "b")):
    new = {r[0]: r for r in batch if r[0] is not None}
    out = []
    for k, a, b in target:
        if k in new:
            a, b = (new[k][1] if "a" in listed else a), (new[k][2] if "b" in listed else b)
        out.append((k, a, b))
    held = {r[0] for r in target}
    out += [(k, a if "a" in listed else None, b if "b" in listed else None) for k, a, b in batch if k is None or k not in held]
    return sorted(out, key=str)


@pytest.mark.parametrize("rule", [{"width": 10}, {"number": 7}])
def test_upserts_against_a_plain_merge(spark, name, rule):
    rng = random.Random(3)
    target = [(k, "x", k / 2) for k in range(-30, 70)] + [(None, "n", 0.0), (5, "twice", 1.0)]
    B.create_bucketed(spark.createDataFrame(target, SCHEMA), name, B.Buckets("k", **rule))
    for listed in (None, ["k", "b"], None):
        keys = rng.sample(range(-60, 100), 12)
        batch = [(k, rng.choice(["y", None]), rng.choice([None, 9.5])) for k in keys] + [(None, "m", 2.0)]
        assert B.upsert_bucketed(spark.createDataFrame(batch, SCHEMA), name, listed) == 13
        target = merged(target, batch, listed or ("k", "a", "b"))
        assert sorted(map(tuple, B.read_bucketed(spark, name).collect()), key=str) == target
    assert B.upsert_bucketed(spark.createDataFrame([], SCHEMA), name) == 0
    with pytest.raises(ValueError, match="duplicate"):
        B.upsert_bucketed(spark.createDataFrame([(1, "a", 0.0)] * 2, SCHEMA), name)
    assert sorted(map(tuple, B.read_bucketed(spark, name).collect()), key=str) == target


def test_other_buckets_are_neither_read_nor_written(spark, name):
    rows = spark.range(1_000).selectExpr("id AS k", "'x' AS a", "id / 2 AS b")
    B.create_bucketed(rows, name, B.Buckets("k", width=100))
    before = places(spark, name)
    batch = spark.createDataFrame([(205, "new", 0.0), (299, "new", 0.0), (1_005, "new", 0.0)], SCHEMA)
    plan, touched = B.merged_buckets(batch, name)
    assert touched == ["10", "2"]
    text = plan._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert scans and all("_bucket" in re.search(r"PartitionFilters: \[(.*?)\]", s).group(1) for s in scans)
    # What is shuffled below the merge are keys that the batch shares with the table, never the table's rows.
    target = spark.table(name).filter("_bucket = '2'").drop(B.BUCKET)
    assert "Exchange hashpartitioning" not in B.upsert(target, batch, "k")._jdf.queryExecution().sparkPlan().toString()
    assert B.upsert_bucketed(batch, name) == 3
    after = places(spark, name)
    assert {b for b in after if before.get(b) != after[b]} == {"2", "10"}
    got = {r["k"]: r["a"] for r in B.read_bucketed(spark, name).collect()}
    assert len(got) == 1_001 and [k for k, a in got.items() if a == "new"].__len__() == 3


def test_a_death_between_buckets(spark, name, monkeypatch):
    """Every bucket is whole, old or new, and doing the upsert again completes it."""
    B.create_bucketed(spark.range(100).selectExpr("id AS k", "'old' AS a", "0D AS b"), name, B.Buckets("k", width=10))
    batch = spark.createDataFrame([(k, "new", 1.0) for k in range(100, 0, -3)], SCHEMA)
    real, calls = B._point, []

    def dies(*args):
        if len(calls) == 4:
            raise RuntimeError("lost")
        calls.append(args)
        return real(*args)

    monkeypatch.setattr(B, "_point", dies)
    with pytest.raises(RuntimeError):
        B.upsert_bucketed(batch, name)
    spark.catalog.refreshTable(name)
    seen = {}
    for r in B.read_bucketed(spark, name).collect():
        if r["k"] % 3 == 1:
            seen.setdefault(r["k"] // 10, set()).add(r["a"])
    assert all(len(v) == 1 for v in seen.values()) and {"old", "new"} == set().union(*seen.values())
    monkeypatch.setattr(B, "_point", real)
    B.upsert_bucketed(batch, name)
    got = {r["k"]: r["a"] for r in B.read_bucketed(spark, name).collect()}
    assert got == {k: "new" if k % 3 == 1 else "old" for k in range(101)}
    assert B.drop_unused(spark, name) > 0 and B.drop_unused(spark, name) == 0
    assert {r["k"]: r["a"] for r in B.read_bucketed(spark, name).collect()} == got


def test_rules(spark, name):
    for wrong in ({}, {"number": 2, "width": 3}, {"width": 0}):
        with pytest.raises(ValueError):
            B.Buckets("k", **wrong)
    spark.range(1).write.saveAsTable(name)
    with pytest.raises(ValueError, match="buckets"):
        B.bucket_rule(spark, name)


def test_merge_statement_parses_to_a_merge(spark):
    parser = spark._jsparkSession.sessionState().sqlParser()
    plan = parser.parsePlan(tables.merge_statement("cat.db.t", "batch", "id", ["id", "x", "odd`name"], evolve=True))
    assert plan.nodeName() == "MergeIntoTable"
    assert plan.withSchemaEvolution() and "'t.id = 's.id" in plan.mergeCondition().toString()
    matched, added = plan.matchedActions(), plan.notMatchedActions()
    assert matched.size() == added.size() == 1
    update = [(a.key().toString(), a.value().toString()) for a in (matched.head().assignments().apply(k) for k in range(2))]
    assert update == [("'t.x", "'s.x"), ("'t.odd`name", "'s.odd`name")]
    insert = [a.value().toString() for a in (added.head().assignments().apply(k) for k in range(3))]
    assert insert == ["'s.id", "'s.x", "'s.odd`name"]
    only = parser.parsePlan(tables.merge_statement("t", "batch", "id", ["id"]))
    assert only.matchedActions().isEmpty() and not only.withSchemaEvolution()


def test_upsert_table_merges_where_the_format_can(spark, lake, monkeypatch):
    seen = []
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {lake.schema('bronze')}")
    table = lake.table("bronze", "rows")
    spark.range(3).selectExpr("id AS k", "'x' AS a").write.saveAsTable(table)
    details = {**tables.table_details(spark, table), "Provider": "delta"}
    monkeypatch.setattr(tables, "table_details", lambda s, t: details)
    real = type(spark).sql

    def sql(self, text, *args, **kwargs):
        if text.startswith("MERGE"):
            view = re.search(r"USING `(\w+)`", text).group(1)
            seen.append((text, self.table(view).count()))
            return None
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", sql)
    batch = spark.range(2).selectExpr("id AS k", "'y' AS a")
    assert tables.upsert_table(batch, table, "k") == 2
    assert [n for _, n in seen] == [2] and f"INTO {table} AS t" in seen[0][0]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("upsert_")]


def test_replacing_columns_leaves_no_gap(spark, lake, monkeypatch):
    """A job that dies while the new table is written, or before it takes the name, loses nothing."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {lake.schema('bronze')}")
    table = lake.table("bronze", "rows")
    spark.range(5).selectExpr("id AS k", "'x' AS a").write.saveAsTable(table)
    wrong = spark.table(table).select(F.raise_error(F.lit("lost")).cast("string").alias("only"))
    with pytest.raises(Exception, match="lost"):
        tables.overwrite_table(wrong, table)
    assert spark.table(table).columns == ["k", "a"] and spark.table(table).count() == 5
    real = type(spark).sql

    def sql(self, text, *args, **kwargs):
        if text.endswith(f"RENAME TO {tables._in_catalog(table)}"):
            raise RuntimeError("lost")
        return real(self, text, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", sql)
        with pytest.raises(RuntimeError):
            tables.overwrite_table(spark.table(table).select("a"), table)
    assert not spark.catalog.tableExists(table)
    rows = spark.range(2).selectExpr("id AS k", "'z' AS a")
    assert tables.overwrite_table(rows, table) == 2
    assert sorted(map(tuple, spark.table(table).collect())) == [(0, "z"), (1, "z")]
    assert tables.overwrite_table(spark.table(table).select("a"), table) == 2
    assert spark.table(table).columns == ["a"]
