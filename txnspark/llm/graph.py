"""Connected components by alternating large-star and small-star steps.

Every step is a join and an aggregate keyed by node.  The aggregate is combined
before the shuffle and the join can be split by skew handling, so a node that is
linked to a third of all others is not one task's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark.scratch import materialize

from .store import few, stored


def _least(df: DataFrame) -> DataFrame:
    return df.groupBy("u").agg(F.min("v").alias("m"))


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def _settled(edges: DataFrame, rows: int) -> bool:
    """Whether every node but the roots has one edge, to a root."""
    ends = edges.selectExpr("u AS x", "1 AS a", "0 AS b").union(edges.selectExpr("v AS x", "0 AS a", "1 AS b"))
    ends = few(ends.groupBy("x").agg(F.sum("a").alias("a"), F.max("b").alias("b")), rows)
    return not ends.agg(F.expr("count_if(a > 1 OR (a > 0 AND b > 0))")).first()[0]


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(id, component) for every id with an edge to another; component is the least id reachable.

    ``edges`` are pairs of non-null longs in any direction; loops and repeats are
    ignored.  An empty input gives an empty result.
    """
    now, rows = materialize(edges.select(*_pair(F.col(left), F.col(right))).filter("u <> v").distinct(), "edges")
    while not _settled(now, rows):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").filter("v > u").select(*_pair(F.col("v"), F.least("m", "u")))
        large, rows = materialize(few(few(large.filter("u <> v"), rows).distinct(), rows), "edges")
        least = _least(large)
        small = large.join(least, "u").filter("v <> m").select(*_pair(F.col("v"), F.col("m")))
        small = few(small.union(least.select("u", F.col("m").alias("v"))).filter("u <> v"), rows)
        now, rows = materialize(few(small.distinct(), rows), "edges")
    out = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = few(now.select("v").distinct(), rows).select(F.col("v").alias("id"), F.col("v").alias("component"))
    return stored(out.union(roots), "components")
