"""Lookups by key and numbers of copies that hold up when one key owns much of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark.scratch import broadcast_if_small

from .store import stored

#: Keys that are dealt with apart, at most; and rows that a key may always have in one task.
HOT_KEYS, COLD_ROWS = 100_000, 64


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """Left join of ``left``, a stored table of ``rows`` rows, with ``right``, which has one row per key.

    Keys of ``left`` with more than their share of rows are at most ``HOT_KEYS``; their rows of
    ``right`` are sent to the rows, not the rows to one task.  Keys are not null.
    """
    keys, limit = list(keys), max(COLD_ROWS, -(-rows // HOT_KEYS))
    hot = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).select(*keys)
    hot = stored(hot.join(right, keys, "left"), "hot")
    if hot.isEmpty():
        return left.join(right, keys, "left")
    hot_rows = left.join(broadcast_if_small(hot), keys)
    cold = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return cold.join(right, keys, "left").unionByName(hot_rows)


def repeated_names(records: DataFrame, name: str) -> DataFrame:
    """Stored values of column ``name`` that more than one row has."""
    return stored(records.groupBy(name).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(name), "repeated")


def number_copies(copies: DataFrame, name: str, number: str) -> DataFrame:
    """``copies`` with the number, from 0, of each row among those of its name.

    ``copies`` is a stored table with ``_row``, a number that grows within each part it was written in.
    Copies are counted by part first, so that no task gets all rows of a name.
    """
    copies = copies.withColumn("_part", F.shiftright("_row", 33))
    before = copies.groupBy(name, "_part").agg(F.count(F.lit(1)).alias("_n")).selectExpr(
        name,
        "_part",
        f"coalesce(sum(_n) OVER (PARTITION BY {name} ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before",
    )
    inside = copies.selectExpr("*", f"row_number() OVER (PARTITION BY {name}, _part ORDER BY _row) - 1 AS _in")
    out = inside.join(before, [name, "_part"]).withColumn(number, F.col("_before") + F.col("_in"))
    return out.drop("_before", "_in", "_part", "_row")
