"""Comparison of two frames: distribution shift, category shares, missingness."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnspark.functions.columns import is_missing
from txnspark.operators.ordered import ONE_TASK_ROWS, running_totals
from txnspark.operators.profile import missing_by_group, value_counts

_TERMS = 100
# Values of a side up to which the p-value is exact: the driver walks sides squared steps.
EXACT_ROWS = 1_000


def kolmogorov_tail(x: float) -> float:
    """P(K > x) of the limiting distribution: 2 * sum (-1)^(k-1) exp(-2 k^2 x^2)."""
    if x < 0.2:  # the series has not converged, and the tail is 1 to six digits
        return 1.0
    total = 2 * sum((1 if k % 2 else -1) * math.exp(-2 * k * k * x * x) for k in range(1, _TERMS + 1))
    return min(1.0, max(0.0, total))


def exact_tail(left: int, right: int, gap: int) -> float:
    """P(a gap of at least ``gap`` / (left * right)) between the samples if all orders of their values are alike.

    An order is a path through a lattice of ``left`` by ``right`` steps.  The probability of the paths that
    have kept below the gap goes from one diagonal of the lattice to the next; what leaves there is added up,
    so that small tails lose no digits.
    """
    if gap <= 0:
        return 1.0
    at = np.arange(left + 1, dtype=np.int64)
    inside, gone = np.zeros(left + 1), 0.0
    inside[0] = 1.0
    for step in range(1, left + right + 1):
        rest = left + right - step + 1
        other = step - at
        now = inside * np.clip(right - other + 1, 0, None) / rest
        now[1:] += inside[:-1] * (left - at[1:] + 1) / rest
        now[(other < 0) | (other > right)] = 0.0
        out = np.abs(at * right - other * left) >= gap
        gone += now[out].sum()
        now[out] = 0.0
        inside = now
    return min(1.0, float(gone))


def ks_two_sample(
    left: DataFrame,
    right: DataFrame,
    column: str,
    *,
    exact_rows: int = EXACT_ROWS,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic and its p-value, one row.

    The p-value is exact while neither side has more than ``exact_rows`` values, as if these were
    all different, and asymptotic above.  Only the largest gap and the sizes reach the driver.

    Numbers compare as doubles with missing values left out; text compares as text
    with a missing value as the level ``nan``.  Both sides are counted per value
    first; the cumulative counts then go over range-partitioned chunks.
    """
    text = isinstance(left.schema[column].dataType, T.StringType)

    def side(df: DataFrame, a: int) -> DataFrame:
        if text:
            value = F.coalesce(F.col(column), F.lit("nan"))
            rows = df.select(value.alias("_v"))
        else:
            rows = df.filter(~is_missing(df, column)).select(F.col(column).cast("double").alias("_v"))
        return rows.withColumns({"_a": F.lit(a), "_b": F.lit(1 - a)})

    counted = (
        side(left, 1).unionByName(side(right, 0)).groupBy("_v").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    )
    placed = running_totals(
        counted,
        order=["_v"],
        sums={"_ca": "_a", "_cb": "_b"},
        totals={"n_left": "_a", "n_right": "_b"},
        one_task_rows=one_task_rows,
    )
    # The gap as a whole number, over left * right.
    whole = {c: F.col(c).cast("decimal(19,0)") for c in ("_ca", "_cb", "n_left", "n_right")}
    gap = F.abs(whole["_ca"] * whole["n_right"] - whole["_cb"] * whole["n_left"])
    one = placed.agg(F.max(gap).alias("gap"), F.max("n_left").alias("m"), F.max("n_right").alias("n")).first()
    statistic = p_value = None
    m, n = one["m"], one["n"]
    if m and n:
        most = int(one["gap"])
        statistic = most / (m * n)
        if max(m, n) <= exact_rows:
            p_value = exact_tail(m, n, most)
        else:
            p_value = kolmogorov_tail(math.sqrt(m * n / (m + n)) * statistic)
    row = (column, statistic, p_value, m, n)
    return left.sparkSession.createDataFrame([row], "column string, statistic double, p_value double, n_left long, n_right long")


def share_comparison(left: DataFrame, right: DataFrame, column: str, *, top_n: int = 6) -> DataFrame:
    """Share of each of the left side's most frequent levels on both sides; absent means 0."""
    mine = value_counts(left, column, top_n=top_n, drop_missing=True).select("value", F.col("share").alias("left_share"))
    other = value_counts(right, column, top_n=None, drop_missing=True).select("value", F.col("share").alias("right_share"))
    # At most top_n levels are broadcast to pick their counts on the other side.
    theirs = other.join(F.broadcast(mine.select("value")), "value")
    return mine.join(theirs, "value", "left").select(
        "value", "left_share", F.coalesce("right_share", F.lit(0.0)).alias("right_share")
    )


def missing_drift(left: DataFrame, right: DataFrame) -> DataFrame:
    """Missing percent per column group on both sides, largest absolute change first."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return missing_by_group(df).select(
            "group", F.col("n_columns").alias(f"n_columns_{name}"), F.col("avg_pct_missing").alias(f"pct_{name}")
        )

    both = side(left, "left").join(side(right, "right"), "group")
    both = both.withColumn("missing_diff", F.col("pct_right") - F.col("pct_left"))
    return both.orderBy(F.desc(F.abs("missing_diff")), "group")
