"""Stored intermediate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from txnspark.scratch import materialize

#: Narrow rows that one task may well work through, and tasks that are always allowed.
TASK_ROWS, TASKS = 250_000, 8


def stored(df: DataFrame, label: str = "tmp") -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    return materialize(df, label)[0]


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of about ``rows`` narrow rows in as many tasks as these need, without a shuffle."""
    return df.coalesce(max(TASKS, -(-rows // TASK_ROWS)))
