"""Co-moments of many pairs of columns in one scan.

For every pair the rows on which both columns have a value are counted, with the means, the sums of
squared deviations and the sum of products of deviations on just these rows.  A task adds up
batches by matrix products and keeps one set of matrices, whatever the number of rows; the sets
of all tasks are then put together by sums, first of the means and then of the deviations around
them, so no pair's parts are gathered in one place.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark.scratch import materialize

# Bytes of the matrices that a task may keep; more pairs take another scan.
MATRIX_BYTES = 256 << 20
# Sets of matrices that each core of the cluster sends on.
SETS_PER_CORE = 4
_FIELDS = ("n", "base_x", "base_y", "mean_x", "mean_y", "sq_x", "sq_y", "prod", "lo_x", "hi_x", "lo_y", "hi_y")


def _one_value(values: np.ndarray, held: np.ndarray, other: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends that bound each column where the other has a value: equal if it has one value there, else open."""
    at = held.argmax(axis=0)
    first = np.where(held.any(axis=0), values[at, np.arange(values.shape[1])], 0.0)
    strange = (held & (values != first)).astype(np.float64).T @ other
    lo = np.where(counts == 0, np.inf, np.where(strange == 0, first[:, None], -np.inf))
    hi = np.where(counts == 0, -np.inf, np.where(strange == 0, first[:, None], np.inf))
    # None of these rows has the column's first value: they may still share another one.
    for i, j in zip(*np.nonzero((strange == counts) & (counts > 0))):
        own = values[held[:, i] & (other[:, j] > 0), i]
        lo[i, j], hi[i, j] = own.min(), own.max()
    return lo, hi


def _mean(values: np.ndarray) -> np.ndarray:
    held = ~np.isnan(values)
    return np.where(held, values, 0.0).sum(axis=0) / np.maximum(held.sum(axis=0), 1)


def _of_batch(x: np.ndarray, y: np.ndarray, base_x: np.ndarray, base_y: np.ndarray) -> dict[str, np.ndarray]:
    """Moments of the columns of x by those of y over some rows; NaN is no value, and means are told from the bases."""
    has_x, has_y = ~np.isnan(x), ~np.isnan(y)
    mask_x, mask_y = has_x.astype(np.float64), has_y.astype(np.float64)

    def centred(values, held):
        mean = _mean(values)
        return mean, np.where(held, values - mean, 0.0)

    (mean_x, dx), (mean_y, dy) = centred(x - base_x, has_x), centred(y - base_y, has_y)
    n = mask_x.T @ mask_y
    rows = np.maximum(n, 1)
    sum_x, sum_y = dx.T @ mask_y, mask_x.T @ dy
    out = {"n": n, "base_x": np.broadcast_to(base_x[:, None], n.shape), "base_y": np.broadcast_to(base_y, n.shape)}
    out |= {"mean_x": mean_x[:, None] + sum_x / rows, "mean_y": mean_y[None, :] + sum_y / rows}
    out["sq_x"] = np.maximum((dx * dx).T @ mask_y - sum_x * sum_x / rows, 0)
    out["sq_y"] = np.maximum(mask_x.T @ (dy * dy) - sum_y * sum_y / rows, 0)
    out["prod"] = dx.T @ dy - sum_x * sum_y / rows
    out["lo_x"], out["hi_x"] = _one_value(x, has_x, mask_y, n)
    lo, hi = _one_value(y, has_y, mask_x, n.T)
    out["lo_y"], out["hi_y"] = lo.T, hi.T
    return out


def _merged(a: dict[str, np.ndarray] | None, b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    if a is None:
        return b
    n = a["n"] + b["n"]
    rows = np.maximum(n, 1)
    dx, dy = b["mean_x"] - a["mean_x"], b["mean_y"] - a["mean_y"]
    both = a["n"] * b["n"] / rows
    out = {"n": n, "base_x": a["base_x"], "base_y": a["base_y"]}
    for side, d in (("x", dx), ("y", dy)):
        mean = np.where(a["n"] == 0, b[f"mean_{side}"], a[f"mean_{side}"] + d * b["n"] / rows)
        out[f"mean_{side}"] = mean
        out[f"sq_{side}"] = a[f"sq_{side}"] + b[f"sq_{side}"] + d * d * both
        out[f"lo_{side}"] = np.minimum(a[f"lo_{side}"], b[f"lo_{side}"])
        out[f"hi_{side}"] = np.maximum(a[f"hi_{side}"], b[f"hi_{side}"])
    out["prod"] = a["prod"] + b["prod"] + dx * dy * both
    return out


def _task(left: Sequence[int], right: Sequence[int]):
    def run(batches) -> Iterator[pa.RecordBatch]:
        total, bases = None, None
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            table = np.column_stack(columns).astype(np.float64)
            table[np.isinf(table)] = np.nan
            x, y = table[:, list(left)], table[:, list(right)]
            bases = bases or (_mean(x), _mean(y))
            total = _merged(total, _of_batch(x, y, *bases))
        if total is None:
            return
        for i in range(len(left)):
            at = np.flatnonzero(total["n"][i] > 0)
            yield pa.record_batch(
                [pa.array(np.full(len(at), i, dtype=np.int32)), pa.array(at.astype(np.int32)), *[pa.array(total[f][i, at]) for f in _FIELDS]],
                names=["i", "j", *_FIELDS],
            )

    return run


def _blocks(left: int, right: int, limit: int) -> Iterator[tuple[range, range]]:
    """Ranges of columns whose matrices fit the limit."""
    cells = max(1, limit // (8 * 2 * len(_FIELDS)))
    wide = min(right, max(1, int(cells**0.5))) if left * right > cells else right
    tall = max(1, cells // wide)
    for a in range(0, left, tall):
        for b in range(0, right, wide):
            yield range(a, min(a + tall, left)), range(b, min(b + wide, right))


def co_moments(
    df: DataFrame, left: Sequence[Column], right: Sequence[Column], *, matrix_bytes: int = MATRIX_BYTES
) -> DataFrame:
    """(i, j, n, sq_x, sq_y, prod, varies) for each of the ``left`` with each of the ``right`` columns by number.

    Only pairs with common rows are listed.  NULL, NaN and infinite values are missing.
    ``varies`` is whether both sides have two values on the common rows, which is exact.
    """
    numbers = df.select(
        *[c.cast("double").alias(f"x{k}") for k, c in enumerate(left)], *[c.cast("double").alias(f"y{k}") for k, c in enumerate(right)]
    )
    blocks = list(_blocks(len(left), len(right), matrix_bytes))
    if len(blocks) > 1:
        numbers, _ = materialize(numbers, "numbers")
    schema = "i int, j int, " + ", ".join(f"{f} double" for f in _FIELDS)
    sets = None
    for own, other in blocks:
        names = [*[f"x{k}" for k in own], *[f"y{k}" for k in other]]
        tasks = SETS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
        part = numbers.select(*names).coalesce(tasks)
        part = part.mapInArrow(_task(range(len(own)), range(len(own), len(names))), schema)
        part = part.withColumns({"i": F.col("i") + own.start, "j": F.col("j") + other.start})
        sets = part if sets is None else sets.unionByName(part)
    sets, _ = materialize(sets, "moments")
    # Means are told from the least base of a pair: what is far from zero does not lose its last digits.
    least = sets.groupBy("i", "j").agg(*[F.min(f"base_{s}").alias(f"from_{s}") for s in "xy"])
    near = {f"mean_{s}": F.col(f"base_{s}") - F.col(f"from_{s}") + F.col(f"mean_{s}") for s in "xy"}
    sets, _ = materialize(sets.join(least, ["i", "j"]).withColumns(near), "moments")
    whole = sets.groupBy("i", "j").agg(
        *[(F.sum(F.col("n") * F.col(f"mean_{s}")) / F.sum("n")).alias(f"all_{s}") for s in "xy"],
        *[F.min(f"lo_{s}").alias(f"least_{s}") for s in "xy"],
        *[F.max(f"hi_{s}").alias(f"most_{s}") for s in "xy"],
    )
    off = {s: F.col(f"mean_{s}") - F.col(f"all_{s}") for s in "xy"}
    varies = (F.col("least_x") < F.col("most_x")) & (F.col("least_y") < F.col("most_y"))
    return (
        sets.join(whole, ["i", "j"])
        .groupBy("i", "j")
        .agg(
            F.sum("n").cast("long").alias("n"),
            *[F.sum(F.col(f"sq_{s}") + F.col("n") * off[s] * off[s]).alias(f"sq_{s}") for s in "xy"],
            F.sum(F.col("prod") + F.col("n") * off["x"] * off["y"]).alias("prod"),
            F.bool_or(varies).alias("varies"),
        )
    )
