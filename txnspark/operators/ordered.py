"""Operators that need a total order over data of any size.

``Window.orderBy`` without a partition sends a whole table through one task, and
``Window.partitionBy(k)`` does the same for a key that owns a third of the rows.
Everything here is built from two pieces that avoid both:

* :func:`running_totals` - prefix sums over range-partitioned chunks;
* :func:`keys_at_ranks` - the k-th row of an order, found with shrinking histograms.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnspark.scratch import materialize, task_count

# A frame of at most this many rows may be ordered inside one task.
ONE_TASK_ROWS = 1_000_000
# A top-n gathers whole rows, so it is used for fewer of them.
TOP_ROWS = 100_000
_BUCKETS = 4096
# Rows of a chunk of a range-partitioned frame, which a task orders.
CHUNK_ROWS = 250_000
# Half octaves on either side of 1 that doubles reach; bins of a pass, and ranges refined in one, on the driver.
_OCTAVES = 2200.0
_BINS_COLLECTED = 65_536
_RANGES = 128


def running_totals(
    df: DataFrame,
    *,
    order: Sequence[str],
    sums: Mapping[str, str],
    group: Sequence[str] = (),
    descending: Sequence[str] = (),
    inclusive: bool = True,
    totals: Mapping[str, str] | None = None,
    size: int | None = None,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Add running sums along ``order`` within ``group``, without a skewed task.

    ``sums`` maps output name to input column; ``totals`` optionally maps output
    name to input column for the sum over the whole group.  With ``inclusive``
    the current row counts, otherwise only the rows before it.  Ties in
    ``order`` are summed in no particular order, so callers make it unique.

    The input is stored once to learn its size, unless ``size`` gives it.  A small
    frame is ordered directly.  A large one is range-partitioned on (group, order), which also cuts through a hot group, and
    stored again with its chunk number; each chunk is then summed on its own and
    shifted by the sum of the chunks before it.  At most one group per chunk
    started in an earlier chunk, so the table of shifts has no more rows than
    there are chunks and is safe to broadcast.
    """
    totals = dict(totals or {})
    stored, rows = materialize(df, "ordered") if size is None else (df, size)
    place = ", ".join(f"`{c}` {'DESC' if c in descending else 'ASC'}" for c in order)
    keys = ", ".join(f"`{c}`" for c in group)
    by_group = f"PARTITION BY {keys}" if group else ""
    upto = "ROWS BETWEEN UNBOUNDED PRECEDING AND " + ("CURRENT ROW" if inclusive else "1 PRECEDING")
    if rows <= one_task_rows:
        return stored.selectExpr(
            "*",
            *[f"coalesce(sum({c}) OVER ({by_group} ORDER BY {place} {upto}), 0) AS {n}" for n, c in sums.items()],
            *[f"sum({c}) OVER ({by_group}) AS {n}" for n, c in totals.items()],
        )

    columns = [F.col(c).desc() if c in descending else F.col(c).asc() for c in order]
    chunks = task_count(df.sparkSession, rows, CHUNK_ROWS)
    chunked, _ = materialize(
        stored.repartitionByRange(
            chunks,
            *[F.col(c) for c in group],
            *columns,
        ).withColumn(
            "_chunk", F.spark_partition_id()
        ),
        "chunks",
    )
    needed = sorted({*sums.values(), *totals.values()})
    per_chunk = chunked.groupBy(*group, "_chunk").agg(*[F.sum(c).alias(f"_t_{c}") for c in needed])
    earlier = f"({by_group} ORDER BY _chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    shifts = per_chunk.selectExpr(
        *[f"`{c}` AS `_g_{c}`" for c in group],
        "_chunk AS _c",
        f"count(1) OVER {earlier} AS _before",
        *[f"sum(_t_{c}) OVER {earlier} AS _s_{n}" for n, c in sums.items()],
        *[f"sum(_t_{c}) OVER ({by_group}) AS {n}" for n, c in totals.items()],
    )
    if not totals:
        shifts = shifts.filter("_before > 0")
    if not (totals and group):  # at most one row per chunk
        shifts = F.broadcast(shifts)
    inside = f"(PARTITION BY {', '.join([*([keys] if group else []), '_chunk'])} ORDER BY {place} {upto})"
    # A chunk is a task's own: dealt by a hash, several would meet in one.
    dealt = chunked.repartitionById(chunks, F.col("_chunk"))
    local = dealt.selectExpr("*", *[f"coalesce(sum({c}) OVER {inside}, 0) AS _l_{n}" for n, c in sums.items()])
    same = " AND ".join(["_chunk = _c", *[f"`{c}` <=> `_g_{c}`" for c in group]])
    return local.join(shifts, F.expr(same), "left").selectExpr(
        *[f"`{c}`" for c in df.columns],
        *[f"_l_{n} + coalesce(_s_{n}, 0) AS {n}" for n in sums],
        *totals,
    )


def quantiles(
    df: DataFrame,
    column: str,
    probs: Sequence[float],
    *,
    group: Sequence[str] = (),
    accuracy: int | None = None,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Quantiles with linear interpolation: one row per group, columns ``q0 .. qn``.

    Exact by default, by :func:`values_at_ranks`.  ``accuracy`` switches to the one-pass
    sketch.  NULL and NaN are ignored; a frame without values has one row of NULLs if it
    is not grouped, and no rows otherwise.
    """
    group = list(group)
    value = F.col(column).cast("double")
    values = df.select(*[F.col(g) for g in group], (value + F.lit(0.0)).alias("_v"))  # -0.0 equals 0.0
    values = values.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if accuracy is not None:
        sketch = values.groupBy(*group).agg(
            F.percentile_approx("_v", [float(p) for p in probs], accuracy).alias("_q")
        )
        return sketch.select(*group, *[F.col("_q")[i].alias(f"q{i}") for i in range(len(probs))])
    values, _ = materialize(values, "values")

    def ranks(rows: int) -> set[int]:
        places = [(rows - 1) * float(p) for p in probs]
        return {end(x) for x in places for end in (math.floor, math.ceil)}

    found = values_at_ranks(values, "_v", ranks, group)
    if found is None:
        return _quantiles_by_value(values, probs, group, one_task_rows)
    rows = []
    for key, (size, at) in found.items():
        out = []
        for p in probs:
            place = (size - 1) * float(p)
            low, high = at[math.floor(place)], at[math.ceil(place)]
            out.append(low if low == high else low + (high - low) * (place - math.floor(place)))
        rows.append((*key, *out))
    if not rows and not group:
        rows = [(None,) * len(probs)]
    fields = [T.StructField(g, values.schema[g].dataType) for g in group]
    fields += [T.StructField(f"q{i}", T.DoubleType()) for i in range(len(probs))]
    return df.sparkSession.createDataFrame(rows, T.StructType(fields))


@dataclass
class _Range:
    """Values of one group between two of them, and the ranks that are still sought there."""

    key: tuple
    lo: float
    hi: float
    before: int  # rows of the group below
    ranks: set[int]


def values_at_ranks(
    values: DataFrame, name: str, ranks: Callable[[int], set[int]], group: Sequence[str] = ()
) -> dict[tuple, tuple[int, dict[int, float]]] | None:
    """Per group its number of rows and the values at ``ranks(rows)``, counted from 0; None for too many groups.

    A histogram per group is refined until every rank has a bin of one value.  The first
    pass bins by sign and half octave, so that no outlier spoils it; each further pass cuts
    the bins that hold ranks, of all groups at once, into equal parts.  Bins go by rounded
    arithmetic that never falls where its argument rises, so the result is exact.  Tasks add
    up whole bins, which is all that is shuffled: no key is a value, a frequent value is one
    count, and a large group is as many rows as it has bins.  ``values`` is read several
    times, so it should be stored; the column holds no NULLs, NaNs or negative zeros.
    """
    v, group = F.col(name), list(group)
    octave = F.least(F.coalesce(F.floor(F.log2(F.abs(v)) * 2).cast("double"), F.lit(-_OCTAVES)), F.lit(_OCTAVES))
    size = octave + 2 * _OCTAVES
    first = F.when(v < 0, -size).when(v > 0, size).otherwise(0.0)
    counted = _bins(values.select(*group, first.alias("_b"), v.alias("_x")), group)
    rows = counted.limit(_BINS_COLLECTED + 1).collect()
    if len(rows) > _BINS_COLLECTED:
        return None
    held: dict[tuple, list] = {}
    for row in rows:
        held.setdefault(tuple(row[g] for g in group), []).append(row)
    out, ranges = {}, []
    for key, own in held.items():
        n = sum(r["n"] for r in own)
        out[key] = (n, {})
        ranges += _settle(own, _Range(key, 0.0, 0.0, 0, ranks(n)), out[key][1])
    while ranges:
        if len(ranges) > _RANGES:
            return None
        parts = max(64, _BINS_COLLECTED // len(ranges))
        number = F.lit(None).cast("int")
        for k, r in reversed(list(enumerate(ranges))):
            inside = v.between(F.lit(r.lo), F.lit(r.hi))
            for g, value in zip(group, r.key):
                inside = F.col(g).eqNullSafe(F.lit(value)) & inside
            number = F.when(inside, k).otherwise(number)
        lows, highs = (F.array(*[F.lit(x) for x in xs]) for xs in ([r.lo for r in ranges], [r.hi for r in ranges]))
        low = F.get(lows, "_k")
        part = F.floor((F.col("_x") - low) / (F.get(highs, "_k") - low) * parts)
        cut = values.select(number.alias("_k"), v.alias("_x")).filter("_k IS NOT NULL").select("_k", part.alias("_b"), "_x")
        rows = _bins(cut, ["_k"]).collect()
        narrowed = []
        for k, r in enumerate(ranges):
            narrowed += _settle([x for x in rows if x["_k"] == k], r, out[r.key][1])
        ranges = narrowed
    return out


def _bins(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi"))


def _settle(bins: list, parent: _Range, found: dict[int, float]) -> list[_Range]:
    """The bins that still hold ranks; ranks in bins of one value are ``found``."""
    out, before = [], parent.before
    for row in sorted(bins, key=lambda r: r["_b"]):
        own = {r for r in parent.ranks if before <= r < before + row["n"]}
        if own and row["lo"] == row["hi"]:
            found.update(dict.fromkeys(own, row["lo"]))
        elif own:
            out.append(_Range(parent.key, row["lo"], row["hi"], before, own))
        before += row["n"]
    return out


def _quantiles_by_value(values: DataFrame, probs: Sequence[float], group: list[str], one_task_rows: int) -> DataFrame:
    """Quantiles of more groups than the driver can follow: equal values are counted, then summed up in order."""
    counted = values.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_totals(
        counted,
        group=group,
        order=["_v"],
        sums={"_upto": "_n"},
        totals={"_all": "_n"},
        one_task_rows=one_task_rows,
    )

    picked, out = [], []
    for i, p in enumerate(probs):
        place = f"(_all - 1) * {float(p)!r}D"
        for end in ("floor", "ceil"):
            here = f"_upto > {end}({place}) AND _upto - _n <= {end}({place})"
            picked.append(f"max(CASE WHEN {here} THEN _v END) AS _{end}{i}")
        picked.append(f"max({place} - floor({place})) AS _f{i}")
        out.append(f"if(_floor{i} = _ceil{i}, _floor{i}, _floor{i} + (_ceil{i} - _floor{i}) * _f{i}) AS q{i}")
    return ranked.groupBy(*group).agg(*[F.expr(e) for e in picked]).selectExpr(*[f"`{c}`" for c in group], *out)


@dataclass(frozen=True)
class Cut:
    """The row at some rank: its key, and how that key's copies fall around the rank."""

    key: tuple
    upto: int  # copies of the key at or before the rank
    copies: int  # all rows that carry the key

    @property
    def splits_copies(self) -> bool:
        return self.upto < self.copies


def _as_number(df: DataFrame, name: str) -> Column | None:
    """Order-preserving long of a column, or None for types without one.

    Floating numbers go by their bit pattern, with NaN last as in a sort.
    """
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.IntegralType):
        return column.cast("long")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return _double_as_number(F.coalesce(column.cast("double"), F.lit(0.0)))  # NULLs are left out by callers
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (column * F.lit(10**kind.scale).cast("decimal(19,0)")).cast("long")
    return None


def _double_as_number(x: Column) -> Column:
    """Sign and bit pattern of the magnitude, put together from exponent and fraction; NaN is last.

    Scaling by a power of two is exact, and a logarithm that is off by one place is put right
    by comparing with the powers next to it.
    """
    size = F.abs(x)
    guess = F.least(F.greatest(F.floor(F.log2(size)).cast("double"), F.lit(-1022.0)), F.lit(1024.0))
    power = F.pow(F.lit(2.0), guess)
    exponent = F.when(size / 2 >= power, guess + 1).when((size < power) & (guess > -1022), guess - 1).otherwise(guess)
    fraction = size / F.pow(F.lit(2.0), exponent)
    bits = (exponent + 1022).cast("long") * F.lit(1 << 52) + (fraction * float(1 << 52)).cast("long")
    infinite = F.lit(0x7FF << 52)
    signed = F.when(size == float("inf"), infinite).when(size > 0, bits).otherwise(F.lit(0))
    return F.when(F.isnan(x), infinite + 1).when(x < 0, -signed).otherwise(signed)


def keys_at_ranks(
    df: DataFrame,
    keys: Sequence[str],
    ranks: Sequence[int],
    *,
    size: int | None = None,
    one_task_rows: int = ONE_TASK_ROWS,
) -> list[Cut]:
    """Keys of the ``ranks``-th rows (from 1) of ``df`` ordered by ``keys``, NULLs last.

    No sort of the table: each pass counts rows in some 4096 buckets of the first
    key and keeps the bucket that holds the rank, until the bucket is small enough
    to sort or has a single value, in which case the next key decides.  Buckets are
    ranges of longs, so every pass narrows, whatever the values.  The keys are stored
    once for all passes and ranks; only bucket counts and final keys reach the driver.
    """
    part = df.select(*keys)
    size = df.count() if size is None else size
    if size <= one_task_rows:
        return _sorted_ranks(part, list(keys), ranks)
    numbers = {f"_rank_{k}": n for k in keys if (n := _as_number(part, k)) is not None}
    part, _ = materialize(part.withColumns(numbers), "keys")
    return [_search(part, list(keys), rank, size, one_task_rows) for rank in ranks]


def _sorted_ranks(part: DataFrame, keys: list[str], ranks: Sequence[int]) -> list[Cut]:
    """Keys at ranks of a frame small enough for one task."""
    place = ", ".join(f"`{c}` ASC NULLS LAST" for c in keys)
    counted = part.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hit = " OR ".join(f"({r} > _upto - _n AND {r} <= _upto)" for r in ranks)
    rows = counted.selectExpr("*", f"sum(_n) OVER (ORDER BY {place}) AS _upto").filter(hit).collect()
    cuts = []
    for rank in ranks:
        row = next(r for r in rows if r["_upto"] - r["_n"] < rank <= r["_upto"])
        cuts.append(Cut(tuple(row[c] for c in keys), rank - (row["_upto"] - row["_n"]), row["_n"]))
    return cuts


def _search(part: DataFrame, keys: list[str], rank: int, size: int, one_task_rows: int) -> Cut:
    """Key at a rank of a large frame: settle the first key, then go on with the rest."""
    if size <= one_task_rows:
        return _sorted_ranks(part, keys, [rank])[0]
    name, rest = keys[0], keys[1:]
    known = part.filter(F.col(name).isNotNull())
    n = known.count()
    if rank > n:
        part, rank, size, value = part.filter(F.col(name).isNull()), rank - n, size - n, None
    else:
        part, rank, size = _narrow(known, name, rank, n, one_task_rows)
        if size <= one_task_rows:
            return _sorted_ranks(part, keys, [rank])[0]
        value = part.select(name).first()[0]
    if not rest:
        return Cut((value,), rank, size)
    tail = _search(part, rest, rank, size, one_task_rows)
    return Cut((value, *tail.key), tail.upto, tail.copies)


def _narrow(part: DataFrame, name: str, rank: int, size: int, one_task_rows: int) -> tuple[DataFrame, int, int]:
    """The rows around a rank of one column: few rows or a single value, the rank and count in them."""
    number = F.col(f"`_rank_{name}`")
    if f"_rank_{name}" not in part.columns:
        counted = part.groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
        totals = running_totals(counted, order=[name], sums={"_upto": "_n"}, one_task_rows=one_task_rows)
        hit = totals.filter((F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < rank)).first()
        return part.filter(F.col(name) == F.lit(hit[name])), rank - (hit["_upto"] - hit["_n"]), hit["_n"]
    lo, hi = part.agg(F.min(number), F.max(number)).first()
    while lo != hi and size > one_task_rows:
        step = (hi - lo) // _BUCKETS + 1
        counts = part.groupBy(_divided(number, step).alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min(number).alias("lo"), F.max(number).alias("hi")
        )
        for row in sorted(counts.collect(), key=lambda r: r["b"]):
            if rank <= row["n"]:
                size, lo, hi = row["n"], row["lo"], row["hi"]
                break
            rank -= row["n"]
        part = part.filter(number.between(F.lit(lo), F.lit(hi)))
    return part, rank, size


def _divided(number: Column, step: int) -> Column:
    """Whole quotient, rounded towards zero."""
    return F.call_function("div", number, F.lit(step).cast("long"))


def at_or_before(keys: Sequence[str], cut: Cut) -> Column:
    """Whether a row's key is not after the cut, NULLs last."""
    result: Column = F.lit(True)
    for name, value in reversed(list(zip(keys, cut.key))):
        column = F.col(name)
        if value is None:
            before, same = column.isNotNull(), column.isNull()
        else:
            before, same = column < F.lit(value), column == F.lit(value)  # NaN is last and equals itself
        result = F.coalesce(before, F.lit(False)) | (F.coalesce(same, F.lit(False)) & result)
    return result


def with_position(
    df: DataFrame, keys: Sequence[str], name: str = "position", *, one_task_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """Add each row's place (from 1) in the order of unique ``keys``."""
    counted = df.withColumn("_one", F.lit(1).cast("long"))
    placed = running_totals(counted, order=keys, sums={name: "_one"}, one_task_rows=one_task_rows)
    return placed.drop("_one")


def first_rows(
    df: DataFrame, n: int | None, keys: Sequence[str], *, one_task_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """First ``n`` rows by ``keys`` (unique, NULLs last); None or negative keeps all.

    Small ``n`` is a top-n in every task.  Beyond that the n-th key is looked up and
    the table filtered, so the kept rows are never gathered in one place.
    """
    if n is None or n < 0:
        return df
    if n <= min(TOP_ROWS, one_task_rows):
        return df.orderBy(*[F.col(c).asc_nulls_last() for c in keys]).limit(n)
    size = df.count()
    if n >= size:
        return df
    fixed, (kept,) = cut_by_rank(df, keys, [n], size=size, one_task_rows=one_task_rows)
    return fixed.filter(kept).select(*df.columns)


def cut_by_rank(
    df: DataFrame,
    keys: Sequence[str],
    ranks: Sequence[int],
    *,
    size: int | None = None,
    one_task_rows: int = ONE_TASK_ROWS,
) -> tuple[DataFrame, list[Column]]:
    """The frame and, per rank, a condition that holds for exactly that many first rows.

    Where a rank falls between copies of one key, the frame is stored once with a
    number per row, so that every later read cuts the copies at the same place.
    """
    cuts = keys_at_ranks(df, keys, ranks, size=size, one_task_rows=one_task_rows)
    if any(c.splits_copies for c in cuts):
        df, size = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
        keys = [*keys, "_row"]
        cuts = keys_at_ranks(df, keys, ranks, size=size, one_task_rows=one_task_rows)
    return df, [at_or_before(keys, c) for c in cuts]
