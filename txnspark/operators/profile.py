"""Exploratory profiling: missingness, rates, distributions, correlations, key checks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnspark.functions.columns import event_day, is_missing
from txnspark.functions.groups import column_groups, group_of
from txnspark.operators.moments import co_moments
from txnspark.operators.ordered import first_rows, quantiles
from txnspark.scratch import broadcast_if_small, materialize

# Expressions per aggregation, to stay within generated-code limits on wide tables.
_BATCH = 100
_PAIRS = 40
_FLOATS = (T.FloatType, T.DoubleType)


def _batches(names: Sequence[str]) -> list[list[str]]:
    return [list(names[i : i + _BATCH]) for i in range(0, len(names), _BATCH)]


def _clean(df: DataFrame, name: str) -> Column:
    """The column with NaN as NULL."""
    return F.when(~is_missing(df, name), F.col(f"`{name}`"))


def _numeric_columns(df: DataFrame, drop: Iterable[str] = ()) -> list[str]:
    dropped = set(drop)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in dropped]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _value(df: DataFrame, name: str) -> str:
    """SQL of a column with NaN as NULL."""
    is_float = isinstance(df.schema[name].dataType, _FLOATS)
    return f"nanvl({_quoted(name)}, NULL)" if is_float else _quoted(name)


def _per_column(df: DataFrame, names: Sequence[str], measures: Callable[[str], str]) -> DataFrame:
    """One row per column from one aggregation, and so one scan, of all columns.

    ``measures(name)`` is the SQL list of a column's aggregates.
    """
    batches = []
    for k, batch in enumerate(_batches(names)):
        rows = ", ".join(f"struct({_text(n)} AS column, {measures(n)})" for n in batch)
        batches.append(F.expr(f"array({rows})").alias(f"_rows{k}"))
    # A list per batch keeps the expressions, and the code made of them, small.
    return df.agg(*batches).select(F.inline(F.flatten(F.array(*[f"_rows{k}" for k in range(len(batches))]))))


# ------------------------------------------------------------- missing values


def missing_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: share of missing values in percent, and its column group."""
    names = list(columns if columns is not None else df.columns)

    def measures(name: str) -> str:
        missing = f"avg(CASE WHEN {_value(df, name)} IS NULL THEN 1 ELSE 0 END) * 100"
        return f"{missing} AS pct_missing, {_text(group_of(name))} AS `group`"

    return _per_column(df, names, measures)


def missing_summary(df: DataFrame, top_n: int = 30) -> DataFrame:
    """Columns with the highest missing share; ties by name."""
    return (
        missing_rates(df).select("column", "pct_missing").orderBy(F.desc("pct_missing"), "column").limit(top_n)
    )


def columns_missing_above(df: DataFrame, share: float = 0.9) -> DataFrame:
    """Columns whose missing share exceeds ``share``."""
    return missing_rates(df).filter(F.col("pct_missing") > share * 100).select("column", "pct_missing")


def missing_by_group(df: DataFrame, groups: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Per column group: number of columns and mean missing percent, highest first."""
    rates = missing_rates(df)
    if groups is not None:
        named = {c: g for g, members in groups.items() for c in members if c in df.columns}
        label = F.lit(None).cast("string")
        for group in dict.fromkeys(named.values()):
            label = F.when(F.col("column").isin([c for c in named if named[c] == group]), group).otherwise(label)
        rates = rates.withColumn("group", label).filter("group is not null")
    grouped = rates.groupBy("group").agg(
        F.count(F.lit(1)).alias("n_columns"), F.avg("pct_missing").alias("avg_pct_missing")
    )
    return grouped.orderBy(F.desc("avg_pct_missing"), "group")


def missing_blocks(df: DataFrame, blocks: Sequence[str] = ("C", "D", "M", "V")) -> DataFrame:
    """Mean, median and largest missing percent of each anonymous block."""
    found = column_groups(df.columns)
    names = [c for b in blocks for c in found.get(b, [])]
    return (
        missing_rates(df, names)
        .groupBy("group")
        .agg(
            F.count(F.lit(1)).alias("n_columns"),
            F.avg("pct_missing").alias("avg_pct_missing"),
            F.median("pct_missing").alias("median_pct_missing"),
            F.max("pct_missing").alias("max_pct_missing"),
        )
    )


def missing_before_after(before: DataFrame, after: DataFrame, side: Sequence[str] = ()) -> DataFrame:
    """Mean missing percent over all columns before and after a join, and of the joined-in columns."""
    after_rates, _ = materialize(missing_rates(after), "rates")  # the join runs once for both uses
    stages = [("before join", missing_rates(before)), ("after join", after_rates)]
    if side:
        stages.append(("joined columns", after_rates.filter(F.col("column").isin(*side))))
    out = None
    for name, rates in stages:
        row = rates.agg(F.avg("pct_missing").alias("avg_pct_missing"))
        row = row.select(F.lit(name).alias("stage"), "avg_pct_missing")
        out = row if out is None else out.unionByName(row)
    return out


# ---------------------------------------------------------------- label rates


def target_rate(
    df: DataFrame, feature: str, label: str, *, min_count: int = 100, top_n: int | None = 15
) -> DataFrame:
    """Label count and mean per level, frequent levels only, highest rate first.

    Missing levels are dropped; only rows with a label count.
    """
    rates = (
        df.filter(~is_missing(df, feature))
        .groupBy(F.col(feature).alias("level"))
        .agg(F.count(label).alias("count"), F.avg(label).alias("mean"))
        .filter(F.col("count") >= min_count)
    )
    ranked = rates.orderBy(F.desc("mean"), "level")
    return ranked if top_n is None else ranked.limit(top_n)


def target_rates(
    df: DataFrame, features: Sequence[str], label: str, *, min_count: int = 100, top_n: int | None = 15
) -> DataFrame:
    """:func:`target_rate` of many features from one scan: feature, level (as text), count, mean.

    Grouping sets of one feature each; a level that is counted in a task is one row from there on.
    """
    place = {c: f"_{k}" for k, c in enumerate(features)}
    rows = df.select(F.col(label).alias("_y"), *[_clean(df, c).cast("string").alias(p) for c, p in place.items()])
    sets = [[F.col(p)] for p in place.values()]
    # One bit per feature, the first the highest; the bit of the feature that a row is of is not set.
    number = F.grouping_id(*[F.col(p) for p in place.values()]).alias("_set")
    counted = rows.groupingSets(sets, *[F.col(p) for p in place.values()]).agg(
        number, F.count("_y").alias("count"), F.avg("_y").alias("mean")
    )
    full, every = (1 << len(place)) - 1, list(place.items())
    feature, level = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, (name, column) in enumerate(every):
        own = F.col("_set") == full - (1 << (len(place) - 1 - k))
        feature, level = F.when(own, name).otherwise(feature), F.when(own, F.col(column)).otherwise(level)
    out = counted.select(feature.alias("feature"), level.alias("level"), "count", "mean")
    out = out.filter(F.col("level").isNotNull() & (F.col("count") >= min_count))
    if top_n is None:
        return out
    ranked = out.withColumn("_r", F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("mean"), "level")))
    return ranked.filter(F.col("_r") <= top_n).drop("_r")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows and percent per class, and the ratio of the largest class to each."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    return counts.select(
        label,
        "count",
        (F.col("count") * 100.0 / counts.agg(F.sum("count")).scalar()).alias("percent"),
        (counts.agg(F.max("count")).scalar() / F.col("count")).alias("majority_ratio"),
    )


def coverage_rate(df: DataFrame, side_column: str, label: str) -> DataFrame:
    """Rows, share and label rate with and without a value in an optional column."""
    has = (~is_missing(df, side_column)).alias("present")
    counts = df.groupBy(has).agg(F.count(F.lit(1)).alias("rows"), F.avg(label).alias("rate"))
    share = F.col("rows") * 100.0 / F.sum("rows").over(Window.partitionBy())  # at most two rows
    return counts.select("present", "rows", share.alias("pct_rows"), "rate")


def daily_rate(df: DataFrame, at: str, label: str) -> DataFrame:
    """Rows and label rate per day."""
    return df.groupBy(event_day(F.col(at)).alias("day")).agg(
        F.count(F.lit(1)).alias("volume"), F.avg(label).alias("rate")
    )


def decile_rate(df: DataFrame, column: str, label: str, *, bins: int = 10, accuracy: int | None = None) -> DataFrame:
    """Label rate per equal-frequency bin; bins are (lo, hi], the first includes its lower edge.

    Edges are exact quantiles unless ``accuracy`` asks for the sketch; equal edges merge.
    Only the ``bins + 1`` edges reach the driver.
    """
    probs = [i / bins for i in range(bins + 1)]
    row = quantiles(df, column, probs, accuracy=accuracy).first()
    if row is None:
        raise ValueError(f"column {column!r} has no values")
    edges = sorted(set(row))
    value = _clean(df, column).cast("double")
    if len(edges) == 1:
        edges = edges * 2
    # Number of inner edges strictly below the value = bin number.
    inner = edges[1:-1]
    number = sum([(value > F.lit(e)).cast("int") for e in inner], F.lit(0))
    lows, highs = (F.array(*[F.lit(e) for e in es]) for es in (edges[:-1], edges[1:]))
    binned = df.filter(value.isNotNull()).select(number.alias("bin"), F.col(label).alias("_y"))
    return (
        binned.groupBy("bin")
        .agg(F.count("_y").alias("count"), F.avg("_y").alias("rate"))
        .select("bin", F.get(lows, "bin").alias("lo"), F.get(highs, "bin").alias("hi"), "count", "rate")
    )


# --------------------------------------------------------------- description


def describe_by(
    df: DataFrame, column: str, by: str | None = None, *, accuracy: int | None = None
) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max of a column, per class."""
    keys = [by] if by else []
    value = _clean(df, column).cast("double")
    values = df.select(*keys, value.alias("_v"))
    basics = values.groupBy(*keys).agg(
        F.count("_v").alias("count"),
        F.avg("_v").alias("mean"),
        F.stddev_samp("_v").alias("std"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
    )
    quarts = quantiles(values, "_v", [0.25, 0.5, 0.75], group=keys, accuracy=accuracy)
    quarts = quarts.toDF(*keys, "q25", "q50", "q75")
    joined = _join_small(basics, quarts, keys)
    return joined.select(*keys, "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, min and max of several numeric columns in one pass."""
    long = df.selectExpr(*[f"CAST({_value(df, c)} AS DOUBLE) AS {_quoted(c)}" for c in columns]).unpivot(
        [], list(columns), "column", "_v"
    )
    return long.groupBy("column").agg(
        F.count("_v").alias("count"),
        F.avg("_v").alias("mean"),
        F.stddev_samp("_v").alias("std"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
    )


def _join_small(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join two aggregates on their (nullable) keys; without keys both have one row."""
    if not keys:
        keys = ["_one"]
        left, right = left.withColumn("_one", F.lit(1)), right.withColumn("_one", F.lit(1))
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    return left.join(renamed, condition, "left").drop(*[f"_r_{k}" for k in keys])


def cardinality(df: DataFrame, columns: Sequence[str], *, approx_rsd: float | None = None) -> DataFrame:
    """Distinct non-missing values and missing percent per column.

    Exact counts go through one (column, value) grouping with a map-side combine
    instead of one distinct aggregate per column.
    """
    if approx_rsd is not None:
        return _per_column(
            df,
            columns,
            lambda n: f"approx_count_distinct({_value(df, n)}, {approx_rsd}) AS n_distinct, "
            f"avg(CASE WHEN {_value(df, n)} IS NULL THEN 1 ELSE 0 END) * 100 AS pct_missing",
        )
    long = df.select(*[_clean(df, c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    counted = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("column").agg(
        F.count("value").alias("n_distinct"),
        (F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)) * 100.0 / F.sum("n")).alias("pct_missing"),
    )


def value_counts(df: DataFrame, column: str, *, top_n: int | None = 10, drop_missing: bool = False) -> DataFrame:
    """Rows and share per value, most frequent first; ties by value, missing values counted."""
    rows = df.filter(~is_missing(df, column)) if drop_missing else df
    counts = rows.groupBy(_clean(df, column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    counts, _ = materialize(counts, "counts")
    share = F.col("count") / counts.agg(F.sum("count")).scalar()
    ranked = counts.select("value", "count", share.alias("share")).orderBy(F.desc("count"), F.asc_nulls_last("value"))
    return ranked if top_n is None else ranked.limit(top_n)


# -------------------------------------------------------------- correlations


def _correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson correlation (i, j, r) of a few column pairs, each on its complete rows, in one aggregate.

    A constant side gives NULL, and rounding never takes r out of [-1, 1].
    """
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    place = {c: f"_{k}" for k, c in enumerate(names)}
    numbers = df.select(*[_finite(df, c).alias(place[c]) for c in names])
    rows = []
    for a, b in pairs:
        x, y = place[a], place[b]
        # Merged deviations of a constant can come out as a tiny number, hence the range test.
        both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
        varies = " AND ".join(f"min({v}) FILTER (WHERE {both}) < max({v}) FILTER (WHERE {both})" for v in (x, y))
        spread = " * ".join(f"stddev_pop({v}) FILTER (WHERE {both})" for v in (x, y))
        r = f"CASE WHEN {varies} THEN greatest(-1D, least(1D, try_divide(covar_pop({x}, {y}), {spread}))) END"
        rows.append(f"struct({_text(a)} AS i, {_text(b)} AS j, {r} AS r)")
    return numbers.agg(F.expr(f"array({', '.join(rows)})").alias("_rows")).select(F.inline("_rows"))


def _finite(df: DataFrame, name: str) -> Column:
    """The column as a double, NULL where it is NaN or infinite."""
    value = F.expr(f"CAST({_value(df, name)} AS DOUBLE)")
    return F.when(F.abs(value) < float("inf"), value)


def _many_correlations(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """Pearson correlation (i, j, r) of every left with every right column, from one scan."""
    found = co_moments(df, [_finite(df, c) for c in left], [_finite(df, c) for c in right])
    ratio = F.try_divide("prod", F.sqrt("sq_x") * F.sqrt("sq_y"))
    r = F.when(F.col("varies"), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ratio)))
    found = found.select(F.col("i").alias("_i"), F.col("j").alias("_j"), r.alias("r"))
    spark = df.sparkSession
    every = spark.createDataFrame([(k, c) for k, c in enumerate(left)], "_i int, i string")
    others = spark.createDataFrame([(k, c) for k, c in enumerate(right)], "_j int, j string")
    every = every.select("_i", "i", F.explode(F.sequence(F.lit(0), F.lit(len(right) - 1))).alias("_j")).join(others, "_j")
    return every.join(found, ["_i", "_j"], "left").select("i", "j", "r")


def corr_with_label(
    df: DataFrame, label: str, columns: Sequence[str] | None = None, *, top_n: int | None = None
) -> DataFrame:
    """Pearson correlation of numeric columns with the label on complete pairs, strongest first."""
    names = list(columns) if columns is not None else _numeric_columns(df, drop=(label,))
    if len(names) <= _PAIRS:
        found = _correlations(df, [(n, label) for n in names])
    else:
        found = _many_correlations(df, names, [label])
    found = found.select(F.col("i").alias("column"), "r")
    ranked = found.withColumn("abs_r", F.abs("r")).orderBy(F.desc_nulls_last("abs_r"), "column")
    return ranked if top_n is None else ranked.limit(top_n)


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair of columns, in long form (i, j, r).

    One scan: a few pairs are one aggregate, many are matrix products (see :mod:`.moments`).
    """
    if len(columns) * (len(columns) + 1) // 2 > _PAIRS:
        return _many_correlations(df, columns, columns)
    found = _correlations(df, [(a, b) for k, a in enumerate(columns) for b in columns[k:]])
    mirrored = F.expr("IF(i = j, array(struct(i, j)), array(struct(i, j), struct(j AS i, i AS j)))")
    return found.select(F.explode(mirrored).alias("p"), "r").select("p.i", "p.j", "r")


# ------------------------------------------------------------- distributions


def histogram_by_class(
    df: DataFrame,
    column: str,
    by: str,
    *,
    bins: int = 30,
    clip: tuple[float, float] | None = None,
    accuracy: int | None = None,
) -> DataFrame:
    """Equal-width bins with the density normalised per class.

    The range is the column's, or its ``clip`` quantiles (equal ends widen by one);
    values outside are left out.  The last bin includes its upper end.
    """
    value = _clean(df, column).cast("double")
    values = df.select(value.alias("_v"), F.col(by).alias("_c")).filter("_v is not null and _c is not null")
    if clip is None:
        ends = values.agg(F.min("_v").alias("q0"), F.max("_v").alias("q1")).first()
    else:
        ends = quantiles(df, column, list(clip), accuracy=accuracy).first()
    lo, hi = ends[0], ends[1]
    if lo is None:
        raise ValueError(f"column {column!r} has no values")
    if lo == hi:
        hi = lo + 1
    width = (hi - lo) / bins
    number = F.least(F.floor((F.col("_v") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = (
        values.filter(F.col("_v").between(F.lit(lo), F.lit(hi)))
        .groupBy(F.col("_c").alias(by), number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    of_class = F.sum("count").over(Window.partitionBy(by))  # at most one row per bin
    return counts.select(
        by,
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
        "count",
        (F.col("count") / (of_class * F.lit(width))).alias("density"),
    )


def boxplot_stats(df: DataFrame, column: str, by: str, *, accuracy: int | None = None) -> DataFrame:
    """Quartiles, whisker ends within 1.5 interquartile ranges, and rows beyond, per class."""
    values = df.select(F.col(by), _clean(df, column).cast("double").alias("_v"))
    values = values.filter(F.col("_v").isNotNull() & F.col(by).isNotNull())
    quarts = quantiles(values, "_v", [0.25, 0.5, 0.75], group=[by], accuracy=accuracy).toDF(by, "q1", "q2", "q3")
    quarts = broadcast_if_small(materialize(quarts, "quartiles")[0])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("_v").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        values.join(quarts, by)
        .groupBy(by, "q1", "q2", "q3")
        .agg(
            F.min(F.when(inside, F.col("_v"))).alias("whisker_lo"),
            F.max(F.when(inside, F.col("_v"))).alias("whisker_hi"),
            F.count_if(~inside).alias("outliers"),
        )
    )


# --------------------------------------------------------------------- checks


def key_check(df: DataFrame, key: str, name: str = "table") -> DataFrame:
    """Rows, distinct keys, most rows per key and whether the key is unique."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.lit(name).alias("name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.max("n"), F.lit(0)).alias("max_per_key"),
        (F.coalesce(F.max("n"), F.lit(0)) <= 1).alias("is_unique"),
    )


def schema_diff(left: DataFrame, right: DataFrame, *, ignore: Iterable[str] = ()) -> DataFrame:
    """Each column with where it occurs: ``left``, ``right`` or ``both``."""
    skipped = set(ignore)
    names = dict.fromkeys([*left.columns, *right.columns])
    rows = []
    for name in names:
        if name in skipped:
            continue
        place = "both" if name in left.columns and name in right.columns else None
        rows.append((name, place or ("left" if name in left.columns else "right")))
    return left.sparkSession.createDataFrame(rows, "column string, side string")


def frame_shape(df: DataFrame) -> DataFrame:
    """Rows, columns, and how many columns are text, floating, integral or other."""
    kinds = {"text": 0, "floating": 0, "integral": 0, "other": 0}
    for f in df.schema:
        if isinstance(f.dataType, T.StringType):
            kinds["text"] += 1
        elif isinstance(f.dataType, (*_FLOATS, T.DecimalType)):
            kinds["floating"] += 1
        elif isinstance(f.dataType, T.IntegralType):
            kinds["integral"] += 1
        else:
            kinds["other"] += 1
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        *[F.lit(n).alias(f"{k}_columns") for k, n in kinds.items()],
    )


def hash_sample(df: DataFrame, n: int, key: str, *, seed: int = 42) -> DataFrame:
    """``min(n, rows)`` rows by a hash of the key and the seed.

    The same rows whatever the partitioning.
    """
    code = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    # A number first: ranks of numbers are found without a shuffle.
    place = {"_place": F.conv(F.substring(code, 1, 15), 16, 10).cast("long"), "_code": code}
    return first_rows(df.withColumns(place), n, ["_place", "_code", key]).drop(*place)


# --------------------------------------------------------------- type advice


def type_advice(df: DataFrame, *, approx_rsd: float | None = None) -> DataFrame:
    """Per column: current type and the narrowest storage type that holds its values.

    Text with fewer distinct values (missing counts as one) than half the rows is
    advised a dictionary; floating types become float; integers the narrowest type
    that strictly contains their range (Spark has signed types only).
    """
    names = df.columns
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    kinds = {f.name: f.dataType for f in df.schema}

    def bounds(name: str) -> str:
        integral = isinstance(kinds[name], T.IntegralType)
        value = f"CAST({_quoted(name)} AS BIGINT)" if integral else "CAST(NULL AS BIGINT)"
        kind = _text(kinds[name].simpleString())
        return f"{kind} AS current, count(1) AS _rows, min({value}) AS lo, max({value}) AS hi"

    table = _per_column(df, names, bounds)
    if text:
        distinct = cardinality(df, text, approx_rsd=approx_rsd).select(
            F.col("column").alias("_c"),
            (F.col("n_distinct") + F.when(F.col("pct_missing") > 0, 1).otherwise(0)).alias("_n"),
        )
        table = table.join(F.broadcast(distinct), F.col("column") == F.col("_c"), "left")
    else:
        table = table.withColumn("_n", F.lit(None).cast("long"))
    lo, hi = F.col("lo"), F.col("hi")
    integral = F.col("current").isin("tinyint", "smallint", "int", "bigint")
    advised = F.when((F.col("current") == "string") & (F.col("_n") < F.col("_rows") * 0.5), "dictionary").when(
        F.col("current").isin("float", "double"), "float"
    )
    # Strict bounds of the signed widths.
    for kind, low, high in (
        ("tinyint", -128, 127),
        ("smallint", -32768, 32767),
        ("int", -2147483648, 2147483647),
    ):
        advised = advised.when(integral & (lo > low) & (hi < high), kind)
    return table.select("column", "current", advised.otherwise(F.col("current")).alias("advised"), "lo", "hi")


def apply_types(df: DataFrame, advice: DataFrame) -> DataFrame:
    """Cast the columns as advised; text stays text (Parquet builds its own dictionaries)."""
    wanted = {r["column"]: r["advised"] for r in advice.collect()}
    changed = {
        c: F.col(c).cast(wanted[c])
        for c in df.columns
        if wanted.get(c) not in (None, "dictionary") and wanted[c] != df.schema[c].dataType.simpleString()
    }
    return df.withColumns(changed) if changed else df
