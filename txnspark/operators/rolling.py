"""Prior-window features per entity, and scoring of requests against history.

For a row (or request) at time ``t`` with number ``id`` and a window of width
``w``, the *prior rows* are those of the same entity with

    t - w <= at < t,   or   at = t and their id is smaller.

A row or request without an id sees only ``at < t``, and is seen only from later times.
The row itself never counts.

Amounts are added as decimals with nine places, so that a row that entered and left a
window leaves no residue and the order of rows does not matter.  An amount that is not
finite, or not below 1e18, is no amount: it counts as NULL, also as the own amount.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnspark.operators.joins import frequent_keys
from txnspark.operators.ordered import ONE_TASK_ROWS, first_rows, running_totals
from txnspark.scratch import broadcast_if_small, materialize, task_count

MICROS = 1_000_000
# An entity above this size is spread over chunks.
HOT_ROWS = 1_000_000
# Rows that a task of a sweep takes, apart from an entity that has more.
SWEEP_ROWS = 100_000
# Request batches up to this size carry their entity list to the history scan.
PRUNE_REQUESTS = 250_000
# Slots over which rows without a history are spread.
_SLOTS = 1 << 20
# Amounts: the exact type they are added in, and the bound they stay below.
_EXACT, _BOUND = "DECIMAL(38, 9)", 1e18


@dataclass(frozen=True)
class RollingSpec:
    """One feature: ``count``, ``sum``, ``avg`` or ``ratio`` (own amount / avg) over ``width``."""

    name: str
    agg: str
    width: timedelta

    def __post_init__(self) -> None:
        if self.agg not in ("count", "sum", "avg", "ratio"):
            raise ValueError(f"unknown rolling aggregate {self.agg!r}")
        if self.width <= timedelta(0):
            raise ValueError("window width must be positive")

    @property
    def micros(self) -> int:
        return self.width // timedelta(microseconds=1)


# The four behavioural features and their windows.
BEHAVIORAL_SPECS = (
    RollingSpec("velocity_1h", "count", timedelta(hours=1)),
    RollingSpec("cumulative_spend_24h", "sum", timedelta(hours=24)),
    RollingSpec("avg_amount_ratio_30d", "ratio", timedelta(days=30)),
    RollingSpec("avg_amount_ratio_90d", "ratio", timedelta(days=90)),
)


@dataclass(frozen=True)
class HistoryColumns:
    """Column names of a history table."""

    entity: str = "derived_user_id"
    at: str = "transaction_at"
    id: str = "transaction_id"
    amount: str = "transaction_amt"
    label: str = "is_fraud"


DEFAULT_COLUMNS = HistoryColumns()


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a timestamp column (a plain timestamp counts as UTC)."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.unix_micros(F.from_utc_timestamp(F.col(name).cast("timestamp"), F.current_timezone()))
    return F.unix_micros(name)


def _finish(spec: RollingSpec, count: Column, total: Column, own: Column) -> Column:
    """Feature value from the prior count, the prior sum and the own amount."""
    if spec.agg == "count":
        return count.cast("int").alias(spec.name)
    if spec.agg == "sum":
        return F.coalesce(total.cast("double"), F.lit(0.0)).alias(spec.name)
    average = F.try_divide(total.cast("double"), F.nullif(count, F.lit(0)).cast("double"))
    if spec.agg == "avg":
        return average.alias(spec.name)
    return F.try_divide(own.cast("double"), F.nullif(average, F.lit(0.0))).alias(spec.name)


def usable_amount(amount: Column) -> Column:
    """The amount as a double; NULL unless finite and within bounds."""
    value = amount.cast("double")
    return F.when(F.abs(value) < _BOUND, value)  # NaN compares as greater than any number


# ---------------------------------------------------------------- hot entities


def hot_entities(df: DataFrame, entity: str, hot_rows: int) -> tuple[DataFrame | None, int]:
    """Stored keys of the entities with more than ``hot_rows`` rows, and how many rows they have."""
    return _entity_sizes(df, entity, hot_rows)[:2]


def _entity_sizes(df: DataFrame, entity: str, hot_rows: int) -> tuple[DataFrame | None, int, int]:
    """Stored keys of the hot entities, how many rows these have, and how many all have."""
    rows = df.count()
    keys = frequent_keys(df, entity, rows, hot_rows)
    if keys is None:
        return None, 0, rows
    return keys.select(entity), keys.agg(F.sum("_n")).first()[0], rows


# --------------------------------------------------------------------- sweep
#
# Every history row enters its entity's running state at its own time and leaves
# each window one microsecond after the window's width has passed.  A probe reads
# the state.  Within a microsecond rows leave first; then ids decide, and a probe
# comes before the entry of the same id.
#
# A row without an id enters after all others of its microsecond.

_ENTER, _PROBE = -1, -2


def _state_columns(specs: Sequence[RollingSpec]) -> tuple[list[int], dict[str, tuple[str, int]]]:
    """Window widths, and per running sum what it adds and for which width."""
    widths = sorted({s.micros for s in specs})
    needed: dict[str, tuple[str, int]] = {}
    for spec in specs:
        w = widths.index(spec.micros)
        if spec.agg == "count":
            needed[f"_n{w}"] = ("_rows", w)
        else:
            needed[f"_s{w}"] = ("_sum", w)
            needed[f"_k{w}"] = ("_known", w)
    return widths, needed


def _moves(df: DataFrame, specs: Sequence[RollingSpec], first: str, carried: str) -> DataFrame:
    """Explode rows into moves: ``first`` (SQL of an array of moves), then the leaves.

    Input columns ``_rows _known _sum`` say what a row adds.  Output columns
    ``_at _tie _sub`` give the order, and one column per running sum its change.
    """
    widths, needed = _state_columns(specs)
    leaves = ", ".join(_move(f"(_us + {w + 1}) * 2", 0, i, carried) for i, w in enumerate(widths))
    moves = f"CASE WHEN _rows > 0 THEN concat({first}, array({leaves})) ELSE {first} END"
    spread = df.selectExpr("_entity", "_rows", "_known", "_sum", f"explode({moves}) AS _m")
    changes = []
    for name, (what, w) in needed.items():
        zero = f"CAST(0 AS {_EXACT})" if what == "_sum" else "0L"
        changes.append(
            f"CASE _m._kind WHEN {_ENTER} THEN {what} WHEN {w} THEN -{what} ELSE {zero} END AS _d{name}"
        )
    return spread.selectExpr("_entity", "_m.*", *changes)


def _move(at: str, sub: int, kind: int, more: str = "") -> str:
    return f"struct({at} AS _at, _id AS _tie, {sub} AS _sub, {kind} AS _kind{more})"


# Twice the microsecond, plus one for rows that enter: leaves come first.  The next even
# number belongs to the leaves of the next microsecond, where no probe can be.
_HERE, _IN = "_us * 2 + 1", "IF(_id IS NULL, _us * 2 + 2, _us * 2 + 1)"


def _features_from_state(specs: Sequence[RollingSpec]) -> list[Column]:
    widths, _ = _state_columns(specs)
    own, out = F.col("_row._own"), []
    for spec in specs:
        w = widths.index(spec.micros)
        if spec.agg == "count":
            out.append(_finish(spec, F.col(f"_n{w}"), F.lit(None), own))
        else:
            out.append(_finish(spec, F.col(f"_k{w}"), F.col(f"_s{w}"), own))
    return out


def _amounts(df: DataFrame, *keep: str) -> DataFrame:
    """What each row adds to the state."""
    zero = f"CAST(0 AS {_EXACT})"
    return df.selectExpr(
        *keep,
        "IF(_counts, 1L, 0L) AS _rows",
        "IF(_counts AND _amt IS NOT NULL, 1L, 0L) AS _known",
        f"IF(_counts, coalesce(CAST(_amt AS {_EXACT}), {zero}), {zero}) AS _sum",
    )


def _by_sweep(df: DataFrame, specs: Sequence[RollingSpec], rows: int) -> DataFrame:
    """Sweep with one window per entity: linear in its ``rows``, one exchange of compact rows.

    Entities are dealt to as many tasks as the rows ask for, so that the moves that a task
    sorts do not grow with the table.

    A row's probe and its entry are separate moves, so that copies of a row do not
    see each other.
    """
    _, needed = _state_columns(specs)
    tasks = [task_count(df.sparkSession, rows, SWEEP_ROWS)] if rows > SWEEP_ROWS else []
    compact = _amounts(df.repartition(*tasks, "_entity"), "_entity", "_us", "_id", "_probes", "_row")
    nothing = ", CASE WHEN false THEN _row END AS _row"
    probe, enter = _move(_HERE, 0, _PROBE, ", _row AS _row"), _move(_IN, 1, _ENTER, nothing)
    first = f"CASE WHEN _probes AND _rows > 0 THEN array({probe}, {enter}) WHEN _probes THEN array({probe}) ELSE array({enter}) END"
    moves = _moves(compact, specs, first, nothing)
    upto = "(PARTITION BY _entity ORDER BY _at, _tie, _sub ROWS UNBOUNDED PRECEDING)"
    state = moves.selectExpr("_kind", "_row", *[f"sum(_d{c}) OVER {upto} AS {c}" for c in needed])
    return state.filter(F.col("_kind") == _PROBE).select("_row", *_features_from_state(specs))


def _by_chunked_sweep(df: DataFrame, specs: Sequence[RollingSpec], rows: int, one_task_rows: int) -> DataFrame:
    """Sweep for entities that do not fit one task; ``rows`` is about the size of ``df``.

    Rows with the same entity, time and id are added up first, with a map-side
    combine, so a large group of copies collapses; each group then reads the state
    just before its own single entry, a group without id that before its microsecond.
    The running sums go over chunks that cut through an entity, and the state is
    joined back to the rows.
    """
    widths, needed = _state_columns(specs)
    place = ("_entity", "_us", "_id")
    groups = (
        _amounts(df, *place).groupBy(*place).agg(*[F.sum(c).cast(t).alias(c) for c, t in _ADDED])
    )
    probe, enter = _move(_HERE, 0, _PROBE), _move(_IN, 0, _ENTER)
    moves = _moves(groups, specs, f"IF(_id IS NULL, array({probe}, {enter}), array({enter}))", "")
    state = running_totals(
        moves,
        group=["_entity"],
        order=["_at", "_tie"],
        sums={c: f"_d{c}" for c in needed},
        inclusive=False,
        size=rows * (len(widths) + 2),
        one_task_rows=one_task_rows,
    )
    reads = (F.col("_kind") == _PROBE) | ((F.col("_kind") == _ENTER) & F.col("_tie").isNotNull())
    state = state.filter(reads).selectExpr(
        "_entity AS _p_entity", "(_at - 1) div 2 AS _p_us", *_id_columns("_tie", "_p_id", "_p_none"), *needed
    )
    probes = df.filter("_probes").selectExpr("_row", "_entity", "_us", *_id_columns("_id", "_q_id", "_q_none"))
    if rows > SWEEP_ROWS:
        # The side of the state, whose places are distinct, says how many tasks join; the other follows it.
        state = state.repartition(task_count(df.sparkSession, rows, SWEEP_ROWS), "_p_entity", "_p_us", "_p_id", "_p_none")
    same = F.expr("_entity = _p_entity AND _us = _p_us AND _q_id = _p_id AND _q_none = _p_none")
    return probes.join(state, same).select("_row", *_features_from_state(specs))


def _id_columns(name: str, value: str, none: str) -> list[str]:
    """SQL of an id as two columns that are never NULL."""
    return [f"coalesce({name}, 0L) AS {value}", f"{name} IS NULL AS {none}"]


_ADDED = (("_rows", "bigint"), ("_known", "bigint"), ("_sum", _EXACT))


# ---------------------------------------------------------------- operators


def _prepared(
    df: DataFrame, columns: HistoryColumns, *, counts: bool, probes: bool, keep: Sequence[str]
) -> DataFrame:
    """Rows as the sweep takes them.

    A row without entity or time counts nowhere; it gets a key of its own slot, so that
    it reads an empty history and many such rows do not meet in one task.
    """
    amount = usable_amount(F.col(columns.amount))
    tie = F.col(columns.id).cast("long") if columns.id in df.columns else F.lit(None).cast("long")
    usable = F.col(columns.entity).isNotNull() & F.col(columns.at).isNotNull()
    slot = F.pmod(F.xxhash64(columns.at, columns.amount, tie), F.lit(_SLOTS))
    return df.select(
        F.struct(F.col(columns.entity).alias("key"), F.when(~usable, slot).alias("slot")).alias("_entity"),
        F.coalesce(micros(df, columns.at), F.lit(0).cast("long")).alias("_us"),
        tie.alias("_id"),
        amount.alias("_amt"),
        (F.lit(counts) & usable).alias("_counts"),
        F.lit(probes).alias("_probes"),
        F.struct(*[F.col(c) for c in keep], amount.alias("_own")).alias("_row"),
    )


def _at_between(df: DataFrame, name: str, lo: int, hi: int) -> Column:
    """Time filter on microsecond bounds; reaches the scan for a timestamp column."""
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.col(name).between(F.timestamp_micros(F.lit(lo)), F.timestamp_micros(F.lit(hi)))
    return micros(df, name).between(F.lit(lo), F.lit(hi))


def rolling_features(
    df: DataFrame,
    specs: Sequence[RollingSpec] = BEHAVIORAL_SPECS,
    *,
    columns: HistoryColumns = DEFAULT_COLUMNS,
    strategy: str = "auto",
    hot_rows: int = HOT_ROWS,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Add one column per spec to every row of ``df``.

    Strategies give equal results: ``sweep`` (linear, any ordinary entity) and
    ``chunked`` (entities spread over several tasks).  ``auto`` sweeps, with the
    entities of more than ``hot_rows`` rows chunked.

    Rows without entity or time get the empty-history value and never meet in a
    window.  NULL amounts count as rows but not in sums and averages.
    """
    specs = list(specs)
    names = [s.name for s in specs]
    if clash := [n for n in names if n in df.columns]:
        raise ValueError(f"columns already present: {clash}")
    if strategy not in ("auto", "sweep", "chunked"):
        raise ValueError(f"unknown strategy {strategy!r}")
    ready = _prepared(df, columns, counts=True, probes=True, keep=df.columns)
    if strategy == "sweep":
        result = _by_sweep(ready, specs, df.count())
    elif strategy == "chunked":
        result = _by_chunked_sweep(ready, specs, df.count(), one_task_rows)
    else:
        result = _by_size(ready, specs, *_entity_sizes(df, columns.entity, hot_rows), one_task_rows)
    return result.select("_row.*", *names).drop("_own")


def _by_size(
    df: DataFrame, specs: Sequence[RollingSpec], hot: DataFrame | None, hot_rows: int, rows: int, one_task_rows: int
) -> DataFrame:
    """Sweep of ``rows`` rows, with the ``hot_rows`` ones of hot entities chunked."""
    if hot is None:
        return _by_sweep(df, specs, rows)
    keys = broadcast_if_small(hot.toDF("_hot"))
    same = (F.col("_entity.key") == F.col("_hot")) & F.col("_entity.slot").isNull()
    normal, heavy = df.join(keys, same, "left_anti"), df.join(keys, same, "left_semi")
    swept = _by_sweep(normal, specs, rows - hot_rows)
    return swept.unionByName(_by_chunked_sweep(heavy, specs, hot_rows, one_task_rows))


def behavioral_features(
    history: DataFrame,
    *,
    limit: int | None = None,
    transaction_ids: DataFrame | Iterable[int] | None = None,
    specs: Sequence[RollingSpec] = BEHAVIORAL_SPECS,
    columns: HistoryColumns = DEFAULT_COLUMNS,
    strategy: str = "auto",
    with_ordinal: bool = False,
) -> DataFrame:
    """Id, label and the rolling features of selected rows; windows see all history.

    With ``transaction_ids`` (values, or a frame with ``transaction_id`` and
    optionally ``ordinal``) the result follows the caller's order, repeats repeated
    ids and drops unknown ones, and only the entities behind those ids are read;
    ``with_ordinal`` keeps each row's place as a column.
    Otherwise the first ``limit`` rows by (time, id); no row ever looks ahead, so
    cutting the history there first gives the same values.  None means all rows.
    """
    narrow = history.select(columns.id, columns.label, columns.entity, columns.at, columns.amount)
    names = [columns.id, columns.label, *[s.name for s in specs]]
    if transaction_ids is None:
        chosen = first_rows(narrow, limit, [columns.at, columns.id])
        return rolling_features(chosen, specs, columns=columns, strategy=strategy).select(*names)
    wanted = id_frame(history, transaction_ids, columns.id)
    entities = narrow.join(wanted.select(columns.id).distinct(), columns.id, "left_semi")
    entities = entities.select(columns.entity).distinct()
    related = narrow.join(entities, columns.entity, "left_semi")
    without = narrow.filter(F.col(columns.entity).isNull())
    features = rolling_features(
        related.unionByName(without), specs, columns=columns, strategy=strategy
    ).select(*names)
    return wanted.join(features, columns.id).orderBy("ordinal").select(*names, *["ordinal"] * with_ordinal)


def id_frame(df: DataFrame, ids: DataFrame | Iterable[int], name: str) -> DataFrame:
    """Ids as a frame with their place in the caller's list (column ``ordinal``)."""
    if isinstance(ids, DataFrame):
        wanted = ids if "ordinal" in ids.columns else ids.withColumn("ordinal", F.lit(0))
        return wanted.select(F.col(name).cast("long").alias(name), "ordinal")
    schema = T.StructType([T.StructField(name, T.LongType()), T.StructField("ordinal", T.LongType())])
    return df.sparkSession.createDataFrame([(int(v), i) for i, v in enumerate(ids)], schema)


def score_requests(
    requests: DataFrame,
    history: DataFrame,
    specs: Sequence[RollingSpec] = BEHAVIORAL_SPECS,
    *,
    columns: HistoryColumns = DEFAULT_COLUMNS,
    hot_rows: int = HOT_ROWS,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Features of requests that need not be in the history table.

    ``requests`` has entity, time and amount, and optionally an id for tied times.
    Requests read the same running state as :func:`rolling_features`, so the cost is
    linear in requests plus history and no request-history pairs are formed.
    History outside the time span the windows can reach is not read; for a batch of
    at most 250,000 requests, nor are other entities.
    """
    specs = list(specs)
    usable = requests.filter(F.col(columns.entity).isNotNull() & F.col(columns.at).isNotNull())
    past = history.filter(F.col(columns.entity).isNotNull() & F.col(columns.at).isNotNull())
    past = past.select(columns.entity, columns.at, columns.id, columns.amount)
    asked_us, reach = micros(usable, columns.at), max(s.micros for s in specs)
    span = usable.agg(
        F.min(asked_us).alias("lo"), F.max(asked_us).alias("hi"), F.count(F.lit(1)).alias("n")
    ).first()
    if span["n"]:
        past = past.filter(_at_between(past, columns.at, span["lo"] - reach, span["hi"]))
        if span["n"] <= PRUNE_REQUESTS:
            entities = materialize(usable.select(columns.entity).distinct(), "entities")[0]
            past = past.join(broadcast_if_small(entities), columns.entity, "left_semi")
    asked = _prepared(requests, columns, counts=False, probes=True, keep=requests.columns)
    payload = asked.schema["_row"].dataType
    known = _prepared(past, columns, counts=True, probes=False, keep=[columns.entity])
    both = asked.unionByName(known.withColumn("_row", F.lit(None).cast(payload)))
    keyed = both.selectExpr("IF(_entity.slot IS NULL, _entity.key, NULL) AS key")
    result = _by_size(both, specs, *_entity_sizes(keyed, "key", hot_rows), one_task_rows)
    return result.select("_row.*", *[s.name for s in specs]).drop("_own")


# ------------------------------------------------------------ single lookups


def prior_rows(
    history: DataFrame,
    *,
    entity,
    at: datetime,
    width: timedelta,
    transaction_id: int | None = None,
    columns: HistoryColumns = DEFAULT_COLUMNS,
) -> DataFrame:
    """The prior rows of one described transaction."""
    when = F.col(columns.at)
    before = when < F.lit(at)
    if transaction_id is not None:
        before = before | ((when == F.lit(at)) & (F.col(columns.id) < F.lit(transaction_id)))
    return history.filter((F.col(columns.entity) == F.lit(entity)) & (when >= F.lit(at - width)) & before)


def point_features(
    history: DataFrame,
    *,
    entity,
    at: datetime,
    amount: float | None,
    transaction_id: int | None = None,
    specs: Sequence[RollingSpec] = BEHAVIORAL_SPECS,
    columns: HistoryColumns = DEFAULT_COLUMNS,
) -> DataFrame:
    """Features of one described transaction as a single row, in one filtered scan."""
    specs = list(specs)
    widest = max(s.width for s in specs)
    rows = prior_rows(
        history, entity=entity, at=at, width=widest, transaction_id=transaction_id, columns=columns
    )
    sums = []
    for i, spec in enumerate(specs):
        inside = F.col(columns.at) >= F.lit(at - spec.width)
        value = F.when(inside, usable_amount(F.col(columns.amount)).cast(_EXACT))
        counted = F.when(inside, F.lit(1)) if spec.agg == "count" else value
        sums += [F.count(counted).alias(f"_n{i}"), F.sum(value).alias(f"_s{i}")]
    own = usable_amount(F.lit(amount))
    return rows.agg(*sums).select(
        *[_finish(s, F.col(f"_n{i}"), F.col(f"_s{i}"), own) for i, s in enumerate(specs)]
    )
