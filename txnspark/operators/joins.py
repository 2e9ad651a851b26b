"""Keyed joins that hold up when one key, or NULL, owns much of the left side."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnspark.scratch import BROADCAST_BYTES, broadcast_if_small, materialize, task_count

_NULL_SLOTS = 1_000
# Rows of target and source together up to which Spark deals out an upsert, and rows that a task takes beyond.
UPSERT_ROWS, UPSERT_TASK_ROWS = 1_000_000, 250_000
# The same for both sides of a left join by size, and for a search for duplicate keys.
JOIN_ROWS, JOIN_TASK_ROWS = 1_000_000, 250_000
# Least share of the rows for which frequent items are looked up: a row may cost a look at one over it.
_LEAST_SHARE = 1e-3


def left_join(left: DataFrame, right: DataFrame, key: str, *, spread_nulls: bool = True) -> DataFrame:
    """Left outer equi-join on ``key``; the key appears once.

    Rows with a NULL key match nothing, yet a plain join would hash all of them to
    one task.  They get a slot number next to the key so that they spread out; a
    slot is the number of the input partition, which does not change when a lost
    task runs again.  Other hot keys are left to adaptive skew splitting, which a
    left outer join allows on its left side.  ``spread_nulls=False`` is for sides
    known to have no NULL keys: consecutive joins on the key then share a shuffle.
    """
    if not spread_nulls:
        return left.join(right, key, "left").select(*left.columns, *[c for c in right.columns if c != key])
    slot = F.when(F.col(key).isNull(), F.pmod(F.spark_partition_id(), F.lit(_NULL_SLOTS)) + 1).otherwise(0)
    spread = left.withColumn("_slot", slot)
    keyed = right.filter(F.col(key).isNotNull()).withColumn("_slot", F.lit(0))
    return spread.join(keyed, [key, "_slot"], "left").drop("_slot").select(
        *left.columns, *[c for c in right.columns if c != key]
    )


def left_join_by_size(left: DataFrame, right: DataFrame, key: str, *, left_rows: int | None = None) -> DataFrame:
    """:func:`left_join`, in as many tasks as the rows ask for.

    The rows are counted; a small ``left_rows`` may say how many the left side has at most.  Above
    :data:`JOIN_ROWS` of both sides, a right side that is too large to be broadcast is joined
    in tasks of about :data:`JOIN_TASK_ROWS`.  A left key with more rows than a task's share
    spreads over slots, and its right rows have a copy in every slot.
    """
    left_rows = left.count() if left_rows is None or left_rows > JOIN_ROWS else left_rows
    right_rows = right.count()
    if left_rows + right_rows <= JOIN_ROWS:
        return left_join(left, right, key)
    # A value measures 16 bytes at least, so that many rows need not be read to be too large.
    if right_rows * len(right.columns) * 16 <= BROADCAST_BYTES and (sent := broadcast_if_small(right)) is not right:
        return left_join(left, sent, key)
    tasks = task_count(left.sparkSession, left_rows + right_rows, JOIN_TASK_ROWS)
    slot = F.when(F.col(key).isNull(), F.pmod(F.spark_partition_id(), F.lit(_NULL_SLOTS)) + 1)
    spread, keyed, slots = left, right.filter(F.col(key).isNotNull()), F.array(F.lit(0))
    hot = frequent_keys(left, key, left_rows, max(JOIN_TASK_ROWS, int(left_rows * _LEAST_SHARE)))
    if hot is not None:
        marked = F.broadcast(hot.select(key, F.lit(True).alias("_hot")))
        spread, keyed = (df.join(marked, key, "left") for df in (spread, keyed))
        # From a row's values and partition, so that a lost task which runs again deals it alike.
        plain = [F.col(f.name) for f in left.schema if isinstance(f.dataType, T.AtomicType)]
        slot = slot.when(F.col("_hot"), F.pmod(F.xxhash64(*plain, F.spark_partition_id()), F.lit(tasks)).cast("int"))
        slots = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(tasks - 1))).otherwise(slots)
    spread, keyed = spread.withColumn("_slot", slot.otherwise(0)), keyed.withColumn("_slot", F.explode(slots))
    sides = [df.drop("_hot").repartition(tasks, key, "_slot") for df in (spread, keyed)]
    return sides[0].join(sides[1], [key, "_slot"], "left").select(
        *left.columns, *[c for c in right.columns if c != key]
    )


def frequent_keys(df: DataFrame, key: str, rows: int, share: int) -> DataFrame | None:
    """Stored non-NULL keys with more than ``share`` rows and their number ``_n``; None if there are none.

    ``rows`` is how many ``df`` has, at most.  One pass finds the few keys that may be frequent,
    a second one counts them, so no table of all keys is built.
    """
    if rows <= share:
        return None
    known = df.filter(F.col(key).isNotNull()).select(key)
    if share / rows >= _LEAST_SHARE:
        items = known.select(F.col(key).alias("_k")).freqItems(["_k"], share / rows)
        maybe, _ = materialize(items.select(F.explode("_k_freqItems").alias(key)), "frequent")
        known = known.join(F.broadcast(maybe), key, "left_semi")
    counts = known.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    keys, n = materialize(counts.filter(F.col("_n") > share), "hot")
    return keys if n else None


def keep_ids(df: DataFrame, ids: DataFrame | Iterable[int], key: str = "transaction_id") -> DataFrame:
    """Rows whose key is among ``ids`` (values or a frame); no ids keep no rows."""
    if not isinstance(ids, DataFrame):
        schema = T.StructType([T.StructField(key, T.LongType())])
        ids = df.sparkSession.createDataFrame([(int(v),) for v in set(ids)], schema)
    return df.join(ids.select(F.col(key).cast(df.schema[key].dataType).alias(key)).distinct(), key, "left_semi")


def is_subset(part: DataFrame, whole: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys of ``part``, how many ``whole`` lacks, and whether none is lacking."""
    keys = part.select(key).distinct()
    lacking = keys.join(whole.select(key).distinct(), key, "left_anti")
    counted = keys.select(F.lit(1).alias("one"), F.lit(0).alias("gone")).unionAll(
        lacking.select(F.lit(0), F.lit(1))
    )
    sums = counted.agg(
        F.coalesce(F.sum("one"), F.lit(0)).alias("distinct_keys"),
        F.coalesce(F.sum("gone"), F.lit(0)).alias("lacking_keys"),
    )
    return sums.withColumn("is_subset", F.col("lacking_keys") == 0)


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    *,
    evolve: bool = False,
) -> DataFrame:
    """The target after a keyed merge of ``source``.

    Matched rows take every listed non-key column from the source, also its NULLs;
    unmatched source rows are added; columns that are not listed keep their value or
    are NULL on added rows.  NULL keys never match, so they are added.  A listed
    column that the target lacks is an error unless ``evolve`` adds it.

    Written as a left join plus an anti join rather than one full outer join: the
    left join can split a hot target key, and a small batch of changes is broadcast
    so that the target is not shuffled at all.  Source keys must be unique; see
    :func:`duplicate_keys`.

    Above :data:`UPSERT_ROWS` rows, which are counted, a batch that is too large to be
    broadcast is joined in as many tasks as the rows ask for; see :func:`_upsert_dealt`.
    """
    listed = list(columns if columns is not None else source.columns)
    if key not in listed:
        listed.insert(0, key)
    changed = [c for c in listed if c != key]
    if unknown := [c for c in listed if c not in source.columns]:
        raise ValueError(f"source lacks columns {unknown}")
    added = [c for c in changed if c not in target.columns]
    if added and not evolve:
        raise ValueError(f"target lacks columns {added}; pass evolve=True to add them")
    layout = [*target.columns, *added]
    kinds = {**{c: source.schema[c].dataType for c in added}, **{f.name: f.dataType for f in target.schema}}

    incoming = source.select(
        F.col(key).cast(kinds[key]).alias(key),
        F.lit(True).alias("_new"),
        *[F.col(c).cast(kinds[c]).alias(f"_n_{c}") for c in changed],
    )

    def value(name: str):
        if name not in changed:
            return F.col(name)
        old = F.col(name) if name in target.columns else F.lit(None).cast(kinds[name])
        return F.when(F.col("_new"), F.col(f"_n_{name}")).otherwise(old).alias(name)

    rows = target.count() + source.count()
    if rows > UPSERT_ROWS:
        sent = broadcast_if_small(incoming)
        if sent is incoming:
            merged = _upsert_dealt(target, incoming, key, task_count(target.sparkSession, rows, UPSERT_TASK_ROWS))
            return merged.select(*[value(c) for c in layout])
        incoming = sent
    merged = left_join(target, incoming, key)
    updated = merged.select(*[value(c) for c in layout])
    # Target keys that this batch touches: as few as the batch has rows.
    touched = target.select(key).join(incoming.select(key), key, "left_semi").distinct()
    fresh = incoming.join(touched, key, "left_anti").select(
        *[
            F.col(key)
            if c == key
            else (F.col(f"_n_{c}") if c in changed else F.lit(None).cast(kinds[c])).alias(c)
            for c in layout
        ]
    )
    return updated.unionByName(fresh)


def _upsert_dealt(target: DataFrame, incoming: DataFrame, key: str, tasks: int) -> DataFrame:
    """Full outer join on ``key``, in ``tasks`` tasks of which none gets a hot key as a whole.

    NULL keys match nothing and spread over slots.  The rows of a target key that may own more
    than a task's share spread as well, and its source row has a copy in every slot.  Such a
    key is in the target, so a copy that meets no row there is not an added row and goes.
    The slot of a row follows from its values and its partition, and the frequent keys are
    stored, so that both sides agree also when a lost task runs again.
    """
    counted = target.filter(F.col(key).isNotNull()).select(F.col(key).alias("_k"))
    frequent, _ = materialize(counted.freqItems(["_k"], max(1 / tasks, 1e-3)).toDF("_often"), "frequent")
    plain = [F.col(f.name) for f in target.schema if isinstance(f.dataType, T.AtomicType)]
    own = F.pmod(F.xxhash64(*plain, F.spark_partition_id()), F.lit(tasks)).cast("int")
    often = F.coalesce(F.array_contains("_often", F.col(key)), F.lit(False))
    null_slot = F.pmod(F.spark_partition_id(), F.lit(_NULL_SLOTS))
    slot = F.when(F.col(key).isNull(), null_slot).when(often, own).otherwise(0)
    old = target.crossJoin(F.broadcast(frequent)).withColumns({"_slot": slot, "_old": F.lit(True)}).drop("_often")
    slots = F.when(F.col(key).isNull(), F.array(null_slot))
    slots = slots.when(often, F.sequence(F.lit(0), F.lit(tasks - 1))).otherwise(F.array(F.lit(0)))
    new = incoming.crossJoin(F.broadcast(frequent)).withColumns({"_copy": often, "_slot": slots}).drop("_often")
    new = new.withColumn("_slot", F.explode("_slot"))
    sides = [df.repartition(tasks, key, "_slot") for df in (old, new)]
    return sides[0].join(sides[1], [key, "_slot"], "full").filter("_old OR NOT _copy")


def duplicate_keys(source: DataFrame, key: str, *, rows: int | None = None) -> DataFrame:
    """Non-NULL keys that occur more than once, with their count.

    A caller who knows how many ``rows`` there are has many of them counted in as many tasks
    as they ask for; keys with more than a task's share are counted apart.
    """
    known = source.filter(F.col(key).isNotNull()).select(key)
    hot = None
    if rows is not None and rows > JOIN_ROWS:
        hot = frequent_keys(known, key, rows, max(JOIN_TASK_ROWS, int(rows * _LEAST_SHARE)))
        if hot is not None:
            known = known.join(F.broadcast(hot.select(key)), key, "left_anti")
        known = known.repartition(task_count(source.sparkSession, rows, JOIN_TASK_ROWS), key)
    copies = known.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    return copies if hot is None else copies.unionAll(hot)


def latest_per_key(source: DataFrame, key: str, order: str) -> DataFrame:
    """One row per non-NULL key, the one with the largest ``order``; NULL keys all stay.

    A grouped maximum, so that many versions of one key combine before the shuffle.
    """
    others = [c for c in source.columns if c not in (key, order)]
    newest = (
        source.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(order, *others)).alias("_r"))
        .select(key, "_r.*")
        .select(*source.columns)
    )
    return newest.unionByName(source.filter(F.col(key).isNull()))
