"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the total by its weight.  A source whose share exceeds
``epochs`` times its size is held there and the excess is shared again among the
others by weight, until no share is above.  A source is then taken in whole
repetitions and one seeded fractional one: documents in the order of a hash, up to
the point that comes nearest to the target.

That point is found from sums by (source, hash prefix); only the documents behind the
one prefix in which a source's point lies are put in order.  So no source has to fit
one task, and texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnspark.scratch import broadcast_if_small, materialize

from .keyed import number_copies, repeated_names
from .store import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = "mix"
#: Hex digits of the hash by which sizes are summed first.
PREFIX = 3
#: Sources that may be broadcast.
BROADCAST_SOURCES = 100_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """``sources`` (size, weight) with ``target``: shares of the total size, none above epochs * size."""
    cap = F.col("size").cast("decimal(38,0)") * epochs
    held = F.lit(False)
    while True:
        total, rest, weight, n = sources.agg(
            F.sum("size"),
            F.sum("size") - F.coalesce(F.sum(F.when(held, F.col("size") * epochs)), F.lit(0)),
            F.sum(F.when(~held, F.col("weight"))),
            F.count_if(held),
        ).first()
        if not total or not weight:
            return sources.withColumn("target", cap.cast("double") if total else F.lit(0.0))
        above = F.col("weight").cast("decimal(38,0)") * F.lit(rest) > cap * F.lit(weight)
        if sources.agg(F.count_if(above)).first()[0] == n:
            share = (F.col("weight") * F.lit(rest)).cast("double") / F.lit(float(weight))
            return sources.withColumn("target", F.when(held, cap.cast("double")).otherwise(share))
        held = above


def plan(rows: DataFrame, weights: tuple[int, ...], epochs: int) -> DataFrame:
    """One row per source: size, target, whole repetitions, last hash of the fractional one."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    picked = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    filled = water_fill(stored(sizes.withColumn("weight", picked.cast("long")), "sources"), epochs)
    whole = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0)
    filled = stored(
        filled.withColumn("whole", whole.cast("long")).withColumn("part", F.col("target") - F.col("whole") * F.col("size")),
        "targets",
    )
    same = F.col("source").eqNullSafe(F.col("s"))
    slots = rows.groupBy("source", F.substring("hash", 1, PREFIX).alias("prefix")).agg(F.sum("size").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("source").orderBy("prefix"))
    small = filled.select(F.col("source").alias("s"), "part").filter("part > 0")
    crossed = (
        slots.withColumn("upto", upto)
        .join(small, same)
        .filter("upto - n < part AND upto >= part")
        .select("s", "prefix", (F.col("upto") - F.col("n")).alias("before"), "part")
    )
    crossed = stored(crossed, "crossed")
    near = rows.join(crossed, same & (F.substring("hash", 1, PREFIX) == F.col("prefix")))
    near = near.groupBy("s", "prefix", "before", "part", "hash").agg(F.sum("size").alias("n"))
    order = Window.partitionBy("s").orderBy("hash")
    taken = near.withColumn("upto", F.col("before") + F.sum("n").over(order)).filter("2 * upto - n < 2 * part")
    last = taken.groupBy("s").agg(F.max("hash").alias("hash"))
    ends = crossed.alias("c").join(last.alias("l"), F.col("c.s").eqNullSafe(F.col("l.s")), "left")
    ends = ends.select("c.s", F.coalesce("l.hash", "c.prefix").alias("last"))
    return filled.join(ends, same, "left").select("source", "size", "target", "whole", "last")


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: str = SEED,
    keep: list[str] | None = None,
) -> DataFrame:
    """Columns ``keep`` (all by default) with size, source_size, target, copies and taken, one row per input row.

    ``copies`` says how often the mix takes the row, ``taken`` is copies * size: the words it takes.
    Sources are weighed in code point order, a null source last and as a source of its
    own.  Null, empty and blank texts have size 0 and are not taken.  The order of the fractional
    repetition is by a hash of source, id and text and of a row's number among equal ones, so that it may end
    among copies; a null id counts as an empty one.  Columns of ``docs`` named like a result are replaced.
    """
    names = ["size", "source_size", "target", "copies", "taken"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]
    source, text = F.col(source_col).cast("string"), F.col(text_col).cast("string").cast("binary")
    parts = [F.coalesce(c, F.lit("")) for c in (source, F.col(id_col).cast("string"), F.md5(text))]
    name = F.concat_ws("|", *parts, source.isNull().cast("string"))
    read = docs.select(source.alias("source"), n_words(F.col(text_col)).alias("size"), name.alias("_name"))
    read = stored(read.withColumn("_row", F.monotonically_increasing_id()), "sizes")
    repeated = repeated_names(read, "_name")
    few, several = broadcast_if_small(repeated), not repeated.isEmpty()

    def hashed(df: DataFrame, to: str) -> DataFrame:
        """Rows with their place in the order; ``_row`` is there for copies to be numbered."""
        numbered = df.withColumn("_number", F.lit(0).cast("long")).drop("_row")
        if several:
            copies = number_copies(stored(df.join(few, "_name", "left_semi"), "copies"), "_name", "_number")
            numbered = numbered.join(few, "_name", "left_anti").unionByName(copies)
        place = F.md5(F.concat_ws("|", F.lit(seed), "_name", F.col("_number").cast("string")).cast("binary"))
        return numbered.withColumn(to, place).drop("_name", "_number")

    rows = stored(hashed(read, "hash"), "places") if several else hashed(read, "hash")
    targets, n = materialize(plan(rows, weights, epochs), "plan")
    targets = targets.select(
        F.col("source").alias("_source"),
        F.col("size").alias("source_size"),
        "target",
        F.col("whole").alias("_whole"),
        F.col("last").alias("_last"),
    )
    # ``docs`` is read again, so that no text was written; its sizes are counted once more.
    own = [F.col(c).alias(f"_k{k}") for k, c in enumerate(keep)]
    full = docs.select(*own, source.alias("_from"), n_words(F.col(text_col)).alias("size"), name.alias("_name"))
    full = hashed(full.withColumn("_row", F.monotonically_increasing_id()), "_hash")
    full = full.join(
        F.broadcast(targets) if n <= BROADCAST_SOURCES else targets, F.col("_from").eqNullSafe(F.col("_source")), "left"
    )
    times = F.col("_whole") + F.coalesce((F.col("_hash") <= F.col("_last")).cast("long"), F.lit(0))
    full = full.withColumn("copies", F.when(F.col("size") > 0, times).otherwise(0))
    full = full.withColumn("taken", F.col("size") * F.col("copies"))
    return full.select(*[F.col(f"_k{k}").alias(c) for k, c in enumerate(keep)], *names)


ORACLE = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}|' || name || '|' || (row_number() OVER (PARTITION BY name) - 1)) AS h
  FROM (SELECT *, coalesce(source, '') || '|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(md5(text), '') || '|' || (source IS NULL) AS name
        FROM documents)),
s AS (
  SELECT source, sum(size)::BIGINT AS size,
         [{", ".join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1]::BIGINT AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, (sum(size) OVER ())::BIGINT
              - {EPOCHS} * coalesce((sum(size) OVER (ORDER BY size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 0)::BIGINT AS rest,
         (sum(w) OVER (ORDER BY size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weight
  FROM s),
-- the sources before the first that fits are held at their cap
f AS (SELECT rest, weight, size / w AS edge FROM o WHERE rest * w <= {EPOCHS} * size * weight ORDER BY size / w, source NULLS LAST LIMIT 1),
t AS (
  SELECT s.source, s.size, s.w,
         CASE WHEN f.rest * s.w > {EPOCHS} * s.size * f.weight THEN ({EPOCHS} * s.size)::DOUBLE
              ELSE (s.w * f.rest)::DOUBLE / f.weight::DOUBLE END AS target
  FROM s, f),
r AS (SELECT *, CASE WHEN size > 0 THEN floor(target / size)::BIGINT ELSE 0 END AS whole FROM t),
u AS (SELECT source, h, sum(size)::BIGINT AS n FROM d GROUP BY source, h),
c AS (SELECT source, h, n, (sum(n) OVER (PARTITION BY source ORDER BY h))::BIGINT AS upto FROM u)
SELECT d.doc_id, d.size, r.size AS source_size, r.target,
       d.size * (r.whole + CASE WHEN 2 * c.upto - c.n < 2 * (r.target - r.whole * r.size) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
       JOIN c ON c.source IS NOT DISTINCT FROM d.source AND c.h = d.h
"""
