"""Shards by fixed virtual slots, in DataFrame functions only.

Every record is hashed to one of ``SLOTS`` slots for good.  Bytes are summed by slot, and a
small table, the map, says which shard holds a slot.  Balancing edits the map, never the hash:
shards above their share of the bytes give up their smallest slots, and shards below it are
filled with them.  Every edit is a version; versions are kept as a log of the slots that moved,
so an older one can still be read and a copy knows what to move.

The map has one row per slot whatever the number of records, so it may be sorted in one task
and sent to every executor.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark.scratch import broadcast_if_small, scratch_path

from .keyed import number_copies, repeated_names
from .store import stored

SLOTS = 4096
SHARDS = 16
#: Edits of a new map: each leaves smaller slots to move than the one before.
ROUNDS = 2


def _place(name: Column, number: Column) -> Column:
    return F.md5(F.concat_ws("|", name, number.cast("string")).cast("binary"))


def place_records(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS, keep: list[str] | None = None
) -> DataFrame:
    """Stored columns ``keep`` (all by default) with size, text_crc32, place and virtual_slot.

    A record's place hashes its id, its text and its number among records with the same id and
    text, so copies spread like any other records.  Columns of ``docs`` with these names are replaced.
    """
    own = ["size", "text_crc32", "place", "virtual_slot"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in own]
    text = F.col(text_col).cast("string").cast("binary")
    name = F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.md5(text), F.lit("")))
    records = stored(
        docs.select(
            *[F.col(c).alias(f"_k{k}") for k, c in enumerate(keep)],
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("").cast("binary"))).alias("text_crc32"),
            name.alias("_name"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "records",
    )
    repeated = broadcast_if_small(repeated_names(records, "_name"))
    numbered = number_copies(records.join(repeated, "_name", "left_semi"), "_name", "_number")
    single = records.join(repeated, "_name", "left_anti").withColumn("_number", F.lit(0).cast("long")).drop("_row")
    placed = single.unionByName(numbered).withColumn("place", _place(F.col("_name"), F.col("_number")))
    slot = F.pmod(F.conv(F.substring("place", 1, 8), 16, 10).cast("long"), F.lit(slots)).cast("int")
    return stored(
        placed.select(*[F.col(f"_k{k}").alias(c) for k, c in enumerate(keep)], "size", "text_crc32", "place", slot.alias("virtual_slot")),
        "placed",
    )


def slot_sizes(placed: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, bytes, records) of every slot, empty ones too."""
    found = placed.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("records"))
    every = placed.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(found, "virtual_slot", "left").fillna(0, ["bytes", "records"])


def first_map(sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Version 0: slots dealt to shards in turn."""
    return sizes.select(F.lit(0).alias("version"), "virtual_slot", (F.col("virtual_slot") % shards).alias("shard"))


def current(log: DataFrame, version: int | None = None) -> DataFrame:
    """(virtual_slot, shard) of the newest version of a log, or of the version asked for."""
    log = log if version is None else log.filter(F.col("version") <= version)
    return log.groupBy("virtual_slot").agg(F.max_by("shard", "version").alias("shard"))


def edit(sizes: DataFrame, mapped: DataFrame, version: int, shards: int = SHARDS) -> DataFrame:
    """The slots that move, as rows of the log under ``version``.

    A shard keeps its largest slots as far as they fit its share of all bytes.  The other slots,
    largest first, are laid along the gaps of the shards; the gap around a slot's middle takes it.
    ``shards`` may be larger than the number in the map: new shards start empty.
    """
    total = int(sizes.agg(F.sum("bytes")).first()[0] or 0)
    shares = [total * (s + 1) // shards - total * s // shards for s in range(shards)]
    share = f"element_at(array({', '.join(f'{x}L' for x in shares)}), shard + 1)"
    held = sizes.select("virtual_slot", "bytes").join(mapped, "virtual_slot")
    ranked = held.selectExpr(
        "*", f"{share} AS share", "sum(bytes) OVER (PARTITION BY shard ORDER BY bytes DESC, virtual_slot) AS upto"
    ).withColumn("stays", F.expr("upto <= share OR bytes = 0"))
    spilled = ranked.filter("NOT stays").selectExpr(
        "virtual_slot", "shard", "2 * sum(bytes) OVER (ORDER BY bytes DESC, virtual_slot) - bytes AS at"
    )
    every = sizes.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    kept = ranked.filter("stays").groupBy("shard").agg(F.sum("bytes").alias("kept"))
    gaps = every.join(kept, "shard", "left").selectExpr("shard", f"{share} - coalesce(kept, 0) AS gap")
    ends = gaps.selectExpr("NULL AS virtual_slot", "shard", "2 * sum(gap) OVER (ORDER BY shard) AS at")
    line = spilled.selectExpr("virtual_slot", "shard", "at", "0 AS is_end").union(ends.selectExpr("*", "1 AS is_end"))
    # The number of gaps that end at or before a slot's middle is the shard whose gap it lies in.
    filled = line.selectExpr(
        "virtual_slot", "shard", f"least(CAST(sum(is_end) OVER (ORDER BY at, is_end DESC) AS INT), {shards - 1}) AS target"
    )
    moved = filled.filter("virtual_slot IS NOT NULL AND target <> shard")
    return moved.select(F.lit(version).alias("version"), F.col("virtual_slot").cast("int"), F.col("target").alias("shard"))


def balanced_map(sizes: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, path: str | None = None) -> DataFrame:
    """The stored log of a new map: the first version and ``rounds`` edits, one folder per version below ``path``."""
    path = path or scratch_path(sizes.sparkSession, "map")
    log = _append(path, 0, first_map(sizes, shards))
    for version in range(1, rounds + 1):
        log = _append(path, version, edit(sizes, current(log), version, shards))
    return log


def grow(sizes: DataFrame, log: DataFrame, shards: int) -> DataFrame:
    """The log with one more version, balanced over ``shards`` shards."""
    version = log.agg(F.max("version")).first()[0] + 1
    return log.unionByName(edit(sizes, current(log), version, shards))


def _append(path: str, version: int, rows: DataFrame) -> DataFrame:
    """Writes a version's rows and reads all versions so far."""
    rows.coalesce(1).write.parquet(f"{path}/v={version}")
    spark = rows.sparkSession
    return reduce(DataFrame.union, [spark.read.schema("version int, virtual_slot int, shard int").parquet(f"{path}/v={v}") for v in range(version + 1)])


def shard_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    slots: int = SLOTS,
    rounds: int = ROUNDS,
    keep: list[str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Columns ``keep`` (all by default) with size, text_crc32, virtual_slot, shard and slot.

    ``size`` is the text's UTF-8 bytes plus 1; shards get near equal sums of it.  ``slot`` numbers
    a shard's records from 0, by virtual slot and place.  A null text counts as none and has the
    checksum of the empty text; null ids, empty and long texts are records like any others, and
    equal records get places of their own.  No records give no rows.  Columns of ``docs`` with the
    names of new ones are replaced.  The log of the map is stored below ``path``.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("shard", "slot")]
    placed = place_records(docs, id_col=id_col, text_col=text_col, slots=slots, keep=keep)
    sizes = stored(slot_sizes(placed, slots), "sizes")
    mapped = current(balanced_map(sizes, shards, rounds, path)).join(sizes, "virtual_slot")
    first = "coalesce(sum(records) OVER (PARTITION BY shard ORDER BY virtual_slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    mapped = mapped.selectExpr("virtual_slot", "shard", f"{first} AS _first")
    inside = placed.selectExpr("*", "row_number() OVER (PARTITION BY virtual_slot ORDER BY place) - 1 AS _in")
    out = inside.join(F.broadcast(mapped), "virtual_slot")  # one row per slot
    kept = [c for c in keep if c not in ("size", "text_crc32", "place", "virtual_slot")]
    return out.select(*kept, "size", "text_crc32", "virtual_slot", "shard", (F.col("_first") + F.col("_in")).alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder of files per shard."""
    sharded.write.partitionBy("shard").parquet(path)


def _round_sql(k: int) -> str:
    share = "(total * (shard + 1)) // {0} - (total * shard) // {0}".format(SHARDS)
    return f"""
r{k} AS (SELECT *, {share} AS share, sum(bytes) OVER (PARTITION BY shard ORDER BY bytes DESC, vs) AS upto FROM m{k - 1}),
s{k} AS (SELECT vs, 2 * sum(bytes) OVER (ORDER BY bytes DESC, vs) - bytes AS at FROM r{k} WHERE NOT (upto <= share OR bytes = 0)),
g{k} AS (SELECT e.shard, {share} - coalesce((SELECT sum(bytes) FROM r{k} WHERE r{k}.shard = e.shard AND (upto <= share OR bytes = 0)), 0) AS gap
         FROM (SELECT range AS shard, (SELECT max(total) FROM m0) AS total FROM range({SHARDS})) e),
e{k} AS (SELECT shard, 2 * sum(gap) OVER (ORDER BY shard) AS at FROM g{k}),
t{k} AS (SELECT vs, least((SELECT count(*) FROM e{k} WHERE e{k}.at <= s{k}.at), {SHARDS - 1}) AS target FROM s{k}),
m{k} AS MATERIALIZED (SELECT m.vs, bytes, records, total, coalesce(target, shard) AS shard FROM m{k - 1} m LEFT JOIN t{k} t ON m.vs = t.vs),"""


ORACLE = f"""
WITH tab AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY i) AS tab
             FROM range(256) r(i)),
b AS (SELECT doc_id, text, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes FROM documents),
d AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
             xor(list_reduce(list_concat([4294967295::BIGINT], bytes), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32,
             coalesce(doc_id::VARCHAR, '') || '|' || coalesce(md5(text), '') AS name FROM b, tab),
p AS (SELECT *, md5(name || '|' || (row_number() OVER (PARTITION BY name) - 1)) AS place FROM d),
v AS MATERIALIZED (SELECT *, ('0x' || substr(place, 1, 8))::BIGINT % {SLOTS} AS vs FROM p),
z AS (SELECT s.range AS vs, coalesce(sum(size), 0)::BIGINT AS bytes, count(v.vs) AS records FROM range({SLOTS}) s LEFT JOIN v ON v.vs = s.range GROUP BY 1),
m0 AS MATERIALIZED (SELECT vs, bytes, records, sum(bytes) OVER () AS total, vs % {SHARDS} AS shard FROM z),
{"".join(_round_sql(k) for k in range(1, ROUNDS + 1))}
o AS (SELECT v.*, shard FROM v JOIN m{ROUNDS} m ON v.vs = m.vs)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY vs, place) - 1 AS slot, NULL::INT AS grown_shard
FROM o
"""
