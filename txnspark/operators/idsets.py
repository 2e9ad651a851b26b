"""Sets of whole-number ids as bitmaps: exact membership without a shuffle of the rows that are tested.

A bitmap holds one bit for each of 32,768 neighbouring ids, so dense ids take an eighth of a byte
each: a billion of them some 125 MB, where a join would shuffle every row of both sides.  Bitmaps
are sent to the tasks while they are small, and otherwise met by their number, which spreads rows evenly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark.scratch import BROADCAST_BYTES, materialize

#: Bytes of a bitmap.
BITMAP_BYTES = 4096


@dataclass(frozen=True)
class IdSet:
    """Stored bitmaps (bucket, bits), their number, and whether a NULL was among the ids."""

    bitmaps: DataFrame
    buckets: int
    has_null: bool

    @property
    def bytes(self) -> int:
        return self.buckets * (BITMAP_BYTES + 8)


def id_set(ids: DataFrame, key: str) -> IdSet:
    """The set of the values of ``key``, a whole number; a task sends each of its bitmaps once."""
    whole = ids.select(F.col(key).cast("long").alias("_id"))
    counted = whole.groupBy(F.bitmap_bucket_number("_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("bits")
    )
    stored, _ = materialize(counted, "ids")
    some = stored.agg(F.count("bucket").alias("n"), F.count_if(F.col("bucket").isNull()).alias("nulls")).first()
    return IdSet(stored.filter("bucket IS NOT NULL"), some["n"], some["nulls"] > 0)


def _holds(bits: Column, place: Column) -> Column:
    """Whether a bitmap has the bit at ``place``; bits of a byte count from its lowest."""
    byte = F.conv(F.hex(F.substring(bits, (F.call_function("div", place, F.lit(8)) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def members(df: DataFrame, key: str, ids: IdSet, *, negate: bool = False, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows whose key is in the set, or those whose key is not; a NULL key is never in it."""
    bitmaps = ids.bitmaps.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    bitmaps = F.broadcast(bitmaps) if ids.bytes <= max_bytes else bitmaps
    whole = F.col(key).cast("long")
    met = df.join(bitmaps, F.bitmap_bucket_number(whole) == F.col("_bucket"), "left")
    held = F.coalesce(F.col("_bits").isNotNull() & _holds(F.col("_bits"), F.bitmap_bit_position(whole)), F.lit(False))
    return met.filter(~held if negate else held).drop("_bucket", "_bits")


def containment(part: IdSet, whole: IdSet) -> DataFrame:
    """One row, as :func:`txnspark.operators.joins.is_subset` gives it: distinct keys of ``part``, how many ``whole`` lacks, and whether none is.

    Only bitmaps are read: what ``whole`` lacks is what it would gain by the union of both.
    """
    both = part.bitmaps.select("bucket", "bits", F.lit(1).alias("one")).unionAll(whole.bitmaps.select("bucket", "bits", F.lit(0)))
    met = both.groupBy("bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("every"),
        F.sum(F.when(F.col("one") == 1, F.bitmap_count("bits")).otherwise(0)).alias("own"),
        F.sum(F.when(F.col("one") == 0, F.bitmap_count("bits")).otherwise(0)).alias("other"),
    )
    null = int(part.has_null)  # a NULL key counts as one that nothing holds
    sums = met.agg(
        (F.coalesce(F.sum("own"), F.lit(0)) + null).alias("distinct_keys"),
        (F.coalesce(F.sum(F.col("every") - F.col("other")), F.lit(0)) + null).alias("lacking_keys"),
    )
    return sums.withColumn("is_subset", F.col("lacking_keys") == 0)
