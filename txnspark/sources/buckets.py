"""Tables cut into buckets of keys, so that an upsert reads and writes only what its batch touches.

A bucket is a partition of the table: a range of whole-number keys, which suits keys that grow with
time, or a share of the keys' hashes.  How keys are dealt is kept in the table's properties.  An
upsert prunes the table to the buckets of its batch, merges, writes the new buckets to a folder
of their own, and only then points the partitions there, one by one.  A job that dies before that
changes nothing; one that dies between two partitions leaves whole buckets, old or new, and the
same upsert done again completes it.  Old folders stay for readers until :func:`drop_unused`.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnspark.operators.joins import duplicate_keys, upsert
from txnspark.scratch import materialize
from txnspark.sources.tables import delete_folder, table_details

BUCKET = "_bucket"
_FOLDER = "_upserts"
_PROPERTY = "txnspark.buckets."


@dataclass(frozen=True)
class Buckets:
    """Keys dealt by ranges of ``width`` whole numbers, or by hash to ``number`` buckets; NULL keys have one of their own."""

    key: str
    number: int | None = None
    width: int | None = None

    def __post_init__(self):
        if (self.number is None) == (self.width is None) or (self.number or self.width) < 1:
            raise ValueError("buckets need either a number or a width, of 1 or more")

    def of(self, key: Column) -> Column:
        if self.width is not None:
            whole = key.cast("long")
            place = F.call_function("div", whole - F.pmod(whole, F.lit(self.width)), F.lit(self.width))
        else:
            place = F.when(key.isNotNull(), F.pmod(F.xxhash64(key), F.lit(self.number)))
        return F.coalesce(place.cast("string"), F.lit("none"))


def create_bucketed(df: DataFrame, table: str, buckets: Buckets, *, provider: str = "parquet") -> None:
    """A new table of the rows of ``df`` with one folder of files per bucket."""
    dealt = df.withColumn(BUCKET, buckets.of(F.col(buckets.key)))
    dealt.repartition(BUCKET).write.format(provider).partitionBy(BUCKET).saveAsTable(table)
    rule = {"key": buckets.key, **({"width": buckets.width} if buckets.width is not None else {"number": buckets.number})}
    told = ", ".join(f"'{_PROPERTY}{k}' = '{v}'" for k, v in rule.items())
    df.sparkSession.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({told})")


def bucket_rule(spark: SparkSession, table: str) -> Buckets:
    """How a table's keys are dealt."""
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if f"{_PROPERTY}key" not in held:
        raise ValueError(f"table {table} is not cut into buckets")
    sizes = {k: int(held[_PROPERTY + k]) for k in ("number", "width") if _PROPERTY + k in held}
    return Buckets(held[f"{_PROPERTY}key"], **sizes)


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    """The table's rows, without the bucket."""
    return spark.table(table).drop(BUCKET)


def merged_buckets(batch: DataFrame, table: str, columns: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """The buckets that a stored batch touches, as they are after the upsert, and their names.

    The table's part is not shuffled while the batch is small enough to be sent to it.
    """
    spark = batch.sparkSession
    rule = bucket_rule(spark, table)
    names = batch.select(rule.of(F.col(rule.key).cast(spark.table(table).schema[rule.key].dataType)).alias("b")).distinct()
    touched = sorted(r["b"] for r in names.collect())  # no more than the table's buckets and the batch's new ones
    part = spark.table(table).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
    merged = upsert(part, batch, rule.key, columns)
    return merged.withColumn(BUCKET, rule.of(F.col(rule.key))), touched


def upsert_bucketed(source: DataFrame, table: str, columns: Sequence[str] | None = None) -> int:
    """Keyed merge of ``source`` into a bucketed table; returns the source row count.

    The rules are those of :func:`txnspark.operators.joins.upsert`; duplicate non-NULL keys in the
    source are an error, and an empty source changes nothing.
    """
    spark = source.sparkSession
    batch, rows = materialize(source, "upsert")
    if not rows:
        return 0
    key = bucket_rule(spark, table).key
    if copies := duplicate_keys(batch, key, rows=rows).limit(5).collect():
        raise ValueError(f"source has duplicate keys in {key}: {[r[key] for r in copies]}")
    merged, touched = merged_buckets(batch, table, columns)
    details = table_details(spark, table)
    folder = f"{details['Location'].rstrip('/')}{_FOLDER}/{uuid.uuid4().hex}"
    merged.write.format(details["Provider"].lower()).partitionBy(BUCKET).save(folder)
    held = {r["partition"].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for name in touched:
        _point(spark, table, name, f"{folder}/{BUCKET}={name}", name in held)
    spark.catalog.refreshTable(table)
    return rows


def _point(spark: SparkSession, table: str, name: str, folder: str, held: bool) -> None:
    change = "PARTITION ({}) SET" if held else "ADD PARTITION ({})"
    spark.sql(f"ALTER TABLE {table} {change.format(f'{BUCKET} = {name!r}')} LOCATION '{folder}'")


def drop_unused(spark: SparkSession, table: str) -> int:
    """Deletes upserts' folders of buckets that the table points to no more; returns their number.

    For times without readers of older states and without writers.
    """
    root = table_details(spark, table)["Location"].rstrip("/") + _FOLDER
    used = set()
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        name = row["partition"].partition("=")[2]
        told = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({BUCKET} = {name!r})")
        used.add(told.filter("col_name = 'Location'").first()["data_type"].rstrip("/"))
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = 0
    for upserted in fs.listStatus(path) if fs.exists(path) else []:
        for bucket in fs.listStatus(upserted.getPath()):
            place = bucket.getPath().toString()
            if bucket.isDirectory() and place not in used:
                delete_folder(spark, place)
                gone += 1
    return gone
