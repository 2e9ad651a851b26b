"""Catalog tables: scans, overwrite, keyed upsert.

Table formats with row-level operations (Delta, Iceberg) use ``MERGE`` and their own
overwrite.  A plain file table is replaced by writing a new snapshot folder next to
it and pointing the table there, so that a table may be rewritten from itself, is
written once, and keeps its old content if a job dies half way.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txnspark.operators.joins import duplicate_keys, latest_per_key, upsert
from txnspark.scratch import materialize
from txnspark.schemas import ddl

ROW_LEVEL = ("delta", "iceberg", "hudi")
_SNAPSHOTS = "_snapshots"
_NEXT, _PRIOR = "__next", "__prior"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by its qualified name."""
    return spark.table(name)


def table_details(spark: SparkSession, table: str) -> dict[str, str]:
    """Provider, location and type (managed or external) of a table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name in ('Provider', 'Location', 'Type')").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def _in_catalog(table: str) -> str:
    """The name without its catalog, as the new name of a renamed table has to be."""
    return ".".join(table.split(".")[-2:])


def _snapshot_root(location: str) -> str:
    """The table's folder for snapshots: its first location with a suffix."""
    return location.rstrip("/").partition(f"{_SNAPSHOTS}/")[0] + _SNAPSHOTS


def _drop_old_snapshots(spark: SparkSession, root: str, keep: Sequence[str]) -> None:
    """Delete snapshot folders except the current and the previous one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    kept = {k.rstrip("/").rsplit("/", 1)[-1] for k in keep}
    for status in fs.listStatus(path):
        if status.getPath().getName() not in kept:
            fs.delete(status.getPath(), True)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def overwrite_table(df: DataFrame, table: str) -> int:
    """Replace a table's rows and columns by ``df``; returns the row count of the write.

    The new rows are written before the old ones go.  A job that died between two renames
    left the old table under another name, from which the next call takes it back.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(f"{table}{_PRIOR}"):
        spark.sql(f"ALTER TABLE {table}{_PRIOR} RENAME TO {_in_catalog(table)}")
    spark.sql(f"DROP TABLE IF EXISTS {table}{_PRIOR}")
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if not spark.catalog.tableExists(table):
        counted.write.saveAsTable(table)
        return seen.get["rows"]
    details = table_details(spark, table)
    provider = details["Provider"].lower()
    if provider in ROW_LEVEL:
        counted.write.format(provider).mode("overwrite").option("overwriteSchema", True).saveAsTable(table)
        return seen.get["rows"]

    root = _snapshot_root(details["Location"])
    old = [(f.name, f.dataType) for f in spark.table(table).schema]
    new = [(f.name, f.dataType) for f in df.schema]
    if new[: len(old)] != old and details["Type"].upper() == "MANAGED":
        # Other columns need a new table, which is written and then takes the old one's name.
        fresh = f"{table}{_NEXT}"
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        counted.write.format(provider).saveAsTable(fresh)
        spark.sql(f"ALTER TABLE {table} RENAME TO {_in_catalog(table)}{_PRIOR}")
        # The renamed table took its files along; what still lies under the name is an older content.
        delete_folder(spark, root.removesuffix(_SNAPSHOTS))
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {_in_catalog(table)}")
        spark.sql(f"DROP TABLE {table}{_PRIOR}")
        delete_folder(spark, root)
        return seen.get["rows"]
    path = f"{root}/{uuid.uuid4().hex}"
    counted.write.format(provider).save(path)
    if new[: len(old)] == old:
        if len(new) > len(old):
            added = ddl(type(df.schema)(df.schema.fields[len(old) :]))
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    else:
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"CREATE TABLE {table} ({ddl(df.schema)}) USING {provider} LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    _drop_old_snapshots(spark, root, [path, details["Location"]])
    if details["Type"].upper() == "MANAGED" and details["Location"].startswith(f"{root}/"):
        # The previous content is a snapshot, so the folder that the table began with is of no use.
        delete_folder(spark, root.removesuffix(_SNAPSHOTS))
    return seen.get["rows"]


def merge_statement(table: str, view: str, key: str, columns: Sequence[str], *, evolve: bool = False) -> str:
    """``MERGE`` of a view into a table of a format with row-level operations.

    Matched rows take every listed column but the key, others are added; NULL keys match nothing.
    """

    def quoted(name: str) -> str:
        return "`" + name.replace("`", "``") + "`"

    changed = [quoted(c) for c in columns if c != key]
    every = [quoted(key), *changed]
    update = f"WHEN MATCHED THEN UPDATE SET {', '.join(f't.{c} = s.{c}' for c in changed)} " if changed else ""
    return (
        f"MERGE {'WITH SCHEMA EVOLUTION ' if evolve else ''}INTO {table} AS t USING {quoted(view)} AS s "
        f"ON t.{quoted(key)} = s.{quoted(key)} {update}"
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(every)}) VALUES ({', '.join(f's.{c}' for c in every)})"
    )


def upsert_table(
    source: DataFrame,
    table: str,
    key: str,
    columns: Sequence[str] | None = None,
    *,
    evolve: bool = False,
    keep_latest_by: str | None = None,
    stored: bool = False,
) -> int:
    """Keyed merge of ``source`` into a table; returns the source row count.

    Duplicate non-NULL source keys are an error, or the row with the largest
    ``keep_latest_by`` wins.  An empty source changes nothing.  The source is read
    several times, so it is stored first unless the caller says that it is cheap.
    """
    spark = source.sparkSession
    listed = list(columns if columns is not None else source.columns)
    if keep_latest_by is not None:
        source = latest_per_key(source, key, keep_latest_by)
    batch, rows = (source, source.count()) if stored else materialize(source, "upsert")
    if rows == 0:
        return 0
    if keep_latest_by is None:
        copies = duplicate_keys(batch, key, rows=rows).limit(5).collect()
        if copies:
            raise ValueError(f"source has duplicate keys in {key}: {[r[key] for r in copies]}")
    provider = table_details(spark, table)["Provider"].lower()
    if provider in ROW_LEVEL:
        view = f"upsert_{uuid.uuid4().hex}"
        batch.createOrReplaceTempView(view)
        try:
            spark.sql(merge_statement(table, view, key, listed, evolve=evolve))
        finally:
            spark.catalog.dropTempView(view)
        return rows
    overwrite_table(upsert(spark.table(table), batch, key, listed, evolve=evolve), table)
    return rows


def write_features(
    features: DataFrame, table: str, key: str = "TransactionID", *, evolve: bool = False, stored: bool = False
) -> int:
    """Wide features: the first load adds its columns to the table, later loads merge by key."""
    spark = features.sparkSession
    if spark.table(table).isEmpty():
        return append_first(features, table, key, stored=stored)
    return upsert_table(features, table, key, evolve=evolve, stored=stored)


def append_first(source: DataFrame, table: str, key: str, *, stored: bool = False) -> int:
    """First load of an empty table: its columns and rows are written without a merge."""
    batch, rows = (source, source.count()) if stored else materialize(source, "append")
    if not rows:
        return 0
    copies = duplicate_keys(batch, key, rows=rows).limit(5).collect()
    if copies:
        raise ValueError(f"source has duplicate keys in {key}: {[r[key] for r in copies]}")
    known = [F.lit(None).cast(f.dataType).alias(f.name) for f in source.sparkSession.table(table).schema if f.name not in batch.columns]
    return overwrite_table(batch.select("*", *known), table)
