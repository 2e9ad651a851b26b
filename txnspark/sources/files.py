"""Raw files: typed CSV scans, the raw pair, and file checks."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from txnspark.operators.joins import left_join_by_size
from txnspark.operators.ordered import TOP_ROWS, first_rows
from txnspark.scratch import materialize

KEY = "TransactionID"
# Raw columns by type; everything else is a double.
_RAW_TYPES = (
    (r"^(TransactionID)$", T.LongType()),
    (r"^(isFraud|TransactionDT)$", T.IntegerType()),
    (r"^(ProductCD|card4|card6|[PR]_emaildomain|M\d+|Device\w+)$", T.StringType()),
    (r"^id[_-](12|15|16|23|27|28|29|30|31|33|34|35|36|37|38)$", T.StringType()),
)


def raw_type(name: str) -> T.DataType:
    """Type of a raw column, by its name."""
    return next((kind for pattern, kind in _RAW_TYPES if re.search(pattern, name)), T.DoubleType())


def raw_schema(columns: Iterable[str], *, compact: bool = False) -> T.StructType:
    """Schema for a raw header; ``compact`` narrows id and label and stores floats in four bytes."""
    narrow = {"TransactionID": T.IntegerType(), "isFraud": T.ByteType()}
    fields = []
    for name in columns:
        kind = raw_type(name)
        if compact:
            kind = narrow.get(name, T.FloatType() if isinstance(kind, T.DoubleType) else kind)
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, *, infer: bool = False, compact: bool = False
) -> DataFrame:
    """CSV with a header.

    Without a schema the types follow the column names, which reads one line instead
    of the whole file; ``infer`` asks for Spark's inference, one extra full scan.
    A missing path is an error.
    """
    reader = spark.read.option("header", True)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    if schema is None:
        schema = raw_schema(reader.csv(path).columns, compact=compact)
    return reader.schema(schema).csv(path)


def first_in_files(df: DataFrame, n: int | None, *, top_rows: int = TOP_ROWS) -> DataFrame:
    """First ``n`` rows of scanned files in the order of the files: by path, place in the file, and line.

    ``df`` is a scan, or columns of one.  None or a negative number keeps all.  A few rows are a top-n in
    every task; more are cut by looking up the n-th place in a stored copy.
    """
    if n is None or n < 0:
        return df
    # Lines of one part of a file are read by one task, in order.
    place = {
        "_file": F.col("_metadata.file_path"),
        "_block": F.col("_metadata.file_block_start"),
        "_line": F.monotonically_increasing_id(),
    }
    placed = df.select("*", *[c.alias(k) for k, c in place.items()])
    if n <= top_rows:
        return placed.orderBy(*place).limit(n).drop(*place)
    kept, _ = materialize(placed, "raw")
    return first_rows(kept, n, list(place), one_task_rows=top_rows).drop(*place)


def merge_raw(
    transactions: DataFrame, identities: DataFrame, *, limit: int | None = None, rows: int | None = None
) -> DataFrame:
    """Raw transactions, cut to the first ``limit`` by id, with their identity row if any.

    The identity side keeps its own columns; names present on both sides get ``_id``.
    ``rows`` may say how many transactions there are at most; else they are counted.
    """
    most = rows if limit is None or limit < 0 else limit
    clash = [c for c in identities.columns if c in transactions.columns and c != KEY]
    renamed = identities.withColumnsRenamed({c: f"{c}_id" for c in clash})
    return left_join_by_size(first_rows(transactions, limit, [KEY]), renamed, KEY, left_rows=most)


def load_raw(
    spark: SparkSession,
    transaction_path: str,
    identity_path: str,
    *,
    limit: int | None = None,
    infer: bool = False,
    schemas: Mapping[str, T.StructType] | None = None,
) -> DataFrame:
    """Scan the raw pair and merge it; ``limit`` keeps the first transactions in the order of the file."""
    schemas = schemas or {}
    transactions = read_csv(spark, transaction_path, schemas.get("transaction"), infer=infer)
    identities = read_csv(spark, identity_path, schemas.get("identity"), infer=infer)
    rows = None if limit is None or limit < 0 else limit
    return merge_raw(first_in_files(transactions, limit), identities, rows=rows)


_INVENTORY = "file string, exists boolean, size_mb double, rows long"


def file_inventory(spark: SparkSession, files: Mapping[str, str]) -> DataFrame:
    """Per named file: whether it exists, its size in MB (two decimals) and its data rows.

    Sizes come from the listing; the file's bytes are only read to count lines.
    """
    out = None
    for name, path in files.items():
        try:
            listed = spark.read.format("binaryFile").load(path).agg(F.sum("length").alias("bytes"), F.count("path").alias("n"))
            lines = spark.read.text(path).agg(F.count(F.lit(1)).alias("lines"))
            row = listed.select(
                F.lit(name).alias("file"),
                F.lit(True).alias("exists"),
                F.round(F.col("bytes") / 1e6, 2).alias("size_mb"),
                (lines.scalar() - F.col("n")).alias("rows"),
            )
        except AnalysisException:
            row = spark.createDataFrame([(name, False, None, None)], _INVENTORY)
        out = row if out is None else out.unionByName(row)
    return spark.createDataFrame([], _INVENTORY) if out is None else out


def require_files(spark: SparkSession, directory: str, names: Iterable[str]) -> None:
    """Raise unless every named file is in the directory; the error lists those that are not."""
    jvm = spark._jvm
    missing = []
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(f"{directory.rstrip('/')}/{name}")
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            missing.append(name)
    if missing:
        raise FileNotFoundError(f"expected files missing in {directory}: {', '.join(missing)}")
