"""Stages of the corpus pipeline.

Every stage works on all rows its predecessor kept and returns the columns of
``documents``; the last adds ``copy``, the number of a repetition.  Rows with a null id
go by their own text in every stage.  An empty table gives empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnspark.scratch import broadcast_if_small, materialize

from . import langid
from .decontaminate import WINDOW, without_benchmark
from .minhash import near_duplicates
from .mixing import mix
from .secret_scan import redact, scan_secrets
from .store import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Probability that the best language must have.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from all rows with a language; texts without a letter or without a clear language go.

    The language found does not replace the one given, and a difference between them is no
    reason to drop a text.
    """
    model = langid.fit(docs.select("text", "lang"), "text", "lang")
    found = langid.identify(docs.select(*COLUMNS), model)
    return found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 80 % of shingles of five words, the row with the least id stays.

    Rows are told apart by a number of their own, so rows with one id, or none, go by their texts;
    a null id comes after all others, and of rows with equal ids the least by all columns stays.
    """
    rows = stored(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")), "rows")
    groups = near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), width=5)
    groups = stored(groups.select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group")), "groups")
    # Rows without a partner, nearly all of them, need no comparison.
    paired, n = materialize(groups.groupBy("_group").count().filter("count > 1").select("_group"), "paired")
    if not n:
        return rows.drop("_row")
    members = groups.join(broadcast_if_small(paired), "_group", "left_semi")
    order = F.struct(F.col("doc_id").isNull(), *COLUMNS, "_row")
    best = rows.join(members, "_row").groupBy("_group").agg(F.min(order).alias("best"))
    gone = stored(members.join(best.select("best._row"), "_row", "left_anti").select("_row"), "gone")
    return rows.join(broadcast_if_small(gone), "_row", "left_anti").drop("_row")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds a passage of the benchmark, or a part of one, go."""
    return without_benchmark(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=WINDOW)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced in its text; n_chars follows the text where it changed."""
    found = scan_secrets(docs.select(*COLUMNS))
    found = found.withColumn("text", redact(F.col("text"), F.col("secrets")))
    size: Column = F.when(F.size("secrets") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", size).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated as the mix takes them, numbered from 1 in ``copy``; rows not taken go."""
    taken = mix(docs.select(*COLUMNS)).filter("copies > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return taken.select(*COLUMNS, copies)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
]
#: The language model and the near-duplicates cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
