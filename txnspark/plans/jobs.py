"""End-to-end jobs: ingest, promotion, behavioural features, training frame."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnspark.operators.dataset import training_frame
from txnspark.operators.normalize import (
    conform_identities,
    conform_transactions,
    normalize_identities,
    normalize_transactions,
    stage_counts,
    static_features,
)
from txnspark.operators.rolling import behavioral_features
from txnspark.schemas import BEHAVIORAL, IDENTITIES, TRANSACTIONS, ensure_tables
from txnspark.scratch import materialize
from txnspark.settings import Lake
from txnspark.sources.files import load_raw
from txnspark.sources.tables import overwrite_table, upsert_table, write_features


@dataclass(frozen=True)
class IngestResult:
    rows_read: int
    rows_merged: int
    identities_merged: int
    feature_rows: int
    features_table: str | None
    silver_transactions: int
    silver_identities: int


@dataclass(frozen=True)
class PromoteResult:
    transactions_written: int
    identities_written: int


def ingest(
    spark: SparkSession,
    lake: Lake | None = None,
    *,
    data_dir: str | None = None,
    limit: int | None = None,
    dry_run: bool = False,
    skip_tables: bool = False,
    skip_features: bool = False,
    promote_silver: bool = True,
    ensure: bool = True,
    infer: bool = False,
    evolve: bool = False,
) -> IngestResult:
    """Raw files to bronze, and on to silver.

    The merged raw rows are stored once and feed every write.  A dry run only counts.
    """
    if skip_tables and skip_features:
        raise ValueError("skip_tables and skip_features together leave nothing to do")
    lake = lake or Lake()
    files = lake.raw_files(data_dir)
    merged = load_raw(spark, files["transaction"], files["identity"], limit=limit, infer=infer)
    features_table = None if skip_features else lake.table("bronze", "train_features")
    if dry_run:
        counts = stage_counts(merged).first()
        features = 0 if skip_features else counts["feature_rows"]
        return IngestResult(counts["rows_merged"], 0, counts["identity_rows"], features, features_table, 0, 0)

    if ensure:
        with_silver = promote_silver and not skip_tables
        ensure_tables(spark, lake, ("bronze", "silver", "gold") if with_silver else ("bronze",))
    merged, rows_read = materialize(merged, "raw")
    feature_rows = transactions = identities = 0
    promoted = PromoteResult(0, 0)
    if not skip_features:
        feature_rows = write_features(static_features(merged), features_table, evolve=evolve, stored=True)
    if not skip_tables:
        transactions = upsert_table(
            normalize_transactions(merged), lake.table("bronze", "transactions"), "transaction_id", stored=True
        )
        identities = upsert_table(
            normalize_identities(merged),
            lake.table("bronze", "transaction_identities"),
            "transaction_id",
            stored=True,
        )
        if promote_silver:
            promoted = promote(spark, lake, ensure=ensure)
    return IngestResult(
        rows_read,
        transactions,
        identities,
        feature_rows,
        features_table,
        promoted.transactions_written,
        promoted.identities_written,
    )


def promote(
    spark: SparkSession, lake: Lake | None = None, *, dry_run: bool = False, ensure: bool = True
) -> PromoteResult:
    """Bronze to silver; a dry run only counts the rows that would be written."""
    lake = lake or Lake()
    if ensure and not dry_run:
        ensure_tables(spark, lake, ("silver",))
    parts = {
        "transactions": conform_transactions(spark.table(lake.table("bronze", "transactions"))),
        "transaction_identities": conform_identities(spark.table(lake.table("bronze", "transaction_identities"))),
    }
    if dry_run:
        return PromoteResult(*[df.count() for df in parts.values()])
    layouts = (TRANSACTIONS, IDENTITIES)
    return PromoteResult(
        *[
            overwrite_table(df.select(*layout.names), lake.table("silver", name))
            for (name, df), layout in zip(parts.items(), layouts)
        ]
    )


def behavioral_frame(spark: SparkSession, lake: Lake | None = None, **options) -> DataFrame:
    """Behavioural features of the silver transactions."""
    lake = lake or Lake()
    source = options.pop("table", None) or lake.table("silver", "transactions")
    return behavioral_features(spark.table(source), **options)


def write_behavioral(
    spark: SparkSession,
    lake: Lake | None = None,
    *,
    limit: int | None = None,
    table: str | None = None,
    output_table: str | None = None,
    ensure: bool = True,
) -> int:
    """Overwrite the gold table with behavioural features in its declared types; returns the rows."""
    lake = lake or Lake()
    if ensure:
        ensure_tables(spark, lake, ("silver", "gold"))
    features = behavioral_frame(spark, lake, limit=limit, table=table)
    typed = features.select(*[F.col(f.name).cast(f.dataType) for f in BEHAVIORAL])
    return overwrite_table(typed, output_table or lake.table("gold", "behavioral_features"))


def training_set(
    spark: SparkSession,
    lake: Lake | None = None,
    *,
    limit: int | None = None,
    features_table: str | None = None,
    store: bool = False,
) -> DataFrame:
    """Training frame from the layered tables.

    ``store`` writes it to scratch once, for callers that go on to split, encode and
    fit: these read the frame several times.
    """
    lake = lake or Lake()
    frame = training_frame(
        spark.table(features_table or lake.table("bronze", "train_features")),
        spark.table(lake.table("silver", "transactions")),
        spark.table(lake.table("silver", "transaction_identities")),
        limit=limit,
    )
    return materialize(frame, "training")[0] if store else frame
