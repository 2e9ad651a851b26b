"""The given tables in the roles the operators expect.

Each input is written once as a Spark frame and once as a DuckDB common table
expression with the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# (column, Spark expression, DuckDB expression or None when equal)
RAW_COLUMNS = (
    ("TransactionID", "o_orderkey", None),
    ("isFraud", "CAST(o_orderstatus = 'F' AS INT)", None),
    ("TransactionAmt", "o_totalprice", None),
    (
        "TransactionDT",
        "CAST(datediff(o_orderdate, DATE'1992-01-01') * 86400 AS INT)",
        "CAST(date_diff('day', TIMESTAMP '1992-01-01', o_orderdate) * 86400 AS INT)",
    ),
    ("ProductCD", "o_orderpriority", None),
    ("card1", "CAST(o_custkey AS DOUBLE)", None),
    ("card2", "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS DOUBLE) / CAST(8 AS DOUBLE) END", None),
    ("card3", "CAST(150 AS DOUBLE)", None),
    ("card4", "o_orderstatus", None),
    ("card5", "CAST(length(o_orderpriority) AS DOUBLE)", None),
    ("card6", "CASE WHEN o_orderpriority LIKE '1%' THEN 'nan' ELSE 'credit' END", None),
    ("P_emaildomain", "CASE WHEN o_orderstatus = 'O' THEN concat(lower(o_orderpriority), '.com') END", None),
    ("R_emaildomain", "CAST(NULL AS STRING)", "CAST(NULL AS VARCHAR)"),
    ("addr1", "CASE WHEN o_orderpriority NOT LIKE '2%' THEN CAST(315 AS DOUBLE) END", None),
    ("addr2", "CAST(87 AS DOUBLE)", None),
    ("dist1", "CASE WHEN o_totalprice < 50000 THEN o_totalprice END", None),
    ("C1", "CAST(o_custkey AS DOUBLE)", None),
    ("D1", "CASE WHEN o_orderstatus = 'F' THEN o_totalprice / CAST(2 AS DOUBLE) END", None),
    ("D2", "CASE WHEN o_totalprice > 200000 THEN CAST(1 AS DOUBLE) END", None),
    ("M1", "CASE WHEN o_orderstatus <> 'O' THEN 'T' END", None),
    ("V1", "o_totalprice * CAST(2 AS DOUBLE)", None),
    ("V2", "CASE WHEN o_orderpriority LIKE '5%' THEN o_totalprice END", None),
    ("V3", "CASE WHEN o_totalprice > 490000 THEN CAST(1 AS DOUBLE) END", None),
)
SIDE_COLUMNS = (
    ("TransactionID", "event_id", None),
    ("id_01", "value", None),
    ("id_30", "nullif(event_type, 'error')", None),
    ("id_31", "CASE WHEN event_type = 'click' THEN '' WHEN event_type = 'view' THEN 'chrome' END", None),
    ("DeviceType", "CASE WHEN event_type IN ('click', 'signup') THEN 'mobile' WHEN event_type = 'view' THEN '  ' END", None),
    ("DeviceInfo", "CASE WHEN event_type = 'view' THEN props END", None),
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the given tables."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str, *, by_day: bool = False) -> DataFrame:
    """Events as a history; ``by_day`` truncates times, which makes many ties."""
    at = F.col("ts").cast("timestamp")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("transaction_id"),
        (F.col("event_type") == "error").cast("int").alias("is_fraud"),
        F.col("user_id").alias("derived_user_id"),
        (F.date_trunc("day", at) if by_day else at).alias("transaction_at"),
        F.col("value").alias("transaction_amt"),
    )


def orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a history over years, with ties."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("is_fraud"),
        F.col("o_custkey").alias("derived_user_id"),
        F.col("o_orderdate").cast("timestamp").alias("transaction_at"),
        F.col("o_totalprice").alias("transaction_amt"),
    )


def raw(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in the raw transaction layout, without ``dist2``."""
    return table(spark, sf, "orders").selectExpr(*[f"{e} AS `{c}`" for c, e, _ in RAW_COLUMNS])


def side(spark: SparkSession, sf: str) -> DataFrame:
    """Events in the raw identity layout."""
    return table(spark, sf, "events").selectExpr(*[f"{e} AS `{c}`" for c, e, _ in SIDE_COLUMNS])


def _cte(name: str, columns, source: str) -> str:
    return f"{name} AS (SELECT " + ", ".join(f"{d or s} AS {c}" for c, s, d in columns) + f" FROM {source})"


RAW_CTE = _cte("raw", RAW_COLUMNS, "orders")
SIDE_CTE = _cte("side", SIDE_COLUMNS, "events")
MERGED_CTE = f"""{RAW_CTE}, {SIDE_CTE}, merged AS (
    SELECT raw.*, id_01, id_30, id_31, DeviceType, DeviceInfo
    FROM raw LEFT JOIN side ON raw.TransactionID = side.TransactionID)"""
MERGED_COLUMNS = [c for c, _, _ in RAW_COLUMNS] + [c for c, _, _ in SIDE_COLUMNS if c != "TransactionID"]

EVENTS_CTE = """h AS (SELECT event_id AS id, CAST(event_type = 'error' AS INT) AS y, user_id AS u, ts AS t,
    value AS amt FROM events)"""
EVENTS_BY_DAY_CTE = EVENTS_CTE.replace("ts AS t", "date_trunc('day', ts) AS t")
ORDERS_CTE = """h AS (SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS INT) AS y, o_custkey AS u,
    o_orderdate AS t, o_totalprice AS amt FROM orders)"""
