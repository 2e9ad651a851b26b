"""The same results in DuckDB SQL, formulated independently of the operators.

Rolling features are plain self-joins, splits and ranking metrics use row numbers
and ranks, and distribution statistics use DuckDB's own aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from workload.inputs import (
    EVENTS_BY_DAY_CTE,
    EVENTS_CTE,
    MERGED_COLUMNS,
    MERGED_CTE,
    ORDERS_CTE,
    RAW_COLUMNS,
    RAW_CTE,
    SIDE_COLUMNS,
)

# ------------------------------------------------------------------- rolling

_PRIOR = "b.u = a.u AND b.t >= a.t - INTERVAL {width} AND (b.t < a.t OR (b.t = a.t AND b.id < a.id))"
_STRICT = "b.u = a.u AND b.t >= a.t - INTERVAL {width} AND b.t < a.t"


def _in(width: str) -> str:
    return f"FILTER (WHERE b.t >= a.t - INTERVAL {width})"


def _ratio(width: str) -> str:
    return f"round(any_value(a.amt) / nullif(avg(b.amt) {_in(width)}, 0), 6)"


_FEATURES = {
    "velocity_1h": f"CAST(count(b.id) {_in('1 HOUR')} AS INTEGER)",
    "cumulative_spend_24h": f"round(coalesce(sum(b.amt) {_in('24 HOUR')}, 0), 6)",
    "avg_amount_ratio_30d": _ratio("30 DAY"),
    "avg_amount_ratio_90d": _ratio("90 DAY"),
}


def _rolling(
    history: str,
    names: Sequence[str] = tuple(_FEATURES),
    *,
    label: bool = False,
    requests: str = "h",
    prior: str = _PRIOR,
    key: str = "transaction_id",
    tail: str = "",
) -> str:
    y = "any_value(a.y) AS is_fraud, " if label else ""
    values = ", ".join(f"{_FEATURES[n]} AS {n}" for n in names)
    return (
        f"WITH {history} SELECT a.id AS {key}, {y}{values} FROM {requests} a "
        f"LEFT JOIN h b ON {prior.format(width='90 DAY')} GROUP BY a.id {tail}"
    )


_HOT = """h AS (SELECT event_id AS id, CASE WHEN event_type IN ('view', 'click') THEN -1 ELSE user_id END AS u,
    ts AS t, value AS amt FROM events)"""
_NULL_USER = """h AS (SELECT event_id AS id, CAST(event_type = 'error' AS INT) AS y,
    CASE WHEN event_type NOT IN ('view', 'signup') THEN user_id END AS u, ts AS t,
    nullif(value, 1.63) AS amt FROM events)"""
_LATER = EVENTS_CTE + ", r AS (SELECT id, u, t + INTERVAL 30 MINUTE AS t, amt * 2 AS amt FROM h)"



def _odd(ids: bool) -> str:
    """Rows tied by day; ``id`` decides among them, and a NULL id is seen from later days only."""
    own = "CASE WHEN event_id % 3 <> 0 THEN event_id END" if ids else "event_id"
    amount = "value" if ids else "CASE WHEN event_id % 7 < 3 THEN NULL WHEN event_id % 7 = 3 THEN 0 ELSE value END"
    return f"""
        WITH h AS (SELECT event_id AS r, {own} AS id, user_id AS u, date_trunc('day', ts) AS t, {amount} AS amt FROM events)
        SELECT a.r AS row, CAST(count(b.r) FILTER (WHERE b.t >= a.t - INTERVAL 1 HOUR) AS INTEGER) AS velocity_1h,
            round(coalesce(sum(b.amt) FILTER (WHERE b.t >= a.t - INTERVAL 24 HOUR), 0), 6) AS cumulative_spend_24h,
            round(coalesce(sum(b.amt), 0), 6) AS sum_30d
        FROM h a LEFT JOIN h b ON a.u = b.u AND b.t >= a.t - INTERVAL 30 DAY AND (b.t < a.t OR (b.t = a.t AND b.id < a.id))
        GROUP BY a.r"""


ORACLES: dict[str, str] = {
    "rolling_velocity_1h": _rolling(EVENTS_CTE, ["velocity_1h"]),
    "rolling_spend_24h": _rolling(EVENTS_CTE, ["cumulative_spend_24h"]),
    "rolling_ratio_30d": _rolling(ORDERS_CTE, ["avg_amount_ratio_30d"]),
    "rolling_ratio_90d": _rolling(ORDERS_CTE, ["avg_amount_ratio_90d"]),
    "rolling_all_events": _rolling(EVENTS_CTE, label=True),
    "rolling_ties": _rolling(EVENTS_BY_DAY_CTE, label=True),
    "rolling_chunked": _rolling(EVENTS_BY_DAY_CTE, label=True),
    "rolling_hot_entity": _rolling(_HOT),
    "rolling_null_user": _rolling(_NULL_USER, label=True),
    "rolling_first_n": _rolling(EVENTS_CTE, label=True, tail="ORDER BY any_value(a.t), a.id LIMIT 1000"),
    "rolling_by_ids": _rolling(EVENTS_CTE, label=True, tail="HAVING a.id IN (SELECT o_orderkey FROM orders)"),
    "rolling_by_repeated_ids": f"""SELECT f.*, i.ordinal FROM ({_rolling(EVENTS_CTE, label=True)}) f JOIN
        (SELECT o_orderkey AS id, o_orderkey * 2 + again AS ordinal FROM orders, (VALUES (0), (1)) t(again)) i
        ON f.transaction_id = i.id""",
    "gold_behavioral": _rolling(EVENTS_CTE, label=True),
    "rolling_custom_width": f"""
        WITH {EVENTS_CTE} SELECT a.id AS transaction_id,
            CAST(count(b.id) {_in('6 HOUR')} AS INTEGER) AS count_6h,
            round(coalesce(sum(b.amt) {_in('7 DAY')}, 0), 6) AS sum_7d,
            round(avg(b.amt) {_in('3 DAY')}, 6) AS avg_3d
        FROM h a LEFT JOIN h b ON {_PRIOR.format(width='7 DAY')} GROUP BY a.id""",
    **{f"rolling_null_id_{s}": _odd(True) for s in ("auto", "sweep", "chunked")},
    **{f"rolling_odd_amounts_{s}": _odd(False) for s in ("auto", "sweep", "chunked")},
    "chronological_order": """
        SELECT event_id AS transaction_id, strftime(ts, '%Y-%m-%d') AS event_day, round(ln(1 + value), 6) AS log_amt,
            row_number() OVER (ORDER BY date_trunc('day', ts), event_id) AS position FROM events""",
    "time_position": """SELECT o_orderkey AS transaction_id,
        row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS position FROM orders""",
    "score_requests_later": _rolling(_LATER, requests="r", key="request_id"),
    "score_requests_no_id": _rolling(EVENTS_BY_DAY_CTE, prior=_STRICT, key="request_id"),
}

# ------------------------------------------------------- scans and projections


def _component(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN {text} IN ('NaN', 'nan', 'None', 'null') THEN '' ELSE coalesce({text}, '') END"


_USER = "md5(" + " || '_' || ".join(
    _component(c) for c in ("card1", "card2", "card3", "card4", "card5", "card6", "addr1", "addr2")
) + ")"
_AT = "(TIMESTAMP '2017-11-30' + to_seconds(TransactionDT))"
_TRANSACTIONS = f"""SELECT TransactionID AS transaction_id, {_USER} AS derived_user_id, isFraud AS is_fraud,
    TransactionAmt AS transaction_amt, substr(ProductCD, 1, 10) AS product_cd, TransactionDT AS transaction_dt,
    strftime({_AT}, '%Y-%m-%d %H:%M:%S') AS transaction_at, card1, card2, card3, card4, card5, card6,
    P_emaildomain AS p_emaildomain, R_emaildomain AS r_emaildomain, addr1, addr2, dist1,
    CAST(NULL AS DOUBLE) AS dist2"""
_IDENTITIES = """SELECT TransactionID AS transaction_id, id_30, id_31, DeviceType AS device_type,
    DeviceInfo AS device_info FROM merged
    WHERE id_30 IS NOT NULL OR id_31 IS NOT NULL OR DeviceType IS NOT NULL OR DeviceInfo IS NOT NULL"""
_CLEAN_IDENTITIES = f"""SELECT transaction_id, nullif(trim(id_30), '') AS id_30, nullif(trim(id_31), '') AS id_31,
    nullif(trim(device_type), '') AS device_type, nullif(trim(device_info), '') AS device_info
    FROM ({_IDENTITIES})"""
_STATIC = "TransactionID, C1, D1, D2, M1, V1, V2, V3, id_01"

ORACLES |= {
    "entity_id_md5": """
        SELECT p_partkey, md5(concat(CAST(p_size AS VARCHAR), '_', CAST(p_retailprice AS VARCHAR), '__',
            CASE WHEN p_type = 'SMALL' THEN '' ELSE p_type END, '__',
            CASE WHEN p_brand = 'Brand#2' THEN '' ELSE p_brand END, '__')) AS entity_id FROM part""",
    "event_time_from_offset": f"""WITH {RAW_CTE}
        SELECT TransactionID, strftime({_AT}, '%Y-%m-%d %H:%M:%S') AS transaction_at FROM raw""",
    "raw_left_join": f"WITH {MERGED_CTE} SELECT TransactionID, TransactionAmt, id_01, id_30, DeviceInfo FROM merged",
    "normalize_transactions": f"WITH {MERGED_CTE} {_TRANSACTIONS} FROM merged",
    "raw_first_n": f"""WITH {MERGED_CTE} SELECT TransactionID, TransactionAmt, id_30 FROM merged
        ORDER BY TransactionAmt DESC, TransactionID LIMIT 700""",
    "normalize_identities": f"WITH {MERGED_CTE} {_IDENTITIES}",
    "ingest_silver_transactions": f"WITH {MERGED_CTE} {_TRANSACTIONS} FROM merged",
    "ingest_wide_features": f"""WITH {MERGED_CTE} SELECT {_STATIC.replace("V1,", "CASE WHEN card4 <> 'O' THEN V1 + 1 ELSE V1 END AS V1,")}
        FROM merged""",
    "csv_compact_scan": f"""WITH {RAW_CTE} SELECT TransactionID, isFraud,
        CAST(CAST(TransactionAmt AS FLOAT) AS DOUBLE) AS TransactionAmt FROM raw""",
    "static_feature_split": f"WITH {MERGED_CTE} SELECT {_STATIC} FROM merged",
    "conform_transactions": """
        SELECT o_orderkey AS transaction_id, strftime(o_orderdate, '%Y-%m-%d') AS transaction_at,
            CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS card4,
            CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS product_cd
        FROM orders WHERE o_orderkey <> 7 AND o_orderpriority <> '5-LOW'""",
    "conform_identities": f"WITH {MERGED_CTE} {_CLEAN_IDENTITIES}",
    "csv_roundtrip_scan": f"""WITH {RAW_CTE}
        SELECT TransactionID, isFraud, TransactionAmt, TransactionDT, ProductCD, card2, dist1, M1 FROM raw""",
    "file_inventory_sizes": """SELECT file, TRUE AS "exists", round(sum(bytes) / 1e6, 2) AS size_mb FROM (
            SELECT CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'done' END AS file,
                length(CAST(o_orderkey AS VARCHAR)) + length(CAST(o_custkey AS VARCHAR)) + length(o_orderpriority) + 3 AS bytes
            FROM orders WHERE o_orderstatus IN ('O', 'F')) GROUP BY file
        UNION ALL SELECT 'absent', FALSE, NULL""",
    "file_inventory": """
        SELECT 'train_transaction' AS file, TRUE AS "exists", count(*) AS "rows" FROM orders
        UNION ALL SELECT 'test_transaction', FALSE, NULL""",
    "stage_counts": f"""WITH {MERGED_CTE} SELECT count(*) AS rows_merged, count(*) AS feature_rows,
        count(coalesce(id_30, id_31, DeviceType, DeviceInfo)) AS identity_rows FROM merged""",
    "frame_shape": """SELECT count(*) AS "rows", 11 AS "columns", 2 AS text_columns, 4 AS floating_columns,
        4 AS integral_columns, 1 AS other_columns FROM lineitem""",
}

# --------------------------------------------------------------------- sinks

_BATCH = """batch AS (SELECT o_orderkey, o_custkey + 1 AS o_custkey, o_orderstatus,
    CASE WHEN o_totalprice > 100000 THEN o_totalprice END AS o_totalprice FROM orders WHERE o_orderstatus <> 'O'),
    target AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F')"""
_MERGED_ORDERS = f"""WITH {_BATCH} SELECT * FROM batch UNION ALL
    SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)"""

ORACLES |= {
    "upsert_merge": _MERGED_ORDERS,
    "upsert_idempotent": _MERGED_ORDERS,
    "upsert_partial_columns": f"""WITH {_BATCH}
        SELECT coalesce(t.o_orderkey, b.o_orderkey) AS o_orderkey, t.o_custkey, t.o_orderstatus,
            CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_totalprice ELSE t.o_totalprice END AS o_totalprice
        FROM target t FULL OUTER JOIN batch b ON t.o_orderkey = b.o_orderkey""",
    "cli_jobs": f"""WITH {MERGED_CTE}, n AS (SELECT count(*) AS n, count(coalesce(id_30, id_31, DeviceType, DeviceInfo)) AS i FROM merged)
        SELECT n AS dry_rows, 0 AS dry_merged, n AS rows_read, n AS rows_merged, i AS identities_merged, n AS feature_rows,
            n AS silver_transactions, n AS promoted, n AS gold_rows, n AS gold_written FROM n""",
    "upsert_bucketed": """WITH m AS (SELECT max(o_orderkey) AS last FROM orders),
        b AS (SELECT orders.*, last FROM orders, m WHERE o_orderkey > last - last // 100),
        r AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey > last - last // 100 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
              FROM orders, m UNION ALL SELECT o_orderkey + last, NULL, o_totalprice FROM b)
        SELECT *, (SELECT 2 * count(*) FROM b) AS written FROM r""",
    "overwrite_roundtrip": """SELECT event_id, user_id, event_type, value,
        (SELECT count(*) FROM events) AS written FROM events""",
}

# ------------------------------------------------------------ training frame

_LAYERS = f"""{MERGED_CTE},
    static AS (SELECT {_STATIC} FROM merged),
    tx AS ({_TRANSACTIONS}, {_AT} AS event_at FROM raw),
    ids AS ({_CLEAN_IDENTITIES}),
    h AS (SELECT transaction_id AS id, derived_user_id AS u, event_at AS t, transaction_amt AS amt FROM tx)"""
_BEHAVIOR = (
    "beh AS (SELECT a.id, "
    + ", ".join(f"{e} AS {n}" for n, e in _FEATURES.items())
    + f" FROM h a LEFT JOIN h b ON {_PRIOR.format(width='90 DAY')} GROUP BY a.id)"
)
_OPERATIONAL = """is_fraud, transaction_dt, transaction_amt, product_cd, card1, card2, card3, card4, card5, card6,
    p_emaildomain, r_emaildomain, addr1, addr2, dist1, dist2, ids.id_30, ids.id_31, device_type, device_info"""
_JOINED = """FROM static JOIN tx ON static.TransactionID = tx.transaction_id
    LEFT JOIN ids ON ids.transaction_id = tx.transaction_id LEFT JOIN beh ON beh.id = tx.transaction_id"""
_NUMBERED = f"""WITH {ORDERS_CTE}, n AS (
    SELECT *, row_number() OVER (ORDER BY t, id) AS rn, count(*) OVER () AS n FROM h),
    s AS (SELECT *, CASE WHEN rn <= floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
        WHEN rn <= floor(n * CAST(0.7 AS DOUBLE)) + floor(n * CAST(0.15 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM n)"""


def _vocabulary(column: str) -> str:
    return f"""SELECT '{column}' AS "column", level, row_number() OVER (ORDER BY first DESC, level) - 1 AS code FROM (
        SELECT level, max(first) AS first FROM (
            SELECT DISTINCT coalesce({column}, '__MISSING__') AS level, 0 AS first FROM p
            UNION ALL SELECT '__MISSING__', CASE WHEN count(*) FILTER (WHERE {column} IS NULL) = 0 THEN 1 ELSE 0 END FROM p
        ) GROUP BY level)"""


_PARTS = """p AS (SELECT p_partkey, p_size, p_retailprice, p_brand, nullif(p_type, 'SMALL') AS p_type FROM part)"""
_TRAIN_ONLY = _NUMBERED.replace("o_totalprice AS amt", "o_totalprice AS amt, "
    "coalesce(nullif(o_orderpriority, '5-LOW'), '__MISSING__') AS priority, strftime(o_orderdate, '%Y-%m') AS month")


def _level(column: str) -> str:
    return f"CASE WHEN {column} IN (SELECT {column} FROM s WHERE split = 'train') THEN {column} ELSE '__MISSING__' END"


ORACLES |= {
    "training_frame": f"""WITH {_LAYERS}, {_BEHAVIOR}
        SELECT tx.transaction_id, C1, D1, D2, M1, V1, V2, V3, id_01, {_OPERATIONAL}, {', '.join(_FEATURES)} {_JOINED}""",
    "training_frame_first_n": f"""WITH {_LAYERS}, {_BEHAVIOR}
        SELECT tx.transaction_id, is_fraud, device_type, {', '.join(_FEATURES)} {_JOINED}
        ORDER BY tx.transaction_id LIMIT 2000""",
    "time_split_rows": f"{_NUMBERED} SELECT id AS transaction_id, split FROM s",
    "time_split_report": f"""{_NUMBERED} SELECT split, count(*) AS "rows", CAST(sum(y) AS BIGINT) AS positives,
        round(avg(y), 6) AS rate, strftime(min(t), '%Y-%m-%d') AS first_time,
        strftime(max(t), '%Y-%m-%d') AS last_time FROM s GROUP BY split""",
    "encode_fit_vocab": f"WITH {_PARTS} {_vocabulary('p_brand')} UNION ALL {_vocabulary('p_type')}",
    "encode_transform": f"""WITH {_PARTS}, k AS (SELECT * FROM p WHERE p_brand < 'Brand#2' AND p_type <> 'PROMO')
        SELECT p_partkey, p_size, p_retailprice,
            CASE WHEN p_brand IN (SELECT p_brand FROM k) THEN p_brand ELSE '__MISSING__' END AS p_brand,
            CASE WHEN p_type IN (SELECT p_type FROM k) THEN p_type ELSE '__MISSING__' END AS p_type FROM p""",
    "encode_train_only": f"""{_TRAIN_ONLY} SELECT id AS transaction_id, split, amt AS o_totalprice,
        {_level('priority')} AS priority, {_level('month')} AS month FROM s""",
    "encode_codes": f"""{_TRAIN_ONLY},
        lv AS (SELECT DISTINCT month AS m FROM s WHERE split = 'train'),
        lp AS (SELECT DISTINCT priority AS p FROM s WHERE split = 'train')
        SELECT id AS transaction_id, split, amt AS o_totalprice,
            CAST((SELECT count(*) FROM lp WHERE lp.p < {_level('priority')}) AS INTEGER) AS priority,
            CAST(CASE WHEN month IN (SELECT m FROM lv) THEN 1 + (SELECT count(*) FROM lv WHERE lv.m < month) ELSE 0 END AS INTEGER) AS month
        FROM s""",
}

# ----------------------------------------------------------------- profiling

_GROUPS = {"TransactionID": "core", "isFraud": "core", "TransactionDT": "core", "TransactionAmt": "core", "ProductCD": "core"}


def _group(column: str) -> str:
    if column in _GROUPS:
        return _GROUPS[column]
    for prefix, group in (("card", "card"), ("addr", "addr"), ("id_", "id"), ("Device", "device")):
        if column.startswith(prefix):
            return group
    if "emaildomain" in column:
        return "email"
    return column[0] if column[0] in "CDMV" and column[1:].isdigit() else "other"


def _missing(source: str, columns: Sequence[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{_group(c)}' AS "group", 100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*) AS pct
        FROM {source}"""
        for c in columns
    )


_RAW_NAMES = [c for c, _, _ in RAW_COLUMNS]
_SIDE_NAMES = [c for c, _, _ in SIDE_COLUMNS if c != "TransactionID"]
_M = f"WITH {MERGED_CTE}, m AS ({_missing('merged', MERGED_COLUMNS)})"
_LINES = "l AS (SELECT *, CAST(l_returnflag = 'R' AS INT) AS y FROM lineitem)"
_QUARTILES = ", ".join(f"quantile_cont(l_extendedprice, {p}) AS {n}" for p, n in ((0.25, "q1"), (0.5, "q2"), (0.75, "q3")))
_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")
_PAIRED = ("TransactionAmt", "dist1", "D1", "V2", "id_01", "isFraud")
_SIDES = "o AS (SELECT *, o_orderdate < TIMESTAMP '1996-01-01' AS early FROM orders)"


def _ks(column: str) -> str:
    return f"""WITH {_SIDES}, v AS (SELECT DISTINCT {column} AS v FROM o),
        g AS (SELECT v, count(*) FILTER (WHERE early) AS a, count(*) FILTER (WHERE NOT early) AS b
            FROM (SELECT {column} AS v, early FROM o) GROUP BY v),
        c AS (SELECT sum(a) OVER (ORDER BY v) AS ca, sum(b) OVER (ORDER BY v) AS cb,
            sum(a) OVER () AS na, sum(b) OVER () AS nb FROM g),
        d AS (SELECT max(abs(ca / CAST(na AS DOUBLE) - cb / CAST(nb AS DOUBLE))) AS d, any_value(na) AS na, any_value(nb) AS nb FROM c),
        x AS (SELECT *, sqrt(CAST(na AS DOUBLE) * nb / (na + nb)) * d AS x FROM d)
        SELECT '{column}' AS "column", round(d, 6) AS statistic, CAST(na AS BIGINT) AS n_left, CAST(nb AS BIGINT) AS n_right,
            -- the distribution function by its other series, which converges where the tail's does not
            round(CASE WHEN x < 0.05 THEN 1.0 ELSE greatest(0.0, 1 - sqrt(2 * pi()) / x * (SELECT
                sum(exp(-(2 * k - 1) * (2 * k - 1) * pi() * pi() / (8 * x * x))) FROM range(1, 101) r(k))) END, 6) AS p_value
        FROM x"""


ORACLES |= {
    "missing_summary": f"""{_M} SELECT "column", round(pct, 6) AS pct_missing FROM m ORDER BY pct DESC, "column" LIMIT 30""",
    "missing_above": f"""{_M} SELECT "column", round(pct, 6) AS pct_missing FROM m WHERE pct > 90""",
    "missing_by_group": f"""{_M} SELECT "group", count(*) AS n_columns, round(avg(pct), 6) AS avg_pct_missing FROM m GROUP BY 1""",
    "missing_blocks": f"""{_M} SELECT "group", count(*) AS n_columns, round(avg(pct), 6) AS avg_pct_missing,
        round(median(pct), 6) AS median_pct_missing, round(max(pct), 6) AS max_pct_missing
        FROM m WHERE "group" IN ('C', 'D', 'M', 'V') GROUP BY 1""",
    "missing_before_after": f"""WITH {MERGED_CTE},
        a AS ({_missing('raw', _RAW_NAMES)}), b AS ({_missing('merged', MERGED_COLUMNS)}), c AS ({_missing('merged', _SIDE_NAMES)})
        SELECT 'before join' AS stage, round(avg(pct), 6) AS avg_pct_missing FROM a
        UNION ALL SELECT 'after join', round(avg(pct), 6) FROM b
        UNION ALL SELECT 'joined columns', round(avg(pct), 6) FROM c""",
    "target_rate_by_category": f"""WITH {_LINES} SELECT l_quantity AS level, count(y) AS "count", round(avg(y), 6) AS mean
        FROM l GROUP BY 1 HAVING count(y) >= 100 ORDER BY avg(y) DESC, 1 LIMIT 15""",
    "class_balance": """WITH c AS (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1)
        SELECT l_returnflag, n AS "count", round(n * 100.0 / (SELECT sum(n) FROM c), 6) AS percent,
            round((SELECT max(n) FROM c) / CAST(n AS DOUBLE), 6) AS majority_ratio FROM c""",
    "describe_by_class": """SELECT l_returnflag, count(l_extendedprice) AS "count", round(avg(l_extendedprice), 6) AS mean,
        round(stddev_samp(l_extendedprice), 6) AS std, round(min(l_extendedprice), 6) AS "min",
        round(quantile_cont(l_extendedprice, 0.25), 6) AS q25, round(quantile_cont(l_extendedprice, 0.5), 6) AS q50,
        round(quantile_cont(l_extendedprice, 0.75), 6) AS q75, round(max(l_extendedprice), 6) AS "max"
        FROM lineitem GROUP BY 1""",
    "describe_columns": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
        round(min({c}), 6) AS "min", round(max({c}), 6) AS "max" FROM lineitem"""
        for c in _MEASURES[:4]
    ),
    "decile_rate": f"""WITH {_LINES},
        e AS (SELECT DISTINCT unnest(quantile_cont(l_extendedprice, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS e FROM l),
        b AS (SELECT row_number() OVER (ORDER BY e) - 1 AS bin, e AS lo, lead(e) OVER (ORDER BY e) AS hi FROM e)
        SELECT CAST(bin AS INTEGER) AS bin, round(lo, 6) AS lo, round(hi, 6) AS hi, count(y) AS "count", round(avg(y), 6) AS rate
        FROM l JOIN b ON (l_extendedprice > lo OR (bin = 0 AND l_extendedprice = lo)) AND l_extendedprice <= hi GROUP BY 1, 2, 3""",
    "daily_rate": """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS volume,
        round(avg(CAST(event_type = 'error' AS INT)), 6) AS rate FROM events GROUP BY 1""",
    "cardinality": f"WITH {MERGED_CTE} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct,
        round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS pct_missing FROM merged"""
        for c in ("card1", "card2", "addr1", "P_emaildomain", "R_emaildomain", "DeviceType")
    ),
    "coverage_rate": f"""WITH {MERGED_CTE} SELECT id_01 IS NOT NULL AS present, count(*) AS "rows",
        round(100.0 * count(*) / (SELECT count(*) FROM merged), 6) AS pct_rows, round(avg(isFraud), 6) AS rate
        FROM merged GROUP BY 1""",
    "value_counts": f"""WITH {MERGED_CTE} SELECT DeviceInfo AS "value", count(*) AS "count",
        round(count(*) / CAST((SELECT count(*) FROM merged) AS DOUBLE), 6) AS share
        FROM merged GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 10""",
    "corr_with_label": f"WITH {_LINES} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(corr({c}, y), 6) AS r, round(abs(corr({c}, y)), 6) AS abs_r FROM l""" for c in _MEASURES
    ),
    "corr_matrix": f"WITH {MERGED_CTE} " + " UNION ALL ".join(
        f"SELECT '{a}' AS i, '{b}' AS j, round(corr({a}, {b}), 6) AS r FROM merged" for a in _PAIRED for b in _PAIRED
    ),
    "histogram_by_class": """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.01) AS lo, quantile_cont(l_extendedprice, 0.99) AS hi FROM lineitem),
        b AS (SELECT l_returnflag, lo, (hi - lo) / 30 AS w, CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin
            FROM lineitem, q WHERE l_extendedprice BETWEEN lo AND hi)
        SELECT l_returnflag, bin, round(any_value(lo) + bin * any_value(w), 4) AS lo, count(*) AS "count",
            round(count(*) / (sum(count(*)) OVER (PARTITION BY l_returnflag) * any_value(w)), 9) AS density
        FROM b GROUP BY l_returnflag, bin""",
    "boxplot_stats": f"""WITH q AS (SELECT l_returnflag AS c, {_QUARTILES} FROM lineitem GROUP BY 1),
        v AS (SELECT l_returnflag, q1, q2, q3, l_extendedprice AS x,
            l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
            FROM lineitem JOIN q ON c = l_returnflag)
        SELECT l_returnflag, round(q1, 6) AS q1, round(q2, 6) AS q2, round(q3, 6) AS q3,
            round(min(x) FILTER (WHERE inside), 6) AS whisker_lo, round(max(x) FILTER (WHERE inside), 6) AS whisker_hi,
            count(*) FILTER (WHERE NOT inside) AS outliers FROM v GROUP BY l_returnflag, q1, q2, q3""",
    "ks_numeric": _ks("o_totalprice"),
    "ks_string": _ks("o_orderpriority"),
    "share_compare": f"""WITH {_SIDES}, n AS (SELECT count(*) FILTER (WHERE early) AS a, count(*) FILTER (WHERE NOT early) AS b FROM o)
        SELECT o_orderpriority AS "value", round(count(*) FILTER (WHERE early) / CAST(any_value(a) AS DOUBLE), 6) AS left_share,
            round(count(*) FILTER (WHERE NOT early) / CAST(any_value(b) AS DOUBLE), 6) AS right_share
        FROM o, n GROUP BY 1 ORDER BY count(*) FILTER (WHERE early) DESC, 1 LIMIT 6""",
    "missing_drift": f"""WITH {RAW_CTE}, ra AS (SELECT * FROM raw WHERE TransactionDT < 126230400),
        rb AS (SELECT * FROM raw WHERE TransactionDT >= 126230400),
        a AS (SELECT "group", count(*) AS n, avg(pct) AS pct FROM ({_missing('ra', _RAW_NAMES)}) GROUP BY 1),
        b AS (SELECT "group", count(*) AS n, avg(pct) AS pct FROM ({_missing('rb', _RAW_NAMES)}) GROUP BY 1)
        SELECT a."group", a.n AS n_columns_left, round(a.pct, 6) AS pct_left, b.n AS n_columns_right,
            round(b.pct, 6) AS pct_right, round(b.pct - a.pct, 6) AS missing_diff FROM a JOIN b ON a."group" = b."group\"""",
    "key_checks": """SELECT 'lineitem.l_orderkey' AS name, CAST(sum(n) AS BIGINT) AS "rows", count(*) AS keys, max(n) AS max_per_key, max(n) <= 1 AS is_unique
            FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)
        UNION ALL SELECT 'orders.o_orderkey', CAST(sum(n) AS BIGINT), count(*), max(n), max(n) <= 1
            FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey)""",
    "subset_check": """WITH l AS (SELECT DISTINCT l_orderkey AS k FROM lineitem), o AS (SELECT DISTINCT o_orderkey AS k FROM orders)
        SELECT 'lines in orders' AS name, count(*) AS distinct_keys, count(*) FILTER (WHERE k NOT IN (SELECT k FROM o)) AS lacking_keys,
            count(*) FILTER (WHERE k NOT IN (SELECT k FROM o)) = 0 AS is_subset FROM l
        UNION ALL SELECT 'orders in lines', count(*), count(*) FILTER (WHERE k NOT IN (SELECT k FROM l)),
            count(*) FILTER (WHERE k NOT IN (SELECT k FROM l)) = 0 FROM o""",
    "id_set_members": """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "id_set_others": """SELECT c_custkey, c_name FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey <> 1)""",
    "id_set_containment": """WITH l AS (SELECT DISTINCT l_orderkey AS k FROM lineitem), o AS (SELECT DISTINCT o_orderkey AS k FROM orders),
        c AS (SELECT 'lines in orders' AS name, count(*) AS distinct_keys, count(*) FILTER (WHERE k NOT IN (SELECT k FROM o)) AS lacking_keys FROM l
        UNION ALL SELECT 'orders in lines', count(*), count(*) FILTER (WHERE k NOT IN (SELECT k FROM l)) FROM o)
        SELECT *, lacking_keys = 0 AS is_subset FROM c""",
    "schema_diff": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{s}' AS side, {n} AS "rows\""""
        for c, s, n in [
            (c, "both" if c == "TransactionID" else "left", "CAST(NULL AS BIGINT)" if c == "TransactionID" else "(SELECT count(*) FROM orders)")
            for c in _RAW_NAMES
            if c != "isFraud"
        ]
        + [(c, "right", "(SELECT count(*) FROM events)") for c in _SIDE_NAMES]
    ),
    "hash_sample": """SELECT event_id AS transaction_id, value AS transaction_amt FROM events
        ORDER BY md5('42:' || CAST(event_id AS VARCHAR)), event_id LIMIT 1000""",
    "type_advice_applied": "WITH " + _LINES + ", k AS (" + " UNION ALL ".join(
        f"""SELECT {n} AS place, '{c}' AS c, CASE WHEN min({c}) > -128 AND max({c}) < 127 THEN 'tinyint'
            WHEN min({c}) > -32768 AND max({c}) < 32767 THEN 'smallint'
            WHEN min({c}) > -2147483648 AND max({c}) < 2147483647 THEN 'int' END AS t, '{t}' AS held FROM l"""
        for n, (c, t) in enumerate((("l_orderkey", "bigint"), ("l_linenumber", "int"), ("l_suppkey", "bigint")))
    ) + """) SELECT l_orderkey, l_linenumber, l_suppkey, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate,
        (SELECT string_agg(c || ' ' || t, ', ' ORDER BY place) FROM k WHERE t <> held) AS narrowed FROM l""",
    "target_rates": "WITH " + _LINES + ", f AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level, y FROM l"
        for c in ("l_linestatus", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_suppkey")
    ) + """), g AS (SELECT feature, level, count(y) AS "count", avg(y) AS m FROM f WHERE level IS NOT NULL GROUP BY 1, 2 HAVING count(y) >= 20)
        SELECT feature, level, "count", round(m, 6) AS mean FROM g
        QUALIFY row_number() OVER (PARTITION BY feature ORDER BY m DESC, level) <= 10""",
    "type_advisor": "WITH " + _LINES + ", c AS (" + " UNION ALL ".join(
        [
            f"""SELECT '{c}' AS "column", '{t}' AS "current", CAST(min({c}) AS BIGINT) AS lo, CAST(max({c}) AS BIGINT) AS hi, FALSE AS few FROM l"""
            for c, t in (("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"))
        ]
        + [
            f"SELECT '{c}', 'double', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), FALSE"
            for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        ]
        + [
            f"SELECT '{c}', 'string', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), count(DISTINCT {c}) < 0.5 * count(*) FROM l"
            for c in ("l_returnflag", "l_linestatus")
        ]
        + ["SELECT 'l_shipdate', 'timestamp_ntz', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), FALSE"]
    ) + """) SELECT "column", "current", CASE WHEN few THEN 'dictionary' WHEN "current" = 'double' THEN 'float'
            WHEN "current" = 'string' THEN 'string' WHEN lo > -128 AND hi < 127 THEN 'tinyint'
            WHEN lo > -32768 AND hi < 32767 THEN 'smallint'
            WHEN lo > -2147483648 AND hi < 2147483647 THEN 'int' ELSE "current" END AS advised, lo, hi FROM c""",
}

# ------------------------------------------------------- metrics and modelling

ORACLES |= {
    "ranking_metrics": f"""WITH {EVENTS_CTE},
        r AS (SELECT y, rank() OVER (ORDER BY amt) + (count(*) OVER (PARTITION BY amt) - 1) / 2.0 AS mid FROM h),
        t AS (SELECT sum(y) AS p, count(*) - sum(y) AS n FROM h),
        g AS (SELECT amt, sum(y) AS p, count(*) AS c FROM h GROUP BY amt),
        k AS (SELECT p, sum(p) OVER (ORDER BY amt DESC) / CAST(sum(c) OVER (ORDER BY amt DESC) AS DOUBLE) AS prec FROM g)
        SELECT round((SELECT sum(k.p * prec) FROM k) / t.p, 6) AS pr_auc,
            round(((SELECT sum(mid) FROM r WHERE y = 1) - t.p * (t.p + 1) / 2.0) / (CAST(t.p AS DOUBLE) * t.n), 6) AS roc_auc,
            CAST(t.p AS BIGINT) AS positives, CAST(t.n AS BIGINT) AS negatives FROM t""",
    "class_weight": """SELECT count(*) FILTER (WHERE event_type <> 'error') AS negatives,
        count(*) FILTER (WHERE event_type = 'error') AS positives,
        round(count(*) FILTER (WHERE event_type <> 'error') / CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE), 6) AS weight
        FROM events""",
}
