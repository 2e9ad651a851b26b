"""Raw files to bronze and silver, upserts, jobs and names."""

from __future__ import annotations

import hashlib
import random
from datetime import datetime, timezone

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from txnspark.functions.columns import entity_id, event_time
from txnspark.operators import joins
from txnspark.operators.joins import (
    duplicate_keys,
    frequent_keys,
    is_subset,
    keep_ids,
    latest_per_key,
    left_join,
    left_join_by_size,
    upsert,
)
from txnspark.operators.normalize import (
    conform_identities,
    conform_transactions,
    normalize_identities,
    normalize_transactions,
    stage_counts,
    static_features,
)
from txnspark.plans import cli, jobs
from txnspark.schemas import BEHAVIORAL, IDENTITIES, TABLES, TRANSACTIONS, ensure_tables
from txnspark.settings import EVENT_EPOCH, EVENT_EPOCH_SECONDS, Lake
from txnspark.sources.files import file_inventory, first_in_files, load_raw, merge_raw, raw_schema, read_csv, require_files
from txnspark.sources.tables import overwrite_table, upsert_table, write_features

HEADER = (
    "TransactionID,isFraud,TransactionAmt,TransactionDT,ProductCD,card1,card2,card3,card4,card5,card6,"
    "P_emaildomain,R_emaildomain,addr1,addr2,dist1,dist2,V1"
)
ROWS = [
    "2987000,0,68.5,86400,W,13926.0,,150.0,discover,142.0,credit,gmail.com,,315.0,87.0,19.0,,0.1",
    "2987001,1,29.0,86401,W,2755.0,404.0,150.0,mastercard,102.0,credit,,,325.0,87.0,,,0.2",
]
THIRD = "2987002,0,15.0,86402,W,1000.0,,150.0,visa,142.0,debit,,,300.0,87.0,10.0,,0.3"
ID_HEADER = "TransactionID,id_30,id_31,DeviceType,DeviceInfo,id_01"
ID_ROW = "2987000,Windows 10,chrome 63.0,desktop,Windows,1.0"


def write_raw(folder, rows, id_header=ID_HEADER, id_rows=(ID_ROW,)):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "train_transaction.csv").write_text("\n".join([HEADER, *rows]) + "\n")
    (folder / "train_identity.csv").write_text("\n".join([id_header, *id_rows]) + "\n")
    return str(folder)


@pytest.fixture
def raw_dir(tmp_path):
    return write_raw(tmp_path / "raw", ROWS)


def merged(spark, folder, **options):
    return load_raw(spark, f"{folder}/train_transaction.csv", f"{folder}/train_identity.csv", **options)


# ------------------------------------------------------------------ functions


def test_entity_id_text(spark):
    text = "13926.0__150.0_discover_142.0_credit_315.0_87.0"
    df = spark.sql(
        "SELECT 13926.0D card1, double('NaN') card2, 150.0D card3, 'discover' card4, 142.0D card5, "
        "'credit' card6, 315.0D addr1, 87.0D addr2"
    )
    assert df.select(entity_id(df)).first()[0] == hashlib.md5(text.encode()).hexdigest()
    ints = df.withColumn("card1", F.lit(13926))
    assert ints.select(entity_id(ints)).first()[0] != df.select(entity_id(df)).first()[0]
    a, b = (d.select(entity_id(d, canonical=True)).first()[0] for d in (df, ints.withColumns(
        {c: F.col(c).cast("int") for c in ("card3", "card5", "addr1", "addr2")})))
    assert a == b


def test_entity_id_missing_forms(spark):
    empty = hashlib.md5(b"_______").hexdigest()
    for value in ("NULL", "'nan'", "'NaN'", "'None'", "'null'", "''"):
        df = spark.sql(f"SELECT {value} AS card4")
        assert df.select(entity_id(df)).first()[0] == empty


def test_event_time(spark):
    assert EVENT_EPOCH_SECONDS == int(EVENT_EPOCH.timestamp())
    row = spark.sql("SELECT 86400 AS s, CAST(NULL AS INT) AS n").select(
        F.unix_seconds(event_time(F.col("s"))), event_time(F.col("n"))
    ).first()
    assert row[0] == int(datetime(2017, 12, 1, tzinfo=timezone.utc).timestamp()) and row[1] is None


# -------------------------------------------------------------- normalisation


def test_normalize(spark, raw_dir):
    out = normalize_transactions(merged(spark, raw_dir))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in TRANSACTIONS]
    got = {r["transaction_id"]: r for r in out.collect()}
    assert got[2987000]["p_emaildomain"] == "gmail.com" and got[2987000]["card2"] is None
    text = "13926.0__150.0_discover_142.0_credit_315.0_87.0"
    assert got[2987000]["derived_user_id"] == hashlib.md5(text.encode()).hexdigest()


def test_malformed_numbers_become_null_and_text_is_cut(spark):
    df = spark.sql(
        "SELECT '1' TransactionID, 'x' isFraud, 'abc' TransactionAmt, '60' TransactionDT, "
        "repeat('p', 20) ProductCD, 'NaN' card1, repeat('c', 80) card4"
    )
    row = normalize_transactions(df).first()
    assert (row["transaction_id"], row["is_fraud"], row["transaction_amt"], row["card1"]) == (1, None, None, None)
    assert (len(row["product_cd"]), len(row["card4"]), row["dist2"]) == (10, 50, None)
    with pytest.raises(ValueError, match="TransactionDT"):
        normalize_transactions(df.drop("TransactionDT"))


def test_identities_need_a_value(spark, raw_dir):
    out = normalize_identities(merged(spark, raw_dir))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in IDENTITIES]
    assert [tuple(r) for r in out.collect()] == [(2987000, "Windows 10", "chrome 63.0", "desktop", "Windows")]
    none = merged(spark, raw_dir).drop("id_30", "id_31", "DeviceType", "DeviceInfo")
    assert normalize_identities(none).count() == 0 and normalize_identities(none).columns == IDENTITIES.names


def test_static_features(spark, raw_dir):
    out = static_features(merged(spark, raw_dir))
    assert out.columns == ["TransactionID", "V1", "id_01"] and dict(out.dtypes)["TransactionID"] == "bigint"
    with pytest.raises(ValueError):
        static_features(out.drop("TransactionID"))


def test_conform(spark):
    at = F.lit(EVENT_EPOCH)
    base = spark.range(1, 4).select(F.col("id").alias("transaction_id"))
    df = base.withColumns(
        {
            "transaction_at": F.when(F.col("transaction_id") != 2, at),
            "card4": F.when(F.col("transaction_id") == 1, "  ").otherwise("\t"),
            "p_emaildomain": F.lit(""),
            "product_cd": F.lit(" W"),
        }
    )
    got = {r["transaction_id"]: r for r in conform_transactions(df).collect()}
    assert sorted(got) == [1, 3] and got[1]["card4"] is None and got[1]["p_emaildomain"] is None
    assert got[3]["card4"] == "\t" and got[1]["product_cd"] == " W"
    assert conform_transactions(df, all_whitespace=True).filter("card4 is not null").count() == 0
    ids = spark.createDataFrame(
        [(1, "", "chrome", "desktop", "  "), (None, "Windows", "x", "y", "z")],
        "transaction_id long, id_30 string, id_31 string, device_type string, device_info string",
    )
    assert [tuple(r) for r in conform_identities(ids).collect()] == [(1, None, "chrome", "desktop", None)]


# ---------------------------------------------------------------------- joins


def test_left_join_spreads_null_keys(spark, rows):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c"), (3, "d")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "k int, r string")
    want = [(1, "a", "x"), (3, "d", None), (None, "b", None), (None, "c", None)]
    assert rows(left_join(left, right, "k")) == want == rows(left_join(left, right, "k", spread_nulls=False))


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(joins, "JOIN_ROWS", 100)
    monkeypatch.setattr(joins, "JOIN_TASK_ROWS", 100)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)


def sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_a_large_left_join_is_dealt_to_more_tasks(spark, rows, small_tasks):
    """Also hot and NULL keys, and keys that come several times on the right side."""
    left = spark.range(900).selectExpr("id AS v", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id * 2 END AS k")
    right = spark.range(600).selectExpr("CASE WHEN id % 40 = 39 THEN NULL WHEN id < 2 THEN 7 ELSE id - id % 4 END AS k", "-id AS w")
    out = left_join_by_size(left, right, "k")
    assert out.columns == ["v", "k", "w"]
    want = rows(left_join(left, right, "k"))
    assert rows(out) == want and rows(left_join_by_size(left, right, "k", left_rows=10**9)) == want
    assert len(sizes(out)) > 12 and max(sizes(out)) <= 250  # the hot key alone has 600 rows
    once = right.dropDuplicates(["k"])
    cold = left.withColumn("k", F.col("v"))
    assert rows(left_join_by_size(cold, once, "k")) == rows(left_join(cold, once, "k"))
    empty = right.limit(0)
    assert rows(left_join_by_size(left, empty, "k")) == rows(left_join(left, empty, "k"))
    assert rows(left_join_by_size(left.limit(0), right, "k")) == []


def test_a_large_raw_pair_is_merged_in_more_tasks(spark, rows, small_tasks):
    transactions = spark.range(800).selectExpr("id AS TransactionID", "id % 2 AS isFraud")
    identities = spark.range(0, 1600, 3).selectExpr("id AS TransactionID", "id AS id_01", "0L AS isFraud")
    out = merge_raw(transactions, identities)
    assert rows(out) == sorted(((i, i % 2, None if i % 3 else i, None if i % 3 else 0) for i in range(800)), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert max(sizes(out)) <= 120  # a quarter of all, 200, when dealt by Spark's default
    few = merge_raw(transactions, identities, limit=5)
    assert rows(few, "TransactionID", "id_01") == [(0, 0), (1, None), (2, None), (3, 3), (4, None)]


def test_many_keys_are_searched_for_copies_in_more_tasks(spark, rows, small_tasks):
    df = spark.range(2000).selectExpr("CASE WHEN id % 5 = 0 THEN -1 WHEN id % 50 = 1 THEN NULL WHEN id > 1990 THEN 2 ELSE id END AS k")
    want = rows(duplicate_keys(df, "k"))
    assert want == [(-1, 400), (2, 9)]
    found = duplicate_keys(df, "k", rows=2000)
    assert rows(found) == want and found.columns == ["k", "copies"]
    unique = spark.range(2000).withColumnRenamed("id", "k")
    assert duplicate_keys(unique, "k", rows=2000).rdd.getNumPartitions() == 20
    assert rows(duplicate_keys(unique, "k", rows=2000)) == []


def test_frequent_keys_are_counted_without_the_others(spark, rows, monkeypatch):
    df = spark.range(5000).selectExpr("CASE WHEN id % 4 = 0 THEN 'a' WHEN id % 9 = 1 THEN 'b' WHEN id % 9 = 2 THEN NULL ELSE CAST(id AS STRING) END AS k")
    counted = dict(df.groupBy("k").count().collect())
    grouped, store = [], joins.materialize

    def stored(out, label):
        if label == "hot":
            grouped.append(out._jdf.queryExecution().optimizedPlan().toString())
        return store(out, label)

    monkeypatch.setattr(joins, "materialize", stored)
    assert rows(frequent_keys(df, "k", 5000, 400)) == [("a", 1250), ("b", counted["b"])]
    assert frequent_keys(df, "k", 5000, 1250) is None and frequent_keys(df, "k", 5000, 5000) is None
    assert all("LeftSemi" in plan for plan in grouped) and len(grouped) == 2
    assert rows(frequent_keys(df, "k", 10**9, 400)) == [("a", 1250), ("b", counted["b"])]  # too small a share


def test_upsert_rules(spark, rows):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 9.0)], "k int, s string, extra double")
    source = spark.createDataFrame([(2, None), (3, "new"), (None, "null key")], "k int, s string")
    want = [(1, "a", 1.0), (2, None, 2.0), (3, "new", None), (None, "n", 9.0), (None, "null key", None)]
    assert rows(upsert(target, source, "k")) == want
    wider = source.withColumn("more", F.lit(1))
    with pytest.raises(ValueError, match="more"):
        upsert(target, wider, "k")
    out = upsert(target, wider, "k", evolve=True)
    assert out.columns == ["k", "s", "extra", "more"] and out.filter("more = 1").count() == 3


def test_upsert_with_a_hot_target_key(spark):
    target = spark.range(300).selectExpr("if(id < 100, 7, id) as k", "id as v")
    source = spark.createDataFrame([(7, 0), (999, 1)], "k long, v long")
    out = upsert(target, source, "k")
    assert out.count() == 301 and out.filter("k = 7 and v = 0").count() == 100


def test_key_helpers(spark, rows):
    df = spark.createDataFrame([(1, 5), (1, 7), (None, 1), (None, 2), (2, 0)], "k int, v int")
    assert rows(duplicate_keys(df, "k")) == [(1, 2)]
    assert rows(latest_per_key(df, "k", "v")) == [(1, 7), (2, 0), (None, 1), (None, 2)]
    assert rows(keep_ids(df, [2, 2, 5], "k")) == [(2, 0)]
    assert keep_ids(df, [], "k").count() == 0
    one = is_subset(spark.range(5), spark.range(3), "id").first()
    assert tuple(one) == (5, 2, False) and is_subset(spark.range(3), spark.range(5), "id").first()["is_subset"]


# ---------------------------------------------------------------------- files


def test_csv_types_follow_names(spark, raw_dir):
    df = read_csv(spark, f"{raw_dir}/train_transaction.csv")
    kinds = dict(df.dtypes)
    assert (kinds["TransactionID"], kinds["isFraud"], kinds["card1"], kinds["card4"]) == ("bigint", "int", "double", "string")
    compact = dict(read_csv(spark, f"{raw_dir}/train_transaction.csv", compact=True).dtypes)
    assert (compact["TransactionID"], compact["isFraud"], compact["V1"]) == ("int", "tinyint", "float")
    assert dict(read_csv(spark, f"{raw_dir}/train_transaction.csv", infer=True).dtypes)["isFraud"] == "int"
    assert raw_schema(["id_12", "id_01", "M4"]).simpleString() == "struct<id_12:string,id_01:double,M4:string>"
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_csv(spark, f"{raw_dir}/absent.csv")


@pytest.mark.parametrize("top_rows", [100_000, 50])
def test_first_rows_in_the_order_of_files(spark, tmp_path, top_rows):
    """Files by name, lines by place, also where a file is read in parts by several tasks."""
    rng, want = random.Random(2), []
    for k, n in enumerate([900, 3, 0, 1200]):
        ids = rng.sample(range(100_000), n)
        (tmp_path / f"part-{k}.csv").write_text("TransactionID,M1\n" + "".join(f"{i},{'x' * (i % 40)}\n" for i in ids))
        want += ids
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        df = read_csv(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 8
        for n in (0, 1, 899, 1000, 2103, 9999):
            got = first_in_files(df, n, top_rows=top_rows).select("TransactionID").collect()
            assert sorted(r[0] for r in got) == sorted(want[:n])
        assert first_in_files(df, -1).count() == first_in_files(df, None).count() == 2103
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_limit_applies_before_the_join(spark, raw_dir):
    out = merged(spark, raw_dir, limit=1).collect()
    assert [(r["TransactionID"], r["id_30"]) for r in out] == [(2987000, "Windows 10")]


def test_inventory(spark, raw_dir, rows):
    got = rows(file_inventory(spark, {"t": f"{raw_dir}/train_transaction.csv", "x": f"{raw_dir}/x.csv"}))
    assert got == [("t", True, 0.0, 2), ("x", False, None, None)]
    require_files(spark, raw_dir, ["train_identity.csv"])
    with pytest.raises(FileNotFoundError, match="test_identity.csv, y.csv"):
        require_files(spark, raw_dir, ["train_identity.csv", "test_identity.csv", "y.csv"])


# --------------------------------------------------------------------- tables


def test_ensure_tables(spark, lake):
    ensure_tables(spark, lake)
    ensure_tables(spark, lake)
    for layer, tables in TABLES.items():
        for name, schema in tables.items():
            found = spark.table(lake.table(layer, name)).schema
            assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in schema]


def test_overwrite_from_itself_and_with_new_columns(spark, lake):
    ensure_tables(spark, lake, ["bronze"])
    name = lake.table("bronze", "transaction_identities")
    df = spark.range(10).selectExpr("id as transaction_id", *[f"'x' as {c}" for c in IDENTITIES.names[1:]])
    assert overwrite_table(df, name) == 10
    assert overwrite_table(spark.table(name).filter("transaction_id < 4"), name) == 4
    assert overwrite_table(spark.table(name).withColumn("more", F.lit(1)), name) == 4
    assert spark.table(name).columns[-1] == "more" and spark.table(name).count() == 4
    assert overwrite_table(spark.table(name).select("more", "id_30"), name) == 4
    assert spark.table(name).columns == ["more", "id_30"]
    kind = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Type'").first()["data_type"]
    assert kind == "MANAGED"


def test_overwrites_leave_no_old_files(spark, lake):
    ensure_tables(spark, lake, ["bronze"])
    name = lake.table("bronze", "transaction_identities")
    df = spark.range(10).selectExpr("id as transaction_id", *[f"'x' as {c}" for c in IDENTITIES.names[1:]])
    df.repartition(3).write.mode("append").saveAsTable(name)
    for _ in range(3):
        overwrite_table(df, name)
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]
    root = Path(location.removeprefix("file:")).parent
    assert len([p for p in root.iterdir() if p.is_dir()]) == 2  # this one and the last
    assert not Path(str(root).removesuffix("_snapshots")).exists()
    others = {p.name for p in root.parent.iterdir()}
    assert {"transactions", "train_features"} <= others  # other tables keep their folders
    overwrite_table(spark.table(name).select("id_30"), name)
    assert {"transactions", "train_features"} <= {p.name for p in root.parent.iterdir()}


@pytest.mark.parametrize("listed", [None, ["k", "v"]])
def test_a_large_upsert_is_dealt_to_more_tasks(spark, rows, monkeypatch, listed):
    """Also hot and NULL keys, a key that only the source has, and columns that are not listed."""
    target = spark.range(900).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id * 2 END AS k", "id AS v", "id % 4 AS w")
    source = spark.range(600).selectExpr("CASE WHEN id % 40 = 39 THEN NULL ELSE id * 3 + 1 END AS k", "IF(id % 5 = 0, NULL, -id) AS v", "-1L AS w")
    want = rows(upsert(target, source, "k", listed))
    monkeypatch.setattr(joins, "UPSERT_ROWS", 100)
    monkeypatch.setattr(joins, "UPSERT_TASK_ROWS", 100)
    monkeypatch.setattr(joins, "broadcast_if_small", lambda df: df)
    out = upsert(target, source, "k", listed)
    assert rows(out) == want
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) > 12 and max(sizes) <= 250  # the hot key alone has 300 rows
    empty = source.limit(0)
    assert rows(upsert(target, empty, "k", listed)) == rows(target) and rows(upsert(target.limit(0), source, "k")) == rows(source)


def test_a_small_batch_leaves_a_large_target_where_it_is(spark, rows, monkeypatch):
    target = spark.range(900).selectExpr("id AS k", "id AS v")
    source = spark.range(800, 1000).selectExpr("id AS k", "-id AS v")
    want = rows(upsert(target, source, "k"))
    monkeypatch.setattr(joins, "UPSERT_ROWS", 100)
    assert rows(upsert(target, source, "k")) == want


def test_upsert_table(spark, lake, rows):
    ensure_tables(spark, lake, ["bronze"])
    name = lake.table("bronze", "train_features")
    first = spark.createDataFrame([(1, 0.1), (2, 0.2)], "TransactionID long, V1 double")
    assert write_features(first, name) == 2
    assert write_features(first.filter("false"), name) == 0
    assert write_features(spark.createDataFrame([(2, 0.9), (3, 0.3)], first.schema), name) == 2
    assert rows(spark.table(name)) == [(1, 0.1), (2, 0.9), (3, 0.3)]
    twice = first.unionByName(first)
    with pytest.raises(ValueError, match="duplicate"):
        upsert_table(twice, name, "TransactionID")
    assert upsert_table(twice, name, "TransactionID", keep_latest_by="V1") == 2
    with pytest.raises(ValueError, match="V2"):
        write_features(first.withColumn("V2", F.lit(1.0)), name)
    assert write_features(first.withColumn("V2", F.lit(1.0)), name, evolve=True) == 2
    assert rows(spark.table(name)) == [(1, 0.1, 1.0), (2, 0.2, 1.0), (3, 0.3, None)]


# ----------------------------------------------------------------------- jobs


def counts(spark, lake):
    return {
        (layer, name): spark.table(lake.table(layer, name)).count()
        for layer, name in (
            ("bronze", "transactions"),
            ("bronze", "transaction_identities"),
            ("bronze", "train_features"),
            ("silver", "transactions"),
            ("silver", "transaction_identities"),
        )
    }


def test_ingest_end_to_end(spark, lake, raw_dir, tmp_path, rows):
    done = jobs.ingest(spark, lake, data_dir=raw_dir)
    assert done == jobs.IngestResult(2, 2, 1, 2, lake.table("bronze", "train_features"), 2, 1)
    before = counts(spark, lake)
    assert list(before.values()) == [2, 1, 2, 2, 1]
    assert spark.table(lake.table("bronze", "train_features")).columns == ["TransactionID", "V1", "id_01"]

    jobs.ingest(spark, lake, data_dir=raw_dir)  # again: nothing changes
    assert counts(spark, lake) == before

    extra = write_raw(tmp_path / "extra", [THIRD], "TransactionID", ["2987002"])
    with pytest.raises(ValueError):
        jobs.ingest(spark, lake, data_dir=raw_dir, skip_tables=True, skip_features=True)
    jobs.ingest(spark, lake, data_dir=extra)
    ids = spark.table(lake.table("bronze", "train_features")).select("TransactionID").distinct()
    assert ids.count() == 3

    changed = write_raw(tmp_path / "changed", [ROWS[0].replace("0.1", "0.999").replace("68.5", "70.0")])
    jobs.ingest(spark, lake, data_dir=changed)
    assert counts(spark, lake)["bronze", "transactions"] == 3
    row = spark.table(lake.table("bronze", "train_features")).filter("TransactionID = 2987000").first()
    assert row["V1"] == 0.999
    assert spark.table(lake.table("silver", "transactions")).filter("transaction_amt = 70.0").count() == 1

    assert jobs.write_behavioral(spark, lake, limit=None) == 3
    gold = spark.table(lake.table("gold", "behavioral_features"))
    assert [(f.name, f.dataType) for f in gold.schema] == [(f.name, f.dataType) for f in BEHAVIORAL]
    training = jobs.training_set(spark, lake)
    assert training.count() == 3 and "velocity_1h" in training.columns


def test_dry_run_and_skips(spark, lake, raw_dir):
    dry = jobs.ingest(spark, lake, data_dir=raw_dir, dry_run=True)
    assert (dry.rows_read, dry.rows_merged, dry.identities_merged, dry.feature_rows) == (2, 0, 1, 2)
    assert not spark.catalog.databaseExists(lake.bronze)
    done = jobs.ingest(spark, lake, data_dir=raw_dir, skip_features=True, promote_silver=False)
    assert (done.feature_rows, done.features_table, done.silver_transactions) == (0, None, 0)
    assert jobs.promote(spark, lake, dry_run=True) == jobs.PromoteResult(2, 1)
    done = jobs.ingest(spark, lake, data_dir=raw_dir, skip_tables=True)
    assert (done.rows_merged, done.feature_rows, done.silver_transactions) == (0, 2, 0)


def test_empty_gold_keeps_its_schema(spark, lake):
    ensure_tables(spark, lake)
    assert jobs.write_behavioral(spark, lake) == 0
    assert spark.table(lake.table("gold", "behavioral_features")).columns == BEHAVIORAL.names


def test_command_line(spark, lake, raw_dir, monkeypatch):
    for variable, value in (
        ("FRAUD_CATALOG", lake.catalog), ("FRAUD_BRONZE_SCHEMA", lake.bronze),
        ("FRAUD_SILVER_SCHEMA", lake.silver), ("FRAUD_GOLD_SCHEMA", lake.gold),
    ):
        monkeypatch.setenv(variable, value)
    assert cli.run(spark, ["ingest", "--data-dir", raw_dir, "--limit", "-1"])["rows_merged"] == 2
    assert cli.run(spark, ["promote", "--dry-run"]) == {"transactions_written": 2, "identities_written": 1}
    assert cli.run(spark, ["features", "--limit", "1", "--dry-run"]) == {"rows": 1, "written": False}
    assert cli.run(spark, ["features", "--limit", "-1", "--schema-gold", lake.gold]) == {"rows": 2, "written": True}


# ---------------------------------------------------------------------- names


def test_names(monkeypatch):
    for name in ("CATALOG", "BRONZE_SCHEMA", "SCHEMA", "SILVER_SCHEMA", "GOLD_SCHEMA", "VOLUME"):
        monkeypatch.delenv(f"FRAUD_{name}", raising=False)
    lake = Lake()
    assert lake.table("bronze", "transactions") == "fraud_dev.bronze.transactions"
    with pytest.raises(ValueError, match="FRAUD_VOLUME"):
        lake.raw_files()
    monkeypatch.setenv("FRAUD_SCHEMA", "legacy")
    assert Lake().bronze == "legacy"
    monkeypatch.setenv("FRAUD_BRONZE_SCHEMA", "new")
    monkeypatch.setenv("FRAUD_CATALOG", "prod")
    assert Lake().table("bronze", "x") == "prod.new.x" and Lake(catalog="c").schema("gold") == "c.gold"
    assert Lake().raw_files("/data/")["transaction"] == "/data/train_transaction.csv"
    assert Lake(volume="/landing/").raw_files()["identity"] == "/landing/raw/train_identity.csv"
    with pytest.raises(ValueError):
        Lake().schema("iron")


def test_stage_counts(spark, raw_dir):
    assert tuple(stage_counts(merged(spark, raw_dir)).first()) == (2, 2, 1)
