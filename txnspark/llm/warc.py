"""Content-addressed WARC archive.

An archive is two tables: ``payloads`` holds the bytes of every distinct payload once,
by SHA-256; ``records`` holds each record's exact headers and the key of its payload.
A join puts the original records together again.  Digests are computed where the bytes
lie; only ids, lengths and digests are shuffled when an archive is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnspark.scratch import materialize, scratch_path

from .store import stored

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
CRLF = "\r\n"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Keys (about 50 bytes each) that may be broadcast to pick payloads; more are joined by a shuffle.
BROADCAST_KEYS = 500_000


def sha1_base32(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: every 5 hex digits are 4 digits of base 32."""
    code = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(code, k, 5), 16, 32), 4, "0") for k in range(1, 41, 5)]
    return F.translate(F.concat(*parts), _DIGITS, BASE32)


def _http(length: Column) -> Column:
    return F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        length.cast("string"),
        F.lit(CRLF * 2),
    )


def _record_id(*parts: Column) -> Column:
    code = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    cut = [F.substring(code, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _header(fields: list[tuple[str, Column]]) -> Column:
    """Header lines; a field that is null is left out."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in fields]
    return F.concat(F.lit(f"WARC/1.1{CRLF}"), F.concat_ws("", *lines), F.lit(CRLF))


def write_archive(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
) -> None:
    """Write a record for every row below ``path``.

    Payloads are the column's UTF-8 (null: empty).  Among rows with equal payloads of
    at least ``min_bytes`` bytes those with the least id are responses and the others
    revisit it; a null id is above all others, and is a response if no id is known.
    Repeated rows are repeated records of one payload.  Line breaks in a URL are
    percent-encoded, so that headers stay lines.  Other columns are ignored.
    """
    data = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    source = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), data.alias("payload")
    ).withColumn("key", F.unhex(F.sha2("payload", 256)))
    rows = stored(
        source.select(
            "id", "url", "key", F.octet_length("payload").cast("long").alias("n"), sha1_base32(F.col("payload")).alias("digest")
        ),
        "rows",
    )
    heads, n = materialize(rows.groupBy("key").agg(F.min("id").alias("head")), "heads")
    again = (F.col("n") >= min_bytes) & F.coalesce(F.col("id") != F.col("head"), F.col("head").isNotNull())
    records = rows.join(heads, "key").withColumn("again", again)
    url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = _http(F.col("n"))
    length = F.octet_length(http) + F.when(F.col("again"), F.lit(0)).otherwise(F.col("n"))
    headers = _header(
        [
            ("WARC-Type", F.when(F.col("again"), "revisit").otherwise("response")),
            ("WARC-Record-ID", _record_id(F.col("id"), F.col("url"), F.col("digest"))),
            ("WARC-Date", F.lit(DATE)),
            ("WARC-Target-URI", url),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
            ("WARC-Profile", F.when(F.col("again"), F.lit(PROFILE))),
            ("WARC-Refers-To-Page", F.when(F.col("again"), F.col("head").cast("string"))),
            ("WARC-Page", F.col("id").cast("string")),
            ("Content-Type", F.lit("application/http; msgtype=response")),
            ("Content-Length", length.cast("string")),
        ]
    )
    records.select("key", F.concat(headers, http).cast("binary").alias("headers")).write.parquet(f"{path}/records")

    picked = F.broadcast(heads) if n <= BROADCAST_KEYS else heads
    picked = picked.withColumnRenamed("key", "k")
    chosen = source.join(picked, (F.col("key") == F.col("k")) & F.col("id").eqNullSafe(F.col("head")), "left_semi")
    chosen = chosen.select("key", "payload")
    if rows.join(heads, "key").filter(F.col("id").eqNullSafe(F.col("head"))).count() > n:
        chosen = chosen.dropDuplicates(["key"])  # the row that holds a payload is itself repeated
    chosen.write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, its fields parsed from the stored headers.

    Columns: page_id, url, record_type, refers_to, declared_digest, headers, payload,
    payload_bytes, payload_digest (computed from the payload read), verified, record
    (the original bytes).  What is not asked for isn't shuffled.
    """
    text = F.col("headers").cast("string")

    def field(name):
        found = F.regexp_extract(text, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
        return F.when(F.contains(text, F.lit(f"\r\n{name}: ")), found)

    records = spark.read.schema("key binary, headers binary").parquet(f"{path}/records")
    records = records.select(
        F.col("key").alias("_key"),
        field("WARC-Page").cast("long").alias("page_id"),
        field("WARC-Target-URI").alias("url"),
        field("WARC-Type").alias("record_type"),
        field("WARC-Refers-To-Page").cast("long").alias("refers_to"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("declared_digest"),
        "headers",
    )
    payloads = spark.read.schema("key binary, payload binary").parquet(f"{path}/payloads")
    payloads = payloads.select(
        "key",
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        sha1_base32(F.col("payload")).alias("payload_digest"),
        (F.unhex(F.sha2("payload", 256)) == F.col("key")).alias("_sound"),
    )
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return (
        records.join(payloads, F.col("_key") == F.col("key"), "left")
        .withColumn("verified", F.coalesce(F.col("_sound") & (F.col("declared_digest") == F.col("payload_digest")), F.lit(False)))
        .withColumn("record", F.concat("headers", body, F.lit((CRLF * 2).encode())))
        .drop("_key", "key", "_sound")
    )


def archive_round_trip(pages: DataFrame, *, path: str | None = None, **columns) -> DataFrame:
    """Write ``pages`` as an archive (a fresh folder in the shared scratch space by default) and read it back."""
    path = path or scratch_path(pages.sparkSession, "warc")
    write_archive(pages, path, **columns)
    return read_archive(pages.sparkSession, path)


def _base32_sql(code: str) -> str:
    digits = [
        f"substr('{BASE32}', ((('0x' || substr({code}, {k}, 5))::BIGINT >> {shift}) & 31)::INT + 1, 1)"
        for k in range(1, 41, 5)
        for shift in (15, 10, 5, 0)
    ]
    return " || ".join(digits)


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS head, sha1(html) AS code FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_base32_sql("code")} AS payload_digest,
       CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> head THEN head END AS refers_to
FROM m
"""
