import base64
import hashlib

from txnspark.llm import warc
from txnspark.llm.warc import archive_round_trip, write_archive
from txnspark.scratch import scratch_path


def pages():
    out = [(k, f"http://x/{k}", f"<p>page {k % 7} é漢</p>") for k in range(30, 0, -1)]
    return out + [(31, None, None), (32, "u", ""), (33, "bad\r\nWARC-Type: x", "y" * 200_000), (None, "n", "alone"), (None, "m", "<p>page 1 é漢</p>")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, b"z", "x") for r in rows], "page_id long, url string, html string, payload binary, key string")


def test_round_trip(spark, monkeypatch):
    for bound in (warc.BROADCAST_KEYS, 0):
        monkeypatch.setattr(warc, "BROADCAST_KEYS", bound)
        got = archive_round_trip(frame(spark, pages())).collect()
        assert len(got) == len(pages())
        first = {}
        for p, _, html in pages():
            if p is not None:
                first[html or ""] = min(first.get(html or "", p), p)
        html = {p: t or "" for p, _, t in pages() if p is not None}
        for r in got:
            assert r.verified
            if r.page_id is None:
                assert (r.record_type, r.refers_to) in {("response", None), ("revisit", 1)}
                continue
            data = html[r.page_id].encode()
            head = first[html[r.page_id]]
            assert r.payload_bytes == len(data)
            assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
            assert (r.record_type, r.refers_to) == (("response", None) if head == r.page_id else ("revisit", head))


def test_records_are_well_formed(spark):
    for r in archive_round_trip(frame(spark, pages())).collect():
        raw = bytes(r.record)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        assert lines[0] == "WARC/1.1" and fields["WARC-Type"] == r.record_type
        assert len(rest) == int(fields["Content-Length"]) + 4 and rest.endswith(b"\r\n\r\n")
        assert raw.startswith(bytes(r.headers))
        if r.record_type == "response":
            assert rest[:-4].partition(b"\r\n\r\n")[2] == bytes(r.payload)


def test_payloads_are_stored_once(spark):
    path = scratch_path(spark, "archive")
    rows = pages() + pages()[:9]  # repeated rows
    write_archive(frame(spark, rows), path)
    kept = spark.read.parquet(f"{path}/payloads")
    assert kept.count() == kept.select("key").distinct().count() == len({t or "" for _, _, t in rows})
    assert spark.read.parquet(f"{path}/records").count() == len(rows)


def test_small_payloads_and_empty_tables(spark):
    got = archive_round_trip(frame(spark, pages()), min_bytes=1_000).collect()
    assert {r.record_type for r in got} == {"response"}
    assert archive_round_trip(frame(spark, pages()).limit(0)).collect() == []


def test_damage_is_seen(spark):
    path = scratch_path(spark, "archive")
    write_archive(frame(spark, pages()), path)
    kept = spark.read.parquet(f"{path}/payloads").collect()
    spark.createDataFrame([(r.key, b"changed") for r in kept], "key binary, payload binary").write.mode("overwrite").parquet(f"{path}/payloads")
    assert not any(r.verified for r in warc.read_archive(spark, path).collect())
