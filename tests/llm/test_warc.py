import gzip
import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from riverbed.llm import warc as R
from riverbed.llm.catalog import ORACLE, op6_warc
from riverbed.llm.common import shared_fs

SCHEMA = "page_id long, url string, html string"
BIG = "é" * 600
ROWS = [(1, "http://a/", BIG), (2, "http://b/", BIG), (3, None, None), (4, "http://d/", ""), (5, "http://e/\r\nX: y", "x" * 999),
        (6, "http://f/", "x" * 999), (7, "http://g/", "x" * 1000), (8, "http://h/", "x" * 1000), (8, "http://h/", "x" * 1000),
        (None, "http://n/", BIG), (None, "http://m/", "y" * 2000), (None, "http://m/", "y" * 2000), (9, "http://z/", "a\r\n\r\nb")]


def brute(rows):
    payload = lambda r: (r[2] or "").encode()
    first = {}
    for r in rows:
        if len(payload(r)) >= 1000 and r[0] is not None:
            first[payload(r)] = max(first.get(payload(r), r[0]), r[0])
    out = []
    for r in rows:
        p = payload(r)
        f = first.get(p)
        revisit = f is not None and f != r[0]
        out.append((r[0], len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


def test_query_equals_oracle(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{sf}/pages.parquet')")
    assert found(op6_warc(spark, sf)) == sorted(con.execute(ORACLE["op6_warc"]).fetchall(), key=repr)


def test_edge_rows_round_trip(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA).withColumn("digest", F.lit("mine")).withColumn("first", F.lit("mine"))
    index = R.write_archives(pages, file_bytes=500)
    got = R.read_records(index)
    assert found(got) == brute(ROWS)
    payloads = sorted((repr((r["page_id"], bytes(r["payload"]))) for r in got.where("record_type = 'response'").collect()))
    want = brute(ROWS)
    kept = [(r[0], (r[2] or "").encode()) for r in ROWS if (r[0], len((r[2] or "").encode()), hashlib.sha1((r[2] or "").encode()).hexdigest(), "response", None) in want]
    assert payloads == sorted(map(repr, kept))
    urls = {r["page_id"]: r["url"] for r in got.collect()}
    assert urls[5] == "http://e/%0D%0AX: y" and urls[3] == ""


def test_selected_records_by_ranges(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    index = R.write_archives(pages)
    some = index.where("page_id % 5 = 0")
    texts = {r["page_id"]: r["html"] for r in pages.collect()}
    for gap, most in ((0, 1 << 22), (1 << 16, 1 << 22), (1 << 16, 4000)):
        ranges = R.ranges(some, gap, most)
        assert ranges.selectExpr("sum(size(records))").first()[0] == some.count()
        got = R.read_records(some, gap, most).collect()
        assert {r["page_id"]: bytes(r["payload"]).decode() for r in got} == {k: v for k, v in texts.items() if k % 5 == 0}
    assert R.ranges(some, 1 << 30, 1 << 30).count() == some.select("file").distinct().count()
    assert R.ranges(index, 0, 1 << 30).count() == index.select("file").distinct().count()


def test_files_are_warc(spark):
    index = R.write_archives(spark.createDataFrame(ROWS[:2], SCHEMA).coalesce(1)).orderBy("file", "offset").collect()
    data = b""
    for file in sorted({r["file"] for r in index}):
        fs, path = shared_fs(file)
        with fs.open_input_file(path) as f:
            data += gzip.decompress(f.read())
    assert data.count(b"WARC/1.1\r\n") == 2 and data.count(b"WARC-Type: revisit\r\n") == 1 and data.count(b"WARC-Type: response\r\n") == 1
    assert f"WARC-Payload-Digest: sha1:{hashlib.sha1(BIG.encode()).hexdigest()}\r\n".encode() in data and data.endswith(b"\r\n\r\n")


def test_a_damaged_payload_ends_the_job(spark):
    index = R.write_archives(spark.createDataFrame([(1, "u", "abc")], SCHEMA)).withColumn("page_id", F.lit(1))
    row = index.first()
    fs, path = shared_fs(row["file"])
    bad = R.record(1, "u", b"abd", hashlib.sha1(b"abc").hexdigest(), None)
    with fs.open_output_stream(path, compression=None) as f:
        f.write(bad)
    with pytest.raises(Exception, match="does not match"):
        R.read_records(index.withColumn("length", F.lit(len(bad)).cast("long"))).collect()


def test_empty(spark):
    assert R.read_records(R.write_archives(spark.createDataFrame([], SCHEMA))).count() == 0
