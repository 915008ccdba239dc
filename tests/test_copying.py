"""Listings made by tasks, and the copy job."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from riverbed.operators import copying as CP
from riverbed.sources import listing as LS
from riverbed.sources.paths import filesystem, qualified

META = ("source_bucket string, source_object_key string, target_bucket string, target_object_key string, "
        "size_bytes long, etag string, status string")


def put(root, key, data):
    path = os.path.join(root, key)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def md5(data):
    return hashlib.md5(data).hexdigest()


def meta_of(spark, objects, status="ACTIVE"):
    return spark.createDataFrame([("src", k, "dst", k, len(v), md5(v), status) for k, v in objects.items()], META)


def files(root):
    out = {}
    for folder, _, names in os.walk(root):
        for n in names:
            if n.startswith(".") and n.endswith(".crc"):
                continue
            with open(os.path.join(folder, n), "rb") as f:
                out[os.path.relpath(os.path.join(folder, n), root)] = f.read()
    return out


def test_listing_of_many_prefixes(spark, tmp_root):
    """10,000 files in 400 prefixes of several depths; no file index of the driver."""
    want = set()
    for i in range(10_000):
        key = f"p{i % 20}/" + ("q%d/" % (i % 400 // 20) if i % 3 else "") + ("deep/er/" if i % 7 == 0 else "") + f"f{i}"
        want.add((key, i % 5))
        put(f"{tmp_root}/b", key, b"x" * (i % 5))
    os.makedirs(f"{tmp_root}/b/empty/one")
    for least in (None, 1, 10 ** 9):                  # walked by tasks after some rounds, at once, never
        listed = LS.list_objects(spark, {"b": f"{tmp_root}/b"}, least_prefixes=least)
        rows = listed.collect()
        assert len(rows) == 10_000 and {(r["object_key"], r["size_bytes"]) for r in rows} == want
        assert all(r["last_modified"] is not None for r in rows)
    plan = LS.bucket_roots(spark, {"b": f"{tmp_root}/b"}).withColumn("object_key", F.lit("")).mapInArrow(LS._list(True), LS.LISTED)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in text and "FileScan" not in text


def test_missing_buckets(spark, tmp_root):
    put(f"{tmp_root}/b", "k", b"1")
    roots = {"b": f"{tmp_root}/b", "gone": f"{tmp_root}/gone"}
    got = LS.object_inventory(spark, roots, skip_missing=True, with_etag=True).collect()
    assert [(r["bucket"], r["object_key"], r["etag"]) for r in got] == [("b", "k", md5(b"1"))]
    with pytest.raises(FileNotFoundError):
        LS.object_inventory(spark, roots)
    assert LS.object_inventory(spark, {"gone": f"{tmp_root}/gone"}, skip_missing=True).collect() == []


def test_only_what_differs_is_written(spark, tmp_root):
    src, dst = f"{tmp_root}/src", f"{tmp_root}/dst"
    objects = {f"d{i % 3}/k{i}": f"content {i}".encode() * 9 for i in range(12)}
    for k, v in objects.items():
        put(src, k, v)
    put(dst, "d0/k0", objects["d0/k0"])                                  # the same
    put(dst, "d1/k1", b"y" * len(objects["d1/k1"]))                      # other bytes
    put(dst, "d2/k2", b"short")                                          # another size
    put(dst, "orphan", b"stays")
    kept = os.stat(f"{dst}/d0/k0").st_mtime_ns
    rows = CP.copy_verified(spark, meta_of(spark, objects), {"src": src}, {"dst": dst}).collect()
    assert {r["target_object_key"] for r in rows if r["copied"]} == set(objects) - {"d0/k0"}
    assert all(r["verified"] and r["error"] is None for r in rows) and len(rows) == 12
    assert files(dst) == objects | {"orphan": b"stays"} and os.stat(f"{dst}/d0/k0").st_mtime_ns == kept
    again = CP.copy_verified(spark, meta_of(spark, objects), {"src": src}, {"dst": dst}).collect()
    assert not any(r["copied"] for r in again) and all(r["verified"] for r in again)
    assert sorted(os.listdir(tmp_root)) == ["dst", "src"]                # no attempts are left


def test_killed_attempt_leaves_no_part(spark, tmp_root):
    src, dst = f"{tmp_root}/src", f"{tmp_root}/dst"
    os.makedirs(dst)
    objects = {f"k{i}": os.urandom(100_000 + i) for i in range(8)}
    for k, v in objects.items():
        put(src, k, v)
    with pytest.raises(Exception, match="killed"):                       # local[4] ends a job at its first failure
        CP.copy_verified(spark, meta_of(spark, objects), {"src": src}, {"dst": dst}, _fail=f"{tmp_root}/died")
    assert os.path.exists(f"{tmp_root}/died")
    part = files(dst)
    assert part and all(objects[k] == v for k, v in part.items())        # whole objects only
    rows = CP.copy_verified(spark, meta_of(spark, objects), {"src": src}, {"dst": dst}).collect()
    assert all(r["verified"] for r in rows) and files(dst) == objects
    assert {r["target_object_key"] for r in rows if not r["copied"]} == set(part)


def test_sources_that_went_and_unknown_buckets(spark, tmp_root):
    src, dst = f"{tmp_root}/src", f"{tmp_root}/dst"
    os.makedirs(dst)
    put(src, "there", b"1")
    rows = meta_of(spark, {"there": b"1", "gone": b"2"}).unionByName(
        spark.createDataFrame([("other", "k", "dst", "k", 1, "e", "ACTIVE"), ("src", "there", "dst", "off", 1, "e", "MISSING")], META))
    got = {r["target_object_key"]: r for r in CP.copy_verified(spark, rows, {"src": src, "none": f"{tmp_root}/no"}, {"dst": dst}).collect()}
    assert set(got) == {"there", "gone", "k"} and got["there"]["verified"]
    assert not got["gone"]["copied"] and not got["gone"]["verified"] and got["gone"]["error"]
    assert got["k"]["error"] == "unknown bucket"
    changed = spark.createDataFrame([("src", "there", "dst", "n", 1, md5(b"2"), "ACTIVE")], META)
    bad = CP.copy_verified(spark, changed, {"src": src}, {"dst": dst}).first()
    assert bad["copied"] and not bad["verified"]                         # the source is not what the plan says


def test_paths(spark, tmp_root):
    uri = qualified(spark, tmp_root)
    assert uri.startswith("file:/") and filesystem(uri)[1] == tmp_root
    with pytest.raises(ValueError):
        filesystem("/no/scheme")
    with pytest.raises(ValueError):
        filesystem("jdbc:x")
