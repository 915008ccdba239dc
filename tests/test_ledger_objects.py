"""Run ledger paths, object inventory listing, copy plan."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from riverbed.operators import ledger as L
from riverbed.operators import objects as OB


def test_ledger_paths(spark, tmp_root):
    path = os.path.join(tmp_root, "ledger")
    ok = L.run_job(spark, path, "rel", lambda: ({"a": 1}, 0))
    warn = L.run_job(spark, path, "rel", lambda: ({"a": 2}, 3))

    def boom():
        raise RuntimeError("source unreachable")
    with pytest.raises(RuntimeError):
        L.run_job(spark, path, "rel", boom)
    runs = {r["batch_id"]: r for r in L.runs_view(L.read_ledger(spark, path)).collect()}
    assert runs[ok["batch_id"]]["status"] == "SUCCESS"
    assert runs[warn["batch_id"]]["status"] == "SUCCESS_WITH_WARNINGS"
    failed = [r for r in runs.values() if r["status"] == "FAILED"]
    assert len(failed) == 1 and failed[0]["error_message"] == "source unreachable"
    assert all(r["duration_seconds"] >= 0 for r in runs.values())
    assert len(runs) == 3                                   # RUNNING rows folded away


def test_inventory_listing_prunes_content(spark, tmp_root):
    for b, names in {"clean-images": ["a/x.png", "y.png"], "clean-audio": ["z.wav"]}.items():
        for n in names:
            p = os.path.join(tmp_root, b, n)
            os.makedirs(os.path.dirname(p), exist_ok=True)
            with open(p, "wb") as f:
                f.write(b"1234")
    inv = OB.object_inventory(spark, {b: os.path.join(tmp_root, b)
                                      for b in ("clean-images", "clean-audio", "clean-missing")}, skip_missing=True)
    with pytest.raises(Exception):                          # a target listing fails loudly
        OB.object_inventory(spark, {"clean-missing": os.path.join(tmp_root, "clean-missing")})
    etag = OB.object_inventory(spark, {"clean-audio": os.path.join(tmp_root, "clean-audio")}, with_etag=True).first()["etag"]
    assert etag == hashlib.md5(b"1234").hexdigest()
    rows = sorted((r["bucket"], r["object_key"], r["size_bytes"]) for r in inv.collect())
    assert rows == [("clean-audio", "z.wav", 4), ("clean-images", "a/x.png", 4), ("clean-images", "y.png", 4)]
    plan = inv._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_copy_plan_only_changed(spark):
    meta = spark.createDataFrame(
        [("s", "k1", "clean-images", "k1", 4, "e1", "ACTIVE"), ("s", "k2", "clean-images", "k2", 5, "e2", "ACTIVE"),
         ("s", "k3", "clean-images", "k3", 6, "e3", "ACTIVE")],
        "source_bucket string, source_object_key string, target_bucket string, target_object_key string, "
        "size_bytes long, etag string, status string")
    inv = spark.createDataFrame([("clean-images", "k1", 4, "e1"), ("clean-images", "k2", 9, "e2")],
                                "bucket string, object_key string, size_bytes long, etag string")
    got = sorted(r["target_object_key"] for r in OB.copy_plan(meta, inv).collect())
    assert got == ["k2", "k3"]


def test_message_formats(spark):
    import json
    from riverbed.operators import changes as CH
    ev = spark.createDataFrame([("o1", "e1", 5)], "object_id string, event_id string, size_bytes long")
    m = OB.event_messages(ev).first()
    assert m["key"] == "o1" and list(json.loads(m["value"])) == ["event_id", "object_id", "size_bytes"]
    dead = spark.createDataFrame([("t", 0, 3, '{"id":1}', "bad")],
                                 "source_topic string, source_partition int, source_offset long, "
                                 "message_key string, error_message string")
    d = CH.dlq_messages(dead).first()
    assert d["key"] == '{"id":1}' and json.loads(d["value"])["error_message"] == "bad"
