import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from riverbed.llm import sharding as S
from riverbed.llm.catalog import op9_rendezvous_shards


def test_query(spark, sf, docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = op9_rendezvous_shards(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    slots = {}
    for r in rows:
        t = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(t) + 1, zlib.crc32(t), "key")
        assert 0 <= r["shard"] < 16 and r["grown_shard"] in (r["shard"], 16)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_law_against_brute_force(spark):
    """The shard is that of the largest -w / ln(u); weights share the rows out,
    and a change of shards or of one weight moves no others."""
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    weights = [1.0, 2.0, 0.0, 1.0]
    draws = [S.draw(F.col("doc_id"), s).alias(f"u{s}") for s in range(5)]
    rows = ids.select("doc_id", S.rendezvous(F.col("doc_id"), weights).alias("a"), S.rendezvous(F.col("doc_id"), [*weights, 3.0]).alias("b"),
                      S.rendezvous(F.col("doc_id"), [1.0, 4.0, 0.0, 1.0]).alias("c"), *draws).collect()
    for r in rows:
        score = lambda ws: max(range(len(ws)), key=lambda s: (-ws[s] / math.log(r[f"u{s}"]), -s))
        assert r["a"] == score(weights) and r["b"] == score([*weights, 3.0])
        assert r["b"] in (r["a"], 4) and r["c"] in (r["a"], 1)
    n = Counter(r["a"] for r in rows)
    assert n[2] == 0 and abs(n[1] / 20_000 - 0.5) < 0.02 and abs(n[0] / 20_000 - 0.25) < 0.02
    assert abs(sum(r["b"] == 4 for r in rows) / 20_000 - 3 / 7) < 0.02


def test_edge_rows(spark, edge, empty, clashing):
    for df in (edge, clashing):
        rows = S.assign(df, [1.0] * 4, block_rows=2).collect()
        assert len(rows) == edge.count()
        slots = {}
        for r in rows:
            slots.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
        assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1 and len({r["shard"] for r in rows if r["doc_id"] == 6}) == 1
    null = [r for r in S.assign(edge, [1.0]).collect() if r["doc_id"] == 0]
    assert [(r["size"], r["text_crc32"]) for r in null] == [(1, 0)]
    assert S.assign(empty, [1.0] * 4).count() == 0


def test_one_key_with_a_third_of_all_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text"))
    rows = S.assign(df, [1.0] * 4, block_rows=64).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_moved(spark):
    out = S.assign(spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")), [1.0] * 3)
    rows = S.moved(out).collect()
    assert {r["grown_shard"] for r in rows} == {3} and 150 < sum(r["rows"] for r in rows) < 350


def test_names_with_a_dot(spark, edge):
    dotted = edge.withColumnsRenamed({"doc_id": "doc.id", "text": "the.text"})
    got = S.assign(dotted, [1.0] * 4, key="doc.id", text="the.text")
    assert got.columns[0] == "doc.id"
    place = lambda rows: sorted((r[0] is None, r[0] or 0, r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in rows)
    assert place(got.collect()) == place(S.assign(edge, [1.0] * 4).collect())
