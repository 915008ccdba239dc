"""What contended business keys cost (F2, F3): narrow tables, groups whose tables shrink."""

import json
import random

from pyspark.sql import functions as F

from riverbed.operators import changes as CH
from riverbed.operators import groups as G
from riverbed.plans import catalog as CT
from riverbed.sources.feeds import FEED_SCHEMA

T = "shop.reviewsdb.product_reviews"


def _claim(offset, op, who, key=None):
    doc = None if key is None else json.dumps({"_id": {"$oid": who}, "review_id": key, "title": "t"})
    return (T, 0, offset, json.dumps({"id": json.dumps({"$oid": who})}),
            json.dumps({"op": op, "after": doc, "source": {"db": "d", "collection": "product_reviews"}, "ts_ms": offset}))


def test_tables_of_claims_hold_what_is_read(spark, monkeypatch):
    """Claims, dead letters and live rows need no cleaned column but the keys."""
    seen, real = [], CT.materialize
    monkeypatch.setattr(CT, "materialize", lambda df: seen.append(df.columns) or real(df))
    feed = spark.createDataFrame([_claim(0, "c", "a", "1"), _claim(1, "c", "b", "1"), _claim(2, "d", "a"), _claim(3, "c", "b", "1")], FEED_SCHEMA)
    got = CT._claims_in_batches(feed, (("one", [F.lit(True)]), ("many", [F.col("offset") < 2, F.col("offset") >= 2])))
    assert sorted((r["batches"], r["kind"], r["_id"], r["source_offset"]) for r in got.collect()) == [
        (b, k, i, o) for b in ("many", "one") for k, i, o in (("dead", None, 1), ("live", "b", None))]
    assert len(seen) == 9 and not any({"title", "document", "_cdc", "_doc"} & set(columns) for columns in seen)


def test_tables_of_groups_shrink(spark, monkeypatch):
    """A chain of 1,025 nodes in random order, as hashed ids and keys make one."""
    rows, real = [], G.materialize

    def counted(df):
        out = real(df)
        rows.append(out.count())
        return out
    monkeypatch.setattr(G, "materialize", counted)
    names = [f"{n:05d}" for n in range(1025)]
    random.Random(5).shuffle(names)
    got, _ = G.connected(spark.createDataFrame(list(zip(names, names[1:])), "a string, b string"))
    assert {tuple(r) for r in got.collect()} == {(n, "00000") for n in names}
    assert sum(rows) < 20 * len(names)


def test_nodes_of_no_neighbour_and_of_no_name(spark):
    edges = [("a", "a"), ("b", None), (None, "c"), (None, None), ("d", "e"), ("e", "f"), ("e", "d")]
    got, _ = G.connected(spark.createDataFrame(edges, "a string, b string"))
    assert {r["node"]: r["group"] for r in got.collect()} == {"a": "a", "b": "b", "c": "c", "d": "d", "e": "d", "f": "d"}


def test_contention_groups_are_of_ids_and_keys_apart(spark):
    """An id that reads like a key is no key; groups are numbers."""
    pairs = spark.createDataFrame([("1", "x"), ("2", "x"), ("3", "y"), ("4", "y"), ("x", "y")], "id string, key string")
    groups = CH._contention_groups(pairs)
    assert dict(groups.dtypes) == {"node": "bigint", "group": "bigint"}
    got = {r["id"]: r["group"] for r in pairs.withColumn("node", CH._node("i", "id")).join(groups, "node").collect()}
    assert got["1"] == got["2"] != got["3"] == got["4"] == got["x"]
