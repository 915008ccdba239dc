"""The relational pipeline's marts from partial states equal the rebuild after
every batch, and a batch touches its own buckets only."""

import json
import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from riverbed.operators import changes as CH
from riverbed.operators import marts as M
from riverbed.operators import partials as PT
from riverbed.sources.feeds import FEED_SCHEMA
from riverbed.streaming import streams as ST

from test_changes import order
from test_incremental import random_log, rows_of


def rebuilt(pipe):
    orders, customers = (CH.current(pipe.state(t), CH.RELATIONAL[t]) for t in ("orders", "customers"))
    return rows_of(M.daily_revenue(orders, customers)), rows_of(M.customer_summary(customers, orders))


@pytest.mark.parametrize("seed,cuts", [(7, [4, 20])])
def test_marts_equal_the_rebuild(spark, tmp_root, seed, cuts):
    feed = spark.createDataFrame(random_log(seed, 36), FEED_SCHEMA)
    pipe, bounds = ST.RelationalPipeline(spark, tmp_root), [0, *cuts, 10 ** 9]
    for n, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        pipe.process(feed.where(F.col("offset").between(lo, hi - 1)), n)
        assert (rows_of(pipe.read_mart("daily_revenue")), rows_of(pipe.read_mart("customer_summary"))) == rebuilt(pipe)


def omsg(off, op, o, cid=None):
    body = {"op": op, "before": o if op == "d" else None, "after": None if op == "d" else o, "ts_ms": None}
    return ("shop.public.orders", 0, off, json.dumps({"id": o["id"]}), json.dumps(body))


def cmsg(off, cid, country):
    after = {"id": cid, "full_name": "n", "country": country, "created_at": 0, "updated_at": 0}
    return ("shop.public.customers", 0, off, json.dumps({"id": cid}), json.dumps({"op": "u", "before": None, "after": after, "ts_ms": None}))


def test_newest_order_goes_and_customer_moves(spark, tmp_root):
    """MAX is taken back within a day and over days; ties; a customer's last order; a move with no order changed."""
    day, hour = 86_400_000, 3_600_000
    t0 = 1704067200000
    times = [t0, t0 + hour, t0 + hour, t0 + 2 * day, t0 + 2 * day + hour]
    o = [order(n, customer_id=1, order_date=t) for n, t in enumerate(times)] + [order(9, customer_id=2, order_date=t0)]
    first = [cmsg(0, 1, "vietnam"), cmsg(1, 2, "usa"), *[omsg(n, "c", x) for n, x in enumerate(o)]]
    steps = [[omsg(20, "d", o[4]), omsg(21, "d", o[3])], [omsg(22, "d", o[2]), omsg(24, "d", o[5]), cmsg(30, 1, "japan")],
             [omsg(23, "d", o[1]), omsg(25, "u", {**o[0], "customer_id": 2})]]
    pipe = ST.RelationalPipeline(spark, tmp_root)
    want_last = [times[2], times[1], None]
    pipe.process(spark.createDataFrame(first, FEED_SCHEMA), 0)
    for n, (rows, last) in enumerate(zip(steps, want_last), 1):
        pipe.process(spark.createDataFrame(rows, FEED_SCHEMA), n)
        assert (rows_of(pipe.read_mart("daily_revenue")), rows_of(pipe.read_mart("customer_summary"))) == rebuilt(pipe)
        got = pipe.read_mart("customer_summary").where("customer_id = 1").select(F.unix_millis("last_order_date")).first()[0]
        assert got == last
    moments = pipe.state("order_moments").where(~F.col("_deleted"))
    assert [(r["owner"], r["orders"]) for r in moments.collect()] == [(2, 1)]


def test_a_batch_touches_its_own_buckets(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(ST, "KeyedStore", partial(ST.KeyedStore, least_buckets=64))
    rows = [cmsg(n, n, "usa") for n in range(40)] + [omsg(n, "c", order(n, customer_id=n % 40, order_date=1704067200000 + n * 1000)) for n in range(200)]
    pipe = ST.RelationalPipeline(spark, tmp_root)
    pipe.process(spark.createDataFrame(rows, FEED_SCHEMA), 0)
    before = pipe.commits.latest()
    assert all(len(before["tables"][t]["paths"]) > 25 for t in ("orders", "customers", "order_days", "order_moments"))
    for s in pipe.stores.values():
        s.read_buckets, s.written_buckets = [], []
    pipe.process(spark.createDataFrame([omsg(500, "u", order(7, customer_id=8, quantity=9)), cmsg(600, 3, "japan")], FEED_SCHEMA), 1)
    after = pipe.commits.latest()
    for t, most in (("orders", 1), ("customers", 1), ("order_days", 2), ("order_moments", 2)):
        changed = [b for b, p in after["tables"][t]["paths"].items() if before["tables"][t]["paths"].get(b) != p]
        assert 0 < len(changed) <= most
        assert max(pipe.stores[t].read_buckets, default=0) <= 3 and max(pipe.stores[t].written_buckets) <= most
    # as many files as buckets
    fs = pipe.commits.fs
    for t in ("orders", "order_moments"):
        for p in after["tables"][t]["paths"].values():
            assert sum(n.endswith(".parquet") for n in fs.list_names(f"{tmp_root}/{p}")) == 1
    assert (rows_of(pipe.read_mart("daily_revenue")), rows_of(pipe.read_mart("customer_summary"))) == rebuilt(pipe)


def test_keys_are_one_however_spelled(spark, tmp_root):
    rows = [omsg(0, "c", order("007")), omsg(1, "u", order(7, quantity=5)), omsg(2, "c", order(8)), omsg(3, "d", order("08"))]
    pipe = ST.RelationalPipeline(spark, tmp_root)
    pipe.process(spark.createDataFrame(rows, FEED_SCHEMA), 0)
    assert [(r["id"], r["quantity"]) for r in CH.current(pipe.state("orders"), CH.RELATIONAL["orders"]).collect()] == [(7, 5)]


def moved_changes(spark, seed):
    """Changes of few keys in several partitions, some without a clock or brought twice."""
    rng = random.Random(seed)
    rows = []
    for off in range(120):
        part, gone = rng.randrange(3), rng.random() < .2
        row = (str(rng.randrange(8)), (rng.choice([None, rng.randrange(50)]), "t", part, off), None, gone, "d" if gone else "u", None if gone else off)
        rows += [row] * rng.choice([1, 1, 2])
    return spark.createDataFrame(rows, PT._HEAD + "n int")


def states(df):
    return sorted((r["pk"], r["_pos"], [tuple(p) for p in r["_past"] or []], r["_deleted"], r["_op"], r["n"]) for r in df.collect())


def test_rows_are_laid_out_once_and_fold_to_the_same_state(spark, tmp_root):
    first, second = (moved_changes(spark, seed).checkpoint() for seed in (1, 2))
    second = second.withColumn("_pos", F.col("_pos").withField("offset", F.col("_pos.offset") + 60))
    old = CH.fold(first).checkpoint()
    want = states(CH.fold(second, old))
    at = lambda rows: rows.withColumn("_bucket", F.lit(0))
    for crowded, exchanges in ((False, 1), (True, 2)):
        laid = CH.fold(at(second), at(old), ("_bucket", "pk"), lambda rows: rows.repartition(3, "_bucket"), crowded, ["n"])
        assert states(laid) == want
        assert laid._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == exchanges
    held = {r["pk"]: r["n"] for r in old.where("not _deleted").collect()}
    made = {r["pk"]: (r["_fresh"], r["_was"] and r["_was"]["n"]) for r in laid.collect()}
    assert {k: v for k, (_, v) in made.items()} == {k: held.get(k) for k in made} and any(f for f, _ in made.values())
    store = ST.KeyedStore(spark, tmp_root, "t", first.schema, bucket_rows=5)        # more changes in a bucket than rows belong in one
    one = store.merge(first, None, "b0")
    two = store.merge(second, one, "b1", was=["n"])
    assert states(store.state(two)) == want
    assert store.state(two).columns == first.columns and ST.KeyedStore(spark, tmp_root, "t").state(two).columns == first.columns


def test_texts_stay_with_rejected_rows_only(spark, tmp_root):
    rows = [omsg(0, "c", order(1)), omsg(1, "c", order(2, quantity=3_000_000_000))]
    slim = CH.slim(CH.parse_relational(spark.createDataFrame(rows, FEED_SCHEMA), CH.RELATIONAL["orders"]), ["before", "after"])
    got = {r["offset"]: (r["value_text"] is None, r["after"] is None) for r in slim.collect()}
    assert got == {0: (True, False), 1: (False, True)}
