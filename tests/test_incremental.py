"""Invariant: incremental marts equal the full rebuild after every batch,
for random change logs (orders before customers, moves, deletes, NULLs)."""

import json
import random

import pytest
from pyspark.sql import functions as F

from riverbed.operators import changes as CH
from riverbed.operators import incremental as IN
from riverbed.operators import marts as M
from riverbed.sources.feeds import FEED_SCHEMA


def random_log(seed, n=28):
    rng = random.Random(seed)
    rows, cust, orders = [], {}, {}
    for off in range(n):
        r = rng.random()
        if r < 0.25:
            cid = rng.randint(1, 4)
            after = {"id": cid, "full_name": "n", "country": rng.choice(["vn", "usa", "", None, "japan"]),
                     "created_at": 0, "updated_at": 0}
            rows.append(("shop.public.customers", cid % 2, off, json.dumps({"id": cid}),
                         json.dumps({"op": "u" if cid in cust else "c", "before": cust.get(cid), "after": after})))
            cust[cid] = after
        elif r < 0.32 and cust:
            cid = rng.choice(sorted(cust))
            rows.append(("shop.public.customers", cid % 2, off, json.dumps({"id": cid}),
                         json.dumps({"op": "d", "before": cust.pop(cid), "after": None})))
        elif r < 0.85:
            oid = rng.randint(1, 7)
            after = {"id": oid, "customer_id": rng.choice([1, 2, 3, 4, 5, None]), "quantity": rng.randint(-1, 4),
                     "unit_price": str(rng.randint(1, 900) / 100), "status": rng.choice(["new", "CANCELLED", "paid"]),
                     "order_date": 1704067200000 + rng.randint(0, 3) * 86400000, "updated_at": 0}
            rows.append(("shop.public.orders", oid % 2, off, json.dumps({"id": oid}),
                         json.dumps({"op": "u" if oid in orders else "c", "before": orders.get(oid), "after": after})))
            orders[oid] = after
        elif orders:
            oid = rng.choice(sorted(orders))
            rows.append(("shop.public.orders", oid % 2, off, json.dumps({"id": oid}),
                         json.dumps({"op": "d", "before": orders.pop(oid), "after": None})))
    return rows


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed,cuts", [(1, [9, 18]), (7, [3, 6, 14, 20]), (23, [14])])
def test_incremental_equals_full(spark, seed, cuts):
    rows = random_log(seed)
    feed = spark.createDataFrame(rows, FEED_SCHEMA)
    so, sc = CH.RELATIONAL["orders"], CH.RELATIONAL["customers"]
    st_o = st_c = rev = cs = None
    bounds = [0] + cuts + [10**9]
    for lo, hi in zip(bounds, bounds[1:]):
        b = feed.where((F.col("offset") >= lo) & (F.col("offset") < hi))
        ch_o = CH.keyed_changes(CH.parse_relational(b, so), so).checkpoint()
        ch_c = CH.keyed_changes(CH.parse_relational(b, sc), sc).checkpoint()
        new_o, new_c = CH.fold(ch_o, st_o).checkpoint(), CH.fold(ch_c, st_c).checkpoint()
        cur_o, cur_c = CH.current(new_o, so), CH.current(new_c, sc)
        if rev is None:
            rev, cs = M.daily_revenue(cur_o, cur_c), M.customer_summary(cur_c, cur_o)
        else:
            old_o, old_c = CH.current(st_o, so), CH.current(st_c, sc)
            chg_o = ch_o.selectExpr("cast(pk as bigint) as id")
            chg_c = ch_c.selectExpr("cast(pk as bigint) as id")
            rev = IN.revenue_refresh(rev, old_o, old_c, cur_o, cur_c, chg_o, chg_c)
            cs = IN.customer_summary_refresh(cs, old_o, cur_o, cur_c, chg_o, chg_c)
        rev, cs = rev.checkpoint(), cs.checkpoint()
        st_o, st_c = new_o, new_c
        assert rows_of(rev) == rows_of(M.daily_revenue(cur_o, cur_c))
        assert rows_of(cs) == rows_of(M.customer_summary(cur_c, cur_o))
