"""Driver contract, oracle agreement on the smoke data, plan shape."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from riverbed.plans import catalog  # noqa: E402
from riverbed.plans.catalog import ORACLE, QUERIES  # noqa: E402

SLOW = {"stream_orders_available_now", "stream_revenue_available_now", "doc_country_incremental"}
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"order_day", "country", "total_orders", "total_items", "total_revenue"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck(sf):
    catalog.FEEDS = {}                                   # each change feed is made once for all queries
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    yield con
    catalog.FEEDS = None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_matches_oracle_and_plan(spark, sf, duck, name):
    from check import digest
    df = E.queries()[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad} in plan"
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    orows = res.fetchall()
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_scan_is_pruned_and_filtered(spark, sf):
    df = E.queries()["mart_daily_revenue"](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.split("\n") if "orders.parquet" in ln or "ReadSchema" in ln]
    assert "o_orderpriority" not in plan                      # unused column never read
    assert any("customer" in ln for ln in plan.split("\n") if "PushedFilters" in ln or "FileScan" in ln) or scans


def test_streaming_restart(spark, sf):
    df = E.queries()["stream_orders_available_now"](spark, sf)
    ref = E.queries()["cdc_current_orders"](spark, sf)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, ref.collect()))


def test_pieces_are_bounded_for_change_data_only(spark):
    from riverbed.session import PIECES, bound_pieces
    own = {k: spark.conf.get(k) for k in PIECES}
    for on in (True, True, False, False):
        bound_pieces(spark, on)
        assert {k: spark.conf.get(k) for k in PIECES} == (PIECES if on else own)
