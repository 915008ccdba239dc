import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riverbed.llm import cells, topk
from riverbed.llm.catalog import op13_exact_topk

SCHEMA = "vec_id long, vector array<long>"


def dot(a, b):
    return max(-2 ** 63, min(2 ** 63 - 1, sum(x * y for x, y in zip(a, b))))


def brute(rows, asks, k):
    """All pairs, row by row; a null id sorts last."""
    rows = [r for r in rows if r[1] is not None and None not in r[1]]
    out = []
    for i, (q, v) in enumerate(rows):
        if q is None or not asks(q):
            continue
        scored = sorted((-dot(v, w), c is None, c or 0) for j, (c, w) in enumerate(rows) if j != i)
        out += [(q, n, None if null else c, -s) for n, (s, null, c) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def check(df, rows, k=4):
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k=k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, lambda q: q % 5 == 0, k)


def test_query(spark, sf):
    v = [(r["vec_id"], [math.floor(64 * float(x)) for x in r["embedding"]]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = op13_exact_topk(spark, sf).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(v, lambda q: q % 20 == 0, 20)


def test_against_brute_force(spark):
    """Ties, repeated ids and rows, null ids, nulls, empty, sparse and uneven vectors."""
    rnd = random.Random(3)
    rows = [(rnd.choice([None, *range(60)]), [rnd.choice([0, 0, 0, 1, -1, 2]) for _ in range(rnd.choice([0, 3, 8]))]) for _ in range(300)]
    rows += [(5, [1, 1, 1]), (5, [1, 1, 1]), (5, [1, 1, 1]), (10, None), (15, [1, None]), (None, None), (20, [])]
    check(spark.createDataFrame(rows, SCHEMA), rows)


def test_few_rows_and_empty(spark):
    rows = [(0, [1, 2]), (5, [2, 1]), (7, [0, 0])]
    check(spark.createDataFrame(rows, SCHEMA), rows, k=20)
    check(spark.createDataFrame([], SCHEMA), [])
    check(spark.createDataFrame([(0, [1])], SCHEMA), [(0, [1])])


def test_one_id_and_one_vector_hold_a_third(spark, monkeypatch):
    """Over many cells: rows are dealt by row, not by key."""
    monkeypatch.setattr(cells, "GROUP_COMPONENTS", 128)
    monkeypatch.setattr(cells, "GROUP_QUERIES", 16)
    rnd = random.Random(5)
    rows = [(10 if i % 3 == 0 else i, [1, 2, 3] if i % 3 == 0 else [rnd.randint(-3, 3) for _ in range(3)]) for i in range(240)]
    check(spark.createDataFrame(rows, SCHEMA), rows)


@pytest.mark.parametrize("size", [1, 100, 40_000, 3_000_000_000, 2 ** 62])
def test_every_width_of_numbers(spark, size):
    rnd = random.Random(size)
    rows = [(i, [rnd.randint(-size, size) for _ in range(6)]) for i in range(60)]
    check(spark.createDataFrame(rows, SCHEMA), rows)


def test_clashing_names(spark):
    rows = [(i, [i % 7, i % 3]) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    for n in ("id", "row", "asks", "score", "rank", "query_id", "cell", "kind"):
        df = df.withColumn(n, F.lit("mine"))
    check(df, rows)
    dotted = df.withColumnsRenamed({"vec_id": "v.id", "vector": "the.vector"})
    got = topk.top_k(dotted, F.col("`v.id`") % 5 == 0, k=4, id_col="v.id", vector="the.vector")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, lambda q: q % 5 == 0, 4)


def test_quantized(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(0, [0.5, -0.001, 1.0]), (1, None), (2, [nan, 1.0]), (3, [inf]), (4, [None, 1.0]), (5, []), (6, [1e30])],
                               "i int, x array<float>")
    got = dict(df.select("i", cells.quantized(F.col("x"), 64)).collect())
    assert got == {0: [32, -1, 64], 1: None, 2: None, 3: None, 4: None, 5: [], 6: [2 ** 63 - 1]}


def test_best():
    rnd = np.random.default_rng(1)
    s = rnd.integers(0, 5, (3, 200))
    b = cells.Best(3, 7)
    for a in range(0, 200, 32):
        q, i = np.nonzero(np.ones_like(s[:, a:a + 32]))
        b.offer(q, s[q, i + a], i + a)
    for q in range(3):
        assert b.i[b.q == q].tolist() == sorted(range(200), key=lambda i: (-s[q, i], i))[:7]
    assert b.full.all() and b.least.tolist() == [sorted(s[q])[-7] for q in range(3)]
