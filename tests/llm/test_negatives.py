import math
import random

import numpy as np
from pyspark.sql import functions as F

from riverbed.llm import cells, negatives
from riverbed.llm.catalog import op12_hard_negatives

SCHEMA = "vec_id long, label long, vector array<long>"


def dot(a, b):
    return max(-2 ** 63, min(2 ** 63 - 1, sum(x * y for x, y in zip(a, b))))


def brute(rows, asks, positives=5, negatives=3, low=(50, 100), high=(95, 100)):
    rows = [r for r in rows if r[1] is not None and r[2] is not None and None not in r[2]]
    out = []
    for i, (a, label, v) in enumerate(rows):
        if a is None or not asks(a):
            continue
        scored = sorted((-dot(v, w), c is None, c or 0, x == label) for j, (c, x, w) in enumerate(rows) if j != i)
        scored = [(-s, None if null else c, same) for s, null, c, same in scored]
        for p, pid, _ in [x for x in scored if x[2]][:positives]:
            fits = [x for x in scored if not x[2] and low[0] * p <= low[1] * x[0] and high[1] * x[0] <= high[0] * p]
            out += [(a, pid, r, c, p, s) for r, (s, c, _) in enumerate(fits[:negatives], 1)]
    return sorted(out, key=repr)


def check(df, rows, **how):
    got = negatives.mine(df, F.col("vec_id") % 5 == 0, **how)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows, lambda a: a % 5 == 0, **how)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    return want


def clustered(n, seed, dims=6):
    rnd = random.Random(seed)
    centers = [[rnd.randint(-40, 40) for _ in range(dims)] for _ in range(5)]
    return [(i, rnd.randrange(3), [x + rnd.randint(-15, 15) for x in rnd.choice(centers)]) for i in range(n)]


def test_query(spark, sf):
    rows = []
    for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect():
        label = (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]
        rows.append((r["vec_id"], label, [math.floor(256 * float(x)) for x in r["embedding"]]))
    got = op12_hard_negatives(spark, sf).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, lambda a: a % 50 == 0)


def test_query_moves_labels_and_skips_bad_rows(spark, tmp_root):
    """Null labels and ids, null, NaN and infinite components; a label at the end of its type."""
    rnd = random.Random(8)
    raw = [(i, [rnd.gauss(0, 0.1) for _ in range(8)], rnd.randrange(4)) for i in range(300)]
    raw += [(350, [float("nan")] * 8, 1), (400, [float("inf")] * 8, 1), (450, None, 1), (500, [0.1] * 8, None),
            (550, [None] * 8, 1), (None, [0.1] * 8, 1), (77, [0.2] * 8, 2 ** 31 - 1)]
    spark.createDataFrame(raw, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_root}/embeddings.parquet")
    rows = []
    for i, x, label in raw:
        ok = x is not None and all(v is not None and math.isfinite(v) for v in x)
        if label is not None and i is not None and i % 7 == 0:
            label = (label + 1) % 10
        rows.append((i, label, [math.floor(256 * float(np.float32(v))) for v in x] if ok else None))
    got = sorted((tuple(r) for r in op12_hard_negatives(spark, tmp_root).collect()), key=repr)
    assert got == brute(rows, lambda a: a % 50 == 0) and got


def test_against_brute_force(spark):
    rows = clustered(400, 1)
    rows += [(5, 1, rows[0][2])] * 3 + [(None, 1, rows[0][2]), (None, 2, rows[1][2]), (10, None, [1] * 6), (15, 1, None), (20, 1, [1, None]),
                                       (25, 1, []), (30, 2, [3]), (35, 0, [0] * 6)]
    assert check(spark.createDataFrame(rows, SCHEMA), rows)


def test_windows_of_small_and_negative_scores(spark):
    """A positive of score 0 takes negatives of score 0 only, one below 0 none."""
    rnd = random.Random(2)
    rows = [(i, i % 2, [rnd.randint(-1, 1) for _ in range(2)]) for i in range(80)]
    check(spark.createDataFrame(rows, SCHEMA), rows)
    check(spark.createDataFrame(rows, SCHEMA), rows, positives=2, negatives=7, low=(1, 3), high=(1, 1))


def test_over_many_cells_and_clusters(spark, monkeypatch):
    monkeypatch.setattr(cells, "GROUP_COMPONENTS", 256)
    monkeypatch.setattr(cells, "GROUP_QUERIES", 16)
    monkeypatch.setattr(negatives, "CLUSTER_ANCHORS", 8)
    monkeypatch.setattr(negatives, "CHUNK", 8)
    rows = clustered(300, 4)
    rows = [(r[0], r[1], rows[0][2]) if r[0] % 3 == 0 else r for r in rows]          # a third are copies
    assert check(spark.createDataFrame(rows, SCHEMA), rows)


def test_large_numbers_and_few_rows(spark):
    rnd = random.Random(6)
    for size in (2 ** 27, 2 ** 40):
        rows = [(i, rnd.randrange(2), [rnd.randint(-size, size) for _ in range(4)]) for i in range(40)]
        check(spark.createDataFrame(rows, SCHEMA), rows)
    check(spark.createDataFrame([], SCHEMA), [])
    check(spark.createDataFrame([(0, 1, [1])], SCHEMA), [(0, 1, [1])])


def test_clashing_names(spark):
    rows = clustered(60, 9)
    df = spark.createDataFrame(rows, SCHEMA)
    for n in ("id", "row", "asks", "score", "rank", "slot", "cluster", "angle", "cell", "kind"):
        df = df.withColumn(n, F.lit("mine"))
    check(df, rows)


def test_walks_stop_early():
    """Certified: a member of a tight cluster reads the head of the list only."""
    import pyarrow as pa
    rnd = np.random.default_rng(0)
    m = np.concatenate((rnd.integers(90, 110, (2000, 8)), rnd.integers(-110, -90, (6000, 8)))).astype(np.int64)
    t = pa.table({"id": np.arange(8000), "row": np.arange(8000), "label": ["x"] * 8000, "vector": pa.array(list(m))})
    index = negatives.Lists(t, np.ones((1, 8)) / np.sqrt(8), [0.1])
    best, seen = cells.Best(4, 5), 0

    def visit(active, places, s):
        nonlocal seen
        seen += s.size
        q, i = np.nonzero(s >= cells.kth(s, 5)[:, None])
        best.offer(active[q], s[q, i], places[i])

    negatives._walk(index, 0, m[:4], visit, lambda: np.where(best.full, best.least.astype(float), -np.inf))
    assert seen < 4 * 3000
    exact = m[:4] @ m.T
    assert all(best.i[best.q == q].tolist() == sorted(range(8000), key=lambda i: (-exact[q, i], i))[:5] for q in range(4))
