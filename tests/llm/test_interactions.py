import re
from itertools import permutations
from math import factorial

import pytest
from pyspark.sql import functions as F

from riverbed.llm import interactions as I
from riverbed.llm.catalog import op11_filter_interactions


def fails(text, n_words):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {"A": len(words) < n_words, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text))}


def brute(rows, labels, n_words=50):
    """Applies every order document by document. rows: (id, text, part)."""
    seen, docs, out = {}, [], {}
    for i, t, _ in rows:
        if i is not None:
            seen[t or ""] = min(i, seen.get(t or "", i))
    for i, t, part in rows:
        f = fails(t or "", n_words)
        f["E"] = i is not None and i > seen[t or ""]
        marks = [x for x in labels if x[0] == i and i is not None]
        docs.append((part or "", {k for k in f if f[k]}, any(x[1] == 1 for x in marks), any(x[2] == 1 for x in marks)))
    for part in {d[0] for d in docs}:
        mine, shapley = [d for d in docs if d[0] == part], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            gone = set()
            for step, x in enumerate(order, 1):
                here = [n for n, d in enumerate(mine) if x in d[1] and n not in gone]
                before = sum(1 for n, d in enumerate(mine) if x in d[1] and n in gone)
                gone |= set(here)
                shapley[x] += len(here)
                out[part, "".join(order), step] = [
                    len(mine) - len(gone), len(here), before, sum(d[1] == {x} for d in mine),
                    sum(mine[n][2] for n in here), sum(mine[n][3] for n in here)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def result(df):
    rows = df.collect()
    got = {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in rows}
    assert len(got) == len(rows)
    return got


def test_query(spark, sf, docs):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    df = op11_filter_interactions(spark, sf)
    assert df.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert result(df) == brute(rows, labels)


def test_edge_rows(spark, edge, edge_rows, clashing, empty):
    """Null and repeated ids and labels, null and empty texts and parts, ties."""
    rows = [(r[0], r[1], r[3]) for r in edge_rows]
    marks = [(6, 1, None), (6, 0, 1), (None, 1, 1), (2, None, None), (7, 1, 1), (999, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    for df in (edge, clashing):
        assert result(I.audit(I.fail_counts(df, labels))) == brute(rows, marks)
    assert I.audit(I.fail_counts(empty, labels)).count() == 0
    none = labels.limit(0)
    assert result(I.audit(I.fail_counts(edge, none))) == brute(rows, [])


def test_one_text_holds_a_third(spark):
    rows = [(i, "the same words here" if i % 3 == 0 else f"words {i % 40}", f"p{i % 4}") for i in range(3000)]
    rows += [(0, "the same words here", "p9"), (0, "the same words here", "p9")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(0, 3000, 5)], "doc_id long, quality int, toxic int")
    got = result(I.audit(I.fail_counts(df, labels)))
    assert got == brute(rows, [tuple(r) for r in labels.collect()])


def test_path_counts():
    for n in range(1, 7):
        edges = I.path_counts(n)
        assert len(edges) == n << (n - 1)
        for s, f, a, b in edges:
            k = bin(s).count("1")
            assert not s >> f & 1 and (a, b) == (factorial(k), factorial(n - k - 1))
    steps = I.order_steps("ABCDE")
    assert len(steps) == 600 and len({s[:2] for s in steps}) == 600
    # an edge lies on as many orders as the path counts say
    on = {(s, f): a * b for s, f, a, b in I.path_counts(5)}
    for e in on:
        assert sum(x[2:] == e for x in steps) == on[e]


def test_shapley_sums_to_what_all_filters_remove(spark):
    counts = spark.createDataFrame([("p", m, m + 1, 0, 0) for m in range(8)], "part string, mask int, n long, good long, toxic long")
    rows = I.audit(counts, "XYZ").collect()
    per = {r["filter_order"][r["step"] - 1]: r["shapley"] for r in rows}
    assert len(rows) == 18 and sum(per.values()) == 6 * sum(m + 1 for m in range(1, 8))
    with pytest.raises(ValueError):
        I.audit(counts, "ABCDEFGH")


def test_other_conditions(spark):
    df = spark.createDataFrame([(1, "aa", "s"), (2, "b", "s"), (3, "aa", "t")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = I.fail_counts(df, labels, lambda t: {"long": F.char_length(t) > 1}).collect()
    assert sorted((r["part"], r["mask"], r["n"]) for r in got) == [("s", 0, 1), ("s", 1, 1), ("t", 3, 1)]
