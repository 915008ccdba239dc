from collections import Counter

import numpy as np
import pytest

from riverbed.llm import quality as Q
from riverbed.llm.catalog import op3_quality_rules
from riverbed.llm.common import free_name

SPACE = " \t\n\r\x0b\x0c"


def words_of(text):
    out, word = [], ""
    for ch in text + " ":
        if ch in SPACE:
            if word:
                out.append(word)
            word = ""
        else:
            word += ch
    return out


def brute(text):
    text = text or ""
    words = words_of(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(zip(words, words[1:], words[2:]))
    mark = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i:i + 3])] > 1:
            mark |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(mark))


def failed(counts):
    return counts[0] < 50 or 100 * counts[4] > 50 * counts[0]


def test_query_counts_equal_brute_force(spark, sf, docs):
    want = {r["doc_id"]: brute(r["text"]) for r in docs.collect()}
    for r in op3_quality_rules(spark, sf).collect():
        assert tuple(r[c] for c in Q.COUNTS) == want[r["doc_id"]]
        assert r["base_failed"] == failed(want[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


def test_edge_rows(spark, edge, empty, clashing, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for df in (edge, clashing):
        got = sorted((tuple(r)[:6] for r in Q.judge(df, labels).collect()), key=repr)
        assert got == sorted(((r["doc_id"], *brute(r["text"])) for r in df.collect()), key=repr)
    kept = Q.keep_good(clashing, labels)
    assert kept.columns == clashing.columns and kept.where("kept = 'mine'").count() == kept.count()
    assert Q.judge(empty, labels).count() == 0 and Q.keep_good(empty, labels).count() == 0


def test_without_labels_the_fixed_rules_decide(spark, docs, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for none in (labels.limit(0), labels.selectExpr("doc_id", "cast(null as int) quality", "toxic")):
        got = Q.judge(docs, none).collect()
        assert all(r["kept"] == (not r["base_failed"]) for r in got)


def test_verdict_on_held_out_labels(spark):
    """Labels of three quarters of the documents train and calibrate; on the
    rest nearly all good documents stay and nearly all bad ones go."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = Q.judge(docs, labels.where("doc_id % 4 <> 0")).where("not base_failed").join(labels.where("doc_id % 4 = 0"), "doc_id")
    share = {r["quality"]: r["s"] for r in got.groupBy("quality").agg({"kept": "count", "doc_id": "count"}).selectExpr("quality", "1 as s").collect()}
    assert set(share) == {0, 1}
    kept = {r[0]: r[1] for r in got.selectExpr("quality", "cast(kept as double) k").groupBy("quality").avg("k").collect()}
    assert kept[1] > 0.995 and kept[0] < 0.02


def test_judge_and_keep_good_agree(spark, docs, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = {r["doc_id"] for r in Q.judge(docs, labels).where("kept").collect()}
    assert {r["doc_id"] for r in Q.keep_good(docs, labels).collect()} == kept


def test_trees_are_paths_over_splits():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 3))
    f = Q.Forest(x, x.min(0) - 3, x.max(0) + 3, np.ones(3), trees=20)

    def path(tree, row):
        feature, value, left, right, length = tree
        at = 0
        while feature[at] >= 0:
            at = left[at] if row[feature[at]] < value[at] else right[at]
        return length[at]

    want = [2 ** (-np.mean([path(t, row) for t in f.trees]) / f.norm) for row in x[:50]]
    assert np.allclose(f.scores(x[:50]), want)
    far = f.scores(np.full((1, 3), x.max() + 2))
    assert far[0] > np.quantile(f.scores(x), 0.99)


@pytest.mark.parametrize("good,bad", [(10, 0), (10, 10)])
def test_separation(good, bad):
    a, b = np.zeros((good, 2)), np.zeros((bad, 2))
    if bad:
        b[:, 1] = 1
    got = Q.separation(a, b)
    assert got[1] == 1 and (not bad or got[0] == 0)


def test_free_name(edge):
    assert free_name(edge, "text") == "_text" and free_name(edge, "other") == "other"
