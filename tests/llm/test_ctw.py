import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riverbed.llm import ctw as C
from riverbed.llm.catalog import op7_lm_score

SPACE = " \t\n\r\x0b\x0c"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    out, word = [], ""
    for ch in (text or "").translate(UP) + " ":
        if ch in SPACE:
            if word:
                out.append(word)
            word = ""
        else:
            word += ch
    return out


def held(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2


def base_brute(rows):
    n = Counter()
    for d, t in rows:
        if not held(d):
            n.update([*words_of(t), None])
    total, distinct = sum(n.values()), len(n)
    out = []
    for d, t in rows:
        tokens = [*words_of(t), None]
        out.append((d, held(d), len(tokens), sum(n[w] > 0 for w in tokens), total,
                    sum(math.log10((n[w] + 1) / (total + distinct + 1)) for w in tokens)))
    return out


class Tree:
    """Context-tree weighting by the book: sequential KT counts at every node,
    weighted probabilities by recursion, predictions by the ratio of two
    trees; nodes without counts do not exist."""

    def __init__(self, bodies, depth):
        self.depth, self.counts, self.kids = depth, {}, {}
        for body in bodies:
            data = b"\n" * depth + body
            for i in range(depth, len(data)):
                for node, bit in self.decisions(data[i]):
                    for d in range(depth + 1):
                        key = (data[i - d:i], node)
                        c = self.counts.setdefault(key, [0, 0])
                        c[bit] += 1
                        if d:
                            self.kids.setdefault((data[i - d + 1:i], node), set()).add(key)
        self.memo = {}

    @staticmethod
    def decisions(byte):
        node = 1
        for k in range(7, -1, -1):
            bit = byte >> k & 1
            yield node, bit
            node = 2 * node + bit

    @staticmethod
    def kt(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, key):
        if key not in self.memo:
            own = self.kt(*self.counts[key])
            if len(key[0]) < self.depth:
                below = sum(map(self.weighted, self.kids.get(key, ())))
                own = math.log(.5) + max(own, below) + math.log1p(math.exp(-abs(own - below)))
            self.memo[key] = own
        return self.memo[key]

    def p(self, context, node, bit, d=0):
        key = (context[len(context) - d:], node)
        if key not in self.counts:
            return None
        c = self.counts[key]
        own = (c[bit] + .5) / (sum(c) + 1)
        if d == self.depth:
            return own
        below = self.p(context, node, bit, d + 1)
        if below is None:
            return own
        kt, kids = self.kt(*c), sum(map(self.weighted, self.kids[key]))
        w = 1 / (1 + math.exp(min(kids - kt, 700)))
        return w * own + (1 - w) * below

    def log10(self, body):
        data = b"\n" * self.depth + body
        total = 0.0
        for i in range(self.depth, len(data)):
            for node, bit in self.decisions(data[i]):
                p = self.p(data[i - self.depth:i], node, bit)
                total += math.log10(.5 if p is None else p)
        return total


def body_of(text):
    return " ".join(words_of(text)).encode() + b"\n"


@pytest.mark.parametrize("depth", [2, 3, 5])
def test_scores_equal_the_sequential_method(spark, depth):
    texts = ["abracadabra abra", "the cat sat on the mat", "The cat, the hat", "", None, "É é É", "zzz", "abra cadabra the end", "the mat sat"]
    rows = [(i, texts[i % len(texts)]) for i in range(60)] + [(None, "abra"), (3, "repeated id"), (3, "repeated id")]
    got = C.score(spark.createDataFrame(rows, "doc_id long, text string"), depth=depth, block_bytes=64).collect()
    tree = Tree([body_of(t) for d, t in rows if not held(d)], depth)
    want = sorted(((*b, tree.log10(body_of(t))) for b, (_, t) in zip(base_brute(rows), rows)), key=repr)
    got = sorted((tuple(r)[:7] for r in got), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-6)


def test_query_base_columns_and_held_out_quality(spark, sf, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: r for r in op7_lm_score(spark, sf).collect()}
    for d, h, n, known, total, base in base_brute(rows):
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (h, n, known, total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert math.isclose(r["bits_per_byte"], -r["score"] * math.log2(10) / len(body_of(dict(rows)[d])), rel_tol=1e-9)
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in out) / sum(len(body_of(dict(rows)[r["doc_id"]])) for r in out) * math.log2(10) > -3


def test_held_out_texts_beat_the_base_score(spark):
    sf = "/root/testdata/sf0.1"
    r = (op7_lm_score(spark, sf).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first())
    assert r["s"] > r["b"]


def test_probabilities_of_a_byte_sum_to_one():
    rng = np.random.default_rng(0)
    bodies = [bytes(rng.choice(list(b"abc \xc3\xa9"), 40).astype(np.uint8)) + b"\n" for _ in range(30)]
    depth = 3
    codes, n = np.unique(C.codes_of(bodies, depth)[0], return_counts=True)
    context = codes[7] >> np.uint64(8)
    every = (context << np.uint64(8)) | np.arange(256, dtype=np.uint64)
    both = np.unique(np.concatenate((codes, every)))
    count = np.zeros(len(both))
    count[np.searchsorted(both, codes)] = n
    p, (known, zeros, ones, weighted) = C.lower_levels(both, count, depth)
    above, at = np.unique(known & 0xFFFF, return_inverse=True)
    top = C.Top(above >> 8, above & 255, *(np.bincount(at, x) for x in (zeros, ones, weighted)))
    at = np.searchsorted(both, every)
    assert math.isclose((10 ** top.log10(every, p[:, at])).sum(), 1, rel_tol=1e-9)


def test_lgamma_and_lookup():
    x = np.array([0.5, 1, 1.5, 2, 10, 1e4, 1e9])
    assert np.allclose(C._lgamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)
    rng = np.random.default_rng(1)
    codes = np.unique(rng.integers(0, 1 << 48, 5000).astype(np.uint64))
    table = C.Lookup(codes, np.arange(len(codes), dtype=float))
    assert (table.get(codes) == np.arange(len(codes))).all() and np.isnan(table.get(codes + np.uint64(1 << 50))).all()
    assert len(C.Lookup(codes[:0], np.zeros(0)).get(codes)) == len(codes)


def test_edges(spark, edge, empty, clashing):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    want = sorted((b[:5] for b in base_brute(rows)), key=repr)
    for df in (edge, clashing):
        assert sorted((tuple(r)[:5] for r in C.score(df, depth=2).collect()), key=repr) == want
    assert C.score(empty).count() == 0
    none = C.score(edge.where("doc_id < 3"), depth=2, held_out=F.lit(True)).collect()
    assert [(r["train_tokens"], r["base_score"]) for r in none] == [(0, 0.0)] * 3
    assert all(math.isclose(r["score"], 8 * math.log10(.5), rel_tol=1e-6) for r in none)
    with pytest.raises(ValueError):
        C.score(edge, depth=9)
