import random

import numpy as np
import xxhash

from pyspark.sql import functions as F

from riverbed.llm import simhash as S
from riverbed.llm.catalog import op2_simhash_dedup
from riverbed.llm.components import components

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fp(text, k=3):
    words = [w for w in _split((text or "").translate(UP)) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _split(text):
    word = ""
    for ch in text:
        if ch == " " or "\t" <= ch <= "\r":
            yield word
            word = ""
        else:
            word += ch
    yield word


def brute_classes(rows, bits=2):
    """component id of each row by trying all pairs."""
    fps = [brute_fp(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    out = []
    for i in range(len(rows)):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((rows[i][0], fps[i], min(ids) if ids else None))
    return sorted(out, key=repr)


def unsigned(v):
    return v & (1 << 64) - 1


def test_edge_rows_equal_brute_force(edge, clashing):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    want = brute_classes(rows)
    for df in (edge, clashing):
        got = sorted(((r[0], unsigned(r[1]), r[2]) for r in S.classes(df).collect()), key=repr)
        assert got == want


def test_long_texts_count_every_shingle(monkeypatch):
    """Around the chunk's length and its multiples, every shingle is hashed
    once and the fingerprint is that of all of them."""
    taken = []
    digest = xxhash.xxh64_intdigest
    monkeypatch.setattr(S.xxhash, "xxh64_intdigest", lambda g, seed: taken.append(g) or digest(g, seed))
    rng = random.Random(9)
    for n in (32768, 32769, 65536, 65538, 100_000, 131_076):
        words = [f"{rng.getrandbits(40):x}" for _ in range(n + 2)]
        grams = [" ".join(g).encode() for g in zip(words, words[1:], words[2:])]
        taken.clear()
        got = S.fingerprint(" ".join(words).encode())
        assert taken == grams and len(taken) == n
        bits = np.unpackbits(np.array([digest(g, 42) for g in grams], "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        assert got == sum(1 << b for b in np.flatnonzero(2 * bits.sum(axis=0, dtype=np.int64) > n).tolist())


def test_long_texts_equal_brute_force():
    """Random texts of more than two chunks; a shingle lost in each would
    change some of their fingerprints."""
    rng = random.Random(3)
    for n in [32769, 65538, 100_001] * 4:
        words = [f"w{rng.randrange(1 << 30):x}" for _ in range(n + 2)]
        hashes = np.array([xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in zip(words, words[1:], words[2:])], np.uint64)
        want = sum(1 << b for b in range(64) if 2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > n)
        assert S.fingerprint(" ".join(words).encode()) == want


def test_query_equals_brute_force(spark, sf, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted(((r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in op2_simhash_dedup(spark, sf).collect()), key=repr)
    assert got == brute_classes(rows)
    assert all(len(r["fingerprint"]) == 16 for r in op2_simhash_dedup(spark, sf).collect())


def test_links_over_planted_fingerprints(spark):
    """Chains and clouds around random fingerprints: the components over the
    index are those over all pairs, for each bit distance."""
    rng = random.Random(5)
    fps = set()
    for _ in range(30):
        f = rng.getrandbits(64)
        fps.add(f)
        for _ in range(25):
            f ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4])))
            fps.add(f)
    center = rng.getrandbits(64)
    fps |= {center ^ v for v in range(300)}                 # over 64 in one posting
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    x = np.array(fps, np.uint64)
    for bits in (1, 2, 3):
        near = np.bitwise_count(x[:, None] ^ x[None, :]) <= bits
        root = list(range(len(x)))
        for i in range(len(x)):                             # the least index reachable
            todo, seen = [i], {i}
            while todo:
                for j in np.flatnonzero(near[todo.pop()]):
                    if int(j) not in seen:
                        seen.add(int(j))
                        todo.append(int(j))
            root[i] = frozenset(seen)
        want = {frozenset(signed[k] for k in r) for r in root if len(r) > 1}
        got = {}
        for r in components(S.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bits)).collect():
            got.setdefault(r["root"], set()).add(r["node"])
        assert {frozenset(v) for v in got.values()} == want


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(400)] + [(1000, i) for i in range(1001, 1500)] + [(5, 5)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(401)}, **{i: 1000 for i in range(1000, 1500)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one(spark, edge, empty):
    kept = S.keep_one(edge)
    assert kept.columns == edge.columns
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    fps = [brute_fp(t) for _, t in rows]
    groups = {}
    for i, f in enumerate(fps):
        for g in groups.values():
            if any((f ^ fps[j]).bit_count() <= 2 for j in g):
                g.append(i)
                break
        else:
            groups[f] = [i]
    want = sorted(repr(min((rows[i][0] for i in g if rows[i][0] is not None), default=None)) for g in groups.values())
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == want
    assert S.keep_one(empty).count() == 0 and S.classes(empty).count() == 0
    bare = spark.createDataFrame([(None, "some words here"), (None, "some words here"), (None, "quite other text")], "doc_id long, text string")
    assert sorted(r["text"] for r in S.keep_one(bare).collect()) == ["quite other text", "some words here"]


def test_very_large_postings_are_posted_anew(spark, monkeypatch):
    """Fingerprints that agree in most bytes: postings over the bound give the same links."""
    rnd = random.Random(11)
    base = rnd.getrandbits(64)
    values = {base}
    for _ in range(400):
        v = base
        for b in rnd.sample(range(24), rnd.randint(1, 6)):
            v ^= 1 << b
        values.add(v)
    values |= {rnd.getrandbits(64) for _ in range(100)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    near = {tuple(sorted((a, b))) for i, a in enumerate(signed) for b in signed[:i] if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 2}

    def groups(edges):
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x
        for a, b in edges:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return {x: find(x) for x in root}

    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    for many in (1024, 8):
        monkeypatch.setattr(S, "MANY", many)
        assert groups([tuple(r) for r in S.links(fps, 2).collect()]) == groups(near)


def test_keep_one_with_clashing_names(spark, edge):
    mine = edge.withColumns({n: F.lit("mine") for n in ("__id", "__h", "__row", "fp", "h", "id", "root")})
    plain = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in S.keep_one(edge).collect())
    got = S.keep_one(mine)
    assert got.columns == mine.columns
    rows = got.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in rows) == plain and {r["__id"] for r in rows} == {"mine"}
