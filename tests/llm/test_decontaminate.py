import hashlib
import re

from pyspark.sql import functions as F

from riverbed.llm import decontaminate as D
from riverbed.llm.catalog import op1_decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text, items, n=10):
    """(n_words, hit word positions, items) by comparing word lists."""
    words = WORD.findall((text or "").translate(UP))
    hit, found = set(), set()
    for item, body in items:
        own = WORD.findall((body or "").translate(UP))
        windows = [own[i:i + n] for i in range(max(1, len(own) - n + 1))] if own else []
        for w in windows:
            for i in range(len(words) - len(w) + 1):
                if words[i:i + len(w)] == w:
                    hit.update(range(i, i + len(w)))
                    if item is not None:
                        found.add(str(item))
    return len(words), len(hit), sorted(found)


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def check(spark, df, items, **how):
    got = sorted(((r["doc_id"], r["text"], r["n_words"], r["n_hit"], r["items"]) for r in
                  D.scan(df, bench(spark, items), **how).collect()), key=repr)
    want = sorted(((r["doc_id"], r["text"], *brute(r["text"], items, how.get("n", 10))) for r in df.collect()), key=repr)
    assert got == want


ITEMS = [(1, "quick brown fox jumps over the lazy dog while nobody looks"), (2, "one two"), (3, None), (4, "..."), (None, "naïve"),
         (5, "word1x1 word2x2 word3x3 word4x4 word5x5 word6x6 word7x7 word8x8 word9x9 word10x10 word11x11 word12x12"),
         (6, "one two"), (6, "one two"), (7, "hello")]


def test_edge_rows_equal_brute_force(spark, edge):
    check(spark, edge, ITEMS)


def test_small_windows_and_blocks(spark, edge):
    check(spark, edge.where("length(text) < 1000 or text is null"), ITEMS, n=3, block_windows=4)


def test_query_equals_brute_force(spark, sf, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {}
    grams = {}
    for item, body in items:                       # an index by window, so that all documents can be tried
        own = WORD.findall(body.translate(UP))
        for i in range(max(1, len(own) - 9)):
            grams.setdefault(tuple(own[i:i + 10]), set()).add(str(item))
    for r in docs.collect():
        words = WORD.findall(r["text"].translate(UP))
        hit, found = set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(words) - n + 1):
                g = tuple(words[i:i + n])
                if g in grams:
                    hit.update(range(i, i + n))
                    found |= grams[g]
        want[r["doc_id"]] = (len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    got = {r[0]: tuple(r)[1:] for r in op1_decontaminate(spark, sf).collect()}
    assert got == want
    assert any(v[-1] for v in want.values())


def test_spans_and_removal(spark):
    text = "Ünder: The QUICK brown fox jumps over the lazy dog while nobody looks, said É."
    df = spark.createDataFrame([(1, text, 5), (2, "clean", 6), (3, None, 7)], "doc_id long, text string, n_words int")
    found = {r["doc_id"]: r for r in D.scan(df, bench(spark, ITEMS[:1])).collect()}
    assert [text[s["start"]:s["end"]] for s in found[1]["hit_spans"]] == ["QUICK brown fox jumps over the lazy dog while nobody looks"]
    assert found[1]["n_words"] == 5 and found[1]["_n_words"] == 15            # a column of that name stays
    left = {r["doc_id"]: r["text"] for r in D.remove_spans(df, bench(spark, ITEMS[:1])).collect()}
    assert left == {1: "Ünder: The , said É.", 2: "clean", 3: None}
    kept = D.drop_documents(df, bench(spark, ITEMS[:1]))
    assert kept.columns == df.columns and sorted(r[0] for r in kept.collect()) == [2, 3]


def test_empty_tables_and_clashes(spark, empty, edge, clashing):
    assert D.scan(empty, bench(spark, ITEMS)).count() == 0
    assert D.scan(edge, bench(spark, [])).where("n_hit > 0").count() == 0
    got = D.scan(clashing, bench(spark, ITEMS))
    assert {"n_words", "_n_words", "items", "_items", "hit_spans", "_hit_spans"} <= set(got.columns)
    assert got.where(F.col("_n_words") > 0).count() > 0


def test_word_longer_than_a_hash_block(spark):
    big = "a" * (D._BLOCK + 100)
    texts = [f"{big} one two", f"one two {big}"]
    assert [x[0] for x in D.NgramSet([(b"one two", "1")]).scan([t.encode() for t in texts])] == [3, 3]
    assert [x[1] for x in D.NgramSet([(b"one two", "1")]).scan([t.encode() for t in texts])] == [[(1, 3)], [(0, 2)]]
