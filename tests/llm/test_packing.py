import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from riverbed.llm import packing as K
from riverbed.llm.catalog import op5_best_fit_packing

PATH = P.path("byte_bpe_50k.json")


def check(docs, got, most=1024):
    """Every piece is right, and sequences are gapless and not too long."""
    tok = Tokenizer.from_file(PATH)
    want = []
    for d, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        first = len(ids) if len(ids) <= most else (len(ids) % most or most)
        at, piece = 0, 0
        while at < len(ids):
            n = first if at == 0 else most
            want.append((d, piece, at, n, zlib.crc32(np.array(ids[at:at + n], "<u4").tobytes())))
            at, piece = at + n, piece + 1
    rows = [tuple(r) for r in got.collect()]
    assert sorted((r[:5] for r in rows), key=repr) == sorted(want, key=repr)
    bins = {}
    for r in rows:
        bins.setdefault(r[5], []).append((r[6], r[3]))
    for places in bins.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        assert end <= most
    return len(bins), sum(r[3] for r in rows)


def test_query_equals_brute_force(spark, sf, docs):
    n, total = check([(r["doc_id"], r["text"]) for r in docs.collect()], op5_best_fit_packing(spark, sf))
    assert n <= 1.03 * total / 1024 + 1


def test_edge_rows_and_small_blocks(spark, edge, clashing, empty):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    for df in (edge, clashing):
        check(rows, K.pack(df, PATH))
    check(rows, K.pack(edge, PATH, most=7, block_rows=5), 7)
    assert K.pack(empty, PATH).count() == 0


def test_sequences_hold_the_ids(spark, docs):
    some = docs.where("doc_id < 40")
    packed = K.pack(some, PATH, with_ids=True)
    tok = Tokenizer.from_file(PATH)
    whole = {r["doc_id"]: tok.encode(r["text"], add_special_tokens=False).ids + [2] for r in some.collect()}
    places = {(r["sequence_id"], r["offset"]): r for r in packed.collect()}
    seqs = {r["sequence_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in K.sequences(packed).collect()}
    assert {s for s, _ in places} == set(seqs)
    for (s, at), r in places.items():
        assert seqs[s][at:at + r["length"]] == whole[r["doc_id"]][r["start"]:r["start"] + r["length"]]


def test_sum_of_squares_rule():
    """Each step leaves the least sum of squared counts of open gaps."""
    rng = np.random.default_rng(4)
    sizes, cap = rng.integers(1, 21, 200), 20
    bins, offsets = K.sum_of_squares(sizes, cap)
    gaps = {}
    cost = lambda g: sum(n * n for n in np.bincount([x for x in g.values() if x], minlength=cap + 1).tolist())
    for s, b, at in zip(sizes.tolist(), bins.tolist(), offsets.tolist()):
        assert at == cap - gaps.get(b, cap)
        options = [cost({**gaps, k: g - s}) for k, g in gaps.items() if g >= s] + [cost({**gaps, "new": cap - s})]
        gaps[b] = gaps.get(b, cap) - s
        assert gaps[b] >= 0 and cost(gaps) == min(options)


def test_waste_is_small():
    """One round, in the order that ``pack`` takes: within 1 % of full for
    sizes like those of documents, 4 % where half of all items fill over half
    a sequence."""
    rng = np.random.default_rng(1)
    for sizes, most in ((np.minimum(1023, rng.exponential(250, 20_000).astype(int) + 1), 1.01), (rng.integers(1, 1024, 20_000), 1.04)):
        sizes = sizes[np.lexsort((rng.random(len(sizes)), -(sizes * 64 // 1024)))]
        bins, _ = K.sum_of_squares(sizes, 1024)
        assert bins.max() + 1 <= most * sizes.sum() / 1024 + 1


def test_cut():
    assert K.cut(1, 4) == [(0, 1)] and K.cut(4, 4) == [(0, 4)] and K.cut(5, 4) == [(0, 1), (1, 4)] and K.cut(8, 4) == [(0, 4), (4, 4)]
