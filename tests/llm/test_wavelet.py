import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from riverbed.llm import wavelet as W
from riverbed.llm.catalog import op8_token_output

PATH = P.path("word_bpe_49k.json")


@pytest.mark.parametrize("n,bits", [(0, 16), (1, 16), (7, 3), (5000, 16), (70_000, 9), (9000, 20)])
def test_access_rank_select_and_files(n, bits):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % (1 << bits)).astype(np.int64)
    ends = np.unique(np.concatenate((rng.integers(0, n + 1, 5), [n])))
    data = W.to_bytes(W.WaveletMatrix.build(ids, bits), list(range(len(ends))), ends)
    m, docs, got_ends = W.from_bytes(data)
    assert docs == list(range(len(ends))) and got_ends.tolist() == ends.tolist()
    assert (m.decode() == ids).all()
    for at in rng.integers(0, max(n, 1), 40) if n else []:
        assert m.access(int(at)) == ids[at]
    for value in {*ids[:20].tolist(), 0, 1, (1 << bits) - 1}:
        where = np.flatnonzero(ids == value)
        for to in (0, n // 3, n, n + 5):
            assert m.rank(value, to) == int((where < to).sum())
        assert m.count(value, n // 4, n // 2) == int(((where >= n // 4) & (where < n // 2)).sum())
        for k in {0, len(where) // 2, len(where) - 1} & set(range(len(where))):
            assert m.select(value, k) == where[k]
        assert m.select(value, len(where)) == -1
    assert m.rank(1 << bits, n) == 0
    with pytest.raises(IndexError):
        m.access(n)


def brute(rows):
    tok, out, at = Tokenizer.from_file(PATH), [], 0
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_query_equals_brute_force(spark, sf, docs):
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert sorted(tuple(r) for r in op8_token_output(spark, sf).collect()) == brute(rows)


def test_edge_rows(spark, edge, empty, clashing):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))      # null first; equal ids in their order
    for df in (edge, clashing):
        files = W.write_shards(df, PATH, shard_tokens=500)
        assert files.count() > 1
        got = sorted((tuple(r) for r in W.read_shards(files).collect()), key=lambda r: r[1])
        assert got == brute(order)
    assert W.read_shards(W.write_shards(empty, PATH)).count() == 0


def test_occurrences(spark, docs):
    some = docs.where("doc_id < 60")
    files = W.write_shards(some, PATH, shard_tokens=2000)
    tok, want, at = Tokenizer.from_file(PATH), [], 0
    value = tok.encode("the", add_special_tokens=False).ids[0]
    for r in sorted(some.collect()):
        ids = tok.encode(r["text"], add_special_tokens=False).ids + [1]
        want += [(r["doc_id"], i, at + i) for i, x in enumerate(ids) if x == value]
        at += len(ids)
    assert want and sorted(tuple(r) for r in W.occurrences(files, value).collect()) == want


def test_ids_beyond_the_planes_end_the_job(spark, docs):
    with pytest.raises(Exception, match="more than 4 bits"):
        W.write_shards(docs.limit(3), PATH, bits=4).count()
