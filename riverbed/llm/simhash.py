"""SimHash near-duplicates over a byte-position inverted index with count
filtering.

A 64-bit fingerprint has 8 positional bytes.  Two fingerprints with at most
``k`` differing bits differ in at most ``k`` bytes, so they share at least
``8 - k`` of them: that is the guaranteed minimum of the count filter.

Postings of single positional bytes hold 1/256 of all fingerprints each, and
tallying those pair by pair is quadratic.  The index posts combinations of
positions instead.  For k <= 2 the positions form four pairs, of which at least
two stay untouched, so every union of two pairs is one posting key of four
bytes: six postings a fingerprint.  In a posting, the shared positional bytes
of each candidate pair are tallied, pairs that reach the minimum are kept, and
verified by their differing bits.

A posting of very many members would be quadratic again.  Its members are
posted anew under every choice of ``8 - k`` positions: members of such a
posting differ in ``k`` bytes only, so it has at most 256^k of them, whatever
the input, and they are joined by probing, without writing out pairs.

Exact copies and equal fingerprints are one entry of the index, so groups of
copies of any size cost one entry.  Components of linked fingerprints are
found by star contraction (``components``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import free_name, ship_package, utf8, written
from riverbed.llm.components import components

_CHUNK = 1 << 15
#: Larger postings are posted anew; up to here all pairs of one are tallied.
MANY = 1024


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """A-Z lowered, words split at white space, shingles of ``shingle`` words
    (the whole sequence if there are fewer); a bit is 1 if it is set in over
    half of the shingles' XXH64.  No words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    grams = (b" ".join(g) for g in zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else iter([b" ".join(words)])
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), 0
    while True:
        h = np.fromiter((digest(g, seed) for g in islice(grams, _CHUNK)), "<u8")
        if not len(h):
            break
        n += len(h)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = np.fromiter((fingerprint(t, shingle, seed) for t in utf8(b.column(b.num_columns - 1))), np.uint64, b.num_rows)
            arrays = [*b.columns[:-1], pa.array(got.view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=[f"c{i}" for i in range(len(arrays))])
    return run


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = 3, seed: int = 42, text: str = "text",
                 name: str = "fp") -> DataFrame:
    """``keep`` columns of ``docs`` and the fingerprint as a signed long; a
    null text has no words."""
    ship_package(docs.sparkSession)
    base = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias("t"))
    ddl = ", ".join([f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(base.schema.fields[:-1])] + [f"c{len(keep)} long"])
    out = base.mapInArrow(_fingerprints(shingle, seed), ddl)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col(f"c{len(keep)}").alias(name))


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """How many positional bytes two fingerprints share, given their
    exclusive or: its zero bytes."""
    return (x[..., None].view(np.uint8) == 0).sum(axis=-1)


def _stars(values: np.ndarray, bits: int) -> Iterator[tuple[int, int]]:
    """(member, root) edges that connect the values within ``bits`` of each
    other, given the members of a posting."""
    n = len(values)
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(i: int, j: int) -> None:
        i, j = find(i), find(j)
        if i != j:
            root[max(i, j)] = min(i, j)

    if n <= MANY:
        x = values.astype(np.int64).view(np.uint64)
        for a in range(0, n, 256):
            apart = x[a:a + 256, None] ^ x[None, :]
            i, j = np.nonzero(shared_bytes(apart) >= 8 - bits)           # the tally reaches the minimum
            near = (np.bitwise_count(apart[i, j]) <= bits) & (i + a < j)       # verified, each pair once
            for i, j in zip((i[near] + a).tolist(), j[near].tolist()):
                join(i, j)
    else:
        # probe every value with up to half the bits flipped: two values are
        # within ``bits`` exactly if such probes meet
        free = np.bitwise_or.reduce(values ^ values[0])
        one = np.uint64(1) << np.arange(64, dtype=np.uint64)
        at = [f for b, f in enumerate(one.view(np.int64)) if (int(free) >> b) & 1]
        flips = [np.int64(0)]
        for k in range(1, bits // 2 + 1):
            flips += [np.bitwise_xor.reduce(np.array(c, np.int64)) for c in combinations(at, k)]
        probes = {}
        for f in flips:
            for i, v in enumerate((values ^ f).tolist()):
                j = probes.setdefault(v, i)
                if j != i:
                    join(i, j)
        if bits % 2:                                     # one flip more on one side
            for f in at:
                for i, v in enumerate((values ^ f).tolist()):
                    for g in flips:
                        j = probes.get(v ^ int(g))
                        if j is not None:
                            join(i, j)
    for i in range(n):
        j = find(i)
        if j != i:
            yield int(values[i]), int(values[j])


def _link(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, r = [], []
            col = b.column(0)
            ends, flat = col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False)
            for i in range(b.num_rows):
                for x, y in _stars(np.sort(flat[ends[i]:ends[i + 1]]), bits):
                    a.append(x)
                    r.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(r, pa.int64())], names=["a", "b"])
    return run


def _postings(fps: DataFrame, choices: list[tuple[int, ...]]) -> DataFrame:
    """(fp, positions, shared): each fingerprint under every choice of
    positions, with the bytes it has there."""
    masks = []
    for positions in choices:
        m = sum(0xFF << (8 * p) for p in positions)
        masks.append(m - (1 << 64) if m >> 63 else m)
    keys = F.array(*[F.struct(F.lit(i).cast("byte").alias("positions"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("shared"))
                     for i, m in enumerate(masks)])
    return fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.positions", "k.shared")


def _linked(posted: DataFrame, bits: int) -> DataFrame:
    members = (posted.groupBy("positions", "shared").agg(F.collect_list("fp").alias("members"))
               .where(F.size("members") > 1).select("members"))
    return members.mapInArrow(_link(bits), "a long, b long")


def links(fps: DataFrame, bits: int = 2, name: str = "fp") -> DataFrame:
    """(a, b) edges between distinct fingerprints such that two are connected
    within a posting exactly if a chain of steps of at most ``bits`` differing
    bits joins them there; every pair within ``bits`` shares a posting."""
    if not 0 < bits < 4:
        raise ValueError("bits: 1 to 3")
    ship_package(fps.sparkSession)
    fps = fps.select(F.col(f"`{name}`").alias("fp"))
    exact = list(combinations(range(8), 8 - bits))
    if bits == 3:
        return _linked(_postings(fps, exact), bits).distinct()
    pairs = [(2 * i, 2 * i + 1) for i in range(4)]
    posted = _postings(fps, [a + b for a, b in combinations(pairs, 2)])
    many = written(posted.groupBy("positions", "shared").count().where(F.col("count") > MANY).select("positions", "shared"), "simhash")
    if not many.take(1):
        return _linked(posted, bits).distinct()
    again = written(posted.join(many, ["positions", "shared"], "left_semi").select("fp").distinct(), "simhash")
    few = posted.join(many, ["positions", "shared"], "left_anti").select(*posted.columns)
    return _linked(few, bits).union(_linked(_postings(again, exact), bits)).distinct()


def _placed(docs: DataFrame, shingle: int, bits: int, seed: int, id_col: str, text: str) -> DataFrame:
    """Per row of ``docs``: id, hash of the text, fp, and the smallest
    fingerprint (root) and smallest id (component_id) of its component."""
    body = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"),
                       F.xxhash64(F.col(f"`{text}`")).alias("h"))
    rows = written(fingerprints(body, ["id", "h"], shingle, seed), "simhash")
    nodes = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash")
    roots = components(links(nodes, bits)).withColumnRenamed("node", "fp")
    placed = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    of_root = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(placed.select("fp", "root").join(of_root, "root"), "fp")


def classes(docs: DataFrame, shingle: int = 3, bits: int = 2, seed: int = 42, id_col: str = "doc_id",
            text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``fp`` (signed long) and
    ``component_id``, the smallest id reachable over links, itself included.

    Null and empty texts have fingerprint 0 and link like any other; a null
    id takes no part in the minimum (which is null if all ids of a component
    are); repeated rows share a component; an empty table gives an empty
    result; other columns are ignored.
    """
    return _placed(docs, shingle, bits, seed, id_col, text).select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, bits: int = 2, seed: int = 42, id_col: str = "doc_id",
             text: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that with the
    smallest id, null last; among equal ids, that with the smallest hash of
    the text, then of the whole row."""
    rows = _placed(docs, shingle, bits, seed, id_col, text)
    first = F.min(F.struct(F.col("id").isNull().alias("bare"), "id", "h")).alias("f")
    stay = written(rows.groupBy("root").agg(first).select(F.col("f.id").alias("id"), F.col("f.h").alias("h")), "simhash")
    twice = written(rows.groupBy("id", "h").count().where("count > 1").select("id", "h"), "simhash")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    ident, h = F.col(f"`{id_col}`"), F.xxhash64(F.col(f"`{text}`"))
    kid, kh, whole_row = (free_name(docs, n) for n in ("__id", "__h", "__row"))

    def of(keys: DataFrame, how: str, rows: DataFrame) -> DataFrame:
        keys = keys.select(F.col("id").alias(kid), F.col("h").alias(kh))
        return rows.join(keys, (h == F.col(kh)) & ident.eqNullSafe(F.col(kid)), how)

    kept = of(stay, "left_semi", docs)
    if not twice.take(1):
        return kept.select(*cols)
    whole = F.struct(*cols)
    one = (of(twice, "left_semi", kept).groupBy(ident.alias(kid), h.alias(kh))
           .agg(F.min_by(whole, F.xxhash64(*cols)).alias(whole_row)).select(f"{whole_row}.*"))
    return of(twice, "left_anti", kept).select(*cols).union(one)
