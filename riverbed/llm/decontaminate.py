"""Benchmark decontamination: a broadcast set of normalised test n-grams is
looked up in every window of the training documents; hits are verified word
by word and give spans or whole documents to remove.

Normal form: A-Z lowered; words are runs of letters a-z, digits and all
characters beyond ASCII.  A window is ``n`` consecutive words of a benchmark
item; an item of fewer words (but not none) is one window of that length.

Windows are hashed with numpy over the bytes of many documents at once; a
hash found in the set is then compared as text, so a hash collision cannot
give a hit.  The windows' set is broadcast in blocks of at most
``block_windows`` (window, item) pairs: one block for any usual benchmark, and
otherwise one pass over the documents for each block, so the broadcast never
grows with the benchmark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import free_name, ship_package, slices, utf8, written

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")       # on lowered UTF-8

_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[0x41:0x5B] += 0x20
_R, _Q, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xBF58476D1CE4E5B9)
_R_INV = np.uint64(pow(int(_R), -1, 1 << 64))
_BLOCK = 1 << 21
_TABLE_BITS = 22


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """base^0.. and its inverse's powers, made once per process."""
    up = down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_R, n), _powers(_R_INV, n)
        return cls.up, cls.down


def _words(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words in lowered bytes; a word ends at a
    break (the first byte of a document) too."""
    ok = _IS_WORD[data]
    prev = np.empty_like(ok)
    prev[:1] = False
    prev[1:] = ok[:-1]
    cut = np.zeros(len(data) + 1, bool)
    cut[breaks] = True
    starts = np.flatnonzero(ok & (~prev | cut[:-1]))
    nxt = np.empty_like(ok)
    nxt[-1:] = False
    nxt[:-1] = ok[1:]
    ends = np.flatnonzero(ok & (~nxt | cut[1:])) + 1
    up, down = _Powers.get(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    h ^= h >> np.uint64(29)
    h *= _MIX
    h ^= h >> np.uint64(32)
    return starts, ends, h


def word_arrays(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lowered bytes of all texts, starts, ends, hashes, text number) of all
    words.  A long stretch is hashed in blocks that end between words."""
    joined = b"".join(texts)
    data = _LOW[np.frombuffer(joined, np.uint8)]
    low = data.tobytes()
    offsets = np.cumsum([0, *map(len, texts)])
    parts, at = [], 0
    while at < len(data):
        to = min(at + _BLOCK, len(data))
        if to < len(data):
            back = np.flatnonzero(~_IS_WORD[data[at:to]])
            # no gap in a whole block: one word of over 2 MB; take it to its end
            to = at + int(back[-1]) + 1 if len(back) else WORD.match(low, at).end()
        inner = offsets[(offsets >= at) & (offsets <= to)] - at
        s, e, h = _words(data[at:to], inner)
        parts.append((s + at, e + at, h))
        at = to
    starts, ends, hashes = (np.concatenate(x) if parts else np.zeros(0, np.int64) for x in (zip(*parts) if parts else ((), (), ())))
    owner = np.searchsorted(offsets, starts, side="right") - 1
    return low, starts, ends, hashes, owner


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    total, power = np.zeros(m, np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(n):
            total += hashes[k:k + m] * power
            power = power * _Q
    total ^= total >> np.uint64(31)
    return total * _MIX


def _windows_of(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out_w, out_i = b.column(0).to_pylist(), [], []
            for item, text in zip(ids, utf8(b.column(1))):
                words = WORD.findall(text.lower())
                if not words:
                    continue
                for i in range(max(1, len(words) - n + 1)):
                    out_w.append(b" ".join(words[i:i + n]))
                    out_i.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(out_w, pa.binary()), pa.array(out_i, pa.string())],
                                             names=["window", "item"])
    return run


def benchmark_windows(benchmark: DataFrame, n: int = 10, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """The distinct (window, item) pairs of the benchmark; a null text has
    none, a null id stays null."""
    ship_package(benchmark.sparkSession)
    return (benchmark.select(F.col(id_col).cast("string"), F.col(text))
            .mapInArrow(_windows_of(n), "window binary, item string").distinct())


class NgramSet:
    """The broadcast set: window text -> items, and a table and sorted array
    of window hashes for each window length."""

    def __init__(self, pairs: list[tuple[bytes, str | None]]):
        self.items: dict[bytes, list[str]] = {}
        by_length: dict[int, list[bytes]] = {}
        for w, item in pairs:
            if w not in self.items:
                self.items[w] = []
                by_length.setdefault(w.count(b" ") + 1, []).append(w)
            if item is not None:
                self.items[w].append(item)
        self.lengths = {}
        for n, windows in by_length.items():
            texts = [w for w in windows]
            _, _, h, owner = word_arrays(texts)[1:]
            first = np.searchsorted(owner, np.arange(len(texts)))
            found = np.unique(window_hashes(h, n)[first])
            table = np.zeros(1 << _TABLE_BITS, bool)
            table[found >> np.uint64(64 - _TABLE_BITS)] = True
            self.lengths[n] = (table, found)

    def scan(self, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], list[tuple[int, int]], set[str]]]:
        """For each text: number of words, hit word ranges, the byte ranges of
        these, items."""
        low, starts, ends, hashes, owner = word_arrays(texts)
        begin = np.searchsorted(owner, np.arange(len(texts) + 1))
        offsets = np.cumsum([0, *map(len, texts)])
        hits: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        for n, (table, known) in self.lengths.items():
            h = window_hashes(hashes, n)
            maybe = np.flatnonzero(table[h >> np.uint64(64 - _TABLE_BITS)])
            maybe = maybe[owner[maybe] == owner[maybe + n - 1]]
            at = np.minimum(np.searchsorted(known, h[maybe]), len(known) - 1)
            for i in maybe[known[at] == h[maybe]]:
                w = b" ".join([low[s:e] for s, e in zip(starts[i:i + n], ends[i:i + n])])
                found = self.items.get(w)
                if found is not None:
                    d = int(owner[i])
                    hits.setdefault(d, []).append((int(i), int(i) + n))
                    items.setdefault(d, set()).update(found)
        out = []
        for d in range(len(texts)):
            first = int(begin[d])
            ranges = merged([(a - first, b - first) for a, b in hits.get(d, ())])
            where = [(int(starts[first + a] - offsets[d]), int(ends[first + b - 1] - offsets[d])) for a, b in ranges]
            out.append((int(begin[d + 1]) - first, ranges, where, items.get(d, set())))
        return out


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of half-open ranges, those that touch joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_RANGE = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_FOUND = [("n_words", pa.int64()), ("hit_words", pa.list_(_RANGE)), ("hit_spans", pa.list_(_RANGE)),
          ("items", pa.list_(pa.string()))]
_FOUND_DDL = ("n_words long, hit_words array<struct<start:long,end:long>>, "
              "hit_spans array<struct<start:long,end:long>>, items array<string>")


def _scan(bc, width: int, text_at: int, again: bool):
    """Batches with ``width`` leading columns kept; with ``again`` the four
    found columns of an earlier block follow and are added to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ngrams: NgramSet = bc.value
        for b in batches:
            texts = utf8(b.column(text_at))
            for lo, hi in slices(texts):
                found = []
                for k, (n, words, spans, items) in enumerate(ngrams.scan(texts[lo:hi])):
                    if words:
                        body = texts[lo + k].decode()
                        spans = spans if len(body) == len(texts[lo + k]) else _code_points(texts[lo + k], spans)
                    found.append((n, words, spans, items))
                if again:
                    for k, old in enumerate(zip(*(b.column(width + j).slice(lo, hi - lo).to_pylist() for j in (1, 2, 3)))):
                        n, words, spans, items = found[k]
                        found[k] = (n, merged(words + [(r["start"], r["end"]) for r in old[0]]),
                                    merged(spans + [(r["start"], r["end"]) for r in old[1]]), items | set(old[2]))
                ranges = [[[{"start": s, "end": e} for s, e in f[j]] for f in found] for j in (1, 2)]
                arrays = [b.column(i).slice(lo, hi - lo) for i in range(width)]
                arrays += [pa.array([f[0] for f in found], pa.int64()), pa.array(ranges[0], _FOUND[1][1]),
                           pa.array(ranges[1], _FOUND[2][1]), pa.array([sorted(f[3]) for f in found], _FOUND[3][1])]
                yield pa.RecordBatch.from_arrays(arrays, names=[f"c{i}" for i in range(len(arrays))])
    return run


def _code_points(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    seen = np.zeros(len(text) + 1, np.int64)
    np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80, out=seen[1:])
    return [(int(seen[a]), int(seen[b])) for a, b in spans]


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", block_windows: int = 500_000, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` (all by default) and

    * ``n_words``, ``n_hit``: words of the text, and those inside a window,
    * ``hit_spans``: these in code points, as (start, end) with end exclusive,
    * ``items``: the ids, as strings, of the items with an occurring window.

    A found column's name that ``docs`` has already gets underscores before
    it.  Null and empty texts have no words; items of null id give hits but
    are not listed; repeated rows are scanned each; an empty benchmark hits
    nothing.
    """
    spark = docs.sparkSession
    ship_package(spark)
    windows = written(benchmark_windows(benchmark, n, item_id, item_text), "ngrams")
    total = windows.count()
    blocks = max(1, -(-total // block_windows))
    cols = list(keep if keep is not None else docs.columns)
    base = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)],
                       *([] if text in cols else [F.col(f"`{text}`").alias(f"c{len(cols)}")]))
    width, text_at = len(base.columns), cols.index(text) if text in cols else len(cols)
    ddl = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(base.schema.fields))
    out_ddl = ", ".join([ddl] + [f"c{width + j} {d.split(' ', 1)[1]}" for j, d in enumerate(_FOUND_DDL.split(", "))])
    out = base
    for k in range(blocks):
        mine = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k) if blocks > 1 else windows
        bc = spark.sparkContext.broadcast(NgramSet([(bytes(r[0]), r[1]) for r in mine.collect()]))
        out = out.mapInArrow(_scan(bc, width, text_at, k > 0), out_ddl)
        if blocks > 1:                                  # only one block's set is in memory at a time
            out = written(out, "scan")
            bc.unpersist()
    names = {}
    for name in ("n_words", "n_hit", "hit_spans", "items"):
        names[name] = free_name(docs.select(*[f"`{c}`" for c in cols]) if cols else docs.limit(0), name)
    hit = F.aggregate(F.col(f"c{width + 1}"), F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)],
                      F.col(f"c{width}").alias(names["n_words"]), hit.alias(names["n_hit"]),
                      F.col(f"c{width + 2}").alias(names["hit_spans"]), F.col(f"c{width + 3}").alias(names["items"]))


def drop_documents(docs: DataFrame, benchmark: DataFrame, least_hits: int = 1, **how) -> DataFrame:
    """``docs`` without the rows that have ``least_hits`` hit words or more."""
    hit = free_name(docs, "n_hit")
    return scan(docs, benchmark, **how).where(F.col(hit) < least_hits).select(*[f"`{c}`" for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """``docs`` with the hit spans cut out of the text; other rows as they
    are."""
    spans = free_name(docs, "hit_spans")
    found = scan(docs, benchmark, text=text, **how)
    size = F.char_length(F.col(text))
    at = F.col(spans)
    # what lies between the end of a span and the start of the next
    left = F.array_join(F.transform(
        F.sequence(F.lit(0), F.size(at)),
        lambda i: F.substring(F.col(text), (F.when(i == 0, F.lit(0)).otherwise(F.get(at, i - 1)["end"]) + 1).cast("int"),
                              (F.coalesce(F.get(at, i)["start"], size)
                               - F.when(i == 0, F.lit(0)).otherwise(F.get(at, i - 1)["end"])).cast("int"))), "")
    return found.withColumn(text, F.when(F.size(at) > 0, left).otherwise(F.col(text))).select(
        *[f"`{c}`" for c in docs.columns])
