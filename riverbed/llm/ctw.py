"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions.  For each decision the tree of the ``depth``
bytes before it has a node per context of 0 to ``depth`` bytes, with a
Krichevsky-Trofimov (KT) estimate from the zeros and ones seen there, and the
weighted probability of a node is half its KT probability plus half the
product of its children's.  Counts come from the training texts; the trained
tree then gives each decision the mixture over all depths that the next
symbol of the training sequence would get.  A context without training counts
has no node, so the mixture starts at the longest context that has one.

A text is its words, lower-cased in A-Z, joined by single spaces, and an end
(a line feed); so the base score, a smoothed unigram model over words and the
end, and the tree's score are probabilities of the same thing.

How it runs.  Every task cuts its rows into blocks of bounded size, writes a
block's texts to a file of its own and asks for the n-grams of bytes (context
and symbol) and words that occur there, as compressed sorted lists dealt over
shards: n-grams by their last two context bytes, words by a hash.  A shard sums
the counts of all blocks, list by list, and makes its part of the tree, levels
``depth`` to 2; the two top levels, at most 256 * 255 nodes, pass through the
driver.  Then shards answer each block with the probabilities of its n-grams
and the counts of its words, and the block's texts are scored with those.
Nothing that grows with the corpus is broadcast, no task holds more than a
block or a shard's distinct entries, and texts are never shuffled.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import shared_fs, shared_path, ship_package, slices, utf8, written

END = b"\n"
_HALF = np.log(0.5)


# ----------------------------------------------------------- byte n-grams

def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def codes_of(bodies: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, ends): for every byte of every body (which ends with END) the
    ``depth`` bytes before it and itself as one number, the byte lowest; ENDs
    stand before the first.  ``ends`` are the bodies' ends in ``codes``."""
    pad = END * depth
    data = np.frombuffer(pad + pad.join(bodies), np.uint8)
    n = len(data) - depth
    codes = np.zeros(max(n, 0), np.uint64)
    for k in range(depth + 1):
        codes <<= np.uint64(8)
        codes |= data[k:k + len(codes)]
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    ends = np.cumsum(sizes)
    if len(bodies) > 1:                     # what stands at the ENDs between two bodies is none of theirs
        keep = np.ones(len(codes), bool)
        after = ends[:-1] + depth * np.arange(len(bodies) - 1)
        keep[(after[:, None] + np.arange(depth)).ravel()] = False
        codes = codes[keep]
    return codes, ends


class _Tally:
    """Counts of codes, compacted now and then."""

    def __init__(self, most: int = 4 << 20):
        self.most, self.parts, self.held = most, [], 0

    def add(self, codes: np.ndarray, counts: np.ndarray | None = None) -> None:
        if counts is None:
            codes, counts = np.unique(codes, return_counts=True)
        self.parts.append((codes, counts))
        self.held += len(codes)
        if self.held > self.most:
            codes, counts = self.total()
            self.parts, self.held = [(codes, counts)], len(codes)
            self.most = max(self.most, 2 * self.held)

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(self.parts) == 1:
            return self.parts[0]
        codes = np.concatenate([p[0] for p in self.parts])
        counts = np.concatenate([p[1] for p in self.parts])
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else np.zeros(0, np.int64)
        return codes[first], np.add.reduceat(counts, first) if len(first) else counts


# ------------------------------------------------------------------- tree

def _lgamma(x: np.ndarray) -> np.ndarray:
    """log gamma for x >= 0.5, by Stirling's series from x + 8 on."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7) + 1 / (1188 * y ** 9) - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log KT probability of a sequence with these counts."""
    a, b = zeros.astype(float), ones.astype(float)
    return _lgamma(a + 0.5) + _lgamma(b + 0.5) - _lgamma(a + b + 1) - np.log(np.pi)


def _decisions(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, bits), 8 rows each: the place in the byte (1 and the bits
    before) and the bit of each decision."""
    shift = np.arange(7, -1, -1, dtype=np.int64)[:, None]
    s = symbols.astype(np.int64)[None, :]
    return (1 << (7 - shift)) | (s >> (shift + 1)), (s >> shift) & 1


def _level(keys: np.ndarray, bits: np.ndarray, n: np.ndarray):
    """Distinct nodes of a level with their counts: (keys, place of each
    decision's node, zeros, ones)."""
    known, at = np.unique(keys.ravel(), return_inverse=True)
    at = at.reshape(keys.shape)
    weight = np.broadcast_to(n, keys.shape)
    ones = np.bincount(at.ravel(), (weight * bits).ravel(), len(known))
    return known, at, np.bincount(at.ravel(), weight.ravel(), len(known)) - ones, ones


def _mix(p: np.ndarray, own: np.ndarray, seen: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The estimate of a level given that of the level below (nan: none)."""
    return np.where(np.isnan(p), np.where(seen, own, np.nan), weight * own + (1 - weight) * p)


def lower_levels(codes: np.ndarray, n: np.ndarray, depth: int):
    """Levels ``depth`` to 2 for n-grams that hold all of their two last
    context bytes: the estimate (8 rows) of each n-gram's decisions by these
    levels, and the level-2 nodes: (context and node, zeros, ones, log of the
    weighted probability)."""
    context, (nodes, bits) = (codes >> np.uint64(8)).astype(np.int64), _decisions(codes & np.uint64(255))
    below = None
    levels = []
    for d in range(depth, 1, -1):
        keys = ((context & ((1 << (8 * d)) - 1)) << 8)[None, :] | nodes
        known, at, zeros, ones = _level(keys, bits, n)
        kt = log_kt(zeros, ones)
        if below is None:
            weighted, weight = kt, np.ones(len(known))
        else:
            # a node one level down belongs to the node without its oldest byte
            parent = np.searchsorted(known, below[0] & ((1 << (8 * d + 8)) - 1))
            children = np.bincount(parent, below[1], len(known))
            weighted = np.logaddexp(kt, children) + _HALF
            weight = 1 / (1 + np.exp(np.clip(children - kt, -700, 700)))
        below = (known, weighted)
        levels.append((at, zeros, ones, weight))
    p = np.full(nodes.shape, np.nan)
    for at, zeros, ones, weight in levels:
        total = zeros + ones
        own = ((ones + 0.5) / (total + 1))[at]
        p = _mix(p, np.where(bits == 1, own, 1 - own), (total > 0)[at], weight[at])
    known, (_, zeros, ones, _) = below[0], levels[-1]
    return p, (known, zeros, ones, below[1])


class Top:
    """Levels 1 and 0: arrays over (context byte, node) and (node)."""

    def __init__(self, context: np.ndarray, node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray):
        self.zeros, self.ones, below = (np.zeros((256, 256)) for _ in range(3))
        for a, v in ((self.zeros, zeros), (self.ones, ones), (below, children)):
            a[context, node] = v
        kt = log_kt(self.zeros, self.ones)
        self.weight = 1 / (1 + np.exp(np.clip(below - kt, -700, 700)))
        weighted = np.logaddexp(kt, below) + _HALF
        self.zeros0, self.ones0 = self.zeros.sum(axis=0), self.ones.sum(axis=0)
        kt0 = log_kt(self.zeros0, self.ones0)
        self.weight0 = 1 / (1 + np.exp(np.clip(weighted.sum(axis=0) - kt0, -700, 700)))

    def log10(self, codes: np.ndarray, p: np.ndarray) -> np.ndarray:
        """log10 of the probability of each n-gram's byte, from the estimates
        of the lower levels."""
        context, (nodes, bits) = ((codes >> np.uint64(8)) & np.uint64(255)).astype(np.int64), _decisions(codes & np.uint64(255))
        context = np.broadcast_to(context, nodes.shape)
        for zeros, ones, weight in ((self.zeros[context, nodes], self.ones[context, nodes], self.weight[context, nodes]),
                                    (self.zeros0[nodes], self.ones0[nodes], self.weight0[nodes])):
            total = zeros + ones
            own = (ones + 0.5) / (total + 1)
            p = _mix(p, np.where(bits == 1, own, 1 - own), total > 0, weight)
        return np.log10(np.where(np.isnan(p), 0.5, p)).sum(axis=0)


class Lookup:
    """Values by code: a few hash tables, each for what collided before."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        self.layers = []
        rest, salt = np.arange(len(codes)), 0
        while len(rest):
            bits = max(4, int(len(rest) * 3).bit_length())
            mult = np.uint64((0x9E3779B97F4A7C15 + 2 * 0x632BE59BD9B4E019 * salt) % (1 << 64) | 1)
            slot = (codes[rest] * mult) >> np.uint64(64 - bits)
            own = np.full(1 << bits, -1, np.int64)
            own[slot] = rest
            won = own[slot] == rest
            keys = np.where(own >= 0, codes[own], np.uint64(1 << 63))
            self.layers.append((mult, np.uint64(64 - bits), keys, np.where(own >= 0, values[own], np.nan)))
            rest, salt = rest[~won], salt + 1

    def get(self, codes: np.ndarray) -> np.ndarray:
        """The values; nan where a code is not known."""
        out = np.full(len(codes), np.nan)
        rest = None
        for mult, shift, keys, values in self.layers:
            mine = codes if rest is None else codes[rest]
            slot = (mine * mult) >> shift
            hit = keys[slot] == mine
            if rest is None:
                out[hit] = values[slot[hit]]
                rest = np.flatnonzero(~hit)
            else:
                out[rest[hit]] = values[slot[hit]]
                rest = rest[~hit]
            if not len(rest):
                break
        return out


# -------------------------------------------------------------- Spark side

CODES, WORDS, NODES, TOTALS = range(4)


def _pack(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 1)


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def _pack_codes(codes: np.ndarray) -> bytes:
    """Sorted codes as differences, their bytes in planes."""
    steps = np.diff(codes, prepend=np.uint64(0))
    return _pack(steps.view(np.uint8).reshape(-1, 8).T)


def _unpack_codes(data: bytes) -> np.ndarray:
    planes = _unpack(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _shard_of(codes: np.ndarray, shards: int) -> np.ndarray:
    context = (codes >> np.uint64(8)) & np.uint64(0xFFFF)
    return ((context * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % shards


_ASK = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_ASK_DDL = "kind int, block long, shard int, keys binary, counts binary"


def _ask(folder: str, depth: int, shards: int, block_bytes: int):
    """(id, held, text) rows to block files and the blocks' lists."""
    def lists(block: int, held: list[bool], bodies: list[bytes]) -> Iterator[pa.RecordBatch]:
        rows = []
        grams, words = _Tally(), Counter()
        for train in (True, False):
            mine = [b for b, h in zip(bodies, held) if h != train]
            for lo, hi in slices(mine):
                codes, n = np.unique(codes_of(mine[lo:hi], depth)[0], return_counts=True)
                grams.add(codes, n if train else np.zeros_like(n))
            for b in mine:
                if train:
                    words.update(b.split())
                else:
                    words.update(dict.fromkeys(b.split(), 0))
            if mine:
                words.update({END: len(mine) if train else 0})
        codes, n = grams.total()
        shard = _shard_of(codes, shards)
        order = np.argsort(shard, kind="stable")
        ends = np.searchsorted(shard[order], np.arange(shards + 1))
        for k in range(shards):
            own = order[ends[k]:ends[k + 1]]
            if len(own):
                rows.append((CODES, block, k, _pack_codes(codes[own]), _pack(n[own].astype(np.int64))))
        parts: list[list[bytes]] = [[] for _ in range(shards)]
        for w in words:
            parts[zlib.crc32(w) % shards].append(w)
        for k, part in enumerate(parts):
            if part:
                part.sort()
                rows.append((WORDS, block, k, zstandard.compress(b" ".join(part), 1),
                             _pack(np.fromiter((words[w] for w in part), np.int64, len(part)))))
        for lo in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[lo:lo + 64]), _ASK)], schema=_ASK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = shared_fs(folder)
        ids, held, bodies, size = [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            # a number of its own for each attempt: only blocks in the committed lists count
            block = uuid.uuid4().int >> 65
            with fs.open_output_stream(f"{root}/{block}.parquet") as out:
                pq.write_table(pa.table({"id": pa.chunked_array(ids), "held": pa.array(held), "body": pa.array(bodies, pa.large_binary())}),
                               out, compression="zstd", compression_level=1, use_dictionary=False)
            yield from lists(block, held, bodies)

        for b in batches:
            at = 0
            for i, (h, t) in enumerate(zip(b.column(1).to_pylist(), utf8(b.column(2)))):
                held.append(h)
                bodies.append(b" ".join(words_of(t)) + END)
                size += len(bodies[-1])
                if size >= block_bytes:
                    ids.append(b.column(0).slice(at, i + 1 - at))
                    yield from flush()
                    ids, held, bodies, size, at = [], [], [], 0, i + 1
            if at < b.num_rows:
                ids.append(b.column(0).slice(at))
        if bodies:
            yield from flush()
    return run


_SUM = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("context", pa.int32()),
                  ("node", pa.int32()), ("zeros", pa.float64()), ("ones", pa.float64()), ("children", pa.float64())])
_SUM_DDL = ("kind int, shard int, keys binary, counts binary, context int, node int, zeros double, ones double, children double")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _sum(depth: int, most: int):
    """The lists of a (kind, shard) summed: n-grams with their estimates by
    the lower levels and the nodes at level 1; words with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (None,) * 5
        for (kind, shard), asked in groupby(_rows(batches), lambda r: (r[0], r[2])):
            if kind == WORDS:
                total: dict[bytes, int] = {}
                for _, _, _, keys, counts in asked:
                    for w, n in zip(zstandard.decompress(keys).split(b" "), _unpack(counts, np.int64).tolist()):
                        total[w] = total.get(w, 0) + n
                words = sorted(total)
                yield _batch([(TOTALS, shard, None, None, None, None, float(sum(total.values())),
                               float(sum(n > 0 for n in total.values())), None)], _SUM)
                for lo in range(0, len(words), most):
                    part = words[lo:lo + most]
                    yield _batch([(WORDS, shard, zstandard.compress(b" ".join(part), 1),
                                   _pack(np.fromiter((total[w] for w in part), np.int64, len(part))), *none)], _SUM)
                continue
            tally = _Tally()
            for _, _, _, keys, counts in asked:
                tally.add(_unpack_codes(keys), _unpack(counts, np.int64))
            codes, n = tally.total()
            p, (known, zeros, ones, weighted) = lower_levels(codes, n.astype(float), depth)
            for lo in range(0, len(codes), most):
                yield _batch([(CODES, shard, _pack_codes(codes[lo:lo + most]), _pack(p[:, lo:lo + most]), *none)], _SUM)
            # level-2 nodes summed by their last context byte
            above, at = np.unique(known & 0xFFFF, return_inverse=True)
            sums = [np.bincount(at, x, len(above)) for x in (zeros, ones, weighted)]
            m = len(above)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, NODES, np.int32)), pa.array(np.full(m, shard, np.int32)), pa.nulls(m, pa.binary()),
                 pa.nulls(m, pa.binary()), pa.array((above >> 8).astype(np.int32)), pa.array((above & 255).astype(np.int32)),
                 *map(pa.array, sums)], schema=_SUM)
    return run


_ANSWER = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("values", pa.binary())])
_ANSWER_DDL = "kind int, block long, keys binary, values binary"


def _answer(bc):
    """Per (kind, shard): the summed entries (block null) come first, then the
    blocks' lists, each answered with the values of its keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (kind, _), rows in groupby(_rows(batches), lambda r: (r[0], r[2])):
            keys, values, words = [], [], {}
            for _, block, _, asked, counts in rows:
                if block is None and kind == CODES:
                    keys.append(_unpack_codes(asked))
                    values.append(bc.value.log10(keys[-1], _unpack(counts, np.float64).reshape(8, -1)).astype(np.float32))
                elif block is None:
                    words.update(zip(zstandard.decompress(asked).split(b" "), _unpack(counts, np.int64).tolist()))
                elif kind == CODES:
                    if len(keys) > 1:
                        order = np.argsort(np.concatenate(keys), kind="stable")
                        keys, values = [np.concatenate(keys)[order]], [np.concatenate(values)[order]]
                    got = values[0][np.searchsorted(keys[0], _unpack_codes(asked))]
                    yield _batch([(kind, block, asked, _pack(got))], _ANSWER)
                else:
                    mine = zstandard.decompress(asked).split(b" ")
                    got = np.fromiter(map(words.__getitem__, mine), np.int64, len(mine))
                    yield _batch([(kind, block, asked, _pack(got))], _ANSWER)
    return run


def _score(folder: str, depth: int, total: float, distinct: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = shared_fs(folder)
        for block, rows in groupby(_rows(batches), lambda r: r[1]):
            codes, values, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.float32)], {}
            for kind, _, keys, got in rows:
                if kind == CODES:
                    codes.append(_unpack_codes(keys))
                    values.append(_unpack(got, np.float32))
                else:
                    counts.update(zip(zstandard.decompress(keys).split(b" "), _unpack(got, np.int64).tolist()))
            table = Lookup(np.concatenate(codes), np.concatenate(values).astype(np.float64))
            with fs.open_input_file(f"{root}/{block}.parquet") as f:
                docs = pq.read_table(f)
            ids, held = docs.column("id").combine_chunks(), docs.column("held").combine_chunks()
            bodies = utf8(docs.column("body"))
            for lo, hi in slices(bodies):
                part = bodies[lo:hi]
                grams, ends = codes_of(part, depth)
                sums = np.concatenate(([0.0], np.cumsum(table.get(grams))))[np.concatenate(([0], ends))]
                n_tokens, n_known, base = [], [], []
                for b in part:
                    words = b.split()
                    words.append(END)
                    c = np.fromiter(map(counts.__getitem__, words), np.float64, len(words))
                    n_tokens.append(len(words))
                    n_known.append(int((c > 0).sum()))
                    base.append(float(np.log10((c + 1) / (total + distinct + 1)).sum()))
                scores = np.diff(sums)
                if np.isnan(scores).any():
                    raise ValueError("an n-gram of the block has no answer")
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), held.slice(lo, hi - lo), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()),
                     pa.array(base), pa.array(scores), pa.array([len(b) for b in part], pa.int64())],
                    names=["id", "held", "n_tokens", "n_known", "base", "score", "n_bytes"])
    return run


def is_held_out(id_col: Column) -> Column:
    """crc32 of the id as text, mod 7, is 2; a null id is an empty text."""
    return F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")) % 7 == 2


def score(docs: DataFrame, depth: int = 5, id_col: str = "doc_id", text: str = "text", held_out: Column | None = None,
          block_bytes: int = 32 << 20) -> DataFrame:
    """One row per row of ``docs``: the id, held_out, n_tokens (words and the
    end), n_known (those that occur in training texts), train_tokens,
    base_score, score (log10 probabilities of the text) and bits_per_byte (the
    code length per byte of the normal form).

    Texts that are not ``held_out`` train both models.  Null and empty texts
    are the end alone; repeated rows count and are scored each; without
    training texts every decision has probability 1/2 and base_score is 0;
    other columns are ignored.  ``depth`` is 2 to 7.
    """
    if not 2 <= depth <= 7:
        raise ValueError("depth: 2 to 7")
    spark = docs.sparkSession
    ship_package(spark)
    folder = shared_path(spark, "ctw_blocks")
    fs, root = shared_fs(folder)
    fs.create_dir(root, recursive=True)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), (is_held_out(F.col(f"`{id_col}`")) if held_out is None else held_out).alias("held"),
                       F.col(f"`{text}`").alias("text"))
    asked = written(rows.mapInArrow(_ask(folder, depth, shards, block_bytes), _ASK_DDL), "ctw")
    deal = lambda df, *by: df.repartition(shards, "kind", "shard").sortWithinPartitions("kind", "shard", *by)
    summed = written(deal(asked).mapInArrow(_sum(depth, 1 << 18), _SUM_DDL), "ctw")
    top = summed.where(F.col("kind") == NODES).groupBy("context", "node").agg(
        *[F.sum(c).alias(c) for c in ("zeros", "ones", "children")]).toPandas()
    model = Top(*(top[c].to_numpy() for c in ("context", "node")), *(top[c].to_numpy() for c in ("zeros", "ones", "children")))
    n, v = summed.where(F.col("kind") == TOTALS).agg(F.coalesce(F.sum("zeros"), F.lit(0.0)), F.coalesce(F.sum("ones"), F.lit(0.0))).first()
    entries = summed.where(F.col("kind") <= WORDS).select("kind", F.lit(None).cast("long").alias("block"), "shard", "keys", "counts")
    lists = asked.withColumn("counts", F.lit(None).cast("binary"))
    answers = deal(entries.union(lists), F.asc_nulls_first("block")).mapInArrow(
        _answer(spark.sparkContext.broadcast(model)), _ANSWER_DDL)
    kind = rows.schema["id"].dataType.simpleString()
    out = (answers.repartition(shards, "block").sortWithinPartitions("block", "kind")
           .mapInArrow(_score(folder, depth, n, v),
                       f"id {kind}, held boolean, n_tokens long, n_known long, base double, score double, n_bytes long"))
    return out.select(F.col("id").alias(id_col), F.col("held").alias("held_out"), "n_tokens", "n_known",
                      F.lit(int(n)).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score",
                      (-F.col("score") / F.log10(F.lit(2.0)) / F.col("n_bytes")).alias("bits_per_byte"))
