"""Token-id shards as wavelet matrices.

A shard file holds the ids of some documents, in ascending id order of the
documents, as one bit-plane per bit of the vocabulary, the top bit first; each
plane orders the ids by the bits above it (zeros first), which makes access,
counting (rank) and occurrence lookup (select) a walk over the planes.  Every
section of the file is zstd-compressed; a small JSON header has their places.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverbed.llm.common import shared_fs, shared_path, ship_package, utf8, written
from riverbed.sources.paths import qualified
from riverbed.llm.tokens import encoder

MAGIC = b"WVMX0001"
_RANK = 1 << 12                 # bits between stored counts of ones


class WaveletMatrix:
    """The ids 0 <= id < 2 ** bits of one shard."""

    def __init__(self, n: int, bits: int, planes: list[np.ndarray], ranks: list[np.ndarray], zeros: list[int]):
        self.n, self.bits, self.planes, self.ranks, self.zeros = n, bits, planes, ranks, zeros

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        now = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        then, planes, ranks, zeros = np.empty_like(now), [], [], []
        for b in range(bits - 1, -1, -1):
            bit = (now & now.dtype.type(1 << b)).astype(bool)
            plane = np.packbits(bit, bitorder="little")
            planes.append(plane)
            ranks.append(_rank_table(plane))
            low = len(now) - int(np.count_nonzero(bit))
            zeros.append(low)
            if b:                                   # zeros first, in place of the other buffer
                np.compress(bit, now, out=then[low:])
                np.compress(np.logical_not(bit, out=bit), now, out=then[:low])
                now, then = then, now
        return cls(len(ids), bits, planes, ranks, zeros)

    def _ones(self, level: int, to: int) -> int:
        """Ones before position ``to`` of a plane."""
        block = to // _RANK
        plane, at = self.planes[level], block * (_RANK // 8)
        tail = plane[at:to // 8]
        got = int(self.ranks[level][block]) + int(np.bitwise_count(tail).sum())
        return got + (int(plane[to // 8]) & ((1 << to % 8) - 1)).bit_count() if to % 8 else got

    def _bit(self, level: int, at: int) -> int:
        return int(self.planes[level][at // 8]) >> (at % 8) & 1

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for level in range(self.bits):
            bit, ones = self._bit(level, at), self._ones(level, at)
            at = self.zeros[level] + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def rank(self, value: int, to: int) -> int:
        """How often ``value`` occurs before position ``to``."""
        first, to = 0, min(max(to, 0), self.n)
        if not 0 <= value < 1 << self.bits:
            return 0
        for level in range(self.bits):
            a, b = self._ones(level, first), self._ones(level, to)
            if value >> (self.bits - 1 - level) & 1:
                first, to = self.zeros[level] + a, self.zeros[level] + b
            else:
                first, to = first - a, to - b
        return to - first

    def count(self, value: int, start: int = 0, end: int | None = None) -> int:
        return self.rank(value, self.n if end is None else end) - self.rank(value, start)

    def select(self, value: int, k: int) -> int:
        """The position of occurrence ``k`` (from 0), -1 if there is none."""
        if k < 0 or k >= self.count(value):
            return -1
        at = 0
        for level in range(self.bits):
            ones = self._ones(level, at)
            at = self.zeros[level] + ones if value >> (self.bits - 1 - level) & 1 else at - ones
        at += k
        for level in range(self.bits - 1, -1, -1):
            if value >> (self.bits - 1 - level) & 1:
                at = self._place(level, at - self.zeros[level], True)
            else:
                at = self._place(level, at, False)
        return at

    def _place(self, level: int, k: int, ones: bool) -> int:
        """Position of one (or zero) number ``k`` of a plane."""
        ranks = self.ranks[level].astype(np.int64)
        starts = np.arange(len(ranks), dtype=np.int64) * _RANK
        before = ranks if ones else starts - ranks
        block = int(np.searchsorted(before, k, side="right")) - 1
        at = block * (_RANK // 8)
        bits = np.unpackbits(self.planes[level][at:at + _RANK // 8], bitorder="little")
        hits = np.flatnonzero(bits == (1 if ones else 0))
        return block * _RANK + int(hits[k - int(before[block])])

    def decode(self) -> np.ndarray:
        """All ids in order: the planes undone from the last."""
        now = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for level in range(self.bits - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            up = np.empty_like(now)
            up[~bit] = now[:self.zeros[level]]
            up[bit] = now[self.zeros[level]:] | now.dtype.type(1 << (self.bits - 1 - level))
            now = up
        return now


def _rank_table(plane: np.ndarray) -> np.ndarray:
    step = _RANK // 8
    full = np.zeros(-(-max(len(plane), 1) // step) * step, np.uint8)
    full[:len(plane)] = np.bitwise_count(plane)
    sums = full.reshape(-1, step).sum(axis=1, dtype=np.uint32)
    return np.concatenate((np.zeros(1, np.uint32), np.cumsum(sums, dtype=np.uint32)))


def to_bytes(matrix: WaveletMatrix, docs: list[int | None], ends: np.ndarray, level: int = 1) -> bytes:
    """The shard file: magic, header length, header, sections."""
    z = zstandard.ZstdCompressor(level=level)
    known = np.array([d is not None for d in docs], np.uint8)
    raw = [np.array([d or 0 for d in docs], np.int64).tobytes(), known.tobytes(), np.asarray(ends, np.int64).tobytes()]
    raw += [p.tobytes() for p in matrix.planes] + [r.tobytes() for r in matrix.ranks]
    parts = [z.compress(x) for x in raw]
    places = np.cumsum([0, *map(len, parts)]).tolist()
    head = json.dumps({"n": matrix.n, "bits": matrix.bits, "zeros": matrix.zeros, "places": places}).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head, *parts])


def from_bytes(data: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    """(matrix, document ids, end of each document) of a shard file."""
    if data[:8] != MAGIC:
        raise ValueError("not a shard file")
    size = int.from_bytes(data[8:12], "little")
    head, body = json.loads(data[12:12 + size]), memoryview(data)[12 + size:]
    z = zstandard.ZstdDecompressor()
    raw = [z.decompress(body[a:b]) for a, b in zip(head["places"], head["places"][1:])]
    ids, known = np.frombuffer(raw[0], np.int64).tolist(), np.frombuffer(raw[1], np.uint8)
    bits = head["bits"]
    planes = [np.frombuffer(x, np.uint8) for x in raw[3:3 + bits]]
    ranks = [np.frombuffer(x, np.uint32) for x in raw[3 + bits:]]
    docs = [d if k else None for d, k in zip(ids, known)]
    return WaveletMatrix(head["n"], bits, planes, ranks, head["zeros"]), docs, np.frombuffer(raw[2], np.int64)


def open_shard(path: str) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    fs, at = shared_fs(path)
    with fs.open_input_file(at) as f:
        return from_bytes(f.read())


# -------------------------------------------------------------- Spark side

_MANIFEST = "file string, part int, seq int, first_doc long, first_row long, n_docs long, n_tokens long"


def _write(path: str, end_id: int, bits: int, shard_tokens: int, folder: str):
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, (fs, root) = encoder(path), shared_fs(folder)
        part, seq = TaskContext.get().partitionId(), 0
        docs, bodies, held, first_row = [], [], 0, 0

        def flush():
            # a name of its own for each attempt: only those in the committed manifest count
            file = f"shard-{part:05d}-{seq:05d}-{uuid.uuid4().hex}.wvm"
            ids = np.frombuffer(b"".join(bodies), "<u4")
            if len(ids) and int(ids.max()) >> bits:
                raise ValueError(f"an id needs more than {bits} bits")
            ends = np.cumsum([len(b) // 4 for b in bodies])
            with fs.open_output_stream(f"{root}/{file}") as f:
                f.write(to_bytes(WaveletMatrix.build(ids, bits), docs, ends))
            return pa.RecordBatch.from_pylist([{"file": f"{folder}/{file}", "part": part, "seq": seq, "first_doc": docs[0],
                                                "first_row": first_row, "n_docs": len(docs), "n_tokens": len(ids)}], _schema())

        for b in batches:
            for doc, row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2))):
                if not docs:
                    first_row = row
                docs.append(doc)
                bodies.append(enc.encode(text.decode()) + end)
                held += len(bodies[-1]) // 4
                if held >= shard_tokens:
                    yield flush()
                    seq, held, docs, bodies = seq + 1, 0, [], []
        if docs:
            yield flush()
    return run


def _schema() -> pa.Schema:
    return pa.schema([("file", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("first_doc", pa.int64()),
                      ("first_row", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def write_shards(docs: DataFrame, path: str, end_id: int = 1, bits: int = 16, shard_tokens: int = 1 << 21,
                 id_col: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """Write ``docs`` in ascending id order (null first, equal ids in their
    input's order) to shard files of about ``shard_tokens`` ids; returns the
    manifest: one row per file with ``start``, the ids in all files before it.

    A null text is the end id alone; other columns are ignored; an empty table
    gives no files.  ``folder`` must be one that all executors see; by default
    a new one in the shared folder.
    """
    spark = docs.sparkSession
    ship_package(spark)
    folder = qualified(spark, folder) if folder else shared_path(spark, "token_shards")
    fs, root = shared_fs(folder)
    fs.create_dir(root, recursive=True)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the row number keeps equal ids apart, so that many of them fill several partitions
    rows = (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.monotonically_increasing_id().alias("row"),
                        F.col(f"`{text}`").alias("text"))
            .repartitionByRange(n, F.asc_nulls_first("doc"), "row").sortWithinPartitions(F.asc_nulls_first("doc"), "row"))
    files = written(rows.mapInArrow(_write(path, end_id, bits, shard_tokens, folder), _MANIFEST), "token_manifest")
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the writing job
    parts = files.groupBy("part").agg(F.min(F.struct(F.col("first_doc").isNotNull(), "first_doc", "first_row")).alias("first"),
                                      F.sum("n_tokens").alias("all"))
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    return files.join(parts, "part").withColumn(
        "start", F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).drop("base")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for file, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            matrix, docs, ends = open_shard(file)
            ids = matrix.decode().astype("<u4")
            begin = np.concatenate((np.zeros(1, np.int64), ends[:-1]))
            crc = [zlib.crc32(ids[a:e]) for a, e in zip(begin, ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(begin + start), pa.array(ends - begin), pa.array(crc, pa.int64())],
                names=["doc", "start", "n_tokens", "ids_crc32"])


def read_shards(manifest: DataFrame) -> DataFrame:
    """One row per document of the files: doc, start, n_tokens, ids_crc32, by
    decoding every file."""
    spark = manifest.sparkSession
    ship_package(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("file", "start").repartition(n, "file").mapInArrow(
        _read, "doc long, start long, n_tokens long, ids_crc32 long")


def _find(value: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                matrix, docs, ends = open_shard(file)
                at = np.array([matrix.select(value, k) for k in range(matrix.count(value))], np.int64)
                own = np.searchsorted(ends, at, side="right")
                begin = np.concatenate((np.zeros(1, np.int64), ends))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([docs[i] for i in own], pa.int64()), pa.array(at - begin[own]), pa.array(at + start)],
                    names=["doc", "place", "position"])
    return run


def occurrences(manifest: DataFrame, value: int) -> DataFrame:
    """(doc, place in it, position over all files) of every occurrence of an
    id, by select on each file."""
    ship_package(manifest.sparkSession)
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("file", "start").repartition(n, "file").mapInArrow(
        _find(value), "doc long, place long, position long")
