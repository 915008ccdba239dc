"""Scan of a document collection (S6): a snapshot of Extended-JSON lines.

A snapshot is a folder of files, one document a line, with an index beside
them: the smallest and greatest ``_id`` of every piece of a file.  The scan is
a Python data source whose partitions are those pieces; comparisons on ``_id``
are pushed into it, and pieces that cannot hold a fitting key are never opened.
``write_snapshot`` sorts by key, so that pieces are key ranges;
``index_snapshot`` indexes files that came from elsewhere, in any order.
"""

from __future__ import annotations

import json
import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import variant as V
from ..session import materialize, ship_package
from . import listing as LS
from .paths import filesystem, join, qualified

INDEX = "_index"
PIECE_BYTES = 128 << 20
BLOCK = 4 << 20
ROWS = 5_000
PIECE = "file string, start long, end long, first string, last string, n_rows long"
_PLAIN_ID = re.compile(rb'\s*\{\s*"_id"\s*:\s*\{\s*"\$oid"\s*:\s*"([0-9a-fA-F]+)"\s*\}')


def key_text(line: bytes) -> str | None:
    """The text of a document's ``_id``; None if it has none or is no document."""
    m = _PLAIN_ID.match(line)
    if m:
        return m.group(1).decode()
    try:
        doc = json.loads(line)
    except ValueError:
        return None
    key = doc.get("_id") if isinstance(doc, dict) else None
    if isinstance(key, dict) and len(key) == 1:
        key = next(iter(key.values()))
    if key is None or isinstance(key, str):
        return key
    return json.dumps(key, separators=(",", ":"))


def lines_of(uri: str, start: int, end: int) -> Iterator[bytes]:
    """The lines that begin in bytes [start, end) of a file, without blanks."""
    fs, path = filesystem(uri)
    with fs.open_input_file(path) as f:
        at, carry, skip = max(0, start - 1), b"", start > 0       # the line that begins before is the piece before's
        f.seek(at)
        while at < end:
            block = f.read(BLOCK)
            if not block:
                if carry.strip() and not skip:
                    yield carry
                return
            lines = (carry + block).split(b"\n")
            carry = lines.pop()
            for line in lines:
                if at >= end:
                    return
                at += len(line) + 1
                if line.strip() and not skip:
                    yield line
                skip = False


@dataclass
class Piece(InputPartition):
    file: str
    start: int
    end: int


class CollectionReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.low, self.high = options.get("low"), options.get("high")
        self.keys = json.loads(options["keys"]) if "keys" in options else None

    def _fits(self, first: str | None, last: str | None) -> bool:
        """Whether a piece with keys from ``first`` to ``last`` can hold one that is asked for."""
        if self.low is None and self.high is None and self.keys is None:
            return True
        return (first is not None and (self.low is None or last >= self.low) and (self.high is None or first < self.high)
                and (self.keys is None or any(first <= k <= last for k in self.keys)))

    def partitions(self):
        import pyarrow.parquet as pq
        fs, path = filesystem(join(self.path, INDEX))
        pieces = pq.read_table(path, filesystem=fs, columns=["file", "start", "end", "first", "last"]).to_pylist()
        return [Piece(p["file"], p["start"], p["end"]) for p in pieces if self._fits(p["first"], p["last"])]

    def read(self, piece):
        names, keys, texts = ["_id", "line"], [], []
        if piece is None:
            return
        for line in lines_of(join(self.path, piece.file), piece.start, piece.end):
            keys.append(key_text(line))
            texts.append(line.decode("utf-8", "replace"))
            if len(keys) == ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(texts, pa.string())], names=names)
                keys, texts = [], []
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(texts, pa.string())], names=names)


class Collection(DataSource):
    """``spark.read.format("riverbed_collection").load(path)``."""

    @classmethod
    def name(cls):
        return "riverbed_collection"

    def schema(self):
        return "_id string, line string"

    def reader(self, schema):
        return CollectionReader(self.options)


def read_collection(spark: SparkSession, path: str, low: str | None = None, high: str | None = None,
                    keys: list[str] | None = None) -> DataFrame:
    """_id, line (the document as it came) and document (VARIANT; null for a
    line that is no JSON) of the documents with ``low`` <= _id < ``high`` and
    _id in ``keys``, as far as these are given.

    The bounds are options of the scan.  Spark 4.1 can push filters into a
    Python source by itself, but all scans of one DataFrame in a plan then
    share the last one's: a union of two filters lost rows.
    """
    ship_package(spark)
    spark.dataSource.register(Collection)
    reader, key, fits = spark.read.format("riverbed_collection"), F.col("_id"), F.lit(True)
    if low is not None:
        reader, fits = reader.option("low", low), fits & (key >= low)
    if high is not None:
        reader, fits = reader.option("high", high), fits & (key < high)
    if keys is not None:
        reader, fits = reader.option("keys", json.dumps(keys)), fits & key.isin(*keys)
    rows = reader.load(qualified(spark, path)).where(fits)
    return rows.select("_id", "line", F.try_parse_json("line").alias("document"))


# --------------------------------------------------------------------- index


def _keys_of(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                first = last = None
                n = 0
                for line in lines_of(join(root, r["file"]), r["start"], r["end"]):
                    n += 1
                    key = key_text(line)
                    if key is not None:
                        first, last = min(first or key, key), max(last or key, key)
                out.append({**r, "first": first, "last": last, "n_rows": n})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("file", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                                             ("first", pa.string()), ("last", pa.string()), ("n_rows", pa.int64())]))
    return run


def index_snapshot(spark: SparkSession, path: str, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Index the files under ``path``: one pass over them, in pieces of about
    ``piece_bytes``.  Returns the index."""
    ship_package(spark)
    root = qualified(spark, path)
    files = LS.list_objects(spark, {"": path}).where(
        ~F.col("object_key").startswith(INDEX + "/") & (F.col("size_bytes") > 0) & ~F.col("object_key").rlike(r"(^|/)\.[^/]*$"))
    starts = F.sequence(F.lit(0).cast("long"), F.col("size_bytes") - 1, F.lit(piece_bytes).cast("long"))
    pieces = files.select(F.col("object_key").alias("file"), F.explode(starts).alias("start"), "size_bytes").select(
        "file", "start", F.least(F.col("start") + piece_bytes, F.col("size_bytes")).alias("end"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = pieces.repartition(4 * n, F.xxhash64("file", "start"))
    spread.mapInArrow(_keys_of(root), PIECE).write.mode("overwrite").parquet(join(root, INDEX))
    return spark.read.parquet(join(root, INDEX))


def _writer(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, size, start, first, last, n, out, done = f"{uuid.uuid4().hex}.jsonl", 0, 0, None, None, 0, None, []
        for b in batches:
            for key, line in zip(b.column("_id").to_pylist(), b.column("line").to_pylist()):
                if out is None:
                    fs, path = filesystem(join(root, name))
                    if fs.type_name != "s3":
                        fs.create_dir(posixpath.dirname(path), recursive=True)
                    out = fs.open_output_stream(path)
                data = line.encode() + b"\n"
                out.write(data)
                size, n = size + len(data), n + 1
                if key is not None:
                    first, last = min(first or key, key), max(last or key, key)
                if size - start >= PIECE_BYTES:
                    done.append((name, start, size, first, last, n))
                    start, first, last, n = size, None, None, 0
        if out is not None:
            out.close()
            if size > start:
                done.append((name, start, size, first, last, n))
        cols = list(zip(*done)) or [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
            pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))], names=["file", "start", "end", "first", "last", "n_rows"])
    return run


def write_snapshot(docs: DataFrame, path: str, files: int | None = None, line: str = "line") -> None:
    """Write a column of Extended-JSON text as a snapshot in the order of
    ``_id``, a file per task; only files that the index names belong to it, so
    what a dead attempt leaves is never read."""
    spark = docs.sparkSession
    ship_package(spark)
    root = qualified(spark, path)
    v = F.try_parse_json(F.col(line))
    keyed = materialize(docs.select(F.col(line).alias("line"), V.doc_id_text(V.field(v, "_id")).alias("_id")))
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = keyed.repartitionByRange(n, "_id", F.xxhash64("line")).sortWithinPartitions("_id")
    ranged.mapInArrow(_writer(root), PIECE).write.mode("overwrite").parquet(join(root, INDEX))
