"""Listings of object buckets (S7, S8), made by tasks.

A bucket is a folder.  Listing goes level by level: each round is a job whose
rows are key prefixes, every task lists the prefixes it got, and the prefixes
found are the next round's rows.  Once there are prefixes enough for all tasks
each is walked to its end by one of them, a folder at a time.  The driver sees
only how many prefixes are left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from .paths import filesystem, join, qualified

CHUNK = 4 << 20
LISTED = "bucket string, root string, object_key string, size_bytes long, last_modified timestamp, folder boolean"
INVENTORY = ["bucket", "object_key", "size_bytes", "last_modified"]


def bucket_roots(spark: SparkSession, roots: dict[str, str], skip_missing: bool = False) -> DataFrame:
    """(bucket, root) of the buckets that are there.  One that is not, or that
    cannot be asked for, is left out (``skip_missing``) or ends the job."""
    from pyarrow.fs import FileType
    found = []
    for bucket, root in roots.items():
        try:
            uri = qualified(spark, root)
            fs, path = filesystem(uri)
            if fs.get_file_info(path).type != FileType.Directory:
                raise FileNotFoundError(f"bucket {bucket}: no folder at {uri}")
        except Exception:
            if not skip_missing:
                raise
            continue
        found.append((bucket, uri))
    return spark.createDataFrame(found, "bucket string, root string")


def _list(whole: bool):
    """Lists the folders of (bucket, root, object_key) rows: what lies in each,
    or, if ``whole``, below it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSelector, FileType
        for b in batches:
            for bucket, root, prefix in zip(*(b.column(c).to_pylist() for c in ("bucket", "root", "object_key"))):
                fs, base = filesystem(root)
                base = base.rstrip("/")
                stack = [prefix]
                while stack:
                    at = stack.pop()
                    infos = fs.get_file_info(FileSelector(f"{base}/{at}".rstrip("/")))
                    rows = [(i.path[len(base) + 1:], i.type == FileType.Directory, i.size, i.mtime) for i in infos
                            if i.type in (FileType.Directory, FileType.File)]
                    if whole:
                        stack += [r[0] for r in rows if r[1]]
                        rows = [r for r in rows if not r[1]]
                    for a in range(0, len(rows), 10_000):
                        part = rows[a:a + 10_000]
                        yield pa.RecordBatch.from_arrays([
                            pa.array([bucket] * len(part)), pa.array([root] * len(part)), pa.array([r[0] for r in part], pa.string()),
                            pa.array([r[2] for r in part], pa.int64()), pa.array([r[3] for r in part], pa.timestamp("us", "UTC")),
                            pa.array([r[1] for r in part], pa.bool_())],
                            names=["bucket", "root", "object_key", "size_bytes", "last_modified", "folder"])
    return run


def list_objects(spark: SparkSession, roots: dict[str, str], skip_missing: bool = False, least_prefixes: int | None = None) -> DataFrame:
    """bucket, root, object_key, size_bytes, last_modified of every file under
    the buckets, as a written table."""
    ship_package(spark)
    tasks = spark.sparkContext.defaultParallelism
    enough = least_prefixes or 4 * tasks
    front = bucket_roots(spark, roots, skip_missing).withColumn("object_key", F.lit(""))
    files, left = [], front.count()
    while left:
        whole = left >= enough
        found = materialize(front.repartition(min(left, 16 * tasks)).mapInArrow(_list(whole), LISTED))
        files.append(found.where(~F.col("folder")).drop("folder"))
        front = found.where(F.col("folder")).select("bucket", "root", "object_key")
        left = 0 if whole else front.count()
    if not files:
        return spark.createDataFrame([], LISTED).drop("folder")
    out = files[0]
    for f in files[1:]:
        out = out.unionByName(f)
    return out


def read_chunks(uri: str) -> Iterator[bytes]:
    """A file's bytes, a few megabytes at a time."""
    fs, path = filesystem(uri)
    with fs.open_input_stream(path, buffer_size=CHUNK) as f:
        while chunk := f.read(CHUNK):
            yield chunk


def _etags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        tags = []
        for root, key in zip(b.column("root").to_pylist(), b.column("object_key").to_pylist()):
            digest = hashlib.md5()
            for chunk in read_chunks(join(root, key)):
                digest.update(chunk)
            tags.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tags, pa.string())], names=[*b.schema.names, "etag"])


def with_etags(listed: DataFrame) -> DataFrame:
    """``listed`` (with ``root`` and ``object_key``) and the MD5 of each file's
    bytes, as single-part uploads have it.  Files are spread over tasks."""
    n = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = listed.repartition(n, F.xxhash64("root", "object_key"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in listed.schema.fields) + ", etag string"
    return spread.mapInArrow(_etags, ddl)


def object_inventory(spark: SparkSession, roots: dict[str, str], skip_missing: bool = False, with_etag: bool = False) -> DataFrame:
    """Bucket, object_key, size_bytes, last_modified (and etag) of every
    file under each bucket.

    A source listing (``skip_missing``) leaves out a bucket that is not there,
    like a failing bucket of the producer; any other listing fails loudly, as
    a bucket left out would turn all its objects into missing ones.  Contents
    are read only for ``with_etag``.
    """
    listed = list_objects(spark, roots, skip_missing)
    return (with_etags(listed) if with_etag else listed).select(*INVENTORY, *(["etag"] if with_etag else []))
