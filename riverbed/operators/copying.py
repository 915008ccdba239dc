"""Copying objects into their clean buckets.

A plan (objects whose copy is absent or differs) is dealt over tasks; each task
streams its objects from the source bucket into files of its own attempt and
moves them to their keys once they are whole.  An attempt that dies, or a
second one that runs beside it, never leaves a part of an object under its
key.  Afterwards the target buckets are listed again and every object of the
plan is held against what it should be, by size and etag.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources import listing as LS
from ..sources.paths import filesystem, join
from .store import HadoopFiles

WANTED = ["source_bucket", "source_object_key", "target_bucket", "target_object_key", "size_bytes", "etag"]
#: bytes that one task copies, about
TASK_BYTES = 1 << 30


def copy_plan(meta: DataFrame, inventory: DataFrame) -> DataFrame:
    """Objects whose target copy is absent or differs in size or etag."""
    want = meta.where("status = 'ACTIVE'").select(*WANTED)
    have = inventory.select(F.col("bucket").alias("target_bucket"), F.col("object_key").alias("target_object_key"),
                            F.col("size_bytes").alias("_have_size"), F.col("etag").alias("_have_etag"))
    j = want.join(have, ["target_bucket", "target_object_key"], "left")
    return j.where(F.col("_have_size").isNull() | (F.col("_have_size") != F.col("size_bytes"))
                   | ~F.col("_have_etag").eqNullSafe(F.col("etag"))).drop("_have_size", "_have_etag")


def attempts_folder(root: str, job: str) -> str:
    """Beside the bucket, on its file system, and never listed with it."""
    return f"{root.rstrip('/')}.attempts-{job}"


def copy_file(source: str, target: str, attempt: str) -> tuple[int, str]:
    """Stream ``source`` to the new file ``attempt``, then move it to
    ``target``; returns the size and MD5 of the bytes that were copied."""
    fs, final = filesystem(target)
    _, part = filesystem(attempt)
    size, digest = 0, hashlib.md5()
    if fs.type_name != "s3":
        fs.create_dir(posixpath.dirname(part), recursive=True)
        fs.create_dir(posixpath.dirname(final), recursive=True)
    with fs.open_output_stream(part) as out:
        for chunk in LS.read_chunks(source):
            out.write(chunk)
            digest.update(chunk)
            size += len(chunk)
    try:
        fs.move(part, final)
    except OSError:                           # some file systems do not replace a file by a move
        fs.delete_file(final)
        fs.move(part, final)
    return size, digest.hexdigest()


def _copier(job: str, fail: str | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, tags, errors = [], [], []
            for source, target, sk, tk in zip(*(b.column(c).to_pylist() for c in ("_source", "_target", "source_object_key", "target_object_key"))):
                size = tag = error = None
                try:
                    size, tag = copy_file(join(source, sk), join(target, tk), join(attempts_folder(target, job), uuid.uuid4().hex))
                except FileNotFoundError as e:                  # the source went since it was listed
                    error = str(e)[:500]
                if fail:
                    import os
                    if not os.path.exists(fail):                # tests end the first attempt here
                        open(fail, "w").close()
                        raise RuntimeError("killed")
                sizes.append(size)
                tags.append(tag)
                errors.append(error)
            yield pa.RecordBatch.from_arrays(
                [b.column("target_bucket"), b.column("target_object_key"), pa.array(sizes, pa.int64()), pa.array(tags, pa.string()),
                 pa.array(errors, pa.string())], names=["target_bucket", "target_object_key", "copied_bytes", "copied_etag", "error"])
    return run


def copy_objects(plan: DataFrame, sources: dict[str, str], targets: dict[str, str], _fail: str | None = None) -> DataFrame:
    """Copy every object of ``plan``; returns, as a written table,
    target_bucket, target_object_key, copied_bytes, copied_etag and error (the
    source is not there any more, or its bucket is not known)."""
    spark = plan.sparkSession
    job = uuid.uuid4().hex[:12]
    roots = {True: LS.bucket_roots(spark, sources, skip_missing=True), False: LS.bucket_roots(spark, targets)}
    # at most one row per bucket on either side
    placed = (plan.join(F.broadcast(roots[True].toDF("source_bucket", "_source")), "source_bucket", "left")
              .join(F.broadcast(roots[False].toDF("target_bucket", "_target")), "target_bucket", "left"))
    placed = materialize(placed)
    known = F.col("_source").isNotNull() & F.col("_target").isNotNull()
    total = placed.agg(F.sum("size_bytes")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, total // TASK_BYTES)
    spread = placed.where(known).repartition(int(tasks), F.xxhash64("target_bucket", "target_object_key"))
    done = spread.mapInArrow(_copier(job, _fail), "target_bucket string, target_object_key string, copied_bytes long, copied_etag string, error string")
    lost = placed.where(~known).select("target_bucket", "target_object_key", F.lit(None).cast("long").alias("copied_bytes"),
                                       F.lit(None).cast("string").alias("copied_etag"), F.lit("unknown bucket").alias("error"))
    try:
        return materialize(done.unionByName(lost))
    finally:
        files = HadoopFiles(spark)
        for r in roots[False].collect():                        # one row per bucket
            files.drop(attempts_folder(r["root"], job))


def existing(spark: SparkSession, meta: DataFrame, targets: dict[str, str]) -> DataFrame:
    """The target inventory as far as ``copy_plan`` needs it: contents are read
    only of objects whose size is the wanted one."""
    listed = LS.list_objects(spark, targets)
    want = meta.select(F.col("target_bucket").alias("bucket"), F.col("target_object_key").alias("object_key"), "size_bytes").distinct()
    same = listed.join(want, ["bucket", "object_key", "size_bytes"], "left_semi").select(*listed.columns)
    other = listed.join(want, ["bucket", "object_key", "size_bytes"], "left_anti").select(*listed.columns)
    return LS.with_etags(same).unionByName(other.withColumn("etag", F.lit(None).cast("string"))).drop("root")


def copy_verified(spark: SparkSession, meta: DataFrame, sources: dict[str, str], targets: dict[str, str],
                  _fail: str | None = None) -> DataFrame:
    """Copy what is absent or differs, list the targets again, and return every
    ACTIVE object of ``meta`` with ``copied`` (it was written by this run),
    ``verified`` (its copy has the wanted size and etag now) and ``error``."""
    meta = materialize(meta.where("status = 'ACTIVE'").select(*WANTED, "status"))
    plan = materialize(copy_plan(meta, existing(spark, meta, targets)))
    done = copy_objects(plan, sources, targets, _fail)
    now = existing(spark, meta, targets).select(
        F.col("bucket").alias("target_bucket"), F.col("object_key").alias("target_object_key"),
        F.col("size_bytes").alias("_size"), F.col("etag").alias("_etag"))
    keys = ["target_bucket", "target_object_key"]
    out = meta.drop("status").join(done, keys, "left").join(now, keys, "left")
    fine = F.coalesce((F.col("_size") == F.col("size_bytes")) & (F.col("_etag") == F.col("etag")), F.lit(False))
    return out.select(*WANTED, F.col("copied_bytes").isNotNull().alias("copied"), fine.alias("verified"), "error")
