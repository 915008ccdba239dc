"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.session import checkpoint_dir
from riverbed.sources.paths import filesystem, qualified


ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file, the same on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, as a zip file through Spark's own file
    server, once per SparkContext.  Functions of the operators are then
    imported on the workers (and keep their per-process caches) wherever the
    driver found the package."""
    # documents are long rows: batches of the default 10,000 rows would be tens
    # of megabytes, held several times over by each worker
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ARROW_ROWS:
        spark.conf.set(rows, str(ARROW_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_riverbed_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    if root.is_dir():
        path = os.path.join(tempfile.mkdtemp(prefix="riverbed-py-"), "riverbed.zip")
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, str(Path(root.name) / p.relative_to(root)))
        sc.addPyFile(path)
    sc._riverbed_shipped = True


def shared_path(spark: SparkSession, kind: str) -> str:
    """The URI of a new folder in the shared folder of ``spark.checkpoint.dir``,
    with the scheme that Spark itself would use."""
    return f"{qualified(spark, checkpoint_dir(spark)).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str = "tables") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and
    keeps the rows when executors are lost."""
    spark = df.sparkSession
    path = shared_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_fs(uri: str):
    """(file system, path) for a folder that driver and executors share, given
    as a URI; a scheme that Arrow does not know is an error."""
    return filesystem(uri)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it, such that ``df`` has no column
    of that name in any letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def utf8(col: pa.Array) -> list[bytes]:
    """The values of a string column as UTF-8, null as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_string(col.type):
        col = col.cast(pa.binary())
    elif pa.types.is_large_string(col.type):
        col = col.cast(pa.large_binary())
    return [b"" if v is None else v for v in col.to_pylist()]


def ascii_lower(col):
    """``col`` with only A-Z lowered (``lower`` would change other letters)."""
    up = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(col, up, up.lower())


def slices(texts: list[bytes], most: int = 1 << 21):
    """(first, last + 1) ranges of ``texts`` of about ``most`` bytes each."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)
