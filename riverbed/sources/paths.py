"""Shared folders as tasks see them: one qualified URI on the driver, one
Arrow file system in every task."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Schemes that Arrow opens; others of Hadoop's have no reader in a Python task.
SCHEMES = ("file", "hdfs", "viewfs", "s3", "s3a", "s3n", "gs", "gcs", "abfs", "abfss")


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and authority that Spark itself would use: a
    path without a scheme belongs to the cluster's default file system, not to
    each machine's own disk."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    scheme = uri.split(":", 1)[0]
    if scheme not in SCHEMES:
        raise ValueError(f"tasks cannot open {scheme}: paths ({uri})")
    return uri


def filesystem(uri: str):
    """(Arrow file system, path in it) of a qualified URI."""
    from pyarrow import fs
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    if scheme in ("s3a", "s3n"):
        uri = "s3:" + rest
    if scheme not in SCHEMES:
        raise ValueError(f"not a qualified path that tasks can open: {uri}")
    return fs.FileSystem.from_uri(uri)


def join(uri: str, key: str) -> str:
    return f"{uri.rstrip('/')}/{key}"
