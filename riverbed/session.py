"""SparkSession construction and cluster-level settings.

Everything here is plain Spark configuration.  The library never assumes a
local folder: lineage cuts go to the shared folder the cluster names in
``spark.checkpoint.dir``; only tests (where it is unset) get a temporary one.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on: UTC everywhere (epoch millis are decoded as
# UTC), ANSI on (lenient parses therefore use try_*), AQE with partition
# coalescing and skew-join splitting for hot keys.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # no record of the Python line of every Column call: it doubles the time
    # that building a plan takes
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # VARIANT columns are written as plain variant binary: inferring a
    # shredding schema per write costs ~5x the write itself here.
    "spark.sql.variant.inferShreddingSchema": "false",
}


# Of the change-data queries: what one task reads of a table or of a shuffle.
# Messages and documents take some 20 times their size on disk when a task
# sorts them, so Spark's own sizes let a task's memory grow to gigabytes.
# And the largest method that the JVM compiles (bytes of bytecode): a generated
# one beyond it runs interpreted for good, so such a stage goes by operators.
PIECES = {"spark.sql.files.maxPartitionBytes": "32m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
          "spark.sql.codegen.hugeMethodLimit": "8000"}


def build_session(master: str | None = None, app: str = "riverbed",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Session-level settings that can be changed on an existing session."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.adaptive.coalescePartitions.enabled",
              "spark.sql.sources.partitionOverwriteMode",
              "spark.sql.variant.inferShreddingSchema"):
        try:
            spark.conf.set(k, BASE_CONF[k])
        except Exception:  # static or locked conf on a managed cluster
            pass


def bound_pieces(spark: SparkSession, on: bool) -> None:
    """Set ``PIECES``, or give a session its own sizes back."""
    own = getattr(spark, "_riverbed_pieces", None)
    if on and own is None:
        spark._riverbed_pieces = {k: spark.conf.get(k) for k in PIECES}
    for k, v in (PIECES if on else own or {}).items():
        spark.conf.set(k, v)
    if not on:
        spark._riverbed_pieces = None


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared lineage-cut folder.

    Read from ``spark.checkpoint.dir``; only when it is unset and the session
    is local (tests) a fallback is created and registered.  On a cluster a
    machine's own folder would not be shared, so an unset one is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir() if hasattr(
            spark.sparkContext, "getCheckpointDir") else None
    if not d:
        local = spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")
        if not fallback and not local:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = fallback or tempfile.mkdtemp(prefix="riverbed-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:
        pass
    return d


def store_root(spark: SparkSession, name: str) -> str:
    """A folder for materialised tables under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, as a zip file through Spark's own file
    server, once per SparkContext; they import from it what runs in tasks."""
    sc = spark.sparkContext
    if getattr(sc, "_riverbed_shipped", False):
        return
    root = Path(__file__).resolve().parent
    if root.is_dir():
        path = os.path.join(tempfile.mkdtemp(prefix="riverbed-py-"), "riverbed.zip")
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, str(Path(root.name) / p.relative_to(root)))
        sc.addPyFile(path)
    sc._riverbed_shipped = True


def materialize(df):
    """Cut lineage by writing the rows as a parquet table in the shared
    checkpoint folder and reading them back (never a local checkpoint:
    executors may be lost).  Used where one batch's state feeds the next,
    exactly like a written table would.  One computation, columnar on disk
    (a reliable ``checkpoint()`` of an unpersisted plan computes it twice)."""
    import uuid
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "tables", uuid.uuid4().hex)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(feed):
    """Messages spread evenly over the tasks by position.  A feed made from a
    few row groups is otherwise written, and then parsed, by as few tasks."""
    return feed.repartition("topic", "partition", "offset")
