"""Keyed tables and batch commits without a table format.

Layout under a pipeline's ``root`` (any Hadoop-compatible shared path)::

    clean/orders/b0000000007-3f2a/_bucket=3/part-*   bucket 3 as batch 7 left it
    mart/daily_revenue/b0000000007-3f2a/part-*       the mart after batch 7
    _commits/0000000007.json                         what batch 7 made current

* Everything that a batch writes goes to folders of its own attempt.  The one
  commit file, written last and never overwritten, names the current folders
  of all tables and marts.  Readers go by the newest commit, so they see the
  state after a whole batch, never a part of one; an attempt that died leaves
  folders that no commit names, and its replay starts from the same commit as
  it did.
* Rows are spread over ``pmod(xxhash64(key), buckets)``; a merge reads and
  rewrites only the buckets its batch touches.  The number of buckets follows
  the table's size when it is first written, is kept in the commit, and doubles
  until buckets are small enough when the table has grown.
* Rows keep their source position and delete markers, so an older event never
  overwrites a newer row or resurrects a deleted one (``changes.fold``).
* With a MERGE-capable table format this would be ``mergeInto``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import changes as CH


class HadoopFiles:
    """Small driver-side file operations through the cluster's FileSystem."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()

    def _path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def _fs(self, p: str):
        return self._path(p).getFileSystem(self.conf)

    def exists(self, p: str) -> bool:
        return self._fs(p).exists(self._path(p))

    def list_names(self, p: str) -> list[str]:
        if not self.exists(p):
            return []
        return [s.getPath().getName() for s in self._fs(p).listStatus(self._path(p))]

    def write_new(self, p: str, text: str) -> None:
        out = self._fs(p).create(self._path(p), False)     # fails if it exists
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def read_text(self, p: str) -> str:
        stream = self._fs(p).open(self._path(p))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def drop(self, p: str) -> None:
        self._fs(p).delete(self._path(p), True)

    def drop_matching(self, p: str, prefix: str) -> None:
        for name in self.list_names(p):
            if name.startswith(prefix):
                self.drop(f"{p}/{name}")


class Commits:
    """The commit files of a pipeline; the newest ``keep`` stay readable, older
    files and the folders that only they name go."""

    NONE = {"batch": -1, "tables": {}, "marts": {}}

    def __init__(self, spark: SparkSession, root: str, keep: int = 8):
        self.root, self.keep, self.fs = root.rstrip("/"), keep, HadoopFiles(spark)

    def _names(self) -> list[str]:
        return sorted(n for n in self.fs.list_names(f"{self.root}/_commits") if n.endswith(".json"))

    def _read(self, name: str) -> dict:
        return json.loads(self.fs.read_text(f"{self.root}/_commits/{name}"))

    def latest(self) -> dict:
        names = self._names()
        return self._read(names[-1]) if names else self.NONE

    def get(self, batch: int) -> dict:
        return self._read(f"{batch:010d}.json")

    def write(self, doc: dict) -> None:
        self.fs.write_new(f"{self.root}/_commits/{doc['batch']:010d}.json", json.dumps(doc, sort_keys=True))
        names = self._names()
        if len(names) > self.keep:
            kept = set().union(*(_folders(self._read(n)) for n in names[-self.keep:]))
            for n in names[:-self.keep]:
                for folder in _folders(self._read(n)) - kept:
                    self.fs.drop(f"{self.root}/{folder}")
                self.fs.drop(f"{self.root}/_commits/{n}")


def _folders(doc: dict) -> set[str]:
    return {p for t in doc["tables"].values() for p in t["paths"].values()} | set(doc["marts"].values())


class KeyedStore:
    """One keyed table; ``entry`` is its part of a commit."""

    #: What ``was`` adds to the files of a batch; it is no part of the table.
    EXTRA = ("_fresh", "_was")

    def __init__(self, spark: SparkSession, root: str, name: str, schema=None, key: str = "pk",
                 bucket_rows: int = 250_000, least_buckets: int = 4):
        """``key`` is the column that buckets follow; a row's own key is ``pk``."""
        self.spark, self.root, self.name, self.key = spark, root.rstrip("/"), name, key
        self.schema, self.bucket_rows, self.least_buckets = schema, bucket_rows, least_buckets
        #: buckets read by each ``near`` and rewritten by each ``merge``
        self.read_buckets: list[int] = []
        self.written_buckets: list[int] = []

    # ---------------------------------------------------------------- reads
    def _read(self, entry: dict | None, buckets=None) -> DataFrame:
        paths = [] if not entry else [f"{self.root}/{d}" for b, d in sorted(entry["paths"].items())
                                      if buckets is None or int(b) in buckets]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        folders = {p.rsplit("/", 1)[0] for p in paths}
        if len(folders) == 1 and len(paths) == len(entry["paths"]) and len(paths) > 1:
            return reader.parquet(folders.pop()).drop("_bucket", *self.EXTRA)     # one folder holds the whole version: one listing
        return reader.parquet(*paths).drop(*self.EXTRA)

    def state(self, entry: dict | None) -> DataFrame:
        """All rows, delete markers included."""
        return self._read(entry)

    def near(self, entry: dict | None, changes: DataFrame, known: tuple[int, dict[int, int]] | None = None) -> DataFrame:
        """The rows of the keys in ``changes``, from their buckets only
        (``known``: what ``touched`` gave for them, if it is at hand)."""
        if not entry:
            return self._read(None)
        touched = known[1] if known and known[0] == entry["buckets"] else self._touched(changes, entry["buckets"])
        self.read_buckets.append(len(touched))
        rows = self._read(entry, touched)
        return rows.join(changes.select(self.key).distinct(), self.key, "left_semi").select(*rows.columns)

    # --------------------------------------------------------------- writes
    def _keys(self) -> tuple:
        return ("pk",) if self.key == "pk" else (self.key, "pk")

    def _bucket(self, n: int):
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(n)).cast("int")

    def touched(self, entry: dict | None, changes: DataFrame) -> tuple[int, dict[int, int]] | None:
        """(number of buckets, those that the keys in ``changes`` are in, with how many changes)."""
        return (entry["buckets"], self._touched(changes, entry["buckets"])) if entry else None

    def within(self, rows: DataFrame, known: tuple[int, dict[int, int]]) -> DataFrame:
        """The rows whose keys lie in the buckets that ``touched`` gave."""
        n, buckets = known
        return rows if len(buckets) == n else rows.where(self._bucket(n).isin(list(buckets)))

    def _touched(self, changes: DataFrame, n: int) -> dict[int, int]:
        # at most ``n`` small rows
        return {r[0]: r[1] for r in changes.groupBy(self._bucket(n).alias("b")).count().collect()}

    def _wanted(self, rows: int, now: int) -> int:
        while rows > now * self.bucket_rows:
            now *= 2
        return now

    def _plan(self, changes: DataFrame, entry: dict | None, known) -> tuple[int, dict[int, int], bool]:
        """Number of buckets, those to write with their numbers of changes, and
        whether the table is laid out anew."""
        if not entry:
            fine = self.least_buckets << 10
            counts = self._touched(changes, fine)
            n, sizes = self._wanted(sum(counts.values()), self.least_buckets), {}
            if n > fine:
                return n, counts, True
            for b, c in counts.items():                      # ``n`` divides ``fine``
                sizes[b % n] = sizes.get(b % n, 0) + c
            return n, sizes, True
        n = entry["buckets"]
        grown = self._wanted(entry["rows"], n)
        touched = known[1] if known and known[0] == n else self._touched(changes, n)
        return grown, touched, grown != n

    def merge(self, changes: DataFrame, entry: dict | None, tag: str, known: tuple[int, dict[int, int]] | None = None,
              was: list[str] | None = None) -> dict:
        """Fold one batch in and return the table's new entry; nothing is
        current until a commit names it.  Changes and stored rows are laid out
        by bucket once and folded there; where a bucket has more changes than
        rows belong in one, the changes of each key are combined before that.
        ``was``: see ``changes.fold``, and ``made``."""
        ch = changes if self.schema is None else changes.select(*[f.name for f in self.schema.fields])
        n, touched, anew = self._plan(ch, entry, known)
        if entry and not touched and not anew:
            return entry
        at = lambda rows: rows.withColumn("_bucket", self._bucket(n))
        held = self._read(entry, None if anew else touched) if entry else None
        merged = CH.fold(at(ch), None if held is None else at(held), ("_bucket", *self._keys()), self._laid(n, touched, anew),
                         max(touched.values(), default=0) > self.bucket_rows, was)
        return self._write(merged, entry, tag, n, anew)

    def add(self, added: DataFrame, entry: dict | None, tag: str, combine, known: tuple[int, dict[int, int]] | None = None) -> dict:
        """Add rows to a table of sums and return its new entry.  ``combine``
        gets the added rows and the stored rows of the touched buckets
        (``_held``), laid out by ``_bucket``, and gives the buckets' new rows."""
        n, touched, anew = self._plan(added, entry, known)
        if entry and not touched and not anew:
            return entry
        rows = added.withColumn("_held", F.lit(False))
        if entry:
            live = self._read(entry, None if anew else touched).where(~F.col("_deleted"))
            rows = rows.unionByName(live.withColumn("_held", F.lit(True)).select(
                "_held", *[c for c in live.columns if c in added.columns]), allowMissingColumns=True)
        laid = self._laid(n, touched, anew)(rows.withColumn("_bucket", self._bucket(n)))
        return self._write(combine(laid), entry, tag, n, anew)

    def made(self, tag: str, entry: dict | None, more: str = "") -> DataFrame | None:
        """The rows that an attempt wrote, with what ``was`` added to them; None if it wrote none."""
        out = f"clean/{self.name}/{tag}"
        if not entry or not any(p.startswith(f"{out}/") for p in entry["paths"].values()):
            return None
        return self.spark.read.schema(StructType(self.schema.fields + StructType.fromDDL(more).fields) if more else self.schema) \
            .parquet(f"{self.root}/{out}").drop("_bucket")

    def _laid(self, n: int, touched, anew: bool):
        # a bucket lies in one task, so in one file: buckets are of bounded size, as their number follows the table's
        tasks = 2 * (n if anew else len(touched))
        return lambda rows: rows.repartition(tasks, "_bucket")

    def _write(self, merged: DataFrame, entry: dict | None, tag: str, n: int, anew: bool) -> dict:
        out = f"clean/{self.name}/{tag}"
        merged.write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.root}/{out}")
        # the row count of what was written, by bucket (at most ``n`` rows)
        wrote = self.spark.read.schema(f"{self.key} string, _bucket int").parquet(f"{self.root}/{out}")
        sizes = {r[0]: r[1] for r in wrote.groupBy("_bucket").count().collect()}
        self.written_buckets.append(len(sizes))
        kept = {} if anew else {b: d for b, d in entry["paths"].items() if int(b) not in sizes}
        counts = {b: c for b, c in (entry or {}).get("counts", {}).items() if b in kept} | {str(b): c for b, c in sizes.items()}
        paths = kept | {str(b): f"{out}/_bucket={b}" for b in sizes}
        return {"buckets": n, "rows": sum(counts.values()), "counts": counts, "paths": paths}
