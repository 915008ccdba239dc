"""WARC archives: records written by Spark tasks, an index of every record, and
reads of selected records by coalesced byte ranges.

Each record is a gzip member of its own, so its bytes can be read alone.  The
index (file, offset, length, url, digest and more, one row per record) comes
first: readers sort the selected rows by file and offset, join neighbours with
small gaps into ranges, and each task reads whole ranges.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverbed.llm.common import shared_fs, shared_path, ship_package, utf8, written
from riverbed.sources.paths import qualified

# fixed values: the profile of a revisit, and the date of all records here
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
_INDEX = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()),
                    ("digest", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string())])
_INDEX_DDL = "file string, offset long, length long, url string, digest string, page_id long, record_type string"


def record_id(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}')}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers: int | None) -> bytes:
    """A response record with the payload, or with ``refers`` a revisit record
    without; line breaks in a url are percent-encoded."""
    url = "".join(f"%{ord(c):02X}" if c in "\r\n" else c for c in url or "")
    revisit = refers is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page)}",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    if page is not None:
        head.append(f"X-Page-ID: {page}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers)}", f"X-Refers-To-Page-ID: {refers}"]
    data = "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    return gzip.compress(data, 5, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(WARC headers in lower case, HTTP head, payload) of a record's gzip
    member."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    body = rest[:int(fields["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    return fields, http, payload


def roles(pages: DataFrame, least: int = 1000, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """(digest, size, first): for payloads of at least ``least`` bytes that
    occur more than once, the page that is the response."""
    body = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    size = F.octet_length(body)
    return (pages.select(F.col(f"`{id_col}`").alias("page"), F.sha1(F.encode(body, "UTF-8")).alias("digest"), size.alias("size"))
            .where(F.col("size") >= least).groupBy("digest", "size")
            .agg(F.max("page").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))


def _write(folder: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = shared_fs(folder)
        out, file, at = None, "", 0
        for b in batches:
            rows = []
            for page, url, payload, digest, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2)),
                                                         b.column(3).to_pylist(), b.column(4).to_pylist()):
                if out is None or at >= most:
                    if out is not None:
                        out.close()
                    # a name of its own for each attempt: only files in the committed index count
                    file, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{file}", compression=None)
                data = record(page, url, payload, digest, first)
                out.write(data)
                rows.append((f"{folder}/{file}", at, len(data), url, digest, page, "response" if first is None else "revisit"))
                at += len(data)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 7, _INDEX)], schema=_INDEX)
        if out is not None:
            out.close()
    return run


def write_archives(pages: DataFrame, least: int = 1000, file_bytes: int = 64 << 20, id_col: str = "page_id",
                   url: str = "url", html: str = "html", folder: str | None = None) -> DataFrame:
    """Write one record per row of ``pages`` to WARC files of about
    ``file_bytes`` and return their index, itself a written table.

    Of rows with equal payloads of at least ``least`` bytes the one with the
    largest id is the response and the others revisit it; if that id occurs
    more than once, each of its rows is a response.  A null id never is
    another's response, and rows of null id whose payload no other id has are
    responses.  Null payloads are empty, a null url is an empty one; repeated
    rows get a record each; other columns are ignored.
    """
    spark = pages.sparkSession
    ship_package(spark)
    folder = qualified(spark, folder) if folder else shared_path(spark, "warc")
    fs, root = shared_fs(folder)
    fs.create_dir(root, recursive=True)
    body = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page"), F.col(f"`{url}`").cast("string").alias("url"),
                        body.alias("html"), F.sha1(F.encode(body, "UTF-8")).alias("digest"),
                        F.octet_length(body).alias("size"))
    first = roles(pages, least, id_col, html)
    # the texts cross this join's shuffle: which rows revisit others is known only by digest
    got = rows.join(first, ["digest", "size"], "left").select(
        "page", "url", "html", "digest",
        F.when(F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first")), F.col("first")).alias("first"))
    return written(got.mapInArrow(_write(folder, file_bytes), _INDEX_DDL), "warc_index")


def ranges(index: DataFrame, gap: int = 64 << 10, most: int = 4 << 20) -> DataFrame:
    """(file, start, end, records): the records of ``index`` sorted by offset,
    neighbours joined while at most ``gap`` bytes lie between them, cut every
    ``most`` bytes of a file.  A file's size bounds its rows."""
    cell = F.floor(F.col("offset") / F.lit(most))
    w = Window.partitionBy("file").orderBy("offset")
    new = (F.col("offset") - F.lag(F.col("offset") + F.col("length")).over(w) > gap) | (cell != F.lag(cell).over(w))
    runs = index.withColumn("new", F.coalesce(new.cast("int"), F.lit(1))).withColumn("run", F.sum("new").over(w))
    return runs.groupBy("file", "run").agg(
        F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("end"),
        F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("records")).drop("run")


_FOUND = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
_FOUND_DDL = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long")


def _read(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, start, end, records in zip(*(b.column(i).to_pylist() for i in range(4))):
                fs, path = shared_fs(file)
                with fs.open_input_file(path) as f:
                    data = f.read_at(end - start, start)
                rows = []
                for r in records:
                    at = r["offset"] - start
                    head, http, payload = parse(data[at:at + r["length"]])
                    digest = head["warc-payload-digest"].partition(":")[2]
                    kind = head["warc-type"]
                    size = int(http.lower().partition(b"content-length:")[2].split(b"\r\n")[0])
                    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"{file} at {r['offset']}: the payload does not match its record")
                    page, refers = head.get("x-page-id"), head.get("x-refers-to-page-id")
                    rows.append((None if page is None else int(page), head["warc-target-uri"],
                                 payload if with_payload and kind == "response" else None, size, digest, kind,
                                 None if refers is None else int(refers)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _FOUND)], schema=_FOUND)
    return run


def read_records(index: DataFrame, gap: int = 64 << 10, most: int = 4 << 20, with_payload: bool = True) -> DataFrame:
    """The records of ``index`` (all, or those selected from it), read by
    ranges: page_id, url, payload (null for revisits), payload_bytes and
    payload_digest of the full payload, record_type, refers_to.  A payload
    that does not match its digest ends the job."""
    spark = index.sparkSession
    ship_package(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ranges(index, gap, most).repartition(n, "file", "start").mapInArrow(_read(with_payload), _FOUND_DDL)
