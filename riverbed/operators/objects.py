"""Object-store pipeline: listing -> events -> clean metadata -> reconcile.

F21-F24 event projection, T6/J7 change detection, R4-R6 reconciliation (J5
full outer join).  Listings (S7/S8) are made by ``sources.listing``, copies
(K14) by ``operators.copying``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources.listing import object_inventory
from .copying import copy_plan

__all__ = ["object_inventory", "copy_plan", "object_events", "changed_objects", "fingerprint", "guess_content_type", "iso_utc",
           "latest_per_object", "reconcile", "apply_reconcile", "reconcile_metrics", "issue_samples", "event_messages"]

EVENT_TYPE = "OBJECT_CREATED_OR_UPDATED"


# MIME types by extension, for the kinds of files that buckets hold.
MIME = {
    ".avi": "video/x-msvideo", ".bin": "application/octet-stream", ".bmp": "image/bmp", ".css": "text/css",
    ".csv": "text/csv", ".doc": "application/msword", ".gif": "image/gif", ".htm": "text/html",
    ".html": "text/html", ".ico": "image/vnd.microsoft.icon", ".jpeg": "image/jpeg", ".jpg": "image/jpeg",
    ".js": "text/javascript", ".json": "application/json", ".m4a": "audio/mp4", ".md": "text/markdown",
    ".mkv": "video/x-matroska", ".mov": "video/quicktime", ".mp3": "audio/mpeg", ".mp4": "video/mp4",
    ".mpeg": "video/mpeg", ".ogg": "audio/ogg", ".pdf": "application/pdf", ".png": "image/png",
    ".ppt": "application/vnd.ms-powerpoint", ".svg": "image/svg+xml", ".tar": "application/x-tar",
    ".tif": "image/tiff", ".tiff": "image/tiff", ".txt": "text/plain", ".wav": "audio/x-wav",
    ".webm": "video/webm", ".webp": "image/webp", ".xls": "application/vnd.ms-excel", ".xml": "text/xml",
    ".zip": "application/zip",
}
# Suffixes that stand for two, and those of a compressed file, which do not count.
SUFFIX_PAIRS = {".svgz": ".svg.gz", ".tgz": ".tar.gz", ".taz": ".tar.gz", ".tz": ".tar.gz",
                ".tbz2": ".tar.bz2", ".txz": ".tar.xz"}
ENCODINGS = [".gz", ".Z", ".bz2", ".xz", ".br"]

_EXT = r"^\.*[^.].*(\.[^.]*)$"


def guess_content_type(object_key) -> F.Column:
    """MIME type by extension (exact, then lower-case), else NULL.  A
    suffix pair is written out and one compression suffix dropped first, so
    ``a.txt.gz`` is text and ``a.tgz`` a tar archive."""
    name = S.file_name(object_key if not isinstance(object_key, str) else F.col(object_key))
    both = lambda m, e: F.coalesce(F.try_element_at(m, e), F.try_element_at(m, F.lower(e)))
    table = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    ext = F.regexp_extract(name, _EXT, 1)
    pair = both(table(SUFFIX_PAIRS), ext)
    name = F.when(pair.isNotNull(), F.concat(F.substring(name, F.lit(1), F.char_length(name) - F.char_length(ext)), pair)).otherwise(name)
    ext = F.regexp_extract(name, _EXT, 1)
    name = F.when(ext.isin(ENCODINGS), F.substring(name, F.lit(1), F.char_length(name) - F.char_length(ext))).otherwise(name)
    return both(table(MIME), F.regexp_extract(name, _EXT, 1))


def iso_utc(ts) -> F.Column:
    """``datetime.isoformat()`` of a UTC timestamp (whole seconds)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")


def object_events(listing: DataFrame, event_time=None) -> DataFrame:
    """One event per listed object (``bucket, object_key, size_bytes,
    etag, content_type, last_modified``)."""
    lm_iso = iso_utc(F.col("last_modified"))
    ctype = F.coalesce(F.col("content_type"), guess_content_type(F.col("object_key")),
                       F.lit(S.DEFAULT_CONTENT_TYPE))
    name = S.file_name(F.col("object_key"))
    return listing.select(
        S.stable_hash("bucket", "object_key", "etag", "size_bytes", lm_iso).alias("event_id"),
        F.lit(EVENT_TYPE).alias("event_type"),
        (F.lit(event_time).cast("string") if event_time is not None else lm_iso).alias("event_time"),
        F.lit(S.DEFAULT_SOURCE_TYPE).alias("source_type"),
        S.stable_hash("bucket", "object_key").alias("object_id"),
        F.col("bucket").alias("source_bucket"),
        "object_key",
        name.alias("file_name"),
        S.file_extension(name).alias("extension"),
        S.media_type_for(F.col("bucket"), F.col("object_key"), ctype).alias("media_type"),
        ctype.alias("content_type"),
        "size_bytes", "etag",
        lm_iso.alias("last_modified"))


def fingerprint() -> F.Column:
    """Per-object fingerprint used by the change detector."""
    return S.stable_hash("bucket", "object_key", "etag", "size_bytes",
                         F.date_format(F.col("last_modified"), "yyyy-MM-dd HH:mm:ssxxx"))


def changed_objects(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Objects whose fingerprint is new or differs from the last scan.

    One left join on (bucket, key) -- both listings shuffle once on the key;
    no per-object state lives on the driver.  Adds ``change_kind``.
    """
    cur = current.withColumn("fingerprint", fingerprint())
    prev = previous.select("bucket", "object_key", fingerprint().alias("_prev_fp"))
    j = cur.join(prev, ["bucket", "object_key"], "left")
    return (j.where(F.col("_prev_fp").isNull() | (F.col("_prev_fp") != F.col("fingerprint")))
            .withColumn("change_kind", F.when(F.col("_prev_fp").isNull(), "new").otherwise("changed"))
            .drop("_prev_fp"))


def latest_per_object(meta: DataFrame) -> DataFrame:
    """K6: one clean row per ``object_id`` (the latest event wins).

    ``max_by`` is a partial aggregate, so a hot object id (many events for
    one object) is combined map-side instead of landing whole in one task.
    """
    order = F.struct(*[F.col(c) for c in ("ingested_at", "last_modified", "event_id") if c in meta.columns])
    cols = [c for c in meta.columns if c != "object_id"]
    return (meta.groupBy("object_id")
            .agg(F.max_by(F.struct(*cols), order).alias("_r"))
            .select("object_id", *[F.col(f"_r.{c}").alias(c) for c in cols]))


def reconcile(meta: DataFrame, inventory: DataFrame, batch_ts) -> DataFrame:
    """R4/R5 via J5: full outer join of metadata target keys with the target
    inventory.  One row per key with presence flags, new status and sizes.

    Metadata keys are de-duplicated first (Q18: two sources mapping to the
    same target key collapse to the latest); inventory keys are unique.
    """
    ts = F.lit(batch_ts).cast("timestamp")
    m = (meta.groupBy(F.col("target_bucket").alias("bucket"), F.col("target_object_key").alias("object_key"))
         .agg(F.count(F.lit(1)).alias("metadata_rows"),
              F.max_by(F.struct("size_bytes", "object_id"),
                       F.struct(F.col("ingested_at"), F.col("object_id"))).alias("_r"))
         .select("bucket", "object_key", F.col("_r.size_bytes").alias("metadata_size"),
                 F.col("_r.object_id").alias("object_id"), "metadata_rows", F.lit(True).alias("_in_meta")))
    inv = inventory.select("bucket", "object_key", F.col("size_bytes").alias("object_size"),
                           F.lit(True).alias("_in_inv"))
    j = m.join(inv, ["bucket", "object_key"], "full_outer")
    in_meta = F.coalesce("_in_meta", F.lit(False))
    in_inv = F.coalesce("_in_inv", F.lit(False))
    return j.select(
        "bucket", "object_key", "object_id",
        in_meta.alias("in_metadata"), in_inv.alias("in_inventory"),
        F.when(in_meta & in_inv, "both").when(in_meta, "metadata_only").otherwise("object_only").alias("presence"),
        F.when(in_meta & in_inv, "ACTIVE").when(in_meta, "MISSING").alias("status"),
        F.when(in_meta & ~in_inv, ts).alias("missing_detected_at"),
        F.when(in_meta, ts).alias("last_reconciled_at"),
        "metadata_size", "object_size", "metadata_rows",
        (in_meta & in_inv & ~F.col("metadata_size").eqNullSafe(F.col("object_size"))).alias("size_mismatch"))


def apply_reconcile(meta: DataFrame, recon: DataFrame) -> DataFrame:
    """Set status / missing_detected_at / last_reconciled_at on every
    metadata row from the reconcile result (joined back on the target key)."""
    r = recon.where("in_metadata").select(
        F.col("bucket").alias("target_bucket"), F.col("object_key").alias("target_object_key"),
        F.col("status").alias("_status"), "missing_detected_at", "last_reconciled_at")
    return (meta.drop("missing_detected_at", "last_reconciled_at")
            .join(r, ["target_bucket", "target_object_key"], "left")
            .withColumn("status", F.coalesce("_status", "status")).drop("_status"))


def reconcile_metrics(recon: DataFrame) -> DataFrame:
    """R6 + R10: one row of counts and the DQ score (samples: ``issue_samples``)."""
    agg = recon.agg(
        F.count_if("in_inventory").alias("target_object_count"),
        F.count_if(F.col("status") == "ACTIVE").alias("active_object_count"),
        F.count_if(F.col("status") == "MISSING").alias("missing_status_count"),
        F.coalesce(F.sum(F.when(F.col("in_metadata"), F.col("metadata_rows"))), F.lit(0)).cast("bigint").alias("clean_object_metadata_count"),
        F.count_if(F.col("presence") == "object_only").alias("missing_metadata_count"),
        F.count_if(F.col("presence") == "metadata_only").alias("missing_object_count"),
        F.count_if("size_mismatch").alias("size_mismatch_count"))
    return agg.withColumn("dq_issue_count", F.col("missing_metadata_count") + F.col("missing_object_count")
                          + F.col("size_mismatch_count"))


def issue_samples(recon: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` keys (sorted) of each issue kind, as ``bucket/key``.

    Each kind is an ``orderBy().limit(n)`` -- a distributed top-k where every
    task keeps at most n rows -- so no issue group is gathered in one task.
    """
    sample = F.concat_ws("/", "bucket", "object_key").alias("sample")
    kinds = [("missing_metadata", F.col("presence") == "object_only"),
             ("missing_object", F.col("presence") == "metadata_only"),
             ("size_mismatch", F.col("size_mismatch"))]
    parts = [recon.where(cond).select(F.lit(k).alias("issue"), sample).orderBy("sample").limit(n)
             for k, cond in kinds]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def event_messages(events: DataFrame) -> DataFrame:
    """Object events as Kafka-shaped messages -- key ``object_id``,
    value the event as JSON with sorted keys (struct fields in name order)."""
    cols = sorted(c for c in events.columns if not c.startswith("_"))
    return events.select(F.col("object_id").alias("key"),
                         F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"))
