"""Source-system rows derived from the given tables.

The reference pipeline reads customers/orders (relational), profiles/reviews/
clicks (documents) and object listings.  These builders derive rows of the
same shape -- including the messy values the cleaners must handle -- from the
driver's parquet tables, so every query grows with the data.  Modulo rules on
integer keys only *shape* values (orphans, poison rows): every input row gives
a row.  Orphans are orders, reviews and clicks whose customer key is shifted
beyond every customer, and beyond 32 bits, since ids are BIGINT throughout.

The SQL twins of these builders live in ``riverbed.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Epoch millis of 2024-01-01T00:00:00Z; base of derived customer timestamps.
EPOCH_2024_MS = 1704067200000
DAY_MS = 86_400_000
ORPHAN_SHIFT = 5_000_000_000
POISON_MOD, POISON_REM = 997, 5          # orders whose total overflows
POISON_QTY, POISON_PRICE = 2_000_000_000, "99999999.99"


def _s(c) -> Column:
    return c.cast("string")


def epoch_ms(ts_ntz: Column) -> Column:
    """Wall-clock NTZ timestamp as UTC epoch millis (what the feed carries);
    the session time zone is UTC."""
    return F.unix_millis(ts_ntz.cast("timestamp"))


# ---------------------------------------------------------------- relational
def src_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    email = (F.when(k % 11 == 0, F.lit(None).cast("string"))
             .when(k % 17 == 0, F.lit("no-at-sign"))
             .when(k % 19 == 0, F.concat(F.lit(" Two@At@"), F.col("c_name"), F.lit(".COM")))
             .otherwise(F.concat(F.lit("  "), F.upper(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
                                 F.lit("@MAIL"), _s(k % 4), F.lit(".COM "))))
    phone = F.concat(F.lit("+1 ("), _s(100 + k % 900), F.lit(") "), _s(1000 + k % 1000), F.lit("-00"))
    nk = F.col("c_nationkey") % 10
    country = (F.when(nk == 0, "vietnam").when(nk == 1, " VIETNAM ").when(nk == 2, "Viet Nam")
               .when(nk == 3, "usa").when(nk == 4, "  USA").when(nk == 5, "United States")
               .when(nk == 6, "japan").when(nk == 7, " singapore").when(nk == 8, "")
               .otherwise(F.lit(None).cast("string")))
    created = F.lit(EPOCH_2024_MS) + k * 60000
    return c.select(k.cast("bigint").alias("id"),
                    F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("full_name"),
                    email.alias("email"), phone.alias("phone"), country.alias("country"),
                    created.cast("bigint").alias("created_at"),
                    (created + 3_600_000).cast("bigint").alias("updated_at"))


def src_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    poison = k % POISON_MOD == POISON_REM
    status = (F.when(k % 6 == 0, " cancelled").when(F.col("o_orderstatus") == "O", "new")
              .when(F.col("o_orderstatus") == "F", "Delivered ").otherwise(F.lit(None).cast("string")))
    ms = epoch_ms(F.col("o_orderdate"))
    return o.select(
        k.cast("bigint").alias("id"),
        F.when(k % 53 != 0, _maybe_orphan(F.col("o_custkey"), k % 13 == 0)).alias("customer_id"),
        F.concat(F.lit(" Product "), _s(k % 10), F.lit(" ")).alias("product_name"),
        F.when(poison, F.lit(POISON_QTY)).otherwise((k % 7 - 1).cast("int")).alias("quantity"),
        F.when(poison, F.lit(POISON_PRICE))
         .otherwise(_s(F.col("o_totalprice").cast("decimal(12,2)"))).alias("unit_price"),
        status.alias("status"),
        ms.alias("order_date"),
        (ms + DAY_MS).alias("updated_at"))


def _maybe_orphan(customer: Column, orphan: Column) -> Column:
    return customer.cast("bigint") + F.when(orphan, F.lit(ORPHAN_SHIFT)).otherwise(F.lit(0))


# ------------------------------------------------------------------ documents
def _oid(k: Column, prefix: str = "0") -> Column:
    return F.lpad(F.lower(F.hex(k.cast("bigint"))), 24, prefix)


def src_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    m5 = k % 5
    status = (F.when(m5 == 0, "approved").when(m5 == 1, " PENDING").when(m5 == 2, "Rejected")
              .when(m5 == 3, "APPROVED").otherwise(F.lit(None).cast("string")))
    return o.select(
        _oid(k).alias("_id"),
        _s(k).alias("review_id"),
        _maybe_orphan(F.col("o_custkey"), k % 17 == 0).alias("customer_id"),
        ((k * 7) % 500).cast("int").alias("product_id"),
        (k % 9 - 1).cast("int").alias("rating"),
        status.alias("status"),
        F.concat(F.lit(" Title "), _s(k % 13), F.lit(" ")).alias("title"),
        F.array(F.lit(" fast "), F.lit("cheap"), F.lit(" fast"), F.lit(""), F.concat(F.lit("t"), _s(k % 3))).alias("tags"),
        epoch_ms(F.col("o_orderdate")).alias("updated_at"))


def src_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    k = F.col("event_id")
    ref = (F.when(k % 4 == 0, "direct").when(k % 4 == 1, "ads ").when(k % 4 == 2, "email")
           .otherwise(F.lit(None).cast("string")))
    page = F.when(k % 3 == 0, "home").when(k % 3 == 1, " search").otherwise("cart")
    return e.select(
        _oid(k).alias("_id"),
        _s(k).alias("event_id"),
        _maybe_orphan(F.col("user_id"), k % 19 == 0).alias("customer_id"),
        F.when(k % 41 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit(" "), F.col("event_type"))).alias("event_type"),
        (k % 500 + 1).cast("int").alias("product_id"),
        F.concat(F.lit("s"), _s(F.col("user_id"))).alias("session_id"),
        F.lit(" Mozilla/5.0 ").alias("user_agent"),
        ref.alias("referrer"), page.alias("page"),
        epoch_ms(F.col("ts")).alias("event_time"))


def src_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    n6 = F.col("c_nationkey") % 6
    country = (F.when(n6 == 0, "VN").when(n6 == 1, " vietnam ").when(n6 == 2, "us")
               .when(n6 == 3, "japan").when(n6 == 4, "France").otherwise(F.lit(None).cast("string")))
    seg = F.col("c_mktsegment")
    tier = (F.when(seg == "BUILDING", "gold").when(seg == "MACHINERY", " Silver")
            .when(seg == "HOUSEHOLD", F.lit(None).cast("string")).otherwise("bronze"))
    devices = F.when(k % 3 == 0, F.array(F.lit(" mobile "), F.lit("web"), F.lit("mobile"), F.lit(" "))) \
               .otherwise(F.array(F.lit("tablet")))
    return c.select(_oid(k).alias("_id"),
                    k.cast("bigint").alias("customer_id"),
                    F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("full_name"),
                    country.alias("country"),
                    F.when(k % 5 == 0, F.lit(" books ")).otherwise(F.lit("toys")).alias("category"),
                    (k % 2 == 0).alias("newsletter"),
                    F.when(k % 4 == 0, F.lit(" high")).otherwise(F.lit(None).cast("string")).alias("price_sensitivity"),
                    tier.alias("tier"),
                    F.floor(F.col("c_acctbal")).cast("int").alias("points"),
                    devices.alias("devices"))


# -------------------------------------------------------------------- objects
def _doc_key(k: Column) -> Column:
    ext = (F.when(k % 4 == 0, ".PNG").when(k % 4 == 1, ".mp4").when(k % 4 == 2, ".wav").otherwise(".txt"))
    return F.concat(F.col("lang"), F.lit("/"), F.col("source"), F.lit("/doc_"), _s(k), ext)


def src_object_listing(spark: SparkSession, sf_dir: str, previous: bool = False) -> DataFrame:
    """Source-bucket listing (S8): one object per document.

    ``previous=True`` gives the listing of the scan before: objects with
    ``doc_id % 17 == 0`` did not exist yet and ``doc_id % 11 == 0`` had
    another etag, so the change detector (T6) has new and changed objects.
    """
    d = read_table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    etag = F.md5(F.col("text"))
    if previous:
        d = d.where(k % 17 != 0)
        etag = F.when(k % 11 == 0, F.md5(F.concat(F.col("text"), F.lit("#v0")))).otherwise(etag)
    bucket = (F.when(k % 4 == 0, "raw-images").when(k % 4 == 1, "raw-videos")
              .when(k % 4 == 2, "raw-audio").otherwise("raw-documents"))
    return d.select(
        bucket.alias("bucket"), _doc_key(k).alias("object_key"),
        F.when(k % 37 == 0, F.lit(0).cast("bigint")).otherwise(F.col("n_chars")).alias("size_bytes"),
        etag.alias("etag"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.lit("text/plain")).alias("content_type"),
        (F.lit(EPOCH_2024_MS) + k * 1000).alias("last_modified_ms"))


def _write_objects(roots: dict[str, str]):
    def run(batches):
        import os

        import pyarrow as pa

        from .paths import filesystem, join
        for b in batches:
            for bucket, key, content in zip(*(b.column(c).to_pylist() for c in ("bucket", "object_key", "content"))):
                fs, path = filesystem(join(roots[bucket], key))
                fs.create_dir(os.path.dirname(path), recursive=True)
                with fs.open_output_stream(path) as f:
                    f.write(content)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])
    return run


def write_objects(rows: DataFrame, root: str) -> dict[str, str]:
    """Put (bucket, object_key, content) rows as files under ``root``; returns
    the buckets' folders."""
    from ..session import ship_package
    from .paths import qualified
    ship_package(rows.sparkSession)
    names = [r[0] for r in rows.select("bucket").distinct().collect()]          # a handful of buckets
    base = qualified(rows.sparkSession, root)
    roots = {n: f"{base}/{n}" for n in names}
    rows.select("bucket", "object_key", "content").mapInArrow(_write_objects(roots), "n long").agg(F.sum("n")).collect()
    return roots


def object_contents(spark: SparkSession, sf_dir: str, stale_targets: bool = False) -> DataFrame:
    """A file per document: its text in the source bucket, or, with
    ``stale_targets``, what an earlier copy left in the clean bucket: none for
    ``doc_id % 23 == 0``, other bytes of the same length for ``doc_id % 29 ==
    0``, a part for ``doc_id % 31 == 0``."""
    d = read_table(spark, sf_dir, "documents")
    k, text = F.col("doc_id"), F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    kinds = ["images", "videos", "audio", "documents"]
    bucket = F.concat(F.lit("clean-" if stale_targets else "raw-"), F.get(F.array(*map(F.lit, kinds)), (k % 4).cast("int")))
    if stale_targets:
        d = d.where(k % 23 != 0)
        text = (F.when(k % 29 == 0, F.encode(F.repeat(F.lit("x"), F.octet_length(F.coalesce("text", F.lit(""))).cast("int")), "UTF-8"))
                .when(k % 31 == 0, F.encode(F.substring(F.coalesce("text", F.lit("")), 1, 5), "UTF-8")).otherwise(text))
    return d.select(bucket.alias("bucket"), _doc_key(k).alias("object_key"), text.alias("content"))


def target_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target-bucket listing (S7): some objects missing, resized or orphaned."""
    d = read_table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    bucket = (F.when(k % 4 == 0, "clean-images").when(k % 4 == 1, "clean-videos")
              .when(k % 4 == 2, "clean-audio").otherwise("clean-documents"))
    copied = d.where(k % 23 != 0).select(
        bucket.alias("bucket"), _doc_key(k).alias("object_key"),
        F.when(k % 29 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")).alias("size_bytes"),
        F.md5(F.col("text")).alias("etag"))
    orphans = d.where(k % 31 == 0).select(
        F.lit("clean-documents").alias("bucket"),
        F.concat(F.lit("orphan/"), _s(k)).alias("object_key"),
        F.col("n_chars").alias("size_bytes"), F.md5(F.col("text")).alias("etag"))
    return copied.unionByName(orphans)
