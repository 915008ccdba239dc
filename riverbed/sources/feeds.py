"""Change feeds (S1-S4) with Kafka's row shape.

Production reads use ``spark.readStream.format("kafka")`` (or any source with
the columns ``topic, partition, offset, key, value``); see
``riverbed.streaming.streams``.  For tests and the query catalogue the same
rows are derived from the given tables: a snapshot (``op='r'``) of every
source row followed by updates and deletes, plus malformed messages,
tombstones and poison rows that must be dead-lettered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import documents as D
from . import fixtures as FX

FEED_SCHEMA = "topic string, partition int, offset bigint, key string, value string"
PREFIX = "shop"
N_PARTITIONS = 4
ORDERS_TOPIC = f"{PREFIX}.public.orders"
CUSTOMERS_TOPIC = f"{PREFIX}.public.customers"
REVIEWS_TOPIC = f"{PREFIX}.reviewsdb.product_reviews"

# Sequence numbers of the events generated per key (offset = key * 8 + seq).
SEQ_R, SEQ_U, SEQ_D, SEQ_TOMBSTONE, SEQ_BAD, SEQ_DUP, SEQ_DELETE = 0, 1, 2, 3, 4, 5, 6
BAD_JSON_MOD, BAD_JSON_REM = 1009, 7          # malformed messages (orders)
POISON_MOD, POISON_REM = 97, 13               # messages that no target can store (orders)
# The poison messages' members, one kind for each of the keys' classes: (op, id, quantity, unit_price, order_date).
POISON = [
    ('"u"', None, "2", '"1.00"', "9223372036854775807"),
    ('"u"', None, "2", '"1.00"', "1e30"),
    ('"u"', None, "2", '"99999999999999999999"', "0"),
    ("null", None, "2", '"1.00"', "0"),
    ('"u"', "null", "2", '"1.00"', "0"),
    ('"u"', None, "2", '"1.00"', '"not a time"'),
    ('"u"', None, "3000000000", '"1.00"', "0"),
    ('"u"', "9223372036854775808", "2", '"1.00"', "0"),
]
DUP_MOD, DUP_REM = 101, 3                     # duplicate business key (reviews)
NO_AFTER_MOD, NO_AFTER_REM = 211, 9           # document upsert without after
NO_ID_MOD, NO_ID_REM = 307, 11                # document delete without id


def _json(c: Column) -> Column:
    return F.to_json(c, {"ignoreNullFields": "false"})


def _envelope(op: str, before: Column | None, after: Column | None, ts: Column,
              wrap: Column) -> Column:
    """Debezium-style value: bare, or nested under ``payload`` where ``wrap``."""
    none = F.lit(None)
    inner = F.struct(F.lit(op).alias("op"),
                     (before if before is not None else none).alias("before"),
                     (after if after is not None else none).alias("after"),
                     ts.alias("ts_ms"))
    return F.when(wrap, _json(F.struct(F.lit(None).cast("string").alias("schema"), inner.alias("payload")))) \
        .otherwise(_json(inner))


def _event(df: DataFrame, topic: str, key: Column, seq: int, value: Column) -> DataFrame:
    return df.select(F.lit(topic).alias("topic"),
                     (key % N_PARTITIONS).cast("int").alias("partition"),
                     (key.cast("bigint") * 8 + seq).alias("offset"),
                     _json(F.struct(key.alias("id"))).alias("key"),
                     value.alias("value"))


def order_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source order with its snapshot image and its updated image."""
    o = FX.src_orders(spark, sf_dir)
    r_img = F.struct(*[F.col(c) for c in o.columns])
    u_img = F.struct(*[(F.lit("shipped ") if c == "status" else
                        (F.col("quantity") + 1).alias("quantity") if c == "quantity" else
                        (F.col("updated_at") + 3_600_000).alias("updated_at") if c == "updated_at" else
                        F.col(c)).alias(c) for c in o.columns])
    return o.select("id", r_img.alias("r_img"), u_img.alias("u_img"), "updated_at")


def _poison(k: Column, ts: Column) -> Column:
    """One of the poison messages as text, members in name order."""
    kind = F.floor(k / POISON_MOD) % len(POISON)
    out = F.lit(None).cast("string")
    for i, (op, own_id, qty, price, date) in enumerate(POISON):
        text = F.concat(F.lit('{"after":{"customer_id":1,"id":'), F.lit(own_id) if own_id else k.cast("string"),
                        F.lit(f',"order_date":{date},"quantity":{qty},"unit_price":{price}' + '},"op":' + op + ',"ts_ms":'),
                        ts.cast("string"), F.lit("}"))
        out = F.when(kind == i, text).otherwise(out)
    return out


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """r for every order, u for id % 3 == 0, d (+ tombstone) for id % 9 == 0,
    a malformed message for id % 1009 == 7 and a poison one for id % 97 == 13."""
    o = order_images(spark, sf_dir)
    k = F.col("id")
    wrap = k % 2 == 1
    ts = F.col("updated_at")
    parts = [
        _event(o, ORDERS_TOPIC, k, SEQ_R, _envelope("r", None, F.col("r_img"), ts, wrap)),
        _event(o.where(k % 3 == 0), ORDERS_TOPIC, k, SEQ_U,
               _envelope("u", F.col("r_img"), F.col("u_img"), ts + 1, wrap)),
        _event(o.where(k % 9 == 0), ORDERS_TOPIC, k, SEQ_D,
               _envelope("d", F.col("u_img"), None, ts + 2, wrap)),
        _event(o.where(k % 9 == 0), ORDERS_TOPIC, k, SEQ_TOMBSTONE, F.lit(None).cast("string")),
        _event(o.where(k % POISON_MOD == POISON_REM), ORDERS_TOPIC, k, SEQ_DUP, _poison(k, ts + 3)),
        _event(o.where(k % BAD_JSON_MOD == BAD_JSON_REM), ORDERS_TOPIC, k, SEQ_BAD,
               F.concat(F.lit('{"op": "u", "after": {"id": '), k.cast("string"), F.lit(", "))),
    ]
    return reduce(DataFrame.unionByName, parts)


def order_deletes(orders: DataFrame) -> DataFrame:
    """A delete of each of the source orders, later than all their events."""
    img = F.struct(*[F.col(c) for c in ("id", "customer_id", "order_date")])
    return _event(orders, ORDERS_TOPIC, F.col("id"), SEQ_DELETE, _envelope("d", img, None, F.col("updated_at"), F.lit(False)))


def customers_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """r for every customer, u (country moved) for id % 5 == 0."""
    c = FX.src_customers(spark, sf_dir)
    k = F.col("id")
    r_img = F.struct(*[F.col(x) for x in c.columns])
    new_country = F.when(k % 2 == 0, F.lit("Singapore ")).otherwise(F.lit(" usa"))
    u_img = F.struct(*[(new_country if x == "country" else F.col(x)).alias(x) for x in c.columns])
    wrap = k % 2 == 0
    ts = F.col("updated_at")
    return _event(c, CUSTOMERS_TOPIC, k, SEQ_R, _envelope("r", None, r_img, ts, wrap)).unionByName(
        _event(c.where(k % 5 == 0), CUSTOMERS_TOPIC, k, SEQ_U, _envelope("u", r_img, u_img, ts + 1, wrap)))


def relational_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers_feed(spark, sf_dir).unionByName(orders_feed(spark, sf_dir))


# ------------------------------------------------------------------ documents
def _doc_value(op: str, after_text: Column | None, ts: Column, collection: str) -> Column:
    return _json(F.struct(
        F.lit(op).alias("op"),
        (after_text if after_text is not None else F.lit(None).cast("string")).alias("after"),
        F.struct(F.lit("reviewsdb").alias("db"), F.lit(collection).alias("collection")).alias("source"),
        ts.alias("ts_ms")))


def _doc_key(oid: Column) -> Column:
    return _json(F.struct(_json(F.struct(oid.alias("$oid"))).alias("id")))


def reviews_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document change feed for product reviews (Extended-JSON ``after``
    text, key ``{"id": "{\\"$oid\\": ...}"}``): r for all, u for k % 4 == 0,
    d for k % 10 == 0, plus a duplicate business key, an upsert without
    ``after`` and a delete without id."""
    src = FX.src_reviews(spark, sf_dir).withColumn("k", F.col("review_id").cast("bigint"))
    k = F.col("k")
    upd = src.withColumn("rating", F.col("rating") + 1).withColumn("status", F.lit(" approved "))
    docs = src.select("*", D.review_json(src).alias("r_after"),
                      D.review_json(src, _id=FX._oid(k, "f")).alias("dup_after"))
    upd = upd.select("*", D.review_json(upd).alias("u_after"))
    r_after, u_after, dup_after = F.col("r_after"), F.col("u_after"), F.col("dup_after")
    dup = docs.withColumn("_id", FX._oid(k, "f"))
    oid = F.col("_id")
    ts = F.lit(FX.EPOCH_2024_MS) + k

    def ev(df, seq, value, key=None):
        return df.select(F.lit(REVIEWS_TOPIC).alias("topic"), (k % N_PARTITIONS).cast("int").alias("partition"),
                         (k * 8 + seq).alias("offset"),
                         (key if key is not None else _doc_key(oid)).alias("key"), value.alias("value"))
    parts = [
        ev(docs, SEQ_R, _doc_value("r", r_after, ts, "product_reviews")),
        ev(upd.where(k % 4 == 0), SEQ_U, _doc_value("u", u_after, ts + 1, "product_reviews")),
        ev(docs.where(k % 10 == 0), SEQ_D, _doc_value("d", None, ts + 2, "product_reviews")),
        ev(dup.where(k % DUP_MOD == DUP_REM), SEQ_DUP, _doc_value("c", dup_after, ts + 5, "product_reviews")),
        ev(docs.where(k % NO_AFTER_MOD == NO_AFTER_REM), SEQ_BAD, _doc_value("u", None, ts + 4, "product_reviews")),
        ev(docs.where(k % NO_ID_MOD == NO_ID_REM), SEQ_TOMBSTONE,
           _doc_value("d", None, ts + 3, "product_reviews"), key=F.lit(None).cast("string")),
    ]
    return reduce(DataFrame.unionByName, parts)


PROFILES_TOPIC = f"{PREFIX}.reviewsdb.customer_profiles"
CLICKS_TOPIC = f"{PREFIX}.reviewsdb.click_events"


def _document_events(src: DataFrame, upd: DataFrame, render, topic: str, collection: str) -> DataFrame:
    """r for every document, u for k % 4 == 0 and d for k % 10 == 0."""
    k, ts = F.col("k"), F.lit(FX.EPOCH_2024_MS) + F.col("k")

    def ev(df, seq, op, body, at):
        return df.select(F.lit(topic).alias("topic"), (k % N_PARTITIONS).cast("int").alias("partition"), (k * 8 + seq).alias("offset"),
                         _doc_key(F.col("_id")).alias("key"), _doc_value(op, body, at, collection).alias("value"))

    return reduce(DataFrame.unionByName, [
        ev(src.withColumn("body", render(src)), SEQ_R, "r", F.col("body"), ts),
        ev(upd.withColumn("body", render(upd)).where(k % 4 == 0), SEQ_U, "u", F.col("body"), ts + 1),
        ev(src.where(k % 10 == 0), SEQ_D, "d", None, ts + 2)])


def profiles_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile documents; an update moves them to Japan and to gold."""
    src = FX.src_profiles(spark, sf_dir).withColumn("k", F.col("customer_id"))
    upd = src.withColumn("country", F.lit("Japan ")).withColumn("tier", F.lit("gold"))
    return _document_events(src, upd, D.profile_json, PROFILES_TOPIC, "customer_profiles")


def clicks_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click documents; an update makes them purchases."""
    src = FX.src_clicks(spark, sf_dir).withColumn("k", F.col("event_id").cast("bigint"))
    upd = src.withColumn("event_type", F.lit(" purchase"))
    return _document_events(src, upd, D.click_json, CLICKS_TOPIC, "click_events")


def key_release_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews A and B of each order that take turns at a business key, in
    positions of one partition; by order key modulo 3:

    0: A claims, A moves to another key, B claims (free again),
    1: A claims, B claims (held), A is deleted, B claims (free again),
    2: A claims, B claims a key of its own, B moves to A's (held, B stays
       where it is), a third, C, claims B's (held).
    """
    src = FX.src_reviews(spark, sf_dir).withColumn("k", F.col("review_id").cast("bigint"))
    k, topic = F.col("k"), REVIEWS_TOPIC
    own, other = F.col("review_id"), F.concat(F.col("review_id"), F.lit("-2"))
    steps = {0: [("c", "a", own), ("u", "a", other), ("c", "b", own)],
             1: [("c", "a", own), ("c", "b", own), ("d", "a", None), ("c", "b", own)],
             2: [("c", "a", own), ("c", "b", other), ("u", "b", own), ("c", "c", other)]}
    parts = []
    for case, events in steps.items():
        for seq, (op, who, key) in enumerate(events):
            oid = F.concat(F.lit(who), F.lpad(F.lower(F.hex(k)), 23, "0"))
            body = None if key is None else _json(F.struct(F.struct(oid.alias("$oid")).alias("_id"), key.alias("review_id")))
            parts.append(src.where(k % 3 == case).select(
                F.lit(topic).alias("topic"), (k % N_PARTITIONS).cast("int").alias("partition"), (k * 8 + seq).alias("offset"),
                _doc_key(oid).alias("key"),
                _doc_value(op, body, F.lit(FX.EPOCH_2024_MS) + k * 8 + seq, "product_reviews").alias("value")))
    return reduce(DataFrame.unionByName, parts)


def key_chain_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews in chains of up to 1,024 order keys: each claims the key of its
    own place, then the next place's; in even chains the last one moves first,
    in odd ones the first.  A chain lies in one partition."""
    src = FX.src_reviews(spark, sf_dir).withColumn("k", F.col("review_id").cast("bigint"))
    chain, pos = F.floor(F.col("k") / 1024), F.col("k") % 1024
    oid = F.concat(F.lit("c"), F.lpad(F.lower(F.hex("k")), 23, "0"))
    turn = F.when(chain % 2 == 0, 1023 - pos).otherwise(pos)

    def claims(op: str, place: Column, offset: Column) -> DataFrame:
        key = F.concat_ws("-", chain.cast("string"), place.cast("string"))
        body = _json(F.struct(F.struct(oid.alias("$oid")).alias("_id"), key.alias("review_id")))
        return src.select(F.lit(REVIEWS_TOPIC).alias("topic"), (chain % N_PARTITIONS).cast("int").alias("partition"),
                          (chain * 4096 + offset).alias("offset"), _doc_key(oid).alias("key"),
                          _doc_value(op, body, F.lit(FX.EPOCH_2024_MS), "product_reviews").alias("value"))

    return claims("c", pos, pos).unionByName(claims("u", pos + 1, 2048 + turn))
