"""Structured Streaming wiring.

``readStream`` of a Kafka-shaped change feed -> ``foreachBatch`` that, per
micro-batch:

1. drops messages delivered twice or handled by an earlier batch (T2; the
   ledger holds ranges of offsets, K7), parses the batch once and writes the
   parsed rows, which feed every later step,
2. writes the raw audit log, the dead letters and their messages into folders
   named by the batch, overwriting what a dead attempt left there,
3. merges keyed changes into the keyed tables (``operators.store``),
4. refreshes the marts for what the batch touched, from the state that the
   batch before committed and the state it makes itself,
5. writes one commit that makes all of it current at once.

A batch that has a commit is a no-op when it comes again; one that died before
its commit starts again from the commit before it.  So the results are those
of applying every batch once, wherever an attempt dies.

Late data needs no watermark: a late event simply updates its key and its
bucket is recomputed (T4).  The checkpoint replaces the consumer offset commit.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import envelope as EV
from ..functions import scalars as SC
from ..operators import changes as CH
from ..operators import clean as C
from ..operators import incremental as IN
from ..operators import marts as M
from ..operators import objects as OB
from ..operators import offsets as OF
from ..operators import partials as PT
from ..operators.store import Commits, KeyedStore
from ..sources.feeds import FEED_SCHEMA


def read_kafka(spark: SparkSession, bootstrap: str, topics: list[str], **options) -> DataFrame:
    """Kafka source (needs the Kafka connector on the classpath).  Keys
    and values stay bytes, for the envelope's lenient decoding."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
              .option("subscribe", ",".join(topics)).option("startingOffsets", "earliest"))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select("topic", "partition", "offset", "key", "value")


def publish_kafka(messages: DataFrame, bootstrap: str, **options) -> None:
    """Write topic, key, value and headers to Kafka (needs the Kafka
    connector).  The ``position`` header identifies a message that a retried
    batch publishes again."""
    writer = messages.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("includeHeaders", "true")
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.save()


def read_feed_files(spark: SparkSession, path: str, max_files: int | None = None, schema: str = FEED_SCHEMA) -> DataFrame:
    """File replay of a feed with the Kafka columns, or of listings (tests, backfills)."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


class Pipeline:
    """What the pipelines share: commits, batch folders, readers, the ledger of
    handled offsets and the dead letters."""

    #: tables whose buckets follow another column than their key
    KEYS: dict[str, str] = {}

    def __init__(self, spark: SparkSession, root: str, batch_ts=None, group: str = "riverbed"):
        self.spark, self.root, self.group = spark, root.rstrip("/"), group
        self.batch_ts = batch_ts or (lambda batch_id: None)
        self.commits = Commits(spark, self.root)
        self.stores: dict[str, KeyedStore] = {}
        #: Called with a step's name after each write; tests end an attempt there.
        self.after = lambda step: None

    def store(self, name: str, schema=None) -> KeyedStore:
        if name not in self.stores or (schema is not None and self.stores[name].schema is None):
            schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
            self.stores[name] = KeyedStore(self.spark, self.root, name, schema, key=self.KEYS.get(name, "pk"))
        return self.stores[name]

    def state(self, name: str) -> DataFrame:
        """The committed rows of a table, delete markers included."""
        return self.store(name).state(self.commits.latest()["tables"].get(name))

    def read_mart(self, name: str, commit: dict | None = None) -> DataFrame | None:
        path = (commit or self.commits.latest())["marts"].get(name)
        return self.spark.read.parquet(f"{self.root}/{path}") if path else None

    def read_log(self, name: str) -> DataFrame:
        """An append-only table's rows of committed batches."""
        return self.spark.read.parquet(f"{self.root}/{name}").where(F.col("batch_id") <= self.commits.latest()["batch"])

    def process(self, batch: DataFrame, batch_id: int) -> None:
        before = self.commits.latest()
        if batch_id <= before["batch"]:
            return                                          # committed already
        tag = f"b{batch_id:010d}-{uuid.uuid4().hex[:8]}"
        self.commits.fs.drop_matching(f"{self.root}/_work", f"b{batch_id:010d}-")      # what a dead attempt left
        doc = {"batch": batch_id, "tables": dict(before["tables"]), "marts": dict(before["marts"])}
        feed = self._intake(batch, batch_id, tag, doc)
        self._process(feed, batch_id, tag, before, doc)
        self.commits.write(doc)
        self.commits.fs.drop(f"{self.root}/_work/{tag}")

    def _intake(self, batch: DataFrame, batch_id: int, tag: str, doc: dict) -> DataFrame:
        """The batch's messages that no batch handled before, each once (T2),
        as a written table; the ledger takes their positions in (K7)."""
        feed = self._parsed(self._arrived(batch), "feed", tag)
        # the positions alone tell whether anything came twice: the messages move only then
        at, ranges = self._parsed(OF.positions(feed), "positions", tag), self.read_mart("offset_ranges", doc)
        if at.where("times > 1").take(1):
            feed = self._parsed(CH.dedupe_deliveries(feed), "feed-once", tag)
        known = None if ranges is None else OF.handled(at, ranges)
        again = known is not None and bool(known.take(1))
        inside = self._parsed(OF.inside_blocks(ranges, at), "ranges", tag)
        self._mart("offset_ranges", OF.across_blocks(inside), tag, doc)
        return feed.join(known, CH.WHERE, "left_anti").select(*feed.columns) if again else feed

    def _arrived(self, batch: DataFrame) -> DataFrame:
        """A batch's messages as they are written for all later steps."""
        return batch

    def handled_offsets(self) -> DataFrame:
        """K7: topic, partition, first, last of every run of handled offsets."""
        return self.read_mart("offset_ranges")

    def _dead(self, dead: DataFrame, batch_id: int) -> None:
        """The failed events as a table, and as messages of the
        dead-letter topic.  Both sinks are folders of the batch, overwritten by
        its next attempt, and every message names its batch and position, so a
        letter is published once however often a batch is tried."""
        self._log("ops/failed_events", dead, batch_id)
        failed = self.spark.read.schema(dead.schema).parquet(f"{self.root}/ops/failed_events/batch_id={batch_id}")
        self._log("dlq", CH.dlq_messages(failed, batch_id), batch_id)

    def dead_letter_topic(self) -> DataFrame:
        """Topic, key, value and headers of the letters of committed batches."""
        return self.read_log("dlq").drop("batch_id")

    def _process(self, feed, batch_id, tag, before, doc) -> None:
        raise NotImplementedError

    def _log(self, name: str, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/batch_id={batch_id}")
        self.after(name)

    def _parsed(self, rows: DataFrame, name: str, tag: str) -> DataFrame:
        """The batch's parsed rows as a written table (JSON is parsed once)."""
        path = f"{self.root}/_work/{tag}/{name}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _merge(self, name: str, changes: DataFrame, tag: str, doc: dict, known=None, was=None) -> dict | None:
        """Merge into a table; returns its entry before the batch."""
        old = doc["tables"].get(name)
        entry = self.store(name, changes.schema).merge(changes, old, tag, known, was)
        if entry["paths"]:
            doc["tables"][name] = entry
        self.after(f"merge {name}")
        return old

    def _add(self, name: str, added: DataFrame, tag: str, doc: dict, combine, known=None) -> None:
        """Add to a table of sums."""
        entry = self.store(name).add(added, doc["tables"].get(name), tag, combine, known)
        if entry["paths"]:
            doc["tables"][name] = entry
        self.after(f"merge {name}")

    def _mart(self, name: str, rows: DataFrame, tag: str, doc: dict) -> None:
        path = f"mart/{name}/{tag}"
        rows.write.mode("overwrite").parquet(f"{self.root}/{path}")
        doc["marts"][name] = path
        self.after(f"mart {name}")

    def start(self, stream: DataFrame, checkpoint: str, available_now: bool = True,
              interval: str | None = None):
        """Run-once (``availableNow``) or interval polling."""
        w = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval or "1 second")
        return w.start()


class RelationalPipeline(Pipeline):
    """Raw / clean / mart maintenance for the relational feed.  The marts follow
    from partial states by customer (``operators.partials``): a batch reads the
    buckets of its own orders and customers in every table, whatever the size
    of the rest."""

    KEYS = {"order_days": "owner", "order_moments": "cell"}

    def _process(self, feed, batch_id, tag, before, doc) -> None:
        parsed = {t: self._parsed(CH.slim(CH.parse_relational(feed, spec), ["before", "after"]), t, tag) for t, spec in CH.RELATIONAL.items()}
        logs = [CH.audit_log(p) for p in parsed.values()], [
            CH.dead_letters(p, failed_at=self.batch_ts(batch_id), consumer_group=self.group) for p in parsed.values()]
        self._log("raw/cdc_events", logs[0][0].unionByName(logs[0][1]), batch_id)
        self._dead(logs[1][0].unionByName(logs[1][1]), batch_id)
        changes = {t: CH.keyed_changes(parsed[t], spec) for t, spec in CH.RELATIONAL.items()}
        old = {t: before["tables"].get(t) for t in changes}
        for t in changes:
            self.store(t, changes[t].schema)
        self._merge("customers", changes["customers"], tag, doc)
        self._merge("orders", changes["orders"], tag, doc, was=PT.IMAGE)
        new = {t: doc["tables"].get(t) for t in changes}

        def images(table: str, entry: dict | None, keys: DataFrame, known) -> DataFrame:
            return CH.current(self.store(table).near(entry, keys, known), CH.RELATIONAL[table])

        # what the changed orders take out of the marts and put in: the merge wrote their images of before beside the new ones
        delta = self._parsed(PT.changed(*self._order_images(tag, new["orders"])), "delta", tag)
        for name, schema in PT.SCHEMAS.items():
            self.store(name, schema)
        owned = delta.where(F.col("owner").isNotNull())
        days, was_d = self.store("order_days"), before["tables"].get("order_days")
        owners = owned.select("owner").distinct()
        self._add("order_moments", PT.moments_added(delta), tag, doc, lambda laid: PT.moment_rows(laid, batch_id))
        moments = self.store("order_moments").made(tag, doc["tables"].get("order_moments"))
        if moments is not None:
            added, left = PT.days_added(delta), PT.last_moments(_live(moments))
            at_d = days.touched(was_d, owned)
            if at_d:
                left = days.within(left, at_d)
            self._add("order_days", added.unionByName(left), tag, doc, lambda laid: PT.day_rows(laid, batch_id), at_d)
        now_d = doc["tables"].get("order_days")

        # the customers who changed, or own a changed order, and their days
        moved = changes["customers"].select(F.col("pk").cast("bigint").alias("owner")).where(F.col("owner").isNotNull()).distinct()
        touched = self._parsed(owners.unionByName(moved).distinct().withColumn("pk", F.col("owner").cast("string")), "touched", tag)
        at_c, at_t = self.store("customers").touched(old["customers"], touched), days.touched(now_d, touched)
        was, now = (images("customers", e["customers"], touched, at_c) for e in (old, new))
        rev, summary = (self.read_mart(n, before) for n in ("daily_revenue", "customer_summary"))
        if rev is None:
            none = {t: CH.current(self.store(t).state(None), CH.RELATIONAL[t]) for t in changes}
            rev, summary = M.daily_revenue(none["orders"], none["customers"]), M.customer_summary(none["customers"], none["orders"])
        both = [_live(days.near(e, moved, at_t)) for e in (was_d, now_d)]
        self._mart("daily_revenue", PT.revenue_refresh(rev, delta, *both, was, now, moved), tag, doc)
        self._mart("customer_summary", PT.customer_refresh(summary, _live(days.near(now_d, touched, at_t)), now, touched), tag, doc)

    def _order_images(self, tag: str, entry: dict | None) -> tuple[DataFrame, DataFrame]:
        """The live images, before and after, of the orders that the batch changed."""
        store = self.store("orders")
        made = store.made(tag, entry, "_fresh boolean, _was struct<" + ", ".join(
            f"{c}: {store.schema[c].dataType.simpleString()}" for c in PT.IMAGE) + ">")
        if made is None:
            return (self.spark.createDataFrame([], store.schema).select(*PT.IMAGE),) * 2
        made = made.where("_fresh")
        return made.where(F.col("_was").isNotNull()).select("_was.*"), _live(made).select(*PT.IMAGE)


def _live(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("_deleted"))


class DocumentPipeline(Pipeline):
    """Raw / clean / mart maintenance for the document feeds (C2, K4-K7, P8,
    Q14, M4-M6): a state per collection that keeps each document as it came
    beside its cleaned fields; duplicate business keys are checked against it;
    the review, engagement and country marts are refreshed for the keys in the
    old or new image of every changed document."""

    def __init__(self, spark: SparkSession, root: str, collections: list[str] | None = None, **kw):
        super().__init__(spark, root, **kw)
        self.collections = collections or ["product_reviews"]

    def clean(self, collection: str) -> DataFrame:
        return self.state(collection).where(~F.col("_deleted"))

    def raw(self, collection: str) -> DataFrame:
        return CH.raw_documents(self.state(collection))

    def _arrived(self, batch: DataFrame) -> DataFrame:
        """With the collection of each message, so that a message of several
        collections' feed is parsed for its own one only."""
        return CH.with_collection(batch) if len(self.collections) > 1 else batch

    def _process(self, feed, batch_id, tag, before, doc) -> None:
        dead, touched, old = [], {}, {}
        for name in self.collections:
            mine = feed.where(F.col("_collection") == name) if "_collection" in feed.columns else feed
            parsed = self._parsed(CH.parse_documents(mine, name), name, tag)
            # a state table's schema is that of the changes
            store = self.store(name, CH.document_changes(parsed, CH.DOC_COLUMNS[name]).schema)
            prior = store.state(before["tables"][name]) if name in before["tables"] else None
            checked = CH.reject_duplicate_keys(parsed, name, prior)
            if checked is not parsed:                       # some keys are contended: the rows are written anew with what is rejected
                checked = self._parsed(CH.slim(checked, ["_doc"]), f"{name}-checked", tag)
            dead.append(CH.dead_letters(checked, failed_at=self.batch_ts(batch_id), consumer_group=self.group))
            changes = CH.document_changes(checked, CH.DOC_COLUMNS[name], self.batch_ts(batch_id))
            old[name] = self._merge(name, changes, tag, doc)
            touched[name] = changes.select("pk").distinct()
        log = dead[0]
        for d in dead[1:]:
            log = log.unionByName(d)
        self._dead(log, batch_id)
        self._marts(touched, old, before, tag, doc)

    def _marts(self, touched, old, before, tag, doc) -> None:
        def live(name: str, entry: dict | None) -> DataFrame:
            return self.store(name).state(entry).where(~F.col("_deleted"))

        new = {n: live(n, doc["tables"].get(n)) for n in self.collections}
        # images of the changed documents before and after, from their buckets only
        images = {n: [self.store(n).near(e, touched[n]).where(~F.col("_deleted"))
                      for e in (old[n], doc["tables"].get(n))] for n in self.collections}

        def refresh(mart: str, key: str, sources: list[str], full) -> None:
            was = self.read_mart(mart, before)
            if was is None:
                self._mart(mart, full(*[new[n] for n in sources]), tag, doc)
                return
            keys = IN.affected_keys([i for n in sources for i in images[n]], key)
            self._mart(mart, IN.replace_keys(was, full(*[new[n].join(keys, key, "left_semi") for n in sources]), keys, key), tag, doc)

        if "product_reviews" in self.collections:
            refresh("product_review_summary", "product_id", ["product_reviews"], M.product_review_summary)
        if {"customer_profiles", "click_events", "product_reviews"} <= set(self.collections):
            refresh("customer_engagement_summary", "customer_id",
                    ["customer_profiles", "click_events", "product_reviews"], M.customer_engagement_summary)
        if "customer_profiles" in self.collections:
            refresh("country_profile_summary", "country", ["customer_profiles"], M.country_profile_summary)


# Object events are flat JSON with fixed keys (D6): parsed with a fixed schema.
OBJECT_EVENT_SCHEMA = ("event_id string, event_type string, event_time string, source_type string, "
                       "object_id string, source_bucket string, object_key string, file_name string, "
                       "extension string, media_type string, content_type string, size_bytes string, "
                       "etag string, last_modified string")


class ObjectPipeline(Pipeline):
    """Object events -> raw events by ``event_id`` and validated clean metadata
    by ``object_id`` -> object marts rebuilt once per micro-batch (S3, E1, K6,
    K13, M5, A8-A10).  Events carry no commit time: they apply in the order of
    batches, then of positions."""

    def _process(self, feed, batch_id, tag, before, doc) -> None:
        text = {c: EV.decode_text(feed, c) for c in ("key", "value")}
        ev = feed.select("topic", "partition", "offset", text["key"].alias("key_text"), text["value"].alias("value_text"))
        ev = ev.where(F.col("value_text").isNotNull()).withColumn("e", F.from_json("value_text", OBJECT_EVENT_SCHEMA))
        flat = ev.select("topic", "partition", "offset", "key_text", "value_text",
                         (F.try_parse_json("value_text").isNull() | ~F.ltrim("value_text").startswith("{")).alias("_bad"), "e.*")
        ts = self.batch_ts(batch_id)
        cleaned = C.clean_object_events(flat, ts, keep=["key_text", "value_text", "_bad"])
        cleaned = self._parsed(cleaned.withColumn("_error", F.when(F.col("_bad"), F.lit(C.ERR_BAD_JSON)).otherwise(F.col("_error"))),
                               "objects", tag)
        self._dead(CH.dead_letters(cleaned, failed_at=ts, consumer_group=self.group), batch_id)
        good = cleaned.where(F.col("_error").isNull())
        order = CH.position(F.lit(None)).alias("_pos"), CH.no_past().alias("_past")
        raw = good.select(F.col("event_id").alias("pk"), *order, F.lit(False).alias("_deleted"), F.lit("u").alias("_op"),
                          "topic", "partition", "offset", F.col("value_text").alias("event"))
        self._merge("raw_events", raw, tag, doc)
        meta_cols = [c for c in good.columns if c not in
                     ("topic", "partition", "offset", "key_text", "value_text", "_bad", "_error")]
        changes = good.select(F.col("object_id").alias("pk"), *order, F.lit(False).alias("_deleted"), F.lit("u").alias("_op"), *meta_cols)
        self._merge("object_metadata", changes, tag, doc)
        meta = self.store("object_metadata").state(doc["tables"].get("object_metadata")).where(~F.col("_deleted"))
        for name, fn in (("object_summary_by_type", M.object_summary_by_type),
                         ("object_summary_by_day", M.object_summary_by_day),
                         ("object_storage_summary", M.object_storage_summary)):
            self._mart(name, fn(meta), tag, doc)


LISTING_SCHEMA = "scan bigint, bucket string, object_key string, size_bytes bigint, etag string, content_type string, last_modified timestamp"


class ListingPipeline(Pipeline):
    """T6/J7 as a stream: scans of object listings in, changed objects out.

    A keyed table holds the last fingerprint of every object ever seen, so the
    detector goes on after a restart where it was, and an object that was away
    for some scans and comes back as it was is no change.  A scan that comes
    again is passed over.  Several scans may share a batch.  Only the buckets
    of changed objects are rewritten.
    """

    def _intake(self, batch: DataFrame, batch_id: int, tag: str, doc: dict) -> DataFrame:
        seen = batch.dropDuplicates(["scan", "bucket", "object_key"]).withColumns(
            {"pk": SC.stable_hash("bucket", "object_key"), "fingerprint": OB.fingerprint()})
        return self._parsed(seen, "listing", tag)

    def _process(self, feed, batch_id, tag, before, doc) -> None:
        pos = F.struct(F.lit(None).cast("bigint").alias("clock"), F.lit("listing").alias("topic"), F.lit(0).alias("partition"),
                       F.col("scan").alias("offset")).alias("_pos")
        last = [F.col("pk"), pos, CH.no_past().alias("_past"), F.lit(False).alias("_deleted"), F.lit("u").alias("_op"), F.col("fingerprint")]
        store = self.store("object_seen", feed.select(*last).schema)
        held = store.near(before["tables"].get("object_seen"), feed).select(
            "pk", F.col("_pos.offset").alias("scan"), "fingerprint", F.lit(True).alias("held"))
        per = Window.partitionBy("pk").orderBy("scan", F.desc("held"))
        rows = feed.select("pk", "scan", "fingerprint", F.lit(False).alias("held")).unionByName(held)
        rows = (rows.withColumns({"_was": F.lag("fingerprint").over(per), "_upto": F.max(F.when(F.col("held"), F.col("scan"))).over(
            Window.partitionBy("pk"))})
            .where(~F.col("held") & (F.col("_upto").isNull() | (F.col("scan") > F.col("_upto")))
                   & ~F.col("_was").eqNullSafe(F.col("fingerprint"))))
        kind = F.when(F.col("_was").isNull(), "new").otherwise("changed").alias("change_kind")
        changed = self._parsed(feed.join(rows.select("pk", "scan", kind), ["pk", "scan"]), "changed", tag)
        self._log("ops/object_changes", changed.drop("pk"), batch_id)
        self._merge("object_seen", changed.select(*last), tag, doc)

    def changes(self) -> DataFrame:
        """Every object that was new or changed in a scan, with ``change_kind``."""
        return self.read_log("ops/object_changes").drop("batch_id")

    def messages(self) -> DataFrame:
        """The changes as object events for the topic of object events."""
        return OB.event_messages(OB.object_events(self.changes()))
