"""Change application: validation split, audit log, current state (E1-E3,
K1-K7, K12, K13, C1-C3, P5, P6, T2, T3).

A change batch (one micro-batch, or a whole replayed feed) is parsed once,
every row gets an ``_error`` (NULL = accepted), and three outputs are cut
from it: the raw audit log, the dead letters and the per-table keyed changes.
Current state is "latest event per key by source position" -- a ``max_by``
aggregate, so a hot key is combined map-side rather than sorted in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import envelope as EV
from ..functions import variant as V
from ..session import materialize
from . import clean as C
from .groups import connected

UPSERT_OPS = ["c", "r", "u"]
META = ["topic", "partition", "offset", "key_text", "value_text", "op", "ts_ms", "before",
        "after", "table_name"]


@dataclass(frozen=True)
class TableSpec:
    """Registry entry: source table -> key, cleaner and clean columns."""
    name: str
    pk: str
    cleaner: Callable[..., DataFrame]
    columns: list[str] = field(default_factory=list)


RELATIONAL = {
    "customers": TableSpec("customers", "id", C.clean_customers, C.CUSTOMER_COLUMNS),
    "orders": TableSpec("orders", "id", C.clean_orders, C.ORDER_COLUMNS),
}


def dedupe_deliveries(feed: DataFrame) -> DataFrame:
    """At-least-once delivery -> each (topic, partition, offset) once."""
    return feed.dropDuplicates(["topic", "partition", "offset"])


def parse_relational(feed: DataFrame, spec: TableSpec) -> DataFrame:
    """P1-P6 + cleaning + E2 for one table's events.  Tombstones (P2) and
    other tables' topics (P3) are dropped; every other row stays, with
    ``_error`` NULL when the event is accepted."""
    p = EV.parse_envelope(feed)
    p = p.where(~F.col("tombstone") & (F.col("table_name") == spec.name))
    p = p.withColumn("pk", EV.relational_pk(F.col("after"), F.col("before"), F.col("key_text"), spec.pk))
    cleaned = spec.cleaner(p, image="after", keep=META + ["pk", "malformed"])
    is_upsert = F.col("op").isin(UPSERT_OPS) & F.col("after").isNotNull()
    env_err = C.first_error((F.col("malformed"), C.ERR_BAD_JSON),
                            (F.col("op").isNull(), C.ERR_NO_OP),
                            (is_upsert & F.col("pk").isNull(), C.ERR_NO_PK))
    no_key = F.when(F.col(spec.pk).isNull(), F.lit(C.ERR_INT_RANGE))        # a key that is no whole number
    return cleaned.withColumn("_error", F.coalesce(env_err, F.when(is_upsert, F.coalesce(F.col("_error"), no_key))))


#: Where a message lies: its identity.
WHERE = ["topic", "partition", "offset"]
#: The last positions in other partitions, of a key that moved.
PAST_TYPE = "array<struct<topic:string,partition:int,offset:bigint>>"


def position(clock: Column | str = "ts_ms") -> Column:
    """Where an event lies, and its source time, which counts between partitions only (``fold``)."""
    clock = F.col(clock) if isinstance(clock, str) else clock
    return F.struct(clock.cast("bigint").alias("clock"), F.col("topic").cast("string").alias("topic"),
                    F.col("partition").cast("int").alias("partition"), F.col("offset").cast("bigint").alias("offset"))


def no_past() -> Column:
    return F.lit(None).cast(PAST_TYPE)


DLQ_TOPIC = "cdc.dlq"


def dead_letters(parsed: DataFrame, dlq_topic: str = DLQ_TOPIC, retry_count: int = 0,
                 failed_at=None, consumer_group: str | None = None) -> DataFrame:
    """The failed-event rows (source position, key, value, reason).
    ``failed_at`` is the batch time, passed in; without one it is the time the
    source gave the event, so that "latest" is defined."""
    ts = F.lit(failed_at).cast("timestamp") if failed_at is not None else F.timestamp_millis(
        F.when(F.col("ts_ms").between(V.MS_MIN, V.MS_MAX), F.col("ts_ms"))) if "ts_ms" in parsed.columns else F.lit(None).cast("timestamp")
    return parsed.where(F.col("_error").isNotNull()).select(
        F.col("topic").alias("source_topic"), F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"), F.col("key_text").alias("message_key"),
        EV.lenient_json(F.col("value_text")).cast("string").alias("message_value"),
        F.col("_error").alias("error_message"), F.lit(retry_count).alias("retry_count"),
        F.lit(dlq_topic).alias("dlq_topic"), ts.alias("failed_at"),
        F.lit(consumer_group).cast("string").alias("consumer_group"))


def audit_log(parsed: DataFrame) -> DataFrame:
    """K1: every accepted event as-is (images as JSON text, pk as text)."""
    return parsed.where(F.col("_error").isNull()).select(
        F.col("table_name").alias("source_table"), "op", "ts_ms", "pk",
        F.to_json(F.col("before")).alias("before_data"), F.to_json(F.col("after")).alias("after_data"),
        F.col("topic").alias("source_topic"), F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"))


def slim(parsed: DataFrame, images: list[str]) -> DataFrame:
    """Parsed rows as they are kept for the later steps of a batch: a rejected
    event needs its texts, an accepted one its ``images``, none needs both."""
    good = F.col("_error").isNull()
    return parsed.withColumns({c: F.when(~good, F.col(c)) for c in ("key_text", "value_text")} | {c: F.when(good, F.col(c)) for c in images})


def keyed_changes(parsed: DataFrame, spec: TableSpec, pos: Column | None = None) -> DataFrame:
    """P5: accepted upserts (with an image) and deletes (with a key) as
    ``pk, _pos, _past, _deleted, _op`` + clean columns; other ops only reach raw."""
    acc = parsed.where(F.col("_error").isNull())
    upsert = F.col("op").isin(UPSERT_OPS) & F.col("after").isNotNull()
    delete = (F.col("op") == "d") & F.col("pk").isNotNull()
    # one text per key, however a message spells the number: the column is one
    key = F.coalesce(F.col("pk").try_cast("bigint").cast("string"), F.col("pk")).alias("pk")
    return acc.where(upsert | delete).select(
        key, (position() if pos is None else pos).alias("_pos"), no_past().alias("_past"),
        (F.col("op") == "d").alias("_deleted"), F.col("op").alias("_op"),
        *[F.when(~(F.col("op") == "d"), F.col(c)).alias(c) for c in spec.columns])


def latest_per_key(df: DataFrame, keys: list[str], order: list[str] | Column) -> DataFrame:
    """The row with the greatest ``order`` per key (``max_by`` partial
    aggregate: combined map-side, so one hot key never sorts in one task)."""
    cols = [c for c in df.columns if c not in keys]
    ordering = order if isinstance(order, Column) else F.struct(*[F.col(c) for c in order])
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*cols), ordering).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols]))


def fold(changes: DataFrame, state: DataFrame | None = None, keys: tuple = ("pk",),
         lay: Callable[[DataFrame], DataFrame] | None = None, crowded: bool = False, was: list[str] | None = None) -> DataFrame:
    """C1/C2/K2/K3 + T3 + Q27: merge a change batch into a state of one row per
    key that keeps delete markers.

    A key's events of one partition apply by offset, whatever their times say.
    A position at or below the last one handled in its partition is a message
    delivered again: it neither overwrites a newer row nor resurrects a deleted
    one.  Everything else in a batch comes after all that earlier batches held.
    Only between partitions of one batch, for a key that moved, does the source
    time decide: each partition's clock for the key is the greatest time of its
    events there, so it never falls, and a missing time is not earlier than the
    event before it; equal clocks go by topic and partition.

    Two ``max_by`` aggregates, per key and partition and then per key, both
    combined map-side.  ``_past`` is null unless the key moved.

    ``lay`` lays the rows out by one of ``keys``, so that both aggregates find
    them in place; with ``crowded`` the changes of a key and partition are
    combined before that.  With ``was`` a row tells whether the batch made it
    (``_fresh``) and what these columns held before in the live row (``_was``).
    """
    at = ["_topic", "_partition"]
    cols = [c for c in changes.columns if c not in (*keys, "_pos", "_past")]
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    lanes = changes.select(*keys, F.col("_pos.topic").alias("_topic"), F.col("_pos.partition").alias("_partition"),
                           F.col("_pos.offset").alias("_offset"), F.col("_pos.clock").alias("_clock"),
                           F.lit(True).alias("_fresh"), F.lit(True).alias("_whole"), row.alias("_row"))
    if crowded:
        lanes = lanes.groupBy(*keys, *at).agg(F.max_by(F.struct("_offset", "_row"), F.col("_offset")).alias("_l"), F.max("_clock").alias("_clock"))
        lanes = lanes.select(*keys, *at, "_l._offset", "_clock", F.lit(True).alias("_fresh"), F.lit(True).alias("_whole"), "_l._row")
    if state is not None:
        past = F.transform(F.coalesce("_past", F.array().cast(PAST_TYPE)), lambda p: F.struct(
            F.lit(None).cast("bigint").alias("clock"), p["topic"].alias("topic"), p["partition"].alias("partition"),
            p["offset"].alias("offset"), F.lit(False).alias("whole")))
        held = F.concat(F.array(F.struct("_pos.clock", "_pos.topic", "_pos.partition", "_pos.offset", F.lit(True).alias("whole"))), past)
        stored = state.select(*keys, row.alias("_row"), F.explode(held).alias("_h"))
        lanes = lanes.unionByName(stored.select(
            *keys, F.col("_h.topic").alias("_topic"), F.col("_h.partition").alias("_partition"), F.col("_h.offset").alias("_offset"),
            F.col("_h.clock").alias("_clock"), F.lit(False).alias("_fresh"), F.col("_h.whole").alias("_whole"),
            F.when(F.col("_h.whole"), F.col("_row")).alias("_row")))
    if lay is not None:
        lanes = lay(lanes)
    held = []
    if was is not None:
        image = F.struct(*[F.col(f"_row.`{c}`").alias(c) for c in was])
        lanes = lanes.withColumn("_was", F.when(~F.col("_fresh") & F.col("_whole") & ~F.col("_row._deleted"), image))
        held = [F.first("_was", ignorenulls=True).alias("_was")]        # one at most per key
    # per key and partition the greatest offset; at the same offset what is stored stays
    last = lanes.groupBy(*keys, *at).agg(
        F.max_by(F.struct("_offset", "_clock", "_fresh", "_whole", "_row"), F.struct("_offset", ~F.col("_fresh"))).alias("_l"),
        F.max(F.when(F.col("_fresh"), F.col("_clock"))).alias("_seen"), *held)
    clock = F.when(F.col("_l._fresh"), F.col("_seen")).otherwise(F.col("_l._clock"))
    last = last.select(*keys, F.struct("_l._fresh", "_l._whole", clock.alias("clock"), F.col("_topic").alias("topic"),
                                       F.col("_partition").alias("partition"), F.col("_l._offset").alias("offset")).alias("_at"), "_l._row",
                       *[F.col("_was") for _ in held])
    best = last.groupBy(*keys).agg(F.max("_at").alias("_at"), F.max_by("_row", "_at").alias("_row"),
                                   F.collect_list(F.struct("_at.topic", "_at.partition", "_at.offset")).alias("_lanes"), *held)
    others = F.array_sort(F.filter("_lanes", lambda p: ~(p["topic"].eqNullSafe(F.col("_at.topic")) & p["partition"].eqNullSafe(F.col("_at.partition")))))
    named = {"_pos": F.struct("_at.clock", "_at.topic", "_at.partition", "_at.offset"),
             "_past": F.when(F.size(others) > 0, others), **{c: F.col(f"_row.`{c}`") for c in cols}}
    more = [F.col("_at._fresh").alias("_fresh"), F.col("_was")] if was is not None else []
    out = best.select(*keys, *[named[c].alias(c) for c in ("_pos", "_past")], *[named[c].alias(c) for c in cols], *more)
    return out.select(*[F.col(f"`{c}`") for c in changes.columns], *[F.col(c) for c in ("_fresh", "_was") if more]) \
        if "_past" in changes.columns else out


def current(state: DataFrame, spec: TableSpec) -> DataFrame:
    """Readers' view: live rows only, clean columns."""
    return state.where(~F.col("_deleted")).select(*spec.columns)


def relational_state(feed: DataFrame, table: str) -> DataFrame:
    """Whole-feed replay of one relational table to its keyed state."""
    spec = RELATIONAL[table]
    return fold(keyed_changes(parse_relational(feed, spec), spec))


def state_as_of(log: DataFrame, table: str, batch_id: int) -> DataFrame:
    """A table's rows as they were after a batch, folded from the written
    audit log: the log's folders of later batches are not read, the stored
    images are cleaned anew, and of a key that moved between partitions the
    later batch's position counts, then the greater clock."""
    spec = RELATIONAL[table]
    image = lambda c: V.null_if_json_null(F.try_parse_json(c))
    rows = log.where((F.col("batch_id") <= batch_id) & (F.col("source_table") == table)).select(
        F.col("source_topic").alias("topic"), F.col("source_partition").alias("partition"), F.col("source_offset").alias("offset"),
        "op", "ts_ms", "pk", image("before_data").alias("before"), image("after_data").alias("after"), "batch_id")
    cleaned = spec.cleaner(rows, image="after", keep=["topic", "partition", "offset", "op", "ts_ms", "pk", "after", "batch_id"])
    at = F.struct(F.struct(F.col("batch_id"), F.col("ts_ms")).alias("clock"), "topic", "partition", "offset")
    # only accepted events are in the log
    return current(fold(keyed_changes(cleaned.withColumn("_error", F.lit(None).cast("string")), spec, at)), spec)


# ------------------------------------------------------------------ documents
DOC_META = ["topic", "partition", "offset", "key_text", "value_text", "op", "ts_ms", "source_db",
            "source_collection"]


def _with_key_id(cleaned: DataFrame) -> DataFrame:
    """``doc_key_id``, the id that the message key holds, of the rows that need
    it: deletes and those whose document has none."""
    wanted = F.col("_id").isNull() | F.col("op").eqNullSafe("d")
    p = cleaned.withColumn("_k", F.when(wanted, F.try_parse_json(F.col("key_text"))))
    p = p.withColumn("_kid", F.when(V.vtype(F.col("_k")).startswith("OBJECT"), V.field(F.col("_k"), "id")).otherwise(F.col("_k")))
    p = p.withColumn("_kid_t", V.vtype(F.col("_kid")))
    p = p.withColumn("_kin", F.when(F.col("_kid_t") == "STRING",
                                    F.coalesce(F.try_parse_json(V.as_str(F.col("_kid"))), F.col("_kid")))
                     .otherwise(F.col("_kid")))
    p = p.withColumn("doc_key_id", F.when(~V.is_missing(F.col("_kin")), V.doc_id_text(F.col("_kin"))))
    return C.staged_rows(p, *cleaned.columns, "doc_key_id")


def _collection() -> Column:
    return F.coalesce(F.col("source_collection"), EV.table_from_topic(F.col("topic")))


def with_collection(feed: DataFrame) -> DataFrame:
    """Messages with the ``_collection`` that ``parse_documents`` finds them in."""
    p = EV.parse_envelope(feed)
    return C.staged_rows(p, *feed.columns, _collection().alias("_collection"))


def parse_documents(feed: DataFrame, collection: str) -> DataFrame:
    """P1, P4, P7, F18-F20, C2 inputs for one collection (E2: upsert
    without ``after``; delete without id)."""
    p = EV.parse_envelope(feed).where(~F.col("tombstone"))
    p = p.where(_collection() == collection)
    # staged so each parse happens once per row (no re-parse inside CASE branches)
    p = C.staged_rows(p, *DOC_META, "after", "malformed").withColumn("_after_t", V.vtype(F.col("after")))
    p = p.withColumn("doc", F.when(F.col("_after_t") == "STRING", F.try_parse_json(V.as_str(F.col("after"))))
                     .when(F.col("_after_t").startswith("OBJECT"), F.col("after"))).drop("_after_t", "after")
    cleaned = _with_key_id(C.DOC_CLEANERS[collection](p, image="doc", keep=DOC_META + ["malformed"]))
    is_upsert = F.col("op").isin(UPSERT_OPS)
    err = C.first_error((F.col("malformed"), C.ERR_BAD_JSON),
                        (is_upsert & F.col("_doc").isNull(), C.ERR_NO_AFTER),
                        ((F.col("op") == "d") & F.col("doc_key_id").isNull(), C.ERR_NO_DOC_ID))
    known = F.col("op").isin(UPSERT_OPS + ["d"])
    return (cleaned.withColumn("_id", F.coalesce(F.col("_id"), F.col("doc_key_id")))
            .withColumn("_error", F.coalesce(err, F.when(is_upsert, F.col("_error"))))
            .where(known | F.col("_error").isNotNull()))            # Q7: unknown ops ignored


def _replay_claims(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rejected of (group, id, key, topic, partition, offset) rows that
    come by group and position: a claim on a key that another live id holds is
    rejected and changes nothing; any other row releases the id's former key.
    Holds the live holders of one group, never its rows."""
    group: str | None = None
    holder: dict = {}
    held: dict = {}
    for b in batches:
        rejected = []
        for n, (g, i, key) in enumerate(zip(*(b.column(c).to_pylist() for c in ("group", "id", "key")))):
            if g != group:
                group, holder, held = g, {}, {}
            if key is not None and holder.get(key, i) != i:
                rejected.append(n)
                continue
            old = held.pop(i, None)
            if old is not None:
                del holder[old]
            if key is not None:
                holder[key], held[i] = i, key
        lost = b.take(pa.array(rejected, pa.int64()))
        yield pa.RecordBatch.from_arrays([lost.column(c) for c in WHERE], names=WHERE)


#: offsets of a partition whose clock one task works out
CLOCK_BLOCK = 1 << 16


def _placed(events: DataFrame) -> DataFrame:
    """(id, key, topic, partition, offset, pos): ``pos`` orders the events of
    all ids.  Inside a partition the offset decides; between partitions a clock
    does, the running maximum of the source times in the partition, which never
    falls and passes over missing times.  Rows of the stored state come first.

    A partition is cut into blocks of offsets: a block's clock starts from the
    greatest time of the blocks before it, so that no task takes a whole one.
    """
    block = F.floor(F.col("offset") / CLOCK_BLOCK)
    lane = ["stored", "topic", "partition"]
    events = events.withColumn("_block", block)
    before = (events.where(~F.col("stored")).groupBy(*lane, "_block").agg(F.max("ts_ms").alias("_top"))
              .withColumn("_top", F.max("_top").over(Window.partitionBy(*lane).orderBy("_block")
                                                     .rowsBetween(Window.unboundedPreceding, -1))))
    inside = F.max("ts_ms").over(Window.partitionBy(*lane, "_block", F.when(F.col("stored"), F.xxhash64("id")))
                                 .orderBy("offset").rowsBetween(Window.unboundedPreceding, 0))
    clocked = events.withColumn("_in", inside).join(before, [*lane, "_block"], "left")
    return clocked.select("id", "key", *WHERE, F.struct((~F.col("stored")).alias("new"), F.greatest("_in", "_top").alias("clock"),
                                                        "topic", "partition", "offset").alias("pos"))


def _contended(events: DataFrame, *more: Column) -> DataFrame:
    """The keys that two or more ids claim (a partial aggregate)."""
    return (events.where(F.col("key").isNotNull()).groupBy("key")
            .agg(F.min("id").alias("a"), F.max("id").alias("b"), *more).where("a <> b").drop("a", "b"))


def _settled(events: DataFrame) -> DataFrame:
    """``events`` with ``lost``: claims that are rejected whatever else happens.
    The first claim on a key finds it free, and its id holds the key until its
    own next event that is no claim on it; claims of others up to then are
    lost.  They change nothing, so what is left can be replayed without them.
    The hot key is an aggregate and a join with one row of its own."""
    back = Window.partitionBy("id").orderBy(F.col("pos").desc())
    events = events.withColumn("_turn", F.when(~F.col("key").eqNullSafe(F.lead("key").over(back)), F.col("pos")))
    events = events.withColumn("until", F.last("_turn", ignorenulls=True).over(
        back.rowsBetween(Window.unboundedPreceding, -1))).drop("_turn")
    first = _contended(events, F.min(F.struct("pos", "id", "until")).alias("first"))
    lost = ((F.col("id") != F.col("first.id")) & (F.col("pos") > F.col("first.pos"))
            & (F.col("first.until").isNull() | (F.col("pos") < F.col("first.until"))))
    return events.drop("until").join(first, "key", "left").withColumn("lost", F.coalesce(lost, F.lit(False))).drop("first")


def _node(kind: str, c: str) -> Column:
    return F.xxhash64(F.lit(kind), c)                       # an id is no key


def _contention_groups(pairs: DataFrame) -> DataFrame:
    """(node, group) for (id, key) pairs: ids that share a key, directly or over
    others, share a group.  Nodes are numbers made of ids and keys; should two
    make the same number, their groups are replayed as one, in the order of
    positions as ever, which changes no answer."""
    return connected(pairs.select(_node("k", "key").alias("a"), _node("i", "id").alias("b")))[0]


def reject_duplicate_keys(parsed: DataFrame, collection: str,
                          state: DataFrame | None = None) -> DataFrame:
    """Q14: a sparse unique business key belongs to one live ``_id`` at a time.
    An upsert that claims a key which another live id holds at its position is
    dead-lettered; a key is free again once its holder takes another key, drops
    it or is deleted.  The answer is that of event-at-a-time processing, so it
    does not depend on how the feed is cut into batches.

    Only events of ids that claim a key of two or more ids (a partial
    aggregate finds them) leave their plan.  Claims lost to a key's first
    holder are settled by joins; of the rest, the claims on keys still
    contended and the releases after them are replayed as a sorted stream, in
    groups of ids that contend with each other.  ``state`` is cut down to the
    rows that share an id or key with the batch first.
    """
    bk = C.DOC_BUSINESS_KEYS[collection]
    events = parsed.where(F.col("_error").isNull() & F.col("_id").isNotNull()).select(
        F.col("_id").alias("id"), F.when(F.col("op") != "d", F.col(bk).cast("string")).alias("key"),
        F.lit(False).alias("stored"), "topic", "partition", "offset", "ts_ms")
    if state is not None:
        live = state.where(~F.col("_deleted")).select(F.col("pk").alias("id"), F.col(bk).cast("string").alias("key"))
        touched = live.join(events.select("id").distinct(), "id", "left_semi").unionByName(
            live.join(events.where(F.col("key").isNotNull()).select("key").distinct(), "key", "left_semi")
            .select("id", "key")).distinct()
        events = events.unionByName(touched.select(
            "id", "key", F.lit(True).alias("stored"), F.lit(None).cast("string").alias("topic"),
            F.lit(-1).alias("partition"), F.lit(-1).cast("bigint").alias("offset"), F.lit(None).cast("bigint").alias("ts_ms")))
    events = materialize(events)
    contended = materialize(_contended(events))
    if not contended.take(1):
        return parsed
    ids = events.join(contended, "key", "left_semi").select("id").distinct()
    settled = materialize(_settled(_placed(events.join(ids, "id", "left_semi"))))
    rejected = settled.where("lost").select(*WHERE)
    rest = settled.where("not lost").drop("lost")
    pairs = materialize(rest.join(_contended(rest), "key", "left_semi").select("id", "key").distinct())
    if pairs.take(1):
        # a claim on any other key is a release of the id's former one, and only the first release after a claim counts
        still = pairs.select("key").distinct().withColumn("_still", F.lit(True))
        rest = (rest.join(pairs.select("id").distinct(), "id", "left_semi").join(still, "key", "left")
                .withColumn("key", F.when(F.col("_still"), F.col("key"))).drop("_still"))
        rest = (rest.withColumn("_before", F.lag("key").over(Window.partitionBy("id").orderBy("pos")))
                .where(F.col("key").isNotNull() | F.col("_before").isNotNull()))
        n = int(parsed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rejected = rejected.unionByName(
            rest.withColumn("node", _node("i", "id")).join(_contention_groups(pairs), "node").repartition(n, "group").sortWithinPartitions("group", "pos")
            .select("group", "id", "key", *WHERE).mapInArrow(_replay_claims, "topic string, partition int, offset bigint"))
    return (parsed.join(rejected.withColumn("_dup", F.lit(True)), ["topic", "partition", "offset"], "left")
            .withColumn("_error", F.coalesce(F.col("_error"), F.when(F.col("_dup"), F.lit(C.ERR_DUP_KEY)))).drop("_dup"))


#: What rejecting duplicate keys and folding read of a parsed document, beside its business key.
CLAIM_COLUMNS = ["topic", "partition", "offset", "op", "ts_ms", "_id", "_error"]


def document_changes(parsed: DataFrame, columns: list[str], synced_at=None, raw: bool = True) -> DataFrame:
    """Accepted document upserts and deletes, with the metadata of
    their change.  ``document`` is the whole document as it came, so fields
    that no cleaner names survive beside the cleaned ones (P16).  Without
    ``raw`` neither is carried: a state holds what its readers ask for."""
    acc = parsed.where(F.col("_error").isNull())
    if not raw:
        return acc.select(
            F.col("_id").alias("pk"), position().alias("_pos"), no_past().alias("_past"),
            (F.col("op") == "d").alias("_deleted"), F.col("op").alias("_op"),
            *[F.when(F.col("op") != "d", F.col(c)).alias(c) for c in columns])
    return acc.select(
        F.col("_id").alias("pk"), position().alias("_pos"), no_past().alias("_past"),
        (F.col("op") == "d").alias("_deleted"), F.col("op").alias("_op"),
        F.struct(F.lit("mongodb").alias("source_type"), F.col("topic").alias("source_topic"),
                 F.col("partition").alias("source_partition"), F.col("offset").alias("source_offset"),
                 F.col("source_db").alias("source_database"),
                 F.col("source_collection").alias("source_collection"),
                 F.col("op").alias("op"), F.col("ts_ms").alias("source_ts_ms"),
                 F.lit(synced_at).cast("timestamp").alias("synced_at")).alias("_cdc"),
        F.when(F.col("op") != "d", F.to_json(F.col("_doc"))).alias("document"),
        *[F.when(F.col("op") != "d", F.col(c)).alias(c) for c in columns])


def raw_documents(state: DataFrame) -> DataFrame:
    """K4: the raw collection, one document as it came per live ``_id``, with
    the metadata of its last change."""
    return state.where(~F.col("_deleted")).select(F.col("pk").alias("_id"), "document", "_cdc")


def offset_ledger(feed: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """K7: a row per handled message, inserted if its position is not in
    ``known`` yet."""
    mine = dedupe_deliveries(feed).select(
        F.col("topic").alias("source_topic"), F.col("partition").alias("source_partition"), F.col("offset").alias("source_offset"))
    return mine if known is None else mine.join(known, mine.columns, "left_anti")


REVIEW_COLUMNS = ["_id", "review_id", "customer_id", "product_id", "rating", "status", "title",
                  "body", "tags", "created_at", "updated_at"]
PROFILE_COLUMNS = ["_id", "customer_id", "full_name", "country", "preferences", "loyalty", "devices",
                   "created_at", "updated_at"]
CLICK_COLUMNS = ["_id", "event_id", "customer_id", "product_id", "event_type", "session_id", "metadata",
                 "event_time"]
DOC_COLUMNS = {"customer_profiles": PROFILE_COLUMNS, "product_reviews": REVIEW_COLUMNS, "click_events": CLICK_COLUMNS}


def document_state(feed: DataFrame, collection: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Whole-feed replay of one collection -> (keyed state, parsed events)."""
    parsed = reject_duplicate_keys(parse_documents(feed, collection), collection)
    return fold(document_changes(parsed, columns)), parsed


def dlq_messages(dead: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Dead letters as Kafka-shaped messages: the dead-letter topic, the
    original message key, the whole failed-event row as the JSON value, and the
    batch and the source position as headers.  Rows that name no topic go to
    the default one."""
    topic = F.col("dlq_topic") if "dlq_topic" in dead.columns else F.lit(DLQ_TOPIC)
    place = F.concat_ws("/", "source_topic", F.col("source_partition").cast("string"), F.col("source_offset").cast("string"))
    header = lambda name, value: F.struct(F.lit(name).alias("key"), F.encode(value, "UTF-8").alias("value"))
    return dead.select(topic.alias("topic"), F.col("message_key").alias("key"),
                       F.to_json(F.struct(*dead.columns)).alias("value"),
                       F.array(header("batch", F.lit(str(batch_id)) if batch_id is not None else F.lit("")), header("position", place)).alias("headers"))
