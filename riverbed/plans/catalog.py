"""Query catalogue: one entry per operator family.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.
Output rule: every column aliased; timestamps leave as ``timestamp_ntz`` (the
wall-clock UTC value), counts as bigint, money as fixed decimals.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ..operators import clean as C
from ..operators import marts as M
from ..operators import snapshot as SN
from ..session import materialize, spread
from ..sources import fixtures as FX
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


#: Feeds already written, by (folder, kind); None makes every query write its
#: own.  The benchmark fills it, to time queries apart from making their feeds.
FEEDS: dict[tuple[str, str], DataFrame] | None = None


def change_feed(spark, sf, kind: str) -> DataFrame:
    """The change feed as a table, like a topic a pipeline reads: generated
    once from the given tables and written to the shared checkpoint folder,
    so parsing plans read one scan instead of the generator's union branches."""
    from ..sources import feeds as FD
    if FEEDS is not None and (sf, kind) in FEEDS:
        return FEEDS[sf, kind]
    gen = {"relational": FD.relational_feed, "reviews": FD.reviews_feed, "profiles": FD.profiles_feed,
           "clicks": FD.clicks_feed, "releases": FD.key_release_feed, "chains": FD.key_chain_feed}[kind]
    feed = materialize(spread(gen(spark, sf)))
    if FEEDS is not None:
        FEEDS[sf, kind] = feed
    return feed


def ntz(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock UTC ``timestamp_ntz`` for engine-neutral output."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


# ---------------------------------------------------------------- clean layer
def clean_customers(spark, sf):
    return SN.clean_customers_snapshot(FX.src_customers(spark, sf))


def clean_orders(spark, sf):
    return SN.clean_orders_snapshot(FX.src_orders(spark, sf))


@register("clean_customers", O.with_ctes("select * from c_customers"))
def q_clean_customers(spark, sf):
    return ntz(clean_customers(spark, sf).select(*C.CUSTOMER_COLUMNS))


@register("clean_orders", O.with_ctes("select * from c_orders"))
def q_clean_orders(spark, sf):
    return ntz(clean_orders(spark, sf).select(*C.ORDER_COLUMNS))


# ----------------------------------------------------------- relational marts
DAILY_REVENUE_SQL = """
select order_day, place as country, cast(sum(n) as bigint) as total_orders, cast(sum(items) as bigint) as total_items,
  cast(sum(money) as decimal(16,2)) as total_revenue
from (
  select per.order_day, per.n, per.items, per.money,
    coalesce((select case when length(w.country) > 0 then w.country end from c_customers w where w.id = per.customer_id), 'UNKNOWN') as place
  from (select customer_id, order_date::date as order_day, count(*) as n, sum(quantity) as items, sum(total_amount) as money
        from c_orders where not status = 'CANCELLED' group by all) per)
group by all
"""

CUSTOMER_SUMMARY_SQL = """
select w.id as customer_id, w.full_name, w.country, ifnull(per.n, 0) as total_orders,
  cast(ifnull(per.money, 0) as decimal(16,2)) as total_spent, per.latest as last_order_date
from c_customers w left join (
  select customer_id, count(*) as n, max(order_date) as latest,
    sum(case status when 'CANCELLED' then 0 else total_amount end) as money
  from c_orders where customer_id is not null group by customer_id) per on per.customer_id = w.id
"""


@register("mart_daily_revenue", O.with_ctes(DAILY_REVENUE_SQL))
def q_mart_daily_revenue(spark, sf):
    return M.daily_revenue(clean_orders(spark, sf), clean_customers(spark, sf))


@register("mart_customer_summary", O.with_ctes(CUSTOMER_SUMMARY_SQL))
def q_mart_customer_summary(spark, sf):
    return ntz(M.customer_summary(clean_customers(spark, sf), clean_orders(spark, sf)))


# ------------------------------------------------------------ document layers
def clean_reviews(spark, sf):
    from ..sources import documents as D
    return SN.clean_documents_snapshot(D.review_docs(FX.src_reviews(spark, sf)), "product_reviews")


def clean_clicks(spark, sf):
    from ..sources import documents as D
    return SN.clean_documents_snapshot(D.click_docs(FX.src_clicks(spark, sf)), "click_events")


def clean_profiles(spark, sf):
    from ..sources import documents as D
    return SN.clean_documents_snapshot(D.profile_docs(FX.src_profiles(spark, sf)), "customer_profiles")


@register("clean_reviews", O.with_ctes(
    "select _id, review_id, cast(customer_id as bigint) as customer_id, cast(product_id as bigint) as product_id, "
    "cast(rating as bigint) as rating, status, title, 'fast,cheap,t' || cast(cast(review_id as bigint) % 3 as varchar) as tags, updated_at from c_reviews"))
def q_clean_reviews(spark, sf):
    return ntz(clean_reviews(spark, sf).select(
        "_id", "review_id", "customer_id", "product_id", "rating", "status", "title",
        F.array_join("tags", ",").alias("tags"), "updated_at"))


@register("clean_clicks", O.with_ctes(
    "select _id, event_id, cast(customer_id as bigint) as customer_id, cast(product_id as bigint) as product_id, "
    "event_type, session_id, user_agent, referrer, page, event_time from c_clicks"))
def q_clean_clicks(spark, sf):
    return ntz(clean_clicks(spark, sf).select(
        "_id", "event_id", "customer_id", "product_id", "event_type", "session_id",
        F.col("metadata.user_agent").alias("user_agent"), F.col("metadata.referrer").alias("referrer"),
        F.col("metadata.page").alias("page"), "event_time"))


@register("clean_profiles", O.with_ctes(
    "select _id, cast(customer_id as bigint) as customer_id, full_name, country, category, newsletter, "
    "price_sensitivity, tier, cast(points as bigint) as points, devices from c_profiles"))
def q_clean_profiles(spark, sf):
    return clean_profiles(spark, sf).select(
        "_id", "customer_id", "full_name", "country",
        F.col("preferences.category").alias("category"), F.col("preferences.newsletter").alias("newsletter"),
        F.col("preferences.price_sensitivity").alias("price_sensitivity"),
        F.col("loyalty.tier").alias("tier"), F.col("loyalty.points").alias("points"),
        F.array_join("devices", ",").alias("devices"))


@register("mart_product_review", O.with_ctes("""
select cast(product_id as bigint) as product_id, count(*) as review_count, round_even(coalesce(avg(rating), 0), 3) as avg_rating,
  count(*) filter (where status = 'APPROVED') as approved_count,
  count(*) filter (where status = 'PENDING') as pending_count,
  count(*) filter (where status = 'REJECTED') as rejected_count,
  max(updated_at) as last_review_at
from c_reviews group by product_id"""))
def q_mart_product_review(spark, sf):
    return ntz(M.product_review_summary(clean_reviews(spark, sf)))


ENGAGEMENT_SQL = """
, keys as (select customer_id from c_profiles where customer_id is not null
           union select customer_id from c_clicks where customer_id is not null
           union select customer_id from c_reviews where customer_id is not null),
cl as (select customer_id, count(*) as total_clicks, max(event_time) as last_click_at from c_clicks group by 1),
rv as (select customer_id, count(*) as total_reviews, avg(rating) as a, max(updated_at) as last_review_at
       from c_reviews group by 1)
select cast(k.customer_id as bigint) as customer_id, p.full_name,
  case when p.customer_id is not null then p.country else 'UNKNOWN' end as country,
  p.tier as loyalty_tier, coalesce(cl.total_clicks, 0) as total_clicks,
  coalesce(rv.total_reviews, 0) as total_reviews, round_even(coalesce(rv.a, 0), 3) as avg_rating_given,
  cl.last_click_at, rv.last_review_at
from keys k left join c_profiles p on p.customer_id = k.customer_id
  left join cl on cl.customer_id = k.customer_id left join rv on rv.customer_id = k.customer_id
"""


def _with_tail(tail: str) -> str:
    """CTEs plus extra CTEs given as ', name as (...)' followed by a body."""
    base = O.with_ctes("")
    return base.rstrip() + "\n" + tail


@register("mart_customer_engagement", _with_tail(ENGAGEMENT_SQL))
def q_mart_customer_engagement(spark, sf):
    return ntz(M.customer_engagement_summary(clean_profiles(spark, sf), clean_clicks(spark, sf),
                                             clean_reviews(spark, sf)))


@register("mart_country_profile", O.with_ctes("""
select country, count(*) as profile_count, count(*) filter (where tier = 'GOLD') as gold_customers,
  count(*) filter (where newsletter) as newsletter_opt_in
from c_profiles group by country"""))
def q_mart_country_profile(spark, sf):
    return M.country_profile_summary(clean_profiles(spark, sf))


# -------------------------------------------------------------------- objects
BATCH_TS = "2024-06-01 00:00:00"


def object_listing(spark, sf, previous: bool = False):
    return (FX.src_object_listing(spark, sf, previous)
            .withColumn("last_modified", F.timestamp_millis("last_modified_ms")).drop("last_modified_ms"))


def object_metadata(spark, sf):
    from ..operators import objects as OB
    ev = OB.object_events(object_listing(spark, sf))
    # three daily runs took the objects in, dealt by the minute of their last change
    day = F.substring("last_modified", 15, 2).cast("int") % 3
    taken = F.lit(BATCH_TS).cast("timestamp") + F.make_dt_interval(days=day)
    return OB.latest_per_object(SN.good(C.clean_object_events(ev, taken)))


def object_reconcile(spark, sf):
    from ..operators import objects as OB
    return OB.reconcile(object_metadata(spark, sf), FX.target_inventory(spark, sf), BATCH_TS)


def object_metadata_reconciled(spark, sf):
    """Metadata with the reconcile result applied; the metadata is written
    once and read by both the reconcile join and the status update."""
    from ..operators import objects as OB
    meta = materialize(object_metadata(spark, sf))
    recon = OB.reconcile(meta, FX.target_inventory(spark, sf), BATCH_TS)
    return OB.apply_reconcile(meta, recon)


OBJ_MEMBERS = """
, ev as (
  select sha256(concat_ws('|', bucket, object_key, coalesce(etag, ''), cast(size_bytes as varchar),
           strftime(make_timestamp(last_modified_ms * 1000), '%Y-%m-%dT%H:%M:%S+00:00'))) as event_id,
    sha256(concat_ws('|', bucket, object_key)) as object_id, bucket as source_bucket, object_key,
    regexp_extract(object_key, '[^/]*$') as file_name,
    lower(regexp_extract(regexp_extract(object_key, '[^/]*$'), '^\\.*[^.].*\\.([^.]*)$', 1)) as extension,
    coalesce(content_type, case lower(regexp_extract(regexp_extract(object_key, '[^/]*$'), '^\\.*[^.].*\\.([^.]*)$', 1))
      when 'png' then 'image/png' when 'mp4' then 'video/mp4' when 'wav' then 'audio/x-wav'
      when 'txt' then 'text/plain' end, 'application/octet-stream') as content_type,
    size_bytes, etag, strftime(make_timestamp(last_modified_ms * 1000), '%Y-%m-%dT%H:%M:%S+00:00') as last_modified
  from src_objects),
ev2 as (
  select *, case when lower(source_bucket) like '%images' or lower(content_type) like 'image/%' then 'image'
    when lower(source_bucket) like '%videos' or lower(content_type) like 'video/%' then 'video'
    when lower(source_bucket) like '%audio' or lower(content_type) like 'audio/%' then 'audio'
    when extension in ('jpg','jpeg','png','webp','gif','bmp','tiff') then 'image'
    when extension in ('mp4','mov','avi','mkv','webm') then 'video'
    when extension in ('mp3','wav','ogg','flac','m4a') then 'audio' else 'document' end as media_type
  from ev),
meta as (
  select object_id, event_id, source_bucket, object_key as source_object_key,
    case media_type when 'image' then 'clean-images' when 'video' then 'clean-videos'
      when 'audio' then 'clean-audio' else 'clean-documents' end as target_bucket,
    object_key as target_object_key, file_name, extension, media_type, content_type, size_bytes, etag,
    last_modified, 'manual_import' as source_type, 'ACTIVE' as status,
    timestamp '2024-06-01 00:00:00' + to_days(cast(substr(last_modified, 15, 2) as integer) % 3) as ingested_at,
    strftime(timestamp '2024-06-01 00:00:00' + to_days(cast(substr(last_modified, 15, 2) as integer) % 3), '%Y-%m-%d') as ingested_day
  from ev2 where size_bytes > 0),
recon as (
  select coalesce(m.target_bucket, i.bucket) as bucket, coalesce(m.target_object_key, i.object_key) as object_key,
    case when m.object_id is not null and i.bucket is not null then 'both'
         when m.object_id is not null then 'metadata_only' else 'object_only' end as presence,
    case when m.object_id is not null and i.bucket is not null then 'ACTIVE'
         when m.object_id is not null then 'MISSING' end as status,
    m.size_bytes as metadata_size, i.size_bytes as object_size,
    (m.object_id is not null and i.bucket is not null and m.size_bytes is distinct from i.size_bytes) as size_mismatch
  from meta m full outer join target_inventory i on m.target_bucket = i.bucket and m.target_object_key = i.object_key),
meta_r as (
  select m.* replace (coalesce(r.status, m.status) as status) from meta m
  left join recon r on r.bucket = m.target_bucket and r.object_key = m.target_object_key)
"""


@register("obj_metadata_clean", _with_tail(OBJ_MEMBERS + """
select object_id, event_id, source_bucket, source_object_key, target_bucket, target_object_key, file_name,
  extension, media_type, content_type, size_bytes, etag, last_modified, source_type, status from meta"""))
def q_obj_metadata_clean(spark, sf):
    return object_metadata(spark, sf).select(
        "object_id", "event_id", "source_bucket", "source_object_key", "target_bucket", "target_object_key",
        "file_name", "extension", "media_type", "content_type", "size_bytes", "etag", "last_modified",
        "source_type", "status")


@register("obj_inventory_reconcile", _with_tail(OBJ_MEMBERS + """
select bucket, object_key, presence, status, metadata_size, object_size, size_mismatch from recon"""))
def q_obj_inventory_reconcile(spark, sf):
    return object_reconcile(spark, sf).select(
        "bucket", "object_key", "presence", "status", "metadata_size", "object_size", "size_mismatch")


@register("obj_size_mismatch", _with_tail(OBJ_MEMBERS + """
select bucket, object_key, metadata_size, object_size from recon where size_mismatch"""))
def q_obj_size_mismatch(spark, sf):
    return object_reconcile(spark, sf).where("size_mismatch").select(
        "bucket", "object_key", "metadata_size", "object_size")


@register("obj_issue_samples", _with_tail(OBJ_MEMBERS + """
, kinds as (
  select case when presence = 'object_only' then 'missing_metadata' when presence = 'metadata_only'
    then 'missing_object' when size_mismatch then 'size_mismatch' end as issue,
    concat_ws('/', bucket, object_key) as sample from recon)
select issue, sample from (
  select issue, sample, row_number() over (partition by issue order by sample) as rn from kinds where issue is not null)
where rn <= 10"""))
def q_obj_issue_samples(spark, sf):
    from ..operators import objects as OB
    # the reconcile result is written once; each issue kind's top-k reads it
    return OB.issue_samples(materialize(object_reconcile(spark, sf)))


@register("obj_dq_score", _with_tail(OBJ_MEMBERS + """
select count(*) filter (where presence <> 'metadata_only') as target_object_count,
  count(*) filter (where status = 'ACTIVE') as active_object_count, count(*) filter (where status = 'MISSING') as missing_status_count,
  count(*) filter (where presence <> 'object_only') as clean_object_metadata_count,
  count(*) filter (where presence = 'object_only') as missing_metadata_count,
  count(*) filter (where presence = 'metadata_only') as missing_object_count,
  count(*) filter (where size_mismatch) as size_mismatch_count,
  count(*) filter (where presence <> 'both' or size_mismatch) as dq_issue_count
from recon"""))
def q_obj_dq_score(spark, sf):
    from ..operators import objects as OB
    return OB.reconcile_metrics(object_reconcile(spark, sf))


@register("obj_summary_by_type", _with_tail(OBJ_MEMBERS + """
select media_type, count(*) as total_objects, cast(sum(size_bytes) as bigint) as total_size_bytes,
  round_even(coalesce(avg(size_bytes), 0), 3) as avg_size_bytes, max(ingested_at) as latest_ingested_at
from meta_r where status = 'ACTIVE' group by media_type"""))
def q_obj_summary_by_type(spark, sf):
    return ntz(M.object_summary_by_type(object_metadata_reconciled(spark, sf)))


@register("obj_summary_by_day", _with_tail(OBJ_MEMBERS + """
select ingested_day, count(*) as total_objects, cast(sum(size_bytes) as bigint) as total_size_bytes
from meta_r where status = 'ACTIVE' group by ingested_day"""))
def q_obj_summary_by_day(spark, sf):
    return M.object_summary_by_day(object_metadata_reconciled(spark, sf))


@register("obj_storage_summary", _with_tail(OBJ_MEMBERS + """
select 'current' as _id, count(*) as total_objects, cast(coalesce(sum(size_bytes), 0) as bigint) as total_size_bytes
from meta_r where status = 'ACTIVE'"""))
def q_obj_storage_summary(spark, sf):
    return M.object_storage_summary(object_metadata_reconciled(spark, sf))


FINGERPRINT_SQL = """
, prev_listing as (
  select bucket, object_key, size_bytes, last_modified_ms,
    case when doc_id % 11 = 0 then md5(concat(text, '#v0')) else md5(text) end as etag
  from (select case doc_id % 4 when 0 then 'raw-images' when 1 then 'raw-videos' when 2 then 'raw-audio'
      else 'raw-documents' end as bucket,
    concat(lang, '/', source, '/doc_', cast(doc_id as varchar), case doc_id % 4 when 0 then '.PNG'
      when 1 then '.mp4' when 2 then '.wav' else '.txt' end) as object_key,
    case when doc_id % 37 = 0 then 0 else n_chars end as size_bytes, 1704067200000 + doc_id * 1000 as last_modified_ms,
    doc_id, text from documents where doc_id % 17 <> 0)),
fp_cur as (select bucket, object_key, sha256(concat_ws('|', bucket, object_key, coalesce(etag, ''), cast(size_bytes as varchar),
    strftime(make_timestamp(last_modified_ms * 1000), '%Y-%m-%d %H:%M:%S+00:00'))) as fp from src_objects),
fp_prev as (select bucket, object_key, sha256(concat_ws('|', bucket, object_key, coalesce(etag, ''), cast(size_bytes as varchar),
    strftime(make_timestamp(last_modified_ms * 1000), '%Y-%m-%d %H:%M:%S+00:00'))) as fp from prev_listing)
select c.bucket, c.object_key, case when p.fp is null then 'new' else 'changed' end as change_kind
from fp_cur c left join fp_prev p on p.bucket = c.bucket and p.object_key = c.object_key
where p.fp is null or p.fp <> c.fp
"""


@register("obj_change_detect", _with_tail(FINGERPRINT_SQL))
def q_obj_change_detect(spark, sf):
    from ..operators import objects as OB
    return OB.changed_objects(object_listing(spark, sf), object_listing(spark, sf, previous=True)) \
        .select("bucket", "object_key", "change_kind")


# ---------------------------------------------------------------- change data
def _orders_state(spark, sf, feed=None):
    from ..operators import changes as CH
    from ..sources import feeds as FD
    return CH.relational_state(feed if feed is not None else change_feed(spark, sf, "relational"), "orders")


@register("cdc_current_orders", O.with_ctes("select * from f_orders"))
def q_cdc_current_orders(spark, sf):
    from ..operators import changes as CH
    return ntz(CH.current(_orders_state(spark, sf), CH.RELATIONAL["orders"]))


@register("cdc_current_customers", O.with_ctes("select * from f_customers"))
def q_cdc_current_customers(spark, sf):
    from ..operators import changes as CH
    from ..sources import feeds as FD
    st = CH.relational_state(change_feed(spark, sf, "relational"), "customers")
    return ntz(CH.current(st, CH.RELATIONAL["customers"]))


@register("replay_idempotent", O.with_ctes("select * from f_orders"))
def q_replay_idempotent(spark, sf):
    """Every message delivered twice; de-duplicated on source position."""
    from ..operators import changes as CH
    from ..sources import feeds as FD
    feed = change_feed(spark, sf, "relational")
    twice = CH.dedupe_deliveries(feed.unionByName(feed))
    return ntz(CH.current(_orders_state(spark, sf, twice), CH.RELATIONAL["orders"]))


def _image_sql(t: str, numbers: list[str], texts: list[str]) -> str:
    """SQL text of a row image, members in name order."""
    parts = ["'{'"]
    for i, n in enumerate(sorted([*numbers, *texts])):
        quote = "'\"'" if n in texts else "''"
        parts.append(f"'{',' if i else ''}\"{n}\":' || coalesce({quote} || cast({t}.{n} as varchar) || {quote}, 'null')")
    return " || ".join(parts + ["'}'"])


_ORDER_IMAGE = (["customer_id", "id", "order_date", "quantity", "updated_at"], ["product_name", "status", "unit_price"])
_CUSTOMER_IMAGE = (["created_at", "id", "updated_at"], ["country", "email", "full_name", "phone"])

def _order_json(after: str, before: str, op: str, ts: str) -> str:
    """SQL text of an order message's value with members in name order."""
    image = lambda t: _image_sql(t, *_ORDER_IMAGE) if t else "'null'"
    inner = f"'{{\"after\":' || {image(after)} || ',\"before\":' || {image(before)} || ',\"op\":\"{op}\",\"ts_ms\":' || {ts} || '}}'"
    return f"case when id % 2 = 1 then '{{\"payload\":' || {inner} || ',\"schema\":null}}' else {inner} end"


_POISON_ERRORS = [C.ERR_TIMESTAMP, C.ERR_TIMESTAMP, C.ERR_NUMERIC_OVERFLOW, C.ERR_NO_OP, C.ERR_NO_PK, C.ERR_TIMESTAMP,
                  C.ERR_INT_RANGE, C.ERR_INT_RANGE]


def _poison_sql() -> str:
    """Per poison kind the message's text, as a JSON parser gives it back, and its error."""
    from ..sources.feeds import POISON
    texts, errors = [], []
    for i, (op, own, qty, price, date) in enumerate(POISON):
        ident = f"'{own}'" if own else "cast(id as varchar)"
        date = "1.0E30" if date == "1e30" else date
        texts.append(f"when {i} then '{{\"after\":{{\"customer_id\":1,\"id\":' || {ident} || ',\"order_date\":{date},\"quantity\":{qty},"
                     f"\"unit_price\":{price}}},\"op\":{op},\"ts_ms\":' || cast(updated_at + 3 as varchar) || '}}'")
        errors.append(f"when {i} then '{_POISON_ERRORS[i]}'")
    return (f"select id, 5 as seq, case (id // 97) % 8 {' '.join(texts)} end as message_value, "
            f"case (id // 97) % 8 {' '.join(errors)} end as err, updated_at + 3 as ts from src_orders where id % 97 = 13")


DEAD_LETTERS_SQL = f"""
select 'shop.public.orders' as source_topic, cast(id % 4 as integer) as source_partition,
  cast(id * 8 + seq as bigint) as source_offset, concat('{{"id":', cast(id as varchar), '}}') as message_key,
  message_value, err as error_message, 0 as retry_count, 'riverbed' as consumer_group,
  make_timestamp(ts * 1000) as failed_at
from (select id, 0 as seq, {_order_json('s', '', 'r', 's.updated_at')} as message_value, 'numeric field overflow' as err, s.updated_at as ts
        from c_orders_all o join src_orders s using (id) where o.total_amount is null
      union all select id, 1, {_order_json('u', 's', 'u', '(s.updated_at + 1)')}, 'numeric field overflow', s.updated_at + 1
        from u_orders_all o join src_orders s using (id) join u_orders_src u using (id) where o.total_amount is null
      union all select id, 4, '{{"_raw":"{{\\"op\\": \\"u\\", \\"after\\": {{\\"id\\": ' || cast(id as varchar) || ', "}}', 'malformed JSON value', null
        from src_orders where id % 1009 = 7
      union all select id, seq, message_value, err, ts from ({_poison_sql()}))
"""


@register("cdc_dead_letters", O.with_ctes(DEAD_LETTERS_SQL))
def q_cdc_dead_letters(spark, sf):
    return ntz(q_cdc_dead_letters_full(spark, sf).drop("dlq_topic"))


AUDIT_SQL = f"""
select source_table, op, pk, ts_ms, cast(source_partition as integer) as source_partition,
  cast(source_offset as bigint) as source_offset, before_data, after_data from (
  select 'customers' as source_table, 'r' as op, cast(id as varchar) as pk, updated_at as ts_ms, id % 4 as source_partition,
    id * 8 as source_offset, cast(null as varchar) as before_data, {_image_sql('s', *_CUSTOMER_IMAGE)} as after_data from src_customers s
  union all select 'customers', 'u', cast(id as varchar), s.updated_at + 1, id % 4, id * 8 + 1,
    {_image_sql('s', *_CUSTOMER_IMAGE)}, {_image_sql('f', *_CUSTOMER_IMAGE)}
    from src_customers s join fin_customers_src f using (id) where id % 5 = 0
  union all select 'orders', 'r', cast(id as varchar), s.updated_at, id % 4, id * 8, null, {_image_sql('s', *_ORDER_IMAGE)}
    from c_orders_all o join src_orders s using (id) where o.total_amount is not null
  union all select 'orders', 'u', cast(id as varchar), s.updated_at + 1, id % 4, id * 8 + 1,
    {_image_sql('s', *_ORDER_IMAGE)}, {_image_sql('u', *_ORDER_IMAGE)}
    from u_orders_all o join src_orders s using (id) join u_orders_src u using (id) where o.total_amount is not null
  union all select 'orders', 'd', cast(id as varchar), s.updated_at + 2, id % 4, id * 8 + 2, {_image_sql('u', *_ORDER_IMAGE)}, null
    from src_orders s join u_orders_src u using (id) where id % 9 = 0)
"""


@register("cdc_audit_log", O.with_ctes(AUDIT_SQL))
def q_cdc_audit_log(spark, sf):
    from ..operators import changes as CH
    feed = change_feed(spark, sf, "relational")
    parts = [CH.audit_log(CH.parse_relational(feed, spec)) for spec in CH.RELATIONAL.values()]
    return parts[0].unionByName(parts[1]).select(
        "source_table", "op", "pk", "ts_ms", "source_partition", "source_offset", "before_data", "after_data")


def _two_batches(feed):
    """Split a feed into the snapshot batch (op r) and the change batch."""
    snap = feed.where(F.col("offset") % 8 == 0)
    rest = feed.where(F.col("offset") % 8 != 0)
    return snap, rest


def _incremental_relational(spark, sf):
    from ..operators import changes as CH
    from ..sources import feeds as FD
    feed = change_feed(spark, sf, "relational")
    b1, b2 = _two_batches(feed)
    # no state carries columns that neither mart reads
    so = replace(CH.RELATIONAL["orders"], columns=["id", "customer_id", "quantity", "total_amount", "status", "order_date"])
    sc = replace(CH.RELATIONAL["customers"], columns=["id", "full_name", "country"])
    ch1_o = CH.keyed_changes(CH.parse_relational(b1, so), so)
    ch1_c = CH.keyed_changes(CH.parse_relational(b1, sc), sc)
    # each batch's state is materialised, as the store would write it
    st1_o, st1_c = materialize(CH.fold(ch1_o)), materialize(CH.fold(ch1_c))
    ch2_o = materialize(CH.keyed_changes(CH.parse_relational(b2, so), so))
    ch2_c = materialize(CH.keyed_changes(CH.parse_relational(b2, sc), sc))
    st2_o, st2_c = materialize(CH.fold(ch2_o, st1_o)), materialize(CH.fold(ch2_c, st1_c))
    old_o, old_c = CH.current(st1_o, so), CH.current(st1_c, sc)
    new_o, new_c = CH.current(st2_o, so), CH.current(st2_c, sc)
    changed_o = ch2_o.select(F.col("pk").cast("bigint").alias("id"))
    changed_c = ch2_c.select(F.col("pk").cast("bigint").alias("id"))
    return old_o, old_c, new_o, new_c, changed_o, changed_c


@register("mart_revenue_incremental", O.with_ctes(
    DAILY_REVENUE_SQL.replace("c_orders", "f_orders").replace("c_customers", "f_customers")))
def q_mart_revenue_incremental(spark, sf):
    """M1-M3 + A3: snapshot batch -> full mart; change batch -> delta refresh."""
    from ..operators import incremental as IN
    old_o, old_c, new_o, new_c, changed_o, changed_c = _incremental_relational(spark, sf)
    mart1 = M.daily_revenue(old_o, old_c)
    return IN.revenue_refresh(mart1, old_o, old_c, new_o, new_c, changed_o, changed_c)


@register("mart_customer_incremental", O.with_ctes(
    CUSTOMER_SUMMARY_SQL.replace("c_orders", "f_orders").replace("c_customers", "f_customers")))
def q_mart_customer_incremental(spark, sf):
    """M3 + A4: affected customers recomputed after the change batch."""
    from ..operators import incremental as IN
    old_o, old_c, new_o, new_c, changed_o, changed_c = _incremental_relational(spark, sf)
    s1 = M.customer_summary(old_c, old_o)
    return ntz(IN.customer_summary_refresh(s1, old_o, new_o, new_c, changed_o, changed_c))


RETRACT_SQL = """
, newest as (select id from src_orders where customer_id is not null
  qualify row_number() over (partition by customer_id order by order_date desc, id desc) = 1),
kept_orders as (select * from c_orders where id not in (select id from newest))
""" + CUSTOMER_SUMMARY_SQL.replace("c_orders", "kept_orders")


@register("mart_customer_retract", _with_tail(RETRACT_SQL))
def q_mart_customer_retract(spark, sf):
    """A4: the newest order of every customer is deleted after the snapshot;
    the last order date goes back to what is left, from the partial states."""
    import uuid

    from ..session import store_root
    from ..sources import feeds as FD
    from ..streaming import streams as ST
    feed = change_feed(spark, sf, "relational").where(F.col("offset") % 8 == 0)
    newest = Window.partitionBy("customer_id").orderBy(F.desc("order_date"), F.desc("id"))
    gone = (FX.src_orders(spark, sf).where(F.col("customer_id").isNotNull()).withColumn("rn", F.row_number().over(newest)).where("rn = 1"))
    pipe = ST.RelationalPipeline(spark, store_root(spark, f"retract-{uuid.uuid4().hex}"))
    pipe.process(feed, 0)
    pipe.process(materialize(FD.order_deletes(gone)), 1)
    return ntz(pipe.read_mart("customer_summary"))


def _reviews_state(spark, sf, feed=None):
    from ..operators import changes as CH
    from ..sources import feeds as FD
    parsed = materialize(CH.parse_documents(feed if feed is not None else change_feed(spark, sf, "reviews"),
                                            "product_reviews"))
    parsed = CH.reject_duplicate_keys(parsed, "product_reviews")
    return CH.fold(CH.document_changes(parsed, CH.REVIEW_COLUMNS)), parsed


@register("cdc_current_reviews", O.with_ctes(
    "select _id, review_id, cast(customer_id as bigint) as customer_id, cast(product_id as bigint) as product_id, "
    "cast(rating as bigint) as rating, status, title, updated_at from f_reviews"))
def q_cdc_current_reviews(spark, sf):
    st, _ = _reviews_state(spark, sf)
    return ntz(st.where(~F.col("_deleted")).select(
        "_id", "review_id", "customer_id", "product_id", "rating", "status", "title", "updated_at"))


DOC_DEAD_SQL = """
select 'shop.reviewsdb.product_reviews' as source_topic, cast(k % 4 as integer) as source_partition,
  cast(k * 8 + seq as bigint) as source_offset, err as error_message
from (select k, 4 as seq, 'document upsert carries no document' as err from src_reviews where k % 211 = 9
      union all select k, 3, 'document delete carries no id' from src_reviews where k % 307 = 11
      union all select k, 5, 'duplicate business key' from src_reviews where k % 101 = 3 and k % 10 <> 0)
"""


@register("cdc_doc_dead_letters", O.with_ctes(DOC_DEAD_SQL))
def q_cdc_doc_dead_letters(spark, sf):
    from ..operators import changes as CH
    _, parsed = _reviews_state(spark, sf)
    return CH.dead_letters(parsed.withColumn("key_text", F.col("key_text"))).select(
        "source_topic", "source_partition", "source_offset", "error_message")


@register("doc_marts_incremental", O.with_ctes("""
select cast(product_id as bigint) as product_id, count(*) as review_count, round_even(coalesce(avg(rating), 0), 3) as avg_rating,
  count(*) filter (where status = 'APPROVED') as approved_count,
  count(*) filter (where status = 'PENDING') as pending_count,
  count(*) filter (where status = 'REJECTED') as rejected_count,
  max(updated_at) as last_review_at
from f_reviews group by product_id"""))
def q_doc_marts_incremental(spark, sf):
    """M4 + P11: review mart after the change batch, refreshed only for the
    products touched by old or new images of changed documents."""
    from ..operators import changes as CH
    from ..operators import incremental as IN
    from ..sources import feeds as FD
    b1, b2 = _two_batches(change_feed(spark, sf, "reviews"))
    # no state carries columns that neither the mart nor the next batch's claims read
    columns = ["review_id", "product_id", "rating", "status", "updated_at"]

    def changes(batch, state=None):
        parsed = materialize(CH.parse_documents(batch, "product_reviews").select(*CH.CLAIM_COLUMNS, *columns))
        return CH.document_changes(CH.reject_duplicate_keys(parsed, "product_reviews", state), columns, raw=False)
    st1 = materialize(CH.fold(changes(b1)))
    ch2 = materialize(changes(b2, st1))
    st2 = materialize(CH.fold(ch2, st1))
    live = lambda st: st.where(~F.col("_deleted"))
    mart1 = M.product_review_summary(live(st1))
    changed = ch2.select("pk")
    old_changed = live(st1).join(changed, "pk", "left_semi")          # M6/J6: prior images
    new_changed = live(st2).join(changed, "pk", "left_semi")
    return ntz(IN.product_review_refresh(mart1, live(st2), old_changed, new_changed))


# ------------------------------------------------------ quality and reconcile
def _relational_layers(spark, sf):
    """Final clean state, audit log and rebuilt marts after the whole feed."""
    from ..operators import changes as CH
    from ..sources import feeds as FD
    feed = change_feed(spark, sf, "relational")
    parsed = {t: materialize(CH.slim(CH.parse_relational(feed, spec), ["before", "after"])) for t, spec in CH.RELATIONAL.items()}
    raw = CH.audit_log(parsed["customers"]).unionByName(CH.audit_log(parsed["orders"]))
    # several metrics read the current rows, so they are written, as the store would
    cur = {t: materialize(CH.current(CH.fold(CH.keyed_changes(parsed[t], spec)), spec))
           for t, spec in CH.RELATIONAL.items()}
    cust, orders = cur["customers"], cur["orders"]
    return raw, cust, orders, M.daily_revenue(orders, cust), M.customer_summary(cust, orders)


REL_METRICS_BODY = """
, raw as (""" + AUDIT_SQL + """),
dr as (""" + DAILY_REVENUE_SQL.replace("c_orders", "f_orders").replace("c_customers", "f_customers") + """),
cs as (""" + CUSTOMER_SUMMARY_SQL.replace("c_orders", "f_orders").replace("c_customers", "f_customers") + """),
metrics as (
  select 'raw_events_count' as metric_name, count(*) as metric_value from raw
  union all select 'clean_customers_count', count(*) from f_customers
  union all select 'customers_unknown_country_count', count(*) filter (where country = 'UNKNOWN') from f_customers
  union all select 'clean_orders_count', count(*) from f_orders
  union all select 'orders_invalid_quantity_count', count(*) filter (where quantity < 0) from f_orders
  union all select 'orders_negative_price_count', count(*) filter (where unit_price < 0) from f_orders
  union all select 'orders_without_customer_count', count(*) from f_orders o
    where not exists (select 1 from f_customers c where c.id = o.customer_id)
  union all select 'mart_daily_revenue_rows', count(*) from dr
  union all select 'mart_unknown_country_rows', count(*) filter (where country = 'UNKNOWN') from dr
  union all select 'mart_customer_summary_rows', count(*) from cs)
"""


@register("rel_dq_metrics", _with_tail(REL_METRICS_BODY + "select metric_name, metric_value from metrics"))
def q_rel_dq_metrics(spark, sf):
    """Layer counts and DQ counts after replaying the relational feed."""
    from ..operators import quality as Q
    return Q.relational_metrics(*_relational_layers(spark, sf))


@register("rel_dq_score", _with_tail(REL_METRICS_BODY + """
select cast(coalesce(sum(metric_value), 0) as bigint) as dq_issue_count,
  case when coalesce(sum(metric_value), 0) = 0 then 'SUCCESS' else 'SUCCESS_WITH_WARNINGS' end as status
from metrics where metric_name in ('customers_unknown_country_count', 'orders_without_customer_count',
  'orders_invalid_quantity_count', 'orders_negative_price_count', 'mart_unknown_country_rows')"""))
def q_rel_dq_score(spark, sf):
    """R8 + A13 + P13 + S9: the score is a filtered sum over the metric rows."""
    from ..operators import quality as Q
    return Q.relational_dq_score(Q.relational_metrics(*_relational_layers(spark, sf)))


#: What metrics and marts read of the clean documents.
LAYER_COLUMNS = {"customer_profiles": ["_id", "customer_id", "full_name", "country", "preferences", "loyalty"],
                 "product_reviews": ["customer_id", "product_id", "rating", "status", "updated_at"],
                 "click_events": ["customer_id", "event_type", "event_time"]}


def _document_layers(spark, sf):
    """Source rows, raw images and clean rows of each collection.  Several
    metrics and marts read the clean rows, so they are written once, by tasks
    that each get a share of the documents however few files hold them."""
    from ..sources import documents as D
    srcs = {"customer_profiles": (FX.src_profiles(spark, sf), D.profile_docs),
            "product_reviews": (FX.src_reviews(spark, sf), D.review_docs),
            "click_events": (FX.src_clicks(spark, sf), D.click_docs)}
    out = {}
    for name, (src, shape) in srcs.items():
        image = lambda rows: SN.document_image(shape(rows))
        clean = SN.good(C.DOC_CLEANERS[name](image(src.repartition("_id")))).select(*LAYER_COLUMNS[name])
        out[name] = (src, image(src), materialize(clean))
    return out


DOC_METRICS_BODY = """
, rm as (select product_id from c_reviews group by product_id),
em as (select customer_id from c_profiles union select customer_id from c_clicks union select customer_id from c_reviews),
cm as (select country from c_profiles group by country),
metrics as (
  select 'source_customer_profiles_count' as metric_name, count(*) as metric_value from src_profiles
  union all select 'target_raw_customer_profiles_count', count(*) from src_profiles
  union all select 'target_clean_customer_profiles_count', count(*) from c_profiles
  union all select 'unknown_country_profiles_count', count(*) filter (where country = 'UNKNOWN') from c_profiles
  union all select 'source_product_reviews_count', count(*) from src_reviews
  union all select 'target_raw_product_reviews_count', count(*) from src_reviews
  union all select 'target_clean_product_reviews_count', count(*) from c_reviews
  union all select 'invalid_review_rating_count', count(*) filter (where rating < 0 or rating > 5) from c_reviews
  union all select 'missing_review_product_id_count', count(*) filter (where product_id = 0) from c_reviews
  union all select 'source_click_events_count', count(*) from src_clicks
  union all select 'target_raw_click_events_count', count(*) from src_clicks
  union all select 'target_clean_click_events_count', count(*) from c_clicks
  union all select 'missing_click_event_type_count', count(*) filter (where event_type = 'UNKNOWN') from c_clicks
  union all select 'mart_product_review_summary_rows', count(*) from rm
  union all select 'mart_customer_engagement_summary_rows', count(*) from em
  union all select 'mart_country_profile_summary_rows', count(*) from cm)
"""


def _doc_metrics(spark, sf):
    from ..operators import quality as Q
    L = _document_layers(spark, sf)
    (sp, rp, cp), (sr, rr, cr), (sc, rc, cc) = (L["customer_profiles"], L["product_reviews"],
                                                 L["click_events"])
    return Q.document_metrics(sp, sr, sc, rp, rr, rc, cp, cr, cc,
                              M.product_review_summary(cr), M.customer_engagement_summary(cp, cc, cr),
                              M.country_profile_summary(cp))


@register("doc_dq_metrics", _with_tail(DOC_METRICS_BODY + "select metric_name, metric_value from metrics"))
def q_doc_dq_metrics(spark, sf):
    """Source / raw / clean counts, mart rows and the four DQ counts."""
    return _doc_metrics(spark, sf)


@register("doc_dq_score", _with_tail(DOC_METRICS_BODY + """
, w as (select
    sum(metric_value) filter (where metric_name in ('unknown_country_profiles_count', 'invalid_review_rating_count',
      'missing_review_product_id_count', 'missing_click_event_type_count')) as issues,
    (case when max(metric_value) filter (where metric_name = 'source_customer_profiles_count')
            = max(metric_value) filter (where metric_name = 'target_clean_customer_profiles_count') then 0 else 1 end
   + case when max(metric_value) filter (where metric_name = 'source_product_reviews_count')
            = max(metric_value) filter (where metric_name = 'target_clean_product_reviews_count') then 0 else 1 end
   + case when max(metric_value) filter (where metric_name = 'source_click_events_count')
            = max(metric_value) filter (where metric_name = 'target_clean_click_events_count') then 0 else 1 end) as mism
  from metrics)
select cast(issues + mism as bigint) as dq_issue_count, cast(mism as bigint) as count_mismatches,
  case when issues + mism = 0 then 'SUCCESS' else 'SUCCESS_WITH_WARNINGS' end as status from w"""))
def q_doc_dq_score(spark, sf):
    """R9 + R11."""
    from ..operators import quality as Q
    return Q.document_dq_score(_doc_metrics(spark, sf))


@register("obj_content_type", _with_tail(OBJ_MEMBERS + """
select source_bucket as bucket, object_key, content_type, media_type from ev2"""))
def q_obj_content_type(spark, sf):
    """F23 + F24: stored type, else guessed from the extension, else octet-stream."""
    from ..operators import objects as OB
    return OB.object_events(object_listing(spark, sf)).select(
        F.col("source_bucket").alias("bucket"), "object_key", "content_type", "media_type")


@register("obj_status_after_reconcile", _with_tail(OBJ_MEMBERS + """
select m.object_id, m.target_bucket, m.target_object_key, m.status,
  case when m.status = 'MISSING' then timestamp '2024-06-01 00:00:00' end as missing_detected_at,
  timestamp '2024-06-01 00:00:00' as last_reconciled_at
from meta_r m"""))
def q_obj_status_after_reconcile(spark, sf):
    """K11 + R4: status / missing_detected_at / last_reconciled_at on metadata."""
    return ntz(object_metadata_reconciled(spark, sf).select(
        "object_id", "target_bucket", "target_object_key", "status", "missing_detected_at",
        "last_reconciled_at"))


# -------------------------------------------------------------------- reports
@register("report_latest_days", O.with_ctes(DAILY_REVENUE_SQL + " order by order_day desc, country limit 20"))
def q_report_latest_days(spark, sf):
    """L1."""
    from . import reports as R
    return R.latest_revenue_days(q_mart_daily_revenue(spark, sf))


@register("report_top_spenders", O.with_ctes(CUSTOMER_SUMMARY_SQL + " order by total_spent desc, customer_id limit 20"))
def q_report_top_spenders(spark, sf):
    """L2."""
    from . import reports as R
    return R.top_spenders(q_mart_customer_summary(spark, sf))


LAYER_COUNTS_SQL = ("select 'raw.cdc_events' as layer, cast(null as varchar) as status, count(*) as row_count from (" + AUDIT_SQL + ")\n"
                    "union all select 'ops.failed_events', null, count(*) from (" + DEAD_LETTERS_SQL + ")\n"
                    "union all select 'source.customers', null, count(*) from src_customers\n"
                    "union all select 'source.orders', null, count(*) from src_orders\n"
                    "union all select 'clean.customers', null, count(*) from c_customers\nunion all select 'clean.orders', null, count(*) from c_orders\n"
                    "union all select 'mart.daily_revenue', null, count(*) from (" + DAILY_REVENUE_SQL + ")\n"
                    "union all select 'mart.customer_summary', null, count(*) from (" + CUSTOMER_SUMMARY_SQL + ")")


@register("report_layer_counts", O.with_ctes(LAYER_COUNTS_SQL))
def q_report_layer_counts(spark, sf):
    """Labelled count report over the relational layers."""
    from . import reports as R
    from ..operators import changes as CH
    cust, orders = clean_customers(spark, sf), clean_orders(spark, sf)
    feed = change_feed(spark, sf, "relational")
    parsed = [materialize(CH.parse_relational(feed, spec)) for spec in CH.RELATIONAL.values()]
    return R.layer_counts({"raw.cdc_events": CH.audit_log(parsed[0]).unionByName(CH.audit_log(parsed[1])),
                           "ops.failed_events": CH.dead_letters(parsed[0]).unionByName(CH.dead_letters(parsed[1])),
                           "source.customers": FX.src_customers(spark, sf), "source.orders": FX.src_orders(spark, sf),
                           "clean.customers": cust, "clean.orders": orders,
                           "mart.daily_revenue": M.daily_revenue(orders, cust),
                           "mart.customer_summary": M.customer_summary(cust, orders)})


@register("report_object_layers", _with_tail(OBJ_MEMBERS + """
select 'clean_object_metadata' as layer, status, count(*) as row_count from meta_r group by status
union all select 'mart_object_summary_by_type', null, count(distinct media_type) from meta_r where status = 'ACTIVE'
union all select 'mart_object_storage_summary', null, 1"""))
def q_report_object_layers(spark, sf):
    """Object layers with per-status counts."""
    from . import reports as R
    meta = object_metadata_reconciled(spark, sf)
    return R.layer_counts({"clean_object_metadata": meta,
                           "mart_object_summary_by_type": M.object_summary_by_type(meta),
                           "mart_object_storage_summary": M.object_storage_summary(meta)},
                          status_col="status")


@register("report_latest_objects", _with_tail(OBJ_MEMBERS + """
select object_id, target_bucket, target_object_key, ingested_at from meta_r
order by ingested_at desc, object_id limit 5"""))
def q_report_latest_objects(spark, sf):
    """L6."""
    from . import reports as R
    return ntz(R.latest_objects(object_metadata_reconciled(spark, sf))
               .select("object_id", "target_bucket", "target_object_key", "ingested_at"))


@register("report_clean_samples", O.with_ctes("""
select 'clean_customer_profiles' as collection, min(_id) as sample_id from c_profiles
union all select 'clean_product_reviews', min(_id) from c_reviews
union all select 'clean_click_events', min(_id) from c_clicks"""))
def q_report_clean_samples(spark, sf):
    """One sample row per clean collection."""
    from . import reports as R
    return R.clean_samples({"clean_customer_profiles": clean_profiles(spark, sf),
                            "clean_product_reviews": clean_reviews(spark, sf),
                            "clean_click_events": clean_clicks(spark, sf)})


@register("report_failed_events", O.with_ctes(
    "select source_topic, source_partition, source_offset, message_key, error_message, retry_count from (" + DEAD_LETTERS_SQL
    + ") order by failed_at desc nulls last, source_topic desc, source_partition desc, source_offset desc limit 20"))
def q_report_failed_events(spark, sf):
    """L4: the 20 most recent dead letters."""
    from . import reports as R
    return R.last_failed_events(q_cdc_dead_letters_full(spark, sf)).select(
        "source_topic", "source_partition", "source_offset", "message_key", "error_message", "retry_count")


def q_cdc_dead_letters_full(spark, sf):
    from ..operators import changes as CH
    from ..sources import feeds as FD
    feed = change_feed(spark, sf, "relational")
    parts = [CH.dead_letters(CH.parse_relational(feed, spec), consumer_group="riverbed") for spec in CH.RELATIONAL.values()]
    return parts[0].unionByName(parts[1])


# ------------------------------------------------------------------ streaming
def run_relational_stream(spark, sf):
    """The relational feed arrives in three drops (snapshot,
    updates, deletes + bad messages) into a folder; after each drop a
    ``trigger(availableNow)`` run of the streaming pipeline processes what is
    new, restarting from its checkpoint.  Returns the pipeline."""
    import uuid

    from ..session import store_root
    from ..sources import feeds as FD
    from ..streaming import streams as ST
    root = store_root(spark, f"stream-{uuid.uuid4().hex}")
    feed = FD.relational_feed(spark, sf)
    drops = [F.col("offset") % 8 == 0, F.col("offset") % 8 == 1, F.col("offset") % 8 >= 2]
    pipe = ST.RelationalPipeline(spark, root)
    for cond in drops:
        spread(feed.where(cond)).write.mode("append").parquet(f"{root}/feed")
        q = pipe.start(ST.read_feed_files(spark, f"{root}/feed"), f"{root}/_checkpoint")
        q.awaitTermination()
    return pipe


def run_review_stream(spark, sf):
    """The review feed in three drops (snapshot, updates, deletes + bad and
    duplicate messages), each processed by an ``availableNow`` run."""
    import uuid

    from ..session import store_root
    from ..sources import feeds as FD
    from ..streaming import streams as ST
    root = store_root(spark, f"docstream-{uuid.uuid4().hex}")
    feed = FD.reviews_feed(spark, sf)
    pipe = ST.DocumentPipeline(spark, root)
    for cond in (F.col("offset") % 8 == 0, F.col("offset") % 8 == 1, F.col("offset") % 8 >= 2):
        spread(feed.where(cond)).write.mode("append").parquet(f"{root}/feed")
        pipe.start(ST.read_feed_files(spark, f"{root}/feed"), f"{root}/_checkpoint").awaitTermination()
    return pipe


@register("stream_reviews_available_now", O.with_ctes(
    "select _id, review_id, cast(customer_id as bigint) as customer_id, cast(product_id as bigint) as product_id, "
    "cast(rating as bigint) as rating, status, title, updated_at from f_reviews"))
def q_stream_reviews_available_now(spark, sf):
    """Current reviews in the document store after three streaming runs."""
    pipe = run_review_stream(spark, sf)
    return ntz(pipe.clean("product_reviews").select(
        "_id", "review_id", "customer_id", "product_id", "rating", "status", "title", "updated_at"))


@register("stream_review_mart_available_now", O.with_ctes("""
select cast(product_id as bigint) as product_id, count(*) as review_count, round_even(coalesce(avg(rating), 0), 3) as avg_rating,
  count(*) filter (where status = 'APPROVED') as approved_count,
  count(*) filter (where status = 'PENDING') as pending_count,
  count(*) filter (where status = 'REJECTED') as rejected_count,
  max(updated_at) as last_review_at
from f_reviews group by product_id"""))
def q_stream_review_mart_available_now(spark, sf):
    """Review mart maintained per micro-batch (M4) equals the full rebuild."""
    return ntz(run_review_stream(spark, sf).read_mart("product_review_summary"))


def object_messages(spark, sf) -> DataFrame:
    """Kafka-shaped object events (K15) as a written topic: the listing of the
    scan before, then the current one, so an object has two versions; then
    messages that must be dead-lettered.  Positions are sequence numbers."""
    from ..operators import objects as OB
    old, new = (OB.event_messages(OB.object_events(object_listing(spark, sf, previous=p))) for p in (True, False))
    bad = object_listing(spark, sf).where(F.regexp_extract("object_key", r"_(\d+)\.", 1).cast("bigint") % 53 == 0)
    key = F.regexp_extract("object_key", r"_(\d+)\.", 1)
    broken = bad.select(key.alias("key"), F.when(key.cast("bigint") % 2 == 0, F.concat(F.lit('{"object_id": "'), key))
                        .otherwise(F.concat(F.lit('{"object_id":"'), key, F.lit('","size_bytes":7}'))).alias("value"))
    parts = [m.select(F.lit("object.events").alias("topic"), F.spark_partition_id().alias("partition"),
                      (F.monotonically_increasing_id() + F.lit(drop << 60)).alias("offset"), "key", "value", F.lit(drop).alias("drop"))
             for drop, m in enumerate((old, new, broken))]
    return materialize(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def run_object_stream(spark, sf):
    """The object messages in three drops (the older listing, the current one,
    broken messages), each processed by an ``availableNow`` run."""
    import uuid

    from ..session import store_root
    from ..streaming import streams as ST
    root = store_root(spark, f"objstream-{uuid.uuid4().hex}")
    msgs = object_messages(spark, sf)
    pipe = ST.ObjectPipeline(spark, root, batch_ts=lambda _bid: BATCH_TS)
    for drop in range(3):
        msgs.where(F.col("drop") == drop).drop("drop").write.mode("append").parquet(f"{root}/feed")
        pipe.start(ST.read_feed_files(spark, f"{root}/feed"), f"{root}/_checkpoint").awaitTermination()
    return pipe


@register("stream_object_summary_available_now", _with_tail(OBJ_MEMBERS + """
select media_type, count(*) as total_objects, cast(sum(size_bytes) as bigint) as total_size_bytes,
  round_even(coalesce(avg(size_bytes), 0), 3) as avg_size_bytes, timestamp '2024-06-01 00:00:00' as latest_ingested_at
from meta group by media_type"""))
def q_stream_object_summary_available_now(spark, sf):
    """M5: object marts rebuilt per micro-batch from the streamed metadata
    (before any reconcile, every valid object is ACTIVE)."""
    return ntz(run_object_stream(spark, sf).read_mart("object_summary_by_type"))


@register("stream_orders_available_now", O.with_ctes("select * from f_orders"))
def q_stream_orders_available_now(spark, sf):
    """Current orders in the versioned store after three streaming runs."""
    from ..operators import changes as CH
    pipe = run_relational_stream(spark, sf)
    return ntz(CH.current(pipe.state("orders"), CH.RELATIONAL["orders"]))


@register("stream_revenue_available_now", O.with_ctes(
    DAILY_REVENUE_SQL.replace("c_orders", "f_orders").replace("c_customers", "f_customers")))
def q_stream_revenue_available_now(spark, sf):
    """The incrementally maintained revenue mart after the streaming runs
    equals the full rebuild over the final state (T4: late rows heal)."""
    pipe = run_relational_stream(spark, sf)
    return pipe.read_mart("daily_revenue")


# ------------------------------------------- ordering, keys, raw layers, replay
@register("cdc_partition_growth", O.with_ctes("select * from f_orders"))
def q_cdc_partition_growth(spark, sf):
    """A topic that was given other partitions between the snapshot and the
    changes: a key's later events lie in lower partitions than its first."""
    from ..operators import changes as CH
    feed = change_feed(spark, sf, "relational")
    moved = feed.withColumn("partition", F.when(F.col("offset") % 8 == 0, F.col("partition") + 8).otherwise(F.col("partition")))
    return ntz(CH.current(_orders_state(spark, sf, moved), CH.RELATIONAL["orders"]))


@register("cdc_clock_skew", O.with_ctes("select * from f_orders"))
def q_cdc_clock_skew(spark, sf):
    """Three batches of a feed whose source times are missing, equal or
    falling and whose keys partly moved to other partitions with their changes;
    the third batch delivers the whole first one again."""
    from ..operators import changes as CH
    feed, k, seq = change_feed(spark, sf, "relational"), F.floor(F.col("offset") / 8), F.col("offset") % 8
    time = F.when(k % 4 == 0, "null").when(k % 4 == 1, "0").when(k % 4 == 2, (100 - seq).cast("string"))
    skewed = F.when(time.isNotNull(), F.regexp_replace("value", F.lit('"ts_ms":[0-9]+'), F.concat(F.lit('"ts_ms":'), time))).otherwise(F.col("value"))
    moved = F.when((k % 5 == 0) & (seq > 0), F.col("partition") + 8).otherwise(F.col("partition"))
    feed = materialize(feed.withColumns({"value": skewed, "partition": moved}))
    spec, state = CH.RELATIONAL["orders"], None
    for cut in (seq == 0, seq == 1, seq != 1):
        state = materialize(CH.fold(CH.keyed_changes(CH.parse_relational(feed.where(cut), spec), spec), state))
    return ntz(CH.current(state, spec))


KEY_RELEASE_SQL = f"""
with k as (select o_orderkey as k, cast(o_orderkey as varchar) as own, cast(o_orderkey as varchar) || '-2' as other from orders),
live as (
  select concat('a', lpad(lower(hex(k)), 23, '0')) as _id, other as review_id from k where k % 3 = 0
  union all select concat('b', lpad(lower(hex(k)), 23, '0')), own from k where k % 3 <> 2
  union all select concat('a', lpad(lower(hex(k)), 23, '0')), own from k where k % 3 = 2
  union all select concat('b', lpad(lower(hex(k)), 23, '0')), other from k where k % 3 = 2),
dead as (
  select cast(k % 4 as integer) as p, k * 8 + 1 as o from k where k % 3 = 1
  union all select cast(k % 4 as integer), k * 8 + 2 from k where k % 3 = 2
  union all select cast(k % 4 as integer), k * 8 + 3 from k where k % 3 = 2)
select b.batches, 'live' as kind, _id, review_id, cast(null as integer) as source_partition, cast(null as bigint) as source_offset
from live, (values ('one'), ('many')) b(batches)
union all select b.batches, 'dead', null, null, p, o from dead, (values ('one'), ('many')) b(batches)
"""


@register("cdc_key_release", KEY_RELEASE_SQL)
def q_cdc_key_release(spark, sf):
    """Q14: keys released by updates and deletes and claims of held ones, with
    the same answer for the feed in one batch and in four."""
    return _claims_in_batches(change_feed(spark, sf, "releases"),
                              (("one", [F.lit(True)]), ("many", [F.col("offset") % 8 == s for s in range(4)])))


KEY_CHAIN_SQL = """
with k as (select o_orderkey as k, o_orderkey // 1024 as chain, o_orderkey % 1024 as pos from orders),
e as (select k.*, n.k is not null and k.chain % 2 = 1 as lost, concat('c', lpad(lower(hex(k.k)), 23, '0')) as _id
      from k left join k n on n.k = k.k + 1 and n.chain = k.chain)
select b.batches, 'live' as kind, _id, chain || '-' || case when lost then pos else pos + 1 end as review_id,
  cast(null as integer) as source_partition, cast(null as bigint) as source_offset
from e, (values ('one'), ('many')) b(batches)
union all
select b.batches, 'dead', null, null, cast(chain % 4 as integer), cast(chain * 4096 + 2048 + pos as bigint)
from e, (values ('one'), ('many')) b(batches) where lost
"""


@register("cdc_key_chain", KEY_CHAIN_SQL)
def q_cdc_key_chain(spark, sf):
    """Q14: chains of up to 1,024 reviews that each move to the next one's
    business key.  In every other chain the last moves first, so that each
    move needs the one before; in the others each key is still held."""
    feed = change_feed(spark, sf, "chains")
    return _claims_in_batches(feed, (("one", [F.lit(True)]), ("many", [F.col("offset") % 4096 < 2048, F.col("offset") % 4096 >= 2048])))


def _claims_in_batches(feed, ways) -> DataFrame:
    """Live reviews and dead letters of a feed, for each way to cut it into batches."""
    from ..operators import changes as CH
    out = []
    # no table carries columns that neither the claims nor the dead letters nor the result read
    columns = ["_id", "review_id"]
    for name, cuts in ways:
        state = None
        for cut in cuts:
            parsed = materialize(CH.parse_documents(feed.where(cut), "product_reviews").select(
                *CH.CLAIM_COLUMNS, "key_text", "value_text", "review_id"))
            parsed = materialize(CH.slim(CH.reject_duplicate_keys(parsed, "product_reviews", state), []))
            out.append(CH.dead_letters(parsed).select(
                F.lit(name).alias("batches"), F.lit("dead").alias("kind"), F.lit(None).cast("string").alias("_id"),
                F.lit(None).cast("string").alias("review_id"), "source_partition", "source_offset"))
            state = materialize(CH.fold(CH.document_changes(parsed, columns, raw=False), state))
        out.append(state.where(~F.col("_deleted")).select(
            F.lit(name).alias("batches"), F.lit("live").alias("kind"), "_id", "review_id",
            F.lit(None).cast("int").alias("source_partition"), F.lit(None).cast("bigint").alias("source_offset")))
    done = out[0]
    for o in out[1:]:
        done = done.unionByName(o)
    return done


def _documents_state(spark, sf, kind: str, collection: str) -> DataFrame:
    from ..operators import changes as CH
    parsed = materialize(CH.parse_documents(change_feed(spark, sf, kind), collection))
    parsed = CH.reject_duplicate_keys(parsed, collection)
    return CH.fold(CH.document_changes(parsed, CH.DOC_COLUMNS[collection], BATCH_TS)).where(~F.col("_deleted"))


@register("cdc_current_profiles", O.with_ctes(
    "select _id, customer_id, full_name, country, category, newsletter, price_sensitivity, tier, cast(points as bigint) as points, "
    "devices from f_profiles"))
def q_cdc_current_profiles(spark, sf):
    """K5: current profile documents after their change feed."""
    return _documents_state(spark, sf, "profiles", "customer_profiles").select(
        "_id", "customer_id", "full_name", "country", F.col("preferences.category").alias("category"),
        F.col("preferences.newsletter").alias("newsletter"), F.col("preferences.price_sensitivity").alias("price_sensitivity"),
        F.col("loyalty.tier").alias("tier"), F.col("loyalty.points").alias("points"), F.array_join("devices", ",").alias("devices"))


@register("cdc_current_clicks", O.with_ctes(
    "select _id, event_id, customer_id, cast(product_id as bigint) as product_id, event_type, session_id, user_agent, referrer, page, "
    "event_time from f_clicks"))
def q_cdc_current_clicks(spark, sf):
    """K5: current click documents after their change feed."""
    return ntz(_documents_state(spark, sf, "clicks", "click_events").select(
        "_id", "event_id", "customer_id", "product_id", "event_type", "session_id", F.col("metadata.user_agent").alias("user_agent"),
        F.col("metadata.referrer").alias("referrer"), F.col("metadata.page").alias("page"), "event_time"))


@register("cdc_raw_documents", O.with_ctes("""
select _id, 'extra-' || review_id as note, review_id, 'mongodb' as source_type, 'shop.reviewsdb.product_reviews' as source_topic,
  cast(cast(review_id as bigint) % 4 as integer) as source_partition, 'reviewsdb' as source_database,
  'product_reviews' as source_collection, timestamp '2024-06-01 00:00:00' as synced_at
from f_reviews"""))
def q_cdc_raw_documents(spark, sf):
    """K4 + P8 + P16: the raw collection keeps members that no cleaner names,
    and the metadata of each document's last change."""
    from ..operators import changes as CH
    parsed = CH.parse_documents(change_feed(spark, sf, "reviews"), "product_reviews")
    # the raw collection keeps documents as they came: of the cleaned columns only the business key is read on
    parsed = materialize(parsed.select(*CH.CLAIM_COLUMNS, "review_id", "source_db", "source_collection", "_doc"))
    parsed = CH.reject_duplicate_keys(parsed, "product_reviews")
    raw = CH.raw_documents(CH.fold(CH.document_changes(parsed, [], BATCH_TS)))
    return ntz(raw.select(
        "_id", F.get_json_object("document", "$.note").alias("note"), F.get_json_object("document", "$.review_id").alias("review_id"),
        *[F.col(f"_cdc.{c}").alias(c) for c in ("source_type", "source_topic", "source_partition", "source_database",
                                                "source_collection", "synced_at")]))


OFFSETS_SQL = """
select topic as source_topic, cast(id % 4 as integer) as source_partition, cast(id * 8 + seq as bigint) as source_offset, 
  case when seq = 0 then 0 else 1 end as first_batch
from (select 'shop.public.customers' as topic, id, 0 as seq from src_customers
  union all select 'shop.public.customers', id, 1 from src_customers where id % 5 = 0
  union all select 'shop.public.orders', id, 0 from src_orders
  union all select 'shop.public.orders', id, 1 from src_orders where id % 3 = 0
  union all select 'shop.public.orders', id, unnest([2, 3]) from src_orders where id % 9 = 0
  union all select 'shop.public.orders', id, 4 from src_orders where id % 1009 = 7
  union all select 'shop.public.orders', id, 5 from src_orders where id % 97 = 13)
"""


@register("offset_ledger", O.with_ctes(OFFSETS_SQL))
def q_offset_ledger(spark, sf):
    """K7: a batch, then one that delivers all of it again beside new messages;
    each position is in the ledger once, from the batch that handled it first."""
    from ..operators import changes as CH
    feed = change_feed(spark, sf, "relational")
    first = CH.offset_ledger(feed.where(F.col("offset") % 8 == 0)).withColumn("first_batch", F.lit(0))
    known = first.drop("first_batch")
    return first.unionByName(CH.offset_ledger(feed, known).withColumn("first_batch", F.lit(1)))


OFFSET_RANGES_SQL = O.with_ctes("""
select topic, partition, min(o) as first, max(o) as last from (
  select topic, partition, o, o - row_number() over (partition by topic, partition order by o) as run from (
    select source_topic as topic, source_partition as partition, rn + case when rn >= 5000 then 100 else 0 end as o
    from (select *, row_number() over (partition by source_topic, source_partition order by source_offset) - 1 as rn from ("""
    + OFFSETS_SQL + """) )
    where rn % 1000 <> 500))
group by topic, partition, run
""")


@register("offset_ranges", OFFSET_RANGES_SQL)
def q_offset_ranges(spark, sf):
    """The ledger of handled offsets as ranges, after batches that
    overlap and one that delivers everything again, over a feed with gaps; a
    message comes through in the first batch that brings it only."""
    import uuid

    from ..operators import offsets as OF
    from ..session import store_root
    from ..streaming import streams as ST
    feed = OF.numbered(change_feed(spark, sf, "relational"), "rn").where(F.col("rn") % 1000 != 500)
    feed = materialize(feed.withColumn("offset", (F.col("rn") + F.when(F.col("rn") >= 5000, 100).otherwise(0)).cast("bigint")).drop("rn"))
    through = []

    class Ledger(ST.Pipeline):
        def _process(self, feed, batch_id, tag, before, doc):
            through.append(feed.count())

    pipe = Ledger(spark, store_root(spark, f"ledger-{uuid.uuid4().hex}"))
    for n, cut in enumerate((F.col("offset") < 3000, F.col("offset").between(2000, 5999), F.lit(True))):
        pipe.process(feed.where(cut), n)
    if sum(through) != feed.count():
        raise AssertionError(f"{sum(through)} messages came through")
    return pipe.handled_offsets()


class _Killed(Exception):
    pass


@register("stream_revenue_after_failure", O.with_ctes(
    DAILY_REVENUE_SQL.replace("c_orders", "f_orders").replace("c_customers", "f_customers")))
def q_stream_revenue_after_failure(spark, sf):
    """A batch's attempt dies after each of its writes in turn and is
    replayed; after every death readers still see the batch before, and in the
    end the marts equal the rebuild."""
    import uuid

    from ..session import store_root
    from ..streaming import streams as ST
    feed = change_feed(spark, sf, "relational")
    pipe = ST.RelationalPipeline(spark, store_root(spark, f"failing-{uuid.uuid4().hex}"))
    for batch_id, cut in enumerate((F.col("offset") % 8 == 0, F.col("offset") % 8 == 1, F.col("offset") % 8 >= 2)):
        batch, seen = feed.where(cut), pipe.commits.latest()
        for step in ("raw/cdc_events", "merge customers", "merge orders", "mart daily_revenue", "mart customer_summary") \
                if batch_id == 1 else ():
            def kill(done, at=step):
                if done == at:
                    raise _Killed(done)
            pipe.after = kill
            try:
                pipe.process(batch, batch_id)
                raise AssertionError(f"{step} was not reached")
            except _Killed:
                pipe.after = lambda done: None
            if pipe.commits.latest() != seen:
                raise AssertionError(f"a batch that died at {step} is visible")
        pipe.process(batch, batch_id)
        pipe.process(batch, batch_id)                       # a replay after the commit changes nothing
    return pipe.read_mart("daily_revenue")


@register("stream_dlq_messages", O.with_ctes(
    "select 'cdc.dlq' as topic, message_key as key, source_topic, source_partition, source_offset, error_message, "
    "source_topic || '/' || source_partition || '/' || source_offset as position from (" + DEAD_LETTERS_SQL + ")"))
def q_stream_dlq_messages(spark, sf):
    """The dead-letter topic holds each letter once, keyed like its
    message, after a batch whose attempts died at either sink and after it."""
    import uuid

    from ..session import store_root
    from ..streaming import streams as ST
    feed = change_feed(spark, sf, "relational")
    pipe = ST.RelationalPipeline(spark, store_root(spark, f"letters-{uuid.uuid4().hex}"))
    for batch_id, cut in enumerate((F.col("offset") % 8 == 0, F.col("offset") % 8 > 0)):
        for step in ("ops/failed_events", "dlq", "merge orders") if batch_id else ():
            def kill(done, at=step):
                if done == at:
                    raise _Killed(done)
            pipe.after = kill
            try:
                pipe.process(feed.where(cut), batch_id)
                raise AssertionError(f"{step} was not reached")
            except _Killed:
                pipe.after = lambda done: None
        pipe.process(feed.where(cut), batch_id)
    member = lambda name: F.get_json_object("value", f"$.{name}")
    place = F.filter("headers", lambda h: h["key"] == "position")[0]["value"].cast("string")
    return pipe.dead_letter_topic().select(
        "topic", "key", member("source_topic").alias("source_topic"), member("source_partition").cast("int").alias("source_partition"),
        member("source_offset").cast("bigint").alias("source_offset"), member("error_message").alias("error_message"), place.alias("position"))


@register("stream_change_detect", _with_tail(FINGERPRINT_SQL.replace(
    "select c.bucket, c.object_key, case when", "select cast(2 as bigint) as scan, c.bucket, c.object_key, case when", 1)
    + "union all select 0, bucket, object_key, 'new' from fp_prev"))
def q_stream_change_detect(spark, sf):
    """Three scans of the source buckets arrive, each taken in by a
    detector started anew: all objects are new, nothing changed, then what
    differs from the scans before."""
    import uuid

    from ..session import store_root
    from ..streaming import streams as ST
    root = store_root(spark, f"scans-{uuid.uuid4().hex}")
    for n, previous in enumerate((True, True, False)):
        scan = object_listing(spark, sf, previous).withColumn("scan", F.lit(n).cast("bigint"))
        scan.select(*[c.split()[0] for c in ST.LISTING_SCHEMA.split(", ")]).write.mode("append").parquet(f"{root}/feed")
        pipe = ST.ListingPipeline(spark, root)
        pipe.start(ST.read_feed_files(spark, f"{root}/feed", schema=ST.LISTING_SCHEMA), f"{root}/_checkpoint").awaitTermination()
    return pipe.changes().select("scan", "bucket", "object_key", "change_kind")


def run_document_stream(spark, sf):
    """All three collections through one pipeline in three drops."""
    import uuid

    from ..session import store_root
    from ..sources import feeds as FD
    from ..streaming import streams as ST
    root = store_root(spark, f"docsstream-{uuid.uuid4().hex}")
    feed = materialize(FD.reviews_feed(spark, sf).unionByName(FD.profiles_feed(spark, sf)).unionByName(FD.clicks_feed(spark, sf)))
    pipe = ST.DocumentPipeline(spark, root, ["customer_profiles", "click_events", "product_reviews"])
    for cond in (F.col("offset") % 8 == 0, F.col("offset") % 8 == 1, F.col("offset") % 8 >= 2):
        spread(feed.where(cond)).write.mode("append").parquet(f"{root}/feed")
        pipe.start(ST.read_feed_files(spark, f"{root}/feed"), f"{root}/_checkpoint").awaitTermination()
    return pipe


@register("doc_engagement_incremental", _with_tail(
    ENGAGEMENT_SQL.replace("c_profiles", "f_profiles").replace("c_clicks", "f_clicks").replace("c_reviews", "f_reviews")))
def q_doc_engagement_incremental(spark, sf):
    """M4 + A6: the engagement mart kept per micro-batch over three collections."""
    return ntz(run_document_stream(spark, sf).read_mart("customer_engagement_summary"))


@register("doc_country_incremental", O.with_ctes("""
select country, count(*) as profile_count, count(*) filter (where tier = 'GOLD') as gold_customers,
  count(*) filter (where newsletter) as newsletter_opt_in
from f_profiles group by country"""))
def q_doc_country_incremental(spark, sf):
    """M4 + A7: the country mart kept per micro-batch."""
    return run_document_stream(spark, sf).read_mart("country_profile_summary")


@register("obj_raw_events", _with_tail(OBJ_MEMBERS + """
select event_id, object_id, etag from ev where size_bytes > 0
union all
select sha256(concat_ws('|', bucket, object_key, coalesce(etag, ''), cast(size_bytes as varchar),
    strftime(make_timestamp(last_modified_ms * 1000), '%Y-%m-%dT%H:%M:%S+00:00'))), sha256(concat_ws('|', bucket, object_key)), etag
from (select case doc_id % 4 when 0 then 'raw-images' when 1 then 'raw-videos' when 2 then 'raw-audio' else 'raw-documents' end as bucket,
    concat(lang, '/', source, '/doc_', cast(doc_id as varchar), case doc_id % 4 when 0 then '.PNG'
      when 1 then '.mp4' when 2 then '.wav' else '.txt' end) as object_key,
    case when doc_id % 37 = 0 then 0 else n_chars end as size_bytes, 1704067200000 + doc_id * 1000 as last_modified_ms,
    md5(concat(text, '#v0')) as etag from documents where doc_id % 17 <> 0 and doc_id % 11 = 0)
where size_bytes > 0"""))
def q_obj_raw_events(spark, sf):
    """K6: raw object events by event id: both versions of a changed object,
    an unchanged one's event once however often it is listed."""
    return run_object_stream(spark, sf).state("raw_events").select(
        F.col("pk").alias("event_id"), F.get_json_object("event", "$.object_id").alias("object_id"),
        F.get_json_object("event", "$.etag").alias("etag"))


@register("stream_object_updates", _with_tail(OBJ_MEMBERS + "select object_id, event_id, etag, size_bytes, media_type, status from meta"))
def q_stream_object_updates(spark, sf):
    """The newer of two versions of each object is current after the stream."""
    return run_object_stream(spark, sf).state("object_metadata").select(
        "object_id", "event_id", "etag", "size_bytes", "media_type", "status")


DOC_SNAPSHOT_SQL = O.with_ctes("""
select scan, _id, review_id, cast(customer_id as bigint) as customer_id, cast(product_id as bigint) as product_id,
  cast(rating as bigint) as rating, status, title, updated_at
from c_reviews, (values ('all'), ('range'), ('keys')) s(scan)
where scan = 'all' or (scan = 'range' and _id >= lpad('1000', 24, '0') and _id < lpad('2000', 24, '0'))
  or (scan = 'keys' and _id in (lpad('7', 24, '0'), lpad('20', 24, '0')))
""")


@register("doc_snapshot_scan", DOC_SNAPSHOT_SQL)
def q_doc_snapshot_scan(spark, sf):
    """A collection's snapshot of Extended-JSON lines in key order, read
    whole, by a range of keys and by two keys, and cleaned."""
    import uuid

    from ..session import store_root
    from ..sources import collection as CO
    from ..sources import documents as D
    path = store_root(spark, f"snapshot-{uuid.uuid4().hex}")
    src = FX.src_reviews(spark, sf)
    CO.write_snapshot(src.select(D.review_json(src).alias("line")), path)
    scans = {"all": CO.read_collection(spark, path), "range": CO.read_collection(spark, path, "1000".zfill(24), "2000".zfill(24)),
             "keys": CO.read_collection(spark, path, keys=["7".zfill(24), "20".zfill(24)])}
    parts = [SN.good(C.DOC_CLEANERS["product_reviews"](d.select(F.col("document").alias("doc")))).select(
        F.lit(name).alias("scan"), "_id", "review_id", "customer_id", "product_id", "rating", "status", "title", "updated_at")
        for name, d in scans.items()]
    return ntz(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def _object_buckets(spark, sf):
    """Buckets of files: a source file per document, and what an earlier copy
    left in the clean buckets.  -> (source folders, target folders)"""
    import uuid

    from ..session import store_root
    root = store_root(spark, f"buckets-{uuid.uuid4().hex}")
    return (FX.write_objects(FX.object_contents(spark, sf), f"{root}/source"),
            FX.write_objects(FX.object_contents(spark, sf, stale_targets=True), f"{root}/target"))


@register("obj_listing", """
select 'source' as side, case k % 4 when 0 then 'raw-images' when 1 then 'raw-videos' when 2 then 'raw-audio' else 'raw-documents' end as bucket,
  lang || '/' || source || '/doc_' || k || case k % 4 when 0 then '.PNG' when 1 then '.mp4' when 2 then '.wav' else '.txt' end as object_key,
  cast(strlen(text) as bigint) as size_bytes, md5(text) as etag
from (select doc_id as k, lang, source, coalesce(text, '') as text from documents)
union all
select 'target', case k % 4 when 0 then 'clean-images' when 1 then 'clean-videos' when 2 then 'clean-audio' else 'clean-documents' end,
  lang || '/' || source || '/doc_' || k || case k % 4 when 0 then '.PNG' when 1 then '.mp4' when 2 then '.wav' else '.txt' end,
  cast(strlen(t) as bigint), md5(t)
from (select doc_id as k, lang, source, case when doc_id % 29 = 0 then repeat('x', strlen(coalesce(text, '')))
        when doc_id % 31 = 0 then coalesce(text, '')[1:5] else coalesce(text, '') end as t
      from documents where doc_id % 23 <> 0)
""")
def q_obj_listing(spark, sf):
    """The files of source and target buckets, listed by tasks; a
    source bucket that is not there is passed over."""
    from ..sources import listing as LS
    source, target = _object_buckets(spark, sf)
    sides = {"source": LS.object_inventory(spark, source | {"raw-gone": next(iter(source.values())) + "-gone"}, skip_missing=True, with_etag=True),
             "target": LS.object_inventory(spark, target, with_etag=True)}
    parts = [d.select(F.lit(side).alias("side"), "bucket", "object_key", "size_bytes", "etag") for side, d in sides.items()]
    return parts[0].unionByName(parts[1])


@register("obj_copy_verified", """
select run, case k % 4 when 0 then 'clean-images' when 1 then 'clean-videos' when 2 then 'clean-audio' else 'clean-documents' end as target_bucket,
  lang || '/' || source || '/doc_' || k || case k % 4 when 0 then '.PNG' when 1 then '.mp4' when 2 then '.wav' else '.txt' end as target_object_key,
  cast(strlen(text) as bigint) as size_bytes, md5(text) as etag,
  run = 1 and (k % 23 = 0 or md5(case when k % 29 = 0 then repeat('x', strlen(text)) when k % 31 = 0 then text[1:5] else text end) <> md5(text)) as copied,
  true as verified
from (select doc_id as k, lang, source, coalesce(text, '') as text from documents where strlen(text) > 0), (values (1), (2)) r(run)
""")
def q_obj_copy_verified(spark, sf):
    """The objects that the source listing gives are cleaned and copied
    where their copy is absent or differs, then listed and held against their
    size and etag; a second run finds nothing to copy."""
    from ..operators import copying as CP
    from ..operators import objects as OB
    from ..sources import listing as LS
    source, target = _object_buckets(spark, sf)
    found = LS.object_inventory(spark, source, skip_missing=True, with_etag=True).withColumn("content_type", F.lit(None).cast("string"))
    meta = materialize(SN.good(C.clean_object_events(OB.object_events(found), BATCH_TS)))
    runs = [CP.copy_verified(spark, meta, source, target).withColumn("run", F.lit(n)) for n in (1, 2)]
    return runs[0].unionByName(runs[1]).select("run", "target_bucket", "target_object_key", "size_bytes", "etag", "copied", "verified")


@register("obj_dead_letters", O.with_ctes("""
select 'object.events' as source_topic, message_key, error_message, message_value, 'riverbed' as consumer_group,
  timestamp '2024-06-01 00:00:00' as failed_at
from (
  select sha256(concat_ws('|', bucket, object_key)) as message_key, 'object size is not positive' as error_message, cast(null as varchar) as message_value
    from src_objects where size_bytes <= 0
  union all select sha256(concat_ws('|', bucket, object_key)), 'object size is not positive', null
    from src_objects, (select 1) where size_bytes <= 0 and cast(regexp_extract(object_key, '_([0-9]+)[.]', 1) as bigint) % 17 <> 0
  union all select cast(doc_id as varchar),
      case when doc_id % 2 = 0 then 'malformed JSON value' else 'object event lacks an identifier' end,
      case when doc_id % 2 = 0 then '{"_raw":"{\\"object_id\\": \\"' || cast(doc_id as varchar) || '"}'
        else '{"object_id":"' || cast(doc_id as varchar) || '","size_bytes":7}' end
    from documents where doc_id % 53 = 0)"""))
def q_obj_dead_letters(spark, sf):
    """E1 + E2 for object events: empty objects, broken JSON and events
    without identifiers; the value of the two latter is compared too."""
    dead = run_object_stream(spark, sf).read_log("ops/failed_events")
    return ntz(dead.select(
        "source_topic", "message_key", "error_message",
        F.when(F.col("error_message") != C.ERR_SIZE, F.col("message_value")).alias("message_value"), "consumer_group", "failed_at"))


@register("obj_reconcile_metrics", _with_tail(OBJ_MEMBERS + """
select metric_name, cast(metric_value as bigint) as metric_value from (
  select 'raw_object_events_count' as metric_name, count(*) as metric_value from ev
  union all select 'active_object_count', count(*) filter (where status = 'ACTIVE') from meta_r
  union all select 'missing_object_count', count(*) filter (where status = 'MISSING') from meta_r
  union all select 'mart_object_summary_by_type_rows', count(distinct media_type) filter (where status = 'ACTIVE') from meta_r
  union all select 'mart_object_summary_by_day_rows', count(distinct ingested_day) filter (where status = 'ACTIVE') from meta_r
  union all select 'mart_object_storage_summary_rows', 1)"""))
def q_obj_reconcile_metrics(spark, sf):
    """Raw, status and mart row counts beside the reconcile counts."""
    from ..operators import objects as OB
    from ..operators import quality as Q
    one = F.count(F.lit(1))
    meta = object_metadata_reconciled(spark, sf)
    return Q.union_all([
        Q.metrics_long(OB.object_events(object_listing(spark, sf)), {"raw_object_events_count": one}),
        Q.metrics_long(meta, {"active_object_count": F.count_if(F.col("status") == "ACTIVE"),
                              "missing_object_count": F.count_if(F.col("status") == "MISSING")}),
        Q.metrics_long(M.object_summary_by_type(meta), {"mart_object_summary_by_type_rows": one}),
        Q.metrics_long(M.object_summary_by_day(meta), {"mart_object_summary_by_day_rows": one}),
        Q.metrics_long(M.object_storage_summary(meta), {"mart_object_storage_summary_rows": one})])


@register("report_mart_days", _with_tail(OBJ_MEMBERS + """
select ingested_day, count(*) as total_objects, cast(sum(size_bytes) as bigint) as total_size_bytes
from meta_r where status = 'ACTIVE' group by ingested_day order by ingested_day desc limit 5"""))
def q_report_mart_days(spark, sf):
    """The last five days of the object mart."""
    from . import reports as R
    return R.last_mart_days(M.object_summary_by_day(object_metadata_reconciled(spark, sf)), "ingested_day")


@register("report_document_layers", O.with_ctes("""
select 'raw_customer_profiles' as layer, cast(null as varchar) as status, count(*) as row_count from src_profiles
union all select 'raw_product_reviews', null, count(*) from src_reviews
union all select 'raw_click_events', null, count(*) from src_clicks
union all select 'clean_customer_profiles', null, count(*) from c_profiles
union all select 'clean_product_reviews', status, count(*) from c_reviews group by status
union all select 'clean_click_events', null, count(*) from c_clicks"""))
def q_report_document_layers(spark, sf):
    """Rows of the document layers, reviews by status."""
    from . import reports as R
    L = _document_layers(spark, sf)
    tables = {f"raw_{n}": L[n][1] for n in L} | {f"clean_{n}": L[n][2] for n in L}
    return R.layer_counts(tables, status_col="status")


# ---------------------------------------------------------------- run ledger
def _score_sql(sql: str, job: str) -> str:
    return f"select '{job}' as job_name, status, dq_issue_count from ({sql})"


@register("report_runs", " union all ".join([
    _score_sql(ORACLE["rel_dq_score"], "relational_reconcile"),
    _score_sql(ORACLE["doc_dq_score"], "document_reconcile"),
    _score_sql(ORACLE["obj_dq_score"].replace(
        "count(*) filter (where presence <> 'both' or size_mismatch) as dq_issue_count",
        "count(*) filter (where presence <> 'both' or size_mismatch) as dq_issue_count, "
        "case when count(*) filter (where presence <> 'both' or size_mismatch) = 0 then 'SUCCESS' "
        "else 'SUCCESS_WITH_WARNINGS' end as status"), "object_reconcile")]))
def q_report_runs(spark, sf):
    """R12 + L3/L5: the three reconcile jobs run through the ledger (RUNNING,
    then SUCCESS / SUCCESS_WITH_WARNINGS by DQ score); report the latest runs.
    Each job's score is a one-row metric, the only thing brought to the driver."""
    import uuid

    from ..operators import ledger as L
    from ..session import store_root
    from . import reports as R
    path = store_root(spark, f"ledger-{uuid.uuid4().hex}")

    def job(query):
        def run():
            row = query(spark, sf).first()
            return row.asDict(), int(row["dq_issue_count"])
        return run
    for name, q in (("relational_reconcile", q_rel_dq_score), ("document_reconcile", q_doc_dq_score),
                    ("object_reconcile", q_obj_dq_score)):
        L.run_job(spark, path, name, job(q))
    return R.last_runs(L.runs_view(L.read_ledger(spark, path))).select(
        "job_name", "status", F.col("dq_issue_count").cast("bigint").alias("dq_issue_count"))


@register("report_last_runs", " union all ".join(f"""
select '{job}' as job_name, n, case when 7 - n = 3 then 'FAILED' when (7 - n) % 2 = 1 then 'SUCCESS_WITH_WARNINGS' else 'SUCCESS' end as status,
  case when 7 - n = 3 then 0 else (7 - n) % 2 end as dq_issue_count,
  case when 7 - n = 3 then '{{}}' else '{{"rows": ' || (select count(*) from {table} where {key} % (7 - n) = 0) || '}}' end as metrics,
  case when 7 - n = 3 then 'source unreachable' end as error_message, true as finished, true as duration_fits
from (select unnest(range(1, 6)) as n)""" for job, table, key in (("document_reconcile", "documents", "doc_id"),
                                                                  ("object_reconcile", "pages", "page_id"))))
def q_report_last_runs(spark, sf):
    """The last five of six runs of the document and the object
    job, one of which failed, with all that the ledger keeps of a run."""
    import uuid

    from ..operators import ledger as L
    from ..session import store_root
    from . import reports as R
    path = store_root(spark, f"runs-{uuid.uuid4().hex}")

    def job(table: str, key: str, run: int):
        def count():
            if run == 3:
                raise RuntimeError("source unreachable")
            return {"rows": FX.read_table(spark, sf, table).where(F.col(key) % run == 0).count()}, run % 2
        return count

    for run in range(1, 7):
        for name, table, key in (("document_reconcile", "documents", "doc_id"), ("object_reconcile", "pages", "page_id")):
            try:
                L.run_job(spark, path, name, job(table, key, run))
            except RuntimeError:
                if run != 3:
                    raise
    runs = materialize(L.runs_view(L.read_ledger(spark, path)))
    newest = R.last_runs_by_job(runs).select("batch_id")
    order = Window.partitionBy("job_name").orderBy(F.desc("started_at"))
    took = F.unix_micros("finished_at") - F.unix_micros("started_at")
    return runs.join(newest, "batch_id", "left_semi").select(
        "job_name", F.row_number().over(order).cast("bigint").alias("n"), "status", F.col("dq_issue_count").cast("bigint").alias("dq_issue_count"),
        "metrics", "error_message", (F.col("finished_at") >= F.col("started_at")).alias("finished"),
        (F.abs(F.col("duration_seconds") * 1e6 - took) <= 1000).alias("duration_fits"))


@register("cdc_raw_dates", O.with_ctes("""
select id, case id % 6 when 0 then strftime(make_timestamp(order_date * 1000), '%Y-%m-%d')
    when 1 then strftime(make_timestamp(order_date * 1000), '%Y-%m-%d') when 2 then strftime(make_timestamp(order_date * 1000), '%d.%m.%Y')
    when 3 then strftime(make_timestamp(order_date * 1000), '%Y-%m-%d') end as raw_date
from src_orders"""))
def q_cdc_raw_dates(spark, sf):
    """the order date of raw images that come as bytes, spelled as
    epoch milliseconds, ISO text with an offset, another text (its first 10
    characters), ISO text without dashes, a short text, and a boolean."""
    from ..functions import envelope as EV
    from ..functions import variant as V
    when, k = F.timestamp_millis("order_date"), F.col("id") % 6
    text = lambda f: F.concat(F.lit('"'), F.date_format(when, f), F.lit('"'))
    raw = (F.when(k == 0, F.col("order_date").cast("string")).when(k == 1, text("yyyy-MM-dd'T'HH:mm:ss'+09:00'"))
           .when(k == 2, text("dd.MM.yyyy HH:mm")).when(k == 3, text("yyyyMMdd")).when(k == 4, F.lit('"soon"')).otherwise(F.lit("true")))
    value = F.concat(F.lit('{"op":"c","after":{"id":'), F.col("id").cast("string"), F.lit(',"order_date":'), raw, F.lit("}}"))
    feed = FX.src_orders(spark, sf).select(
        F.lit("shop.public.orders").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.encode(F.lit("{}"), "UTF-8").alias("key"), F.encode(value, "UTF-8").alias("value"))
    image = EV.parse_envelope(feed).select("after")
    return image.select(F.try_variant_get("after", "$.id", "bigint").alias("id"), V.raw_to_date(V.field("after", "order_date")).alias("raw_date"))


@register("cdc_state_as_of", O.with_ctes("select 0 as batch, * from c_orders union all select 2, * from f_orders"))
def q_cdc_state_as_of(spark, sf):
    """The orders as they were after the first and the last of three
    batches, folded from the audit log that the pipeline wrote."""
    import uuid

    from ..operators import changes as CH
    from ..session import store_root
    from ..streaming import streams as ST
    feed = change_feed(spark, sf, "relational")
    pipe = ST.RelationalPipeline(spark, store_root(spark, f"asof-{uuid.uuid4().hex}"))
    for n, cut in enumerate((F.col("offset") % 8 == 0, F.col("offset") % 8 == 1, F.col("offset") % 8 >= 2)):
        pipe.process(feed.where(cut), n)
    log = pipe.read_log("raw/cdc_events")
    parts = [CH.state_as_of(log, "orders", n).select(F.lit(n).alias("batch"), "*") for n in (0, 2)]
    return ntz(parts[0].unionByName(parts[1]))
