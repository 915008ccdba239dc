"""Per-table cleaners (transform_* in the source pipeline).

Each cleaner takes a DataFrame holding a VARIANT row image (default column
``after``) and returns the typed clean columns plus ``_error``: NULL for a
good row, otherwise the reason the target store would reject it (E2).  The
caller decides where bad rows go (``operators.validate``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import variant as V

ERR_INT_RANGE = "integer out of range"
ERR_NUMERIC_OVERFLOW = "numeric field overflow"
ERR_TIMESTAMP = "invalid input syntax for type timestamp"
ERR_BAD_JSON = "malformed JSON value"
ERR_NO_OP = "missing op"
ERR_NO_PK = "missing primary key"
ERR_NO_AFTER = "document upsert carries no document"
ERR_NO_DOC_ID = "document delete carries no id"
ERR_DUP_KEY = "duplicate business key"
ERR_DATE = "invalid document date"
ERR_BIGINT = "document integer out of range"
ERR_SIZE = "object size is not positive"
ERR_IDS = "object event lacks an identifier"


def first_error(*checks: tuple[Column, str]) -> Column:
    """First failing check's message, NULL when all pass."""
    expr = F.lit(None).cast("string")
    for cond, msg in reversed(checks):
        expr = F.when(F.coalesce(cond, F.lit(False)), F.lit(msg)).otherwise(expr)
    return expr


# ----------------------------------------------------------------- relational
CUSTOMER_COLUMNS = ["id", "full_name", "email", "email_domain", "phone", "country",
                    "created_at", "updated_at"]
ORDER_COLUMNS = ["id", "customer_id", "product_name", "quantity", "unit_price",
                 "total_amount", "status", "order_date", "updated_at"]


def customer_columns(fv, a: Column) -> tuple[dict, Column]:
    cid, cid_bad = V.int_field(fv("id", False), 64)
    email = S.clean_email(V.as_str(fv("email")))
    created, created_bad = V.to_timestamp(fv("created_at", False))
    updated, updated_bad = V.to_timestamp(fv("updated_at", False))
    cols = {
        "id": cid,
        "full_name": V.text(fv("full_name")),
        "email": email,
        "email_domain": S.email_domain(email),
        "phone": S.clean_phone(V.as_str(fv("phone"))),
        "country": S.normalize_country(V.as_str(fv("country"))),
        "created_at": created,
        "updated_at": updated,
    }
    return cols, [(cid_bad, ERR_INT_RANGE), (created_bad | updated_bad, ERR_TIMESTAMP)]


def order_columns(fv, a: Column) -> tuple[dict, Column]:
    oid, oid_bad = V.int_field(fv("id", False), 64)
    cust, cust_bad = V.int_field(fv("customer_id", False), 64)
    # quantity: ``int(q or 0)``; failures -> 0; negatives -> 0; > INT -> error
    q_raw, q_over = V.py_int(fv("quantity", False))
    qty = F.greatest(F.coalesce(q_raw, F.lit(0).cast("bigint")), F.lit(0).cast("bigint"))
    q_bad = q_over | (qty > V.INT_MAX)
    qty_i = F.when(~q_bad, qty).cast("int")
    price, price_over = V.to_decimal(fv("unit_price"))
    price = F.coalesce(price, F.lit(0).cast("decimal(28,10)"))
    unit_price = (F.round(price, 2)).try_cast("decimal(12,2)")
    total = (S.total_amount(price, qty_i)).try_cast("decimal(14,2)")
    order_date, od_bad = V.to_timestamp(fv("order_date", False))
    updated, up_bad = V.to_timestamp(fv("updated_at", False))
    cols = {
        "id": oid,
        "customer_id": cust,
        "product_name": V.text(fv("product_name")),
        "quantity": qty_i,
        "unit_price": unit_price,
        "total_amount": total,
        "status": S.clean_status(V.as_str(fv("status"))),
        "order_date": order_date,
        "updated_at": updated,
    }
    return cols, [(oid_bad | cust_bad | q_bad, ERR_INT_RANGE),
                  (price_over, ERR_NUMERIC_OVERFLOW),
                  (None, ERR_NUMERIC_OVERFLOW, "unit_price"),
                  (None, ERR_NUMERIC_OVERFLOW, "total_amount"),
                  (od_bad | up_bad, ERR_TIMESTAMP)]


def staged_rows(df: DataFrame, *cols) -> DataFrame:
    """The columns, emitted through a one-element ``inline``: a predicate on
    generator output cannot be pushed below it, so what is above is evaluated
    once instead of being re-inlined into the scan, and what follows becomes a
    generated method of its own (one that grows beyond 8,000 bytes of bytecode
    is never compiled by the JVM)."""
    return df.select(F.inline(F.array(F.struct(*cols))))


def _apply(df: DataFrame, builder, image: str, keep: list[str] | None) -> DataFrame:
    """Staged projections: (1) pull every used field out of the image in one
    pass, (2) its JSON type and text form, then what an Extended JSON wrapper
    holds, (3) coercions, (4) the error message.
    Each stage reads plain columns of the previous one, so no variant path or
    type test is repeated inside CASE branches and generated methods stay small.
    """
    used: list[str] = []
    text: set[str] = set()
    plain: list[str] = []
    dates: list[str] = []

    def staged(asked: list[str], n: str, v: str, t: str) -> V.Fld:
        if n not in asked:
            asked.append(n)
        # a text is read out of the variant once; a number's only where it is asked for
        return V.Fld(F.col(f"{v}_{n}"), F.col(f"{t}_{n}"),
                     F.when(F.col(f"{t}_{n}") == "STRING", F.col(f"{v}s_{n}")).otherwise(V.as_str(F.col(f"{v}_{n}"))))

    def fv(n: str, as_text: bool = True) -> V.Fld:
        """Field accessor.  Text fields get their string form materialised
        once; for numeric / date / object fields the (costly) variant-to-text
        cast stays inside the rarely taken STRING branches."""
        if n not in used:
            used.append(n)
        if as_text:
            text.add(n)
        s = F.col(f"_s_{n}") if as_text else V.as_str(F.col(f"_f_{n}"))
        return V.Fld(F.col(f"_f_{n}"), F.col(f"_t_{n}"), s, lambda: staged(plain, n, "_u", "_ut"),
                     lambda: (staged(dates, n, "_d", "_dt"), F.col(f"_dx_{n}").isNotNull()))

    cols, checks = builder(fv, F.col(image))
    keep = keep or []
    s1 = df.select(*keep, F.col(image), V.members(image, used).alias("_m"))
    s1 = s1.select(*keep, F.col(image), *[F.col("_m").getField(n).alias(f"_f_{n}") for n in used])
    s2 = s1.select("*", *[V.vtype(F.col(f"_f_{n}")).alias(f"_t_{n}") for n in used],
                   *[V.as_str(F.col(f"_f_{n}")).alias(f"_s_{n}") for n in used if n in text],
                   *[V.members(f"_f_{n}", V.WRAPPERS).alias(f"_w_{n}") for n in plain],
                   *[V.field(f"_f_{n}", "$date").alias(f"_dx_{n}") for n in dates])
    s2 = s2.select("*", *[V.unwrapped(F.col(f"_w_{n}"), F.col(f"_f_{n}")).alias(f"_u_{n}") for n in plain],
                   *[F.coalesce(f"_dx_{n}", f"_f_{n}").alias(f"_dy_{n}") for n in dates])
    s2 = s2.select("*", *[V.vtype(F.col(f"_u_{n}")).alias(f"_ut_{n}") for n in plain],
                   *[V.members(f"_dy_{n}", V.WRAPPERS).alias(f"_dw_{n}") for n in dates])
    s2 = s2.select("*", *[V.unwrapped(F.col(f"_dw_{n}"), F.col(f"_dy_{n}")).alias(f"_d_{n}") for n in dates])
    s2 = s2.select("*", *[V.vtype(F.col(f"_d_{n}")).alias(f"_dt_{n}") for n in dates])
    s2 = s2.select("*", *[F.when(F.col(f"{t}_{n}") == "STRING", V.as_str(F.col(f"{v}_{n}"))).alias(f"{v}s_{n}")
                          for asked, v, t in ((plain, "_u", "_ut"), (dates, "_d", "_dt")) for n in asked])
    if plain or dates:                              # documents: reading and coercing are a method each
        s2 = staged_rows(s2, *s2.columns)
    flags = {f"_chk{i}": chk[0] for i, chk in enumerate(checks) if chk[0] is not None}
    s3 = s2.select(*keep, *[v.alias(k) for k, v in cols.items()],
                   *[v.alias(k) for k, v in flags.items()])
    err = first_error(*[(F.col(f"_chk{i}") if c is not None else F.col(ref).isNull(), msg)
                        for i, (c, msg, ref) in enumerate(
                            (c[0], c[1], c[2] if len(c) > 2 else None) for c in checks)])
    # The validity split downstream filters on ``_error``.
    return staged_rows(s3, *[F.col(k) for k in keep], *[F.col(k) for k in cols], err.alias("_error"))


def clean_customers(df: DataFrame, image: str = "after", keep: list[str] | None = None) -> DataFrame:
    """Customers image -> clean.customers columns + ``_error``."""
    return _apply(df, customer_columns, image, keep)


def clean_orders(df: DataFrame, image: str = "after", keep: list[str] | None = None) -> DataFrame:
    """Orders image -> clean.orders columns + ``_error``."""
    return _apply(df, order_columns, image, keep)


# ------------------------------------------------------------------ documents
def profile_columns(fv, d: Column) -> tuple[dict, Column]:
    prefs = fv("preferences", False)
    loyalty = fv("loyalty", False)
    prefs = F.when(prefs.t.startswith("OBJECT"), prefs.v)   # F17: non-object -> {}
    loyalty = F.when(loyalty.t.startswith("OBJECT"), loyalty.v)
    cust = V.unwrap_ejson(fv("customer_id", False))
    (created, created_bad), (updated, updated_bad) = (V.ejson_date(fv(n, False)) for n in ("created_at", "updated_at"))
    cols = {
        "_id": V.doc_id_text(fv("_id", False)),
        "customer_id": F.when(V.is_number(V.vtype(cust)), F.try_variant_get(cust.v, "$", "bigint")),
        "full_name": V.text(fv("full_name")),
        "country": S.normalize_doc_country(V.as_str(fv("country"))),
        "preferences": F.struct(
            V.text(V.field(prefs, "category")).alias("category"),
            V.truthy(V.field(prefs, "newsletter")).alias("newsletter"),
            S.normalize_upper(V.as_str(V.field(prefs, "price_sensitivity")), "UNKNOWN").alias("price_sensitivity")),
        "loyalty": F.struct(
            S.normalize_upper(V.as_str(V.field(loyalty, "tier")), "BRONZE").alias("tier"),
            V.safe_int(V.field(loyalty, "points"), 0, 0).alias("points")),
        "devices": S.clean_list(V.str_list(fv("devices", False))),
        "created_at": created,
        "updated_at": updated,
        "_doc": d,
    }
    return cols, [(created_bad | updated_bad, ERR_DATE), (V.beyond_bigint(V.field(loyalty, "points")), ERR_BIGINT)]


def review_columns(fv, d: Column) -> tuple[dict, Column]:
    (created, created_bad), (updated, updated_bad) = (V.ejson_date(fv(n, False)) for n in ("created_at", "updated_at"))
    huge = [V.beyond_bigint(fv(n, False)) for n in ("customer_id", "product_id")]
    cols = {
        "_id": V.doc_id_text(fv("_id", False)),
        "review_id": V.text(V.unwrap_ejson(fv("review_id", False))),
        "customer_id": V.safe_int(fv("customer_id", False), 0, 0),
        "product_id": V.safe_int(fv("product_id", False), 0, 0),
        "rating": V.safe_int(fv("rating", False), 0, 0, 5),
        "status": S.normalize_upper(V.as_str(fv("status")), "PENDING"),
        "title": V.text(fv("title")),
        "body": V.text(fv("body")),
        "tags": S.clean_list(V.str_list(fv("tags", False))),
        "created_at": created,
        "updated_at": updated,
        "_doc": d,
    }
    return cols, [(created_bad | updated_bad, ERR_DATE), (huge[0] | huge[1], ERR_BIGINT)]


def click_columns(fv, d: Column) -> tuple[dict, Column]:
    at, at_bad = V.ejson_date(fv("event_time", False))
    huge = [V.beyond_bigint(fv(n, False)) for n in ("customer_id", "product_id")]
    meta = fv("metadata", False)
    meta = F.when(meta.t.startswith("OBJECT"), meta.v)
    cols = {
        "_id": V.doc_id_text(fv("_id", False)),
        "event_id": V.text(V.unwrap_ejson(fv("event_id", False))),
        "customer_id": V.safe_int(fv("customer_id", False), 0, 0),
        "product_id": V.safe_int(fv("product_id", False), 0, 0),
        "event_type": S.normalize_upper(V.as_str(fv("event_type")), "UNKNOWN"),
        "session_id": V.text(fv("session_id")),
        "metadata": F.struct(
            V.text(V.field(meta, "user_agent")).alias("user_agent"),
            S.normalize_upper(V.as_str(V.field(meta, "referrer")), "UNKNOWN").alias("referrer"),
            S.normalize_upper(V.as_str(V.field(meta, "page")), "UNKNOWN").alias("page")),
        "event_time": at,
        "_doc": d,
    }
    return cols, [(at_bad, ERR_DATE), (huge[0] | huge[1], ERR_BIGINT)]


def clean_profiles(df: DataFrame, image: str = "doc", keep: list[str] | None = None) -> DataFrame:
    """Customer profile documents."""
    return _apply(df, profile_columns, image, keep)


def clean_reviews(df: DataFrame, image: str = "doc", keep: list[str] | None = None) -> DataFrame:
    """Product reviews."""
    return _apply(df, review_columns, image, keep)


def clean_clicks(df: DataFrame, image: str = "doc", keep: list[str] | None = None) -> DataFrame:
    """click events."""
    return _apply(df, click_columns, image, keep)


DOC_CLEANERS = {"customer_profiles": clean_profiles,
                "product_reviews": clean_reviews,
                "click_events": clean_clicks}
# Sparse unique business key per collection (besides _id).  Fixed values.
DOC_BUSINESS_KEYS = {"customer_profiles": "customer_id",
                     "product_reviews": "review_id",
                     "click_events": "event_id"}


# -------------------------------------------------------------------- objects
def clean_object_events(events: DataFrame, batch_ts, keep: list[str] = ()) -> DataFrame:
    """F25-F29, F27 validation: object events -> clean metadata + ``_error``.

    ``events`` has the flat event columns (strings / numbers as parsed).
    ``batch_ts`` is the processing time of the run, passed in (not the clock).
    """
    ts = F.lit(batch_ts).cast("timestamp") if not isinstance(batch_ts, Column) else batch_ts
    media = S.normalize_media_type(F.col("media_type"))
    size_raw = F.col("size_bytes")
    size_i = (size_raw.cast("string")).try_cast("bigint")
    ids = [S.clean_str(F.col(c)) for c in ("source_bucket", "object_key", "object_id", "event_id")]
    err = first_error((F.coalesce(size_i, F.lit(0)) <= 0, ERR_SIZE),
                      (reduce(lambda a, b: a | b, [i.isNull() for i in ids]), ERR_IDS))
    return events.select(
        S.clean_str("object_id").alias("object_id"),
        S.clean_str("event_id").alias("event_id"),
        S.clean_str("source_bucket").alias("source_bucket"),
        S.clean_str("object_key").alias("source_object_key"),
        S.target_bucket(media).alias("target_bucket"),
        S.clean_str("object_key").alias("target_object_key"),
        S.clean_str("file_name").alias("file_name"),
        F.lower(F.coalesce(S.clean_str("extension"), F.lit(""))).alias("extension"),
        media.alias("media_type"),
        F.coalesce(S.clean_str("content_type"), F.lit(S.DEFAULT_CONTENT_TYPE)).alias("content_type"),
        size_i.alias("size_bytes"),
        S.clean_str("etag").alias("etag"),
        S.clean_str("last_modified").alias("last_modified"),
        F.coalesce(S.clean_str("source_type"), F.lit(S.DEFAULT_SOURCE_TYPE)).alias("source_type"),
        F.lit("ACTIVE").alias("status"),
        ts.alias("ingested_at"),
        F.date_format(ts, "yyyy-MM-dd").alias("ingested_day"),
        *[c for c in events.columns if c in ("topic", "partition", "offset", *keep)],
        err.alias("_error"))
