"""Document-shaped images (Extended JSON text) built from flat source rows.

Documents in the change feed carry ``_id`` as ``{"$oid": ...}``, integers
sometimes as ``{"$numberInt": "..."}`` and dates as ``{"$date": ...}``.
These helpers render flat rows as that JSON text -- what a document store's
change stream emits -- with ``to_json`` for the plain members and string
assembly for the Extended-JSON members (no VARIANT round trips).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def oid(c) -> Column:
    return F.struct((F.col(c) if isinstance(c, str) else c).alias("$oid"))


def _num_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


def ejson_int(c: Column, alt: Column) -> Column:
    """``{"$numberInt": "n"}`` where ``alt`` holds, the plain number elsewhere."""
    wrapped = F.concat(F.lit('{"$numberInt": "'), c.cast("string"), F.lit('"}'))
    return F.when(alt & c.isNotNull(), wrapped).otherwise(_num_text(c))


def ejson_date(c: Column, alt: Column) -> Column:
    """``{"$date": {"$numberLong": "ms"}}`` (canonical) or ``{"$date": ms}``."""
    canonical = F.concat(F.lit('{"$date": {"$numberLong": "'), c.cast("string"), F.lit('"}}'))
    relaxed = F.concat(F.lit('{"$date": '), c.cast("string"), F.lit("}"))
    return F.when(c.isNull(), F.lit("null")).when(alt, canonical).otherwise(relaxed)


def with_members(base_json: Column, members: list[tuple[str, Column]]) -> Column:
    """Append raw JSON members to the text of a non-empty JSON object."""
    parts = [base_json.substr(F.lit(1), F.length(base_json) - 1)]
    for name, frag in members:
        parts += [F.lit(f', "{name}": '), frag]
    parts.append(F.lit("}"))
    return F.concat(*parts)


def _plain(*cols) -> Column:
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def review_json(df: DataFrame, _id: Column | None = None) -> Column:
    even = F.col("rating") % 2 == 0
    base = _plain((oid("_id") if _id is None else F.struct(_id.alias("$oid"))).alias("_id"), "review_id",
                  "product_id", "rating", "status", "title", "tags",
                  F.concat(F.lit("extra-"), F.col("review_id")).alias("note"))      # a member that no cleaner names
    return with_members(base, [("customer_id", ejson_int(F.col("customer_id"), even)),
                               ("updated_at", ejson_date(F.col("updated_at"), even))])


def click_json(df: DataFrame) -> Column:
    base = _plain(oid("_id").alias("_id"), "event_id", "customer_id", "event_type", "product_id",
                  "session_id", F.struct("user_agent", "referrer", "page").alias("metadata"))
    return with_members(base, [("event_time", ejson_date(F.col("event_time"), F.col("product_id") % 2 == 0))])


def profile_json(df: DataFrame) -> Column:
    return _plain(oid("_id").alias("_id"), "customer_id", "full_name", "country",
                  F.struct("category", "newsletter", "price_sensitivity").alias("preferences"),
                  F.struct("tier", "points").alias("loyalty"), "devices")


def review_docs(src: DataFrame) -> DataFrame:
    return src.select(review_json(src).alias("doc_json"))


def click_docs(src: DataFrame) -> DataFrame:
    return src.select(click_json(src).alias("doc_json"))


def profile_docs(src: DataFrame) -> DataFrame:
    return src.select(profile_json(src).alias("doc_json"))
