"""Reporting marts (A1-A10, A14, J1, J2, J4) as full rebuilds.

Every mart is one declarative plan: aggregate the big side first (partial
aggregation runs map-side), then join on the key the aggregate is already
partitioned by, so each mart costs one shuffle per input and the join reuses
that partitioning.  Broadcasts are left to AQE, which only converts a join
when the runtime size of a side is under ``autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

REVENUE_TYPE = "decimal(16,2)"


def country_or_unknown(c) -> F.Column:
    """``COALESCE(NULLIF(country, ''), 'UNKNOWN')``."""
    return F.coalesce(F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")), F.lit(S.UNKNOWN))


def revenue_rows(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """J1 + P9 + P14 + F31: one row per non-cancelled order with its bucket.

    One left join in a single pass over the orders.  Orders without a
    customer id cannot match; their join key is a hash, so a flood of NULL
    keys does not land in one join task, and what such a key might meet is
    not looked at.
    """
    o = (orders.where(F.col("status") != "CANCELLED")
         .select(F.to_date("order_date").alias("order_day"),
                 F.coalesce(F.col("customer_id").cast("bigint"), F.xxhash64("id")).alias("_jk"),
                 F.col("customer_id").isNotNull().alias("_real"),
                 "quantity", "total_amount"))
    c = customers.select(F.col("id").cast("bigint").alias("_cid"), F.col("country").alias("_country"))
    return (o.join(c, F.col("_jk") == F.col("_cid"), "left")
            .select("order_day", country_or_unknown(F.when(F.col("_real"), F.col("_country"))).alias("country"),
                    "quantity", "total_amount"))


def aggregate_revenue(rows: DataFrame) -> DataFrame:
    return (rows.groupBy("order_day", "country")
            .agg(F.count(F.lit(1)).alias("total_orders"),
                 F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("total_items"),
                 F.coalesce(F.sum("total_amount"), F.lit(0)).cast(REVENUE_TYPE).alias("total_revenue")))


def daily_revenue(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """A1: revenue by (order day, country), cancelled orders excluded."""
    return aggregate_revenue(revenue_rows(orders, customers))


def order_stats_by_customer(orders: DataFrame) -> DataFrame:
    """Per-customer order aggregate used by A2/A4 (partial agg map-side)."""
    return (orders.where(F.col("customer_id").isNotNull())
            .groupBy("customer_id")
            .agg(F.count("id").alias("total_orders"),
                 F.sum(F.when(F.col("status") != "CANCELLED", F.col("total_amount"))).alias("_spent"),
                 F.max("order_date").alias("last_order_date")))


def customer_summary(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """A2: every customer with order count (all statuses), spend (not
    cancelled) and last order date (all statuses)."""
    stats = order_stats_by_customer(orders)
    c = customers.select(F.col("id").alias("customer_id"), "full_name", "country")
    return (c.join(stats, "customer_id", "left")
            .select("customer_id", "full_name", "country",
                    F.coalesce("total_orders", F.lit(0)).cast("bigint").alias("total_orders"),
                    F.coalesce("_spent", F.lit(0)).cast(REVENUE_TYPE).alias("total_spent"),
                    "last_order_date"))


def product_review_summary(reviews: DataFrame) -> DataFrame:
    """A5 + A14 + F30."""
    return (reviews.groupBy("product_id")
            .agg(F.count(F.lit(1)).alias("review_count"),
                 S.round3(F.avg("rating")).alias("avg_rating"),
                 F.count_if(F.col("status") == "APPROVED").alias("approved_count"),
                 F.count_if(F.col("status") == "PENDING").alias("pending_count"),
                 F.count_if(F.col("status") == "REJECTED").alias("rejected_count"),
                 F.max("updated_at").alias("last_review_at")))


def customer_engagement_summary(profiles: DataFrame, clicks: DataFrame,
                                reviews: DataFrame) -> DataFrame:
    """A6 via J4: keys are the union of the three collections' customer ids
    (NULL ids excluded, Q16).  Three pre-aggregates, two full outer joins on
    the key they are all partitioned by -- no per-customer lookups."""
    p = (profiles.where(F.col("customer_id").isNotNull())
         .groupBy("customer_id")
         .agg(F.min_by(F.struct("full_name", "country", F.col("loyalty.tier").alias("tier")), "_id").alias("_p"))
         .select("customer_id", F.col("_p.full_name").alias("full_name"), F.col("_p.country").alias("_country"),
                 F.col("_p.tier").alias("loyalty_tier"), F.lit(True).alias("_has_profile")))
    cl = (clicks.where(F.col("customer_id").isNotNull()).groupBy("customer_id")
          .agg(F.count(F.lit(1)).alias("total_clicks"), F.max("event_time").alias("last_click_at")))
    rv = (reviews.where(F.col("customer_id").isNotNull()).groupBy("customer_id")
          .agg(F.count(F.lit(1)).alias("total_reviews"), F.avg("rating").alias("_avg"),
               F.max("updated_at").alias("last_review_at")))
    j = p.join(cl, "customer_id", "full_outer").join(rv, "customer_id", "full_outer")
    return j.select(
        "customer_id", "full_name",
        F.when(F.col("_has_profile"), F.col("_country")).otherwise(F.lit(S.UNKNOWN)).alias("country"),
        "loyalty_tier",
        F.coalesce("total_clicks", F.lit(0)).cast("bigint").alias("total_clicks"),
        F.coalesce("total_reviews", F.lit(0)).cast("bigint").alias("total_reviews"),
        S.round3(F.col("_avg")).alias("avg_rating_given"),
        "last_click_at", "last_review_at")


def country_profile_summary(profiles: DataFrame) -> DataFrame:
    """A7 + P15."""
    return (profiles.where(F.col("country").isNotNull() & (F.col("country") != ""))
            .groupBy("country")
            .agg(F.count(F.lit(1)).alias("profile_count"),
                 F.count_if(F.col("loyalty.tier") == "GOLD").alias("gold_customers"),
                 F.count_if(F.col("preferences.newsletter") == F.lit(True)).alias("newsletter_opt_in")))


def _active(meta: DataFrame) -> DataFrame:
    return meta.where(F.col("status") == "ACTIVE")          # P10


def object_summary_by_type(meta: DataFrame) -> DataFrame:
    """A8."""
    return (_active(meta).groupBy("media_type")
            .agg(F.count(F.lit(1)).alias("total_objects"),
                 F.sum("size_bytes").cast("bigint").alias("total_size_bytes"),
                 S.round3(F.avg("size_bytes")).alias("avg_size_bytes"),
                 F.max("ingested_at").alias("latest_ingested_at")))


def object_summary_by_day(meta: DataFrame) -> DataFrame:
    """A9."""
    return (_active(meta).groupBy("ingested_day")
            .agg(F.count(F.lit(1)).alias("total_objects"),
                 F.sum("size_bytes").cast("bigint").alias("total_size_bytes")))


def object_storage_summary(meta: DataFrame) -> DataFrame:
    """A10: a global aggregate always yields exactly one row (0 defaults)."""
    return (_active(meta)
            .agg(F.count(F.lit(1)).alias("total_objects"),
                 F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("bigint").alias("total_size_bytes"))
            .select(F.lit("current").alias("_id"), "total_objects", "total_size_bytes"))
