"""Reconciliation metrics and data-quality scores.

Metrics are produced as a long ``(metric_name, metric_value)`` relation: one
single-pass aggregate per table (all of that table's counts at once, A12),
turned into rows with ``stack`` and unioned.  The score is then a plain
filtered sum over that relation (A13, P13), so no metric ever round-trips
through the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Metric names that count as relational data-quality issues.  Fixed values.
REL_ISSUES = ["customers_unknown_country_count", "orders_without_customer_count",
              "orders_invalid_quantity_count", "orders_negative_price_count",
              "mart_unknown_country_rows"]
# Document issue metrics and source/clean count pairs.  Fixed values.
DOC_ISSUES = ["unknown_country_profiles_count", "invalid_review_rating_count",
              "missing_review_product_id_count", "missing_click_event_type_count"]
DOC_PAIRS = [("source_customer_profiles_count", "target_clean_customer_profiles_count"),
             ("source_product_reviews_count", "target_clean_product_reviews_count"),
             ("source_click_events_count", "target_clean_click_events_count")]


def metrics_long(df: DataFrame, metrics: dict) -> DataFrame:
    """One aggregate pass over ``df`` computing every named count, as rows."""
    agg = df.agg(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for n, c in metrics.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in metrics)
    return agg.selectExpr(f"stack({len(metrics)}, {pairs}) as (metric_name, metric_value)")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def relational_metrics(raw_events: DataFrame | None, customers: DataFrame, orders: DataFrame,
                       daily_revenue: DataFrame, customer_summary: DataFrame) -> DataFrame:
    """Five layer counts and five DQ counts.  Orders without a customer id
    are orphans without a join."""
    named = orders.where(F.col("customer_id").isNotNull())
    orphans = named.join(customers.select(F.col("id").alias("customer_id")), "customer_id", "left_anti").select("id").unionAll(
        orders.where(F.col("customer_id").isNull()).select("id"))
    parts = [
        metrics_long(customers, {
            "clean_customers_count": F.count(F.lit(1)),
            "customers_unknown_country_count": F.count_if(F.col("country") == "UNKNOWN")}),
        metrics_long(orders, {
            "clean_orders_count": F.count(F.lit(1)),
            "orders_invalid_quantity_count": F.count_if(F.col("quantity") < 0),
            "orders_negative_price_count": F.count_if(F.col("unit_price") < 0)}),
        metrics_long(orphans, {"orders_without_customer_count": F.count(F.lit(1))}),
        metrics_long(daily_revenue, {
            "mart_daily_revenue_rows": F.count(F.lit(1)),
            "mart_unknown_country_rows": F.count_if(F.col("country") == "UNKNOWN")}),
        metrics_long(customer_summary, {"mart_customer_summary_rows": F.count(F.lit(1))}),
    ]
    if raw_events is not None:
        parts.insert(0, metrics_long(raw_events, {"raw_events_count": F.count(F.lit(1))}))
    return union_all(parts)


def relational_dq_score(metrics: DataFrame) -> DataFrame:
    """Sum of the five issue counts; status SUCCESS / SUCCESS_WITH_WARNINGS."""
    s = (metrics.where(F.col("metric_name").isin(REL_ISSUES))
         .agg(F.coalesce(F.sum("metric_value"), F.lit(0)).cast("bigint").alias("dq_issue_count")))
    return s.withColumn("status", status_for(F.col("dq_issue_count")))


def status_for(dq) -> F.Column:
    return F.when(dq == 0, "SUCCESS").otherwise("SUCCESS_WITH_WARNINGS")


def document_metrics(src_profiles: DataFrame, src_reviews: DataFrame, src_clicks: DataFrame,
                     raw_profiles: DataFrame, raw_reviews: DataFrame, raw_clicks: DataFrame,
                     profiles: DataFrame, reviews: DataFrame, clicks: DataFrame,
                     review_mart: DataFrame, engagement_mart: DataFrame,
                     country_mart: DataFrame) -> DataFrame:
    """Source / raw / clean counts per collection, mart rows, 4 DQ counts."""
    one = F.count(F.lit(1))
    return union_all([
        metrics_long(src_profiles, {"source_customer_profiles_count": one}),
        metrics_long(raw_profiles, {"target_raw_customer_profiles_count": one}),
        metrics_long(profiles, {"target_clean_customer_profiles_count": one,
                                "unknown_country_profiles_count": F.count_if(F.col("country") == "UNKNOWN")}),
        metrics_long(src_reviews, {"source_product_reviews_count": one}),
        metrics_long(raw_reviews, {"target_raw_product_reviews_count": one}),
        metrics_long(reviews, {"target_clean_product_reviews_count": one,
                               "invalid_review_rating_count": F.count_if((F.col("rating") < 0) | (F.col("rating") > 5)),
                               "missing_review_product_id_count": F.count_if(F.col("product_id") == 0)}),
        metrics_long(src_clicks, {"source_click_events_count": one}),
        metrics_long(raw_clicks, {"target_raw_click_events_count": one}),
        metrics_long(clicks, {"target_clean_click_events_count": one,
                              "missing_click_event_type_count": F.count_if(F.col("event_type") == "UNKNOWN")}),
        metrics_long(review_mart, {"mart_product_review_summary_rows": one}),
        metrics_long(engagement_mart, {"mart_customer_engagement_summary_rows": one}),
        metrics_long(country_mart, {"mart_country_profile_summary_rows": one}),
    ])


def document_dq_score(metrics: DataFrame) -> DataFrame:
    """R9 + R11: issue sum plus one per source/clean count pair that differs."""
    wide = metrics.groupBy().pivot("metric_name", sorted({*DOC_ISSUES, *[x for p in DOC_PAIRS for x in p]})) \
        .agg(F.first("metric_value"))
    issues = reduce(lambda a, b: a + b, [F.coalesce(F.col(n), F.lit(0)) for n in DOC_ISSUES])
    mism = reduce(lambda a, b: a + b, [F.when(~F.col(a).eqNullSafe(F.col(b)), 1).otherwise(0)
                                       for a, b in DOC_PAIRS])
    return wide.select((issues + mism).cast("bigint").alias("dq_issue_count"),
                       mism.cast("bigint").alias("count_mismatches")) \
        .withColumn("status", status_for(F.col("dq_issue_count")))
