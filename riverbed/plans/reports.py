"""Operational report queries.

Every "last N" report is ``orderBy(...).limit(n)`` with a unique tie-break,
which Spark plans as TakeOrderedAndProject: a per-task top-n merged once --
a bounded distributed top-k, never a full sort or a driver-side loop.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_revenue_days(daily_revenue: DataFrame, n: int = 20) -> DataFrame:
    """L1: ``ORDER BY order_day DESC, country LIMIT 20``."""
    return daily_revenue.orderBy(F.col("order_day").desc(), F.col("country")).limit(n)


def top_spenders(customer_summary: DataFrame, n: int = 20) -> DataFrame:
    """L2: ``ORDER BY total_spent DESC LIMIT 20`` (customer id tie-break)."""
    return customer_summary.orderBy(F.col("total_spent").desc(), F.col("customer_id")).limit(n)


def last_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """Most recent batch runs."""
    return runs.orderBy(F.col("started_at").desc(), F.col("batch_id").desc()).limit(n)


def last_runs_by_job(runs: DataFrame, n: int = 5) -> DataFrame:
    """The last ``n`` runs of each job, days first, so that no group grows
    with a job's whole history."""
    run = F.struct("started_at", "batch_id", "status", "dq_issue_count")
    newest = F.slice(F.sort_array(F.collect_list(run), asc=False), 1, n)
    days = runs.groupBy("job_name", F.to_date("started_at").alias("day")).agg(newest.alias("r"))
    top = F.slice(F.sort_array(F.flatten(F.collect_list("r")), asc=False), 1, n)
    return days.groupBy("job_name").agg(top.alias("r")).select("job_name", F.inline("r"))


def last_mart_days(by_day: DataFrame, day: str, n: int = 5) -> DataFrame:
    """The last ``n`` days of a mart by day."""
    return by_day.orderBy(F.col(day).desc()).limit(n)


def last_failed_events(dead: DataFrame, n: int = 20) -> DataFrame:
    """L4: most recent dead letters, by the time they failed, then by source
    position."""
    return dead.orderBy(F.col("failed_at").desc_nulls_last(), F.col("source_topic").desc(),
                        F.col("source_partition").desc(), F.col("source_offset").desc()).limit(n)


def latest_objects(meta: DataFrame, n: int = 5) -> DataFrame:
    """Last 5 objects by ``ingested_at`` (object id tie-break)."""
    return meta.orderBy(F.col("ingested_at").desc(), F.col("object_id")).limit(n)


def clean_samples(tables: dict[str, DataFrame], key: str = "_id") -> DataFrame:
    """One sample row per clean collection (smallest key, deterministic)."""
    parts = [t.select(F.lit(name).alias("collection"), F.col(key).cast("string").alias("sample_id"))
             .orderBy("sample_id").limit(1) for name, t in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def layer_counts(tables: dict[str, DataFrame], status_col: str | None = None) -> DataFrame:
    """Labelled count report ``SELECT 'x', COUNT(*) UNION ALL ...``;
    with ``status_col`` also counts per status value (U6)."""
    parts = []
    for name, t in tables.items():
        if status_col and status_col in t.columns:
            parts.append(t.groupBy(F.col(status_col).alias("status"))
                         .agg(F.count(F.lit(1)).alias("row_count"))
                         .select(F.lit(name).alias("layer"), "status", "row_count"))
        else:
            parts.append(t.agg(F.count(F.lit(1)).alias("row_count"))
                         .select(F.lit(name).alias("layer"), F.lit(None).cast("string").alias("status"),
                                 "row_count"))
    return reduce(DataFrame.unionByName, parts)
