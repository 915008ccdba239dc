"""Batch-run ledger.

A run appends two rows to an append-only ledger table: ``RUNNING`` at start
and the final status (``SUCCESS``, ``SUCCESS_WITH_WARNINGS`` when the DQ
score is positive, ``FAILED`` with the error) at the end.  The view folds the
ledger to the last row per ``batch_id``.  Writes are small appends; the view
is a ``max_by`` aggregate, so it scales with the number of runs.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import HadoopFiles

LEDGER_SCHEMA = ("batch_id string, job_name string, seq int, status string, started_at timestamp, "
                 "finished_at timestamp, duration_seconds double, dq_issue_count bigint, "
                 "metrics string, error_message string")


def _append(spark: SparkSession, path: str, row: dict) -> None:
    spark.createDataFrame([row], LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run_job(spark: SparkSession, ledger_path: str, job_name: str,
            fn: Callable[[], tuple[dict, int]]) -> dict:
    """Run ``fn`` (returning ``(metrics, dq_issue_count)``) between two ledger
    rows.  A failure is recorded with its message and re-raised."""
    batch_id = uuid.uuid4().hex
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    base = dict(batch_id=batch_id, job_name=job_name, started_at=started, finished_at=None,
                duration_seconds=None, dq_issue_count=None, metrics=None, error_message=None)
    _append(spark, ledger_path, dict(base, seq=0, status="RUNNING"))
    try:
        metrics, dq = fn()
        status = "SUCCESS" if int(dq) == 0 else "SUCCESS_WITH_WARNINGS"
        err = None
    except Exception as exc:  # noqa: BLE001 - recorded, then re-raised
        metrics, dq, status, err = {}, 0, "FAILED", str(exc)
        _finish(spark, ledger_path, base, started, status, metrics, dq, err)
        raise
    return _finish(spark, ledger_path, base, started, status, metrics, dq, err)


def _finish(spark, ledger_path, base, started, status, metrics, dq, err) -> dict:
    finished = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = dict(base, seq=1, status=status, finished_at=finished,
               duration_seconds=round((finished - started).total_seconds(), 3),
               dq_issue_count=int(dq), metrics=json.dumps(metrics, default=str, sort_keys=True),
               error_message=err)
    _append(spark, ledger_path, row)
    return row


def runs_view(ledger: DataFrame) -> DataFrame:
    """Latest state per batch id (RUNNING rows are superseded by the finish row)."""
    cols = [c for c in ledger.columns if c != "batch_id"]
    return (ledger.groupBy("batch_id").agg(F.max_by(F.struct(*cols), F.col("seq")).alias("r"))
            .select("batch_id", *[F.col(f"r.{c}").alias(c) for c in cols]))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows; empty before the first run.  The folder is looked up
    in the file system that its path names."""
    if not HadoopFiles(spark).exists(path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)
