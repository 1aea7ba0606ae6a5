"""Run journal: append-only stage metrics and alerts; the latest row per (run, stage) wins on read."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.operators import reconcile, versions
from tallyframe.session import path_exists

METRICS_SCHEMA = ("run_id string, stage string, recorded_at timestamp, duration_seconds double, read_count bigint, "
                  "accepted_count bigint, rejected_count bigint, changed_count bigint, error string")
ALERT_SCHEMA = "created_at timestamp, kind string, payload string"
BATCH_SCHEMA = "batch_id string, run_id string, state string, recorded_at timestamp, published_at timestamp"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def record(spark: SparkSession, root: str, run_id: str, stage: str, seconds: float, metrics: dict,
           error: str | None = None) -> None:
    row = [(run_id, stage, _now(), float(seconds), *(int(metrics.get(k, 0)) for k in
            ("read_count", "accepted_count", "rejected_count", "changed_count")), error)]
    spark.createDataFrame(row, METRICS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/stage_metrics")


def stage_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Current metrics per (run, stage): the newest recorded row (an upsert on read)."""
    rows = spark.read.schema(METRICS_SCHEMA).parquet(f"{root}/stage_metrics")
    return versions.latest_wins(rows, ["run_id", "stage"], ["recorded_at"])


def batch_state(spark: SparkSession, root: str, batch_id: str, run_id: str, state: str,
                published_at: dt.datetime | None = None) -> None:
    spark.createDataFrame([(batch_id, run_id, state, _now(), published_at)], BATCH_SCHEMA).coalesce(1).write.mode(
        "append").parquet(f"{root}/batches")


def batches(spark: SparkSession, root: str) -> DataFrame:
    rows = spark.read.schema(BATCH_SCHEMA).parquet(f"{root}/batches")
    return versions.latest_wins(rows, ["batch_id"], ["recorded_at"])


def alert(spark: SparkSession, root: str, kind: str, payload: dict) -> None:
    spark.createDataFrame([(_now(), kind, json.dumps(payload, default=str))], ALERT_SCHEMA).coalesce(1).write.mode(
        "append").parquet(f"{root}/alerts")


def alerts(spark: SparkSession, root: str, n: int = 100) -> DataFrame:
    """The newest ``n`` alerts (a top-n report)."""
    return spark.read.schema(ALERT_SCHEMA).parquet(f"{root}/alerts").orderBy(F.col("created_at").desc()).limit(n)


def check_freshness(spark: SparkSession, root: str, max_age_seconds: int, now: dt.datetime | None = None) -> bool:
    """False (and an alert row) when no batch was published within ``max_age_seconds`` of ``now``."""
    now = now or _now()
    published = spark.createDataFrame([], BATCH_SCHEMA)  # no batch was ever recorded
    if path_exists(spark, f"{root}/batches"):
        published = batches(spark, root).filter(F.col("published_at").isNotNull())
    row = reconcile.freshness(published, "published_at", now, max_age_seconds).first()
    if row["is_stale"]:
        alert(spark, root, "freshness", {"last_published_at": str(row["last_published_at"]),
                                         "max_age_seconds": max_age_seconds})
        return False
    return True
