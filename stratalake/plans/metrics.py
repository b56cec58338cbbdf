"""What each job did: one row per table and run, appended to a metrics table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime
from enum import StrEnum

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METRICS_SCHEMA = (
    "step string, table_name string, start_ts timestamp, end_ts timestamp, duration_sec double, "
    "rows_input bigint, rows_output bigint, status string, errors array<string>, violations map<string, bigint>"
)


class Status(StrEnum):
    # The states that a job is recorded with.
    PENDING = "PENDING"
    RUNNING = "RUNNING"
    SUCCESS = "SUCCESS"
    FAILED = "FAILED"
    PARTIAL = "PARTIAL"
    NO_DATA = "NO_DATA"


@dataclass
class JobMetrics:
    step: str
    table_name: str
    start_ts: datetime | None = None
    end_ts: datetime | None = None
    duration_sec: float = 0.0
    rows_input: int = 0
    rows_output: int = 0
    status: str = Status.PENDING
    errors: list[str] = field(default_factory=list)
    violations: dict[str, int] = field(default_factory=dict)


def measured(step: str, table: str, job: Callable[[JobMetrics], Status | None]) -> JobMetrics:
    """Run a job and record its time, its counts and how it ended. Errors do not propagate."""
    metrics = JobMetrics(step, table, start_ts=datetime.now(UTC), status=Status.RUNNING)
    try:
        metrics.status = job(metrics) or Status.SUCCESS
    except Exception as error:  # the run records the failure and decides whether to go on
        metrics.status = Status.FAILED
        metrics.errors.append(f"{type(error).__name__}: {error}")
    metrics.end_ts = datetime.now(UTC)
    metrics.duration_sec = (metrics.end_ts - metrics.start_ts).total_seconds()
    return metrics


def metrics_rows(spark: SparkSession, metrics: list[JobMetrics]) -> DataFrame:
    rows = [{**asdict(m), "status": str(m.status)} for m in metrics]
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def save_metrics(spark: SparkSession, metrics: list[JobMetrics], path: str) -> None:
    if metrics:
        metrics_rows(spark, metrics).coalesce(1).write.mode("append").parquet(path)


def run_summary(metrics: DataFrame) -> DataFrame:
    """Per step: tables done, failed and empty, rows in and out, time taken."""
    return metrics.groupBy("step").agg(
        F.count(F.lit(1)).alias("tables"),
        F.count_if(F.col("status") == Status.SUCCESS.value).alias("succeeded"),
        F.count_if(F.col("status") == Status.FAILED.value).alias("failed"),
        F.count_if(F.col("status") == Status.NO_DATA.value).alias("empty"),
        F.sum("rows_input").alias("rows_input"),
        F.sum("rows_output").alias("rows_output"),
        F.sum("duration_sec").alias("duration_sec"),
    )


def overall_status(metrics: list[JobMetrics]) -> Status:
    """SUCCESS when nothing failed, FAILED when nothing worked, else PARTIAL."""
    failed = sum(m.status == Status.FAILED for m in metrics)
    if not failed:
        return Status.SUCCESS
    return Status.FAILED if failed == len(metrics) else Status.PARTIAL
