"""Loading raw rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.dedup import RAW_COLUMNS, fresh_rows, rows_not_numbered, rows_numbered
from stratalake.plans.layout import Layout
from stratalake.plans.metrics import JobMetrics, Status, measured
from stratalake.sinks.key_state import BUCKET, held, key_counts, record, with_buckets
from stratalake.sinks.runs import ROW_KEY, Kind, drop_folder, is_finished, live_runs
from stratalake.sinks.writer import append_raw, read_raw
from stratalake.sources.workspace import COMPACT, written

STEP = "raw"


def _finish_interrupted(spark: SparkSession, name: str, layout: Layout) -> None:
    """Bring the keys up to date with the raw table.

    They lag behind where a load was cut off between its append and the record of its keys. Its choice of rows is then still
    staged; of the days it was about to append to, and only of those, the hashes are read. Without any keys those of the
    whole table are taken.
    """
    choice, keys = f"{layout.staging(name)}/fresh", layout.keys(name)
    started = bool(live_runs(spark, keys))
    if started and not is_finished(spark, choice):
        return
    table = read_raw(spark, layout.raw(name))
    if table is None:
        return
    if started:
        days = [r[0] for r in spark.read.parquet(choice).select("load_date").distinct().collect()]  # the days of one load
        table = table.where(F.col("load_date").isin(days))
    counts = written(key_counts(table, ["record_hash"], layout.key_digits), "raw-keys")
    known = held(counts, keys)
    record(counts if known is None else counts.join(known, ROW_KEY, "left_anti"), keys, Kind.APPEND if started else Kind.BASE)
    drop_folder(spark, choice)


def append_new(raw: DataFrame, name: str, layout: Layout, skip_dedup: bool = False) -> tuple[int, int]:
    """Append the records of a batch that the raw table does not hold; returns rows read and rows appended.

    The batch is staged once. Its digests are compared with the keys on record in the folders they fall into. Of
    the texts those of new records are moved at most, and none while the rows that are left out, or those that are new, are few. The choice of rows is staged ahead of the append and dropped once their
    keys are recorded, so a load that was cut off in between is caught up with by the next one, and any load may
    simply be run again.
    """
    spark = raw.sparkSession
    staging, keys = layout.staging(name), layout.keys(name)
    _finish_interrupted(spark, name, layout)
    read = Observation()
    numbered = with_buckets(raw, ["record_hash"], layout.key_digits).withColumn("row_number", F.monotonically_increasing_id())
    numbered.observe(read, F.count(F.lit(1)).alias("rows")).write.options(**COMPACT).mode("overwrite").parquet(f"{staging}/batch")
    if not read.get["rows"]:
        return 0, 0
    staged = spark.read.schema(numbered.schema).parquet(f"{staging}/batch")
    if skip_dedup:
        chosen = staged.groupBy(ROW_KEY, BUCKET, F.to_date("loaded_at").alias("load_date")).agg(F.count(F.lit(1)).alias("n"))
    else:
        chosen = fresh_rows(staged, held(staged, keys)).withColumn("n", F.lit(1).cast("bigint"))
    new = Observation()
    chosen.observe(new, F.count(F.lit(1)).alias("rows")).write.options(**COMPACT).mode("overwrite").parquet(f"{staging}/fresh")
    left_out = 0 if skip_dedup else read.get["rows"] - new.get["rows"]
    chosen = spark.read.schema(chosen.schema).parquet(f"{staging}/fresh")
    if not left_out:
        rows = staged.select(*RAW_COLUMNS)
    elif left_out < new.get["rows"]:
        rows = rows_not_numbered(staged, written(staged.select("row_number").join(chosen, "row_number", "left_anti"), "left-out"))
    else:
        rows = rows_numbered(staged, chosen)
    added = append_raw(rows, layout.raw(name))
    record(chosen, keys)
    drop_folder(spark, f"{staging}/fresh")
    return read.get["rows"], added


def load_raw(raw: DataFrame, name: str, layout: Layout, skip_dedup: bool = False) -> JobMetrics:
    """Append the records of a batch that the raw table does not hold yet (see ``append_new``)."""

    def job(metrics: JobMetrics) -> Status:
        metrics.rows_input, metrics.rows_output = append_new(raw, name, layout, skip_dedup)
        return Status.SUCCESS if metrics.rows_input else Status.NO_DATA

    return measured(STEP, name, job)


def load_raw_batch(
    batches: Mapping[str, DataFrame], layout: Layout, skip_dedup: bool = False, keep_going: bool = False
) -> list[JobMetrics]:
    """Load several resources; the first failure ends the batch unless told to keep going."""
    done: list[JobMetrics] = []
    for name, raw in batches.items():
        done.append(load_raw(raw, name, layout, skip_dedup))
        if done[-1].status == Status.FAILED and not keep_going:
            break
    return done
