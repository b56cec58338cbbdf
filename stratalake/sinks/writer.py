"""Plain table writes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from enum import StrEnum

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratalake.sources.workspace import COMPACT, read_if_written


RAW_SCHEMA = "id string, data string, record_hash string, loaded_at timestamp_ntz, load_date date"


class Mode(StrEnum):
    """How a write treats a table that exists."""

    APPEND = "append"
    OVERWRITE = "overwrite"
    ERROR = "error"
    MERGE = "merge"


def write_table(
    df: DataFrame,
    path: str,
    mode: Mode | str = Mode.ERROR,
    partition_by: Sequence[str] = (),
    max_rows_per_file: int | None = None,
) -> int:
    """Write a Parquet table and return the number of rows written.

    An empty frame does not overwrite, so it cannot wipe a table. The rows are counted by the
    write itself.
    """
    mode = Mode(mode)
    if mode is Mode.MERGE:
        raise ValueError("merging needs keys: use upsert_table")
    if max_rows_per_file is not None and max_rows_per_file <= 0:
        raise ValueError(f"rows per file must be positive, got {max_rows_per_file}")
    if mode is Mode.OVERWRITE and df.isEmpty():
        return 0
    rows = Observation()
    writer = df.observe(rows, F.count(F.lit(1)).alias("rows")).write.options(**COMPACT).mode(mode.value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(path)
    return rows.get["rows"]


def silver_mode(full_rebuild: bool, merge: bool = True) -> Mode:
    """Cleaned tables: rebuilt, merged, or appended to."""
    return Mode.OVERWRITE if full_rebuild else Mode.MERGE if merge else Mode.APPEND


def gold_mode(rebuild: bool) -> Mode:
    """Dimensional tables: rebuilt or appended to."""
    return Mode.OVERWRITE if rebuild else Mode.APPEND


def append_raw(
    raw: DataFrame, path: str, max_rows_per_file: int | None = None, many_days: bool = False
) -> int:
    """Append raw rows to a table partitioned by load date.

    A load has one load date and is written as it comes. Set ``many_days`` for a back-fill:
    rows are then brought together by day first, or every task would write a file for each.
    """
    dated = raw.withColumn("load_date", F.to_date("loaded_at"))
    if many_days:
        dated = dated.hint("rebalance", "load_date")
    return write_table(dated, path, Mode.APPEND, ["load_date"], max_rows_per_file)


def read_raw(spark: SparkSession, path: str) -> DataFrame | None:
    """A raw table, or None while nothing has been loaded."""
    return read_if_written(spark, path, RAW_SCHEMA)


def append_raw_bucketed(raw: DataFrame, table: str, path: str, buckets: int) -> None:
    """Append raw rows to a catalog table bucketed by record hash.

    Later loads compare hashes with the whole table; bucketed, it is read for that without
    being shuffled. Choose the bucket count for the table's final size, it cannot change.
    """
    dated = raw.withColumn("load_date", F.to_date("loaded_at"))
    (
        dated.repartition(buckets, "record_hash")
        .write.mode("append")
        .format("parquet")
        .option("path", path)
        .partitionBy("load_date")
        .bucketBy(buckets, "record_hash")
        .saveAsTable(table)
    )


def write_json_run(df: DataFrame, root: str, resource: str, extracted_at: datetime) -> str | None:
    """Write records as JSON lines in a directory of their own; nothing when there are none."""
    if df.isEmpty():
        return None
    path = f"{root}/{resource}_{extracted_at:%Y%m%d_%H%M%S}"
    options = {
        "ignoreNullFields": "false",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    }
    df.write.options(**options).json(path)
    return path
