"""Table reads with filters that reach the scan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Look-back window in days.
DEFAULT_LOOKBACK_DAYS = 14
LOOKBACK_LIMITS = (1, 365)


def read_table(
    spark: SparkSession,
    location: str,
    where: str | Column | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """A Parquet path (anything with a slash) or a catalog table, filtered and pruned."""
    df = spark.read.parquet(location) if "/" in location else spark.table(location)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def look_back(
    df: DataFrame,
    as_of: date | datetime,
    days: int = DEFAULT_LOOKBACK_DAYS,
    column: str = "loaded_at",
    partition_column: str = "load_date",
    until: datetime | None = None,
) -> DataFrame:
    """Rows loaded on or after the day ``days`` before ``as_of``, and not after ``until`` where it is given.

    The cut is a whole day, so on a table partitioned by load date the same bound also
    prunes directories. Name ``until`` to let a run repeat although more has been loaded since.
    """
    low, high = LOOKBACK_LIMITS
    if not low <= days <= high:
        raise ValueError(f"look-back must be {low} to {high} days, got {days}")
    day = as_of.date() if isinstance(as_of, datetime) else as_of
    cut = day - timedelta(days=days)
    kept = F.col(column) >= F.lit(cut)
    if until is not None:
        kept &= F.col(column) <= F.lit(until.replace(tzinfo=None)).cast("timestamp_ntz")
    if partition_column in df.columns:
        kept &= F.col(partition_column) >= F.lit(cut)
        if until is not None:
            kept &= F.col(partition_column) <= F.lit(until.date())
    return df.where(kept)


def date_range(
    df: DataFrame, column: str, first: str, last: str, max_days: int | None = None
) -> DataFrame:
    """Rows whose day lies between two YYYY-MM-DD days, both included.

    Written as a half-open range on the bare column, which the Parquet reader can push down.
    """
    try:
        start, end = (datetime.strptime(text, "%Y-%m-%d").date() for text in (first, last))
    except ValueError as bad:
        raise ValueError(f"dates must be YYYY-MM-DD: {bad}") from None
    if start > end:
        raise ValueError(f"range starts {start} after it ends {end}")
    if max_days is not None and (end - start).days > max_days:
        raise ValueError(f"range is longer than {max_days} days")
    return df.where((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end + timedelta(days=1))))


def find_by_key(df: DataFrame, column: str, value) -> DataFrame:
    """At most one row with this business key; the filter is pushed into the scan."""
    return df.where(F.col(column) == F.lit(value)).limit(1)


def first_rows(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order (a top-n, not a full sort)."""
    return df.orderBy(*order_by).limit(n)
