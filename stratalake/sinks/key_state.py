"""Which keys a table holds, and how often, kept beside it as a small table of digests.

State rows are dealt into folders by the first digits of the key's digest. A batch is compared with the folders its own
keys fall into and with no others, and what is compared are digests, never rows. The state grows by runs (see ``runs``): a
merge run replaces the counts of its keys, an append run adds to them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sinks.runs import ROW_KEY, RUN, Kind, Run, drop_superseded, live_runs, read_runs, with_row_key, write_run

BUCKET = "key_bucket"
#: Hexadecimal digits of a digest that name its folder: 16 ** DIGITS folders at most.
DIGITS = 2
FOLD_AFTER = 32


def bucket_of(digits: int = DIGITS) -> Column:
    return F.concat(F.lit("k"), F.lower(F.substring(F.hex(ROW_KEY), 1, digits)))  # a letter ahead: never read as a number


def with_buckets(df: DataFrame, keys: Sequence[str], digits: int = DIGITS) -> DataFrame:
    """Add digest and folder of the key; both NULL where part of the key is."""
    return with_row_key(df, list(keys)).withColumn(BUCKET, bucket_of(digits))


def key_counts(df: DataFrame, keys: Sequence[str], digits: int = DIGITS) -> DataFrame:
    """row_key, key_bucket and n of rows, counted in each task before the shuffle. Keys with a NULL are left out."""
    keyed = with_buckets(df.select(*keys), keys, digits).where(F.col(ROW_KEY).isNotNull())
    return keyed.groupBy(ROW_KEY, BUCKET).agg(F.count(F.lit(1)).alias("n"))


def _counts(spark: SparkSession, path: str, runs: list[Run], buckets: list[str] | None) -> DataFrame:
    state = read_runs(spark, path, runs)
    if buckets is not None:
        state = state.where(F.col(BUCKET).isin(buckets))
    merged = F.max(F.when(F.col(RUN).endswith(str(Kind.MERGE)), F.col(RUN)))
    by_run = state.groupBy(ROW_KEY, BUCKET, RUN).agg(F.sum("n").alias("n"))
    lists = by_run.groupBy(ROW_KEY, BUCKET).agg(merged.alias("_last"), F.collect_list(F.struct(RUN, "n")).alias("_all"))
    left = F.filter("_all", lambda r: F.col("_last").isNull() | (r[RUN] >= F.col("_last")))
    return lists.select(ROW_KEY, BUCKET, F.aggregate(left, F.lit(0).cast("bigint"), lambda a, r: a + r["n"]).alias("n"))


def held(batch: DataFrame, path: str) -> DataFrame | None:
    """row_key of the keys of ``batch`` that the state holds, once or more; None before the first run.

    ``batch`` is a written table with row_key and key_bucket. The names of its folders, 16 ** digits at most, are brought
    to the driver, so the scan lists and reads nothing else.
    """
    spark = batch.sparkSession
    runs = live_runs(spark, path)
    if not runs:
        return None
    touched = [r[0] for r in batch.select(BUCKET).where(F.col(BUCKET).isNotNull()).distinct().collect()]
    state = read_runs(spark, path, runs).where(F.col(BUCKET).isin(touched))  # a key is there once at least, whatever its count
    return state.select(ROW_KEY).join(batch.select(ROW_KEY), ROW_KEY, "left_semi")


def record(counts: DataFrame, path: str, kind: Kind = Kind.APPEND, fold_after: int = FOLD_AFTER) -> None:
    """Add counts as a run: a base starts anew, a merge replaces, an append adds."""
    spark = counts.sparkSession
    write_run(counts.select(ROW_KEY, "n", BUCKET).repartition(BUCKET), path, kind, (BUCKET,))
    if kind is Kind.BASE:
        drop_superseded(spark, path)
    elif len(live_runs(spark, path)) > fold_after:
        fold_state(spark, path)


def fold_state(spark: SparkSession, path: str) -> None:
    """Write the present counts as a new base run."""
    counts = _counts(spark, path, live_runs(spark, path), None)
    write_run(counts.select(ROW_KEY, "n", BUCKET).repartition(BUCKET), path, Kind.BASE, (BUCKET,))


def repeated_keys(counts: DataFrame, path: str) -> DataFrame:
    """row_key and copies of the keys of a batch that it, or the state and it together, hold more than once.

    ``counts`` is what ``key_counts`` gave for the batch, written. Call it before ``record``.
    """
    spark = counts.sparkSession
    runs = live_runs(spark, path)
    total = F.col("n")
    if runs:
        touched = [r[0] for r in counts.select(BUCKET).distinct().collect()]
        before = _counts(spark, path, runs, touched).select(ROW_KEY, F.col("n").alias("_before"))
        counts = counts.join(before, ROW_KEY, "left")
        total = F.col("n") + F.coalesce("_before", F.lit(0))
    return counts.select(ROW_KEY, total.alias("copies")).where("copies > 1")
