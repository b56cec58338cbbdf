"""One row per key: latest version, first copy, and the refusal of duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def any_null(keys: Sequence[str]) -> Column:
    found = F.lit(False)
    for key in keys:
        found = found | F.col(key).isNull()
    return found


def top_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark turns ``row_number() = 1`` into a per-task limit ahead of the shuffle, so every task
    sends at most one row per key and a key that holds a large part of the table is reduced
    where it is read.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(window)).where("_row = 1").drop("_row")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: str, tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """The row with the highest ``order_by`` for each key; NULL ranks lowest.

    Equal values are settled by the tie breakers, highest first. Name enough of them for a
    total order, or the choice between equal rows is arbitrary.
    """
    return top_row_per_key(df, keys, [F.col(c).desc_nulls_last() for c in (order_by, *tie_breakers)])


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The earliest row for each key."""
    return top_row_per_key(df, keys, [F.col(c).asc_nulls_last() for c in order_by])


def unique_keyed_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key has no NULL, failing the job when two of them share a key.

    The check is part of the plan: it groups on the key that a following join needs anyway,
    and copies are counted before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.first(F.struct(*rest, F.lit(0).alias("_"))).alias("_row")
    grouped = df.where(~any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"), row)
    message = F.concat(F.lit("duplicate source key: "), F.to_json(F.struct(*keys)))
    refusal = F.when(F.col("_copies") > 1, F.raise_error(message).cast("boolean"))
    checked = grouped.where(refusal.otherwise(F.lit(True)))
    return checked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)
