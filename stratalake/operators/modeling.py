"""Cleaned rows to dimension and fact rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.calendar import calendar_columns, date_key
from stratalake.functions.digest import surrogate_key
from stratalake.operators.keys import any_null
from stratalake.operators.lookup import add_dimension_key, add_dimension_keys
from stratalake.specs import DATE_DIMENSION_RANGE, DimensionSpec, FactSpec


def dimension_rows(cleaned: DataFrame, spec: DimensionSpec, key: str = "id") -> DataFrame:
    """The natural key under its dimension name, and the tracked attributes."""
    return cleaned.select(F.col(key).alias(spec.key), *spec.attributes)


def fact_rows(cleaned: DataFrame, spec: FactSpec, key: str = "id", found: Sequence[str] = ()) -> DataFrame:
    """The fact's own key, its columns, its days, an integer key for each day, and the dimension keys ``found`` before."""
    return cleaned.select(
        F.col(key).alias(spec.key),
        *spec.columns,
        *[F.to_date(c).alias(c) for c in spec.days],
        "created_at",
        surrogate_key([key]).alias(spec.surrogate),
        *[date_key(F.to_date(c)).alias(f"{c}_sk") for c in spec.day_keys],
        *found,
    )


def fact_with_keys(
    facts: DataFrame,
    spec: FactSpec,
    dimensions: Mapping[str, DataFrame],
    surrogates: Mapping[str, tuple[str, str]],
    valid_at: Column | None = None,
    salts: int = 1,
    slice_days: int | None = None,
    content: Column | None = None,
    shares: Mapping[str, int] | None = None,
) -> DataFrame:
    """Rows with the surrogate key of every dimension that the fact refers to; call it before ``fact_rows``, as what
    that adds need not be moved.

    ``surrogates`` gives each dimension's surrogate and natural key. With ``valid_at`` the versions valid at that moment are
    taken instead of the current ones. A surrogate is the digest of a key and its version's start, so what is
    looked up, and moved from one look-up to the next, is the start. ``content`` stands for a row where rows
    are dealt out by their content. With ``shares``, by dimension, rows are moved once for all look-ups of current
    versions (see ``add_dimension_keys``), and not once for each dimension too large for a broadcast.
    """
    content = F.xxhash64(*facts.columns) if content is None else content
    starts, digests = {}, {}
    for fact_key, name in spec.lookups.items():
        surrogate, natural = surrogates[name]
        start = f"_{surrogate}_start"
        starts[fact_key] = (dimensions[name].withColumn(start, F.col("valid_from")), start, natural)
        digests[surrogate] = F.when(F.col(start).isNotNull(), surrogate_key([fact_key, start]))
    if shares is not None and valid_at is None:
        by_key = {fact_key: shares.get(name, 1) for fact_key, name in spec.lookups.items()}
        facts = add_dimension_keys(facts, starts, by_key, salts, content)
    else:
        spread = F.when(any_null(list(spec.lookups)), content).otherwise(F.pmod(content, F.lit(salts)))
        facts = facts.withColumn("_spread", spread)
        for fact_key, (dimension, start, natural) in starts.items():
            facts = add_dimension_key(facts, dimension, start, natural, fact_key, valid_at, salts, slice_days, F.col("_spread"))
    return facts.withColumns(digests).drop("_spread", *[f"_{surrogate}_start" for surrogate in digests])


def date_rows(
    spark: SparkSession, first: str = DATE_DIMENSION_RANGE[0], last: str = DATE_DIMENSION_RANGE[1]
) -> DataFrame:
    """One row per day, both ends included, with calendar attributes."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(days).alias("day")).select(*named_calendar("day"))


def date_rows_covering(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the earliest to the latest day of a column."""
    ends = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    days = F.sequence(F.to_date("first"), F.to_date("last"))
    return ends.select(F.explode(days).alias("day")).select(*named_calendar("day"))


def named_calendar(column: str) -> list:
    return [expr.alias(name) for name, expr in calendar_columns(column).items()]
