"""Versioned dimensions: what changed, and the next state of the whole history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.digest import differs
from stratalake.operators.dedup import as_timestamp
from stratalake.operators.keys import any_null, unique_keyed_rows

VALIDITY = ("valid_from", "valid_to", "is_current")


def current_rows(history: DataFrame) -> DataFrame:
    return history.where(F.col("is_current"))


def open_versions(rows: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Rows as versions that start at ``as_of`` and have no end."""
    return rows.withColumns(
        {
            "valid_from": as_timestamp(as_of),
            "valid_to": F.lit(None).cast("timestamp_ntz"),
            "is_current": F.lit(True),
        }
    )


def _equal(left: str, right: str, keys: Sequence[str]) -> Column:
    test = F.lit(True)
    for key in keys:
        test = test & (F.col(f"{left}.{key}") == F.col(f"{right}.{key}"))
    return test


def classify(
    incoming: DataFrame, history: DataFrame | None, keys: Sequence[str], compare: Sequence[str]
) -> DataFrame:
    """Incoming rows with ``change``: new, changed or unchanged against the current versions.

    Only the keys and compared columns of the current versions are read.
    """
    if history is None:
        return incoming.withColumn("change", F.lit("new"))
    current = current_rows(history).select(*keys, *compare, F.lit(True).alias("_known"))
    label = (
        F.when(F.col("old._known").isNull(), "new")
        .when(differs([F.col(f"new.{c}") for c in compare], [F.col(f"old.{c}") for c in compare]), "changed")
        .otherwise("unchanged")
    )
    joined = incoming.alias("new").join(current.alias("old"), _equal("new", "old", keys), "left")
    return joined.select("new.*", label.alias("change"))


def changed_versions(
    incoming: DataFrame,
    history: DataFrame | None,
    keys: Sequence[str],
    compare: Sequence[str],
    as_of: datetime | Column,
) -> DataFrame:
    """Only the versions a run opens: rows that are new or changed."""
    moved = classify(incoming, history, keys, compare).where("change <> 'unchanged'").drop("change")
    return open_versions(moved, as_of)


def opened_versions(
    incoming: DataFrame,
    current: DataFrame | None,
    keys: Sequence[str],
    compare: Sequence[str],
    as_of: datetime | Column,
) -> DataFrame:
    """The incoming rows that open a version, with ``change``: new or changed keys, and every row with a NULL key.

    ``current`` holds keys, compared columns and ``valid_from`` of the open versions; without any, all rows are new.
    A key twice in ``incoming`` and a change older than the version it meets fail the run.
    """
    keyed = unique_keyed_rows(incoming, keys)
    unkeyed = incoming.where(any_null(keys))
    if current is None:
        return keyed.unionByName(unkeyed).withColumn("change", F.lit("new"))
    known = current.withColumn("_known", F.lit(True)).alias("old")
    label = (
        F.when(F.col("old._known").isNull(), "new")
        .when(differs([F.col(f"new.{c}") for c in compare], [F.col(f"old.{c}") for c in compare]), "changed")
        .otherwise("unchanged")
    )
    joined = keyed.alias("new").join(known, _equal("new", "old", keys), "left")
    judged = joined.select("new.*", label.alias("change"), F.col("old.valid_from").alias("_began"))
    late = (F.col("change") == "changed") & (F.col("_began") > as_timestamp(as_of))
    refusal = F.raise_error(F.lit("as_of lies before the start of a current version")).cast("boolean")
    moved = judged.where(F.when(late, refusal).otherwise(F.col("change") != "unchanged")).drop("_began")
    return moved.unionByName(unkeyed.withColumn("change", F.lit("without key")))


def change_counts(
    incoming: DataFrame, history: DataFrame | None, keys: Sequence[str], compare: Sequence[str]
) -> DataFrame:
    """One row: how many incoming rows are new, changed, unchanged."""
    kinds = ("new", "changed", "unchanged")
    counts = [F.count_if(F.col("change") == kind).alias(f"rows_{kind}") for kind in kinds]
    return classify(incoming, history, keys, compare).agg(*counts)


def next_history(
    incoming: DataFrame,
    history: DataFrame | None,
    keys: Sequence[str],
    compare: Sequence[str],
    as_of: datetime | Column,
    observation=None,
) -> DataFrame:
    """The whole history after a run.

    A changed key closes its current version at ``as_of`` and opens another; a new key opens
    one; unchanged keys and keys missing from the incoming rows stay as they are. Running the
    same rows again changes nothing. A key twice in ``incoming`` fails the run; rows with a NULL key
    match nothing and open a version each. A version that itself began at ``as_of`` is replaced in place,
    and a change older than the version it meets fails the run.

    One full join of the incoming rows with the current versions yields every result row; the
    closed versions are passed through without one. ``observation`` collects row counts.
    """
    if history is None:
        opened = open_versions(
            unique_keyed_rows(incoming, keys).unionByName(incoming.where(any_null(keys))), as_of
        )
        return opened if observation is None else opened.observe(
            observation, F.count(F.lit(1)).alias("rows_new"), F.lit(0).alias("rows_changed")
        )

    attributes = [c for c in history.columns if c not in VALIDITY]
    incoming = incoming.select(*attributes)
    keyed = unique_keyed_rows(incoming, keys)
    closed = history.where(~F.coalesce("is_current", F.lit(False)))
    current = current_rows(history)

    new = keyed.select(F.struct(*attributes).alias("new"))
    old = current.where(~any_null(keys)).select(F.struct(*history.columns).alias("old"))
    joined = new.join(old, _equal("new", "old", keys), "full").withColumn(
        "change",
        F.when(F.col("old").isNull(), "new")
        .when(F.col("new").isNull(), "missing")
        .when(differs([F.col(f"new.{c}") for c in compare], [F.col(f"old.{c}") for c in compare]), "changed")
        .otherwise("unchanged"),
    )
    if observation is not None:
        joined = joined.observe(
            observation,
            F.count_if(F.col("change") == "new").alias("rows_new"),
            F.count_if(F.col("change") == "changed").alias("rows_changed"),
        )

    def version(side: str, validity: dict[str, Column]) -> Column:
        return F.struct(
            *[validity.get(c, F.col(f"{side}.{c}")).alias(c) for c in history.columns]
        )

    types = {c: history.schema[c].dataType for c in VALIDITY}
    start = as_timestamp(as_of).cast(types["valid_from"])
    never = F.lit(None).cast(types["valid_to"])
    began = F.col("old.valid_from")
    in_time = F.when(
        (F.col("change") == "changed") & (began > start), F.raise_error(F.lit("as_of lies before the start of a current version")).cast("boolean")
    ).otherwise(began < start)
    opens = version("new", {"valid_from": start, "valid_to": never, "is_current": F.lit(True)})
    ends = version("old", {"valid_to": start.cast(types["valid_to"]), "is_current": F.lit(False)})
    versions = F.array_compact(
        F.array(
            F.when((F.col("change") == "changed") & in_time, ends),
            F.when(F.col("change").isin("new", "changed"), opens),
            F.when(F.col("change").isin("missing", "unchanged"), F.col("old")),
        )
    )
    unkeyed = open_versions(incoming.where(any_null(keys)), as_of).select(*history.columns)
    return (
        joined.select(F.inline(versions))
        .select(*history.columns)
        .unionByName(closed)
        .unionByName(current.where(any_null(keys)))
        .unionByName(unkeyed)
    )
