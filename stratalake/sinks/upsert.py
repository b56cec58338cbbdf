"""Keyed tables on Parquet that merge on read.

An upsert appends its rows as a run of their own and touches nothing else (see ``runs``): its cost is that of its source.
A reader takes, of the rows of a key, those no later merge replaced; the changed keys of all merges since the last base run
are the small side of that join, so the base is not shuffled. ``fold`` writes the result as a new base.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.keys import any_null
from stratalake.operators.quality import duplicate_keys
from stratalake.sinks.runs import ROW_KEY, RUN, Kind, Run, drop_superseded, live_runs, read_runs, with_row_key, write_run

#: Runs on top of a base after which a merge folds them in.
FOLD_AFTER = 32


def _resolved(spark: SparkSession, path: str, runs: list[Run]) -> DataFrame:
    table = read_runs(spark, path, runs)
    later = [r for r in runs[1:] if r.kind is Kind.MERGE]
    if not later:  # nothing can have been replaced
        return table.drop(RUN)
    changed = read_runs(spark, path, later).where(F.col(ROW_KEY).isNotNull())
    changed = changed.groupBy(ROW_KEY).agg(F.max(RUN).alias("_last"))
    before = F.col("_last").isNull() | (F.col(RUN) >= F.col("_last"))
    return table.join(changed, ROW_KEY, "left").where(before).drop("_last", RUN)


def read_keyed(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a keyed table, or None before the first write."""
    runs = live_runs(spark, path)
    return _resolved(spark, path, runs).drop(ROW_KEY) if runs else None


def _fitted(rows: DataFrame, table: DataFrame | None) -> DataFrame:
    """The rows with the columns and types of the table, as far as they have them."""
    if table is None:
        return rows
    missing = [c for c in rows.columns if c not in table.columns]
    if missing:
        raise ValueError(f"target lacks source columns: {', '.join(missing)}")
    return rows.select(*[F.col(c).cast(table.schema[c].dataType).alias(c) for c in table.columns if c in rows.columns])


def rebuild_table(df: DataFrame, path: str, keys: Sequence[str], buckets: int, staged: bool = False) -> None:
    """Write a keyed table from scratch, in about ``buckets`` files. An empty frame leaves the old table.

    Set ``staged`` where the rows are those of a table just written: its splits are then put together to at most that
    many files, and no row is shuffled.
    """
    if not df.isEmpty():
        keyed = with_row_key(df, list(keys))
        spread = F.coalesce(F.xxhash64(ROW_KEY), F.xxhash64(*df.columns)) if keys else F.xxhash64(*df.columns)
        write_run(keyed.coalesce(buckets) if staged else keyed.repartition(buckets, spread), path, Kind.BASE)
        drop_superseded(df.sparkSession, path)


def append_keyed(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Add rows to a keyed table without looking for matches."""
    if not df.isEmpty():
        rows = _fitted(df, read_keyed(df.sparkSession, path))
        write_run(with_row_key(rows, list(keys)), path, Kind.APPEND)


def _refuse_copies(source: DataFrame, keys: list[str]) -> None:
    """Fail where two rows have one key."""
    keyed = with_row_key(source.select(*keys), keys).where(F.col(ROW_KEY).isNotNull())
    if copies := duplicate_keys(keyed.select(ROW_KEY), [ROW_KEY]).take(1):
        found = keyed.where(F.col(ROW_KEY) == F.lit(bytes(copies[0][ROW_KEY]))).select(F.to_json(F.struct(*keys)).alias("key"))
        raise ValueError(f"duplicate source key: {found.first()['key']}")


def upsert_table(
    source: DataFrame, path: str, keys: Sequence[str], buckets: int = 64, fold_after: int = FOLD_AFTER
) -> None:
    """Merge source rows into a keyed table: the rows that ``merge_rows`` would give are read from then on.

    The table itself is read only where the source lacks some of its columns, whose values are then
    carried over. Two source rows with one key fail the job before anything is written: digests of the keys are counted
    ahead of the write, so the source is read twice, and its rows are not shuffled.
    """
    spark = source.sparkSession
    if source.isEmpty():
        return
    keys = list(keys)
    table = read_keyed(spark, path)
    source = _fitted(source.select(*[c for c in source.columns if not c.startswith("_")]), table)
    _refuse_copies(source, keys)
    rows = source.where(~any_null(keys))
    unkeyed = source.where(any_null(keys))
    if table is not None and (own := [c for c in table.columns if c not in source.columns]):
        kept = table.where(~any_null(keys)).select(*keys, *own).join(source.select(*keys), keys, "left_semi")
        rows = rows.join(kept, keys, "left").select(*table.columns)
        unkeyed = unkeyed.withColumns({c: F.lit(None).cast(table.schema[c].dataType) for c in own}).select(*table.columns)
    write_run(with_row_key(rows.unionByName(unkeyed), keys), path, Kind.MERGE)
    if len(live_runs(spark, path)) > fold_after:
        fold(spark, path, buckets)


def fold(spark: SparkSession, path: str, buckets: int = 64) -> bool:
    """Write the present rows as a new base run; False when there is nothing to fold.

    Readers that have begun keep to the runs they listed; ``drop_superseded`` removes those later.
    """
    runs = live_runs(spark, path)
    if len(runs) < 2:
        return False
    rows = _resolved(spark, path, runs)
    spread = F.coalesce(F.xxhash64(ROW_KEY), F.xxhash64(*[c for c in rows.columns if c != ROW_KEY]))
    write_run(rows.repartition(buckets, spread), path, Kind.BASE)
    return True


def merge_into_catalog(source: DataFrame, table: str, keys: Sequence[str]) -> None:
    """The same upsert on a catalog table whose format can change rows in place.

    Spark runs it as a MERGE, so only the affected files are touched. Plain Parquet tables
    cannot do that; ``upsert_table`` is for them.
    """
    columns = [c for c in source.columns if not c.startswith("_")]
    incoming = source.select(*columns).alias("source")
    match = F.lit(True)
    for key in keys:
        match = match & (F.col(f"{table}.{key}") == F.col(f"source.{key}"))
    values = {c: F.col(f"source.{c}") for c in columns}
    incoming.mergeInto(table, match).whenMatched().update(values).whenNotMatched().insert(values).merge()
