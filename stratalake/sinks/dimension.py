"""Versioned dimensions on Parquet, kept as a log of versions.

A run appends the versions it opens and nothing else, so one changed row is one written row (see ``runs``). Where a
version ends is not stored with it: it is where the next version of its key begins. ``fold_dimension`` writes a snapshot in
which closed versions are set apart with their ends; from then on only open versions and later runs are looked through.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.functions.digest import surrogate_key
from stratalake.operators.history import VALIDITY, open_versions, opened_versions
from stratalake.operators.keys import top_row_per_key
from stratalake.sinks.runs import ROW_KEY, RUN, Kind, Run, drop_superseded, live_runs, read_runs, with_row_key, write_run

CLOSED = "closed"
#: Runs on top of a snapshot after which an update folds them in.
FOLD_AFTER = 32


def _open_log(spark: SparkSession, path: str, runs: list[Run]) -> DataFrame:
    """Versions that may be open: those of the snapshot and all of later runs, the last one of each key and start."""
    log = read_runs(spark, path, runs).where(F.col(CLOSED) == 0).drop(CLOSED, "valid_to")
    keyed = top_row_per_key(log.where(F.col(ROW_KEY).isNotNull()), [ROW_KEY, "valid_from"], [F.col(RUN).desc()])
    return keyed.unionByName(log.where(F.col(ROW_KEY).isNull()))


def _with_validity(log: DataFrame) -> DataFrame:
    """valid_to and is_current from the start of the key's next version. Rows without a key have none."""
    following = F.lead("valid_from").over(Window.partitionBy(ROW_KEY).orderBy("valid_from"))
    keyed = log.where(F.col(ROW_KEY).isNotNull()).withColumn("valid_to", following)
    lone = log.where(F.col(ROW_KEY).isNull()).withColumn("valid_to", F.lit(None).cast(log.schema["valid_from"].dataType))
    return keyed.unionByName(lone).withColumn("is_current", F.col("valid_to").isNull())


def _history(spark: SparkSession, path: str, runs: list[Run]) -> DataFrame:
    closed = read_runs(spark, path, runs[:1]).where(F.col(CLOSED) == 1).drop(CLOSED)
    derived = _with_validity(_open_log(spark, path, runs))
    return closed.withColumn("is_current", F.lit(False)).unionByName(derived).drop(RUN)


def read_dimension(spark: SparkSession, path: str) -> DataFrame | None:
    """All versions with their validity, or None before the first run."""
    runs = live_runs(spark, path)
    if not runs:
        return None
    rows = _history(spark, path, runs).drop(ROW_KEY)
    return rows.select(*[c for c in rows.columns if c not in VALIDITY], *VALIDITY)


def _write(rows: DataFrame, path: str, kind: Kind) -> None:
    """Versions as a run, those with an end in a folder of their own; only a snapshot has any."""
    rows = rows.drop("is_current").withColumn(CLOSED, F.col("valid_to").isNotNull().cast("int"))
    write_run(rows, path, kind, (CLOSED,))


def update_dimension(
    incoming: DataFrame,
    path: str,
    surrogate: str,
    keys: Sequence[str],
    as_of: datetime,
    compare: Sequence[str] | None = None,
    rebuild: bool = False,
    fold_after: int = FOLD_AFTER,
) -> dict[str, int]:
    """Bring a dimension up to date with one row per key; returns rows new and changed.

    Only new and changed keys, and rows without a key, are written. A version that itself began at ``as_of`` is
    replaced by the later run's; an older ``as_of`` than that of a version it would change fails the run. A
    rebuild starts a new history; from no rows it leaves the table as it is.
    """
    spark = incoming.sparkSession
    if rebuild and incoming.isEmpty():
        return {"rows_new": 0, "rows_changed": 0}
    compare = list(compare or [c for c in incoming.columns if c not in keys])
    runs = [] if rebuild else live_runs(spark, path)
    current = None
    if runs:
        log = _open_log(spark, path, runs)
        attributes = [c for c in log.columns if c not in (*VALIDITY, surrogate, ROW_KEY, RUN)]
        incoming = incoming.select(*attributes)
        keyed = log.where(F.col(ROW_KEY).isNotNull())
        current = top_row_per_key(keyed, [ROW_KEY], [F.col("valid_from").desc()]).select(*keys, *compare, "valid_from")
    opened = open_versions(opened_versions(incoming, current, list(keys), compare, as_of), as_of)
    rows = opened.select(surrogate_key([*keys, "valid_from"]).alias(surrogate), *opened.columns)
    counts = Observation()  # on top of the plan: adaptive execution may drop what lies below an empty exchange
    counted = with_row_key(rows, list(keys)).observe(
        counts,
        F.count_if(F.col("change") == "new").alias("rows_new"),
        F.count_if(F.col("change") == "changed").alias("rows_changed"),
    )
    _write(counted.drop("change"), path, Kind.MERGE if runs else Kind.BASE)
    if not runs:
        drop_superseded(spark, path)
    if len(runs) >= fold_after:
        fold_dimension(spark, path)
    return dict(counts.get)


def fold_dimension(spark: SparkSession, path: str) -> bool:
    """Write the history as a new snapshot; False when there is nothing to fold."""
    runs = live_runs(spark, path)
    if len(runs) < 2:
        return False
    _write(_history(spark, path, runs).hint("rebalance", "is_current"), path, Kind.BASE)
    return True
