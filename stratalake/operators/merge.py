"""Upsert: update what matches, insert what does not, keep the rest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators.keys import any_null, unique_keyed_rows


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after the source has been merged into it on equal keys.

    Source columns that start with an underscore are left out. Columns only the target has
    keep their value on an update and are NULL on an insert. A NULL key matches nothing; such
    rows take no part in any join, so many of them do not meet in one task. Two source rows
    with the same key fail the job.

    The source is the right side of every join with the target, so a small one is broadcast
    and the target is not shuffled.
    """
    keys = list(keys)
    columns = [c for c in source.columns if not c.startswith("_")]
    missing = [c for c in columns if c not in target.columns]
    if missing:
        raise ValueError(f"target lacks source columns: {', '.join(missing)}")
    own = [c for c in target.columns if c not in columns]

    source = source.select(*columns)
    keyed, unkeyed = source.where(~any_null(keys)), source.where(any_null(keys))
    target_keyed = target.where(~any_null(keys))
    incoming = unique_keyed_rows(source, keys)
    if own:
        matched = target_keyed.select(*keys, *own).join(keyed.select(*keys), keys, "left_semi")
        incoming = incoming.join(matched, keys, "left")
        unkeyed = unkeyed.withColumns({c: F.lit(None).cast(target.schema[c].dataType) for c in own})

    kept = target_keyed.join(keyed.select(*keys), keys, "left_anti")
    parts = [kept, target.where(any_null(keys)), incoming, unkeyed]
    return reduce(DataFrame.unionByName, [part.select(*target.columns) for part in parts])
