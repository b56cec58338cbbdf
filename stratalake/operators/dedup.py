"""Raw rows by content: hash, drop copies, skip what is already loaded."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.digest import UNHASHED_FIELDS, record_hash, record_hash_json, record_json
from stratalake.functions.json import merge_json
from stratalake.operators.keys import first_per_key

RAW_COLUMNS = ("id", "data", "record_hash", "loaded_at")


def as_timestamp(as_of: datetime | Column) -> Column:
    """``as_of`` as a timestamp without time zone."""
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp_ntz")


def raw_rows(
    df: DataFrame,
    id_column: str,
    loaded_at: datetime | Column,
    exclude: Sequence[str] = UNHASHED_FIELDS,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Typed rows as raw rows (id, data, record_hash, loaded_at)."""
    columns = list(columns or df.columns)
    return df.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"),
        record_json(columns).alias("data"),
        record_hash(columns, exclude).alias("record_hash"),
        as_timestamp(loaded_at).alias("loaded_at"),
    )


def raw_rows_from_json(
    df: DataFrame,
    loaded_at: datetime | Column,
    data: str = "data",
    id_field: str = "id",
    exclude: Sequence[str] = UNHASHED_FIELDS,
) -> DataFrame:
    """JSON records as raw rows; a record without the id field gets an empty id."""
    return df.select(
        F.coalesce(F.get_json_object(data, f"$['{id_field}']"), F.lit("")).alias("id"),
        F.col(data).alias("data"),
        record_hash_json(data, exclude).alias("record_hash"),
        as_timestamp(loaded_at).alias("loaded_at"),
    )


def add_source_fields(data: Column | str, resource: str, extracted_at: datetime) -> Column:
    """The JSON record with where it came from and when, as members of its own."""
    stamp = F.struct(
        F.lit(resource).alias("_resource"), F.lit(extracted_at.isoformat()).alias("_extracted_at")
    )
    return merge_json(data, F.to_json(stamp))


def drop_copies(raw: DataFrame) -> DataFrame:
    """One row per record hash: the earliest load, then the lowest id and text."""
    return first_per_key(raw, ["record_hash"], ["loaded_at", "id", "data"])


def already_loaded(raw: DataFrame, loaded: DataFrame) -> DataFrame:
    """Hashes of ``raw`` that the loaded table holds, once each.

    Only the hash columns are read. While the batch is small enough to broadcast, Spark moves
    the semi join below the distinct and the loaded table, the large side, is scanned without
    a shuffle. Beyond that, copies of a hash are merged per task before the shuffle, so a hash
    that fills a large part of the table does not meet in one task.
    """
    batch = raw.select("record_hash").distinct()
    return loaded.select("record_hash").distinct().join(batch, "record_hash", "left_semi")


def new_records(raw: DataFrame, loaded: DataFrame | None, skip_dedup: bool = False) -> DataFrame:
    """What a load adds: no copies, nothing loaded before, new content of a known id kept.

    ``skip_dedup`` lets everything through.
    """
    if skip_dedup:
        return raw
    if loaded is None:
        return drop_copies(raw)
    return drop_copies(raw.join(already_loaded(raw, loaded), "record_hash", "left_anti").select(*raw.columns))


def fresh_rows(staged: DataFrame, held: DataFrame | None) -> DataFrame:
    """Key columns, number and load date of the row that is kept of each new content in a staged batch.

    ``staged`` is a written batch with ``row_key``, ``key_bucket`` and a ``row_number`` of its own; ``held`` has the keys that
    are loaded. Of copies the earliest load is kept, then the lowest id and digest of the text. Only digests and
    numbers are shuffled.
    """
    order = F.struct("loaded_at", "id", F.unhex(F.md5("data")).alias("text"), "row_number")
    first = staged.groupBy("row_key", "key_bucket").agg(F.min(order).alias("first"))
    new = first if held is None else first.join(held, "row_key", "left_anti")
    return new.select("row_key", "key_bucket", F.col("first.row_number").alias("row_number"), F.to_date("first.loaded_at").alias("load_date"))


def rows_numbered(staged: DataFrame, chosen: DataFrame) -> DataFrame:
    """The raw rows of a staged batch whose numbers are chosen.

    A small choice is broadcast. For a large one Spark can put a Bloom filter of the chosen numbers ahead of the shuffle
    of the texts (see ``settings``); the filter on numbers, which all pass, marks that side as one to make it from.
    """
    numbers = chosen.where("row_number >= 0").select("row_number")
    return staged.join(numbers, "row_number", "left_semi").select(*RAW_COLUMNS)


def rows_not_numbered(staged: DataFrame, left_out: DataFrame) -> DataFrame:
    """The raw rows of a staged batch but those whose numbers are left out: the same choice where most rows are new, so that
    it is the few other numbers that are broadcast."""
    return staged.join(left_out.select("row_number"), "row_number", "left_anti").select(*RAW_COLUMNS)


def dedup_report(raw: DataFrame, loaded: DataFrame) -> DataFrame:
    """One row: records read, records new, records skipped.

    Works on hashes and their counts alone; no record text is shuffled.
    """
    counts = raw.groupBy("record_hash").agg(F.count(F.lit(1)).alias("copies"))
    known = already_loaded(raw, loaded).withColumn("known", F.lit(True))
    fresh = F.count_if(F.col("known").isNull())
    return (
        counts.join(known, "record_hash", "left")
        .agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_in"), fresh.alias("rows_new"))
        .withColumn("rows_skipped", F.col("rows_in") - F.col("rows_new"))
    )
