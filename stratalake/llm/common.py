"""What the operators of this folder share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.sources.workspace import new_folder, written  # noqa: F401

#: Bytes of text that a Python task works on at a time.
SLICE_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Settings of a session that runs these operators: batches to and from Python of about SLICE_BYTES.

    Spark's own limit lets a task hold several times 64 MB of texts outside its heap and as much again in its worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", SLICE_BYTES)


def tables(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    """Tables of a folder. Python workers of a local session also learn where this package lies."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")
    return [spark.read.parquet(f"{folder}/{name}.parquet") for name in names]


def held_out(key: str = "doc_id") -> Column:
    """Rows that no model may learn labels from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about the given number of bytes; one row is never divided."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    share = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def raw_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; nothing for a null."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def lists(parts: list[bytes], kind: str, arrow: pa.DataType) -> pa.ListArray:
    """A list column from the little-endian bytes of each list."""
    width = np.dtype(kind).itemsize
    ends = np.cumsum([0, *(len(p) // width for p in parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), kind), arrow))


def list_bytes(column: pa.ListArray, kind: str) -> Iterator[bytes]:
    """The little-endian bytes of each list; the reverse of `lists`."""
    values = np.ascontiguousarray(column.values.to_numpy(zero_copy_only=False), kind)
    ends = column.offsets.to_numpy()
    for a, b in zip(ends, ends[1:]):
        yield values[a:b].tobytes()


def task() -> int:
    return TaskContext.get().partitionId()


def numbered(rows: DataFrame, counted: DataFrame, weight: Column, inside: str, name: str, *lead: str) -> DataFrame:
    """Replaces `inside` by the sum of `weight` over all rows before a row, ordered by lead columns and part.

    A part is what one task wrote, and `inside` is that sum within the part, written with the row. So
    only the totals of the parts, taken of `counted`, meet in one task, and no row is sorted again.
    """
    totals = counted.groupBy(*lead, "part").agg(F.sum(weight).alias("_total"))
    before = Window.orderBy(*lead, "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *lead, "part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before")
    )
    joined = rows.join(starts, [*lead, "part"])
    return joined.withColumn(name, F.col("_before") + F.col(inside)).drop("_before", inside)
