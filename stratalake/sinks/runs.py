"""Tables that grow by runs: every run writes a folder of its own and changes no other.

A run counts once Spark's committer has left its success mark in the folder, so a writer may be killed at any point,
also in the first run: what it left is not read. The last finished base run and the runs after it are the table. A
table has one writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass
from enum import StrEnum

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.digest import surrogate_key
from stratalake.operators.keys import any_null
from stratalake.sources.workspace import COMPACT

RUN, ROW_KEY = "run", "row_key"
_MARK = "_SUCCESS"


class Kind(StrEnum):
    """A run holds the whole table, rows that replace those of their key, or rows that are added."""

    BASE = "base"
    MERGE = "merge"
    APPEND = "append"


@dataclass(frozen=True, order=True)
class Run:
    number: int
    kind: Kind
    finished: bool

    @property
    def name(self) -> str:
        return f"{self.number:08d}-{self.kind}"


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def is_finished(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to the folder has ended well."""
    files, mark = _folder(spark, f"{path}/{_MARK}")
    return files.exists(mark)


def drop_folder(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def all_runs(spark: SparkSession, path: str) -> list[Run]:
    """Every run of a table, finished or not, in order. Only folder names are listed."""
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return []
    found = []
    for entry in files.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith(f"{RUN}="):
            number, kind = name.removeprefix(f"{RUN}=").split("-")
            mark = spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), _MARK)
            found.append(Run(int(number), Kind(kind), files.exists(mark)))
    return sorted(found)


def live_runs(spark: SparkSession, path: str) -> list[Run]:
    """The finished runs that make up the table."""
    finished = [r for r in all_runs(spark, path) if r.finished]
    last_base = max((i for i, r in enumerate(finished) if r.kind is Kind.BASE), default=0)
    return finished[last_base:]


def read_runs(spark: SparkSession, path: str, runs: list[Run]) -> DataFrame:
    """Rows of the given runs with the run's name."""
    folders = [f"{path}/{RUN}={r.name}" for r in runs]
    return spark.read.option("basePath", path).parquet(*folders)


def write_run(df: DataFrame, path: str, kind: Kind, partition_by: tuple[str, ...] = ()) -> Run:
    """Write rows as the next run. Numbers of unfinished runs are not used again."""
    spark = df.sparkSession
    run = Run(max((r.number for r in all_runs(spark, path)), default=0) + 1, kind, True)
    df.write.options(**COMPACT).partitionBy(*partition_by).parquet(f"{path}/{RUN}={run.name}")
    return run


def drop_superseded(spark: SparkSession, path: str) -> int:
    """Delete the runs that no reader needs: those before the last base, and what unfinished ones left behind.

    Call it when no job reads an older state any more. Returns how many were deleted.
    """
    live = live_runs(spark, path)
    old = [r for r in all_runs(spark, path) if r not in live and live]
    for run in old:
        drop_folder(spark, f"{path}/{RUN}={run.name}")
    return len(old)


def with_row_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Add a 128-bit digest of the key, NULL where part of the key is."""
    return df.withColumn(ROW_KEY, F.when(~any_null(keys), F.unhex(surrogate_key(keys))))
