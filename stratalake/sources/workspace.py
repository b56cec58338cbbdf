"""Where intermediate tables go: the shared folder named by the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SHARED_FOLDER_SETTING = "spark.checkpoint.dir"
#: Records are texts with much in common, written and read several times on their way.
COMPACT = {"compression": "zstd"}


def shared_folder(spark: SparkSession) -> str:
    """The session's shared folder. Only a local session may fall back to a folder of its own."""
    folder = spark.conf.get(SHARED_FOLDER_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.mkdtemp(prefix="stratalake-")
    raise ValueError(f"set {SHARED_FOLDER_SETTING} to a folder that all executors share")


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/stratalake/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows read back from a table in the shared folder.

    For a frame that several branches of a plan use: it is computed once, and a lost executor
    costs a re-read instead of the work behind it.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_if_written(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame | None:
    """A Parquet table, or None while nothing has been written there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return None
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # written, but without a row
            return None
        raise
