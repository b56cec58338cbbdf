"""Raw loads as a stream of files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratalake.plans.layout import Layout
from stratalake.plans.raw import append_new


def stream_raw(
    records: DataFrame,
    to_raw: Callable[[DataFrame], DataFrame],
    name: str,
    layout: Layout,
    checkpoint: str,
    trigger: dict | None = None,
    remember: str = "1 hour",
) -> StreamingQuery:
    """Append the new records of every micro-batch to a raw table.

    Copies that arrive within ``remember`` of one another are dropped by the stream's own state, which Spark
    keeps on its side and forgets by watermark. What is older, or came in by another stream or load, is found by
    the keys on record beside the raw table (see ``plans.raw.append_new``), of which a micro-batch reads only the folders
    its own digests fall into. A micro-batch that is run twice after a failure adds nothing the second time, and records may
    arrive late or in any order. By default the stream takes what is there and stops.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        append_new(batch, name, layout)

    arrived = to_raw(records).withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", remember)
    unique = arrived.dropDuplicatesWithinWatermark(["record_hash"]).drop("_arrived")
    return (
        unique.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
