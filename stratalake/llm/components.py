"""Connected components of links between long ids, in time logarithmic in their width."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import written


def _joined_locally(links: DataFrame) -> DataFrame:
    """Links of each partition replaced by one from every id to the least id it reaches there."""

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while parent.setdefault(top, top) != top:
                top = parent[top]
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        for batch in batches:
            for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist()):
                a, b = root(a), root(b)
                parent[max(a, b)] = min(a, b)
        found = [(x, r) for x in parent if (r := root(x)) != x]
        pairs = np.array(found, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return links.mapInArrow(shrink, "a long, b long")


def _to_least(links: DataFrame, larger: bool) -> DataFrame:
    """Neighbours of an id tied to the least of them: the larger ones, or the smaller ones and the id itself."""
    if larger:
        around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        tied = around.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("least"))
        tied = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    return tied.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b): each linked id but the least of its component, with that least id.

    `links` has long columns a and b, in any order and with repeats. Partitions first contract what
    they hold, then ids are tied to their least neighbours in turn until nothing changes; an
    id of very many links is never gathered, its links are rows of joins. Every round is a
    written table. No links give no rows.
    """
    least, most = F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")
    now = written(_joined_locally(links.select(most, least).filter("a <> b")).distinct(), "links")
    last = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            return now
        last = state
        now = written(_to_least(_to_least(now, True).select(most, least), False), "links")
