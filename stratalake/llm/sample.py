"""A bounded sample of labelled texts to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import held_out


def usable_labels(labels: DataFrame, label: str) -> DataFrame:
    """doc_id and label (0 or 1) of the rows that a model may learn from, one of each doc_id."""
    return (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, each: int) -> tuple[DataFrame, dict[int, int]]:
    """Up to `each` texts of either class (doc_id, label, text), and the size of either class.

    Rows held out, without a label or without doc_id are left aside; of repeated doc_ids the larger label
    counts, and of their rows the least text. The choice follows a digest of doc_id alone, so
    it is the same in every run. The texts stay on Spark: what a fit brings to the driver are numbers made of them.
    """
    usable = usable_labels(labels, label)
    sizes = {int(r.label): int(r.n) for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = [usable.filter(F.col("label") == c).orderBy(order, "doc_id").limit(each) for c in (0, 1)]
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * each rows
    found = docs.select("doc_id", "text").join(sample, "doc_id").groupBy("doc_id", "label")
    return found.agg(F.min(F.coalesce("text", F.lit(""))).alias("text")), sizes
