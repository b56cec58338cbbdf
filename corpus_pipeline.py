"""The corpus pipeline: stages over documents, each working on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stratalake.llm import decontamination, packing, shingle_join, site_lines, toxicity
from stratalake.llm.common import prepare, tables, written


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labelled rows does not reject."""
    prepare(spark)
    (labels,) = tables(spark, sf_dir, "labels")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that too many pages of their host repeat."""
    prepare(spark)
    return site_lines.drop_site_lines(docs).select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar documents, by five-word shingles and a similarity of 0.8."""
    prepare(spark)
    return shingle_join.drop_near_copies(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepare(spark)
    (benchmark,) = tables(spark, sf_dir, "benchmark")
    return decontamination.drop_leaks(docs, benchmark)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences of the documents that are left, with their ids."""
    prepare(spark)
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.sequence_numbers(pieces).drop("part", "pos")


STAGES = [
    ("toxicity", toxic),
    ("line dedup", lines),
    ("near copies", near_copies),
    ("decontamination", leaks),
    ("packing", packed),
]

#: Nearest examples, set joins, templates and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents, each to the written result of the one before."""
    (docs,) = tables(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
