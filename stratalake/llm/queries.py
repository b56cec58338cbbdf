"""The operators as queries over the whole tables, each giving the digest of its operator's result."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import (
    decontamination, forest, merkle, outliers, packing, periodic_runs, pii, quality, repeats, shingle_join, site_lines,
    token_files, toxicity,
)
from stratalake.llm.common import held_out, new_folder, prepare, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function):
    @wraps(function)
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = prepared
    return prepared


def judged(scores: DataFrame, doc_id: str, threshold: float) -> list:
    """The columns that the score of a classifier is returned with."""
    return [
        F.col(doc_id), held_out(doc_id).alias("held_out"), F.col("score"),
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    ]


@query
def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = tables(spark, sf_dir, "documents", "labels")
    scores = quality.score_quality(docs, quality.fit(docs, labels))
    return scores.select(judged(scores, "doc_id", quality.THRESHOLD))


@query
def op2_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = tables(spark, sf_dir, "documents", "benchmark")
    return decontamination.leaks(docs, benchmark).drop("text_key")


@query
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    return pii.find_personal_data(docs)


@query
def op4_pack_powers_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    files = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.sequence_numbers(packing.with_crc(files), files).drop("part", "pos")


@query
def op5_shingle_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    return shingle_join.similar_groups(docs).select("doc_id", "n_shingles", "component_id")


@query
def op6_toxicity_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = tables(spark, sf_dir, "documents", "labels")
    scores = toxicity.score_toxicity(docs.select("doc_id", "text"), toxicity.fit(docs, labels))
    scores = scores.select("row.doc_id", "score", "evidence")
    return scores.select(*judged(scores, "doc_id", toxicity.THRESHOLD), "evidence")


@query
def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    return repeats.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        (F.col("n_removed") > 0).alias("has_repeat"),
    )


@query
def op8_forest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    (embeddings,) = tables(spark, sf_dir, "embeddings")
    return forest.nearest(embeddings, F.col("vec_id") % 100 == 0)


@query
def op9_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    cut = site_lines.drop_site_lines(docs)
    return cut.select("row.doc_id", "n_lines", "n_dropped", "row.n_chars", F.md5("row.text").alias("text_md5"))


SQL["op9_site_lines"] = site_lines.SQL


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    path = new_folder(spark, "tokens")
    token_files.write_token_files(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    files = token_files.read_tokens(spark, path)
    return token_files.token_starts(packing.with_crc(files), files).drop("part", "pos")


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    text = periodic_runs.with_planted_repeats(F.col("text"), F.col("doc_id"))
    found = periodic_runs.find_runs(docs.select("doc_id", text.alias("text")))
    best = found.select("*", periodic_runs.strongest(F.col("runs")).alias("best"))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_covariance_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    return outliers.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    return merkle.verify(merkle.tampered(docs)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


SQL["op13_merkle_manifest"] = merkle.SQL
