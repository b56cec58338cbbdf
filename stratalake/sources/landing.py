"""Landed extracts: JSON-lines runs, envelope files and page responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratalake.functions.json import marked_json, unmarked_json

# Layout of a page response. Records are kept as JSON text.
PAGE_ENVELOPE = "count bigint, next string, results array<string>"


def read_envelope_files(spark: SparkSession, path: str, spread: bool = False) -> DataFrame:
    """One row per record of extract files that hold a single JSON document each: resource, extracted_at, data.

    A document cannot be split, so it is parsed by one task, once, to a VARIANT; its records are taken from that one after
    the other, and with ``spread`` they are dealt out, so what follows is parallel. Their numbers keep their text. A file that is no JSON, or
    larger than a VARIANT may be, fails the read: land larger extracts as JSON lines (``read_json_lines``).
    """
    documents = spark.read.text(path, wholetext=True).select(F.parse_json(marked_json(F.col("value"))).alias("document"))
    head = documents.select(
        F.variant_get("document", "$.resource", "string").alias("resource"),
        F.variant_get("document", "$.extracted_at", "string").alias("extracted_at"),
        F.variant_get("document", "$.records", "variant").alias("records"),
    )
    records = head.lateralJoin(spark.tvf.variant_explode(F.col("records").outer()))
    rows = records.select("resource", "extracted_at", unmarked_json(F.to_json("value")).alias("data"))
    return rows.hint("rebalance") if spread else rows


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def largest_source(spark: SparkSession, pattern: str, by_directory: bool = False) -> str:
    """The file, or the directory of files, with the most bytes among those matching.

    Only the listing is read. Equal sizes are settled by the later name.
    """
    files = spark.read.format("binaryFile").load(pattern).select("path", "length")
    if by_directory:
        files = files.withColumn("path", F.regexp_replace("path", "/[^/]*$", ""))
    sizes = files.groupBy("path").agg(F.sum("length").alias("length"))
    return sizes.agg(F.max(F.struct("length", "path"))["path"]).first()[0]


def flatten_pages(
    pages: DataFrame,
    listing: list[str],
    body: str = "body",
    page_no: str = "page_no",
    max_pages: int | None = None,
    bin_pages: int = 256,
) -> DataFrame:
    """Records of page responses, up to the page that ends each listing.

    ``listing`` names the columns that tell one listing from another. A listing ends with the
    first page that names no next page or has no results, or with page ``max_pages``.

    Where it ends is found by a scan for those two members alone. Pages are binned by ``bin_pages`` of their numbers: the
    scan leaves one row per listing and bin, which meets the bin's pages in a join, so a long listing is never in one
    task. Bodies are parsed after that, each once, and those behind the end not at all.
    """
    if max_pages is not None:
        pages = pages.where(F.col(page_no) <= max_pages)
    keys = [*listing, "_bin"]
    binned = pages.withColumn("_bin", F.floor(F.col(page_no) / F.lit(bin_pages)))
    results = F.json_array_length(F.get_json_object(body, "$.results"))
    is_last = F.get_json_object(body, "$.next").isNull() | (F.coalesce(results, F.lit(0)) <= 0)
    ends = binned.groupBy(*keys).agg(F.min(F.when(is_last, F.col(page_no))).alias("_end"))
    ends = ends.withColumn("_end", F.min("_end").over(Window.partitionBy(*listing)))
    first_after = F.col("_end") < F.col("_bin") * F.lit(bin_pages)
    ends = ends.where(~F.coalesce(first_after, F.lit(False)))  # whole bins behind the end
    kept = binned.join(ends, keys).where(F.col(page_no) <= F.coalesce("_end", page_no))
    records = F.from_json(body, PAGE_ENVELOPE)["results"]
    return kept.select(*listing, page_no, F.explode(records).alias("data"))
