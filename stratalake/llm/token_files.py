"""Token files: Parquet lists of ids with small row groups and page indexes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import lists, numbered, slices, strings, task
from stratalake.llm.encoder import encoder

END_ID = 0

#: Ids are drawn from one vocabulary: a dictionary page per column and row group, ids as bit-packed
#: positions. What does not fit a dictionary (doc_id, pos) is delta encoded by the second version of
#: the format. Row groups and pages are small, so that the page index leads a reader to a few KB.
FORMAT = {
    "compression": "zstd",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.columnindex.truncate.length": "64",
}


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Writes the ids of each whole text, ended by `end_id`, in ascending doc_id order.

    Columns: part (file), pos (row in it), before (ids in the file ahead of it), doc_id, n_tokens (with the
    end id), ids. Texts are dealt
    out by ranges of doc_id before they are encoded, so only text is shuffled. Files follow each
    other in doc_id order, null ids first; rows of one doc_id follow the digest of their text. A
    null or empty text is the end id alone. No rows give files without rows. Other columns of `docs` are
    not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    digest = F.xxhash64("text").alias("digest")
    dealt = docs.select("doc_id", "text", digest).repartitionByRange("doc_id", "digest")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, done, written = encoder(tokenizer), task(), 0, 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in (s for b in batches for s in slices(b)):
            ids = [known.encode(text) + end for text in strings(batch.column("text"))]
            counts = np.array([len(x) // 4 for x in ids], np.int64)
            before = written + np.cumsum(counts) - counts
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), part, np.int32)),
                    pa.array(np.arange(done, done + len(ids), dtype=np.int64)),
                    pa.array(before),
                    batch.column("doc_id"),
                    pa.array(counts),
                    lists(ids, "<i4", pa.int32()),
                ],
                ["part", "pos", "before", "doc_id", "n_tokens", "ids"],
            )
            done += len(ids)
            written += int(counts.sum())

    encoded = dealt.sortWithinPartitions("doc_id", "digest").mapInArrow(
        encode, f"part int, pos long, before long, doc_id {kind}, n_tokens long, ids array<int>"
    )
    encoded.write.options(**FORMAT).parquet(path)


def read_tokens(spark: SparkSession, path: str, which: Column | None = None) -> DataFrame:
    """Documents' ids; a condition on doc_id, n_tokens, part or pos reaches the page index."""
    rows = spark.read.parquet(path)
    return rows if which is None else rows.filter(which)


def token_starts(rows: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Replaces before by start, the number of ids of all documents before; `files` are the rows as read, where `rows` is costly."""
    return numbered(rows, rows if files is None else files, F.col("n_tokens"), "before", "start")
