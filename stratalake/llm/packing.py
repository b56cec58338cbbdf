"""Packing by powers of two: no sequence crosses documents and none is padded."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import list_bytes, lists, new_folder, numbered, slices, strings, task
from stratalake.llm.encoder import encoder

END_ID = 1
SEQUENCE_TOKENS = 2048


def cuts(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of n tokens: whole sequences, then the powers of two in the rest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def pack(docs: DataFrame, tokenizer: str, path: str | None = None, longest: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Writes sequences of token ids and returns them as read back from their files.

    A document's ids, ended by `end_id`, are cut into pieces whose lengths are powers of two up
    to `longest`; each piece is a sequence of its own. Sequences of equal length are numbered one
    after the other, so a training batch takes a range of `sequence_id`: a rectangle without
    padding. Columns: part, pos (task and row that wrote the piece), nth (pieces of its length before it
    in the part), doc_id, start, length, doc_tokens, ids.

    A null or empty text is the end id alone. Every row is a document of its own, also rows
    that repeat one doc_id or have none. No rows give no rows. Other columns of `docs` are not read.
    """
    if longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    source = docs.select("doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, done, seen = encoder(tokenizer), task(), 0, Counter()
        end = np.array([end_id], "<u4").tobytes()
        for batch in (s for b in batches for s in slices(b)):
            ids = [known.encode(text) + end for text in strings(batch.column("text"))]
            rows = [(i, cuts(len(x) // 4, longest)) for i, x in enumerate(ids)]
            of = np.repeat([i for i, _ in rows], [len(c) for _, c in rows])
            length = np.array([n for _, c in rows for n in c], np.int64)
            start = np.concatenate([np.cumsum([0, *c[:-1]]) for _, c in rows]).astype(np.int64)
            pieces = [ids[i][4 * a : 4 * (a + n)] for i, a, n in zip(of.tolist(), start.tolist(), length.tolist())]
            nth = np.zeros(len(of), np.int64)
            for n in np.unique(length).tolist():
                same = np.flatnonzero(length == n)
                nth[same] = seen[n] + np.arange(len(same))
                seen[n] += len(same)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(of), part, np.int32)),
                    pa.array(np.arange(done, done + len(of), dtype=np.int64)),
                    pa.array(nth),
                    batch.column("doc_id").take(pa.array(of)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(np.array([len(x) // 4 for x in ids], np.int64)[of]),
                    lists(pieces, "<i4", pa.int32()),
                ],
                ["part", "pos", "nth", "doc_id", "start", "length", "doc_tokens", "ids"],
            )
            done += len(of)

    path = path or new_folder(docs.sparkSession, "sequences")
    schema = f"part int, pos long, nth long, doc_id {kind}, start long, length long, doc_tokens long, ids array<int>"
    source.mapInArrow(cut, schema).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def sequence_numbers(pieces: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Replaces nth by sequence_id, running over all sequences of one length before the next, and offset.

    `files` are the pieces as read, where `pieces` is costly.
    """
    rows = numbered(pieces, pieces if files is None else files, F.lit(1), "nth", "sequence_id", "length")
    return rows.withColumn("offset", F.lit(0).cast("long"))


def with_crc(rows: DataFrame) -> DataFrame:
    """The rows with the CRC-32 of their ids, as little-endian 32-bit integers, in place of the ids."""
    keep = [f for f in rows.schema if f.name != "ids"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = np.fromiter((zlib.crc32(x) for x in list_bytes(batch.column("ids"), "<i4")), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in keep), pa.array(crc)], [*(f.name for f in keep), "ids_crc32"]
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keep)
    return rows.mapInArrow(digest, f"{schema}, ids_crc32 long")
