"""Content hashes, surrogate keys and change tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.functions.json import sorted_json
from stratalake.functions.text import as_column

# Bookkeeping fields that are not part of a record's content.
UNHASHED_FIELDS = ("_extracted_at", "_loaded_at", "_record_hash")

TIMESTAMP_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def record_json(columns: Sequence[str]) -> Column:
    """The columns as one JSON object, by name. NULLs are written out, timestamps keep
    microseconds."""
    return F.to_json(F.struct(*sorted(columns)), {**TIMESTAMP_OPTIONS, "ignoreNullFields": "false"})


def record_hash(columns: Sequence[str], exclude: Sequence[str] = UNHASHED_FIELDS) -> Column:
    """SHA-256 of typed columns, independent of their order.

    With nothing to exclude it digests the very text ``record_json`` gives, which Spark then
    builds once for both.
    """
    return F.sha2(record_json([c for c in columns if c not in exclude]), 256)


def canonical_json(data: Column | str, exclude: Sequence[str] = UNHASHED_FIELDS) -> Column:
    """One text per record content, whatever the key order, at every depth.

    Numbers count by their text, so ``1.10`` is not ``1.1``, no digit of a long number is lost, and the number ``1``
    is not the text ``"1"``. NULL for text that is no JSON object.
    """
    return sorted_json(data, tuple(exclude))


def record_hash_json(data: Column | str, exclude: Sequence[str] = UNHASHED_FIELDS) -> Column:
    """SHA-256 of a JSON record; text that is no JSON object is hashed as it stands."""
    return F.sha2(F.coalesce(canonical_json(data, exclude), as_column(data)), 256)


def surrogate_key(columns: Sequence[Column | str]) -> Column:
    """128-bit digest of the key columns as 32 hex characters.

    Each value is preceded by its length and NULL has a mark of its own, so neither a
    separator inside a value nor a shifted NULL gives two keys the same text. The digest is
    the same in every run and needs no global numbering.
    """
    texts = [as_column(c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat_ws("||", *parts))


def differs(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """True when any pair differs; two NULLs are equal."""
    return ~F.struct(*left).eqNullSafe(F.struct(*right))
