"""Raw rows to cleaned, typed rows, as a table specification says."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType, TimestampType

from stratalake.functions import text
from stratalake.operators.dedup import as_timestamp
from stratalake.operators.keys import latest_per_key
from stratalake.specs import TableSpec

CORRUPT = "_corrupt_record"
LINEAGE = ("bronze_id", "record_hash", "bronze_loaded_at")


def parse_records(
    raw: DataFrame,
    schema: str | StructType,
    aliases: Mapping[str, Sequence[str]] | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Raw rows with their JSON opened into typed columns.

    Unknown members are dropped, missing ones are NULL, names match in their letter case. A
    member of the wrong type is NULL and a text that is no JSON object gives all NULLs; in
    both cases, and where one of ``keys`` is missing, the text is kept in ``_corrupt_record``.
    A column with aliases takes the first of its names that has a value.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    aliases = {c: names for c, names in (aliases or {}).items() if c in schema.names}
    extra = [StructField(n, schema[c].dataType) for c, names in aliases.items() for n in names]
    full = StructType([*schema.fields, *extra, StructField(CORRUPT, StringType())])
    record = F.from_json("data", full, {"columnNameOfCorruptRecord": CORRUPT})
    parsed = raw.select(
        F.col("id").alias("bronze_id"), "record_hash", F.col("loaded_at").alias("bronze_loaded_at"),
        "data", record.alias("_record"),
    )
    columns = [
        F.coalesce(*[F.col(f"_record.`{n}`") for n in (c, *aliases.get(c, ()))]).alias(c)
        if c in aliases else F.col(f"_record.`{c}`")
        for c in schema.names
    ]
    text = F.col(f"_record.{CORRUPT}")
    for key in keys:
        text = F.coalesce(text, F.when(F.col(f"_record.`{key}`").isNull(), F.col("data")))
    return parsed.select(*LINEAGE, *columns, text.alias(CORRUPT))


def clean_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Every cleaning rule of the specification whose column is present, in one projection."""
    rules: dict[str, Column] = {}
    rules |= {c: text.clean_text(c) for c in spec.text}
    rules |= {c: text.clean_email(c, spec.trim_email) for c in spec.email}
    rules |= {c: text.clean_phone(c) for c in spec.phone}
    rules |= {c: text.upper_code(c, spec.trim_codes) for c in spec.codes}
    for c in spec.dates:
        if c in df.columns and not isinstance(df.schema[c].dataType, TimestampType):
            rules[c] = text.parse_timestamp(c, spec.date_formats.get(c))
    return df.withColumns({c: rule for c, rule in rules.items() if c in df.columns})


def derive_columns(df: DataFrame, spec: TableSpec, as_of: datetime | Column) -> DataFrame:
    """Derived columns whose inputs are present, then business rules, which may use them."""
    now = as_timestamp(as_of)
    for group in (spec.derived, spec.rules):
        wanted = {d.name: d.rule(now) for d in group if set(d.needs) <= set(df.columns)}
        df = df.withColumns(wanted) if wanted else df
    return df


def add_processing_columns(df: DataFrame, as_of: datetime | Column) -> DataFrame:
    return df.withColumns(
        {"silver_processed_at": as_timestamp(as_of), "silver_is_current": F.lit(True)}
    )


def timestamps_without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as the cleaned tables store them."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def table_schema(spec: TableSpec) -> StructType:
    """The declared columns of a cleaned table: lineage, record fields, derived columns, processing columns."""
    fields = [StructField(c, StringType()) for c in LINEAGE[:2]] + [StructField(LINEAGE[2], TimestampNTZType())]
    for field in StructType.fromDDL(spec.fields):
        zoned = isinstance(field.dataType, TimestampType)
        fields.append(StructField(field.name, TimestampNTZType() if zoned else field.dataType))
    derived = {d.name: d.type for d in (*spec.derived, *spec.rules)}
    known = {f.name for f in fields}
    fields += StructType.fromDDL(", ".join(f"{n} {t}" for n, t in derived.items() if n not in known)).fields if derived else []
    return StructType(fields + StructType.fromDDL("silver_processed_at timestamp_ntz, silver_is_current boolean").fields)


def open_records(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Raw rows opened into the columns of the specification, as they came."""
    return parse_records(raw, spec.fields, spec.aliases, spec.keys)


def latest_records(opened: DataFrame) -> DataFrame:
    """The last loaded version of each opened record, the highest digest of those loaded together.

    Records without an id are not versions of one another: each is told apart by its content and kept. What is
    moved and sorted is opened columns, and of those only what is used later, not the texts. Rows go to the task of their id
    before they are sorted, as most records have few versions and a sort ahead of that would drop next to nothing.
    """
    apart = F.when(F.col("bronze_id") == "", F.col("record_hash"))
    dealt = opened.withColumn("_apart", apart)
    if not (packs := isinstance(opened.schema["record_hash"].dataType, StringType)):
        digests = ["record_hash"]
    else:  # hexadecimal digests are moved as bytes, which are ordered as their digits are
        digests = ["_digest", "record_hash"]
        as_bytes = F.unhex("record_hash")
        dealt = dealt.withColumn("_digest", F.when(F.lower(F.hex(as_bytes)) == F.col("record_hash"), as_bytes))
        dealt = dealt.withColumn("record_hash", F.when(F.col("_digest").isNull(), F.col("record_hash")))
    dealt = dealt.repartition("bronze_id", "_apart")
    latest = latest_per_key(dealt, ["bronze_id", "_apart"], "bronze_loaded_at", digests)
    if packs:
        latest = latest.withColumn("record_hash", F.coalesce("record_hash", F.lower(F.hex("_digest"))))
    return latest.select(*opened.columns)


def clean_opened(opened: DataFrame, spec: TableSpec) -> DataFrame:
    return timestamps_without_zone(clean_columns(opened, spec))


def finish_records(cleaned: DataFrame, spec: TableSpec, as_of: datetime | Column) -> DataFrame:
    """Derived and processing columns, which other columns of the row are enough for."""
    return add_processing_columns(derive_columns(cleaned, spec, as_of), as_of)


def clean_records(raw: DataFrame, spec: TableSpec, as_of: datetime | Column) -> DataFrame:
    """Raw rows to cleaned rows: parse, clean, derive, stamp.

    ``_corrupt_record`` is kept so that a caller can set faulty records aside; the sinks leave
    it out.
    """
    return finish_records(clean_opened(open_records(raw, spec), spec), spec, as_of)
