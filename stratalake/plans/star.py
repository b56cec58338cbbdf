"""Refreshing dimensions and facts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.dedup import as_timestamp
from stratalake.operators.modeling import date_rows, dimension_rows, fact_rows, fact_with_keys
from stratalake.plans.layout import Layout
from stratalake.plans.metrics import JobMetrics, Status, measured
from stratalake.operators.quality import broken_rules, contract_tests, orphan_tests, rule_counters, violations
from stratalake.sinks.dimension import read_dimension, update_dimension
from stratalake.sinks.key_state import key_counts, record, repeated_keys
from stratalake.sinks.runs import Kind
from stratalake.sinks.upsert import append_keyed, read_keyed, rebuild_table, upsert_table
from stratalake.sinks.writer import Mode, write_table
from stratalake.sources.workspace import COMPACT, written
from stratalake.specs import DATE_DIMENSION, DATE_DIMENSION_RANGE, DIMENSIONS, FACTS, DimensionSpec, FactSpec

STEP = "star"
REASON = "_reason"
KINDS = {Mode.OVERWRITE: Kind.BASE, Mode.MERGE: Kind.MERGE, Mode.APPEND: Kind.APPEND}


def cleaned_rows(
    spark: SparkSession, source: str, layout: Layout, since: datetime | None = None
) -> DataFrame | None:
    """A cleaned table, or the rows of it that were written at or after ``since``."""
    cleaned = read_keyed(spark, layout.cleaned(source))
    if cleaned is None or since is None:
        return cleaned
    return cleaned.where(F.col("silver_processed_at") >= as_timestamp(since))


def refresh_dimension(
    spark: SparkSession,
    spec: DimensionSpec,
    layout: Layout,
    as_of: datetime,
    rebuild: bool = False,
    since: datetime | None = None,
) -> JobMetrics:
    """Version one dimension against its cleaned table.

    Rows that break a rule of the specification are counted and set aside as rejects, before the others are compared.
    With ``since`` only cleaned rows written from then on are looked at. That gives the same
    dimension as long as every run is covered, because a key that is absent stays as it is.
    """

    def job(metrics: JobMetrics) -> Status:
        cleaned = cleaned_rows(spark, spec.source, layout, since)
        if cleaned is None:
            return Status.NO_DATA
        rows = dimension_rows(cleaned, spec)
        tests = contract_tests(rows.columns, [spec.key], spec.max_lengths)
        bad = F.size(broken_rules(tests)) > 0
        read = Observation()
        checked = rows.withColumn("reason", F.array_join(broken_rules(tests), ", "))
        checked = checked.observe(read, F.count(F.lit(1)).alias("rows"), *rule_counters(tests)).where("reason <> ''")
        checked.write.mode("overwrite").parquet(layout.rejects_of(spec.name, as_of))
        counts = update_dimension(
            rows.where(~bad), layout.star(spec.name), spec.surrogate, [spec.key], as_of,
            spec.attributes, rebuild,
        )
        metrics.rows_input, metrics.violations = read.get["rows"], violations(read.get, tests)
        metrics.rows_output = counts["rows_new"] + counts["rows_changed"]
        return Status.SUCCESS

    return measured(STEP, spec.name, job)


def refresh_date_dimension(
    spark: SparkSession, layout: Layout, first: str = DATE_DIMENSION_RANGE[0], last: str = DATE_DIMENSION_RANGE[1]
) -> JobMetrics:
    """Write the calendar; it does not depend on any other table."""

    def job(metrics: JobMetrics) -> Status:
        days = date_rows(spark, first, last)
        metrics.rows_output = write_table(days, layout.star(DATE_DIMENSION), Mode.OVERWRITE)
        metrics.rows_input = metrics.rows_output
        return Status.SUCCESS

    return measured(STEP, DATE_DIMENSION, job)


def empty_dimension(spark: SparkSession, name: str) -> DataFrame:
    spec = DIMENSIONS[name]
    return spark.createDataFrame(
        [], f"{spec.surrogate} string, {spec.key} string, valid_from timestamp_ntz, "
        "valid_to timestamp_ntz, is_current boolean"
    )


def build_fact(
    spark: SparkSession,
    spec: FactSpec,
    layout: Layout,
    salts: int = 1,
    since: datetime | None = None,
    keys_at_event: bool = False,
    slice_days: int | None = None,
) -> DataFrame | None:
    """Fact rows with dimension keys, or None while there is no cleaned table.

    With ``keys_at_event`` a row gets the versions that were valid on its first day, else the current ones.
    """
    cleaned = cleaned_rows(spark, spec.source, layout, since)
    if cleaned is None:
        return None
    dimensions, surrogates = {}, {}
    for name in spec.lookups.values():
        known = read_dimension(spark, layout.star(name))
        dimensions[name] = empty_dimension(spark, name) if known is None else known
        surrogates[name] = (DIMENSIONS[name].surrogate, DIMENSIONS[name].key)
    day = F.to_date(spec.days[0]) if keys_at_event else None
    used = cleaned.select(*dict.fromkeys(("id", *spec.columns, *spec.lookups, *spec.days, "created_at")))
    rows = fact_with_keys(used, spec, dimensions, surrogates, day, salts, slice_days)
    return fact_rows(rows, spec, found=[surrogate for surrogate, _ in surrogates.values()])


def refresh_fact(
    spark: SparkSession,
    spec: FactSpec,
    layout: Layout,
    mode: Mode = Mode.OVERWRITE,
    salts: int = 1,
    since: datetime | None = None,
    keys_at_event: bool = False,
    slice_days: int | None = None,
    as_of: datetime | None = None,
) -> JobMetrics:
    """Write one fact table: rebuilt (the default), appended to, or merged on its own key.

    All modes keep one layout, so they may follow each other on a table. Rows that break a rule of the
    specification are counted in the write and set aside as rejects of ``as_of``; keys that a dimension lacks are
    counted. Where rows are appended, the counts of their keys are compared with those on record, so a key that the table then
    holds twice is reported without a look at the table.
    ``since`` limits an append or a merge to cleaned rows written from then on.
    """
    if since is not None and mode is Mode.OVERWRITE:
        raise ValueError("a rebuilt fact table needs all cleaned rows")

    def job(metrics: JobMetrics) -> Status:
        facts = build_fact(spark, spec, layout, salts, since, keys_at_event, slice_days)
        if facts is None:
            return Status.NO_DATA
        staging, path = layout.staging(spec.name), layout.star(spec.name)
        rows = Observation()
        tests = contract_tests(facts.columns, spec.not_null, spec.max_lengths)
        orphans = orphan_tests({key: DIMENSIONS[name].surrogate for key, name in spec.lookups.items()})
        judged = facts.withColumn(REASON, F.array_join(broken_rules(tests), ", "))
        good = F.col(REASON) == ""
        counted = judged.observe(
            rows, F.count(F.lit(1)).alias("rows"), F.count_if(good).alias("good"), *rule_counters(tests | orphans)
        )
        counted.write.options(**COMPACT).mode("overwrite").parquet(f"{staging}/facts")  # the joins run here and only here
        metrics.rows_input, metrics.rows_output = rows.get["rows"], rows.get["good"]
        metrics.violations = violations(rows.get, tests | orphans)
        staged = spark.read.schema(judged.schema).parquet(f"{staging}/facts")
        staged.where(~good).write.mode("overwrite").parquet(layout.rejects_of(spec.name, as_of) if as_of else f"{staging}/rejects")
        staged = staged.where(good).drop(REASON)
        counts = written(key_counts(staged, [spec.key], layout.key_digits), "fact-keys")
        if mode is Mode.APPEND and (repeated := repeated_keys(counts, layout.keys(spec.name)).count()):
            metrics.violations[f"unique:{spec.key}"] = repeated
        if mode is Mode.MERGE:
            upsert_table(staged, path, [spec.key], layout.buckets)
        elif mode is Mode.OVERWRITE:
            rebuild_table(staged, path, [spec.key], layout.buckets, staged=True)
        elif mode is Mode.APPEND:
            append_keyed(staged, path, [spec.key])
        else:
            raise ValueError(f"fact tables are rebuilt, merged or appended to, not {mode}")
        if metrics.rows_output:
            record(counts, layout.keys(spec.name), KINDS[mode])
        return Status.SUCCESS

    return measured(STEP, spec.name, job)


def refresh_star(
    spark: SparkSession,
    layout: Layout,
    as_of: datetime,
    dimensions: Sequence[str] | None = None,
    facts: Sequence[str] | None = None,
    rebuild: bool = False,
    fact_mode: Mode = Mode.OVERWRITE,
    since: datetime | None = None,
    salts: int = 1,
    calendar: tuple[str, str] | None = None,
    keys_at_event: bool = False,
    slice_days: int | None = None,
) -> list[JobMetrics]:
    """Dimensions first, then the facts that refer to them. None means all of a kind."""
    done = []
    for name in [*DIMENSIONS, DATE_DIMENSION] if dimensions is None else dimensions:
        if name == DATE_DIMENSION:
            done.append(refresh_date_dimension(spark, layout, *(calendar or DATE_DIMENSION_RANGE)))
        else:
            done.append(refresh_dimension(spark, DIMENSIONS[name], layout, as_of, rebuild, since))
    for name in FACTS if facts is None else facts:
        changed = None if fact_mode is Mode.OVERWRITE else since
        done.append(refresh_fact(spark, FACTS[name], layout, fact_mode, salts, changed, keys_at_event, slice_days, as_of))
    return done
