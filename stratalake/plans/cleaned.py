"""Refreshing cleaned tables from raw rows."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.cleaning import CORRUPT, LINEAGE, clean_opened, finish_records, latest_records, open_records, table_schema
from stratalake.operators.keys import any_null
from stratalake.operators.quality import broken_rules, conform, contract_tests, rule_counters, violations
from stratalake.plans.layout import Layout
from stratalake.plans.metrics import JobMetrics, Status, measured
from stratalake.sinks.upsert import append_keyed, rebuild_table, upsert_table
from stratalake.sinks.writer import Mode, read_raw
from stratalake.sources.tables import DEFAULT_LOOKBACK_DAYS, look_back
from stratalake.sources.workspace import COMPACT, written
from stratalake.specs import TableSpec

STEP = "cleaned"
BROKEN = "_broken_rules"
#: Ids with several versions that are broadcast, some 10 MB of them.
FEW_IDS = 200_000


def last_versions(raw: DataFrame, spec: TableSpec, read: Observation, few: int = FEW_IDS) -> DataFrame:
    """Raw rows opened, the last version of each record; ``read`` gets the number of raw rows.

    Ids are counted first. Where up to ``few`` have several versions, rows of other ids stay where they are read.
    """
    counts = raw.groupBy("id").agg(F.count(F.lit(1)).alias("n")).observe(read, F.sum("n").alias("rows"))
    several = written(counts.where((F.col("n") > 1) | (F.col("id") == "")).select("id"), "several-versions")
    if several.limit(few + 1).count() > few:
        return latest_records(open_records(raw, spec))
    several = F.broadcast(several)
    single = open_records(raw.join(several, "id", "left_anti"), spec)
    return single.unionByName(latest_records(open_records(raw.join(several, "id", "left_semi"), spec)))


def refresh_cleaned(
    spark: SparkSession,
    spec: TableSpec,
    layout: Layout,
    as_of: datetime,
    lookback_days: int = DEFAULT_LOOKBACK_DAYS,
    full_rebuild: bool = False,
    mode: Mode | None = None,
    until: datetime | None = None,
) -> JobMetrics:
    """Bring one cleaned table up to date from the raw rows in the look-back window, loaded up to ``until``.

    Raw rows are parsed once: the cleaned rows go to a staging table, which feeds both the
    cleaned table and the rejects. A record that has no key or an empty one, or whose text or some member
    could not be read, is added to the rejects with its text; unless its key is missing it is
    also in the cleaned table, with NULL for what could not be read. Rows that break a rule of the
    specification (missing values, lengths) are counted in the write and go to the rejects alone. The rejects of
    a day are those of its last run.
    """
    mode = mode or (Mode.OVERWRITE if full_rebuild else Mode.MERGE)
    staging, path = layout.staging(spec.name), layout.cleaned(spec.name)

    def job(metrics: JobMetrics) -> Status:
        table = read_raw(spark, layout.raw(spec.name))
        if table is None:
            return Status.NO_DATA
        raw = table if full_rebuild else look_back(table, as_of, lookback_days, until=until)
        if raw.isEmpty():
            return Status.NO_DATA
        read = Observation()
        done = Observation()
        no_key = reduce(or_, [F.col(k).cast("string") == "" for k in spec.keys], any_null(spec.keys))
        latest = last_versions(raw.drop("load_date"), spec, read)
        cleaned = finish_records(clean_opened(latest, spec), spec, as_of)
        tests = contract_tests(cleaned.columns, spec.not_null, spec.max_lengths)
        cleaned = cleaned.withColumn(BROKEN, broken_rules(tests))
        good = ~no_key & (F.size(BROKEN) == 0)
        cleaned = cleaned.observe(done, F.count_if(good).alias("rows"), *rule_counters(tests))
        cleaned.write.options(**COMPACT).mode("overwrite").parquet(f"{staging}/parsed")
        metrics.rows_input, metrics.rows_output = read.get["rows"], done.get["rows"]
        metrics.violations = violations(done.get, tests)

        staged = spark.read.parquet(f"{staging}/parsed")
        rows = conform(staged.where(good), table_schema(spec))
        if mode is Mode.MERGE:
            upsert_table(rows, path, spec.keys, layout.buckets)
        elif mode is Mode.OVERWRITE:
            rebuild_table(rows, path, spec.keys, layout.buckets, staged=True)
        else:
            append_keyed(rows, path, spec.keys)

        reason = (
            F.when(F.coalesce(no_key, F.lit(True)), "no key")
            .when(F.size(BROKEN) > 0, F.array_join(BROKEN, ", "))
            .otherwise("unreadable member")
        )
        record = F.to_json(F.struct(*[c for c in rows.columns if c not in LINEAGE]))
        rejects = staged.where(~good | F.col(CORRUPT).isNotNull()).select(
            "bronze_id", "record_hash", "bronze_loaded_at", F.coalesce(CORRUPT, record).alias("data"), reason.alias("reason")
        )
        rejects.write.mode("overwrite").parquet(layout.rejects_of(spec.name, as_of))
        return Status.SUCCESS

    return measured(STEP, spec.name, job)
