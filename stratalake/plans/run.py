"""The whole flow: raw, cleaned, star."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from stratalake.plans.cleaned import refresh_cleaned
from stratalake.plans.layout import Layout
from stratalake.plans.metrics import JobMetrics, Status, save_metrics
from stratalake.plans.raw import load_raw_batch
from stratalake.plans.star import refresh_star
from stratalake.sinks.writer import Mode
from stratalake.sources.tables import DEFAULT_LOOKBACK_DAYS
from stratalake.specs import select_resources


def run_layers(
    spark: SparkSession,
    layout: Layout,
    as_of: datetime,
    batches: Mapping[str, DataFrame] | None = None,
    resources: str | None = None,
    lookback_days: int = DEFAULT_LOOKBACK_DAYS,
    full_rebuild: bool = False,
    skip: tuple[str, ...] = (),
    fact_mode: Mode = Mode.OVERWRITE,
    since: datetime | None = None,
    salts: int = 1,
    calendar: tuple[str, str] | None = None,
    until: datetime | None = None,
    keys_at_event: bool = False,
    slice_days: int | None = None,
) -> list[JobMetrics]:
    """Load raw rows, refresh cleaned tables, refresh the star schema; steps in ``skip`` are
    left out. A step with a failed table ends the run after that step. Every table's metrics
    are appended to the metrics table. ``fact_mode``, ``since``, ``salts`` and ``calendar`` (first and last
    day), ``keys_at_event`` and ``slice_days`` (see ``build_fact``) go to the star step, ``until`` (latest load time to read) to the cleaned step. A batch whose name is no resource is refused before any step.
    """
    chosen = select_resources(resources)
    if unknown := sorted(set(batches or ()) - {spec.name for spec in select_resources(None)}):
        raise ValueError(f"no such resources: {', '.join(unknown)}")
    done: list[JobMetrics] = []

    def finished(step: list[JobMetrics]) -> bool:
        save_metrics(spark, step, layout.metrics)
        done.extend(step)
        return any(m.status == Status.FAILED for m in step)

    if "raw" not in skip:
        wanted = {spec.name: batches[spec.name] for spec in chosen if spec.name in (batches or {})}
        if finished(load_raw_batch(wanted, layout, keep_going=resources is None)):
            return done
    if "cleaned" not in skip:
        tables = [
            refresh_cleaned(spark, spec, layout, as_of, lookback_days, full_rebuild, until=until) for spec in chosen
        ]
        if finished(tables):
            return done
    if "star" not in skip:
        finished(
            refresh_star(
                spark, layout, as_of, rebuild=full_rebuild, fact_mode=fact_mode, since=since, salts=salts, calendar=calendar,
                keys_at_event=keys_at_event, slice_days=slice_days,
            )
        )
    return done
