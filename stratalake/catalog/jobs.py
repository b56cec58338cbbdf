"""Whole jobs: what they leave on disk."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.catalog.cleaned import AS_OF, CLEANED_SQL
from stratalake.catalog.columns import key_sql
from stratalake.catalog.feeds import raw_feed
from stratalake.catalog.registry import query
from stratalake.catalog.star import FACT_SQL
from stratalake.plans.cleaned import refresh_cleaned
from stratalake.plans.layout import Layout
from stratalake.plans.raw import load_raw
from stratalake.plans.run import run_layers
from stratalake.sinks.upsert import read_keyed
from stratalake.sources.workspace import new_folder, written
from stratalake.specs import RESOURCES


def checked(*done):
    for metrics in done:
        if metrics.errors:
            raise RuntimeError(f"{metrics.step} {metrics.table_name}: {metrics.errors[0]}")


@query(CLEANED_SQL["clients"])
def cleaned_refresh(spark, folder):
    """Clients loaded and refreshed, then loaded with new content and merged."""
    layout = Layout(new_folder(spark, "refresh"), buckets=8, key_digits=1)
    spec = RESOURCES["clients"]
    feed = raw_feed(spark, folder, "clients")
    older = feed.withColumns(
        {
            "data": F.regexp_replace("data", "Customer#", "Former name of "),
            "record_hash": F.sha2(F.concat(F.lit("older"), "record_hash"), 256),
            "loaded_at": F.lit(datetime(2001, 12, 31)).cast("timestamp_ntz"),
        }
    )
    for batch in (older, feed):
        checked(load_raw(batch, spec.name, layout), refresh_cleaned(spark, spec, layout, AS_OF))
    return read_keyed(spark, layout.cleaned(spec.name)).drop("record_hash")


@query("""
    WITH long AS (SELECT c_custkey FROM customer WHERE c_nationkey < 5)
    SELECT 'first' AS run, 'cleaned' AS step, 'clients' AS table_name, 'max_length:client_name' AS rule, count(*) AS rows FROM long
    UNION ALL SELECT 'first', 'star', 'fact_invoices', 'orphan:client_id', count(*) FROM orders
      WHERE o_custkey IN (FROM long) OR o_custkey NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT run, 'star', 'fact_invoices', 'orphan:project_id', count(*) FROM orders, (SELECT unnest(['first', 'second']) AS run) GROUP BY run
    UNION ALL SELECT 'first', 'cleaned', 'clients', 'rejects', count(*) FROM long
    UNION ALL SELECT 'second', 'cleaned', 'clients', 'rejects', 0
    UNION ALL SELECT 'second', 'cleaned', 'clients', 'kept', count(*) FROM customer""")
def layers_contract(spark, folder):
    """Clients whose names are too long for the table: counted and set aside in the write, their invoices without a client.
    Then the same day with names that fit: the day's rejects are gone."""
    layout = Layout(new_folder(spark, "contract"), buckets=8, key_digits=1)
    feed, found = raw_feed(spark, folder, "clients"), []
    too_long = F.col("data").rlike(r'"account_manager_id":"[0-4]"')
    name = r'"client_name":"([^"]*)"'
    longer = F.regexp_replace("data", name, '"client_name":"$1' + "x" * 300 + '"')
    bad = feed.withColumns(
        {
            "data": F.when(too_long, longer).otherwise(F.col("data")),
            "record_hash": F.when(too_long, F.sha2(longer, 256)).otherwise(F.col("record_hash")),
            "loaded_at": F.lit(datetime(1998, 6, 29)).cast("timestamp_ntz"),
        }
    )
    good = feed.withColumn("loaded_at", F.lit(datetime(1998, 6, 30)).cast("timestamp_ntz"))
    at_day = F.lit(datetime(1998, 6, 30)).cast("timestamp_ntz")
    invoices = raw_feed(spark, folder, "invoices").withColumn("loaded_at", at_day)
    for run, batches in (("first", {"clients": bad, "invoices": invoices}), ("second", {"clients": good})):
        done = run_layers(spark, layout, AS_OF, batches, "clients,invoices")
        checked(*done)
        rules = [(run, m.step, m.table_name, rule, n) for m in done for rule, n in m.violations.items()]
        found.append(spark.createDataFrame(rules, "run string, step string, table_name string, rule string, rows bigint"))
        rejects = spark.read.parquet(layout.rejects("clients")).agg(F.count(F.lit(1)).alias("rows"))
        kept = read_keyed(spark, layout.cleaned("clients")).agg(F.count(F.lit(1)).alias("rows"))
        for rule, counted in (("rejects", rejects), ("kept", kept)):
            if rule == "rejects" or run == "second":
                row = counted.select(F.lit(run).alias("run"), F.lit("cleaned").alias("step"), F.lit("clients").alias("table_name"), F.lit(rule).alias("rule"), "rows")
                found.append(written(row, "contract-rows"))
    return reduce(DataFrame.unionByName, found)


EARLY, LATE = datetime(1995, 1, 1), datetime(1998, 1, 1)


@query(f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS invoice_id, CASE
      WHEN o_orderdate < TIMESTAMP '{EARLY}' OR c_custkey IS NULL THEN NULL
      WHEN o_orderdate < TIMESTAMP '{LATE}' THEN {key_sql('CAST(o_custkey AS VARCHAR)', f"'{EARLY}'")}
      ELSE {key_sql('CAST(o_custkey AS VARCHAR)', f"'{LATE}'")} END AS client_sk
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def layers_event_time(spark, folder):
    """Two runs that version the clients; the invoices get the version that was valid on the invoice date."""
    layout = Layout(new_folder(spark, "event-time"), buckets=8, key_digits=1)
    clients, invoices = raw_feed(spark, folder, "clients"), raw_feed(spark, folder, "invoices")
    former = F.regexp_replace("data", "Customer#", "Former name of ")
    at = lambda rows, day: rows.withColumn("loaded_at", F.lit(day).cast("timestamp_ntz"))
    older = clients.withColumns({"data": former, "record_hash": F.sha2(former, 256)})
    checked(*run_layers(spark, layout, EARLY, {"clients": at(older, EARLY)}, "clients"))
    batches = {"clients": at(clients, LATE), "invoices": at(invoices, LATE)}
    done = run_layers(spark, layout, LATE, batches, "clients,invoices", keys_at_event=True, slice_days=365)
    checked(*done)
    return read_keyed(spark, layout.star("fact_invoices")).select("invoice_id", "client_sk")


@query(FACT_SQL["fact_invoices"])
def layers_run(spark, folder):
    """Raw, cleaned and star tables of three resources in one run; the invoices at its end."""
    layout = Layout(new_folder(spark, "layers"), buckets=8, key_digits=1)
    names = ("projects", "clients", "invoices")
    batches = {name: raw_feed(spark, folder, name) for name in names}
    checked(*run_layers(spark, layout, AS_OF, batches, ",".join(names)))
    return read_keyed(spark, layout.star("fact_invoices"))
