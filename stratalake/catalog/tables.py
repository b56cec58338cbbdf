"""Writing tables: modes, chunked files, upserts; metrics of the writes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.catalog.registry import query, table
from stratalake.operators.keys import latest_per_key
from stratalake.operators.merge import merge_rows
from stratalake.plans.layout import Layout
from stratalake.plans.metrics import metrics_rows, run_summary, save_metrics
from stratalake.plans.raw import load_raw_batch
from stratalake.operators.dedup import raw_rows
from stratalake.sinks import upsert, writer
from stratalake.sources.workspace import new_folder, written


@query("SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders")
def table_write_modes(spark, folder):
    """Overwrite, append, and an empty overwrite that leaves the table as it was."""
    path = new_folder(spark, "modes")
    orders = table(spark, folder, "orders").withColumn("order_year", F.year("o_orderdate"))
    done = orders.where("o_orderstatus = 'F'")
    writer.write_table(orders, path, writer.Mode.OVERWRITE, ["order_year"])
    writer.write_table(done, path, writer.silver_mode(full_rebuild=True), ["order_year"])
    writer.write_table(orders.where("o_orderstatus <> 'F'"), path, writer.gold_mode(rebuild=False), ["order_year"])
    writer.write_table(orders.where("o_orderstatus = 'none'"), path, writer.Mode.OVERWRITE, ["order_year"])
    return spark.read.parquet(path)


@query("SELECT count(*) AS row_count, TRUE AS within_limit, TRUE AS several_files FROM lineitem")
def chunked_write(spark, folder):
    """No file has more rows than asked for."""
    path = new_folder(spark, "chunks")
    lines = table(spark, folder, "lineitem")
    writer.write_table(lines, path, max_rows_per_file=5000)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).count()
    return files.agg(
        F.sum("count").alias("row_count"), (F.max("count") <= 5000).alias("within_limit"),
        (F.count(F.lit(1)) > 1).alias("several_files"),
    )


# The last order of each customer up to and after the cut.
CUT = datetime(2001, 1, 1)

STATES = f"""
    WITH states AS (
      SELECT o_custkey, o_orderdate >= TIMESTAMP '{CUT}' AS late, o_orderstatus, o_orderpriority, o_totalprice
      FROM orders QUALIFY row_number() OVER (
        PARTITION BY o_custkey, o_orderdate >= TIMESTAMP '{CUT}'
        ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
    target AS (SELECT * FROM states WHERE NOT late),
    source AS (SELECT * FROM states WHERE late)
"""


def last_orders(spark, folder, late: bool) -> DataFrame:
    orders = table(spark, folder, "orders")
    cut = F.lit(CUT).cast("timestamp_ntz")
    side = orders.where(F.col("o_orderdate") >= cut if late else F.col("o_orderdate") < cut)
    last = latest_per_key(side, ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return written(last.select("o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"), "last-orders")


@query(STATES + """
    SELECT coalesce(s.o_custkey, t.o_custkey) AS o_custkey,
      CASE WHEN s.o_custkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
      CASE WHEN s.o_custkey IS NULL THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority,
      CASE WHEN s.o_custkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice
    FROM target t FULL JOIN source s ON t.o_custkey = s.o_custkey""")
def upsert_rows(spark, folder):
    return merge_rows(last_orders(spark, folder, False), last_orders(spark, folder, True), ["o_custkey"])


@query(STATES + """
    SELECT coalesce(s.o_custkey, t.o_custkey) AS o_custkey,
      CASE WHEN s.o_custkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
      t.o_orderpriority, t.o_totalprice
    FROM target t FULL JOIN source s ON t.o_custkey = s.o_custkey""")
def upsert_extra_columns(spark, folder):
    """The target has columns the source lacks: kept on update, NULL on insert."""
    source = last_orders(spark, folder, True).select(
        "o_custkey", "o_orderstatus", F.col("o_totalprice").alias("_ignored")
    )
    return merge_rows(last_orders(spark, folder, False), source, ["o_custkey"])


@query(STATES + """
    SELECT coalesce(s.o_custkey, t.o_custkey) AS o_custkey,
      CASE WHEN s.o_custkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
      CASE WHEN s.o_custkey IS NULL THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority,
      CASE WHEN s.o_custkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice
    FROM target t FULL JOIN source s ON t.o_custkey = s.o_custkey""")
def upsert_table(spark, folder):
    """The same upsert on a table that merges on read, run twice and folded in between."""
    root = new_folder(spark, "upsert")
    for late in (False, True, True):
        upsert.upsert_table(last_orders(spark, folder, late), f"{root}/table", ["o_custkey"], buckets=8)
        upsert.fold(spark, f"{root}/table", buckets=8) if late else None
    return upsert.read_keyed(spark, f"{root}/table")


@query("""
    SELECT 'raw' AS step, CAST(3 AS BIGINT) AS tables, CAST(3 AS BIGINT) AS succeeded, CAST(0 AS BIGINT) AS failed,
      CAST(0 AS BIGINT) AS empty,
      CAST((SELECT count(*) FROM documents) + (SELECT count(*) FROM customer)
        + (SELECT count(*) FROM orders) AS BIGINT) AS rows_input,
      CAST((SELECT count(DISTINCT text) FROM documents) + (SELECT count(*) FROM customer)
        + (SELECT count(*) FROM orders) AS BIGINT) AS rows_output""")
def run_metrics(spark, folder):
    """Load three tables, append what was measured, summarise it (without the times)."""
    layout = Layout(new_folder(spark, "metrics"), key_digits=1)
    loaded_at = datetime(2002, 1, 1)
    batches = {
        "documents": raw_rows(table(spark, folder, "documents"), "doc_id", loaded_at, columns=["text"]),
        "customer": raw_rows(table(spark, folder, "customer"), "c_custkey", loaded_at),
        "orders": raw_rows(table(spark, folder, "orders"), "o_orderkey", loaded_at),
    }
    save_metrics(spark, load_raw_batch(batches, layout), layout.metrics)
    return run_summary(spark.read.parquet(layout.metrics)).drop("duration_sec")
