"""Raw layer: reads, landed files, hashing, de-duplication, appends."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from stratalake.catalog.registry import query, table
from stratalake.operators import dedup
from stratalake.operators.cleaning import CORRUPT, parse_records
from stratalake.operators.keys import latest_per_key
from stratalake.plans.layout import Layout
from stratalake.plans.raw import load_raw
from stratalake.sinks import writer
from stratalake.sources import landing, tables
from stratalake.sources.workspace import new_folder
from stratalake.streaming.ingest import stream_raw

LOADED_AT = datetime(2002, 1, 1)


def event_rows(spark, folder):
    """Events as raw rows: the props are the record, the event time is the load time."""
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("id"), F.col("props").alias("data"),
        F.sha2(F.concat_ws(":", "event_id", "props"), 256).alias("record_hash"), F.col("ts").alias("loaded_at"),
    )


@query("""
    SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
    WHERE o_orderstatus = 'O' AND o_totalprice >= 200000 AND o_orderdate >= TIMESTAMP '1996-01-01'""")
def table_read(spark, folder):
    return tables.read_table(
        spark, f"{folder}/orders.parquet",
        "o_orderstatus = 'O' AND o_totalprice >= 200000 AND o_orderdate >= timestamp_ntz'1996-01-01'",
        ["o_orderkey", "o_totalprice", "o_orderdate"],
    )


@query("SELECT event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-17 00:00:00'")
def lookback_read(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "event_type")
    return tables.look_back(events, datetime(2024, 1, 31, 15, 30), 14, column="ts")


@query("""
    SELECT CAST(event_id AS VARCHAR) AS id, ts AS loaded_at, CAST(ts AS DATE) AS load_date FROM events
    WHERE ts >= TIMESTAMP '2024-01-11 00:00:00'""")
def lookback_partitions(spark, folder):
    """The look-back window on a raw table written by load date: only its directories are read."""
    path = new_folder(spark, "lookback")
    writer.append_raw(event_rows(spark, folder), path, many_days=True)
    raw = writer.read_raw(spark, path)
    return tables.look_back(raw, date(2024, 1, 31), 20).select("id", "loaded_at", "load_date")


@query("""
    SELECT * FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-05-30'""")
def date_range(spark, folder):
    return tables.date_range(table(spark, folder, "orders"), "o_orderdate", "1997-03-01", "1997-05-30", 90)


@query("SELECT * FROM customer WHERE c_name = 'Customer#000000042'")
def point_lookup(spark, folder):
    return tables.find_by_key(table(spark, folder, "customer"), "c_name", "Customer#000000042")


@query("SELECT c_name FROM customer ORDER BY c_name LIMIT 5")
def lookup_examples(spark, folder):
    return tables.first_rows(table(spark, folder, "customer").select("c_name"), ["c_name"], 5)


@query("SELECT * FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 100")
def sample_rows(spark, folder):
    lines = table(spark, folder, "lineitem")
    return tables.first_rows(lines, ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 100)


@query("""
    SELECT CAST(event_id AS VARCHAR) AS bronze_id, ts AS bronze_loaded_at,
      CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS absent
    FROM events""")
def json_parse(spark, folder):
    parsed = parse_records(event_rows(spark, folder), "k int, absent string")
    return parsed.drop("record_hash", CORRUPT)


@query("""
    WITH texts AS (
      SELECT *, CASE event_type WHEN 'error' THEN 'not json ' || props
        WHEN 'click' THEN '{"K": 1, "k": "' || CAST(user_id AS VARCHAR) || '"}' ELSE props END AS data
      FROM events)
    SELECT CAST(event_id AS VARCHAR) AS bronze_id,
      CASE WHEN event_type NOT IN ('error', 'click')
        THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k,
      CASE WHEN event_type IN ('error', 'click') THEN data END AS _corrupt_record
    FROM texts""")
def json_rejects(spark, folder):
    """Texts that are no JSON, and members of the wrong type, are kept for the reject table."""
    events = table(spark, folder, "events")
    quoted = F.concat(F.lit('{"K": 1, "k": "'), F.col("user_id").cast("string"), F.lit('"}'))
    data = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("not json "), "props"))
        .when(F.col("event_type") == "click", quoted)
        .otherwise(F.col("props"))
    )
    raw = events.select(
        F.col("event_id").cast("string").alias("id"), data.alias("data"), F.lit("").alias("record_hash"),
        F.col("ts").alias("loaded_at"),
    )
    return parse_records(raw, "k double").select("bronze_id", "k", CORRUPT)


@query("""
    WITH told AS (
      SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS new_name,
        CASE WHEN c_nationkey < 20 THEN c_name END AS old_name FROM customer)
    SELECT id, coalesce(new_name, old_name) AS status FROM told""")
def json_aliases(spark, folder):
    """A column that the source calls by another name in some records."""
    customers = table(spark, folder, "customer")
    record = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("status"),
        F.when(F.col("c_nationkey") < 20, F.col("c_name")).alias("employee_status"),
    )
    raw = customers.select(
        F.col("c_custkey").cast("string").alias("id"), F.to_json(record).alias("data"),
        F.lit("").alias("record_hash"), F.lit(LOADED_AT).alias("loaded_at"),
    )
    return parse_records(raw, "id string, status string", {"status": ("employee_status",)}).select("id", "status")


@query("""
    WITH pages AS (
      SELECT *, o_orderstatus = 'P' OR o_orderpriority = '5-LOW' AS is_last,
        min(CASE WHEN is_last THEN o_orderkey END) OVER (PARTITION BY o_custkey) AS last_page
      FROM orders)
    SELECT o_custkey, o_orderkey, unnest(['price', 'eighth']) AS kind,
      unnest([o_totalprice, o_totalprice / 8]) AS amount
    FROM pages WHERE o_orderkey <= coalesce(last_page, o_orderkey) AND o_orderpriority <> '5-LOW'""")
def page_flatten(spark, folder):
    """A customer's orders as the pages of one listing, two records to a page. The listing ends
    with the first page that names no next page or has no records."""

    def record(kind: str, amount) -> F.Column:
        return F.struct(F.lit(kind).alias("kind"), amount.alias("amount"))

    price = F.col("o_totalprice")
    results = F.array(record("price", price), record("eighth", price / 8))
    body = F.struct(
        F.lit(2).alias("count"),
        F.when(F.col("o_orderstatus") != "P", "/next").alias("next"),
        F.when(F.col("o_orderpriority") != "5-LOW", results).alias("results"),
    )
    pages = table(spark, folder, "orders").select("o_custkey", "o_orderkey", F.to_json(body).alias("body"))
    records = landing.flatten_pages(pages, ["o_custkey"], page_no="o_orderkey")
    parsed = F.from_json("data", "kind string, amount double")
    return records.select("o_custkey", "o_orderkey", parsed.alias("r")).select("o_custkey", "o_orderkey", "r.*")


@query("""
    SELECT 'customer-' || c_nationkey AS resource, '2002-01-01T00:00:00' AS extracted_at,
      '{"balance":' || c_custkey || '.10,"id":' || repeat('9', 30) || c_custkey || ',"name":"' || c_name || ' 1.0"}' AS data
    FROM customer""")
def json_envelope(spark, folder):
    """Extracts that are one JSON document each, one per nation: a row per record, numbers by their text."""
    record = F.concat(
        F.lit('{"name": "'), "c_name", F.lit(' 1.0", "id": '), F.lit("9" * 30), "c_custkey", F.lit(', "balance": '), "c_custkey", F.lit(".10}")
    )
    listed = table(spark, folder, "customer").groupBy("c_nationkey").agg(F.collect_list(record).alias("records"))
    head = F.concat(F.lit('{"resource": "customer-'), "c_nationkey", F.lit('", "extracted_at": "2002-01-01T00:00:00", "count": '), F.size("records"))
    document = F.concat(head, F.lit(', "records": ['), F.array_join("records", ",\n"), F.lit("]}"))
    path = new_folder(spark, "envelopes")
    listed.select(document.alias("value")).coalesce(1).write.option("maxRecordsPerFile", 1).text(path)
    return landing.read_envelope_files(spark, path, spread=True)


@query("""
    SELECT CAST(doc_id AS VARCHAR) AS id,
      CAST(json_object('doc_id', doc_id, 'lang', lang, 'n_chars', n_chars, 'source', source, 'text', text)
        AS VARCHAR) AS data,
      sha256(json_object('doc_id', doc_id, 'lang', lang, 'n_chars', n_chars, 'source', source, 'text', text))
        AS record_hash,
      TIMESTAMP '2002-01-01' AS loaded_at, DATE '2002-01-01' AS load_date
    FROM documents""")
def raw_append(spark, folder):
    """Typed rows as JSON raw rows, appended to a table by load date and read back."""
    path = new_folder(spark, "raw")
    docs = table(spark, folder, "documents")
    writer.append_raw(dedup.raw_rows(docs, "doc_id", LOADED_AT), path, max_rows_per_file=500)
    return writer.read_raw(spark, path)


DEDUP_SQL = """
    WITH hashed AS (
      SELECT doc_id, text, sha256(json_object('lang', lang, 'text', text)) AS record_hash FROM documents),
    loaded AS (SELECT record_hash FROM hashed WHERE doc_id IN (SELECT doc_id FROM labels))
"""


def document_rows(spark, folder):
    """Documents as raw rows whose content is language and text, so copies share a hash."""
    return dedup.raw_rows(
        table(spark, folder, "documents"), "doc_id", LOADED_AT, columns=["lang", "text"]
    )


def labelled_rows(spark, folder):
    """The part loaded earlier: documents that have a label."""
    labelled = table(spark, folder, "labels").select(F.col("doc_id").cast("string").alias("id"))
    return document_rows(spark, folder).join(labelled, "id", "left_semi")


@query(DEDUP_SQL + """
    SELECT record_hash, min(CAST(doc_id AS VARCHAR)) AS id FROM hashed
    WHERE record_hash NOT IN (SELECT record_hash FROM loaded) GROUP BY record_hash""")
def record_hash_dedup(spark, folder):
    """A batch without its own copies and without what was loaded before."""
    return dedup.new_records(document_rows(spark, folder), labelled_rows(spark, folder)).select("record_hash", "id")


@query(DEDUP_SQL + "SELECT CAST(doc_id AS VARCHAR) AS id, record_hash FROM hashed")
def dedup_bypass(spark, folder):
    return dedup.new_records(
        document_rows(spark, folder), labelled_rows(spark, folder), skip_dedup=True
    ).select("id", "record_hash")


@query(DEDUP_SQL + """
    SELECT (SELECT count(*) FROM hashed) AS rows_in, count(DISTINCT record_hash) AS rows_new,
      (SELECT count(*) FROM hashed) - count(DISTINCT record_hash) AS rows_skipped
    FROM hashed WHERE record_hash NOT IN (SELECT record_hash FROM loaded)""")
def dedup_report(spark, folder):
    return dedup.dedup_report(document_rows(spark, folder), labelled_rows(spark, folder))


@query(DEDUP_SQL + """
    SELECT record_hash, min(CAST(doc_id AS VARCHAR)) AS id FROM hashed
    WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY record_hash
    UNION ALL
    SELECT record_hash, min(CAST(doc_id AS VARCHAR)) FROM hashed
    WHERE record_hash NOT IN (SELECT record_hash FROM loaded) GROUP BY record_hash""")
def raw_load_twice(spark, folder):
    """An early load, a full load, and the full load again: the raw table after all three."""
    layout = Layout(new_folder(spark, "raw-load"), key_digits=1)
    for batch in (labelled_rows(spark, folder), document_rows(spark, folder), document_rows(spark, folder)):
        done = load_raw(batch, "documents", layout)
        if done.errors:
            raise RuntimeError(done.errors[0])
    return writer.read_raw(spark, layout.raw("documents")).select("record_hash", "id")


@query(DEDUP_SQL + "SELECT DISTINCT record_hash FROM hashed")
def stream_dedup(spark, folder):
    """The same load as a stream of files: labelled documents first, then all of them in a file that arrives late and
    holds the first ones again, after a restart; then once more by a stream that remembers nothing."""
    layout = Layout(new_folder(spark, "stream"), key_digits=1)
    landing_folder = f"{layout.root}/landing"
    docs = table(spark, folder, "documents")
    labelled = docs.join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")

    def run(checkpoint: str) -> None:
        records = spark.readStream.schema(docs.schema).parquet(landing_folder)
        stream = stream_raw(
            records, lambda batch: dedup.raw_rows(batch, "doc_id", LOADED_AT, columns=["lang", "text"]),
            "documents", layout, f"{layout.root}/{checkpoint}",
        )
        stream.awaitTermination()

    for batch in (labelled, docs):
        batch.write.mode("append").parquet(landing_folder)
        run("first")
    run("second")
    return writer.read_raw(spark, layout.raw("documents")).select("record_hash")


@query("""
    SELECT * FROM lineitem QUALIFY row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) = 1""")
def latest_rows(spark, folder):
    return latest_per_key(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate",
        ["l_extendedprice", "l_partkey", "l_suppkey", "l_quantity"],
    )


@query("SELECT * FROM customer")
def json_largest_run(spark, folder):
    """Two extracts as JSON-lines runs; the one with the most bytes is read back."""
    root = new_folder(spark, "runs")
    customers = table(spark, folder, "customer")
    some = customers.where("c_mktsegment = 'BUILDING'")
    writer.write_json_run(some, root, "customer", datetime(2002, 1, 2))
    writer.write_json_run(customers, root, "customer", datetime(2002, 1, 1))
    largest = landing.largest_source(spark, f"{root}/customer_*/*.json", by_directory=True)
    return landing.read_json_lines(spark, largest, customers.schema)
