"""Column functions, on whole tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from stratalake.catalog.registry import dealt, query, table
from stratalake.functions import calendar, derive, digest, json, text
from stratalake.operators import cleaning, dedup, display
from stratalake.operators.dedup import as_timestamp

AS_OF = datetime(1998, 6, 30)
# The e-mail pattern.
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


@query(f"""
    SELECT doc_id,
      nullif(trim(substr(text, 1, strpos(text, ' '))), '') AS first_word,
      nullif(trim('  ' || lang || ' '), '') AS lang,
      nullif(trim(chr(9) || source || ' '), '') AS tabbed,
      nullif(trim(CASE WHEN lang = 'en' THEN '   ' ELSE text END), '') AS text,
      upper(source) AS source_code, upper(trim(' ' || source || ' ')) AS trimmed_code
    FROM documents""")
def clean_strings(spark, folder):
    docs = table(spark, folder, "documents")
    padded = F.concat(F.lit(" "), "source", F.lit(" "))
    return docs.select(
        "doc_id",
        text.clean_text(F.expr("substr(text, 1, instr(text, ' '))")).alias("first_word"),
        text.clean_text(F.concat(F.lit("  "), "lang", F.lit(" "))).alias("lang"),
        text.clean_text(F.concat(F.lit("\t"), "source", F.lit(" "))).alias("tabbed"),
        text.clean_text(F.when(F.col("lang") == "en", "   ").otherwise(F.col("text"))).alias("text"),
        text.upper_code("source").alias("source_code"),
        text.upper_code(padded, trim=True).alias("trimmed_code"),
    )


@query(f"""
    WITH found AS (
      SELECT doc_id, regexp_extract(text, '[^ \\n]+@[^ \\n]+') AS address FROM documents)
    SELECT doc_id, CASE WHEN regexp_matches(address, '{EMAIL}') THEN lower(trim(address)) END AS address,
      CASE WHEN regexp_matches(' ' || address, '{EMAIL}') THEN lower(trim(address)) END AS padded,
      CASE WHEN regexp_matches(address, '{EMAIL}') THEN lower(address) END AS padded_trimmed,
      regexp_matches(address, '{EMAIL}') AS has_email
    FROM found""")
def clean_email(spark, folder):
    found = F.regexp_extract("text", r"[^ \n]+@[^ \n]+", 0)
    docs = table(spark, folder, "documents").select("doc_id", found.alias("found"))
    padded = F.concat(F.lit(" "), "found")
    return docs.select(
        "doc_id",
        text.clean_email("found").alias("address"),
        text.clean_email(padded).alias("padded"),
        text.clean_email(padded, trim_first=True).alias("padded_trimmed"),
        text.clean_email("found").isNotNull().alias("has_email"),
    )


@query("""
    SELECT doc_id, nullif(regexp_replace(text, '[^0-9]', '', 'g'), '') AS digits,
      nullif(regexp_replace(regexp_extract(text, '[+(][0-9][-0-9() .]{8,}[0-9]'), '[^0-9]', '', 'g'), '') AS phone
    FROM documents""")
def clean_phone(spark, folder):
    number = F.regexp_extract("text", r"[+(][0-9][-0-9() .]{8,}[0-9]", 0)
    return table(spark, folder, "documents").select(
        "doc_id", text.clean_phone("text").alias("digits"), text.clean_phone(number).alias("phone")
    )


@query("""
    SELECT o_orderkey, o_orderdate AS iso, o_orderdate AS slashed, CAST(NULL AS TIMESTAMP) AS unreadable
    FROM orders""")
def standardize_dates(spark, folder):
    slashed = F.date_format("o_orderdate", "dd/MM/yyyy")
    return cleaning.timestamps_without_zone(
        table(spark, folder, "orders").select(
            "o_orderkey",
            text.parse_timestamp(F.col("o_orderdate").cast("string")).alias("iso"),
            text.parse_timestamp(slashed, "dd/MM/yyyy").alias("slashed"),
            text.parse_timestamp("o_orderpriority").alias("unreadable"),
        )
    )


@query("""
    SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_sk,
      CAST(o_orderdate AS DATE) AS date, CAST(year(o_orderdate) AS INTEGER) AS year,
      CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(month(o_orderdate) AS INTEGER) AS month,
      monthname(o_orderdate) AS month_name, CAST(day(o_orderdate) AS INTEGER) AS day,
      CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week, dayname(o_orderdate) AS day_name,
      CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year, CAST(week(o_orderdate) AS INTEGER) AS week_of_year,
      dayofweek(o_orderdate) IN (0, 6) AS is_weekend
    FROM orders""")
def calendar_parts(spark, folder):
    parts = calendar.calendar_columns("o_orderdate")
    return table(spark, folder, "orders").select("o_orderkey", *[e.alias(n) for n, e in parts.items()])


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS ship_date_sk,
      CASE WHEN l_returnflag <> 'N' THEN CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) END AS return_date_sk,
      CAST(l_shipdate AS DATE) AS ship_date
    FROM lineitem""")
def date_keys(spark, folder):
    returned = F.when(F.col("l_returnflag") != "N", F.col("l_shipdate"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        calendar.date_key("l_shipdate").alias("ship_date_sk"),
        calendar.date_key(returned).alias("return_date_sk"),
        F.to_date("l_shipdate").alias("ship_date"),
    )


@query("""
    WITH named AS (
      SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS first_name,
        CASE WHEN c_nationkey < 15 THEN c_name END AS last_name FROM customer)
    SELECT c_custkey, CASE WHEN first_name IS NOT NULL AND last_name IS NOT NULL
        THEN first_name || ' ' || last_name
      WHEN first_name IS NOT NULL THEN first_name WHEN last_name IS NOT NULL THEN last_name
      ELSE 'UNKNOWN' END AS full_name
    FROM named""")
def full_name(spark, folder):
    first = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    last = F.when(F.col("c_nationkey") < 15, F.col("c_name"))
    return table(spark, folder, "customer").select("c_custkey", derive.full_name(first, last).alias("full_name"))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice - l_extendedprice * l_tax AS margin,
      (l_extendedprice - l_extendedprice * l_tax) / l_extendedprice * 100 AS margin_pct,
      CASE WHEN l_tax <> 0 THEN (l_tax - l_discount) / l_tax * 100 END AS margin_pct_zero_income
    FROM lineitem""")
def margin(spark, folder):
    cost = F.col("l_extendedprice") * F.col("l_tax")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        derive.margin("l_extendedprice", cost).alias("margin"),
        derive.margin_pct("l_extendedprice", cost).alias("margin_pct"),
        derive.margin_pct("l_tax", "l_discount").alias("margin_pct_zero_income"),
    )


@query("""
    SELECT event_id, CAST(date_diff('day', ts, TIMESTAMP '2024-01-15 23:00:00') AS INTEGER) AS days_to_mid,
      CAST(date_diff('day', ts, CASE WHEN event_type <> 'error' THEN ts + INTERVAL 30 HOUR END) AS INTEGER)
        AS days_open
    FROM events""")
def duration_days(spark, folder):
    mid = F.lit(datetime(2024, 1, 15, 23)).cast("timestamp_ntz")
    later = F.when(F.col("event_type") != "error", F.col("ts") + F.expr("INTERVAL 30 HOUR"))
    return table(spark, folder, "events").select(
        "event_id",
        derive.duration_days("ts", mid).alias("days_to_mid"),
        derive.duration_days("ts", later).alias("days_open"),
    )


@query(f"""
    WITH marked AS (
      SELECT *, nullif(o_orderstatus, 'P') AS status,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate + INTERVAL 30 DAY END AS due,
        CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate END AS opened FROM orders)
    SELECT o_orderkey, status IN ('O', 'X') AS is_open, status = 'F' AS is_done,
      status IN ('O') AND due < TIMESTAMP '{AS_OF}' AS is_overdue,
      opened IS NULL OR due IS NULL OR opened + INTERVAL 40 DAY <= due AS dates_valid,
      CASE WHEN due < TIMESTAMP '{AS_OF}' THEN FALSE ELSE status IN ('O', 'X') END AS still_open,
      due IS NOT NULL AS has_due
    FROM marked""")
def status_flags(spark, folder):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    due = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate") + F.expr("INTERVAL 30 DAY"))
    opened = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate"))
    now = as_timestamp(AS_OF)
    is_open = derive.status_in(status, ["O", "X"])
    return table(spark, folder, "orders").select(
        "o_orderkey",
        is_open.alias("is_open"),
        (status == "F").alias("is_done"),
        derive.overdue(status, due, now, ["O"]).alias("is_overdue"),
        derive.dates_in_order(opened + F.expr("INTERVAL 40 DAY"), due).alias("dates_valid"),
        derive.active_until(is_open, due, now).alias("still_open"),
        due.isNotNull().alias("has_due"),
    )


@query("""
    SELECT doc_id, sha256(json_object('doc_id', doc_id, 'lang', lang, 'n_chars', n_chars,
      'source', source, 'text', text)) AS record_hash
    FROM documents""")
def record_hash(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", digest.record_hash(docs.columns).alias("record_hash"))


def record_text(event_type: str, k: str) -> str:
    """SQL for the text that is hashed of an event's record."""
    return f"""
      '{{"_resource":"events","amount":' || event_id || '.10,"event_id":' || event_id || ',"event_type":"' || {event_type}
      || '","props":{{"even":' || (event_id % 2 = 0) || ',"k":' || {k}
      || '}},"serial":' || repeat('1234567890', 4) || (event_id % 10) || '}}'"""


@query(f"""
    WITH told AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events)
    SELECT event_id, sha256({record_text('event_type', 'k')}) AS record_hash,
      sha256({record_text('event_type', 'k')}) AS reordered_hash,
      sha256({record_text("'click'", 'k')}) AS clicked_hash,
      sha256({record_text('event_type', "k || '.0'")}) AS other_text_hash
    FROM told""")
def record_hash_json(spark, folder):
    """Digests of JSON records: members in key order, numbers by their text, bookkeeping fields left out."""
    events = dealt(table(spark, folder, "events"), "event_id").withColumn("k", F.get_json_object("props", "$.k"))

    def member(name: str, value) -> F.Column:
        return F.concat(F.lit(f'"{name}":'), value)

    def text_member(name: str, value) -> F.Column:
        return F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))

    def hashed(*members, event_type=F.col("event_type"), k=F.col("k")) -> F.Column:
        even = F.when(F.col("event_id") % 2 == 0, "true").otherwise("false")
        props = F.concat(F.lit("{"), member("k", k), F.lit(" , "), member("even", even), F.lit("}"))
        serial = F.concat(F.lit("1234567890" * 4), F.col("event_id") % 10)
        known = {
            "resource": text_member("_resource", F.lit("events")), "id": member("event_id", F.col("event_id")),
            "amount": member("amount", F.concat("event_id", F.lit(".10"))), "type": text_member("event_type", event_type),
            "props": member("props", props), "serial": member("serial", serial),
            "stamp": text_member("_extracted_at", F.col("ts").cast("string")),
        }
        return digest.record_hash_json(F.concat(F.lit("{"), F.concat_ws(", ", *(known[m] for m in members)), F.lit("}")))

    one, other = ("id", "type", "amount", "props", "serial", "resource"), ("stamp", "serial", "props", "resource", "amount", "id", "type")
    return events.select(
        "event_id", hashed(*one).alias("record_hash"), hashed(*other).alias("reordered_hash"),
        hashed(*one, event_type=F.lit("click")).alias("clicked_hash"),
        hashed(*one, k=F.concat("k", F.lit(".0"))).alias("other_text_hash"),
    )


def key_sql(*columns: str) -> str:
    parts = [f"coalesce(length({c}) || ':' || {c}, '-')" for c in columns]
    return "md5(" + " || '||' || ".join(parts) + ")"


@query(f"""
    WITH texts AS (
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_orderkey AS VARCHAR) AS a,
        CAST(l_linenumber AS VARCHAR) AS b, nullif(l_returnflag, 'N') AS c,
        nullif(l_linestatus, 'O') AS d, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS e FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {key_sql('a', 'b')} AS line_key,
      {key_sql('c', 'd', 'e')} AS version_key, {key_sql('c', 'd')} = {key_sql('d', 'c')} AS same_swapped
    FROM texts""")
def surrogate_keys(spark, folder):
    c, d = F.nullif(F.col("l_returnflag"), F.lit("N")), F.nullif(F.col("l_linestatus"), F.lit("O"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        digest.surrogate_key(["l_orderkey", "l_linenumber"]).alias("line_key"),
        digest.surrogate_key([c, d, "l_shipdate"]).alias("version_key"),
        (digest.surrogate_key([c, d]) == digest.surrogate_key([d, c])).alias("same_swapped"),
    )


@query("""
    SELECT o.o_orderkey, o.o_orderstatus AS kept, o.o_orderpriority AS detail_wins,
      CAST(NULL AS VARCHAR) AS null_wins, o.o_orderstatus AS base_wins, CAST(o.o_custkey AS VARCHAR) AS added,
      o.o_orderstatus AS without_detail
    FROM orders o""")
def list_detail_merge(spark, folder):
    """A list record with its detail record, both as JSON."""
    orders = table(spark, folder, "orders")
    keep_nulls = {"ignoreNullFields": "false"}
    listed = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
            F.lit("list").alias("priority"), F.lit("list").alias("note"),
        )
    )
    detail = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"),
            F.lit(None).cast("string").alias("note"), F.col("o_custkey").alias("customer"),
        ),
        keep_nulls,
    )
    listing = orders.select("o_orderkey", listed.alias("listed"))
    details = orders.select("o_orderkey", detail.alias("detail"), F.lit('{"status":"other"}').alias("other"))
    joined = listing.join(details, "o_orderkey", "left")
    merged = joined.select(
        "o_orderkey",
        json.merge_json("listed", "detail").alias("merged"),
        json.merge_json("listed", "other", overwrite=False).alias("guarded"),
        json.merge_json("listed", F.lit(None).cast("string")).alias("alone"),
    )
    return merged.select(
        "o_orderkey",
        json.nested_get("merged", "status").alias("kept"),
        json.nested_get("merged", "priority").alias("detail_wins"),
        json.nested_get("merged", "note").alias("null_wins"),
        json.nested_get("guarded", "status").alias("base_wins"),
        json.nested_get("merged", "customer").alias("added"),
        json.nested_get("alone", "status").alias("without_detail"),
    )


WIDE = 80


@query(f"""
    SELECT c_custkey, '{{' || list_aggregate(list_transform(range({WIDE * 3 // 2}), lambda i:
      '"m' || lpad(i::varchar, 3, '0') || '":' || CASE WHEN i < {WIDE // 2} THEN c_custkey || '.' || i || '0'
        WHEN i % 3 = 0 THEN 'null' ELSE '"' || c_name || ' 1.10"' END), 'string_agg', ',') || '}}' AS merged
    FROM customer""")
def list_detail_merge_wide(spark, folder):
    """Records of many members, half of them in both; the text of every number stays."""
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")

    def record(first: int, value) -> F.Column:
        place = F.sequence(F.lit(first), F.lit(first + WIDE - 1))
        named = F.transform(place, lambda i: F.concat(F.lit('"m'), F.lpad(i.cast("string"), 3, "0"), F.lit('": '), value(i)))
        return F.concat(F.lit("{"), F.array_join(F.reverse(named), ", "), F.lit("}"))

    listed = record(0, lambda i: F.concat(key, F.lit("."), i.cast("string"), F.lit("0")))
    detail = record(WIDE // 2, lambda i: F.when(i % 3 == 0, "null").otherwise(F.concat(F.lit('"'), name, F.lit(' 1.10"'))))
    customers = dealt(table(spark, folder, "customer").select("c_custkey", "c_name"), "c_custkey")
    customers = customers.select("c_custkey", listed.alias("listed"), detail.alias("detail"))
    return customers.select("c_custkey", json.merge_json("listed", "detail").alias("merged"))


@query("""
    SELECT event_id, json_extract_string(props, '$.k') AS k, 'N/A' AS missing, 'N/A' AS through_a_value,
      event_type AS nested, CASE WHEN value < 10 THEN 'N/A' ELSE CAST(user_id AS VARCHAR) END AS sometimes
    FROM events""")
def nested_get(spark, folder):
    user = F.when(F.col("value") >= 10, F.col("user_id")).alias("user")
    inner = F.struct(F.col("event_type").alias("type"), user).alias("event")
    record = F.to_json(F.struct(F.struct(inner).alias("body")))
    return table(spark, folder, "events").select("event_id", "props", record.alias("record")).select(
        "event_id",
        json.nested_get("props", "k").alias("k"),
        json.nested_get("props", "k2", "N/A").alias("missing"),
        json.nested_get("props", "k.deeper", "N/A").alias("through_a_value"),
        json.nested_get("record", "body.event.type").alias("nested"),
        json.nested_get("record", "body/event/user", "N/A", "/").alias("sometimes"),
    )


@query("""
    SELECT o_orderkey, '{"_extracted_at":"2002-01-01T00:00:00","_resource":"orders","amount":' || o_orderkey || '.50,"status":"'
      || o_orderstatus || '"}' AS record, 'orders' AS resource, '2002-01-01T00:00:00' AS extracted_at, o_orderstatus AS status
    FROM orders""")
def source_fields(spark, folder):
    """JSON records stamped with resource and extraction time; all else stays as it is, numbers by their text."""
    record = F.concat(F.lit('{"status":"'), "o_orderstatus", F.lit('","amount":'), "o_orderkey", F.lit(".50}"))
    stamped = dedup.add_source_fields(record, "orders", datetime(2002, 1, 1))
    return table(spark, folder, "orders").select("o_orderkey", stamped.alias("record")).select(
        "o_orderkey", "record",
        json.nested_get("record", "_resource").alias("resource"),
        json.nested_get("record", "_extracted_at").alias("extracted_at"),
        json.nested_get("record", "status").alias("status"),
    )


@query(f"""
    SELECT o_orderkey, o_orderstatus, TIMESTAMP '{AS_OF}' AS silver_processed_at, TRUE AS silver_is_current
    FROM orders""")
def processing_columns(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return cleaning.add_processing_columns(orders, AS_OF)


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
      CASE WHEN c_mktsegment = 'MACHINERY' THEN 'N/A' ELSE c_mktsegment END AS c_mktsegment,
      'N/A' AS c_phone, CASE WHEN c_nationkey = 1 THEN 'Active' ELSE 'Inactive' END AS c_nationkey
    FROM customer""")
def attribute_view(spark, folder):
    customers = table(spark, folder, "customer").withColumn(
        "c_mktsegment", F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY"))
    )
    shown = ["c_custkey", "c_name", "c_mktsegment", "c_phone"]
    return display.attribute_view(customers, shown, login="c_nationkey")


# A record field of the card by an expression that Spark and DuckDB both read; the others are missing.
CARD = {
    "employee_number": "CAST(s_suppkey AS STRING)",
    "first_name": "CASE WHEN s_acctbal < 0 THEN NULL ELSE s_name END",
    "last_name": "CASE WHEN s_nationkey > 20 THEN NULL ELSE 'of ' || CAST(s_nationkey AS STRING) END",
    "emp_short_name": "CASE WHEN s_nationkey < 5 THEN NULL ELSE 'S' || CAST(s_suppkey AS STRING) END",
    "email_id": "replace(s_name, '#', '.') || '@example.com'",
    "mobile_phone": "CASE WHEN s_nationkey > 20 THEN '' ELSE '555' || CAST(s_suppkey AS STRING) END",
    "gender": "CAST(NULL AS STRING)",
    "emp_type": "CASE WHEN s_nationkey < 12 THEN 'full_time' ELSE 'contract' END",
    "emptype_category": "CASE WHEN s_nationkey < 12 THEN NULL ELSE 'W2' END",
    "employee_status": "CASE WHEN s_acctbal < 5000 THEN 'active' ELSE 'left' END",
    "date_of_joining": "'1996-01-02'",
    "release_date": "CASE WHEN s_acctbal < 5000 THEN NULL WHEN s_acctbal < 7000 THEN '' ELSE '1999-03-31' END",
    "resignation_status": "CASE WHEN s_acctbal < 8000 THEN NULL ELSE 'accepted' END",
    "department": "'Dept ' || CAST(s_nationkey AS STRING)",
    "location": "'L' || CAST(s_nationkey AS STRING)",
    "reporting_manager": "CAST(s_nationkey AS STRING)",
    "login_status": "CASE WHEN s_nationkey < 3 THEN NULL WHEN s_nationkey < 15 THEN 1 ELSE 0 END",
    "created": "'1995-12-01'",
}


def card_sql() -> str:
    shown = {
        **{c: f"coalesce({CARD.get(c, 'NULL')}, 'N/A')" for columns in display.EMPLOYEE_GROUPS.values() for c in columns},
        "employee": f"coalesce({CARD['first_name']}, '') || ' ' || coalesce({CARD['last_name']}, '')",
        "login_status": f"CASE WHEN {CARD['login_status']} = 1 THEN 'Active' ELSE 'Inactive' END",
    }
    named = [(group, c) for group, columns in display.EMPLOYEE_GROUPS.items() for c in columns]
    rows = [
        f"SELECT s_suppkey, '{group}' AS \"group\", CAST({i} AS INTEGER) AS position, '{c}' AS attribute, {shown[c]} AS value FROM supplier"
        + (f" WHERE coalesce({CARD['release_date']}, '') <> ''" if c in display.ONLY_WITH_RELEASE_DATE else "")
        for i, (group, c) in enumerate(named)
    ]
    return " UNION ALL ".join(rows)


@query(card_sql())
def employee_view(spark, folder):
    """The cards of all employees: 29 fields in six groups, one row per attribute shown; release details where there is a date."""
    fields = [F.expr(value).alias(c) for c, value in CARD.items()]
    return display.employee_card(table(spark, folder, "supplier").select("s_suppkey", *fields), "s_suppkey")
