"""Records for the seven resources, made from the given tables.

One SELECT per resource, in SQL that Spark and DuckDB both read, so a query and its check
start from the same records. Values are padded, blank, malformed or missing where the data
say so (balances, flags, keys), which gives every cleaning rule something to do.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.catalog.registry import table
from stratalake.operators.dedup import raw_rows

LOADED_AT = datetime(2002, 1, 1)

FEEDS = {
    "employees": (
        "supplier",
        """
        SELECT CAST(s_suppkey AS STRING) AS id,
          '  EMP-' || CAST(s_suppkey AS STRING) || ' ' AS employee_code,
          CASE WHEN s_acctbal < 0 THEN '   ' ELSE ' ' || s_name END AS first_name,
          CASE WHEN s_nationkey < 5 THEN NULL ELSE 'of ' || CAST(s_nationkey AS STRING) END AS last_name,
          CASE WHEN s_acctbal < 500 THEN ' ' || replace(s_name, '#', '.') || '@example.com '
               WHEN s_acctbal < 1500 THEN replace(s_name, '#', '.') || '@example'
               ELSE replace(s_name, '#', '.') || '@Example.COM' END AS email,
          CASE WHEN s_acctbal < 0 THEN 'n/a'
               ELSE '+1 (555) ' || CAST(s_suppkey AS STRING) || '-' || CAST(s_nationkey AS STRING) END AS phone,
          CASE WHEN s_nationkey > 20 THEN '' ELSE '555.' || CAST(s_suppkey AS STRING) END AS mobile,
          CASE WHEN s_nationkey < 3 THEN NULL WHEN s_acctbal < 2000 THEN ' active'
               WHEN s_acctbal < 5000 THEN 'Employed' WHEN s_acctbal < 8000 THEN 'active'
               ELSE 'left' END AS status,
          CASE WHEN s_nationkey < 12 THEN 'full_time' ELSE 'Contract' END AS employment_type,
          ' Grade ' || CAST(s_nationkey AS STRING) AS job_title,
          CASE WHEN s_nationkey > 18 THEN ' ' ELSE 'Dept' END AS department,
          'L' || CAST(s_nationkey AS STRING) || '  ' AS location,
          '1996-01-' || lpad(CAST(s_nationkey + 1 AS STRING), 2, '0') AS hire_date,
          CASE WHEN s_acctbal < 1000 THEN '1995-06-30' WHEN s_acctbal > 8000 THEN '1999-03-31 12:30:00'
               ELSE NULL END AS termination_date,
          CAST(s_nationkey AS STRING) AS manager_id,
          'Manager ' || CAST(s_nationkey AS STRING) AS manager_name,
          s_acctbal AS salary, 'USD' AS currency,
          '1995-12-01' AS created_at, '1995-12-02' AS updated_at
        FROM {supplier}
        """,
    ),
    "projects": (
        "orders",
        """
        SELECT CAST(o_orderkey AS STRING) AS id,
          ' PRJ-' || CAST(o_orderkey AS STRING) AS project_code,
          o_orderpriority || '  ' AS project_name,
          CASE WHEN o_totalprice < 50000 THEN '  ' ELSE 'priority ' || o_orderpriority END AS description,
          CASE o_orderstatus WHEN 'F' THEN 'active' WHEN 'O' THEN 'In_Progress' ELSE NULL END AS status,
          CAST(o_custkey AS STRING) AS client_id,
          ' Customer ' || CAST(o_custkey AS STRING) AS client_name,
          CAST(o_orderdate AS STRING) AS start_date,
          CAST(o_orderdate + INTERVAL 90 DAY AS STRING) AS end_date,
          o_totalprice AS budget, 'USD' AS currency,
          CAST(o_custkey AS STRING) AS project_manager_id,
          CAST(NULL AS STRING) AS project_manager_name,
          CAST(o_orderdate AS STRING) AS created_at, CAST(o_orderdate AS STRING) AS updated_at
        FROM {orders}
        """,
    ),
    # Order and line number are not unique, so a placement has several versions. Part numbers
    # run past customer numbers, so some clients are not found.
    "placements": (
        "lineitem",
        """
        SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS id,
          'PL-' || CAST(l_partkey AS STRING) || ' ' AS placement_code,
          CAST(l_suppkey AS STRING) AS employee_id,
          ' Supplier ' || CAST(l_suppkey AS STRING) AS employee_name,
          CAST(l_orderkey AS STRING) AS project_id,
          CASE WHEN l_quantity < 10 THEN ' ' ELSE 'Order ' || CAST(l_orderkey AS STRING) END AS project_name,
          CAST(l_partkey AS STRING) AS client_id,
          'Part ' || CAST(l_partkey AS STRING) AS client_name,
          CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_linestatus = 'O' THEN 'active'
               WHEN l_returnflag = 'A' THEN 'Ongoing' ELSE 'ended' END AS status,
          CAST(l_shipdate AS STRING) AS start_date,
          CASE WHEN l_returnflag = 'N' THEN NULL
               ELSE CAST(l_shipdate + INTERVAL 45 DAY AS STRING) END AS end_date,
          CASE WHEN l_quantity < 3 THEN l_quantity * 0 ELSE l_extendedprice END AS bill_rate,
          CASE WHEN l_tax > 0.07 THEN NULL ELSE l_extendedprice * (1 - l_discount) END AS pay_rate,
          'USD' AS currency, 'contract' AS placement_type,
          CAST(l_shipdate AS STRING) AS created_at, CAST(l_shipdate AS STRING) AS updated_at,
          l_shipdate + CAST(l_partkey AS INT) * INTERVAL '1' SECOND AS loaded_at
        FROM {lineitem}
        """,
    ),
    "clients": (
        "customer",
        """
        SELECT CAST(c_custkey AS STRING) AS id,
          ' CL-' || CAST(c_custkey AS STRING) AS client_code,
          c_name || ' ' AS client_name,
          CASE WHEN c_mktsegment = 'MACHINERY' THEN '  ' ELSE ' ' || c_mktsegment END AS industry,
          CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 6000 THEN 'Active' ELSE 'closed' END AS status,
          'Street ' || CAST(c_nationkey AS STRING) AS address,
          ' City ' || CAST(c_nationkey AS STRING) AS city,
          CASE WHEN c_nationkey > 20 THEN '' ELSE 'S' || CAST(c_nationkey AS STRING) END AS state,
          'N' || CAST(c_nationkey AS STRING) || ' ' AS country,
          CAST(10000 + c_custkey AS STRING) AS postal_code,
          CASE WHEN c_acctbal < 500 THEN 'none' ELSE '(555) 10-' || CAST(c_custkey AS STRING) END AS phone,
          CASE WHEN c_acctbal < 1000 THEN 'no mail'
               ELSE 'Info+' || CAST(c_custkey AS STRING) || '@Client.example' END AS email,
          'www.example.com' AS website,
          CAST(c_nationkey AS STRING) AS account_manager_id, CAST(NULL AS STRING) AS account_manager_name,
          '1995-01-01' AS created_at, '1995-01-02T03:04:05' AS updated_at
        FROM {customer}
        """,
    ),
    "vendors": (
        "part",
        """
        SELECT CAST(p_partkey AS STRING) AS id,
          p_brand || ' ' AS vendor_code,
          '  ' || p_name AS vendor_name,
          lower(p_type) AS vendor_type,
          CASE WHEN p_size < 10 THEN 'approved' WHEN p_size < 30 THEN 'Active'
               WHEN p_size < 40 THEN 'blocked' ELSE NULL END AS status,
          'Road ' || CAST(p_size AS STRING) AS address,
          ' City' AS city, ' ' AS state, 'Country ' AS country, '00000' AS postal_code,
          '00-' || CAST(p_partkey AS STRING) || '/' || CAST(p_size AS STRING) AS phone,
          replace(p_name, ' ', '.') || '@vendor.example' AS email,
          CASE WHEN p_size > 25 THEN '' ELSE ' Contact ' || CAST(p_size AS STRING) END AS contact_person,
          CAST(p_partkey AS STRING) AS tax_id,
          '1995-01-01' AS created_at, '1995-01-01' AS updated_at
        FROM {part}
        """,
    ),
    "expenses": (
        "events",
        """
        SELECT CAST(event_id AS STRING) AS id,
          ' EX-' || CAST(event_id AS STRING) AS expense_code,
          CAST(user_id AS STRING) AS employee_id,
          'User ' || CAST(user_id AS STRING) || ' ' AS employee_name,
          CAST(user_id AS STRING) AS project_id,
          ' ' AS project_name,
          event_type AS expense_type,
          ' ' || event_type || ' ' AS category,
          props AS description,
          CAST(ts AS STRING) AS expense_date,
          value AS amount, 'USD' AS currency,
          CASE event_type WHEN 'purchase' THEN 'paid' WHEN 'click' THEN 'Approved'
               WHEN 'error' THEN NULL ELSE 'submitted' END AS status,
          CAST(ts AS STRING) AS submitted_date,
          CASE WHEN value < 10 THEN 'unknown' ELSE CAST(ts + INTERVAL 2 DAY AS STRING) END AS approved_date,
          CAST(NULL AS STRING) AS approver_id, CAST(NULL AS STRING) AS approver_name,
          CAST(ts AS STRING) AS created_at, CAST(ts AS STRING) AS updated_at
        FROM {events}
        """,
    ),
    "invoices": (
        "orders",
        """
        SELECT CAST(o_orderkey AS STRING) AS id,
          ' INV-' || CAST(o_orderkey AS STRING) AS invoice_number,
          CAST(o_custkey AS STRING) AS client_id,
          'Customer ' || CAST(o_custkey AS STRING) AS client_name,
          CAST(o_orderkey AS STRING) AS project_id,
          o_orderpriority AS project_name,
          CAST(NULL AS STRING) AS placement_id,
          CAST(o_orderdate AS STRING) AS invoice_date,
          CASE WHEN o_orderpriority = '5-LOW' THEN NULL
               ELSE CAST(o_orderdate + INTERVAL 30 DAY AS STRING) END AS due_date,
          CAST(o_orderdate AS STRING) AS period_start,
          CAST(o_orderdate + INTERVAL 28 DAY AS STRING) AS period_end,
          o_totalprice AS subtotal, o_totalprice * 0.25e0 AS tax, o_totalprice * 1.25e0 AS total_amount,
          'USD' AS currency,
          CASE WHEN o_orderpriority = '2-HIGH' THEN NULL WHEN o_orderstatus = 'F' THEN 'paid'
               WHEN o_orderstatus = 'O' THEN 'Sent' ELSE 'closed' END AS status,
          CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate + INTERVAL 20 DAY AS STRING)
               ELSE NULL END AS payment_date,
          'wire' AS payment_method, '  ' AS notes,
          CAST(o_orderdate AS STRING) AS created_at, CAST(o_orderdate AS STRING) AS updated_at
        FROM {orders}
        """,
    ),
}


def feed(spark: SparkSession, folder: str, resource: str) -> DataFrame:
    source, text = FEEDS[resource]
    return spark.sql(text, **{source: table(spark, folder, source)})


def feed_sql(resource: str) -> str:
    source, text = FEEDS[resource]
    return text.replace("{" + source + "}", source)


def raw_feed(spark: SparkSession, folder: str, resource: str) -> DataFrame:
    """The records as raw rows. A record's load time is its own where it has one."""
    records = feed(spark, folder, resource)
    loaded = F.col("loaded_at") if "loaded_at" in records.columns else LOADED_AT
    fields = [c for c in records.columns if c != "loaded_at"]
    return raw_rows(records, "id", loaded, columns=fields)
