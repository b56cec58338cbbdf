"""Star schema: dimensions, history, calendar, facts."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.catalog.cleaned import AS_OF, CLEANED_SQL, cleaned, latest_cleaned
from stratalake.catalog.columns import key_sql
from stratalake.catalog.registry import query, table
from stratalake.functions.digest import surrogate_key
from stratalake.operators import history
from stratalake.operators.cleaning import finish_records
from stratalake.operators.keys import latest_per_key
from stratalake.operators.lookup import add_dimension_key
from stratalake.operators.modeling import date_rows_covering, dimension_rows, fact_rows, fact_with_keys
from stratalake.sinks.dimension import read_dimension, update_dimension
from stratalake.sources.tables import date_range
from stratalake.sources.workspace import new_folder, written
from stratalake.specs import DIMENSIONS, FACTS, RESOURCES

# --- dimensions ------------------------------------------------------------------------------


def dimension(spark, folder, name: str) -> DataFrame:
    """A dimension as its first load leaves it."""
    spec = DIMENSIONS[name]
    rows = history.open_versions(dimension_rows(cleaned(spark, folder, spec.source), spec), AS_OF)
    return rows.withColumn(spec.surrogate, surrogate_key([spec.key, "valid_from"]))


def dimension_sql(name: str, attributes: str) -> str:
    spec = DIMENSIONS[name]
    return f"""
        SELECT id AS {spec.key}, {attributes}, TIMESTAMP '{AS_OF}' AS valid_from,
          CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current,
          {key_sql('id', f"'{AS_OF}'")} AS {spec.surrogate}
        FROM ({CLEANED_SQL[spec.source]})
    """


# The attributes of each dimension, and below the columns of each fact.
DIMENSION_SQL = {
    "dim_employees": dimension_sql(
        "dim_employees",
        "employee_code, first_name, last_name, full_name, email, phone, job_title, department, status, "
        "is_active, hire_date",
    ),
    "dim_projects": dimension_sql(
        "dim_projects", "project_code, project_name, status, is_active, client_id, client_name"
    ),
    "dim_clients": dimension_sql(
        "dim_clients", "client_code, client_name, industry, status, is_active, city, state, country"
    ),
    "dim_vendors": dimension_sql(
        "dim_vendors", "vendor_code, vendor_name, vendor_type, status, is_active"
    ),
}


@query(DIMENSION_SQL["dim_employees"])
def dim_employees(spark, folder):
    return dimension(spark, folder, "dim_employees")


@query(DIMENSION_SQL["dim_projects"])
def dim_projects(spark, folder):
    return dimension(spark, folder, "dim_projects")


@query(DIMENSION_SQL["dim_clients"])
def dim_clients(spark, folder):
    return dimension(spark, folder, "dim_clients")


@query(DIMENSION_SQL["dim_vendors"])
def dim_vendors(spark, folder):
    return dimension(spark, folder, "dim_vendors")


@query("""
    WITH days AS (
      SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, CAST(d AS DATE) AS date,
      CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
      CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name, CAST(day(d) AS INTEGER) AS day,
      CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
      CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(week(d) AS INTEGER) AS week_of_year,
      dayofweek(d) IN (0, 6) AS is_weekend
    FROM days""")
def dim_date(spark, folder):
    """A calendar from the first to the last order date."""
    return date_rows_covering(table(spark, folder, "orders"), "o_orderdate")


# --- facts -----------------------------------------------------------------------------------


# How the keys of facts with several large dimensions are dealt out, see ``add_dimension_keys``.
SHARES = {"fact_placements": {"dim_projects": 48, "dim_clients": 4}}


def fact(spark, folder, name: str, salts: int = 1, shares: Mapping[str, int] | None = None) -> DataFrame:
    """Keys are looked up as soon as the last versions are known; what follows from a row is added after that."""
    spec = FACTS[name]
    dims = {d: dimension(spark, folder, d) for d in spec.lookups.values()}
    surrogates = {d: (DIMENSIONS[d].surrogate, DIMENSIONS[d].key) for d in dims}
    rows = latest_cleaned(spark, folder, spec.source)
    shares = SHARES.get(name) if shares is None else shares
    rows = fact_with_keys(rows, spec, dims, surrogates, salts=salts, content=F.xxhash64("record_hash"), shares=shares)
    rows = finish_records(rows, RESOURCES[spec.source], AS_OF)
    return fact_rows(rows, spec, found=[surrogate for surrogate, _ in surrogates.values()])


def day_key_sql(c: str) -> str:
    return f"CAST(strftime({c}, '%Y%m%d') AS INTEGER) AS {c}_sk"


def fact_sql(name: str, columns: str, days: list[str], day_keys: list[str]) -> str:
    """Every dimension look-up as a plain left join on the natural key."""
    spec = FACTS[name]
    parts, joins, keys = [f"f AS MATERIALIZED ({CLEANED_SQL[spec.source]})"], [], []
    for fact_key, dim in spec.lookups.items():
        found = DIMENSIONS[dim]
        chosen = f"SELECT {found.key} AS {dim}_key, {found.surrogate} FROM ({DIMENSION_SQL[dim]})"
        parts.append(f"{dim} AS MATERIALIZED ({chosen})")
        joins.append(f"LEFT JOIN {dim} ON f.{fact_key} = {dim}.{dim}_key")
        keys.append(found.surrogate)
    return f"""
        WITH {', '.join(parts)}
        SELECT f.id AS {spec.key}, {key_sql('f.id')} AS {spec.surrogate}, {columns},
          {', '.join(f'CAST({c} AS DATE) AS {c}' for c in days)}, created_at,
          {', '.join(day_key_sql(c) for c in day_keys)}, {', '.join(keys)}
        FROM f {' '.join(joins)}
    """


FACT_SQL = {
    "fact_placements": fact_sql(
        "fact_placements",
        "placement_code, employee_id, project_id, client_id, status, bill_rate, pay_rate, margin, margin_pct, "
        "duration_days",
        ["start_date", "end_date"], ["start_date", "end_date"],
    ),
    "fact_expenses": fact_sql(
        "fact_expenses",
        "expense_code, employee_id, project_id, expense_type, category, status, amount, currency, is_approved, "
        "is_reimbursed",
        ["expense_date"], ["expense_date"],
    ),
    "fact_invoices": fact_sql(
        "fact_invoices",
        "invoice_number, client_id, project_id, status, subtotal, tax, total_amount, currency, is_paid, is_overdue",
        ["invoice_date", "due_date", "payment_date"], ["invoice_date", "due_date"],
    ),
}


@query(FACT_SQL["fact_placements"])
def fact_placements(spark, folder):
    return fact(spark, folder, "fact_placements")


@query(FACT_SQL["fact_expenses"])
def fact_expenses(spark, folder):
    return fact(spark, folder, "fact_expenses")


@query(FACT_SQL["fact_invoices"])
def fact_invoices(spark, folder):
    return fact(spark, folder, "fact_invoices")


@query(FACT_SQL["fact_placements"])
def fact_placements_salted(spark, folder):
    """The same look-ups with every key dealt out over four partitions."""
    return fact(spark, folder, "fact_placements", salts=4, shares={"dim_projects": 24, "dim_clients": 2})


@query(f"""
    SELECT expense_id, expense_sk, amount, expense_date, expense_date_sk FROM ({FACT_SQL['fact_expenses']})
    WHERE expense_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""")
def expenses_in_range(spark, folder):
    """Time-based records between two days, as facts."""
    rows = date_range(cleaned(spark, folder, "expenses"), "expense_date", "2024-01-10", "2024-01-20", 90)
    return fact_rows(rows, FACTS["fact_expenses"]).select(
        "expense_id", "expense_sk", "amount", "expense_date", "expense_date_sk"
    )


# --- history ---------------------------------------------------------------------------------

# Three loads of a customer dimension: what each period's last order says about the customer.
PERIODS = (
    (datetime(1995, 1, 1), datetime(1996, 1, 1)),
    (datetime(1996, 1, 1), datetime(2001, 1, 1)),
    (datetime(2001, 1, 1), datetime(2002, 1, 1)),
)
TRACKED = ["order_status", "priority"]


def snapshot(spark, folder, period: int) -> DataFrame:
    start, end = (F.lit(day).cast("timestamp_ntz") for day in PERIODS[period])
    orders = table(spark, folder, "orders").where((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end))
    last = latest_per_key(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return last.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("priority"),
    )


def history_after(spark, folder, periods: int) -> DataFrame:
    """The history after so many loads; each load starts from a written table, as a run does."""
    state = None
    for period in range(periods):
        previous = None if state is None else written(state, "history")
        incoming = written(snapshot(spark, folder, period), "snapshot")
        state = history.next_history(incoming, previous, ["customer_id"], TRACKED, PERIODS[period][1])
    return state


def history_sql(periods: int) -> str:
    """Versions as the states that differ from the state before; a version ends where the
    next one starts."""
    loaded = " ".join(
        f"WHEN o_orderdate < TIMESTAMP '{end}' THEN TIMESTAMP '{end}'" for _, end in PERIODS
    )
    last = PERIODS[periods - 1][1]
    return f"""
        WITH loads AS (
          SELECT o_custkey AS customer_id, o_orderstatus AS order_status,
            nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority, o_orderdate, o_orderkey,
            CASE {loaded} END AS valid_from FROM orders),
        states AS (
          SELECT * FROM loads WHERE valid_from <= TIMESTAMP '{last}'
          QUALIFY row_number() OVER (
            PARTITION BY customer_id, valid_from ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
        marked AS (
          SELECT *, lag(order_status) OVER w IS DISTINCT FROM order_status
            OR lag(priority) OVER w IS DISTINCT FROM priority
            OR row_number() OVER w = 1 AS moved
          FROM states WINDOW w AS (PARTITION BY customer_id ORDER BY valid_from))
        SELECT customer_id, order_status, priority, valid_from,
          lead(valid_from) OVER w AS valid_to, lead(valid_from) OVER w IS NULL AS is_current
        FROM marked WHERE moved WINDOW w AS (PARTITION BY customer_id ORDER BY valid_from)
    """


@query(history_sql(1))
def scd2_first(spark, folder):
    return history_after(spark, folder, 1)


@query(history_sql(3))
def scd2_history(spark, folder):
    return history_after(spark, folder, 3)


@query(f"""
    SELECT * FROM ({history_sql(3)}) WHERE valid_from = TIMESTAMP '{PERIODS[2][1]}'""")
def scd2_changes(spark, folder):
    """Only the versions that the third load opens."""
    return history.changed_versions(
        snapshot(spark, folder, 2), written(history_after(spark, folder, 2), "history"), ["customer_id"], TRACKED,
        PERIODS[2][1],
    )


@query(f"SELECT * FROM ({history_sql(3)}) WHERE is_current")
def scd2_current(spark, folder):
    return history.current_rows(history_after(spark, folder, 3))


@query(f"""
    WITH before AS (SELECT * FROM ({history_sql(1)})), after AS (SELECT * FROM ({history_sql(2)})),
    incoming AS (
      SELECT DISTINCT o_custkey AS customer_id FROM orders
      WHERE o_orderdate >= TIMESTAMP '{PERIODS[1][0]}' AND o_orderdate < TIMESTAMP '{PERIODS[1][1]}'),
    opened AS (SELECT customer_id FROM after WHERE valid_from = TIMESTAMP '{PERIODS[1][1]}')
    SELECT count(*) FILTER (customer_id NOT IN (SELECT customer_id FROM before)) AS rows_new,
      count(*) FILTER (customer_id IN (SELECT customer_id FROM before)
        AND customer_id IN (SELECT customer_id FROM opened)) AS rows_changed,
      count(*) FILTER (customer_id NOT IN (SELECT customer_id FROM opened)) AS rows_unchanged
    FROM incoming""")
def scd2_counts(spark, folder):
    return history.change_counts(
        snapshot(spark, folder, 1), history_after(spark, folder, 1), ["customer_id"], TRACKED
    )


@query(f"""
    SELECT *, {key_sql('CAST(customer_id AS VARCHAR)', "strftime(valid_from, '%Y-%m-%d %H:%M:%S')")} AS customer_sk
    FROM ({history_sql(3)})""")
def scd2_table(spark, folder):
    """The three loads against a dimension on disk, the last one run twice."""
    root = new_folder(spark, "scd2")
    for period in (0, 1, 2, 2):
        update_dimension(
            snapshot(spark, folder, period), f"{root}/table", "customer_sk", ["customer_id"],
            PERIODS[period][1], TRACKED,
        )
    return read_dimension(spark, f"{root}/table")


@query(f"""
    SELECT o.o_orderkey, o.o_custkey, h.customer_sk
    FROM orders o LEFT JOIN (
      SELECT *, {key_sql('CAST(customer_id AS VARCHAR)', "strftime(valid_from, '%Y-%m-%d %H:%M:%S')")} AS customer_sk
      FROM ({history_sql(3)})) h
    ON o.o_custkey = h.customer_id AND h.valid_from <= o.o_orderdate
      AND (h.valid_to IS NULL OR o.o_orderdate < h.valid_to)""")
def lookup_at_event_time(spark, folder):
    """Orders with the version of the customer that was valid on the order date."""
    versions = history_after(spark, folder, 3).withColumn(
        "customer_sk", surrogate_key(["customer_id", "valid_from"])
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    found = add_dimension_key(
        orders, versions, "customer_sk", "customer_id", "o_custkey", valid_at=F.col("o_orderdate")
    )
    return found.select("o_orderkey", "o_custkey", "customer_sk")
