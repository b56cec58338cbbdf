"""Cleaned tables for all seven resources."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.catalog.feeds import LOADED_AT, feed_sql, raw_feed
from stratalake.catalog.registry import query
from stratalake.operators.cleaning import CORRUPT, clean_opened, finish_records, latest_records, open_records
from stratalake.specs import RESOURCES

AS_OF = datetime(1998, 6, 30)
# The e-mail pattern, and below the columns and accepted states of each table.
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def text(*names: str) -> str:
    return ", ".join(f"nullif(trim({c}), '') AS {c}" for c in names)


def email(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '{EMAIL}') THEN lower(trim({c})) END AS {c}"


def phone(c: str) -> str:
    return f"nullif(regexp_replace({c}, '[^0-9]', '', 'g'), '') AS {c}"


def code(*names: str) -> str:
    return ", ".join(f"upper({c}) AS {c}" for c in names)


def stamp(*names: str) -> str:
    return ", ".join(f"TRY_CAST({c} AS TIMESTAMP) AS {c}" for c in names)


def cleaned_sql(resource: str, columns: str, derived: str) -> str:
    """Latest record per id, cleaned, with derived columns."""
    loaded = "loaded_at" if resource == "placements" else f"TIMESTAMP '{LOADED_AT}'"
    return f"""
        WITH feed AS ({feed_sql(resource)}),
        latest AS (
          SELECT *, {loaded} AS bronze_loaded_at FROM feed
          QUALIFY row_number() OVER (PARTITION BY id ORDER BY bronze_loaded_at DESC) = 1),
        cleaned AS (SELECT id, id AS bronze_id, bronze_loaded_at, {columns} FROM latest)
        SELECT *, {derived}, TIMESTAMP '{AS_OF}' AS silver_processed_at, TRUE AS silver_is_current
        FROM cleaned
    """


CLEANED_SQL = {
    "employees": cleaned_sql(
        "employees",
        ", ".join([
            text("employee_code", "first_name", "last_name"), email("email"), phone("phone"),
            phone("mobile"), code("status", "employment_type"), text("job_title", "department", "location"),
            stamp("hire_date", "termination_date"), "manager_id, manager_name, salary, currency",
            stamp("created_at", "updated_at"),
        ]),
        """coalesce(first_name || ' ' || last_name, first_name, last_name, 'UNKNOWN') AS full_name,
        status IN ('ACTIVE', 'EMPLOYED') AS is_active, email IS NOT NULL AS has_email,
        hire_date IS NULL OR termination_date IS NULL OR hire_date <= termination_date AS dates_valid""",
    ),
    "projects": cleaned_sql(
        "projects",
        ", ".join([
            text("project_code", "project_name", "description"), code("status"), "client_id",
            text("client_name"), stamp("start_date", "end_date"),
            "budget, currency, project_manager_id, project_manager_name", stamp("created_at", "updated_at"),
        ]),
        "status IN ('ACTIVE', 'IN_PROGRESS') AS is_active",
    ),
    "placements": cleaned_sql(
        "placements",
        ", ".join([
            text("placement_code", "employee_name", "project_name", "client_name"),
            "employee_id, project_id, client_id", code("status", "placement_type"),
            stamp("start_date", "end_date"), "bill_rate, pay_rate, currency",
            stamp("created_at", "updated_at"),
        ]),
        """bill_rate - pay_rate AS margin,
        (bill_rate - pay_rate) / nullif(bill_rate, 0) * 100 AS margin_pct,
        CAST(date_diff('day', start_date, end_date) AS INTEGER) AS duration_days,
        status IN ('ACTIVE', 'ONGOING') AS is_active""",
    ),
    "clients": cleaned_sql(
        "clients",
        ", ".join([
            text("client_code", "client_name", "industry", "city", "state", "country"), code("status"),
            "address, postal_code, website, account_manager_id, account_manager_name", phone("phone"),
            email("email"), stamp("created_at", "updated_at"),
        ]),
        "status IN ('ACTIVE') AS is_active",
    ),
    "vendors": cleaned_sql(
        "vendors",
        ", ".join([
            text("vendor_code", "vendor_name", "contact_person", "city", "state", "country"),
            code("status", "vendor_type"), "address, postal_code, tax_id", phone("phone"), email("email"),
            stamp("created_at", "updated_at"),
        ]),
        "status IN ('ACTIVE', 'APPROVED') AS is_active",
    ),
    "expenses": cleaned_sql(
        "expenses",
        ", ".join([
            text("expense_code", "employee_name", "project_name", "description", "category"),
            "employee_id, project_id, amount, currency, approver_id, approver_name",
            code("status", "expense_type"),
            stamp("expense_date", "submitted_date", "approved_date", "created_at", "updated_at"),
        ]),
        "status IN ('APPROVED', 'PAID') AS is_approved, status = 'PAID' AS is_reimbursed",
    ),
    "invoices": cleaned_sql(
        "invoices",
        ", ".join([
            text("invoice_number", "client_name", "project_name", "notes"),
            "client_id, project_id, placement_id, subtotal, tax, total_amount, currency",
            code("status", "payment_method"),
            stamp("invoice_date", "due_date", "period_start", "period_end", "payment_date", "created_at",
                  "updated_at"),
        ]),
        f"""status IN ('PAID', 'CLOSED') AS is_paid,
        status IN ('PENDING', 'SENT', 'UNPAID') AND due_date < TIMESTAMP '{AS_OF}' AS is_overdue""",
    ),
}


def latest_cleaned(spark: SparkSession, folder: str, resource: str) -> DataFrame:
    """The last version of each record, cleaned, before derived columns; digests as bits instead of as text: 128 where they
    tell records without an id apart, 64 where they only order the versions of one record that were loaded together."""
    spec = RESOURCES[resource]
    digits = F.when(F.col("bronze_id") == "", 32).otherwise(16)
    short = F.unhex(F.substring("record_hash", F.lit(1), digits))  # ordered as the whole digest is
    opened = open_records(raw_feed(spark, folder, resource), spec).withColumn("record_hash", short)
    return clean_opened(latest_records(opened), spec)


def cleaned(spark: SparkSession, folder: str, resource: str) -> DataFrame:
    """The cleaned table of a resource, without the columns that exist only to trace a row."""
    rows = latest_cleaned(spark, folder, resource)
    return finish_records(rows, RESOURCES[resource], AS_OF).drop("record_hash", CORRUPT)


@query(CLEANED_SQL["employees"])
def silver_employees(spark, folder):
    return cleaned(spark, folder, "employees")


@query(CLEANED_SQL["projects"])
def silver_projects(spark, folder):
    return cleaned(spark, folder, "projects")


@query(CLEANED_SQL["placements"])
def silver_placements(spark, folder):
    return cleaned(spark, folder, "placements")


@query(CLEANED_SQL["clients"])
def silver_clients(spark, folder):
    return cleaned(spark, folder, "clients")


@query(CLEANED_SQL["vendors"])
def silver_vendors(spark, folder):
    return cleaned(spark, folder, "vendors")


@query(CLEANED_SQL["expenses"])
def silver_expenses(spark, folder):
    return cleaned(spark, folder, "expenses")


@query(CLEANED_SQL["invoices"])
def silver_invoices(spark, folder):
    return cleaned(spark, folder, "invoices")
