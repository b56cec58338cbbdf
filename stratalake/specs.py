"""What each table looks like and which rules it follows, as data."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.functions import derive

Rule = Callable[[Column], Column]
"""Takes ``as_of``, returns a column expression over the cleaned columns."""


@dataclass(frozen=True)
class Derived:
    """A computed column: its type, the columns it needs, and its expression."""

    name: str
    type: str
    needs: tuple[str, ...]
    rule: Rule


@dataclass(frozen=True)
class TableSpec:
    """A cleaned table.

    ``fields`` is the record schema. ``aliases`` lists other names a source may use for a
    column; the first one present wins. ``trim_codes`` and ``trim_email`` relax the rules
    that otherwise take padded values as they are.
    """

    name: str
    fields: str
    text: tuple[str, ...] = ()
    email: tuple[str, ...] = ()
    phone: tuple[str, ...] = ()
    codes: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    derived: tuple[Derived, ...] = ()
    rules: tuple[Derived, ...] = ()
    keys: tuple[str, ...] = ("id",)
    max_lengths: Mapping[str, int] = field(default_factory=dict)
    not_null: tuple[str, ...] = ("id",)
    aliases: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    date_formats: Mapping[str, str] = field(default_factory=dict)
    time_column: str | None = None
    trim_codes: bool = False
    trim_email: bool = False


@dataclass(frozen=True)
class DimensionSpec:
    """A versioned dimension: its source table, keys, and the attributes it tracks."""

    name: str
    source: str
    surrogate: str
    key: str
    attributes: tuple[str, ...]
    max_lengths: Mapping[str, int] = field(default_factory=dict)

    @property
    def not_null(self) -> tuple[str, ...]:
        return (self.surrogate, self.key, "valid_from", "is_current")


@dataclass(frozen=True)
class FactSpec:
    """A fact table: natural key, kept columns, days, and the dimensions it refers to."""

    name: str
    source: str
    surrogate: str
    key: str
    columns: tuple[str, ...]
    days: tuple[str, ...]
    day_keys: tuple[str, ...]
    lookups: Mapping[str, str]
    max_lengths: Mapping[str, int] = field(default_factory=dict)

    @property
    def not_null(self) -> tuple[str, ...]:
        return (self.surrogate, self.key)


def _flag(name: str, accepted: tuple[str, ...]) -> Derived:
    return Derived(name, "boolean", ("status",), lambda as_of: derive.status_in("status", accepted))


# An optional rule: add it to a specification's ``rules`` to switch leavers off.
INACTIVE_ONCE_TERMINATED = Derived(
    "is_active", "boolean", ("is_active", "termination_date"),
    lambda as_of: derive.active_until("is_active", "termination_date", as_of),
)


# --- Fixed values: record schemas, cleaning rules, accepted states and length limits ---------

EMPLOYEES = TableSpec(
    name="employees",
    fields="id string, employee_code string, first_name string, last_name string, email string, "
    "phone string, mobile string, status string, employment_type string, job_title string, "
    "department string, location string, hire_date timestamp, termination_date timestamp, "
    "manager_id string, manager_name string, salary double, currency string, "
    "created_at timestamp, updated_at timestamp",
    text=("employee_code", "first_name", "last_name", "job_title", "department", "location"),
    email=("email",),
    phone=("phone", "mobile"),
    codes=("status", "employment_type"),
    dates=("hire_date", "termination_date", "created_at", "updated_at"),
    derived=(
        Derived("full_name", "string", ("first_name", "last_name"),
                lambda as_of: derive.full_name("first_name", "last_name")),
        _flag("is_active", ("ACTIVE", "EMPLOYED")),
    ),
    rules=(
        Derived("has_email", "boolean", ("email",), lambda as_of: F.col("email").isNotNull()),
        Derived("dates_valid", "boolean", ("hire_date", "termination_date"),
                lambda as_of: derive.dates_in_order("hire_date", "termination_date")),
    ),
    max_lengths={"id": 100, "employee_code": 50, "first_name": 100, "last_name": 100, "full_name": 200,
                 "email": 200, "phone": 50, "job_title": 200, "department": 100, "status": 50},
    aliases={"employee_code": ("employee_number",), "email": ("email_id",), "mobile": ("mobile_phone",),
             "status": ("employee_status",), "hire_date": ("date_of_joining",)},
)

PROJECTS = TableSpec(
    name="projects",
    fields="id string, project_code string, project_name string, description string, status string, "
    "client_id string, client_name string, start_date timestamp, end_date timestamp, budget double, "
    "currency string, project_manager_id string, project_manager_name string, "
    "created_at timestamp, updated_at timestamp",
    text=("project_code", "project_name", "description", "client_name"),
    codes=("status",),
    dates=("start_date", "end_date", "created_at", "updated_at"),
    derived=(_flag("is_active", ("ACTIVE", "IN_PROGRESS")),),
    max_lengths={"id": 100, "project_code": 50, "project_name": 200, "status": 50, "client_id": 100,
                 "client_name": 200, "currency": 10},
)

PLACEMENTS = TableSpec(
    name="placements",
    fields="id string, placement_code string, employee_id string, employee_name string, "
    "project_id string, project_name string, client_id string, client_name string, status string, "
    "start_date timestamp, end_date timestamp, bill_rate double, pay_rate double, currency string, "
    "placement_type string, created_at timestamp, updated_at timestamp",
    text=("placement_code", "employee_name", "project_name", "client_name"),
    codes=("status", "placement_type"),
    dates=("start_date", "end_date", "created_at", "updated_at"),
    derived=(
        Derived("margin", "double", ("bill_rate", "pay_rate"),
                lambda as_of: derive.margin("bill_rate", "pay_rate")),
        Derived("margin_pct", "double", ("bill_rate", "pay_rate"),
                lambda as_of: derive.margin_pct("bill_rate", "pay_rate")),
        Derived("duration_days", "int", ("start_date", "end_date"),
                lambda as_of: derive.duration_days("start_date", "end_date")),
        _flag("is_active", ("ACTIVE", "ONGOING")),
    ),
    max_lengths={"id": 100, "placement_code": 50, "employee_id": 100, "employee_name": 200,
                 "project_id": 100, "project_name": 200, "client_id": 100, "client_name": 200,
                 "status": 50, "currency": 10},
)

CLIENTS = TableSpec(
    name="clients",
    fields="id string, client_code string, client_name string, industry string, status string, "
    "address string, city string, state string, country string, postal_code string, phone string, "
    "email string, website string, account_manager_id string, account_manager_name string, "
    "created_at timestamp, updated_at timestamp",
    text=("client_code", "client_name", "industry", "city", "state", "country"),
    email=("email",),
    phone=("phone",),
    codes=("status",),
    dates=("created_at", "updated_at"),
    derived=(_flag("is_active", ("ACTIVE",)),),
    max_lengths={"id": 100, "client_code": 50, "client_name": 200, "industry": 100, "status": 50,
                 "city": 100, "state": 100, "country": 100, "email": 200, "phone": 50},
)

VENDORS = TableSpec(
    name="vendors",
    fields="id string, vendor_code string, vendor_name string, vendor_type string, status string, "
    "address string, city string, state string, country string, postal_code string, phone string, "
    "email string, contact_person string, tax_id string, created_at timestamp, updated_at timestamp",
    text=("vendor_code", "vendor_name", "contact_person", "city", "state", "country"),
    email=("email",),
    phone=("phone",),
    codes=("status", "vendor_type"),
    dates=("created_at", "updated_at"),
    derived=(_flag("is_active", ("ACTIVE", "APPROVED")),),
    max_lengths={"id": 100, "vendor_code": 50, "vendor_name": 200, "vendor_type": 100, "status": 50,
                 "email": 200, "phone": 50},
)

EXPENSES = TableSpec(
    name="expenses",
    fields="id string, expense_code string, employee_id string, employee_name string, "
    "project_id string, project_name string, expense_type string, category string, "
    "description string, expense_date timestamp, amount double, currency string, status string, "
    "submitted_date timestamp, approved_date timestamp, approver_id string, approver_name string, "
    "created_at timestamp, updated_at timestamp",
    text=("expense_code", "employee_name", "project_name", "description", "category"),
    codes=("status", "expense_type"),
    dates=("expense_date", "submitted_date", "approved_date", "created_at", "updated_at"),
    derived=(
        _flag("is_approved", ("APPROVED", "PAID")),
        _flag("is_reimbursed", ("PAID",)),
    ),
    max_lengths={"id": 100, "expense_code": 50, "employee_id": 100, "employee_name": 200,
                 "project_id": 100, "project_name": 200, "expense_type": 100, "category": 100,
                 "description": 500, "currency": 10, "status": 50},
    time_column="expense_date",
)

INVOICE_OPEN_STATES = ("PENDING", "SENT", "UNPAID")

INVOICES = TableSpec(
    name="invoices",
    fields="id string, invoice_number string, client_id string, client_name string, "
    "project_id string, project_name string, placement_id string, invoice_date timestamp, "
    "due_date timestamp, period_start timestamp, period_end timestamp, subtotal double, tax double, "
    "total_amount double, currency string, status string, payment_date timestamp, "
    "payment_method string, notes string, created_at timestamp, updated_at timestamp",
    text=("invoice_number", "client_name", "project_name", "notes"),
    codes=("status", "payment_method"),
    dates=("invoice_date", "due_date", "period_start", "period_end", "payment_date", "created_at",
           "updated_at"),
    derived=(
        _flag("is_paid", ("PAID", "CLOSED")),
        Derived("is_overdue", "boolean", ("status", "due_date"),
                lambda as_of: derive.overdue("status", "due_date", as_of, INVOICE_OPEN_STATES)),
    ),
    max_lengths={"id": 100, "invoice_number": 100, "client_id": 100, "client_name": 200,
                 "project_id": 100, "project_name": 200, "currency": 10, "status": 50},
    time_column="invoice_date",
)

RESOURCES = {
    spec.name: spec
    for spec in (EMPLOYEES, PROJECTS, PLACEMENTS, CLIENTS, VENDORS, EXPENSES, INVOICES)
}

DIMENSIONS = {
    spec.name: spec
    for spec in (
        DimensionSpec(
            "dim_employees", "employees", "employee_sk", "employee_id",
            ("employee_code", "first_name", "last_name", "full_name", "email", "phone", "job_title",
             "department", "status", "is_active", "hire_date"),
            {"employee_id": 100, "employee_code": 50, "first_name": 100, "last_name": 100,
             "full_name": 200, "email": 200, "phone": 50, "job_title": 200, "department": 100,
             "status": 50},
        ),
        DimensionSpec(
            "dim_projects", "projects", "project_sk", "project_id",
            ("project_code", "project_name", "status", "is_active", "client_id", "client_name"),
            {"project_id": 100, "project_code": 50, "project_name": 200, "status": 50,
             "client_id": 100, "client_name": 200},
        ),
        DimensionSpec(
            "dim_clients", "clients", "client_sk", "client_id",
            ("client_code", "client_name", "industry", "status", "is_active", "city", "state", "country"),
            {"client_id": 100, "client_code": 50, "client_name": 200, "industry": 100, "status": 50,
             "city": 100, "state": 100, "country": 100},
        ),
        DimensionSpec(
            "dim_vendors", "vendors", "vendor_sk", "vendor_id",
            ("vendor_code", "vendor_name", "vendor_type", "status", "is_active"),
            {"vendor_id": 100, "vendor_code": 50, "vendor_name": 200, "vendor_type": 100, "status": 50},
        ),
    )
}

DATE_DIMENSION = "dim_date"
DATE_DIMENSION_RANGE = ("2020-01-01", "2025-12-31")

FACTS = {
    spec.name: spec
    for spec in (
        FactSpec(
            "fact_placements", "placements", "placement_sk", "placement_id",
            ("placement_code", "employee_id", "project_id", "client_id", "status", "bill_rate",
             "pay_rate", "margin", "margin_pct", "duration_days"),
            ("start_date", "end_date"),
            ("start_date", "end_date"),
            {"employee_id": "dim_employees", "project_id": "dim_projects", "client_id": "dim_clients"},
            {"placement_id": 100, "placement_code": 50, "status": 50},
        ),
        FactSpec(
            "fact_expenses", "expenses", "expense_sk", "expense_id",
            ("expense_code", "employee_id", "project_id", "expense_type", "category", "status",
             "amount", "currency", "is_approved", "is_reimbursed"),
            ("expense_date",),
            ("expense_date",),
            {"employee_id": "dim_employees", "project_id": "dim_projects"},
            {"expense_id": 100, "expense_code": 50, "expense_type": 100, "category": 100,
             "status": 50, "currency": 10},
        ),
        FactSpec(
            "fact_invoices", "invoices", "invoice_sk", "invoice_id",
            ("invoice_number", "client_id", "project_id", "status", "subtotal", "tax",
             "total_amount", "currency", "is_paid", "is_overdue"),
            ("invoice_date", "due_date", "payment_date"),
            ("invoice_date", "due_date"),
            {"client_id": "dim_clients", "project_id": "dim_projects"},
            {"invoice_id": 100, "invoice_number": 100, "status": 50, "currency": 10},
        ),
    )
}

# Largest range a time-based extract is asked for, in days.
MAX_EXTRACT_DAYS = 90


def select_resources(names: str | None = None) -> list[TableSpec]:
    """All resources, or those in a comma-separated list (any letter case, in that order)."""
    if names is None:
        return list(RESOURCES.values())
    chosen = [name.strip().lower() for name in names.split(",")]
    unknown = [name for name in chosen if name not in RESOURCES]
    if unknown:
        raise ValueError(f"unknown resource {', '.join(unknown)}; available: {', '.join(RESOURCES)}")
    return [RESOURCES[name] for name in chosen]
