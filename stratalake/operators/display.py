"""A readable view of one record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a missing attribute shows, the log-in states, and the attributes shown.
MISSING = "N/A"
LOGIN_STATES = {1: "Active"}
OTHER_LOGIN_STATE = "Inactive"
EMPLOYEE_VIEW = (
    "employee_number", "emp_short_name", "email_id", "mobile_phone", "gender", "marital_status",
    "emp_type", "emptype_category", "employee_status", "date_of_joining", "release_date",
    "resignation_status", "classification", "department", "role", "location", "permanent_state",
    "permanent_country", "workauthorization", "veteran_status", "reporting_manager", "hr_manager",
    "finance_manager", "created", "modified", "_extracted_at",
)
EMPLOYEE_GROUPS = {
    "employee": ("employee",),
    "basic information": ("employee_number", "emp_short_name", "email_id", "mobile_phone", "gender", "marital_status"),
    "employment details": (
        "emp_type", "emptype_category", "employee_status", "date_of_joining", "release_date", "resignation_status",
        "classification", "department", "role",
    ),
    "location and authorization": (
        "location", "permanent_state", "permanent_country", "workauthorization", "veteran_status",
    ),
    "management": ("reporting_manager", "hr_manager", "finance_manager"),
    "system information": ("login_status", "created", "modified", "_extracted_at"),
}
ONLY_WITH_RELEASE_DATE = ("release_date", "resignation_status")


def shown(c: Column | str) -> Column:
    """The value as text, or the mark for a missing one."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(MISSING))


def login_state(c: Column | str) -> Column:
    active = (F.col(c) if isinstance(c, str) else c) == F.lit(1)
    return F.when(active, LOGIN_STATES[1]).otherwise(OTHER_LOGIN_STATE)


def attribute_view(df: DataFrame, attributes: Sequence[str], login: str | None = None) -> DataFrame:
    """The attributes as text; a column the frame lacks shows as missing."""
    columns = [
        (shown(c) if c in df.columns else F.lit(MISSING)).alias(c) for c in attributes
    ]
    return df.select(*columns, *([login_state(login).alias(login)] if login else []))


def employee_view(df: DataFrame, key: str | None = None) -> DataFrame:
    """The employee's attributes. Release details are NULL while there is no release date; ``key`` is kept as ``_key``."""
    first = F.coalesce(F.col("first_name"), F.lit("")) if "first_name" in df.columns else F.lit("")
    last = F.coalesce(F.col("last_name"), F.lit("")) if "last_name" in df.columns else F.lit("")
    named = df.withColumn("employee", F.concat(first, F.lit(" "), last))
    released = (
        F.coalesce(F.col("release_date").cast("string"), F.lit("")) != ""
        if "release_date" in df.columns else F.lit(False)
    )
    if "login_status" not in df.columns:
        named = named.withColumn("login_status", F.lit(None).cast("int"))
    view = named.select(
        *([F.col(key).alias("_key")] if key else []),
        "employee",
        *[
            F.when(released | F.lit(c not in ONLY_WITH_RELEASE_DATE),
                   shown(c) if c in df.columns else F.lit(MISSING)).alias(c)
            for c in EMPLOYEE_VIEW
        ],
        login_state("login_status").alias("login_status"),
    )
    return view


def employee_card(df: DataFrame, key: str) -> DataFrame:
    """The employee view, one row per attribute that is shown: key, group, position in the card, attribute, value.

    Release details have no row while there is no release date.
    """
    named = [(group, c) for group, columns in EMPLOYEE_GROUPS.items() for c in columns]
    view = employee_view(df, key).unpivot("_key", [c for _, c in named], "attribute", "value")
    place = F.create_map(*[F.lit(x) for i, (group, c) in enumerate(named) for x in (c, f"{i:02d} {group}")])
    rows = view.where(F.col("value").isNotNull()).withColumn("_place", place[F.col("attribute")])
    return rows.select(
        F.col("_key").alias(key), F.substring("_place", 4, 100).alias("group"),
        F.substring("_place", 1, 2).cast("int").alias("position"), "attribute", "value",
    )
