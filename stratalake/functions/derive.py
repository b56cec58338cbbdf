"""Derived measures and three-valued status flags.

``as_of`` is always passed in: an operator never looks at the wall clock, so a run can be
repeated and gives the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.functions.text import as_column

# Fixed value: stands in for a person with neither first nor last name.
UNKNOWN_NAME = "UNKNOWN"


def full_name(first: Column | str, last: Column | str) -> Column:
    """``first last``; whichever one is present; else the placeholder."""
    first, last = as_column(first), as_column(last)
    return F.coalesce(F.concat(first, F.lit(" "), last), first, last, F.lit(UNKNOWN_NAME))


def margin(income: Column | str, cost: Column | str) -> Column:
    return as_column(income) - as_column(cost)


def margin_pct(income: Column | str, cost: Column | str) -> Column:
    """Margin as a percentage of income; NULL when income is zero."""
    return F.try_divide(margin(income, cost), as_column(income)) * 100


def duration_days(start: Column | str, end: Column | str) -> Column:
    """Calendar days from start to end. Time of day is ignored; may be negative."""
    return F.datediff(as_column(end), as_column(start))


def status_in(status: Column | str, accepted: Iterable[str]) -> Column:
    """True or false by membership; NULL for a NULL status."""
    return as_column(status).isin(*accepted)


def overdue(status: Column | str, due: Column | str, as_of: Column, open_states: Iterable[str]) -> Column:
    """Still open and due strictly before ``as_of``."""
    return status_in(status, open_states) & (as_column(due) < as_of)


def dates_in_order(start: Column | str, end: Column | str) -> Column:
    """False only when both ends are known and the start is later than the end."""
    return F.coalesce(as_column(start) <= as_column(end), F.lit(True))


def active_until(flag: Column | str, end: Column | str, as_of: Column) -> Column:
    """The flag, forced to false once the end lies before ``as_of``."""
    return F.when(as_column(end) < as_of, F.lit(False)).otherwise(as_column(flag))
