"""Cleaning rules for string and timestamp columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted shape of an email address, and what is removed from a phone number.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
NON_DIGITS = r"[^0-9]"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Strip leading and trailing spaces (not tabs or newlines); blank becomes NULL."""
    return F.nullif(F.trim(as_column(c)), F.lit(""))


def clean_email(c: Column | str, trim_first: bool = False) -> Column:
    """Lower-cased address, or NULL when the value is not an address.

    The check runs on the value as it arrives, so padded addresses are refused. Set
    ``trim_first`` to accept them.
    """
    value = F.trim(as_column(c)) if trim_first else as_column(c)
    return F.when(value.rlike(EMAIL_PATTERN), F.lower(F.trim(value)))


def clean_phone(c: Column | str) -> Column:
    """Digits only; NULL when there are none."""
    return F.nullif(F.regexp_replace(as_column(c), NON_DIGITS, ""), F.lit(""))


def upper_code(c: Column | str, trim: bool = False) -> Column:
    """Upper case. Padding is kept unless ``trim`` is set."""
    return F.upper(F.trim(as_column(c)) if trim else as_column(c))


def parse_timestamp(c: Column | str, fmt: str | None = None) -> Column:
    """Timestamp from text; text that does not parse becomes NULL instead of an error."""
    return F.try_to_timestamp(as_column(c), F.lit(fmt)) if fmt else F.try_to_timestamp(as_column(c))
