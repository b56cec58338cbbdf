"""Queries over the given tables, each with the SQL it is checked against."""

from stratalake.catalog import checks, cleaned, columns, jobs, raw, star, tables  # noqa: F401
from stratalake.catalog.registry import QUERIES, SQL  # noqa: F401
