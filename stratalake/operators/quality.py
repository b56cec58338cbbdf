"""Table contracts: shape, uniqueness, references, missing values, lengths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratalake.operators.keys import any_null


def conform(
    df: DataFrame, schema: StructType | str, defaults: Mapping[str, Column] | None = None
) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and with its types.

    A column the frame lacks, and a value that is NULL, take the default if there is one. A
    value that does not fit the type becomes NULL. Names match in any letter case.
    """
    fields = (schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).fields
    defaults = defaults or {}
    present = {c.lower(): c for c in df.columns}
    columns = []
    for field in fields:
        name = present.get(field.name.lower())
        if name is None:
            value = F.lit(None).cast(field.dataType)
        elif df.schema[name].dataType == field.dataType:
            value = F.col(name)
        else:
            value = F.col(name).try_cast(field.dataType)
        if field.name in defaults:
            value = F.coalesce(value, defaults[field.name].cast(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, and how many rows hold them."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def orphan_keys(
    facts: DataFrame, dimension: DataFrame, keys: Sequence[str], dimension_keys: Sequence[str] | None = None
) -> DataFrame:
    """Key values the dimension does not have, and how many rows use them. NULL keys pass.

    Fact rows are counted per key before the join, so a key that many rows share is one row
    in it.
    """
    used = facts.where(~any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    known = dimension.select(
        *[F.col(theirs).alias(ours) for ours, theirs in zip(keys, dimension_keys or keys)]
    )
    return used.join(known, list(keys), "left_anti").select(*keys, "rows")


def contract_tests(
    columns: Sequence[str], not_null: Sequence[str] = (), max_lengths: Mapping[str, int] | None = None
) -> dict[str, Column]:
    """A test per rule, true where a row breaks it, for those columns that are there."""
    tests = {f"not_null:{c}": F.col(c).isNull() for c in not_null if c in columns}
    for c, limit in (max_lengths or {}).items():
        if c in columns:
            tests[f"max_length:{c}"] = F.coalesce(F.length(c) > limit, F.lit(False))
    return tests


def orphan_tests(lookups: Mapping[str, str]) -> dict[str, Column]:
    """A test per reference, given the key column and that of the key it found."""
    return {f"orphan:{key}": F.col(key).isNotNull() & F.col(found).isNull() for key, found in lookups.items()}


def broken_rules(tests: Mapping[str, Column]) -> Column:
    """The names of the rules that a row breaks."""
    return F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(test, F.lit(rule)) for rule, test in tests.items()]))


def rule_counters(tests: Mapping[str, Column]) -> list[Column]:
    """For an Observation: the number of rows that break each rule."""
    return [F.count_if(test).alias(rule) for rule, test in tests.items()]


def violations(observed: Mapping[str, int], tests: Mapping[str, Column]) -> dict[str, int]:
    """The rules that rows were found to break, with their number."""
    return {rule: observed[rule] for rule in tests if observed[rule]}


def column_failures(
    df: DataFrame, not_null: Sequence[str] = (), max_lengths: Mapping[str, int] | None = None
) -> DataFrame:
    """One row per rule with the number of rows that break it, in a single pass."""
    rules = {("not_null", c): F.col(c).isNull() for c in not_null}
    for c, limit in (max_lengths or {}).items():
        rules[("max_length", c)] = F.length(c) > limit
    counts = [F.count_if(test).alias(f"_{i}") for i, test in enumerate(rules.values())]
    report = [
        F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("column_name"), F.col(f"_{i}").alias("failures"))
        for i, (rule, c) in enumerate(rules)
    ]
    return df.agg(*counts).select(F.inline(F.array(*report)))
