"""Schema-less JSON records: member maps, merging, nested access. Numbers keep their text.

Spark's JSON readers turn ``1.10`` into ``1.1`` and long numbers into doubles. Records are therefore
parsed with their numbers as marked strings, and the marks are taken off what is written again. All of it
is regular expressions and built-in functions over whole columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.functions.text import as_column

# Characters for private use: a string that is a number in the record, and one that began with a mark itself.
NUMBER_MARK, ESCAPE_MARK = "\ue000", "\ue001"
_MARKS = f"{NUMBER_MARK}{ESCAPE_MARK}"
# An opening quote ahead of a mark, as itself or as an escape; a closing quote has none after it.
_OPENS_WITH_MARK = rf'(?<!\\)"(?=[{_MARKS}]|\\u[eE]00[01])'
# Each match starts where the last one ended and passes over whole strings, so it ends in a number outside of them.
# Only what JSON takes for a number is one, and only where a value may stand: the rest is left for the parser to refuse.
_NUMBER = (
    r'(?s)(\G(?:[^"0-9\-]++|"(?:[^"\\]++|\\.)*+")*+)'
    r"(-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+\-]?[0-9]++)?+)(?=\s*+(?:[,}\]]|\z))"
)
_MARKED_NUMBER = rf'"{NUMBER_MARK}(?<!\\"{NUMBER_MARK})([0-9.eE+\-]++)"'


def marked_json(data: Column | str) -> Column:
    """JSON text whose numbers are strings that begin with a mark, so that a parser leaves them as they are."""
    data = as_column(data)
    has_marks = F.contains(data, F.lit(NUMBER_MARK)) | F.contains(data, F.lit(ESCAPE_MARK)) | F.contains(data, F.lit("\\u"))
    escaped = F.when(has_marks, F.regexp_replace(data, _OPENS_WITH_MARK, f'"{ESCAPE_MARK}')).otherwise(data)
    return F.regexp_replace(escaped, _NUMBER, f'$1"{NUMBER_MARK}$2"')


def unmarked_json(text: Column) -> Column:
    """JSON text with the numbers that ``marked_json`` made strings."""
    numbers = F.regexp_replace(text, _MARKED_NUMBER, "$1")
    return F.regexp_replace(numbers, rf'"{ESCAPE_MARK}(?<!\\"{ESCAPE_MARK})', '"')


def _members(data: Column | str) -> Column:
    return F.try_variant_get(F.try_parse_json(marked_json(data)), "$", "map<string,variant>")


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once a row: a lambda would compute it again for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sorted_json(data: Column | str, exclude: tuple[str, ...] | list[str] = ()) -> Column:
    """The record with the members of every object in key order and without the excluded top-level ones.

    Numbers keep their text. NULL for text that is no JSON object or names a member twice.
    """
    members = _members(data)
    if exclude:
        members = F.map_filter(members, lambda key, _: ~key.isin(*exclude))
    return unmarked_json(F.to_json(members))


def merge_json(base: Column | str, update: Column | str, overwrite: bool = True) -> Column:
    """Members of both records, by key; ``update`` wins where both have a key, or ``base`` when
    ``overwrite`` is off. A member that is present with the value null counts as present, and numbers keep
    their text. A missing or unreadable side leaves the other one unchanged.

    The places of the members of both sides are sorted together by key and the first of each key is kept, so time is in
    proportion to their number, but for the sort. The values are looked up by place and written once, as one record.
    """

    def places(entries: Column, rank: int) -> Column:
        return F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), F.lit(rank).alias("rank"), i.alias("place")))

    def joined(sides: Column) -> Column:
        def chosen(sorted_places: Column) -> Column:
            first = F.filter(sorted_places, lambda m, i: (i == 0) | (F.get(sorted_places, i - 1)["key"] != m["key"]))
            of_base = lambda m: m["rank"] == int(overwrite)
            value = lambda m: F.when(of_base(m), F.get(sides["base"], m["place"])["value"]).otherwise(
                F.get(sides["update"], m["place"])["value"])
            return F.to_json(F.map_from_entries(F.transform(first, lambda m: F.struct(m["key"], value(m)))))

        both = F.concat(places(sides["base"], int(overwrite)), places(sides["update"], int(not overwrite)))
        return _bound(F.sort_array(both), chosen)

    sides = F.struct(F.map_entries(_members(base)).alias("base"), F.map_entries(_members(update)).alias("update"))
    merged = unmarked_json(_bound(sides, joined))  # NULL where a side is
    return F.coalesce(merged, as_column(base), as_column(update))


def nested_get(data: Column | str, path: str, default: str | None = None, separator: str = ".") -> Column:
    """Text found along a path of member names; the default when a step is missing or null."""
    steps = "".join(f"['{name}']" for name in path.split(separator))
    found = F.get_json_object(as_column(data), "$" + steps)
    return found if default is None else F.coalesce(found, F.lit(default))
