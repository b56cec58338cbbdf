"""Runs a registered query on Spark and its SQL on DuckDB and compares every value."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def difference(df, con, sql: str) -> str | None:
    """None when schema and rows agree, else what differs first."""
    ours = sorted(df.columns)
    result = con.execute(sql)
    theirs = {c[0]: str(c[1]) for c in result.description}
    if ours != sorted(theirs):
        return f"columns {sorted(set(ours) ^ set(theirs))}"
    types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    wrong = {c: (types[c], theirs[c]) for c in ours if types[c] != theirs[c]}
    if wrong:
        return f"types {wrong}"
    names = [c[0] for c in result.description]
    order = [names.index(c) for c in ours]
    expected = sorted(tuple(norm(row[i]) for i in order) for row in result.fetchall())
    found = sorted(tuple(norm(v) for v in row) for row in df.select(*ours).collect())
    if len(found) != len(expected):
        return f"{len(found)} rows, expected {len(expected)}"
    for a, b in zip(found, expected):
        if a != b:
            return "row " + str([(c, x, y) for c, x, y in zip(ours, a, b) if x != y][:4])
    return None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from tests.conftest import make_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = make_session()
    con = duck(folder)
    sql = entry.oracle_sql()
    for name, function in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = function(spark, folder)
            if name in sql:
                outcome = difference(df, con, sql[name])
                label = "ok" if outcome is None else f"DIFFERS {outcome}"
            else:
                label = f"rows {df.count()}"
        except Exception as error:
            label = f"ERROR {type(error).__name__} {str(error)[:600]}"
        print(f"{time.time() - start:6.1f}s {name}: {label}", flush=True)
