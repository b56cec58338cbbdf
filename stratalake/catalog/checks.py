"""Table contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.catalog.cleaned import cleaned
from stratalake.catalog.columns import key_sql
from stratalake.catalog.registry import query, table
from stratalake.catalog.star import fact, dimension, FACT_SQL, DIMENSION_SQL
from stratalake.operators import quality
from stratalake.sinks import key_state
from stratalake.sources.workspace import new_folder, written
from stratalake.specs import DIMENSIONS, FACTS


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def pk_check(spark, folder):
    return quality.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    SELECT l_partkey, count(*) AS rows FROM lineitem
    WHERE l_partkey NOT IN (SELECT c_custkey FROM customer) GROUP BY l_partkey""")
def fk_check(spark, folder):
    """Part numbers used as customer numbers: those past the last customer are orphans."""
    return quality.orphan_keys(
        table(spark, folder, "lineitem"), table(spark, folder, "customer"), ["l_partkey"], ["c_custkey"]
    )


@query(f"""
    WITH f AS ({FACT_SQL['fact_placements']})
    SELECT 'not_null' AS rule, unnest(['placement_sk', 'placement_id', 'client_sk', 'pay_rate']) AS column_name,
      unnest([count(*) FILTER (placement_sk IS NULL), count(*) FILTER (placement_id IS NULL),
        count(*) FILTER (client_sk IS NULL), count(*) FILTER (pay_rate IS NULL)]) AS failures FROM f""")
def null_check(spark, folder):
    columns = [*FACTS["fact_placements"].not_null, "client_sk", "pay_rate"]
    return quality.column_failures(fact(spark, folder, "fact_placements"), columns)


@query("""
    SELECT 'max_length' AS rule, unnest(['text', 'lang', 'source']) AS column_name,
      unnest([count(*) FILTER (length(text) > 500), count(*) FILTER (length(lang) > 10),
        count(*) FILTER (length(source) > 4)]) AS failures FROM documents""")
def length_check(spark, folder):
    return quality.column_failures(
        table(spark, folder, "documents"), max_lengths={"text": 500, "lang": 10, "source": 4}
    )


@query(f"""
    WITH d AS ({DIMENSION_SQL['dim_clients']})
    SELECT 'not_null' AS rule, unnest(['client_sk', 'client_id', 'valid_from', 'is_current']) AS column_name,
      CAST(0 AS BIGINT) AS failures
    UNION ALL
    SELECT 'max_length', unnest(['client_id', 'client_code', 'client_name', 'industry', 'status', 'city', 'state',
      'country']), unnest([count(*) FILTER (length(client_id) > 100), count(*) FILTER (length(client_code) > 50),
      count(*) FILTER (length(client_name) > 200), count(*) FILTER (length(industry) > 100),
      count(*) FILTER (length(status) > 50), count(*) FILTER (length(city) > 100),
      count(*) FILTER (length(state) > 100), count(*) FILTER (length(country) > 100)]) FROM d""")
def dimension_contract(spark, folder):
    """Every declared rule of a dimension in one pass."""
    spec = DIMENSIONS["dim_clients"]
    return quality.column_failures(dimension(spark, folder, spec.name), spec.not_null, spec.max_lengths)


@query(f"""
    SELECT start_date_sk, count(*) AS rows FROM ({FACT_SQL['fact_placements']})
    WHERE start_date_sk NOT IN (SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) FROM orders)
    GROUP BY start_date_sk""")
def fk_check_fact_dates(spark, folder):
    """Fact days that the order calendar's own days do not cover."""
    days = table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date_sk")
    )
    return quality.orphan_keys(fact(spark, folder, "fact_placements"), days, ["start_date_sk"], ["date_sk"])


@query("""
    SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity,
      TRY_CAST(l_returnflag AS DOUBLE) AS l_returnflag, CAST(NULL AS VARCHAR) AS note,
      TRUE AS is_current, CAST(l_shipdate AS DATE) AS l_shipdate
    FROM lineitem""")
def conform_schema(spark, folder):
    """Order, names, types and defaults of a declared schema; what does not fit is NULL."""
    schema = (
        "l_orderkey bigint, l_linenumber string, l_quantity int, l_returnflag double, note string, "
        "is_current boolean, l_shipdate date"
    )
    lines = table(spark, folder, "lineitem").withColumnRenamed("l_shipdate", "L_SHIPDATE")
    return quality.conform(lines, schema, {"is_current": F.lit(True)})


@query("""
    SELECT client_id, industry, count(*) AS copies FROM (
      SELECT nullif(c_mktsegment, 'MACHINERY') AS industry, c_nationkey AS client_id FROM customer)
    GROUP BY ALL HAVING count(*) > 1""")
def pk_check_clean(spark, folder):
    """A key of cleaned columns that is none; missing values are alike."""
    rows = cleaned(spark, folder, "clients").select(F.col("account_manager_id").cast("int").alias("client_id"), "industry")
    return quality.duplicate_keys(rows, ["client_id", "industry"])


@query(f"""
    SELECT {key_sql('CAST(l_orderkey AS VARCHAR)', 'CAST(l_linenumber AS VARCHAR)')} AS line_key, count(*) AS copies
    FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def pk_check_appends(spark, folder):
    """Lines appended in three parts; each part is compared with the keys on record in the folders its own fall into."""
    state, keys, found = new_folder(spark, "line-keys"), ["l_orderkey", "l_linenumber"], []
    for flag in ("A", "N", "R"):
        part = table(spark, folder, "lineitem").where(F.col("l_returnflag") == flag)
        counts = written(key_state.key_counts(part, keys, digits=1), "line-counts")
        found.append(written(key_state.repeated_keys(counts, state), "repeated"))
        key_state.record(counts, state)
    every = found[0].unionByName(found[1]).unionByName(found[2])
    last = every.groupBy("row_key").agg(F.max("copies").alias("copies"))
    return last.select(F.lower(F.hex("row_key")).alias("line_key"), "copies")
