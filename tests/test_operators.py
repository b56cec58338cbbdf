"""Edge rows and invariants of the table operators."""

import json as pyjson
import random
import time
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratalake.catalog import star
from stratalake.functions.digest import surrogate_key
from stratalake.operators import dedup, history, quality
from stratalake.operators.cleaning import CORRUPT, clean_opened, clean_records, latest_records, open_records, parse_records
from stratalake.operators.keys import first_per_key, latest_per_key, unique_keyed_rows
from stratalake.operators.lookup import add_dimension_key, add_dimension_keys
from stratalake.operators.merge import merge_rows
from stratalake.operators.modeling import date_rows, fact_with_keys
from stratalake.settings import session_settings
from stratalake.sources import landing, tables
from stratalake.specs import CLIENTS, EMPLOYEES, FACTS, INACTIVE_ONCE_TERMINATED, RESOURCES, TableSpec, select_resources

DAY = [datetime(2024, 1, d) for d in range(1, 10)]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def raw(spark, *texts, loaded_at=DAY[0]):
    data = [(str(i), t, f"h{i}", loaded_at) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "id string, data string, record_hash string, loaded_at timestamp_ntz")


def test_parse_edge_records(spark):
    df = parse_records(
        raw(spark, "not json", '{"ID":"c"}', '{"x":"12.5"}', '{"ts":"2024-01-02"}', '{"ts":"01/02/2024"}', '{"x":1}'),
        "id string, x double, ts timestamp",
    )
    got = {r.bronze_id: r for r in df.collect()}
    assert (got["0"].id, got["0"].x, got["0"][CORRUPT]) == (None, None, "not json")
    assert got["1"].id is None and got["1"][CORRUPT] is None
    assert got["2"].x is None and got["2"][CORRUPT] == '{"x":"12.5"}'
    assert got["3"].ts == datetime(2024, 1, 2)
    assert got["4"].ts is None and got["4"][CORRUPT] is not None
    assert got["5"].x == 1.0 and got["5"][CORRUPT] is None


def test_parse_keeps_text_of_records_without_key(spark):
    df = parse_records(raw(spark, '{"ID":"c"}', '{"id":"c"}'), "id string", keys=["id"])
    assert {r.bronze_id: r[CORRUPT] for r in df.collect()} == {"0": '{"ID":"c"}', "1": None}


def test_clean_records_takes_aliases(spark):
    record = {"id": "1", "employee_number": " E-1 ", "email_id": "A@B.co", "employee_status": "active",
              "date_of_joining": "2024-01-02", "first_name": " Ann "}
    row = clean_records(raw(spark, pyjson.dumps(record)), EMPLOYEES, DAY[0]).first()
    assert (row.employee_code, row.email, row.status) == ("E-1", "a@b.co", "ACTIVE")
    assert (row.is_active, row.full_name, row.has_email, row.dates_valid) == (True, "Ann", True, True)
    assert row.hire_date == datetime(2024, 1, 2)
    assert row.silver_processed_at == DAY[0] and row.silver_is_current


def test_rules_skip_missing_columns(spark):
    spec = TableSpec("small", "id string, status string", text=("nothing",), codes=("status", "other"),
                     derived=RESOURCES["placements"].derived)
    row = clean_records(raw(spark, '{"id":"1","status":"active"}'), spec, DAY[0]).first()
    assert row.status == "ACTIVE" and row.is_active is True
    assert "margin" not in row.asDict()


def test_leavers_can_be_switched_off(spark):
    texts = [pyjson.dumps({"id": str(i), "status": "active", "termination_date": d})
             for i, d in enumerate(["2023-12-31", "2024-01-05", None])]
    spec = replace(EMPLOYEES, rules=(*EMPLOYEES.rules, INACTIVE_ONCE_TERMINATED))
    got = clean_records(raw(spark, *texts), spec, DAY[0]).orderBy("id").collect()
    assert [r.is_active for r in got] == [False, True, True]
    got = clean_records(raw(spark, *texts), EMPLOYEES, DAY[0]).orderBy("id").collect()
    assert [r.is_active for r in got] == [True, True, True]


def test_date_text_with_format(spark):
    spec = TableSpec("small", "id string, day string", dates=("day",), date_formats={"day": "dd.MM.yyyy"})
    got = clean_records(raw(spark, '{"id":"1","day":"02.01.2024"}', '{"id":"2","day":"x"}'), spec, DAY[0])
    assert [r.day for r in got.orderBy("id").collect()] == [datetime(2024, 1, 2), None]


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("a", DAY[0], 1), ("a", DAY[1], 2), ("a", DAY[1], 3), ("b", None, 1), ("b", DAY[0], 0), ("c", None, 5)],
        "k string, at timestamp_ntz, n int",
    )
    assert rows(latest_per_key(df, ["k"], "at", ["n"]).select("k", "n")) == [("a", 3), ("b", 0), ("c", 5)]
    assert rows(first_per_key(df, ["k"], ["at", "n"]).select("k", "n")) == [("a", 1), ("b", 0), ("c", 5)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(100_000).selectExpr("if(id % 3 = 0, -1, id) AS k", "id AS at")
    out = latest_per_key(df, ["k"], "at")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert out.where("k = -1").first().at == 99_999
    assert out.count() == 66_667


def test_unique_keyed_rows(spark):
    good = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "c")], "k int, v string")
    assert rows(unique_keyed_rows(good, ["k"])) == [(1, "a"), (2, "b")]
    bad = good.unionByName(good.where("k = 1"))
    with pytest.raises(PySparkException, match="duplicate source key"):
        unique_keyed_rows(bad, ["k"]).collect()


def test_merge_same_columns(spark):
    schema = "k int, v string"
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], schema)
    source = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N"), (None, "N")], schema)
    merged = merge_rows(target, source, ["k"])
    assert sorted(tuple(r) for r in merged.where("k is not null").collect()) == [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(r.v for r in merged.where("k is null").collect()) == ["N", "N", "n"]


def test_merge_extra_target_columns(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, extra int")
    source = spark.createDataFrame([(2, None, 9), (3, "C", 9)], "k int, v string, _hidden int")
    assert rows(merge_rows(target, source, ["k"]).na.fill("-").na.fill(0)) == [(1, "a", 10), (2, "-", 20), (3, "C", 0)]


def test_merge_refuses(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(PySparkException, match="duplicate source key"):
        merge_rows(target, target.unionByName(target), ["k"]).collect()
    with pytest.raises(ValueError, match="lacks"):
        merge_rows(target, target.withColumn("w", F.lit(1)), ["k"])


def test_merge_is_idempotent(spark):
    target = spark.range(50).selectExpr("cast(id AS int) AS k", "'t' AS v")
    source = spark.range(30, 80).selectExpr("cast(id AS int) AS k", "'s' AS v")
    once = merge_rows(target, source, ["k"])
    assert rows(merge_rows(once, source, ["k"])) == rows(once)


def test_dedup(spark):
    batch = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id int, v string")
    first = dedup.raw_rows(batch, "id", DAY[0])
    loaded = dedup.new_records(first, None)
    assert loaded.count() == 2
    assert dedup.new_records(dedup.raw_rows(batch, "id", DAY[1]), loaded).count() == 0
    changed = dedup.raw_rows(spark.createDataFrame([(1, "z")], "id int, v string"), "id", DAY[1])
    assert rows(dedup.new_records(changed, loaded).select("id")) == [("1",)]
    assert dedup.new_records(first, loaded, skip_dedup=True).count() == 3
    assert tuple(dedup.dedup_report(first, loaded).first()) == (3, 0, 3)
    assert tuple(dedup.dedup_report(changed.limit(0), loaded).first()) == (0, 0, 0)


def test_raw_rows_from_json(spark):
    df = spark.createDataFrame([('{"id":7,"a":1}',), ('{"a":1}',), ('{"id":null}',)], "data string")
    got = dedup.raw_rows_from_json(df, DAY[0]).collect()
    assert [r.id for r in got] == ["7", "", ""]
    assert len({r.record_hash for r in got}) == 3


KEYS, COMPARE = ["k"], ["v", "w"]


def snapshot(spark, *data):
    return spark.createDataFrame(list(data), "k int, v string, w string")


def test_history_steps(spark):
    first = history.next_history(snapshot(spark, (1, "a", None), (2, "b", "x"), (3, "c", None)), None, KEYS, COMPARE, DAY[0])
    assert all(r.is_current and r.valid_to is None and r.valid_from == DAY[0] for r in first.collect())

    # 1: NULL moves from one column to the other; 2 unchanged; 3 missing; 4 new
    second_input = snapshot(spark, (1, None, "a"), (2, "b", "x"), (4, "d", None))
    second = history.next_history(second_input, first, KEYS, COMPARE, DAY[1])
    got = {(r.k, r.valid_from): (r.v, r.w, r.valid_to, r.is_current) for r in second.collect()}
    assert got == {
        (1, DAY[0]): ("a", None, DAY[1], False),
        (1, DAY[1]): (None, "a", None, True),
        (2, DAY[0]): ("b", "x", None, True),
        (3, DAY[0]): ("c", None, None, True),
        (4, DAY[1]): ("d", None, None, True),
    }
    again = history.next_history(second_input, second, KEYS, COMPARE, DAY[2])
    assert sorted(map(str, again.collect())) == sorted(map(str, second.collect()))

    opened = history.changed_versions(second_input, first, KEYS, COMPARE, DAY[1])
    assert sorted(r.k for r in opened.collect()) == [1, 4]
    assert tuple(history.change_counts(second_input, first, KEYS, COMPARE).first()) == (1, 1, 1)


def test_history_invariants(spark):
    state = None
    for step in range(4):
        incoming = spark.range(200).where(f"id % 5 <> {step}").selectExpr(
            "cast(id AS int) AS k", f"cast((id * 7 + {step} * (id % 3)) % 4 AS string) AS v", "'w' AS w"
        )
        state = history.next_history(incoming, state, KEYS, COMPARE, DAY[step])
    versions = {}
    for r in state.collect():
        versions.setdefault(r.k, []).append(r)
    assert len(versions) == 200
    for found in versions.values():
        found.sort(key=lambda r: r.valid_from)
        assert [r.is_current for r in found] == [False] * (len(found) - 1) + [True]
        for a, b in zip(found, found[1:]):
            assert a.valid_to == b.valid_from
        assert found[-1].valid_to is None


def test_history_null_keys_match_nothing(spark):
    first = history.next_history(snapshot(spark, (None, "a", None)), None, KEYS, COMPARE, DAY[0])
    second = history.next_history(snapshot(spark, (None, "a", None)), first, KEYS, COMPARE, DAY[1])
    assert second.count() == 2 and second.where("is_current").count() == 2


def dimension(spark):
    return spark.createDataFrame(
        [("a", "s1", DAY[0], DAY[3], False), ("a", "s2", DAY[3], None, True), ("b", "s3", DAY[0], None, True)],
        "key string, sk string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean",
    )


@pytest.mark.parametrize("salts", [1, 5])
def test_lookup(spark, salts):
    facts = spark.createDataFrame(
        [(1, "a", DAY[1]), (2, "a", DAY[3]), (3, "b", DAY[8]), (4, "z", DAY[1]), (5, None, DAY[1])],
        "n int, key string, at timestamp_ntz",
    )
    got = add_dimension_key(facts, dimension(spark), "sk", "key", salts=salts)
    assert {r.n: r.sk for r in got.collect()} == {1: "s2", 2: "s2", 3: "s3", 4: None, 5: None}
    got = add_dimension_key(facts, dimension(spark), "sk", "key", valid_at=F.col("at"), salts=salts)
    assert {r.n: r.sk for r in got.collect()} == {1: "s1", 2: "s2", 3: "s3", 4: None, 5: None}


def test_lookup_spreads_rows_without_key(spark):
    facts = spark.range(40_000).selectExpr("id AS n", "if(id % 3 = 0, 'a', null) AS key")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = add_dimension_key(facts, dimension(spark), "sk", "key")
        sizes = got.where("key is null").groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 8 and max(r["count"] for r in sizes) < 0.3 * 26_667
        assert got.where("sk = 's2'").count() == 13_334
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.fixture
def shuffled_joins(spark):
    """No broadcast joins, and a threshold small enough for test data to count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_fact_key_is_split(spark, shuffled_joins):
    facts = spark.range(0, 200_000, 1, 8).selectExpr("id AS n", "if(id % 3 = 0, 'a', cast(id AS string)) AS key")
    got = add_dimension_key(facts, dimension(spark), "sk", "key")
    assert "skew=true" in final_plan(got)
    assert got.where("sk = 's2'").count() == 66_667


def hashes(spark, scratch):
    loaded = spark.range(0, 200_000, 1, 8).selectExpr("if(id % 3 = 0, 'hot', sha2(string(id), 256)) AS record_hash")
    loaded.write.parquet(f"{scratch}/loaded")
    batch = spark.range(3000).selectExpr("if(id = 0, 'hot', sha2(string(id), 256)) AS record_hash")
    batch.write.parquet(f"{scratch}/batch")
    return spark.read.parquet(f"{scratch}/loaded"), spark.read.parquet(f"{scratch}/batch")


def test_hot_loaded_hash_is_merged_before_the_shuffle(spark, scratch, shuffled_joins):
    loaded, batch = hashes(spark, scratch)
    known = dedup.already_loaded(batch, loaded)
    shuffled = known._jdf.queryExecution().executedPlan().toString()
    left = shuffled[shuffled.index("LeftSemi"):].splitlines()[1:5]
    kinds = [line.split("[")[0].split("(")[0].strip(" :+-") for line in left]
    assert kinds == ["Sort", "HashAggregate", "Exchange hashpartitioning", "HashAggregate"]
    assert known.count() == 2001  # 1 to 2999 without multiples of 3, and the hot one


def test_loaded_table_is_not_shuffled_for_a_small_batch(spark, scratch):
    loaded, batch = hashes(spark, scratch)
    known = dedup.already_loaded(batch, loaded)
    plan = known._jdf.queryExecution().executedPlan().toString()
    probe = plan[plan.index("BroadcastHashJoin"):].split("FileScan")[0]
    assert "Exchange" not in probe and "Aggregate" not in probe
    assert known.count() == 2001  # 1 to 2999 without multiples of 3, and the hot one


def test_settings_follow_size():
    assert session_settings(1)["spark.sql.shuffle.partitions"] == "200"
    assert session_settings(100 * 2**40)["spark.sql.shuffle.partitions"] == "819200"


def test_quality_reports(spark):
    df = spark.createDataFrame([(1, "ab"), (1, None), (2, "abcdef")], "k int, v string")
    assert rows(quality.duplicate_keys(df, ["k"])) == [(1, 2)]
    report = rows(quality.column_failures(df, ["k", "v"], {"v": 3}))
    assert report == [("max_length", "v", 1), ("not_null", "k", 0), ("not_null", "v", 1)]
    dim = spark.createDataFrame([(2,)], "dk int")
    facts = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert rows(quality.orphan_keys(facts, dim, ["k"], ["dk"])) == [(1, 2)]


def test_conform(spark):
    df = spark.createDataFrame([("1", "x", None)], "B string, a string, flag boolean")
    out = quality.conform(df, "a string, b int, c double, flag boolean", {"flag": F.lit(True)})
    assert out.columns == ["a", "b", "c", "flag"]
    assert tuple(out.first()) == ("x", 1, None, True)
    assert quality.conform(df, "a int").first().a is None


def test_date_rows(spark):
    days = date_rows(spark)
    assert days.count() == 2192
    assert days.select("date_sk").distinct().count() == 2192
    first = days.orderBy("date").first()
    assert (first.date, first.date_sk, first.day_name) == (date(2020, 1, 1), 20200101, "Wednesday")


def test_look_back_bounds(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 17)), (2, datetime(2024, 1, 16, 23, 59, 59))], "n int, loaded_at timestamp_ntz"
    )
    assert rows(tables.look_back(df, datetime(2024, 1, 31, 9), 14).select("n")) == [(1,)]
    for bad in (0, 366):
        with pytest.raises(ValueError):
            tables.look_back(df, DAY[0], bad)


def test_date_range_bounds(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 3, 23, 59)), (3, datetime(2024, 1, 4))],
        "n int, d timestamp_ntz",
    )
    assert rows(tables.date_range(df, "d", "2024-01-01", "2024-01-03").select("n")) == [(1,), (2,)]
    for first, last, limit in (("2024-1-x", "2024-01-03", None), ("2024-02-01", "2024-01-01", None),
                               ("2024-01-01", "2024-06-01", 90)):
        with pytest.raises(ValueError):
            tables.date_range(df, "d", first, last, limit)


def pages(spark, *bodies):
    return spark.createDataFrame([("l", i + 1, b) for i, b in enumerate(bodies)], "l string, page_no int, body string")


def test_flatten_pages(spark):
    page = lambda n, more: pyjson.dumps({"count": 9, "next": more, "results": [{"id": n}, {"id": -n}]})
    full = pages(spark, page(1, "x"), page(2, "x"), page(3, None), page(4, "x"))
    ids = lambda df: [pyjson.loads(r.data)["id"] for r in df.orderBy("page_no").collect()]
    assert ids(landing.flatten_pages(full, ["l"])) == [1, -1, 2, -2, 3, -3]
    assert ids(landing.flatten_pages(full, ["l"], max_pages=1)) == [1, -1]
    gap = pages(spark, page(1, "x"), '{"count":0,"next":"x"}', page(3, None))
    assert ids(landing.flatten_pages(gap, ["l"])) == [1, -1]
    empty = pages(spark, page(1, "x"), '{"next":"x","results":[]}', page(3, None))
    assert ids(landing.flatten_pages(empty, ["l"])) == [1, -1]


def test_envelope_files(spark, scratch):
    records = [{"id": 1, "a": {"b": 2}}, {"id": 2}]
    for name, n in (("small", 1), ("large", 2)):
        with open(f"{scratch}/r_{name}.json", "w") as f:
            pyjson.dump({"resource": "r", "extracted_at": "t", "count": n, "records": records[:n]}, f, indent=2)
    path = landing.largest_source(spark, f"{scratch}/r_*.json")
    assert path.endswith("r_large.json")
    got = landing.read_envelope_files(spark, path).collect()
    assert [pyjson.loads(r.data) for r in got] == records


def test_select_resources():
    assert [s.name for s in select_resources()] == list(RESOURCES)
    assert [s.name for s in select_resources(" Vendors , clients")] == ["vendors", "clients"]
    with pytest.raises(ValueError, match="available: employees"):
        select_resources("vendors,nothing")


def test_filters_reach_the_scan(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    plan = tables.date_range(orders, "o_orderdate", "1997-01-01", "1997-02-01").select("o_orderkey")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def as_of_by_hand(facts, versions):
    out = []
    for n, key, at in facts:
        valid = [v for v in versions if v[1] == key and key is not None and at is not None and v[2] <= at and (v[3] is None or at < v[3])]
        out.append((n, max(valid, key=lambda v: v[2])[0] if valid else None))
    return sorted(out, key=lambda r: r[0])


@pytest.mark.parametrize("slice_days", [None, 7, 400])
def test_key_as_of_by_brute_force(spark, slice_days):
    pick = random.Random(slice_days)
    day = lambda n: datetime(2020, 1, 1) + timedelta(days=n)
    versions = []
    for key in ["a", "b", "c", "hot"]:
        starts = sorted(pick.sample(range(400), 6))
        ends = [*starts[1:], None]
        for i, (s, e) in enumerate(zip(starts, ends)):
            e = e - pick.choice([0, 0, 5]) if e is not None else e  # gaps between some versions
            versions.append((f"{key}{i}", key, day(s), day(e) if e is not None and e > s else (day(s) if e is not None else None)))
    facts = [(n, pick.choice([None, "a", "b", "c", "hot", "hot", "hot", "unknown"]), pick.choice([None, *map(day, range(-20, 450))])) for n in range(600)]
    dim = spark.createDataFrame(versions, "sk string, k string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    df = spark.createDataFrame(facts, "n int, key string, at timestamp_ntz")
    got = add_dimension_key(df, dim, "sk", "k", "key", valid_at=F.col("at"), slice_days=slice_days)
    assert got.columns == ["n", "key", "at", "sk"]
    assert sorted((r.n, r.sk) for r in got.collect()) == as_of_by_hand(facts, versions)


def test_key_as_of_of_many_versions(spark):
    starts = spark.range(10_000).select(F.lit("hot").alias("k"), F.expr("timestamp_ntz'2000-01-01' + id * interval 1 hour").alias("valid_from"))
    dim = starts.select("k", "valid_from", F.expr("valid_from + interval 1 hour").alias("valid_to"), F.col("valid_from").cast("string").alias("sk"))
    facts = spark.range(100_000).select("id", F.lit("hot").alias("k"), F.expr("timestamp_ntz'2000-01-01' + id * interval 6 minute").alias("at"))
    start = time.perf_counter()
    got = add_dimension_key(facts, dim, "sk", "k", valid_at=F.col("at"), slice_days=30)
    right = got.select(F.count_if(F.col("sk") == F.date_trunc("hour", "at").cast("timestamp_ntz").cast("string")).alias("right"), F.count(F.lit(1)).alias("n")).first()
    assert tuple(right) == (100_000, 100_000) and time.perf_counter() - start < 60


def test_a_long_listing_is_spread_over_bins(spark):
    body = '{{"count":1,"next":{n},"results":[{{"id":{i}}}]}}'
    pages = [("long", i, body.format(n="null" if i == 700 else '"/p"', i=i)) for i in range(1, 1500)]
    pages += [("other", 1, body.format(n='"/p"', i=1)), ("other", 2, '{"count":0,"next":"/p","results":[]}'), ("other", 3, body.format(n='"/p"', i=3))]
    pages += [("broken", 1, "no json"), ("open", 5, body.format(n='"/p"', i=5)), ("null", 1, '{"next":"/p","results":[null]}')]
    df = spark.createDataFrame(pages, "l string, page_no int, body string")
    got = landing.flatten_pages(df, ["l"], bin_pages=64).groupBy("l").agg(F.count(F.lit(1)).alias("n"), F.max("page_no").alias("last"))
    assert {(r.l, r.n, r["last"]) for r in got.collect()} == {("long", 700, 700), ("other", 1, 1), ("open", 1, 5), ("null", 1, 1)}
    plan = landing.flatten_pages(df, ["l"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("from_json") < plan.index("Join")  # a tree is printed from its end: the join comes first, the parse after it


def test_texts_of_records_are_not_moved_for_their_last_version(spark):
    texts = [pyjson.dumps({"id": str(i % 500), "client_name": "x" * 50, "address": "y" * 2000}) for i in range(1000)]
    opened = open_records(raw(spark, *texts), CLIENTS)
    last = clean_opened(latest_records(opened), CLIENTS).select("id", "status")
    plan = last._jdf.queryExecution().optimizedPlan().toString()
    moved = next(line for line in plan[plan.index("RepartitionByExpression"):].splitlines()[1:] if "Project" in line)
    assert "data#" not in moved and "address#" not in moved
    below = plan[plan.index("Window") : plan.index("RepartitionByExpression")]
    assert "data#" not in below and "address#" not in below


def test_the_last_version_is_taken_and_records_without_id_are_kept(spark):
    at = [datetime(2024, 1, day) for day in (1, 2, 2, 1, 1, 1)]
    data = [("a", "00aa", at[0]), ("a", "00ff", at[1]), ("a", "0aff", at[2]), ("", "01", at[3]), ("", "02", at[4]), ("", "02", at[5])]
    schema = "id string, record_hash string, loaded_at timestamp_ntz"
    raw_rows = spark.createDataFrame(data, schema).withColumn("data", F.lit("{}"))
    got = latest_records(open_records(raw_rows, CLIENTS)).select("bronze_id", "record_hash")
    assert rows(got) == [("", "01"), ("", "02"), ("a", "0aff")]


def test_surrogates_are_digests_of_the_start_that_was_looked_up(spark):
    spec = FACTS["fact_invoices"]
    facts = spark.createDataFrame([("1", "c1", "p1"), ("2", "c9", None)], "id string, client_id string, project_id string")
    start, version = F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz"), "{k} string, valid_from timestamp_ntz, is_current boolean"
    dims, surrogates = {}, {}
    for name, key in (("dim_clients", "client_id"), ("dim_projects", "project_id")):
        dim = spark.createDataFrame([(key[0] + "1", True)], f"{key} string, is_current boolean").withColumn("valid_from", start)
        surrogates[name] = (name + "_sk", key)
        dims[name] = dim.withColumn(name + "_sk", surrogate_key([key, "valid_from"]))
    found = fact_with_keys(facts, spec, dims, surrogates, salts=3)
    expected = {n: dims[n].first()[n + "_sk"] for n in dims}
    assert rows(found.select("id", "dim_clients_sk", "dim_projects_sk")) == [
        ("1", expected["dim_clients"], expected["dim_projects"]), ("2", None, None)]
    joins = found._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in joins[joins.index("Join"):]  # nothing but starts is moved


@pytest.mark.parametrize("salts", [1, 3])
@pytest.mark.parametrize("shares", [{}, {"a": 4}, {"a": 2, "b": 5}])
def test_look_ups_in_one_move_find_what_one_after_the_other_finds(spark, shares, salts):
    keys = [None, "", "1", "2", "3", "hot", "hot", "hot"]
    rows_in = [(n, keys[n % 8], None if n % 5 == 0 else n % 7) for n in range(400)] + [(1, "1", 1), (1, "1", 1)]
    facts = spark.createDataFrame(rows_in, "n int, a string, b int")
    version = "{0} {1}, start timestamp_ntz, is_current boolean"
    first = [("1", DAY[0], False), ("1", DAY[1], True), ("hot", DAY[2], True), ("2", DAY[3], True), ("2", DAY[4], True),
             ("3", DAY[5], False), (None, DAY[6], True), ("", DAY[7], True)]
    dims = {"a": spark.createDataFrame(first, version.format("k", "string")).withColumnRenamed("start", "a_start"),
            "b": spark.createDataFrame([(n, DAY[n], n != 4) for n in range(6)], version.format("m", "bigint")).withColumnRenamed("start", "b_start")}
    expected = add_dimension_key(add_dimension_key(facts, dims["a"], "a_start", "k", "a"), dims["b"], "b_start", "m", "b")
    looked_up = {"a": (dims["a"], "a_start", "k"), "b": (dims["b"], "b_start", "m")}
    got = add_dimension_keys(facts, looked_up, shares, salts)
    assert sorted(got.columns) == sorted(expected.columns)
    tally = lambda df: sorted(map(repr, df.select(*expected.columns).collect()))
    assert tally(got) == tally(expected)


def test_facts_are_moved_once_for_all_look_ups(spark, shuffled_joins):
    facts = spark.range(5000).selectExpr("id AS n", "if(id % 3 = 0, 'hot', string(id % 50)) AS a", "string(id % 70) AS b")
    dims = {k: spark.range(60).selectExpr(f"string(id) AS k{k}", f"id AS {k}_start", "true AS is_current") for k in ("a", "b")}
    got = add_dimension_keys(facts, {k: (dims[k], f"{k}_start", f"k{k}") for k in dims}, {"a": 2, "b": 8})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 3 and "BroadcastHashJoin" not in plan  # of the facts and of each dimension
    hot = got.where("a = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(hot) == 8  # as many partitions as its dimension has copies


@pytest.mark.parametrize("salts", [1, 4])
def test_keys_of_placements_are_found_in_one_move(spark, folder, shuffled_joins, salts):
    df = star.fact_placements(spark, folder) if salts == 1 else star.fact_placements_salted(spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 3
    assert plan.count("Exchange ") == 8  # two of the facts and two of each dimension: for the last versions, for the look-ups
