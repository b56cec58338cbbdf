"""Edge values of the column functions."""

import json as pyjson
import random
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stratalake import catalog
from stratalake.functions import calendar, derive, digest, json, text
from stratalake.operators import display
from stratalake.operators.dedup import add_source_fields, as_timestamp


def values(spark, schema, rows, column):
    """The column evaluated on each row, in order."""
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in df.select("i", column.alias("v")).orderBy("i").select("v").collect()]


def test_clean_text(spark):
    rows = [("  a ",), ("   ",), ("",), (None,), ("\t a \n",)]
    assert values(spark, "c string", rows, text.clean_text("c")) == ["a", None, None, None, "\t a \n"]


def test_clean_email(spark):
    rows = [("A@B.co",), (" a@b.co ",), ("a@b",), (None,)]
    assert values(spark, "c string", rows, text.clean_email("c")) == ["a@b.co", None, None, None]
    trimmed = text.clean_email("c", trim_first=True)
    assert values(spark, "c string", rows, trimmed) == ["a@b.co", "a@b.co", None, None]


def test_clean_phone(spark):
    rows = [("(555) 123-4567",), ("n/a",), (None,)]
    assert values(spark, "c string", rows, text.clean_phone("c")) == ["5551234567", None, None]


def test_upper_code_keeps_padding(spark):
    rows = [(" active",), (None,)]
    assert values(spark, "c string", rows, text.upper_code("c")) == [" ACTIVE", None]
    assert values(spark, "c string", rows, text.upper_code("c", trim=True)) == ["ACTIVE", None]


def test_parse_timestamp(spark):
    rows = [("nope",), ("2024-01-02",), (None,)]
    assert values(spark, "c string", rows, text.parse_timestamp("c")) == [None, datetime(2024, 1, 2), None]
    rows = [("02.01.2024",), ("2024-01-02",)]
    assert values(spark, "c string", rows, text.parse_timestamp("c", "dd.MM.yyyy")) == [datetime(2024, 1, 2), None]


def test_full_name(spark):
    rows = [("A", "B"), ("A", None), (None, "B"), (None, None)]
    got = values(spark, "f string, l string", rows, derive.full_name("f", "l"))
    assert got == ["A B", "A", "B", "UNKNOWN"]


def test_margin(spark):
    rows = [(100.0, 80.0), (0.0, 10.0), (None, 10.0)]
    assert values(spark, "a double, b double", rows, derive.margin("a", "b")) == [20.0, -10.0, None]
    assert values(spark, "a double, b double", rows, derive.margin_pct("a", "b")) == [20.0, None, None]


def test_duration_days(spark):
    rows = [
        (datetime(2024, 3, 9, 23), datetime(2024, 3, 10, 1)),
        (datetime(2024, 3, 9), datetime(2024, 3, 1)),
        (None, datetime(2024, 3, 1)),
    ]
    got = values(spark, "a timestamp_ntz, b timestamp_ntz", rows, derive.duration_days("a", "b"))
    assert got == [1, -8, None]


def test_status_in_is_three_valued(spark):
    rows = [("ACTIVE",), (" ACTIVE",), (None,)]
    got = values(spark, "c string", rows, derive.status_in("c", ["ACTIVE", "EMPLOYED"]))
    assert got == [True, False, None]


def test_overdue(spark):
    now = datetime(2024, 5, 1)
    past = datetime(2024, 4, 1)
    rows = [("SENT", past), ("SENT", now), ("PAID", None), (None, past), ("SENT", None)]
    column = derive.overdue("s", "d", as_timestamp(now), ["PENDING", "SENT", "UNPAID"])
    assert values(spark, "s string, d timestamp_ntz", rows, column) == [True, False, False, None, None]


def test_dates_in_order(spark):
    one, two = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [(None, two), (one, None), (one, two), (two, one), (one, one)]
    got = values(spark, "a timestamp_ntz, b timestamp_ntz", rows, derive.dates_in_order("a", "b"))
    assert got == [True, True, True, False, True]


def test_active_until(spark):
    now, past = datetime(2024, 5, 1), datetime(2024, 4, 1)
    rows = [(True, past), (True, now), (True, None), (None, past), (None, None)]
    column = derive.active_until("f", "e", as_timestamp(now))
    assert values(spark, "f boolean, e timestamp_ntz", rows, column) == [False, True, True, False, None]


def test_calendar(spark):
    days = [(datetime(2024, 3, 10),), (datetime(2021, 1, 1),), (datetime(2024, 3, 9),), (None,)]
    parts = calendar.calendar_columns("d")
    schema = "d timestamp_ntz"
    assert values(spark, schema, days, parts["day_of_week"])[0] == 1
    assert values(spark, schema, days, parts["day_name"])[0] == "Sunday"
    assert values(spark, schema, days, parts["month_name"])[0] == "March"
    assert values(spark, schema, days, parts["is_weekend"]) == [True, False, True, None]
    assert values(spark, schema, days, parts["week_of_year"])[1] == 53
    assert values(spark, schema, days, parts["date_sk"]) == [20240310, 20210101, 20240309, None]


def test_record_hash_json(spark):
    rows = [
        ('{"id":1,"a":{"x":1,"y":[1,2]},"_resource":"r","_extracted_at":"1"}',),
        ('{"a":{"y":[1,2],"x":1},"_extracted_at":"2","_resource":"r","id":1}',),
        ('{"id":1,"a":{"x":1,"y":[1,2]},"_resource":"other"}',),
        ('{"id":"1","a":{"x":1,"y":[1,2]},"_resource":"r"}',),
        ('{"id":1,"a":{"x":1,"y":[2,1]},"_resource":"r"}',),
        ('{"id":1,"a":{"x":1,"y":[1,2]},"_resource":"r","b":null}',),
        ("not json",),
        ('{"a":1,"a":2}',),
        ('{"a":1,"a":3}',),
    ]
    got = values(spark, "c string", rows, digest.record_hash_json("c"))
    assert got[0] == got[1]
    assert len(set(got)) == 8
    assert all(len(h) == 64 for h in got)


def test_surrogate_key_is_unambiguous(spark):
    rows = [(None, "a"), ("a", None), ("a||", "b"), ("a", "||b"), ("", None), (None, ""), (None, None)]
    got = values(spark, "a string, b string", rows, digest.surrogate_key(["a", "b"]))
    assert len(set(got)) == len(rows)


def test_differs_sees_nulls(spark):
    rows = [("a", "a"), (None, "a"), (None, None), ("a", None)]
    column = digest.differs([F.col("a")], [F.col("b")])
    assert values(spark, "a string, b string", rows, column) == [False, True, False, True]


def test_merge_json(spark):
    rows = [
        ('{"a":1,"b":2}', '{"b":null,"c":3}'),
        ('{"a":1}', None),
        (None, '{"c":"x"}'),
        ('{"a":"1"}', '{"a":1}'),
    ]
    schema = "l string, d string"
    got = values(spark, schema, rows, F.to_json(F.parse_json(json.merge_json("l", "d"))))
    assert got == ['{"a":1,"b":null,"c":3}', '{"a":1}', '{"c":"x"}', '{"a":1}']
    kept = values(spark, schema, rows, F.to_json(F.parse_json(json.merge_json("l", "d", overwrite=False))))
    assert kept == ['{"a":1,"b":2,"c":3}', '{"a":1}', '{"c":"x"}', '{"a":"1"}']


def test_nested_get(spark):
    rows = [('{"user":{"address":{"city":"NYC"},"n":null}}',)]
    get = lambda path, default=None: values(spark, "c string", rows, json.nested_get("c", path, default))[0]
    assert get("user.address.city") == "NYC"
    assert get("user.phone", "N/A") == "N/A"
    assert get("user.n", "N/A") == "N/A"
    assert get("user.address.city.deeper", "N/A") == "N/A"
    assert get("user.phone") is None


def test_add_source_fields(spark):
    stamped = add_source_fields("c", "employees", datetime(2024, 1, 1))
    got = values(spark, "c string", [('{"id":1}',)], F.to_json(F.parse_json(stamped)))
    assert got == ['{"_extracted_at":"2024-01-01T00:00:00","_resource":"employees","id":1}']


def test_employee_view(spark):
    rows = [("E1", "Ann", "Lee", 1, None, None), ("E2", None, "Ray", 0, "2024-01-01", "accepted")]
    df = spark.createDataFrame(
        rows, "employee_number string, first_name string, last_name string, login_status int, "
        "release_date string, resignation_status string"
    )
    one, two = display.employee_view(df).orderBy("employee_number").collect()
    assert (one.employee, one.login_status, one.release_date, one.gender) == ("Ann Lee", "Active", None, "N/A")
    assert (two.employee, two.login_status, two.release_date) == (" Ray", "Inactive", "2024-01-01")
    assert two.resignation_status == "accepted"


def test_record_hash_json_unicode_and_escapes(spark):
    rows = [('{"a":"\\u00e9\\n"}',), ('{"a":"é\\n"}',)]
    got = values(spark, "c string", rows, digest.record_hash_json("c"))
    assert got[0] == got[1]


@pytest.mark.parametrize("hot", ["", "   "])
def test_clean_text_of_blank(spark, hot):
    assert values(spark, "c string", [(hot,)], text.clean_text("c")) == [None]


LONG = "12345678901234567890123456789012345678901"


def test_json_numbers_keep_their_text(spark):
    rows = [
        (f'{{"b":1.10,"a":{LONG},"c":[-0.50,1E+2,{{"z":0.1,"y":10}}]}}', '{"d":2.0}'),
        ('{"s":"say 1.10, \\"2.0\\" [3]","t":"\\\\","n":7}', '{"s2":"-1"}'),
        ('{"m":"\ue0001","k":"\ue001x","\ue0002":1,"u":"\\ue0003","v":"\\\\\ue0004","w":"\\"\ue0005"}', '{"e":1}'),
    ]
    got = values(spark, "l string, d string", rows, json.merge_json("l", "d"))
    assert got[0] == f'{{"a":{LONG},"b":1.10,"c":[-0.50,1E+2,{{"y":10,"z":0.1}}],"d":2.0}}'
    assert got[1] == '{"n":7,"s":"say 1.10, \\"2.0\\" [3]","s2":"-1","t":"\\\\"}'
    assert pyjson.loads(got[2]) == {**pyjson.loads(rows[2][0]), "e": 1}


def test_merge_json_is_that_of_dicts(spark):
    pick = random.Random(1)

    def value(depth=0):
        kinds = [None, True, 0, -3, 1.5, "", "x", 'q"1.0', "\\", "1.10", "é\n", "\ue0001", "\ue001"]
        if depth < 2 and pick.random() < 0.3:
            return [value(depth + 1) for _ in range(pick.randrange(3))]
        if depth < 2 and pick.random() < 0.3:
            return {pick.choice("abcde\ue000\ue001"): value(depth + 1) for _ in range(pick.randrange(4))}
        return pick.choice(kinds)

    rows = [tuple({pick.choice(["a", "b", "é", "k 1", '"', "\ue0002", "\\"]): value() for _ in range(pick.randrange(6))} for _ in "ld") for _ in range(300)]
    texts = [tuple(pyjson.dumps(x, ensure_ascii=pick.random() < 0.5, indent=pick.choice([None, 1])) for x in row) for row in rows]
    for overwrite in (True, False):
        got = values(spark, "l string, d string", texts, json.merge_json("l", "d", overwrite))
        assert [pyjson.loads(g) for g in got] == [{**a, **b} if overwrite else {**b, **a} for a, b in rows]
    # the numbers as text: two records are alike exactly if they are as parsed with numbers left as text
    alike = [pyjson.dumps(pyjson.loads(t, parse_int=lambda x: ["n", x], parse_float=lambda x: ["n", x]), sort_keys=True) for t, _ in texts]
    hashes = values(spark, "l string, d string", texts, digest.record_hash_json("l"))
    assert len(set(zip(alike, hashes))) == len(set(alike)) == len(set(hashes))


def test_unreadable_json_stays_unreadable(spark):
    bad = ['{"a":01}', '{1:2}', '{"a":1 2}', '{"a":1.}', '{"a":+1}', '{"a":-}', '{"a":1', '{"a":"x}', '[1,2]', '{"a":1x}', '{"a":"1" 1}', "1", ""]
    assert values(spark, "c string", [(b,) for b in bad], digest.canonical_json("c")) == [None] * len(bad)
    assert values(spark, "c string", [(b,) for b in bad], json.merge_json("c", F.lit('{"k":1}'))) == bad


def test_records_that_differ_in_a_late_digit_are_told_apart(spark):
    other = LONG[:-1] + "2"
    rows = [(f'{{"a":{x}}}',) for x in (LONG, other, "1.10", "1.1", "1", "1.0")]
    assert len(set(values(spark, "c string", rows, digest.record_hash_json("c")))) == 6


def test_merge_json_grows_with_the_members(spark):
    def seconds(members):
        side = F.concat(F.lit("{"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(members)), lambda i: F.concat(F.lit('"k'), i, F.lit('":'), i)), ","), F.lit("}"))
        n = 160_000 // members
        df = spark.range(0, n, 1, 4).select(side.alias("l"), F.replace(side, F.lit("k"), F.lit("j")).alias("d"))
        df = df.select(json.merge_json("l", "d").alias("m"))
        times = []
        for _ in range(3):
            start = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        return min(times)

    assert seconds(1600) < 4 * seconds(80) + 1  # the same number of members in all


def test_costly_rows_of_a_small_file_are_dealt_over_all_tasks(spark, folder):
    for name in ("list_detail_merge_wide", "record_hash_json"):
        rows = catalog.QUERIES[name](spark, folder)
        used = rows.select(F.spark_partition_id().alias("task")).distinct().count()
        assert used == int(spark.conf.get("spark.sql.shuffle.partitions"))
