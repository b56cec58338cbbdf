"""Sinks and jobs on tables in a scratch folder."""

import json as pyjson
import pathlib
import random
import time
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from stratalake.operators import dedup
from stratalake.operators.history import next_history
from stratalake.operators.merge import merge_rows
from stratalake.plans import raw as raw_plan
from stratalake.plans.cleaned import last_versions, refresh_cleaned
from stratalake.plans.layout import Layout
from stratalake.plans.metrics import JobMetrics, Status, measured, overall_status, run_summary
from stratalake.plans.raw import load_raw, load_raw_batch
from stratalake.plans.run import run_layers
from stratalake.plans.star import refresh_fact, refresh_star
from stratalake.settings import session_settings
from stratalake.sinks import dimension, key_state, runs, upsert, writer
from stratalake.sources import workspace
from stratalake.sources.tables import look_back
from stratalake.specs import CLIENTS, DIMENSIONS, FACTS, RESOURCES
from stratalake.catalog.feeds import raw_feed

NOW = datetime(2024, 5, 1, 12)
LATER = datetime(2024, 5, 2, 12)


def json_rows(spark, *records, at=NOW):
    df = spark.createDataFrame([(r if isinstance(r, str) else pyjson.dumps(r),) for r in records], "data string")
    return dedup.raw_rows_from_json(df, at)


def test_write_modes(spark, scratch):
    df = spark.range(10).withColumn("p", F.col("id") % 2)
    path = f"{scratch}/t"
    assert writer.write_table(df, path, "overwrite", ["p"]) == 10
    assert writer.write_table(df.limit(0), path, "overwrite", ["p"]) == 0
    assert writer.write_table(df, path, "append", ["p"]) == 10
    assert spark.read.parquet(path).count() == 20
    with pytest.raises(Exception, match="already exists"):
        writer.write_table(df, path, "error")
    with pytest.raises(ValueError):
        writer.write_table(df, path, "merge")
    with pytest.raises(ValueError, match="positive"):
        writer.write_table(df, path, "append", max_rows_per_file=0)
    assert writer.silver_mode(True) == "overwrite"
    assert writer.silver_mode(False) == "merge"
    assert writer.silver_mode(False, merge=False) == "append"
    assert writer.gold_mode(True) == "overwrite" and writer.gold_mode(False) == "append"


def test_rows_per_file(spark, scratch):
    writer.write_table(spark.range(5).coalesce(1), f"{scratch}/t", max_rows_per_file=2)
    sizes = spark.read.parquet(f"{scratch}/t").groupBy("_metadata.file_path").count().collect()
    assert sorted(r["count"] for r in sizes) == [1, 2, 2]


def test_json_run(spark, scratch):
    assert writer.write_json_run(spark.range(0), scratch, "r", NOW) is None
    path = writer.write_json_run(spark.range(3), scratch, "r", NOW)
    assert path.endswith("r_20240501_120000")
    assert spark.read.json(path).count() == 3


def files_of(spark, path):
    return {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}


def test_upsert_writes_the_changed_rows_alone(spark, scratch):
    path = f"{scratch}/t"
    first = spark.range(20_000).selectExpr("cast(id AS int) AS k", "'a' AS v", "id * 2 AS w")
    upsert.upsert_table(first, path, ["k"])
    before = files_of(spark, path)
    change = spark.range(19_900, 20_100).selectExpr("cast(id AS int) AS k", "'b' AS v")
    upsert.upsert_table(change, path, ["k"])
    added = files_of(spark, path) - before
    assert before <= files_of(spark, path) and spark.read.parquet(*added).count() == 200
    table = upsert.read_keyed(spark, path)
    assert table.columns == ["k", "v", "w"] and table.count() == 20_100
    assert table.where("v = 'b'").count() == 200 and table.where("v = 'b' AND w IS NULL").count() == 100
    assert upsert.fold(spark, path, buckets=4) and not upsert.fold(spark, path)
    assert sorted(upsert.read_keyed(spark, path).collect()) == sorted(table.collect())
    assert runs.drop_superseded(spark, path) == 2 and upsert.read_keyed(spark, path).count() == 20_100


def test_upsert_is_that_of_merge_rows(spark, scratch):
    pick, path, table = random.Random(3), f"{scratch}/t", None
    for step in range(7):
        rows = [(pick.choice([None, *range(step, step + 12)]), "x", pick.randrange(99)) for _ in range(6)]
        rows = list({(r[0], r[1]) if r[0] is not None else i: r for i, r in enumerate(rows)}.values())
        source = spark.createDataFrame(rows, "a int, b string, v long")
        source = source if step % 3 else source.withColumn("w", F.col("v") + 1)
        if step == 4:
            upsert.append_keyed(source, path, ["a", "b"])
            table = workspace.written(table.unionByName(source, allowMissingColumns=True), "t")
        else:
            upsert.upsert_table(source, path, ["a", "b"], buckets=2, fold_after=3)
            table = workspace.written(source if table is None else merge_rows(table, source, ["a", "b"]), "t")
        got = [sorted(map(str, x.select("a", "b", "v", "w").collect())) for x in (upsert.read_keyed(spark, path), table)]
        assert got[0] == got[1]
    with pytest.raises(Exception, match="duplicate source key"):
        upsert.upsert_table(spark.createDataFrame([(1, "x", 1)] * 2, "a int, b string, v long"), path, ["a", "b"])
    with pytest.raises(ValueError, match="lacks"):
        upsert.upsert_table(spark.createDataFrame([(1, "x", 1)], "a int, b string, z long"), path, ["a", "b"])
    assert sorted(map(str, upsert.read_keyed(spark, path).select("a", "b", "v", "w").collect())) == got[1]


@pytest.mark.parametrize("earlier", [0, 1, 3])
def test_a_killed_writer_leaves_a_readable_table(spark, scratch, earlier):
    """What a writer leaves when it is killed: a folder with some files and no mark of success."""
    path = f"{scratch}/t"
    frame = lambda *rows: spark.createDataFrame(list(rows), "k int, v string")
    for i in range(earlier):
        upsert.upsert_table(frame((i, "a"), (9, str(i))), path, ["k"])
    before = sorted(map(tuple, upsert.read_keyed(spark, path).collect())) if earlier else None

    broken = frame((1, "b"), (2, "b")).withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("driver lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="driver lost"):
        upsert.upsert_table(broken, path, ["k"])
    runs.write_run(runs.with_row_key(frame((1, "half"), (9, "half")), ["k"]), path, runs.Kind.MERGE)
    last = runs.all_runs(spark, path)[-1]
    pathlib.Path(f"{path}/run={last.name}/_SUCCESS").unlink()
    state = upsert.read_keyed(spark, path)
    assert (None if state is None else sorted(map(tuple, state.collect()))) == before
    upsert.upsert_table(frame((1, "c"), (9, "c")), path, ["k"])
    assert {(1, "c"), (9, "c")} <= set(map(tuple, upsert.read_keyed(spark, path).collect()))
    assert upsert.read_keyed(spark, path).count() == max(2, len(set(range(earlier)) | {1, 9}))
    runs.drop_superseded(spark, path)
    assert all(r.finished for r in runs.all_runs(spark, path))


def test_reading_does_not_shuffle_the_base(spark, scratch):
    path = f"{scratch}/t"
    upsert.rebuild_table(spark.range(5000).withColumn("v", F.lit("a")), path, ["id"], 4)
    upsert.upsert_table(spark.range(10).withColumn("v", F.lit("b")), path, ["id"])
    plan = upsert.read_keyed(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_parquet_tables_cannot_merge_in_place(spark, scratch):
    spark.range(3).selectExpr("id AS k", "'a' AS v").write.option("path", f"{scratch}/m").saveAsTable("merge_target")
    with pytest.raises(PySparkException, match="MERGE INTO"):
        upsert.merge_into_catalog(spark.range(2).selectExpr("id AS k", "'b' AS v"), "merge_target", ["k"])


def test_bucketed_raw_table_is_not_shuffled(spark, scratch):
    batch = dedup.raw_rows(spark.range(1000).withColumn("v", F.col("id") * 2), "id", NOW)
    writer.append_raw_bucketed(batch, "raw_bucketed", f"{scratch}/b", 8)
    loaded = spark.table("raw_bucketed")
    later = dedup.raw_rows(spark.range(900, 1100).withColumn("v", F.col("id") * 2), "id", LATER)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = dedup.already_loaded(later, loaded)
        plan = known._jdf.queryExecution().executedPlan().toString()
        table_side = plan[plan.index("LeftSemi"):].split("raw_bucketed")[0]
        assert "Exchange" not in table_side and known.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_load_raw(spark, scratch):
    layout = Layout(scratch, buckets=4)
    one = load_raw(json_rows(spark, {"id": 1, "v": "a"}, {"v": "a", "id": 1}, {"id": 2}), "x", layout)
    assert (one.status, one.rows_input, one.rows_output) == (Status.SUCCESS, 3, 2)
    two = load_raw(json_rows(spark, {"id": 1, "v": "a"}, {"id": 1, "v": "b"}, at=LATER), "x", layout)
    assert (two.rows_input, two.rows_output) == (2, 1)
    three = load_raw(json_rows(spark, {"id": 1, "v": "b"}, at=LATER), "x", layout)
    assert (three.status, three.rows_output) == (Status.SUCCESS, 0)
    all_in = load_raw(json_rows(spark, {"id": 2}, at=LATER), "x", layout, skip_dedup=True)
    assert all_in.rows_output == 1 and writer.read_raw(spark, layout.raw("x")).count() == 4
    assert load_raw(json_rows(spark, "{}").limit(0), "y", layout).status == Status.NO_DATA


def test_look_back_prunes_load_dates(spark, scratch):
    for at in (datetime(2024, 4, 1), NOW):
        writer.append_raw(json_rows(spark, {"id": 1, "at": str(at)}, at=at), f"{scratch}/r")
    recent = look_back(writer.read_raw(spark, f"{scratch}/r"), NOW, 14)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan
    assert "GreaterThanOrEqual(loaded_at" in plan
    assert recent.count() == 1


def test_batch_stops_at_first_failure(spark, scratch):
    layout = Layout(scratch)
    good = json_rows(spark, {"id": 1})
    bad = good.withColumn("id", F.raise_error(F.lit("broken source")).cast("string"))
    done = load_raw_batch({"a": good, "b": bad, "c": good}, layout)
    assert [m.status for m in done] == [Status.SUCCESS, Status.FAILED]
    assert "broken source" in done[1].errors[0]
    assert len(load_raw_batch({"b": bad, "c": good}, layout, keep_going=True)) == 2


def test_refresh_cleaned(spark, scratch):
    layout = Layout(scratch, buckets=4)
    assert refresh_cleaned(spark, CLIENTS, layout, NOW).status == Status.NO_DATA
    records = (
        {"id": 1, "client_name": " A ", "status": "active"},
        {"id": 2, "client_name": "B", "created_at": "no date"},
        {"client_name": "no id"},
        {"client_name": "no id either"},
        "broken {",
    )
    load_raw(json_rows(spark, *records), "clients", layout)
    load_raw(json_rows(spark, {"id": 1, "client_name": "A2"}, at=LATER), "clients", layout)
    done = refresh_cleaned(spark, CLIENTS, layout, LATER)
    assert (done.status, done.rows_input, done.rows_output, done.errors) == (Status.SUCCESS, 6, 2, [])
    table = upsert.read_keyed(spark, layout.cleaned("clients"))
    assert {r.id: r.client_name for r in table.collect()} == {"1": "A2", "2": "B"}
    rejects = spark.read.parquet(layout.rejects("clients")).collect()
    assert sorted(r.reason for r in rejects) == ["no key", "no key", "no key", "unreadable member"]
    assert all(r.data for r in rejects)

    refresh_cleaned(spark, CLIENTS, layout, LATER)
    assert upsert.read_keyed(spark, layout.cleaned("clients")).count() == 2
    old = refresh_cleaned(spark, CLIENTS, layout, datetime(2025, 1, 1))
    assert old.status == Status.NO_DATA
    refresh_cleaned(spark, CLIENTS, layout, LATER, mode=writer.Mode.APPEND)
    assert upsert.read_keyed(spark, layout.cleaned("clients")).count() == 4
    refresh_cleaned(spark, CLIENTS, layout, LATER, full_rebuild=True)
    assert upsert.read_keyed(spark, layout.cleaned("clients")).count() == 2


def test_dimension_writes_one_row_for_one_change(spark, scratch):
    path = f"{scratch}/d"
    days = [datetime(2024, 5, d) for d in (1, 2, 3, 4)]
    load = lambda rows, at: dimension.update_dimension(spark.createDataFrame(rows, "k int, v string"), path, "sk", ["k"], at)
    assert load([(1, "a"), (2, "a"), (None, "n")], days[0]) == {"rows_new": 3, "rows_changed": 0}
    before = files_of(spark, path)
    assert load([(1, "b"), (2, "a")], days[1]) == {"rows_new": 0, "rows_changed": 1}
    added = files_of(spark, path) - before
    assert spark.read.parquet(*added).count() == 1 and before <= files_of(spark, path)
    before = files_of(spark, path)
    assert load([(1, "c"), (2, "a"), (3, "x")], days[2]) == {"rows_new": 1, "rows_changed": 1}
    assert before <= files_of(spark, path)
    assert load([(1, "c"), (2, "a"), (3, "x")], days[2]) == {"rows_new": 0, "rows_changed": 0}
    got = dimension.read_dimension(spark, path)
    assert got.count() == 6 and got.select("sk").distinct().count() == 6
    assert sorted(r.v for r in got.where("k = 1").collect()) == ["a", "b", "c"]
    assert got.where("is_current").count() == 4
    state = sorted(map(str, got.collect()))
    assert dimension.fold_dimension(spark, path) and not dimension.fold_dimension(spark, path)
    assert sorted(map(str, dimension.read_dimension(spark, path).collect())) == state
    assert runs.drop_superseded(spark, path) > 0
    assert load([(1, "d")], days[3]) == {"rows_new": 0, "rows_changed": 1}
    assert [r.v for r in dimension.read_dimension(spark, path).where("k = 1").orderBy("valid_from").collect()] == ["a", "b", "c", "d"]
    plan = dimension._open_log(spark, path, runs.live_runs(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(closed" in plan  # closed versions of the snapshot are not read


def test_dimension_is_that_of_whole_histories(spark, scratch):
    pick, path, state = random.Random(5), f"{scratch}/d", None
    for day in (1, 2, 2, 3, 5, 6):
        rows = [(k, pick.choice("ab")) for k in range(6) if pick.random() < 0.7] + [(None, "n")] * (day == 3)
        incoming = spark.createDataFrame(rows, "k int, v string")
        dimension.update_dimension(incoming, path, "sk", ["k"], datetime(2024, 5, day), fold_after=2)
        state = workspace.written(next_history(incoming, state, ["k"], ["v"], datetime(2024, 5, day)), "h")
        assert sorted(map(str, dimension.read_dimension(spark, path).drop("sk").collect())) == sorted(map(str, state.collect()))


def test_same_day_changes_keep_earlier_versions(spark, scratch):
    path = f"{scratch}/d"
    for hour, v in ((1, "a"), (2, "b"), (3, "c")):
        rows = spark.createDataFrame([(1, v)], "k int, v string")
        dimension.update_dimension(rows, path, "sk", ["k"], datetime(2024, 5, 1, hour))
    got = dimension.read_dimension(spark, path).orderBy("valid_from").collect()
    assert [(r.v, r.is_current) for r in got] == [("a", False), ("b", False), ("c", True)]


def test_run_layers(spark, folder, scratch):
    layout = Layout(scratch, buckets=4)
    as_of = datetime(2002, 1, 2)
    loaded_at = F.lit(datetime(2002, 1, 1)).cast("timestamp_ntz")
    batches = {name: raw_feed(spark, folder, name).withColumn("loaded_at", loaded_at) for name in RESOURCES}
    done = run_layers(spark, layout, as_of, batches, full_rebuild=True)
    assert [m.errors for m in done if m.errors] == []
    assert overall_status(done) == Status.SUCCESS
    for name in (*DIMENSIONS, "dim_date", *FACTS):
        assert spark.read.parquet(layout.star(name)).count() > 0
    facts = spark.read.parquet(layout.star("fact_invoices"))
    orders = spark.read.parquet(f"{folder}/orders.parquet").count()
    assert facts.count() == orders
    assert facts.where("client_sk is not null and project_sk is not null").count() == orders
    summary = {r.step: r for r in run_summary(spark.read.parquet(layout.metrics)).collect()}
    assert summary["raw"].tables == 7 and summary["cleaned"].succeeded == 7 and summary["star"].tables == 8

    again = run_layers(spark, layout, as_of, batches)
    assert sum(m.rows_output for m in again if m.step == "raw") == 0
    assert spark.read.parquet(layout.star("fact_invoices")).count() == orders
    for name, spec in DIMENSIONS.items():
        table = dimension.read_dimension(spark, layout.star(name))
        assert table.count() == table.select(spec.key).distinct().count()

    before = upsert.read_keyed(spark, layout.star("fact_expenses")).count()
    for mode, rows in ((writer.Mode.MERGE, before), (writer.Mode.APPEND, 2 * before), (writer.Mode.OVERWRITE, before)):
        done = refresh_star(spark, layout, as_of, dimensions=[], facts=["fact_expenses"], fact_mode=mode)
        assert not done[0].errors and done[0].rows_output == before
        assert upsert.read_keyed(spark, layout.star("fact_expenses")).count() == rows


def test_run_stops_after_failed_step(spark, scratch):
    bad = json_rows(spark, {"id": 1}).withColumn("id", F.raise_error(F.lit("no")).cast("string"))
    done = run_layers(spark, Layout(scratch), NOW, {"clients": bad}, resources="clients")
    assert [(m.step, m.status) for m in done] == [("raw", Status.FAILED)]
    done = run_layers(spark, Layout(scratch), NOW, resources="clients", skip=("raw",))
    assert {m.status for m in done if m.step == "cleaned"} == {Status.NO_DATA}


def test_fact_merge(spark, folder, scratch):
    layout = Layout(scratch, buckets=4)
    batches = {name: raw_feed(spark, folder, name) for name in ("expenses", "employees")}
    run_layers(spark, layout, datetime(2002, 1, 2), batches, full_rebuild=True, skip=("star",))
    for _ in range(2):
        done = refresh_star(spark, layout, NOW, ["dim_employees"], ["fact_expenses"], fact_mode=writer.Mode.MERGE)
        assert [m.status for m in done] == [Status.SUCCESS] * 2
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    facts = upsert.read_keyed(spark, layout.star("fact_expenses"))
    assert facts.count() == events and facts.where("project_sk is not null").count() == 0


def test_star_refresh_since(spark, scratch):
    layout = Layout(scratch, buckets=4)
    for at, name in ((NOW, "A"), (LATER, "B")):
        load_raw(json_rows(spark, {"id": 1, "client_name": name}, at=at), "clients", layout)
        load_raw(json_rows(spark, {"id": name, "client_name": "C"}, at=at), "clients", layout)
        refresh_cleaned(spark, CLIENTS, layout, at, lookback_days=1)
        done = refresh_star(spark, layout, at, ["dim_clients"], [], since=at)
        assert [m.status for m in done] == [Status.SUCCESS], done[0].errors
    table = dimension.read_dimension(spark, layout.star("dim_clients"))
    got = sorted((r.client_id, r.client_name, r.is_current) for r in table.collect())
    assert got == [("1", "A", False), ("1", "B", True), ("A", "C", True), ("B", "C", True)]
    with pytest.raises(ValueError):
        refresh_fact(spark, FACTS["fact_invoices"], layout, since=NOW)


def test_measured_and_status():
    def fails(metrics: JobMetrics):
        raise RuntimeError("boom")

    bad = measured("s", "t", fails)
    good = measured("s", "t", lambda m: None)
    assert bad.status == Status.FAILED and "boom" in bad.errors[0] and bad.duration_sec >= 0
    assert overall_status([good]) == Status.SUCCESS
    assert overall_status([good, bad]) == Status.PARTIAL
    assert overall_status([bad]) == Status.FAILED


def test_shared_folder(spark):
    assert workspace.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert workspace.new_folder(spark, "x") != workspace.new_folder(spark, "x")


def test_unknown_batch_is_refused(spark, scratch):
    with pytest.raises(ValueError, match="client$"):
        run_layers(spark, Layout(scratch), NOW, {"client": json_rows(spark, {"id": 1})})


def test_empty_ids_do_not_block_a_table(spark, scratch):
    layout = Layout(scratch, buckets=2)
    done = run_layers(spark, layout, NOW, {"clients": json_rows(spark, {"id": "", "a": 1}, {"id": "", "a": 2}, {"id": "7"})}, resources="clients", skip=("star",))
    assert [m.status for m in done] == [Status.SUCCESS] * 2
    assert upsert.read_keyed(spark, layout.cleaned("clients")).count() == 1
    assert spark.read.parquet(layout.rejects("clients")).count() == 2


def versions(spark, rows):
    return spark.createDataFrame(rows, "id string, name string")


def test_dimension_reruns_keep_one_version_per_start(spark, scratch):
    path = f"{scratch}/d"

    def run(rows, day, **options):
        return dimension.update_dimension(versions(spark, rows), path, "sk", ["id"], day, **options)

    first, second = datetime(2024, 1, 3), datetime(2024, 1, 6)
    run([("a", "x")], first)
    run([("a", "y")], second)
    run([("a", "z")], second)
    rows = sorted(dimension.read_dimension(spark, path).collect(), key=lambda r: r.valid_from)
    assert [(r.name, r.valid_from, r.valid_to, r.is_current) for r in rows] == [("x", first, second, False), ("z", second, None, True)]
    assert len({r.sk for r in rows}) == 2
    with pytest.raises(Exception, match="as_of lies before"):
        run([("a", "q")], datetime(2024, 1, 4))
    with pytest.raises(Exception, match="duplicate source key"):
        run([("b", "1"), ("b", "2")], datetime(2024, 1, 9))
    assert run([], second, rebuild=True) == {"rows_new": 0, "rows_changed": 0}
    assert dimension.read_dimension(spark, path).count() == 2


def test_look_back_ends_where_told(spark):
    rows = spark.createDataFrame([(datetime(2024, 1, d, 12),) for d in (1, 5, 6, 9)], "loaded_at timestamp_ntz")
    as_of = datetime(2024, 1, 6, 12)
    assert look_back(rows, as_of, 2).count() == 3
    assert look_back(rows, as_of, 2, until=as_of).count() == 2
    assert look_back(rows, as_of, 2, until=datetime(2024, 1, 6, 11)).count() == 1


def test_load_cut_off_after_its_append_is_caught_up_with(spark, scratch, monkeypatch):
    layout = Layout(scratch, buckets=2, key_digits=1)
    first = json_rows(spark, *({"id": i} for i in range(20)))
    load_raw(json_rows(spark, {"id": 0}), "x", layout)

    def dies(*args, **kwargs):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(raw_plan, "record", dies)
        assert "driver lost" in load_raw(first, "x", layout).errors[0]
    assert writer.read_raw(spark, layout.raw("x")).count() == 20  # appended, keys not recorded
    again = load_raw(json_rows(spark, *({"id": i} for i in range(25))), "x", layout)
    assert (again.errors, again.rows_output) == ([], 5)
    assert writer.read_raw(spark, layout.raw("x")).count() == 25


@pytest.mark.parametrize("step", ["append_raw", "record", "fresh_rows"])
def test_first_load_cut_off_anywhere_can_be_run_again(spark, scratch, monkeypatch, step):
    layout = Layout(scratch, key_digits=1)
    rows = json_rows(spark, {"id": 1}, {"id": 2}, {"id": 2})
    with monkeypatch.context() as broken:
        broken.setattr(raw_plan, step, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("driver lost")))
        assert load_raw(rows, "x", layout).errors
    assert load_raw(rows, "x", layout).errors == []
    assert sorted(r.id for r in writer.read_raw(spark, layout.raw("x")).collect()) == ["1", "2"]


def test_tables_loaded_without_keys_are_taken_up(spark, scratch):
    layout = Layout(scratch, key_digits=1)
    writer.append_raw(json_rows(spark, {"id": 1}), layout.raw("x"))
    assert load_raw(json_rows(spark, {"id": 1}, {"id": 2}), "x", layout).rows_output == 1


def test_a_load_reads_the_folders_of_its_own_keys(spark, scratch):
    many = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("record_hash"))
    key_state.record(workspace.written(key_state.key_counts(many, ["record_hash"]), "k"), f"{scratch}/k")
    some = workspace.written(key_state.with_buckets(many.limit(3), ["record_hash"]), "b")
    found = key_state.held(some, f"{scratch}/k")
    assert found.count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    folders = {r[0] for r in some.select("key_bucket").collect()}
    assert "PartitionFilters: [key_bucket" in plan and len(folders) <= 3


def test_texts_of_loaded_records_are_not_shuffled(spark, scratch):
    spark.range(20_000).selectExpr("string(id) AS id", "repeat('x', 500) || id AS data", "sha2(string(id), 256) AS record_hash",
        "timestamp_ntz'2024-05-01' AS loaded_at", "id AS row_number").write.parquet(f"{scratch}/batch")
    staged = spark.read.parquet(f"{scratch}/batch")
    spark.range(19_000, 20_000).selectExpr("id AS row_number").write.parquet(f"{scratch}/fresh")
    rows = dedup.rows_numbered(staged, spark.read.parquet(f"{scratch}/fresh"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange") == 1  # the broadcast of the numbers
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", **session_settings(0),
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = dedup.rows_numbered(staged, spark.read.parquet(f"{scratch}/fresh"))
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "bloom_filter_agg" in plan and "might_contain" in plan
        assert rows.count() == 1000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rows_that_break_a_rule_are_counted_and_set_aside(spark, scratch):
    layout = Layout(scratch, buckets=2, key_digits=1)
    long_name = {"id": 1, "client_name": "x" * 201, "client_code": "c" * 51}
    load_raw(json_rows(spark, long_name, {"id": 2, "client_name": "B"}), "clients", layout)
    done = refresh_cleaned(spark, CLIENTS, layout, NOW)
    assert (done.rows_output, done.violations) == (1, {"max_length:client_code": 1, "max_length:client_name": 1})
    rejects = spark.read.parquet(layout.rejects("clients")).collect()
    assert [r.reason for r in rejects] == ["max_length:client_code, max_length:client_name"]
    assert pyjson.loads(rejects[0].data)["client_name"] == "x" * 201 and str(rejects[0].run_date) == "2024-05-01"
    load_raw(json_rows(spark, {"id": 1, "client_name": "A"}, at=datetime(2024, 5, 1, 13)), "clients", layout)
    done = refresh_cleaned(spark, CLIENTS, layout, NOW)
    assert (done.rows_output, done.violations) == (2, {})
    assert spark.read.parquet(layout.rejects("clients")).count() == 0
    assert upsert.read_keyed(spark, layout.cleaned("clients")).dtypes[-1] == ("silver_is_current", "boolean")


def test_appended_facts_report_keys_held_twice(spark, folder, scratch):
    layout = Layout(scratch, buckets=2, key_digits=1)
    run_layers(spark, layout, datetime(2002, 1, 2), {"expenses": raw_feed(spark, folder, "expenses")}, "expenses", full_rebuild=True, skip=("star",))
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    modes = (writer.Mode.OVERWRITE, writer.Mode.APPEND, writer.Mode.MERGE, writer.Mode.OVERWRITE)
    found = [refresh_fact(spark, FACTS["fact_expenses"], layout, mode) for mode in modes]
    assert [m.errors for m in found] == [[]] * 4
    assert [m.violations.get("unique:expense_id", 0) for m in found] == [0, events, 0, 0]
    assert found[0].violations["orphan:employee_id"] == events
    assert upsert.read_keyed(spark, layout.star("fact_expenses")).count() == events


def test_key_state_is_that_of_counts(spark, scratch):
    pick, path, rows = random.Random(4), f"{scratch}/k", []
    for step, kind in enumerate([runs.Kind.APPEND, runs.Kind.APPEND, runs.Kind.MERGE, runs.Kind.APPEND, runs.Kind.APPEND]):
        part = [pick.choice([None, *range(9)]) for _ in range(8)]
        part = list(set(part)) if kind is runs.Kind.MERGE else part
        counts = workspace.written(key_state.key_counts(spark.createDataFrame([(k,) for k in part], "k int"), ["k"], 1), "c")
        rows = [r for r in rows if kind is runs.Kind.APPEND or r not in part] + part
        repeated = key_state.repeated_keys(counts, path) if kind is runs.Kind.APPEND else None
        if repeated is not None:
            want = sorted(rows.count(k) for k in set(part) - {None} if rows.count(k) > 1)
            assert sorted(r.copies for r in repeated.collect()) == want
        key_state.record(counts, path, kind, fold_after=2)


def bytes_moved(spark, work):
    """Rows written to shuffles by what ``work`` runs."""
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
    def total():
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteBytes() for i in range(stages.size())}
    before = total()
    work()
    time.sleep(1)
    return sum(n for stage, n in total().items() if stage not in before)


def test_texts_of_a_new_batch_are_moved_nowhere(spark, scratch):
    layout, spec = Layout(scratch, buckets=2, key_digits=1), RESOURCES["clients"]
    noise = F.concat(*[F.sha2(F.concat("id", F.lit(str(i))), 512) for i in range(16)])  # 2 KB that no codec shortens by much
    data = F.to_json(F.struct(F.col("id").cast("string").alias("id"), noise.alias("address")))
    batch = spark.range(4000).select(F.when(F.col("id") == 3999, 0).otherwise(F.col("id")).alias("id")).select(data.alias("data"))
    raw = dedup.raw_rows_from_json(batch, NOW)
    moved = bytes_moved(spark, lambda: load_raw(raw, "clients", layout))
    assert writer.read_raw(spark, layout.raw("clients")).count() == 3999 and moved < 1_000_000
    later = json_rows(spark, {"id": "5", "client_name": "new"}, {"id": "6", "client_name": "b"}, at=LATER)
    load_raw(later, "clients", layout)
    done = []
    moved = bytes_moved(spark, lambda: done.append(refresh_cleaned(spark, spec, layout, LATER)))
    assert (done[0].rows_input, done[0].rows_output, done[0].errors) == (4001, 3999, []) and moved < 1_000_000
    kept = upsert.read_keyed(spark, layout.cleaned("clients"))
    assert kept.where("client_name = 'new'").select("id", "address").collect() == [("5", None)]


def test_many_versions_are_picked_as_few_are(spark):
    read, again = Observation(), Observation()
    raw = json_rows(spark, {"id": "1"}, {"id": "2"}, {"id": ""}, {"id": "", "city": "x"}).unionByName(
        json_rows(spark, {"id": "1", "city": "y"}, at=LATER))
    found = [
        sorted(last_versions(raw, RESOURCES["clients"], seen, few).select("bronze_id", "city").collect(), key=str)
        for seen, few in ((read, 0), (again, 100))
    ]
    assert found[0] == found[1] and len(found[0]) == 4 and ("1", "y") in found[0]
    assert read.get["rows"] == again.get["rows"] == 5


def test_a_merge_does_not_shuffle_its_rows(spark, scratch):
    rows = spark.range(4000).select("id", F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 512) for i in range(16)]).alias("v"))
    moved = bytes_moved(spark, lambda: upsert.upsert_table(workspace.written(rows, "rows"), f"{scratch}/t", ["id"]))
    assert moved < 1_000_000 and upsert.read_keyed(spark, f"{scratch}/t").count() == 4000
