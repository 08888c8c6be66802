import dataclasses

import pytest
from pyspark.sql import functions as F

import samples
from siltstone.plans.chain import run_batch
from siltstone.plans.spec import Field, Flow, GoldSpec, Ingest, Lookup, LookupSource, SilverSpec, SpecError
from siltstone.sources.catalogue import FLOWS
from siltstone.sources import cisco_ios, zeek
from siltstone.streaming.chain import Placement, lane_of, replay_gold, run_stream
from siltstone.plans.ocsf import class_schema
from siltstone.streaming.shared import DAY, Lane, SharedTable, committed_batch, create_class_tables


def stable(df):
    """Rows without run-dependent values."""
    kept = df.drop("dsl_id", "processed_time")
    if "metadata" in df.columns:
        volatile = ("processed_time", "logged_time")
        kept = kept.withColumn("metadata", F.col("metadata").dropFields(*volatile))
    return sorted(r[0] for r in kept.select(F.to_json(F.struct("*"))).collect())


@pytest.fixture
def place(tmp_path, database, spark):
    for layer in ("bronze", "silver", "gold"):
        spark.conf.set(f"siltstone.{layer}.database", database)
    yield Placement(checkpoints=str(tmp_path / "ck"))
    for layer in ("bronze", "silver", "gold"):
        spark.conf.unset(f"siltstone.{layer}.database")


@pytest.mark.parametrize("name", sorted(FLOWS))
def test_stream_gives_the_batch_rows(spark, tmp_path, database, place, name):
    flow = FLOWS[name](samples.write(tmp_path / "in", samples.BY_FLOW[name]))
    expected = run_batch(spark, flow)
    run_stream(spark, flow, place)
    for table, df in expected.gold.items():
        assert stable(SharedTable(spark, f"{database}.{table}").frame()) == stable(df), table


def test_new_files_are_added_once(spark, tmp_path, database, place):
    folder = tmp_path / "in"
    flow = cisco_ios.flow(samples.write(folder, samples.IOS[:4], "a.log"))
    run_stream(spark, flow, place)
    samples.write(folder, samples.IOS[4:], "b.log")
    run_stream(spark, flow, place)
    run_stream(spark, flow, place)
    table = SharedTable(spark, f"{database}.process_activity")
    assert "date=" in spark.table(f"{database}.cisco_ios_silver").inputFiles()[0]
    assert sorted(r[0] for r in table.frame().select("metadata.uid").collect()) == ["000103", "000107", "000108", "000109"]
    assert len(table.batches(lane_of(flow))) == 2


def test_several_inputs_feed_one_table(spark, tmp_path, place, database):
    one = samples.write(tmp_path / "one", samples.ZEEK[:2])
    two = samples.write(tmp_path / "deep" / "two", samples.ZEEK[2:])
    run_stream(spark, zeek.flow(one, two), place, layers=["bronze"])
    assert spark.table(f"{database}.zeek_conn_bronze").count() == len(samples.ZEEK)


def test_two_flows_share_a_class_table(spark, tmp_path, place, database):
    run_stream(spark, zeek.flow(samples.write(tmp_path / "z", samples.ZEEK)), place)
    run_stream(spark, cisco_ios.flow(samples.write(tmp_path / "c", samples.IOS)), place, tables=["network_activity"])
    rows = SharedTable(spark, f"{database}.network_activity").frame()
    counts = {r[0]: r[1] for r in rows.groupBy("metadata.log_provider").count().collect()}
    assert counts == {"zeek": len(samples.ZEEK), "cisco": 2}


def test_a_repeated_batch_replaces_itself(spark, database):
    table = SharedTable(spark, f"{database}.t").create(spark.range(0).schema)
    a, b = Lane("p", "a", "1"), Lane("p", "b", "1")
    for _ in range(2):
        table.write_batch(spark.range(5), a, 0)
        table.write_batch(spark.range(3), b, 0)
        table.write_batch(spark.range(5, 7), a, 1)
    assert table.frame().count() == 10
    table.drop_version(b)
    assert sorted(r[0] for r in table.frame().collect()) == list(range(7))


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_compaction_keeps_every_row(spark, database):
    table = SharedTable(spark, f"{database}.t").create(spark.range(0).schema)
    lane, other = Lane("p", "a", "1"), Lane("p", "a", "2")
    for batch in range(4):
        table.write_batch(spark.range(batch * 10, batch * 10 + 10), lane, batch)
    table.write_batch(spark.range(100, 103), other, 0)
    table.compact(lane, up_to=2)
    assert table.batches(lane) == [-1, 3]
    assert ids(table.frame(True).filter("lane_version = '1'")) == list(range(40))
    # A stream may write its last batch again, and one that was vouched for wrongly too.
    table.write_batch(spark.range(30, 40), lane, 3)
    table.write_batch(spark.range(20, 30), lane, 2)
    assert ids(table.frame()) == [*range(40), 100, 101, 102]
    table.write_batch(spark.range(40, 50), lane, 4)
    table.compact(lane, up_to=4)
    assert table.batches(lane) == [-2, -1]
    assert ids(table.frame()) == [*range(50), 100, 101, 102]
    table.compact(lane, up_to=4)
    assert table.batches(lane) == [-2, -1]


def test_compaction_asks_what_is_committed(spark, database, tmp_path):
    table = SharedTable(spark, f"{database}.t").create(spark.range(0).schema)
    lane = Lane("p", "a", "1")
    for batch in range(4):
        table.write_batch(spark.range(batch * 10, batch * 10 + 10), lane, batch)
    with pytest.raises(SpecError, match="committed"):
        table.compact(lane)
    commits = tmp_path / "ck" / "commits"
    assert committed_batch(spark, str(tmp_path / "ck")) == -1
    commits.mkdir(parents=True)
    for name in ("0", "1", "2", ".2.crc"):
        (commits / name).write_text("v1")
    table.compact(lane, checkpoint=str(tmp_path / "ck"))
    assert table.batches(lane) == [-1, 3]
    table.write_batch(spark.range(30, 40), lane, 3)
    assert ids(table.frame()) == list(range(40))


def test_a_merge_that_fails_changes_nothing_and_is_made_good(spark, database, monkeypatch):
    table = SharedTable(spark, f"{database}.t").create(spark.range(0).schema)
    lane = Lane("p", "a", "1")
    for batch in range(3):
        table.write_batch(spark.range(batch * 10, batch * 10 + 10), lane, batch)
    for step in ("_set", "_clear"):
        calls = []

        def broken(self, *args, step=step, calls=calls, whole=getattr(SharedTable, step)):
            calls.append(args)
            if step == "_set" or len(calls) == 2:
                raise RuntimeError("lost")
            return whole(self, *args)

        with monkeypatch.context() as m:
            m.setattr(SharedTable, step, broken)
            with pytest.raises(RuntimeError, match="lost"):
                table.compact(lane, up_to=2)
        assert ids(table.frame()) == list(range(30)), step
    table.compact(lane, up_to=2)
    assert table.batches(lane) == [-1] and ids(table.frame()) == list(range(30))


def test_a_repeated_batch_leaves_no_day_behind(spark, database):
    table = SharedTable(spark, f"{database}.t").create(spark.range(0).selectExpr("id", "timestamp'2024-01-01' as time").schema)
    lane = Lane("p", "a", "1")
    at = lambda day: f"timestamp'2024-01-0{day}' as time"
    table.write_batch(spark.range(3).selectExpr("id", at(1)).union(spark.range(3, 5).selectExpr("id", at(2))), lane, 0)
    table.write_batch(spark.range(5, 6).selectExpr("id", "cast(null as timestamp) as time"), lane, 1)
    assert ids(table.frame(since="2024-01-02")) == [3, 4] and ids(table.frame(until="2024-01-01", since="2023-01-01")) == [0, 1, 2]
    table.write_batch(spark.range(3).selectExpr("id", at(1)), lane, 0)
    assert ids(table.frame()) == [0, 1, 2, 5]


def test_one_day_reads_one_folder(spark, database):
    schema = spark.range(0).selectExpr("id", "timestamp'2024-01-01' as time").schema
    for grain, pruned in (("day", "2024-03-05"), ("month", "2024-03-01")):
        table = SharedTable(spark, f"{database}.{grain}").create(schema, grain=grain)
        rows = spark.range(200).selectExpr("id", "timestamp'2024-01-01' + make_interval(0, 0, 0, id) as time")
        table.write_batch(rows, Lane("p", "a", "1"), 0)
        day = table.frame(since="2024-03-05", until="2024-03-05")
        text = day._jdf.queryExecution().executedPlan().toString()
        assert f"PartitionFilters: [" in text and f"{DAY}" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
        assert ids(day) == [64] and all(f"{DAY}={pruned}" in name for name in day.inputFiles())


def test_class_tables_made_beforehand_take_a_stream(spark, tmp_path, place, database):
    names = create_class_tables(spark, database)
    assert len(names) == 22
    assert SharedTable(spark, names[0]).frame().schema.names == class_schema(names[0].split("`")[-2]).names
    with pytest.raises(SpecError, match="exist already"):
        create_class_tables(spark, database)
    assert create_class_tables(spark, database, ("dns_activity",), replace=True)
    run_stream(spark, cisco_ios.flow(samples.write(tmp_path / "c", samples.IOS)), place, tables=["process_activity"])
    assert SharedTable(spark, f"{database}.process_activity").frame().count() == 4


def test_a_table_of_another_layout_is_refused(spark, database):
    spark.range(3).write.saveAsTable(f"{database}.plain")
    with pytest.raises(SpecError, match="partitioned by"):
        SharedTable(spark, f"{database}.plain").create(spark.range(0).schema)
    table = SharedTable(spark, f"{database}.t").create(spark.range(0).schema)
    with pytest.raises(SpecError, match="lacks columns"):
        table.create(spark.range(0).selectExpr("id", "1 as more").schema)


def test_a_stream_that_runs_on(spark, tmp_path, place, database):
    """Started, fed while it runs, stopped, fed, started again: every line once."""
    import time

    folder = tmp_path / "in"
    flow = cisco_ios.flow(samples.write(folder, samples.IOS[:4], "a.log"))
    running = dataclasses.replace(place, drain=False, interval="1 second")
    run_stream(spark, flow, place)

    def lines():
        return spark.table(f"{database}.cisco_ios_bronze").count()

    queries = run_stream(spark, flow, running, layers=["bronze"])
    try:
        assert all(q.isActive for q in queries)
        samples.write(folder, samples.IOS[4:7], "b.log")
        until = time.time() + 60
        while time.time() < until and lines() < 7:
            time.sleep(0.5)
    finally:
        for q in queries:
            q.stop()
    assert lines() == 7
    samples.write(folder, samples.IOS[7:], "c.log")
    run_stream(spark, flow, place)
    assert lines() == len(samples.IOS)
    with pytest.raises(SpecError, match="drains"):
        replay_gold(spark, flow, running)


def test_replay_leaves_only_the_new_version(spark, tmp_path, place, database):
    flow = cisco_ios.flow(samples.write(tmp_path / "c", samples.IOS))
    run_stream(spark, flow, place, tables=["process_activity"])
    mapping = flow.gold[3]
    changed = dataclasses.replace(
        mapping, fields=tuple(f if f.name != "status" else Field("status", literal="Mapped anew") for f in mapping.fields)
    )
    new = dataclasses.replace(flow, gold=(changed,), version="2.0")
    for _ in range(2):
        replay_gold(spark, new, place, replaced="1.0")
        table = SharedTable(spark, f"{database}.process_activity")
        rows = table.frame(with_lane=True).select("status", "lane_version").collect()
        assert {tuple(r) for r in rows} == {("Mapped anew", "2.0")}
        assert len(rows) == 4


def test_a_failing_layer_is_raised(spark, tmp_path, place):
    flow = Flow(
        name="broken",
        ingest=Ingest(name="broken_bronze", inputs=(samples.write(tmp_path / "in", ["x"]),), format="text",
                      pre=(("timestamp'2024-01-01' as time", "value"),)),
        silver=(SilverSpec(name="broken_silver", fields=(Field("n", "cast(value as int)"),)),),
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_stream(spark, flow, place, layers=["bronze", "silver"])


def test_right_join_is_refused_on_a_stream(spark, tmp_path, place):
    lookup = Lookup(source=LookupSource(frame=spark.range(1).selectExpr("'a' as k")), on=(("value", "k"),), how="right")
    flow = Flow(
        name="r",
        ingest=Ingest(name="r_bronze", inputs=(samples.write(tmp_path / "in", ["x"]),), format="text",
                      pre=(("timestamp'2024-01-01' as time", "value"),), lookups=(lookup,)),
    )
    with pytest.raises(SpecError, match="stream"):
        run_stream(spark, flow, place, layers=["bronze"])


def test_lookup_and_variant_explode_run_on_a_stream(spark, tmp_path, place, database):
    lines = ['{"t":0,"k":"a","xs":[1,2]}', '{"t":1,"k":"b","xs":[]}']
    names = spark.createDataFrame([("a", "Anna")], "k string, name string")
    flow = Flow(
        name="gen",
        ingest=Ingest(
            name="gen_bronze", inputs=(samples.write(tmp_path / "in", lines),), single_variant=True,
            pre=(("'s' as source", "'t' as sourcetype", "timestamp_seconds(try_variant_get(data, '$.t', 'int')) as time", "data"),),
        ),
        silver=(
            SilverSpec(
                name="gen_silver", preserve=True,
                fields=(Field("k", "try_variant_get(data, '$.k', 'string')"), Field("xs", "try_variant_get(data, '$.xs')")),
            ),
            ),
        gold=(GoldSpec(name="process_activity", input="gen_silver", explode="xs",
                       fields=(Field("time", source="time"), Field("message", "to_json(_exploded)"))),),
    )
    flow = dataclasses.replace(
        flow, silver=(dataclasses.replace(flow.silver[0], lookups=()),),
        ingest=dataclasses.replace(
            flow.ingest,
            pre=(flow.ingest.pre[0] + ("try_variant_get(data, '$.k', 'string') as key",),),
            lookups=(Lookup(source=LookupSource(frame=names), on=(("key", "k"),), select=("name",), broadcast=True),),
        ),
    )
    run_stream(spark, flow, place)
    assert {tuple(r) for r in spark.table(f"{database}.gen_bronze").select("key", "name").collect()} == {("a", "Anna"), ("b", None)}
    rows = SharedTable(spark, f"{database}.process_activity").frame().select("message").collect()
    assert sorted(r[0] or "" for r in rows) == ["", "1", "2"]
