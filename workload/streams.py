"""Streaming runs: files to class tables, shared tables, replay and compaction."""

from __future__ import annotations

import dataclasses
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from siltstone.functions import normalize as n
from siltstone.plans.session import at_end, fresh_dir
from siltstone.plans.spec import Field, Flow, GoldSpec, Ingest, SilverSpec, fields
from siltstone.streaming.chain import LAYERS, Placement, replay_gold, run_stream
from siltstone.streaming.shared import Lane, SharedTable, create_class_tables
from workload.base import flat, iso, query, table
from workload.layers import ACTIVITY_SQL, events_flow


@contextmanager
def own_database(spark: SparkSession, grain: str = "day"):
    """A database and checkpoint folder of this run alone, in the shared folder."""
    name = f"run_{uuid.uuid4().hex[:12]}"
    root = fresh_dir(spark, "stream")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{root}/tables'")
    at_end(lambda: spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE"))
    settings = [f"siltstone.{layer}.database" for layer in LAYERS]
    for setting in settings:
        spark.conf.set(setting, name)
    try:
        yield name, Placement(checkpoints=f"{root}/checkpoints", grain=grain)
    finally:
        for setting in settings:
            spark.conf.unset(setting)


def _stream_path(sf: str, name: str) -> str:
    """A file stream takes a folder or a pattern; the table may be one file or a folder."""
    return f"{sf}/[{name[0]}]{name[1:]}.parquet"


def _events(sf: str) -> Flow:
    flow = events_flow()
    return dataclasses.replace(flow, ingest=dataclasses.replace(flow.ingest, inputs=(_stream_path(sf, "events"),)))


def _orders(sf: str) -> Flow:
    spec = GoldSpec(
        name="api_activity",
        input="orders_silver",
        fields=fields(
            {
                "time": F.col("time"),
                **n.class_columns("api_activity"),
                "api.operation": F.col("value"),
                **n.metadata("orders", "Acme", "acme", "orders", "parquet", uid=F.col("order_id")),
            }
        ),
    )
    return Flow(
        name="orders",
        provider="acme",
        log_name="orders",
        ingest=Ingest(
            name="orders_bronze",
            inputs=(_stream_path(sf, "orders"),),
            format="parquet",
            pre=(
                (
                    "'acme' as source", "'orders' as sourcetype", "cast(o_orderdate as timestamp) as time",
                    "o_orderstatus as value", "cast(o_orderkey as string) as order_id",
                ),
            ),
        ),
        silver=(SilverSpec(name="orders_silver", preserve=True),),
        gold=(spec,),
    )


@query(
    "stream_chain",
    f"""
    SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, {ACTIVITY_SQL}, CAST(event_id AS VARCHAR) AS metadata_uid,
           event_type AS api_operation, CAST(user_id AS VARCHAR) AS actor_user_uid
    FROM events""",
)
def stream_chain(spark, sf):
    with own_database(spark) as (database, place):
        run_stream(spark, _events(sf), place)
    rows = SharedTable(spark, f"{database}.api_activity").frame()
    return flat(
        rows, "activity_id activity_name type_uid severity status_id metadata.uid api.operation actor.user.uid",
        time=iso("time"),
    )


@query(
    "stream_shared_table",
    """
    SELECT 'app@events' AS lane, CAST(event_id AS VARCHAR) AS metadata_uid, event_type AS api_operation FROM events
    UNION ALL SELECT 'acme@orders', CAST(o_orderkey AS VARCHAR), o_orderstatus FROM orders""",
)
def stream_shared_table(spark, sf):
    with own_database(spark, "month") as (database, place):
        run_stream(spark, _events(sf), place)
        run_stream(spark, _orders(sf), place)
        # Drained runs find nothing new, so nothing is added twice.
        run_stream(spark, _orders(sf), place)
    return flat(SharedTable(spark, f"{database}.api_activity").frame(with_lane=True), "lane metadata.uid api.operation")


ACTIVITY_COLUMNS = "activity_id activity_name type_uid severity status_id metadata.uid api.operation actor.user.uid"
ACTIVITY_ROWS = f"""
    SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, {ACTIVITY_SQL}, CAST(event_id AS VARCHAR) AS metadata_uid,
           event_type AS api_operation, CAST(user_id AS VARCHAR) AS actor_user_uid
    FROM events"""


@query("stream_running", ACTIVITY_ROWS)
def stream_running(spark, sf):
    """All layers run on side by side, a micro-batch a second, until they are stopped."""
    with own_database(spark) as (database, place):
        running = dataclasses.replace(place, drain=False, interval="1 second")
        started = []
        try:
            for layer in LAYERS:
                started += run_stream(spark, _events(sf), running, layers=[layer])
                for stream in started:
                    stream.processAllAvailable()
        finally:
            for stream in started:
                stream.stop()
    return flat(SharedTable(spark, f"{database}.api_activity").frame(), ACTIVITY_COLUMNS, time=iso("time"))


@query("class_tables_then_stream", ACTIVITY_ROWS)
def class_tables_then_stream(spark, sf):
    """All class tables are made beforehand, as an administrator does."""
    with own_database(spark) as (database, place):
        assert len(create_class_tables(spark, database)) == 22
        run_stream(spark, _events(sf), place)
    return flat(SharedTable(spark, f"{database}.api_activity").frame(), ACTIVITY_COLUMNS, time=iso("time"))


@query("one_day", f"{ACTIVITY_ROWS} WHERE CAST(ts AS DATE) = DATE '2024-01-05'")
def one_day(spark, sf):
    """Rows of one day: the other days' folders are not read."""
    with own_database(spark) as (database, place):
        run_stream(spark, _events(sf), place)
    rows = SharedTable(spark, f"{database}.api_activity").frame(since="2024-01-05", until="2024-01-05")
    return flat(rows, ACTIVITY_COLUMNS, time=iso("time"))


@query(
    "one_day_of_bronze",
    """
    SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time FROM events
    WHERE CAST(ts AS DATE) = DATE '2024-01-07'""",
)
def one_day_of_bronze(spark, sf):
    with own_database(spark) as (database, place):
        run_stream(spark, _events(sf), place, layers=["bronze"])
    bronze = spark.table(f"{database}.app_events_bronze").filter("date = DATE'2024-01-07'")
    return bronze.select("event_id", "event_type", iso("time").alias("time"))


@query("own_gold_database", ACTIVITY_ROWS)
def own_gold_database(spark, sf):
    """A mapping names its database, and reads its parsed table by its full name."""
    flow = _events(sf)
    with own_database(spark) as (elsewhere, _), own_database(spark) as (database, place):
        mapping = dataclasses.replace(flow.gold[0], database=elsewhere, input=f"{database}.app_events_silver")
        silver = dataclasses.replace(flow.silver[0], input=f"{database}.app_events_bronze")
        run_stream(spark, dataclasses.replace(flow, silver=(silver,), gold=(mapping,)), place)
    return flat(SharedTable(spark, f"{elsewhere}.api_activity").frame(), ACTIVITY_COLUMNS, time=iso("time"))


def _second_version(first: Flow, operation: str) -> Flow:
    mapping = first.gold[0]
    kept = tuple(f for f in mapping.fields if f.name != "api.operation")
    changed = dataclasses.replace(mapping, fields=(*kept, Field("api.operation", operation)))
    return dataclasses.replace(first, gold=(changed,), version="2.0")


@query(
    "replay_version",
    """
    SELECT '2.0' AS lane_version, CAST(event_id AS VARCHAR) AS metadata_uid, 'v2 ' || event_type AS api_operation FROM events
    UNION ALL SELECT '1.0', CAST(o_orderkey AS VARCHAR), o_orderstatus FROM orders""",
)
def replay_version(spark, sf):
    first = _events(sf)
    with own_database(spark, "month") as (database, place):
        run_stream(spark, first, place)
        run_stream(spark, _orders(sf), place)
        replay_gold(spark, _second_version(first, "concat('v2 ', event_type)"), place, replaced="1.0")
    return flat(
        SharedTable(spark, f"{database}.api_activity").frame(with_lane=True), "lane_version metadata.uid api.operation"
    )


@query(
    "replay_that_fails",
    "SELECT '1.0' AS lane_version, CAST(event_id AS VARCHAR) AS metadata_uid, event_type AS api_operation FROM events",
)
def replay_that_fails(spark, sf):
    """The old rows stay whole when the new mapping breaks on some row."""
    first = _events(sf)
    with own_database(spark) as (database, place):
        run_stream(spark, first, place)
        try:
            replay_gold(spark, _second_version(first, "if(event_id = 7, raise_error('broken'), event_type)"), place, replaced="1.0")
        except Exception as error:  # noqa: BLE001
            assert "broken" in str(error)
        else:
            raise AssertionError("the replay did not fail")
    return flat(
        SharedTable(spark, f"{database}.api_activity").frame(with_lane=True), "lane_version metadata.uid api.operation"
    )


@query(
    "read_during_replay",
    """
    SELECT 'while' AS moment, '1.0' AS lane_version, count(*) AS rows FROM events
    UNION ALL SELECT 'after', '2.0', count(*) FROM events""",
)
def read_during_replay(spark, sf):
    """While both versions are stored, readers see the old one, then the new one."""
    first = _events(sf)
    second = _second_version(first, "concat('v2 ', event_type)")
    with own_database(spark) as (database, place):
        run_stream(spark, first, place)
        shared = SharedTable(spark, f"{database}.api_activity")
        shared.set_live(Lane("app", "events", "1.0"))
        run_stream(spark, second, place, layers=["gold"])
        seen = [("while", shared.frame(with_lane=True))]
        shared.set_live(Lane("app", "events", "2.0"))
        seen.append(("after", shared.frame(with_lane=True)))
    counts = [df.groupBy("lane_version").agg(F.count("*").alias("rows")).select(F.lit(m).alias("moment"), "*") for m, df in seen]
    return counts[0].unionByName(counts[1])


@query(
    "compaction",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 4 THEN -1 WHEN o_orderkey % 6 = 4 THEN -2 ELSE 6 END AS lane_batch
    FROM orders UNION ALL SELECT o_orderkey, -2 FROM orders WHERE o_orderkey % 6 = 5""",
)
def compaction(spark, sf):
    """Two merges; a batch that is written again after its merge changes nothing."""
    orders = table(spark, sf, "orders").select("o_orderkey")
    lane = Lane("acme", "orders", "1.0")
    with own_database(spark) as (database, _):
        shared = SharedTable(spark, f"{database}.order_keys").create(orders.schema)
        part = [orders.filter(F.col("o_orderkey") % 6 == k) for k in range(6)]
        for batch in range(4):
            shared.write_batch(part[batch], lane, batch, sort_by=["o_orderkey"])
        shared.compact(lane, up_to=3)
        shared.write_batch(part[3], lane, 3, sort_by=["o_orderkey"])
        for batch in (4, 5):
            shared.write_batch(part[batch], lane, batch, sort_by=["o_orderkey"])
        shared.write_batch(part[5], lane, 6, sort_by=["o_orderkey"])
        shared.compact(lane, up_to=5)
    return shared.frame(with_lane=True).select("o_orderkey", "lane_batch")
