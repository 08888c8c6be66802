"""Several inputs of one bronze table: different stores and schemas, schemas that grow, broken records."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from siltstone.plans.session import fresh_dir
from siltstone.plans.spec import Ingest
from siltstone.streaming.inputs import quarantine_table, run_inputs
from workload.base import instant, iso, query, table
from workload.streams import own_database

STAMP = "yyyy-MM-dd HH:mm:ss'Z'"


def _placed(spark, place):
    return dataclasses.replace(place, tables=fresh_dir(spark, "inputs"))


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("at", F.date_format(instant("ts"), STAMP))


@query(
    "inputs_in_two_stores",
    """
    SELECT event_id, event_type, CASE WHEN event_id % 2 = 1 THEN user_id END AS user_id,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, CASE WHEN event_id % 2 = 0 THEN 'json' ELSE 'csv' END AS sourcetype
    FROM events""",
)
def inputs_in_two_stores(spark, sf):
    """JSON files, and CSV files of other columns in another store; both streams are started twice."""
    root, elsewhere = fresh_dir(spark, "first-store"), fresh_dir(spark, "second-store")
    mount = "m" + elsewhere.rpartition("-")[2]
    home = spark._jvm.org.apache.hadoop.fs.Path(elsewhere)
    home = home.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(home).toString()
    spark.conf.set(f"fs.viewfs.mounttable.{mount}.link./in", home)
    spark._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{mount}.link./in", home)
    events = _events(spark, sf)
    made = ("cast(at as timestamp) as time", "cast(event_id as string) as value", "event_id", "event_type")
    inputs = [
        Ingest(
            name="shared_bronze", inputs=(root,), format="json", schema="event_id bigint, event_type string, at string",
            pre=(("'app' as source", "'json' as sourcetype", *made),),
        ),
        Ingest(
            name="shared_bronze", inputs=(f"viewfs://{mount}/in",), format="csv", options={"header": "true"},
            schema="event_id bigint, user_id bigint, event_type string, at string",
            pre=(("'app' as source", "'csv' as sourcetype", *made, "user_id"),),
        ),
    ]
    with own_database(spark) as (database, place):
        place = _placed(spark, place)
        for part in range(2):  # the second start finds new files in both stores, and the old ones
            some = events.filter(F.floor(F.col("event_id") / 2) % 2 == part)
            some.filter("event_id % 2 = 0").select("event_id", "event_type", "at").write.mode("append").json(root)
            some.filter("event_id % 2 = 1").select("event_id", "user_id", "event_type", "at").write.mode("append").option("header", "true").csv(elsewhere)
            run_inputs(spark, inputs, place)
        run_inputs(spark, inputs, place)
        rows = spark.table(f"{database}.shared_bronze")
    return rows.select("event_id", "event_type", "user_id", iso("time").alias("time"), "sourcetype")


@query(
    "schema_memory",
    """
    SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS BIGINT) ELSE event_id * 10000000000 END AS k,
           CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type FROM events""",
)
def schema_memory(spark, sf):
    """Files of a second schema arrive after the first drain: a new column, and a wider type."""
    root = fresh_dir(spark, "growing")
    events = _events(spark, sf)
    ingest = Ingest(name="growing_bronze", inputs=(root,), format="parquet", pre=(("*", "'a' as source", "'b' as sourcetype", "cast(at as timestamp) as time", "at as value"),))
    first = events.filter("event_id % 2 = 0").select("event_id", F.col("event_id").cast("int").alias("k"), "at")
    second = events.filter("event_id % 2 = 1").select("event_id", (F.col("event_id") * 10_000_000_000).alias("k"), "at", "event_type")
    with own_database(spark) as (database, place):
        place = _placed(spark, place)
        for part in (first, second):
            part.write.mode("append").parquet(root)
            run_inputs(spark, [ingest], place)
        rows = spark.table(f"{database}.growing_bronze")
    return rows.select("event_id", "k", "event_type")


BROKEN_SQL = """
    SELECT kind, what, count(*) AS records FROM (
        SELECT CASE WHEN event_id % 2 = 0 THEN 'json' ELSE 'csv' END AS kind,
               CASE WHEN event_id % 10 < 2 THEN CASE WHEN event_id % 2 = 0 THEN '{"event_id": ' || event_id ELSE CAST(event_id AS VARCHAR) || ',short' END
                    ELSE 'good ' || event_type END AS what
        FROM events)
    GROUP BY kind, what"""


@query("records_that_do_not_parse", BROKEN_SQL)
def records_that_do_not_parse(spark, sf):
    """Broken JSON and short CSV lines end in quarantine with their text, the others in bronze."""
    folders = [fresh_dir(spark, name) for name in ("json-lines", "csv-lines")]
    events = _events(spark, sf).withColumn("bad", F.col("event_id") % 10 < 2)
    cut = F.concat(F.lit('{"event_id": '), F.col("event_id"))
    line = F.when(F.col("bad"), cut).otherwise(F.to_json(F.struct("event_id", "event_type", "at")))
    events.filter("event_id % 2 = 0").select(line.alias("value")).write.text(folders[0])
    line = F.when(F.col("bad"), F.concat("event_id", F.lit(",short"))).otherwise(F.concat_ws(",", "event_id", "event_type", "at"))
    events.filter("event_id % 2 = 1").select(line.alias("value")).write.text(folders[1])
    made = ("'app' as source", "cast(at as timestamp) as time", "event_id", "event_type")
    inputs = [
        Ingest(
            name="checked_bronze", inputs=(folders[0],), format="jsonl", schema="event_id bigint, event_type string, at string",
            pre=((*made, "'json' as sourcetype", "event_type as value"),),
        ),
        Ingest(
            name="checked_bronze", inputs=(folders[1],), format="csv", schema="event_id bigint, event_type string, at string",
            options={"header": "false"}, pre=((*made, "'csv' as sourcetype", "event_type as value"),),
        ),
    ]
    with own_database(spark) as (database, place):
        run_inputs(spark, inputs, _placed(spark, place))
        good = spark.table(f"{database}.checked_bronze").select(F.col("sourcetype").alias("kind"), F.concat(F.lit("good "), "event_type").alias("what"))
        kind = F.when(F.contains("file", F.lit("json-lines")), "json").otherwise("csv")
        bad = spark.table(quarantine_table(spark, inputs[0])).select(kind.alias("kind"), F.col("text").alias("what"))
    return good.unionByName(bad).groupBy("kind", "what").agg(F.count("*").alias("records"))
