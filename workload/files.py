"""Raw files of every kind, several inputs, and lookups from files."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions import normalize as n
from siltstone.operators.ingest import to_bronze
from siltstone.operators.layers import to_silver
from siltstone.operators.lookups import apply_lookups
from siltstone.plans.session import fresh_dir
from siltstone.plans.spec import Ingest, Lookup, LookupSource
from siltstone.quality import discover
from siltstone.sources import aws_vpc, cisco_ios
from siltstone.sources.files import read_batch
from workload.base import instant, iso, query, table
from workload.layers import written

RECORDS_SQL = """
    SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS time
    FROM events"""


def _records(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "event_type", F.parse_json("props").alias("inner"),
        F.date_format(instant("ts"), "yyyy-MM-dd HH:mm:ss'Z'").alias("at"),
    )


@query("read_json_multiline", RECORDS_SQL)
def read_json_multiline(spark, sf):
    """Files that hold one array of records each, over many lines."""
    record = F.to_json(F.struct("event_id", "event_type", "inner", "at"), {"pretty": "true"})
    files = (
        _records(spark, sf)
        .groupBy(F.floor(F.col("event_id") / 500).alias("file"))
        .agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list(record), ",\n"), F.lit("\n]")).alias("value"))
    )
    path = fresh_dir(spark, "multiline")
    files.write.partitionBy("file").text(path)
    ingest = Ingest(
        name="j", inputs=(path,), format="json", multiline=True,
        schema="event_id bigint, event_type string, inner struct<k:int>, at string",
        pre=(("'a' as source", "'b' as sourcetype", "cast(at as timestamp) as time", "to_json(inner) as value", "event_id", "event_type", "inner.k as k"),),
    )
    df = to_bronze(read_batch(spark, ingest), ingest)
    return df.select("event_id", "event_type", "k", iso("time").alias("time"))


@query(
    "read_text_two_folders",
    """
    SELECT CAST(event_id AS VARCHAR) AS seq_no, 'APP' AS facility, upper(event_type) AS mnemonic,
           'user ' || user_id AS description, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time
    FROM events""",
)
def read_text_two_folders(spark, sf):
    """Syslog lines from text files in two folders, read as one input."""
    events = table(spark, sf, "events")
    line = F.concat(
        F.col("event_id"), F.lit(": "), F.date_format(instant("ts"), "MMM d yyyy HH:mm:ss"), F.lit(": %APP-6-"),
        F.upper("event_type"), F.lit(": user "), F.col("user_id"),
    )
    lines = events.select("event_id", line.alias("value"))
    folders = [written(lines.filter(F.col("event_id") % 2 == k).select("value"), "text", "text") for k in (0, 1)]
    ingest = cisco_ios.flow(*folders).ingest
    silver = to_silver(to_bronze(read_batch(spark, ingest), ingest), cisco_ios.parsed())
    return silver.select("seq_no", "facility", "mnemonic", "description", iso("time").alias("time"))


@query(
    "csv_zero_led_ids",
    """
    SELECT lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS account_id, CAST(o_orderkey AS BIGINT) AS bytes,
           CASE WHEN o_orderstatus <> 'P' THEN '1e5' END AS interface_id,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS time
    FROM orders""",
)
def csv_zero_led_ids(spark, sf):
    """Account ids of a flow log keep their leading zeros, and other texts their form."""
    orders = table(spark, sf, "orders")
    start = F.unix_timestamp(instant("o_orderdate"))
    path = written(
        orders.select(
            F.lpad(F.col("o_custkey").cast("string"), 12, "0").alias("account-id"),
            F.when(F.col("o_orderstatus") == "P", "-").otherwise("1e5").alias("interface-id"),
            F.col("o_orderkey").alias("bytes"), start.alias("start"), start.alias("end"),
        ),
        "vpc", "csv", header="true", sep=" ",
    )
    ingest = aws_vpc.flow(path).ingest
    silver = to_silver(to_bronze(read_batch(spark, ingest), ingest), aws_vpc.parsed())
    return silver.select("account_id", "bytes", "interface_id", iso("time").alias("time"))


NATIONS_SQL = """
    SELECT c_custkey, n.n_name AS n_name, n.n_regionkey AS n_regionkey FROM customer LEFT JOIN nation n ON n_nationkey = c_nationkey"""


def _with_nation(spark, sf, kind, **options):
    nations = table(spark, sf, "nation")
    path = written(nations, "nations", "csv" if kind == "csv" else "json", **({"header": "true"} if kind == "csv" else {}))
    source = LookupSource(path=path, kind=kind, schema="n_nationkey int, n_name string, n_regionkey int", options=options)
    lookup = Lookup(source, on=(("c_nationkey", "n_nationkey"),), select=("n_name", "n_regionkey"), broadcast=True)
    joined = apply_lookups(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), [lookup])
    return joined.drop("c_nationkey")


@query("lookup_from_csv", NATIONS_SQL)
def lookup_from_csv(spark, sf):
    return _with_nation(spark, sf, "csv", header="true")


@query("lookup_from_json", NATIONS_SQL)
def lookup_from_json(spark, sf):
    return _with_nation(spark, sf, "json")


@query("lookup_from_jsonl", NATIONS_SQL)
def lookup_from_jsonl(spark, sf):
    return _with_nation(spark, sf, "jsonl")


@query(
    "discover_files",
    """
    SELECT 'event_id' AS key, count(*) AS present, count(*) AS filled FROM events
    UNION ALL SELECT 'event_type', count(*), count(*) FROM events
    UNION ALL SELECT 'inner', count(*), count(*) FROM events
    UNION ALL SELECT 'at', count(*), count(*) FROM events""",
)
def discover_files(spark, sf):
    """Keys of raw JSON files nothing is known about."""
    path = written(_records(spark, sf), "unknown", "json")
    return discover.key_population(discover.read_records(spark, path))
