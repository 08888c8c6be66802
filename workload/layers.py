"""Ingest, parse and map steps, generators and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import normalize as n
from siltstone.operators.ingest import LINEAGE_ID, to_bronze
from siltstone.operators.layers import explode_elements, rename_column, to_gold, to_silver
from siltstone.operators.lookups import apply_lookups
from siltstone.plans.chain import Layers, run_batch, union_by_class
from siltstone.plans.ocsf import conform
from siltstone.plans.session import at_end, fresh_dir
from siltstone.plans.spec import Field, Flow, GoldSpec, Ingest, Lookup, LookupSource, SilverSpec, fields
from siltstone.sources.files import csv_to_table, read_batch
from workload.base import flat, instant, iso, query, table

EVENT_COLUMNS = ("event_id", "user_id", "event_type", "value")


def event_ingest() -> Ingest:
    return Ingest(
        name="app_events_bronze",
        format="parquet",
        single_variant=True,
        pre=(
            (
                "'app' as source",
                "'events' as sourcetype",
                instant("ts").alias("time"),
                "parse_json(props) as data",
                *EVENT_COLUMNS,
            ),
        ),
    )


def event_silver() -> SilverSpec:
    return SilverSpec(
        name="app_events_silver",
        preserve=True,
        fields=(Field("k", "try_variant_get(data, '$.k', 'int')"),),
    )


def event_metadata() -> dict:
    return n.metadata(
        "App", "Acme", "app", "events", "JSON",
        uid=F.col("event_id").cast("string"),
        logged_time=F.col("time"),
        processed_time=F.current_timestamp(),
    )


def event_activity() -> GoldSpec:
    return GoldSpec(
        name="api_activity",
        input="app_events_silver",
        fields=fields(
            {
                "time": F.col("time"),
                **n.class_columns("api_activity"),
                "activity_id": n.lookup(F.col("event_type"), {"signup": 1, "view": 2, "click": 3}, 99),
                "activity_name": n.lookup(F.col("activity_id"), {1: "Create", 2: "Read", 3: "Update"}, "Other"),
                "type_uid": n.type_uid(F.col("class_uid"), F.col("activity_id")),
                "type_name": n.type_name("API Activity", F.col("activity_name")),
                "severity_id": n.lookup(F.col("event_type"), {"error": 4}, 1),
                "severity": n.severity_name(F.col("severity_id")),
                "status_id": n.lookup(F.col("event_type"), {"error": 2}, 1),
                "status": n.status_name(F.col("status_id")),
                **event_metadata(),
                "actor.user.uid": F.col("user_id").cast("string"),
                "api.operation": F.col("event_type"),
            }
        ),
    )


def events_flow() -> Flow:
    return Flow(
        name="app_events",
        provider="app",
        log_name="events",
        ingest=event_ingest(),
        silver=(event_silver(),),
        gold=(event_activity(),),
    )


def events_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return to_bronze(table(spark, sf, "events"), event_ingest())


def events_silver(spark: SparkSession, sf: str) -> DataFrame:
    return to_silver(events_bronze(spark, sf), event_silver())


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """events -> bronze -> silver with a chained lookup -> conformed class rows."""
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_nationkey")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    silver = SilverSpec(
        name="app_events_silver",
        preserve=True,
        lookups=(
            Lookup(
                LookupSource(frame=customers), on=(("user_id", "user_id"),), name="customer",
                select=("c_name", "c_nationkey"), broadcast=True,
            ),
            Lookup(
                LookupSource(frame=nations), on=(("c_nationkey", "n_nationkey"),), name="nation",
                select=("n_name",), broadcast=True,
            ),
        ),
        filter="event_type <> 'view'",
        fields=(Field("k", "try_variant_get(data, '$.k', 'int')"),),
    )
    mapping = event_activity()
    enriched = GoldSpec(
        name=mapping.name,
        input=mapping.input,
        fields=mapping.fields
        + fields({"actor.user.name": F.col("c_name"), "src_endpoint.location.country": F.col("n_name")}),
    )
    return conform(to_gold(to_silver(events_bronze(spark, sf), silver), enriched), "api_activity")


ACTIVITY_SQL = """
  CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 ELSE 99 END AS activity_id,
  CASE event_type WHEN 'signup' THEN 'Create' WHEN 'view' THEN 'Read' WHEN 'click' THEN 'Update' ELSE 'Other' END AS activity_name,
  600300 + CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 ELSE 99 END AS type_uid,
  CASE WHEN event_type = 'error' THEN 'High' ELSE 'Informational' END AS severity,
  CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS status_id"""


@query(
    "chain_with_lookups",
    f"""
    SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, {ACTIVITY_SQL},
           CAST(event_id AS VARCHAR) AS metadata_uid, event_type AS api_operation,
           CAST(user_id AS VARCHAR) AS actor_user_uid, c_name AS actor_user_name,
           n_name AS src_endpoint_location_country
    FROM events LEFT JOIN customer ON c_custkey = user_id LEFT JOIN nation ON n_nationkey = c_nationkey
    WHERE event_type <> 'view'""",
)
def chain_with_lookups(spark, sf):
    return flat(
        flagship(spark, sf),
        "activity_id activity_name type_uid severity status_id metadata.uid api.operation actor.user.uid "
        "actor.user.name src_endpoint.location.country",
        time=iso("time"),
    )


# -- ingest ----------------------------------------------------------------------------


@query(
    "bronze_record_id",
    """
    SELECT event_id, md5('{"k":' || json_extract_string(props, '$.k') || '}' || '_events.parquet') AS record_id,
           'app' AS source, 'events' AS sourcetype, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time,
           strftime(ts, '%Y-%m-%d') AS date, 'events.parquet' AS file_name
    FROM events""",
)
def bronze_record_id(spark, sf):
    return events_bronze(spark, sf).select(
        "event_id", "record_id", "source", "sourcetype", iso("time").alias("time"),
        F.col("date").cast("string").alias("date"), F.col("_metadata.file_name").alias("file_name"),
    )


@query(
    "bronze_standard_columns",
    """
    SELECT page_id, md5(html || '_pages.parquet') AS record_id, position,
           list_extract(['record_id', 'source', 'sourcetype', 'time', 'date', 'value', '_metadata', 'processed_time',
                         'dsl_id', 'page_id', 'n_chars'], position) AS column_name
    FROM pages, range(1, 12) AS r(position)""",
)
def bronze_standard_columns(spark, sf):
    ingest = Ingest(
        name="pages_bronze",
        format="parquet",
        pre=(
            (F.lit(0).cast("timestamp").alias("time"), "html as value", "page_id", "'web' as source"),
            ("*", "'pages' as sourcetype", "length(value) as n_chars"),
        ),
        drop=("not_there", "_not_there"),
    )
    df = to_bronze(table(spark, sf, "pages"), ingest)
    names = F.posexplode(F.array(*(F.lit(name) for name in df.columns))).alias("position", "column_name")
    return df.select("page_id", "record_id", names).select(
        "page_id", "record_id", (F.col("position") + 1).alias("position"), "column_name"
    )


@query(
    "bronze_post_transform",
    """
    SELECT event_id, md5('{"k":' || json_extract_string(props, '$.k') || '}' || '_events.parquet') AS record_id,
           c_name AS customer_name, c_mktsegment AS customer_segment
    FROM events JOIN customer ON c_custkey = user_id""",
)
def bronze_post_transform(spark, sf):
    lookup = Lookup(
        LookupSource(path=f"{sf}/customer.parquet", kind="parquet"),
        on=(("user_id", "c_custkey"),), how="inner", select=("c_name", "c_mktsegment"),
    )
    base = event_ingest()
    ingest = Ingest(
        name=base.name, format=base.format, single_variant=True, pre=base.pre, lookups=(lookup,),
        post=("* except (c_name, c_mktsegment)", "named_struct('name', c_name, 'segment', c_mktsegment) as customer"),
        drop=("value", "event_type"),
    )
    df = to_bronze(table(spark, sf, "events"), ingest)
    assert "event_type" not in df.columns
    return flat(df, "event_id record_id customer.name customer.segment")


@query(
    "row_id",
    """
    SELECT 24 AS id_length, true AS is_hex, count(*) AS rows, count(*) AS distinct_ids FROM events""",
)
def row_id(spark, sf):
    return events_bronze(spark, sf).groupBy(
        F.length(LINEAGE_ID).alias("id_length"), F.col(LINEAGE_ID).rlike("^[0-9a-f]{24}$").alias("is_hex")
    ).agg(F.count("*").alias("rows"), F.count_distinct(LINEAGE_ID).alias("distinct_ids"))


def written(df: DataFrame, purpose: str, source: str, **options: str) -> str:
    """The rows as raw log files in the shared folder."""
    path = fresh_dir(df.sparkSession, purpose)
    df.write.format(source).options(**options).save(path)
    return path


@query(
    "read_json_variant",
    """
    SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS time
    FROM events""",
)
def read_json_variant(spark, sf):
    events = table(spark, sf, "events")
    path = written(
        events.select(
            "event_id", "event_type", F.parse_json("props").alias("inner"),
            F.date_format(instant("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS'Z'").alias("at"),
        ),
        "json", "json",
    )
    ingest = Ingest(
        name="j", inputs=(path,), format="jsonl", single_variant=True,
        pre=(("'a' as source", "'b' as sourcetype", "cast(try_variant_get(data, '$.at', 'string') as timestamp) as time", "data"),),
    )
    df = to_bronze(read_batch(spark, ingest), ingest)
    return df.select(
        n.number("$.event_id", "bigint").alias("event_id"), n.text("$.event_type").alias("event_type"),
        n.number("$.inner.k").alias("k"), iso("time").alias("time"),
    )


@query(
    "read_csv_variant",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status,
           CAST(round(o_totalprice * 100) AS BIGINT) AS cents
    FROM orders""",
)
def read_csv_variant(spark, sf):
    orders = table(spark, sf, "orders")
    path = written(
        orders.select(
            F.col("o_orderkey").alias("order-key"),
            F.when(F.col("o_orderstatus") == "P", "-").otherwise(F.col("o_orderstatus")).alias("order-status"),
            F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        ),
        "csv", "csv", header="true", sep=" ",
    )
    ingest = Ingest(
        name="c", inputs=(path,), format="csv", single_variant=True, options={"header": "true", "sep": " "},
    )
    return read_batch(spark, ingest).select(
        n.number("$.order-key", "bigint").alias("o_orderkey"),
        n.missing_as_null(n.text("$.order-status")).alias("status"),
        n.number("$.cents", "bigint").alias("cents"),
    )


@query(
    "read_csv_with_hints",
    "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, s_nationkey FROM supplier",
)
def read_csv_with_hints(spark, sf):
    path = written(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey"), "hints", "csv", header="true")
    ingest = Ingest(name="h", inputs=(path,), format="csv", schema_hints="s_suppkey string")
    return read_batch(spark, ingest).select("s_suppkey", "s_name", "s_nationkey")


@query(
    "csv_lookup_table",
    "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey",
)
def csv_lookup_table(spark, sf):
    regions = Lookup(LookupSource(frame=table(spark, sf, "region")), on=(("n_regionkey", "r_regionkey"),), how="inner", broadcast=True)
    nations = apply_lookups(table(spark, sf, "nation"), [regions])
    path = written(nations.select("n_nationkey", "n_name", "r_name"), "lookup", "csv", header="true")
    name = "nation_lookup_" + path[-12:]
    csv_to_table(spark, path, name, schema="n_nationkey int, n_name string, r_name string")
    at_end(lambda: spark.sql(f"DROP TABLE IF EXISTS {name}"))
    lookup = Lookup(LookupSource(path=name), on=(("c_nationkey", "n_nationkey"),), how="inner", broadcast=True)
    spec = SilverSpec(
        name="s", lookups=(lookup,), fields=tuple(Field(c, source=c) for c in ("c_custkey", "n_name", "r_name"))
    )
    return to_silver(table(spark, sf, "customer"), spec)


# -- parse -----------------------------------------------------------------------------


@query(
    "silver_variant_fields",
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, NULL::VARCHAR AS absent,
           json_extract_string(props, '$.k') AS k_text
    FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50""",
)
def silver_variant_fields(spark, sf):
    spec = SilverSpec(
        name="s",
        filter="try_variant_get(data, '$.k', 'int') >= 50",
        fields=(
            Field("event_id", source="event_id"),
            Field("k", "try_variant_get(data, '$.k', 'int')"),
            Field("k_text", "try_variant_get(data, '$.k', 'string')"),
            Field("absent", "try_variant_get(data, '$.no.such', 'string')"),
        ),
    )
    return to_silver(events_bronze(spark, sf), spec).drop(LINEAGE_ID)


@query(
    "silver_csv_in_text",
    """
    SELECT event_id, CAST(user_id AS INTEGER) AS who, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS what,
           round(value, 2) AS amount
    FROM events""",
)
def silver_csv_in_text(spark, sf):
    """A CSV line inside a record, read by a field expression."""
    line = F.concat_ws(
        ";", F.col("user_id").cast("string"), F.when(F.col("event_type") == "error", "-").otherwise(F.col("event_type")),
        F.round("value", 2).cast("string"),
    )
    spec = SilverSpec(
        name="s",
        temporary=(Field("parts", "from_csv(value, 'who int, what string, amount double', map('sep', ';', 'nullValue', '-'))"),),
        fields=(
            Field("event_id", source="event_id"), Field("who", source="parts.who"),
            Field("what", source="parts.what"), Field("amount", source="parts.amount"),
        ),
    )
    return to_silver(table(spark, sf, "events").select("event_id", line.alias("value")), spec)


@query(
    "silver_temp_preserve",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) % 7 AS cents_mod,
           CAST(round(o_totalprice * 100) AS BIGINT) > 10000000 AS is_large,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority
    FROM orders""",
)
def silver_temp_preserve(spark, sf):
    spec = SilverSpec(
        name="s",
        temporary=(Field("cents", "cast(round(o_totalprice * 100) as bigint)"),),
        fields=(
            Field("cents_mod", "cents % 7"),
            Field("is_large", "cents > 10000000"),
            Field("priority", "try_cast(substr(o_orderpriority, 1, 1) as int)"),
        ),
        preserve=True,
        omit=("o_totalprice", "o_orderdate", "o_orderpriority", "no_such_column"),
    )
    return to_silver(table(spark, sf, "orders"), spec)


@query(
    "silver_filter_postfilter",
    """
    SELECT * FROM (
      SELECT l_orderkey, l_linenumber, CAST(round(l_quantity * (1 + l_linenumber)) AS BIGINT) AS weight
      FROM lineitem WHERE l_returnflag = 'R') WHERE weight > 100""",
)
def silver_filter_postfilter(spark, sf):
    spec = SilverSpec(
        name="s",
        filter="l_returnflag = 'R'",
        fields=(
            Field("l_orderkey", source="l_orderkey"),
            Field("l_linenumber", source="l_linenumber"),
            Field("weight", "cast(round(l_quantity * (1 + l_linenumber)) as bigint)"),
        ),
        post_filter="weight > 100",
    )
    return to_silver(table(spark, sf, "lineitem"), spec)


# -- map -------------------------------------------------------------------------------


@query(
    "gold_nested",
    f"""
    SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, {ACTIVITY_SQL}, 6003 AS class_uid,
           'Application Activity' AS category_name, 'App' AS metadata_product_name, '1.7.0' AS metadata_version,
           'app@events:version@1.0' AS metadata_log_version, CAST(event_id AS VARCHAR) AS metadata_uid,
           CAST(user_id AS VARCHAR) AS actor_user_uid, event_type AS api_operation,
           'API Activity: ' || CASE event_type WHEN 'signup' THEN 'Create' WHEN 'view' THEN 'Read'
             WHEN 'click' THEN 'Update' ELSE 'Other' END AS type_name
    FROM events""",
)
def gold_nested(spark, sf):
    return flat(
        to_gold(events_silver(spark, sf), event_activity()),
        "activity_id activity_name type_uid type_name severity status_id class_uid category_name "
        "metadata.product.name metadata.version metadata.log_version metadata.uid actor.user.uid api.operation",
        time=iso("time"),
    )


@query(
    "gold_shadowed_name",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Done' ELSE 'Open' END AS o_orderstatus,
           'status ' || o_orderstatus AS note,
           CASE WHEN o_orderstatus = 'F' THEN 'Done' ELSE 'Open' END || '!' AS loud, 4 AS sum_member
    FROM orders""",
)
def gold_shadowed_name(spark, sf):
    spec = GoldSpec(
        name="g",
        input="s",
        fields=(
            Field("o_orderkey", source="o_orderkey"),
            Field("word", "CASE WHEN o_orderstatus = 'F' THEN 'Done' ELSE 'Open' END"),
            Field("o_orderstatus", source="word"),
            Field("note", "concat('status ', o_orderstatus)"),
            Field("loud", "concat(word, '!')"),
            Field("s.a", literal=1),
            Field("s.b.c", literal=3),
        ),
    )
    df = to_gold(table(spark, sf, "orders"), spec)
    return df.select("o_orderkey", "o_orderstatus", "note", "loud", (F.col("s.a") + F.col("s.b.c")).alias("sum_member"))


@query(
    "gold_conform",
    """
    SELECT CAST(page_id AS VARCHAR) AS metadata_uid, url AS http_request_url, 'GET' AS http_request_http_method,
           CAST(length(html) AS INTEGER) AS http_response_body_length, NULL::INTEGER AS http_response_code,
           NULL::VARCHAR AS src_endpoint_ip, NULL::INTEGER AS activity_id, 4002 AS class_uid, 39 AS n_columns,
           'dsl_id' AS first_column, 'unmapped' AS last_column
    FROM pages""",
)
def gold_conform(spark, sf):
    spec = GoldSpec(
        name="http_activity",
        input="s",
        fields=fields(
            {
                "metadata.uid": F.col("page_id").cast("string"),
                **n.class_columns("http_activity"),
                "http_request.url": F.col("url"),
                "http_request.http_method": F.lit("GET"),
                "http_response.body_length": F.length("html"),
            }
        ),
    )
    df = conform(to_gold(table(spark, sf, "pages"), spec), "http_activity")
    again = conform(df, "http_activity")
    return flat(
        again,
        "metadata.uid http_request.url http_request.http_method http_response.body_length http_response.code "
        "src_endpoint.ip activity_id class_uid",
        n_columns=F.lit(len(df.columns)),
        first_column=F.lit(df.columns[0]),
        last_column=F.lit(df.columns[-1]),
    )


@query(
    "gold_routing",
    """
    SELECT 'authentication' AS event_class, 3002 AS class_uid, event_id FROM events WHERE event_type IN ('signup', 'click')
    UNION ALL SELECT 'api_activity', 6003, event_id FROM events WHERE event_type IN ('click', 'view')
    UNION ALL SELECT 'process_activity', 1007, event_id FROM events WHERE event_type = 'error' AND value > 20""",
)
def gold_routing(spark, sf):
    routes = {
        "authentication": "event_type IN ('signup', 'click')",
        "api_activity": "event_type IN ('click', 'view')",
        "process_activity": "event_type = 'error' AND value > 20",
    }
    silver = events_silver(spark, sf)
    parts = [
        to_gold(
            silver,
            GoldSpec(
                name=name, input="s", filter=condition,
                fields=(*fields({"class_uid": n.class_columns(name)["class_uid"]}), Field("event_id", source="event_id")),
            ),
        ).select(F.lit(name).alias("event_class"), "class_uid", "event_id")
        for name, condition in routes.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "flow_from_mapping",
    """
    SELECT CAST(event_id AS VARCHAR) AS metadata_uid, 'click' AS api_operation,
           CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) > 50 THEN 3 ELSE 1 END AS severity_id,
           c_mktsegment AS metadata_tenant_uid, strftime(ts, '%Y-%m-%d') AS day
    FROM events LEFT JOIN customer ON c_custkey = user_id WHERE event_type = 'click' AND event_id > 10""",
)
def flow_from_mapping(spark, sf):
    """A flow written as a nested mapping, as a YAML file would hold it."""
    flow = Flow.from_dict(
        {
            "name": "app_clicks",
            "autoloader": {"inputs": [f"{sf}/events.parquet"], "format": "parquet"},
            "bronze": {
                "name": "app_clicks_bronze",
                "preTransform": [
                    ["*", "parse_json(props) as data"],
                    ["'app' as source", "'clicks' as sourcetype", "cast(ts as timestamp) as time", "props as value",
                     "data", "event_id", "user_id", "event_type", "_metadata"],
                ],
                "lookups": [
                    {
                        "name": "customers",
                        "source": {"type": "parquet", "path": f"{sf}/customer.parquet"},
                        "join": {"type": "left", True: ["main.user_id = lookup.c_custkey"]},
                        "select": ["c_mktsegment"],
                        "prefix": "who_",
                    }
                ],
                "drop": ["`user_id`"],
            },
            "silver": {
                "transform": [
                    {
                        "name": "app_clicks_silver",
                        "filter": "event_type = 'click'",
                        "fields": [
                            {"name": "k", "expr": "try_variant_get(data, '$.k', 'int')"},
                            {"name": "event_id", "from": "event_id"},
                            {"name": "time", "from": "time"},
                            {"name": "segment", "from": "who_c_mktsegment"},
                        ],
                        "postFilter": "event_id > 10",
                    }
                ]
            },
            "gold": [
                {
                    "name": "api_activity",
                    "input": "app_clicks_silver",
                    "fields": [
                        {"name": "time", "from": "time"},
                        {"name": "severity_id", "expr": "CAST(CASE WHEN k > 50 THEN 3 ELSE 1 END AS INT)"},
                        {"name": "api.operation", "literal": "click"},
                        {"name": "metadata.uid", "expr": "CAST(event_id AS STRING)"},
                        {"name": "metadata.tenant_uid", "from": "segment"},
                    ],
                }
            ],
        }
    )
    gold = run_batch(spark, flow).gold["api_activity"]
    return flat(
        gold, "metadata.uid api.operation severity_id metadata.tenant_uid", day=F.date_format("time", "yyyy-MM-dd")
    )


@query(
    "rename_nested",
    """
    SELECT event_id, event_type AS op_name, user_id AS who_id, CAST(round(value * 100) AS BIGINT) AS cents FROM events""",
)
def rename_nested(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id",
        F.struct(F.col("event_type").alias("kind"), F.struct(F.col("user_id").alias("id")).alias("who")).alias("op"),
        F.round(F.col("value") * 100).cast("bigint").alias("amount"),
    )
    df = rename_column(rename_column(rename_column(df, "op.kind", "name"), "op.who.id", "key"), "amount", "cents")
    return df.select("event_id", F.col("op.name").alias("op_name"), F.col("op.who.key").alias("who_id"), "cents")


# -- generators --------------------------------------------------------------------------


@query(
    "explode_array",
    """
    WITH c AS (SELECT conv_id, turn, CASE WHEN role = 'system' THEN [NULL] ELSE string_split(text, ' ') END AS words
               FROM conversations)
    SELECT conv_id, turn, unnest(words) AS word FROM c""",
)
def explode_array(spark, sf):
    words = F.when(F.col("role") != "system", F.split("text", " "))
    df = table(spark, sf, "conversations").select("conv_id", "turn", words.alias("words"))
    spec = GoldSpec(
        name="g", input="s", explode="words",
        fields=(Field("conv_id", source="conv_id"), Field("turn", source="turn"), Field("word", source="_exploded")),
    )
    return to_gold(df, spec)


@query(
    "explode_map",
    """
    SELECT l_orderkey, l_linenumber, 'part' AS key, l_partkey AS amount FROM lineitem WHERE l_linenumber > 1
    UNION ALL SELECT l_orderkey, l_linenumber, 'supplier', l_suppkey FROM lineitem WHERE l_linenumber > 1
    UNION ALL SELECT l_orderkey, l_linenumber, NULL, NULL FROM lineitem WHERE l_linenumber = 1""",
)
def explode_map(spark, sf):
    parts = F.create_map(F.lit("part"), F.col("l_partkey"), F.lit("supplier"), F.col("l_suppkey"))
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") > 1, parts).alias("m")
    )
    spec = GoldSpec(
        name="g", input="s", explode="m",
        fields=(
            Field("l_orderkey", source="l_orderkey"), Field("l_linenumber", source="l_linenumber"),
            Field("key", "_exploded.key"), Field("amount", "_exploded.value"),
        ),
    )
    return to_gold(df, spec)


@query(
    "explode_variant",
    """
    SELECT l_orderkey, l_linenumber, l_partkey AS item FROM lineitem WHERE l_linenumber > 2
    UNION ALL SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_linenumber > 2
    UNION ALL SELECT l_orderkey, l_linenumber, NULL FROM lineitem WHERE l_linenumber <= 2""",
)
def explode_variant(spark, sf):
    number = F.col("l_linenumber")
    entry = lambda c: F.struct(F.col(c).alias("id"))
    text = F.when(number > 2, F.to_json(F.array(entry("l_partkey"), entry("l_suppkey")))).when(number == 1, "[]")
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.parse_json(text).alias("items"))
    exploded = explode_elements(df, "items")
    return exploded.select(
        "l_orderkey", "l_linenumber", n.number("$.id", "bigint", F.col("_exploded")).alias("item")
    )


# -- several sources in one class ----------------------------------------------------------


def sources_run(spark: SparkSession, sf: str) -> list[Layers]:
    """Three sources mapped to one class."""
    mapped = {
        "events": (F.col("event_id"), instant("ts"), F.col("event_type")),
        "orders": (F.col("o_orderkey"), instant("o_orderdate"), F.col("o_orderstatus")),
        "pages": (F.col("page_id"), F.lit(0).cast("timestamp"), F.lit("page")),
    }
    runs = []
    for name, (uid, time, operation) in mapped.items():
        spec = GoldSpec(
            name="api_activity", input=name,
            fields=fields(
                {
                    "time": time,
                    **n.class_columns("api_activity"),
                    "api.operation": operation,
                    **n.metadata(name, "Acme", "acme", name, "parquet", uid=uid.cast("string")),
                }
            ),
        )
        runs.append(Layers(None, {}, {"api_activity": conform(to_gold(table(spark, sf, name), spec), "api_activity")}))
    return runs


UNION_SQL = """
    SELECT 'events' AS metadata_log_name, CAST(event_id AS VARCHAR) AS metadata_uid, event_type AS api_operation,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS time FROM events
    UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR), o_orderstatus, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') FROM orders
    UNION ALL SELECT 'pages', CAST(page_id AS VARCHAR), 'page', '1970-01-01 00:00:00' FROM pages"""


@query("union_sources", UNION_SQL)
def union_sources(spark, sf):
    merged = union_by_class(sources_run(spark, sf))["api_activity"]
    return flat(merged, "metadata.log_name metadata.uid api.operation", time=iso("time"))

