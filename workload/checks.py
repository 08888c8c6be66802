"""Quality checks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators.layers import to_gold
from siltstone.plans.chain import run_batch, summary
from siltstone.plans.ocsf import conform, mapping_problems
from siltstone.plans.spec import GoldSpec, fields
from siltstone.functions import normalize as n
from siltstone.operators.ingest import to_bronze
from siltstone.quality import discover, profile, schema
from workload.base import query, table
from workload.layers import events_bronze, events_flow


def labelled_documents(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return documents.join(table(spark, sf, "labels"), "doc_id", "left").withColumn("never", F.lit(None).cast("string"))


LABELLED = """WITH d AS (SELECT d.doc_id, lang, source, quality, toxic, NULL AS never
                  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def _profile_sql(columns, source="d"):
    arms = [
        f"SELECT '{name}' AS \"column\", count(*) AS rows, count(*) - count({sql}) AS null_count, "
        f"round((count(*) - count({sql})) * 100.0 / count(*), 1) AS null_pct FROM {source}"
        for name, sql in columns.items()
    ]
    return " UNION ALL ".join(arms)


@query("null_profile", f"{LABELLED} {_profile_sql({c: c for c in ('doc_id', 'lang', 'source', 'quality', 'toxic', 'never')})}")
def null_profile(spark, sf):
    return profile.null_profile(labelled_documents(spark, sf))


@query(
    "null_profile_nested",
    _profile_sql(
        {
            "event_id": "event_id", "who.id": "nullif(user_id % 4, 0)", "what.kind": "event_type",
            "what.size.cents": "CASE WHEN value > 20 THEN value END",
        },
        "events",
    ),
)
def null_profile_nested(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id",
        F.struct(F.nullif(F.col("user_id") % 4, F.lit(0)).alias("id")).alias("who"),
        F.struct(
            F.col("event_type").alias("kind"),
            F.struct(F.when(F.col("value") > 20, F.col("value")).alias("cents")).alias("size"),
        ).alias("what"),
    )
    return profile.null_profile(df, flatten=True)


@query("always_null", f"{LABELLED} SELECT 'never' AS \"column\" FROM d HAVING count(never) = 0")
def always_null(spark, sf):
    return profile.always_null(labelled_documents(spark, sf))


@query(
    "profile_compare",
    f"""
    {LABELLED}
    SELECT 'doc_id' AS "column", 0.0::DOUBLE AS null_pct_source, 0.0::DOUBLE AS null_pct_target, 'ok' AS status
    UNION ALL SELECT 'lang', 0.0, 0.0, 'ok'
    UNION ALL SELECT 'source', 0.0, round((count(*) - count(quality)) * 100.0 / count(*), 1),
      CASE WHEN (count(*) - count(quality)) * 100.0 / count(*) >= 80 THEN 'high null rate in target'
           WHEN (count(*) - count(quality)) * 100.0 / count(*) > 20 THEN 'null rate increased in target' ELSE 'ok' END FROM d
    UNION ALL SELECT 'n_chars', 0.0, NULL, 'missing from target'
    UNION ALL SELECT 'never', NULL, 100.0, 'new in target'
    UNION ALL SELECT 'text', 0.0, 100.0, 'high null rate in target'""",
)
def profile_compare(spark, sf):
    after = labelled_documents(spark, sf).select(
        F.col("doc_id").alias("DOC_ID"), "lang", F.when(F.col("quality").isNotNull(), F.col("source")).alias("source"),
        "never", F.col("never").alias("text"),
    )
    return profile.compare_profiles(table(spark, sf, "documents"), after, ignore_case=True)


def pages_spec():
    return GoldSpec(
        name="http_activity",
        input="s",
        fields=fields(
            {
                "time": F.lit(0).cast("timestamp"),
                **n.class_columns("http_activity"),
                "severity": F.lit(None).cast("string"),
                "status_code": F.when(F.col("page_id") % 10 == 0, F.lit("x")),
                "http_request.url": F.when(F.col("page_id") % 2 == 0, F.col("url")),
                "http_request.http_method": F.when(F.col("page_id") % 3 == 0, F.lit("GET")),
            }
        ),
    )


def pages_mapping(spark, sf):
    return to_gold(table(spark, sf, "pages"), pages_spec())


@query(
    "class_coverage",
    """
    WITH p AS (SELECT count(*) AS n, count(*) FILTER (page_id % 10 = 0) AS tenths FROM pages)
    SELECT name AS "column", n AS rows, n - filled AS null_count, round((n - filled) * 100.0 / n, 1) AS null_pct,
      CASE WHEN name IN ('time', 'category_uid', 'category_name', 'class_uid', 'class_name', 'type_uid', 'activity_id',
        'severity_id', 'severity') THEN 'yes' ELSE '' END AS required,
      CASE WHEN filled = n THEN 'ok' WHEN filled > 0 THEN 'high null rate'
        WHEN name IN ('type_uid', 'activity_id', 'severity_id', 'severity') THEN 'required field empty' ELSE 'completely empty' END AS status
    FROM (
      SELECT name, n, CASE WHEN name IN ('time', 'category_uid', 'category_name', 'class_uid', 'class_name', 'http_request') THEN n
                           WHEN name = 'status_code' THEN tenths ELSE 0 END AS filled
      FROM p, (SELECT unnest(['dsl_id', 'action', 'action_id', 'activity', 'activity_id', 'activity_name', 'app_name',
        'category_name', 'category_uid', 'class_name', 'class_uid', 'connection_info', 'disposition', 'disposition_id',
        'dst_endpoint', 'enrichments', 'file', 'firewall_rule', 'http_cookies', 'http_request', 'http_response', 'message',
        'metadata', 'observables', 'policy', 'raw_data', 'severity', 'severity_id', 'src_endpoint', 'status', 'status_code',
        'status_detail', 'status_id', 'time', 'timezone_offset', 'traffic', 'type_name', 'type_uid', 'unmapped']) AS name))""",
)
def class_coverage(spark, sf):
    return profile.class_coverage(conform(pages_mapping(spark, sf), "http_activity"))


@query(
    "mapping_coverage",
    """
    WITH p AS (SELECT count(*) AS n, count(*) FILTER (page_id % 10 = 0) AS tenths,
                      count(*) FILTER (page_id % 2 = 0 OR page_id % 3 = 0) AS either FROM pages)
    SELECT name AS "column", name IN ('time', 'category_uid', 'category_name', 'class_uid', 'class_name', 'severity',
      'status_code', 'http_request') AS mapped, n AS rows,
      round(CASE WHEN name IN ('time', 'category_uid', 'category_name', 'class_uid', 'class_name') THEN n
                 WHEN name = 'status_code' THEN tenths WHEN name = 'http_request' THEN either ELSE 0 END * 100.0 / n, 1) AS filled_pct
    FROM p, (SELECT unnest(['dsl_id', 'action', 'action_id', 'activity', 'activity_id', 'activity_name', 'app_name',
      'category_name', 'category_uid', 'class_name', 'class_uid', 'connection_info', 'disposition', 'disposition_id',
      'dst_endpoint', 'enrichments', 'file', 'firewall_rule', 'http_cookies', 'http_request', 'http_response', 'message',
      'metadata', 'observables', 'policy', 'raw_data', 'severity', 'severity_id', 'src_endpoint', 'status', 'status_code',
      'status_detail', 'status_id', 'time', 'timezone_offset', 'traffic', 'type_name', 'type_uid', 'unmapped']) AS name)""",
)
def mapping_coverage(spark, sf):
    return profile.mapping_coverage(pages_mapping(spark, sf), "http_activity")


@query(
    "mapping_problems",
    """
    SELECT 'missing' AS problem, unnest(['type_uid', 'activity_id', 'severity_id', 'metadata']) AS "column", count(*) AS rows,
      0::BIGINT AS filled FROM pages
    UNION ALL SELECT 'extra', 'page_id', count(*), count(*) FILTER (page_id % 3 = 0) FROM pages
    UNION ALL SELECT 'extra', 'host', count(*), count(url) FROM pages""",
)
def mapping_problems_query(spark, sf):
    more = {"page_id": F.when(F.col("page_id") % 3 == 0, F.col("page_id")), "host": F.parse_url("url", F.lit("HOST"))}
    spec = pages_spec()
    spec = GoldSpec(name=spec.name, input=spec.input, fields=(*spec.fields, *fields(more)))
    mapped = to_gold(table(spark, sf, "pages"), spec)
    return profile.problem_rows(mapped, mapping_problems(mapped, "http_activity"))


@query(
    "issue_counts",
    f"""
    {LABELLED}
    SELECT 'coverage' AS "check", CAST((SELECT count(*) FROM (SELECT 1 FROM d HAVING count(never) = 0))
      + (SELECT count(*) FROM (SELECT (count(*) - count(quality)) * 100.0 / count(*) AS p FROM d) WHERE p >= 50) * 2 AS BIGINT) AS issues
    UNION ALL SELECT 'schema', 3""",
)
def issue_counts(spark, sf):
    labelled = labelled_documents(spark, sf)
    coverage = profile.class_coverage(labelled, threshold=50.0)
    differences = schema.schema_diff(labelled, labelled.drop("never", "toxic").withColumn("more", F.lit(1)))
    differences = differences.withColumn(
        "status", F.when(F.col("status") == schema.MATCH, profile.OK).otherwise(F.col("status"))
    )
    return profile.issue_counts({"coverage": coverage, "schema": differences})


@query(
    "layer_summary",
    """
    SELECT 'bronze' AS layer, 'bronze' AS "table", count(*) AS row_count, 13 AS col_count FROM events
    UNION ALL SELECT 'silver', 'app_events_silver', count(*), 14 FROM events
    UNION ALL SELECT 'gold', 'api_activity', count(*), 36 FROM events""",
)
def layer_summary(spark, sf):
    return summary(run_batch(spark, events_flow(), bronze=events_bronze(spark, sf)))


@query(
    "end_to_end_sample",
    """
    SELECT 'bronze' AS layer, 'bronze' AS "table", least(100, count(*)) AS row_count, 13 AS col_count FROM events
    UNION ALL SELECT 'silver', 'app_events_silver', least(100, count(*)), 14 FROM events
    UNION ALL SELECT 'gold', 'api_activity', least(100, count(*)), 36 FROM events""",
)
def end_to_end_sample(spark, sf):
    """A trial run: the row cap is the feature, all layers run on the capped rows."""
    capped = table(spark, sf, "events").select("*", "_metadata").limit(100)
    flow = events_flow()
    return summary(run_batch(spark, flow, bronze=to_bronze(capped, flow.ingest)))


@query(
    "schema_diff",
    """
    WITH c AS (SELECT count(c_custkey) AS key, count(c_name) AS name, count(c_nationkey) AS nation, count(c_acctbal) AS bal,
                 count(c_mktsegment) AS segment FROM customer),
    s AS (SELECT count(s_suppkey) AS key, count(s_name) AS name, count(s_nationkey) AS nation,
            count(*) FILTER (s_acctbal > 0) AS bal FROM supplier)
    SELECT 'c_custkey' AS "column", 'bigint' AS type_source, NULL AS type_target, 'missing from target' AS status,
      c.key AS filled_source, NULL::BIGINT AS filled_target FROM c, s
    UNION ALL SELECT 'name', 'string', 'string', 'match', c.name, s.name FROM c, s
    UNION ALL SELECT 'nationkey', 'int', 'int', 'match', c.nation, s.nation FROM c, s
    UNION ALL SELECT 'acctbal', 'double', 'bigint', 'type mismatch', c.bal, s.bal FROM c, s
    UNION ALL SELECT 's_suppkey', NULL, 'bigint', 'new in target', NULL, s.key FROM c, s
    UNION ALL SELECT 'c_mktsegment', 'string', NULL, 'missing from target', c.segment, NULL FROM c, s""",
)
def schema_diff(spark, sf):
    customers = table(spark, sf, "customer").withColumnsRenamed(
        {"c_name": "NAME", "c_nationkey": "nationkey", "c_acctbal": "acctbal"}
    )
    suppliers = table(spark, sf, "supplier").select(
        "s_suppkey", F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
        F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).cast("bigint").alias("acctbal"),
    )
    return schema.filled_diff(customers, suppliers, ignore_case=True)


@query(
    "schema_diff_nested",
    """
    WITH e AS (SELECT count(event_id) AS id, count(*) FILTER (user_id % 3 = 0) AS thirds, count(user_id) AS users,
                 count(event_type) AS kinds, count(ts) AS days, count(*) AS n FROM events)
    SELECT 'event_id' AS "column", 'bigint' AS type_source, 'bigint' AS type_target, 'match' AS status, id AS filled_source, id AS filled_target FROM e
    UNION ALL SELECT 'who.id', 'bigint', 'bigint', 'match', users, thirds FROM e
    UNION ALL SELECT 'who.kind', 'string', NULL, 'missing from target', kinds, NULL FROM e
    UNION ALL SELECT 'who.at.day', 'date', 'string', 'type mismatch', days, days FROM e
    UNION ALL SELECT 'who.at.zone', NULL, 'string', 'new in target', NULL, n FROM e""",
)
def schema_diff_nested(spark, sf):
    events = table(spark, sf, "events")
    day = F.to_date("ts")
    source = events.select(
        "event_id",
        F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind"), F.struct(day.alias("day")).alias("at")).alias("who"),
    )
    target = events.select(
        "event_id",
        F.struct(
            F.when(F.col("user_id") % 3 == 0, F.col("user_id")).alias("id"),
            F.struct(day.cast("string").alias("day"), F.lit("UTC").alias("zone")).alias("at"),
        ).alias("who"),
    )
    return schema.filled_diff(source, target, flatten=True)


@query(
    "check_in_reading_order",
    f"""
    {LABELLED}, shares AS ({_profile_sql({c: c for c in ('doc_id', 'lang', 'source', 'quality', 'toxic', 'never')})})
    SELECT "column", null_pct, row_number() OVER (ORDER BY status DESC, "column") AS place FROM (
      SELECT *, CASE WHEN null_pct = 100 THEN 'completely empty' WHEN null_pct >= 50 THEN 'high null rate' ELSE 'ok' END AS status
      FROM shares)""",
)
def check_in_reading_order(spark, sf):
    result = profile.by_status(profile.class_coverage(labelled_documents(spark, sf), threshold=50.0, required=()))
    # One row per column of the table, so the order can be numbered in one place.
    return result.coalesce(1).select("column", "null_pct", (F.monotonically_increasing_id() + 1).alias("place"))


def _records(spark, sf):
    """Records of several shapes, as variants."""
    shape = F.when(
        F.col("event_type") == "error", F.to_json(F.struct(F.col("event_id").alias("id"), F.col("value").cast("string").alias("why")))
    ).otherwise(
        F.to_json(
            F.struct(F.col("event_id").alias("id"), F.when(F.col("user_id") % 2 == 0, F.col("user_id")).alias("user")),
            {"ignoreNullFields": "false"},
        )
    )
    return table(spark, sf, "events").select(F.parse_json(shape).alias("data"), F.col("_metadata.file_name").alias("file"))


@query(
    "discover_schema",
    "SELECT 'events.parquet' AS file, count(*) AS rows, 'OBJECT<id: BIGINT, user: BIGINT, why: STRING>' AS record_schema FROM events",
)
def discover_schema(spark, sf):
    return discover.schema_by_file(_records(spark, sf))


@query(
    "discover_keys",
    """
    SELECT 'id' AS key, count(*) AS present, count(*) AS filled FROM events
    UNION ALL SELECT 'user', count(*) FILTER (event_type <> 'error'), count(*) FILTER (event_type <> 'error' AND user_id % 2 = 0) FROM events
    UNION ALL SELECT 'why', count(*) FILTER (event_type = 'error'), count(*) FILTER (event_type = 'error') FROM events""",
)
def discover_keys(spark, sf):
    return discover.key_population(_records(spark, sf))


@query(
    "rows_as_json",
    """
    SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_nationkey > 10""",
)
def rows_as_json(spark, sf):
    suppliers = table(spark, sf, "supplier")
    rows = discover.rows_as_json(suppliers, where="s_nationkey > 10")
    return rows.select(F.from_json("row", suppliers.schema).alias("r")).select("r.s_suppkey", "r.s_name", "r.s_nationkey")

