"""Column builders over values derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions import codes
from siltstone.functions import normalize as n
from siltstone.operators.layers import to_gold
from siltstone.plans.spec import GoldSpec, fields
from siltstone.sources import cisco_ios
from siltstone.operators.ingest import to_bronze
from siltstone.operators.layers import to_silver
from siltstone.plans.spec import Ingest
from workload.base import iso, pairs, query, table
from workload.layers import events_silver

# Portable SQL for addresses made from keys: private, public and look-alike ranges.
SRC_ADDRESS = """CASE l_partkey % 6
    WHEN 0 THEN concat('10.', CAST(l_suppkey % 256 AS STRING), '.1.9')
    WHEN 1 THEN concat('192.168.', CAST(l_suppkey % 256 AS STRING), '.9')
    WHEN 2 THEN concat('172.', CAST(10 + l_suppkey % 30 AS STRING), '.2.9')
    WHEN 3 THEN concat('192.169.', CAST(l_suppkey % 256 AS STRING), '.9')
    WHEN 4 THEN concat('110.', CAST(l_suppkey % 256 AS STRING), '.1.9') END"""
DST_ADDRESS = """CASE l_orderkey % 5
    WHEN 0 THEN concat('10.', CAST(l_linenumber AS STRING), '.7.7')
    WHEN 1 THEN concat('172.', CAST(12 + l_orderkey % 25 AS STRING), '.0.7')
    WHEN 2 THEN concat('8.8.', CAST(l_linenumber AS STRING), '.8')
    WHEN 3 THEN concat('1.10.', CAST(l_linenumber AS STRING), '.8') END"""
# Whether each address is private, from the keys and not from the text.
SRC_PRIVATE = """CASE l_partkey % 6 WHEN 0 THEN true WHEN 1 THEN true WHEN 3 THEN false WHEN 4 THEN false
    WHEN 2 THEN l_suppkey % 30 BETWEEN 6 AND 21 END"""
DST_PRIVATE = """CASE l_orderkey % 5 WHEN 0 THEN true WHEN 2 THEN false WHEN 3 THEN false
    WHEN 1 THEN l_orderkey % 25 BETWEEN 4 AND 19 END"""
DIRECTION_SQL = """CASE WHEN sp AND dp THEN 3 WHEN sp AND NOT dp THEN 2 WHEN NOT sp AND dp THEN 1 ELSE 0 END"""


@query(
    "silver_syslog_parse",
    """
    SELECT event_id, CASE WHEN ok THEN CAST(event_id AS VARCHAR) END AS seq_no, CASE WHEN ok THEN 'APP' END AS facility,
           CASE WHEN ok THEN upper(event_type) END AS mnemonic,
           CASE WHEN ok THEN 'user ' || user_id || ' value ' || CAST(round(value * 100) AS BIGINT) END AS description,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS time,
           CASE WHEN NOT ok THEN 99 ELSE [6, 5, 5, 4, 3, 2, 1, 1, 99, 99][event_id % 10 + 1] END AS severity_id,
           CASE WHEN NOT ok THEN 'Other' ELSE ['Fatal', 'Critical', 'Critical', 'High', 'Medium', 'Low', 'Informational',
             'Informational', 'Other', 'Other'][event_id % 10 + 1] END AS severity
    FROM (SELECT *, event_id % 11 <> 0 AS ok FROM events)""",
)
def silver_syslog_parse(spark, sf):
    at = F.date_format(F.col("ts").cast("timestamp"), "MMM d yyyy HH:mm:ss")
    line = F.concat_ws(
        "",
        F.col("event_id"), F.lit(": "), at, F.when(F.col("event_id") % 11 != 0, ": %APP-").otherwise(": APP-"),
        F.col("event_id") % 10, F.lit("-"), F.upper("event_type"), F.lit(": user "), F.col("user_id"),
        F.lit(" value "), F.round(F.col("value") * 100).cast("bigint"),
    )
    ingest = Ingest(
        name="ios", format="text",
        pre=((n.ios_time(line).alias("time"), line.alias("value"), "event_id", "'app' as source"),),
    )
    parsed = to_silver(to_bronze(table(spark, sf, "events"), ingest), cisco_ios.parsed())
    level = n.syslog_severity(F.col("severity"))
    return parsed.select(
        "event_id", "seq_no", "facility", "mnemonic", "description", iso("time").alias("time"),
        level.alias("severity_id"), n.severity_name(level).alias("severity"),
    )


@query(
    "direction",
    f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {DIRECTION_SQL} AS direction_id,
           CASE WHEN l_linenumber = 7 THEN 1 WHEN l_linenumber = 6 THEN 2 ELSE {DIRECTION_SQL} END AS declared_id,
           ['Unknown', 'Inbound', 'Outbound', 'Lateral'][{DIRECTION_SQL} + 1] AS direction
    FROM (SELECT *, {SRC_PRIVATE} AS sp, {DST_PRIVATE} AS dp FROM lineitem)""",
)
def direction(spark, sf):
    src, dst = F.expr(SRC_ADDRESS), F.expr(DST_ADDRESS)
    declared = n.first_match([(F.col("l_linenumber") == 7, "ingress"), (F.col("l_linenumber") == 6, "egress")])
    here, there = F.col("src_private"), F.col("dst_private")
    code = n.direction_id(here, there)
    return (
        table(spark, sf, "lineitem")
        .select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            n.is_private(src).alias("src_private"), n.is_private(dst).alias("dst_private"),
        )
        .select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", code.alias("direction_id"),
            n.direction_id(here, there, declared).alias("declared_id"),
            n.direction_name(F.col("direction_id")).alias("direction"),
        )
    )


@query(
    "protocol",
    """
    SELECT l_orderkey, l_linenumber, num,
           CASE num WHEN 1 THEN 'icmp' WHEN 6 THEN 'tcp' WHEN 17 THEN 'udp' WHEN 47 THEN 'gre' WHEN 58 THEN 'icmpv6' END AS name,
           CASE num WHEN 1 THEN 1 WHEN 6 THEN 6 WHEN 17 THEN 17 END AS number_of_name,
           CASE l_linenumber % 4 WHEN 0 THEN 17 WHEN 1 THEN 6 WHEN 2 THEN 17 END AS dns_number
    FROM (SELECT *, [1, 6, 17, 47, 58, 2, 99][CAST(l_orderkey % 7 + 1 AS BIGINT)] AS num FROM lineitem)""",
)
def protocol(spark, sf):
    number = F.get(F.array(*(F.lit(v) for v in (1, 6, 17, 47, 58, 2, 99))), (F.col("l_orderkey") % 7).cast("int"))
    words = F.get(F.array(*(F.lit(v) for v in ("DoH", "dot", "udp", "sctp"))), F.col("l_linenumber") % 4)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", number.alias("num"), n.protocol_name(number).alias("name"),
        n.protocol_number(F.upper(n.protocol_name(number))).alias("number_of_name"),
        n.protocol_number(words, codes.DNS_TRANSPORT_NUMBERS).alias("dns_number"),
    )


@query(
    "flow_uid",
    """
    SELECT l_orderkey, l_linenumber, sha256(concat_ws('|', CAST(l_orderkey AS VARCHAR),
             CASE WHEN l_linenumber = 1 THEN '' ELSE CAST(l_partkey AS VARCHAR) END, l_returnflag,
             CAST(l_suppkey AS VARCHAR))) AS uid
    FROM lineitem""",
)
def flow_uid(spark, sf):
    part = F.when(F.col("l_linenumber") != 1, F.col("l_partkey"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        n.flow_uid(F.col("l_orderkey"), part, F.col("l_returnflag"), F.col("l_suppkey")).alias("uid"),
    )


RCODE_SQL = """
    SELECT l_orderkey, l_linenumber, code,
      CASE WHEN code IS NULL THEN 'Other'
           WHEN code <= 11 THEN ['NoError', 'FormError', 'ServError', 'NXDomain', 'NotImp', 'Refused', 'YXDomain', 'YXRRSet',
             'NXRRSet', 'NotAuth', 'NotZone', 'DSOTYPENI'][code + 1]
           WHEN code <= 15 THEN 'Unassigned'
           WHEN code <= 23 THEN ['BADSIG_VERS', 'BADKEY', 'BADTIME', 'BADMODE', 'BADNAME', 'BADALG', 'BADTRUNC',
             'BADCOOKIE'][code - 15]
           WHEN code <= 3840 THEN 'Unassigned' WHEN code <= 4095 THEN 'Reserved' WHEN code < 65535 THEN 'Unassigned'
           WHEN code = 65535 THEN 'Reserved' ELSE 'Other' END AS rcode,
      CASE WHEN code = 0 THEN 'Success' WHEN code BETWEEN 1 AND 65534 THEN 'Failure' ELSE 'Unknown' END AS status,
      CASE WHEN code = 0 THEN 1 WHEN code IS NULL THEN 0 ELSE 2 END AS status_id,
      CASE WHEN code = 3 THEN 'Non-Existent Domain' WHEN code = 23 THEN 'Bad or Missing Server Cookie'
           WHEN code = 0 THEN 'No Error' END AS some_detail
    FROM (SELECT *, CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN 3800 + l_partkey % 400
                         WHEN l_linenumber = 5 THEN 65500 + l_partkey % 50 ELSE l_partkey % 30 END AS code FROM lineitem)"""


@query("dns_rcode", RCODE_SQL)
def dns_rcode(spark, sf):
    code = F.expr(
        "cast(CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN 3800 + l_partkey % 400 "
        "WHEN l_linenumber = 5 THEN 65500 + l_partkey % 50 ELSE l_partkey % 30 END as int)"
    )
    c = F.col("code")
    return (
        table(spark, sf, "lineitem")
        .select("l_orderkey", "l_linenumber", code.alias("code"))
        .select(
            "*", n.dns_rcode_name(c).alias("rcode"), n.dns_status(c).alias("status"),
            n.dns_status_id(c).alias("status_id"),
            F.when(c.isin(0, 3, 23), n.dns_rcode_detail(c)).alias("some_detail"),
        )
    )


@query(
    "dns_answers",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber > 2 THEN 2 END AS n_answers,
           CASE WHEN l_linenumber > 2 THEN '10.0.0.' || l_linenumber END AS first_rdata,
           CASE WHEN l_linenumber > 2 THEN CAST(l_partkey AS INTEGER) END AS first_ttl, NULL::INTEGER AS second_ttl,
           CASE WHEN l_linenumber > 2 THEN 'TXT' END AS second_type
    FROM lineitem""",
)
def dns_answers(spark, sf):
    record = lambda kind, ttl, rdata: F.create_map(
        F.lit("class"), F.lit("IN"), F.lit("type"), F.lit(kind), F.lit("ttl"), ttl, F.lit("rdata"), rdata
    )
    records = F.when(
        F.col("l_linenumber") > 2,
        F.array(
            record("A", F.col("l_partkey").cast("string"), F.concat(F.lit("10.0.0."), F.col("l_linenumber"))),
            record("TXT", F.lit("soon"), F.lit("text")),
        ),
    ).when(F.col("l_linenumber") == 2, F.array().cast("array<map<string,string>>"))
    answers = F.col("answers")
    return (
        table(spark, sf, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey", n.dns_answers(records).alias("answers"))
        .select(
            "l_orderkey", "l_linenumber", "l_partkey",
            F.when(answers.isNotNull(), F.size(answers)).alias("n_answers"),
            F.get(answers, F.lit(0))["rdata"].alias("first_rdata"),
            F.get(answers, F.lit(0))["ttl"].alias("first_ttl"),
            F.get(answers, F.lit(1))["ttl"].alias("second_ttl"),
            F.get(answers, F.lit(1))["type"].alias("second_type"),
        )
    )


@query(
    "first_typed_target",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'u' || o_custkey WHEN o_orderstatus = 'O' THEN 'v' || o_custkey END AS user_id,
           CASE WHEN o_orderstatus = 'F' THEN 'g' || o_orderkey END AS group_id
    FROM orders""",
)
def first_typed_target(spark, sf):
    one = lambda kind, mark, key: F.struct(F.lit(kind).alias("type"), F.concat(F.lit(mark), F.col(key)).alias("id"))
    targets = (
        F.when(
            F.col("o_orderstatus") == "F",
            F.array(one("UserGroup", "g", "o_orderkey"), one("User", "u", "o_custkey"), one("User", "w", "o_custkey")),
        )
        .when(F.col("o_orderstatus") == "O", F.array(one("User", "v", "o_custkey")))
        .otherwise(F.array(one("Other", "x", "o_custkey")))
    )
    return table(spark, sf, "orders").select("o_orderkey", targets.alias("t")).select(
        "o_orderkey", n.first_of_type(F.col("t"), "User")["id"].alias("user_id"),
        n.first_of_type(F.col("t"), "UserGroup")["id"].alias("group_id"),
    )


@query(
    "message_text",
    """
    SELECT event_id, 'event ' || event_type || ' by ' || coalesce(CASE WHEN user_id % 4 <> 0 THEN CAST(user_id AS VARCHAR) END, 'unknown')
           || ':' || event_id AS message
    FROM events""",
)
def message_text(spark, sf):
    who = F.when(F.col("user_id") % 4 != 0, F.col("user_id"))
    return table(spark, sf, "events").select(
        "event_id",
        n.sentence("event ", F.col("event_type"), " by ", (who, "unknown"), ":", (F.col("event_id"), "")).alias("message"),
    )


@query(
    "outcome_status",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 0 END AS status_id,
           CASE o_orderstatus WHEN 'F' THEN 'Success' WHEN 'O' THEN 'Failure' ELSE 'Unknown' END AS status,
           CASE o_orderstatus WHEN 'F' THEN 'Allowed' WHEN 'O' THEN 'Denied' ELSE 'Unknown' END AS action,
           CASE o_orderstatus WHEN 'F' THEN 'Allowed' WHEN 'O' THEN 'Blocked' ELSE 'Unknown' END AS disposition,
           CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 4 ELSE 0 END AS severity_id,
           CASE o_orderstatus WHEN 'F' THEN 'Informational' WHEN 'O' THEN 'High' ELSE 'Unknown' END AS severity
    FROM orders""",
)
def outcome_status(spark, sf):
    word = n.lookup(F.col("o_orderstatus"), {"F": "SUCCESS", "O": "DENY", "P": "CHALLENGE"})
    level = n.word_severity(n.lookup(F.col("o_orderstatus"), {"F": "DEBUG", "O": "ERROR"}))
    status = n.lookup(word, codes.OUTCOME_STATUS, 0)
    return table(spark, sf, "orders").select(
        "o_orderkey", status.alias("status_id"), n.status_name(F.col("status_id")).alias("status"),
        n.action_name(F.col("status_id")).alias("action"), n.disposition_name(F.col("status_id")).alias("disposition"),
        level.alias("severity_id"), n.severity_name(F.col("severity_id")).alias("severity"),
    )


@query(
    "time_fallback",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber <= 2 THEN 'now' ELSE strftime(make_timestamp(CASE WHEN l_linenumber > 4
             THEN 1700000000 + l_orderkey ELSE 1600000000 + l_partkey END * 1000000), '%Y-%m-%d %H:%M:%S') END AS time
    FROM lineitem""",
)
def time_fallback(spark, sf):
    start = F.when(F.col("l_linenumber") > 4, F.lit(1700000000).cast("bigint") + F.col("l_orderkey"))
    end = F.when(F.col("l_linenumber") > 2, F.lit(1600000000).cast("bigint") + F.col("l_partkey"))
    time = n.event_time(start, end)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(time >= F.current_timestamp(), "now").otherwise(iso(time)).alias("time"),
    )


@query(
    "observables",
    """
    SELECT event_id, concat_ws(';', CASE WHEN c_acctbal > 0 THEN 'user.name=' || c_name END, 'operation=' || event_type,
             CASE WHEN user_id % 3 <> 0 THEN 'user.uid=' || user_id END) AS observables,
           concat_ws(';', CASE WHEN c_acctbal > 0 THEN 'segment=' || c_mktsegment END, 'kind=event') AS enrichments,
           CASE WHEN event_type = 'view' THEN 'word=a;word=' || c_mktsegment ELSE '' END AS words
    FROM events LEFT JOIN customer ON c_custkey = user_id""",
)
def observables(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    df = table(spark, sf, "events").join(customers, F.col("c_custkey") == F.col("user_id"), "left")
    rich = F.col("c_acctbal") > 0
    words = F.when(F.col("event_type") == "view", F.array(F.lit("a"), F.lit(None), F.col("c_mktsegment")))
    made = df.select(
        "event_id",
        n.observables(
            [
                ("user.name", "User Name", F.when(rich, F.col("c_name"))),
                ("operation", "Other", F.col("event_type")),
                ("user.uid", "User", F.when(F.col("user_id") % 3 != 0, F.col("user_id"))),
            ]
        ).alias("o"),
        n.enrichments([("segment", F.when(rich, F.col("c_mktsegment"))), ("kind", F.lit("event"))]).alias("e"),
        n.enrichments_of("word", words).alias("w"),
    )
    return made.select(
        "event_id", pairs("o").alias("observables"), pairs("e").alias("enrichments"), pairs("w").alias("words")
    )


@query(
    "raw_unmapped",
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS payload_k, 'app' AS source,
           'events' AS sourcetype, event_type AS left_type, user_id AS left_user, true AS is_object
    FROM events""",
)
def raw_unmapped(spark, sf):
    spec = GoldSpec(
        name="g", input="s",
        fields=fields(
            {
                "event_id": F.col("event_id"),
                "raw_data": n.raw_record(F.col("data")),
                "unmapped": n.unmapped(["event_type", "user_id"]),
            }
        ),
    )
    df = to_gold(events_silver(spark, sf), spec)
    at = lambda path, kind, where="raw_data": F.try_variant_get(where, path, kind)
    return df.select(
        "event_id", at("$.payload.k", "int").alias("payload_k"), at("$.source", "string").alias("source"),
        at("$.sourcetype", "string").alias("sourcetype"), at("$.event_type", "string", "unmapped").alias("left_type"),
        at("$.user_id", "bigint", "unmapped").alias("left_user"),
        F.schema_of_variant("raw_data").startswith("OBJECT").alias("is_object"),
    )
