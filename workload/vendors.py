"""The six log sources: raw records made from the tables, mapped, and checked.

Attributes of a record are portable SQL over table columns.  Spark writes them into a
raw record and parses that record; the oracle computes the class values from the
attributes directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.ingest import to_bronze
from siltstone.plans.chain import run_batch
from siltstone.plans.spec import Flow
from siltstone.sources import aws_vpc, cisco_ios, cloudflare_dns, github_audit, okta, zeek
from workload.base import flat, iso, pairs, query, table
from workload.normalising import DIRECTION_SQL, DST_ADDRESS, DST_PRIVATE, SRC_ADDRESS, SRC_PRIVATE


def pick(expression: str, values) -> str:
    """CASE over 0..n-1; a None value is left out and so becomes NULL."""
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE {expression} % {len(values)} {arms} END"


def attributes(columns: dict[str, str], source: str) -> str:
    """The attributes as a common table for the oracle."""
    return f"WITH r AS (SELECT *, {', '.join(f'{sql} AS {name}' for name, sql in columns.items())} FROM {source})"


def mapped(spark: SparkSession, sf: str, source: str, columns: dict[str, str], record: Column, flow: Flow, name: str) -> DataFrame:
    """One class of a flow over raw records that hold the attributes."""
    payload = flow.ingest.payload
    with_attributes = table(spark, sf, source).select("*", "_metadata").withColumns(
        {n: F.expr(sql) for n, sql in columns.items()}
    )
    raw = with_attributes.select(record.alias(payload), "_metadata")
    return run_batch(spark, flow, bronze=to_bronze(raw, flow.ingest), tables=[name]).gold[name]


def json_record(**members: Column) -> Column:
    return F.parse_json(F.to_json(F.struct(*(c.alias(n) for n, c in members.items()))))


def at(path: str, kind: str = "string", where: str = "unmapped") -> Column:
    return F.try_variant_get(where, path, kind)


# -- Zeek ---------------------------------------------------------------------------------

ZEEK = {
    "epoch": "CAST(1700000000 + l_orderkey AS BIGINT)",
    "uid": "concat('C', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))",
    "src": SRC_ADDRESS,
    "dst": DST_ADDRESS,
    "src_port": "CASE WHEN l_linenumber < 7 THEN 1000 + l_partkey END",
    "dst_port": "l_suppkey",
    "proto": pick("l_orderkey", ["tcp", "UDP", "icmp", None, "gre"]),
    "state": pick(
        "l_partkey",
        ["S0", "S1", "SF", "REJ", "S2", "S3", "RSTO", "RSTR", "RSTOS0", "RSTRH", "SH", "SHR", "OTH", "WEIRD", None],
    ),
    "seconds": "CASE WHEN l_linenumber > 3 THEN l_quantity + 0.75 END",
    "sent": "l_partkey",
    "got": "CASE WHEN l_linenumber > 1 THEN l_suppkey END",
    "mac": "CASE WHEN l_partkey % 3 > 0 THEN concat('02:00:', CAST(l_partkey AS STRING)) END",
    "service": pick("l_suppkey", ["dns", "http", None]),
    "history": pick("l_orderkey", ["ShADadFf", "S", None]),
    "packets_sent": "CASE WHEN l_linenumber < 6 THEN l_linenumber END",
    "packets_got": "CASE WHEN l_linenumber > 2 THEN l_partkey END",
    "missed": "CASE WHEN l_linenumber = 4 THEN l_orderkey END",
    "is_local": "l_partkey % 2 = 0",
}

ZEEK_SQL = f"""
{attributes(ZEEK, "lineitem")},
s AS (SELECT *, {SRC_PRIVATE} AS sp, {DST_PRIVATE} AS dp,
  CASE WHEN state IN ('SF', 'RSTO', 'RSTR', 'RSTRH', 'SH', 'SHR') THEN 2 WHEN state = 'S0' THEN 4 WHEN state = 'REJ' THEN 3
       ELSE 6 END AS aid,
  CASE state WHEN 'S0' THEN 'Connection attempt seen, no reply' WHEN 'S1' THEN 'Connection established, not terminated'
    WHEN 'SF' THEN 'Normal establishment and termination' WHEN 'REJ' THEN 'Connection attempt rejected'
    WHEN 'S2' THEN 'Connection established and close attempt by originator seen'
    WHEN 'S3' THEN 'Connection established and close attempt by responder seen'
    WHEN 'RSTO' THEN 'Connection established, originator aborted' WHEN 'RSTR' THEN 'Responder sent a RST'
    WHEN 'RSTOS0' THEN 'Originator sent a SYN followed by a RST' WHEN 'RSTRH' THEN 'Responder sent a SYN ACK followed by a RST'
    WHEN 'SH' THEN 'Originator sent a SYN followed by a FIN' WHEN 'SHR' THEN 'Responder sent a SYN ACK followed by a FIN'
    WHEN 'OTH' THEN 'No SYN seen, just midstream traffic' ELSE state END AS detail FROM r),
t AS (SELECT *, CASE aid WHEN 2 THEN 'Close' WHEN 4 THEN 'Fail' WHEN 3 THEN 'Refuse' ELSE 'Traffic' END AS aname FROM s)
SELECT strftime(make_timestamp(epoch * 1000000), '%Y-%m-%d %H:%M:%S') AS time, aid AS activity_id, aname AS activity_name,
  CASE WHEN state = 'REJ' THEN 2 WHEN state IN ('S0', 'S1', 'RSTOS0', 'OTH') THEN 0 ELSE 1 END AS action_id,
  CASE WHEN state = 'REJ' THEN 'Denied' WHEN state IN ('S0', 'S1', 'RSTOS0', 'OTH') THEN 'Failed' ELSE 'Allowed' END AS action,
  CASE WHEN state = 'REJ' THEN 2 WHEN state IN ('S0', 'RSTOS0') THEN 4 ELSE 1 END AS disposition_id,
  CASE WHEN state = 'REJ' THEN 'Blocked' WHEN state IN ('S0', 'RSTOS0') THEN 'Failed' ELSE 'Allowed' END AS disposition,
  CASE WHEN aid = 4 THEN 2 ELSE 1 END AS status_id, CASE WHEN aid = 4 THEN 'Failure' ELSE 'Success' END AS status,
  state AS status_code, detail AS status_detail, 400100 + aid AS type_uid, 'Network Activity: ' || aname AS type_name,
  strftime(make_timestamp((epoch + CAST(floor(seconds) AS BIGINT)) * 1000000), '%Y-%m-%d %H:%M:%S') AS end_time,
  src AS src_endpoint_ip, src_port AS src_endpoint_port, dst AS dst_endpoint_ip, dst_port AS dst_endpoint_port,
  lower(proto) AS connection_info_protocol_name,
  CASE lower(proto) WHEN 'icmp' THEN 1 WHEN 'tcp' THEN 6 WHEN 'udp' THEN 17 END AS connection_info_protocol_num,
  {DIRECTION_SQL} AS connection_info_direction_id, sent AS traffic_bytes_out, got AS traffic_bytes_in,
  sent + got AS traffic_bytes, packets_sent AS traffic_packets_out, packets_got AS traffic_packets_in,
  packets_sent + packets_got AS traffic_packets, missed AS traffic_bytes_missed, mac AS src_endpoint_mac,
  NULL::VARCHAR AS dst_endpoint_mac, service AS dst_endpoint_svc_name, history AS connection_info_flag_history,
  uid AS connection_info_uid, is_local AS left_local, 'Zeek' AS metadata_product_vendor_name, uid AS metadata_uid, seconds AS left_seconds, uid AS payload_uid,
  'Network connection ' || aname || ' from ' || coalesce(src, 'unknown') || ':' || coalesce(CAST(src_port AS VARCHAR), '?')
    || ' to ' || coalesce(dst, 'unknown') || ':' || dst_port || ' (' || coalesce(upper(proto), 'unknown') || ') - ' || detail
    AS message
FROM t"""


@query("zeek_network_activity", ZEEK_SQL)
def zeek_network_activity(spark, sf):
    c = F.col
    record = json_record(
        **{
            "ts": c("epoch"), "uid": c("uid"), "id.orig_h": c("src"), "id.orig_p": c("src_port"), "id.resp_h": c("dst"),
            "id.resp_p": c("dst_port"), "proto": c("proto"), "conn_state": c("state"), "duration": c("seconds"),
            "orig_bytes": c("sent"), "resp_bytes": c("got"), "orig_l2_addr": c("mac"), "service": c("service"),
            "history": c("history"), "orig_pkts": c("packets_sent"), "resp_pkts": c("packets_got"), "missed_bytes": c("missed"),
            "local_orig": c("is_local"),
        }
    )
    gold = mapped(spark, sf, "lineitem", ZEEK, record, zeek.flow(), "network_activity")
    return flat(
        gold,
        "activity_id activity_name action_id action disposition_id disposition status_id status status_code "
        "status_detail type_uid type_name src_endpoint.ip src_endpoint.port dst_endpoint.ip dst_endpoint.port "
        "connection_info.protocol_name connection_info.protocol_num connection_info.direction_id traffic.bytes_out "
        "traffic.bytes_in traffic.bytes traffic.packets_out traffic.packets_in traffic.packets traffic.bytes_missed "
        "src_endpoint.mac dst_endpoint.mac dst_endpoint.svc_name connection_info.flag_history connection_info.uid "
        "metadata.product.vendor_name metadata.uid message",
        time=iso("time"), end_time=iso("end_time"), left_seconds=at("$.duration", "double"),
        left_local=at("$.local_orig", "boolean"),
        payload_uid=at("$.payload.uid", "string", "raw_data"),
    )


# -- AWS VPC flow logs ------------------------------------------------------------------------

VPC = {
    "account": "concat('a', CAST(l_suppkey AS STRING))",
    "eni": "concat('eni-', CAST(l_partkey AS STRING))",
    "src": SRC_ADDRESS,
    "dst": DST_ADDRESS,
    "src_port": "CASE WHEN l_linenumber < 7 THEN 1000 + l_partkey END",
    "proto": "CASE l_orderkey % 7 WHEN 0 THEN 1 WHEN 1 THEN 6 WHEN 2 THEN 17 WHEN 3 THEN 47 WHEN 4 THEN 58 WHEN 5 THEN 99 END",
    "verdict": pick("l_orderkey", ["ACCEPT", "REJECT", None]),
    "log": pick("l_linenumber", ["OK", "NODATA", "SKIPDATA", None, "OK", "ODD"]),
    "pkt_src": "CASE WHEN l_partkey % 4 = 0 THEN '9.9.9.9' END",
    "reason": "CASE WHEN l_suppkey % 5 = 0 THEN 'BPA' END",
    "flow": "CASE l_linenumber WHEN 7 THEN 'ingress' WHEN 6 THEN 'egress' END",
    "started": "CAST(1600000000 + l_orderkey AS BIGINT)",
    "size": "CAST(l_quantity AS BIGINT)",
    "packets": "CASE WHEN l_linenumber <> 2 THEN l_linenumber END",
    "vpc": "concat('vpc-', CAST(l_suppkey % 9 AS STRING))",
    "zone": pick("l_suppkey", ["use1-az1", "use1-az2", None]),
    "region": pick("l_partkey", ["us-east-1", None]),
    "service": pick("l_partkey", ["S3", None, "DYNAMODB"]),
    "instance": "CASE WHEN l_orderkey % 2 = 0 THEN concat('i-', CAST(l_orderkey AS STRING)) END",
}

VPC_SQL = f"""
{attributes(VPC, "lineitem")},
s AS (SELECT *, {SRC_PRIVATE} AS sp, {DST_PRIVATE} AS dp, coalesce(pkt_src, src) AS real_src FROM r)
SELECT strftime(make_timestamp(started * 1000000), '%Y-%m-%d %H:%M:%S') AS time,
  strftime(make_timestamp((started + 60) * 1000000), '%Y-%m-%d %H:%M:%S') AS end_time, 6 AS activity_id, 400106 AS type_uid,
  'Network Activity: Traffic' AS type_name, CASE WHEN verdict = 'REJECT' THEN 3 ELSE 1 END AS severity_id,
  CASE WHEN verdict = 'REJECT' THEN 'Medium' ELSE 'Informational' END AS severity,
  CASE WHEN log = 'OK' THEN 1 WHEN log IN ('NODATA', 'SKIPDATA') THEN 99 ELSE 0 END AS status_id,
  CASE WHEN log = 'OK' THEN 'Success' WHEN log IN ('NODATA', 'SKIPDATA') THEN 'Other' ELSE 'Unknown' END AS status,
  CASE WHEN log = 'OK' AND reason IS NOT NULL THEN 'Flow rejected: ' || reason WHEN log = 'OK' THEN 'Flow log recorded'
    WHEN log = 'NODATA' THEN 'No data during aggregation interval' WHEN log = 'SKIPDATA'
    THEN 'Data skipped during aggregation interval' ELSE coalesce(log, 'Unknown') END AS status_detail,
  CASE verdict WHEN 'ACCEPT' THEN 1 WHEN 'REJECT' THEN 2 ELSE 0 END AS action_id,
  CASE verdict WHEN 'ACCEPT' THEN 'Allowed' WHEN 'REJECT' THEN 'Denied' ELSE 'Unknown' END AS action,
  CASE verdict WHEN 'ACCEPT' THEN 'Allowed' WHEN 'REJECT' THEN 'Blocked' ELSE 'Unknown' END AS disposition,
  real_src AS src_endpoint_ip, src_port AS src_endpoint_port, dst AS dst_endpoint_ip, proto AS connection_info_protocol_num,
  CASE proto WHEN 1 THEN 'icmp' WHEN 6 THEN 'tcp' WHEN 17 THEN 'udp' WHEN 47 THEN 'gre' WHEN 58 THEN 'icmpv6' END
    AS connection_info_protocol_name,
  CASE flow WHEN 'ingress' THEN 1 WHEN 'egress' THEN 2 ELSE {DIRECTION_SQL} END AS connection_info_direction_id,
  sha256(concat_ws('|', eni, coalesce(src, ''), coalesce(CAST(src_port AS VARCHAR), ''), coalesce(dst, ''), '443',
    coalesce(CAST(proto AS VARCHAR), ''), CAST(started AS VARCHAR))) AS connection_info_uid,
  size AS traffic_bytes, packets AS traffic_packets, vpc AS src_endpoint_vpc_uid, zone AS src_endpoint_zone,
  region AS cloud_region, 'AWS' AS cloud_provider, service AS src_endpoint_svc_name, service AS dst_endpoint_svc_name,
  instance AS src_endpoint_instance_uid, eni AS src_endpoint_interface_uid, 443 AS dst_endpoint_port, log AS status_code,
  strftime(make_timestamp(started * 1000000), '%Y-%m-%d %H:%M:%S') AS start_time, account AS cloud_account_uid, reason AS left_reason,
  CASE WHEN src IS NULL AND dst IS NULL THEN coalesce(log, 'NODATA') || ' on eni=' || eni
    ELSE coalesce(verdict, '') || ' ' || coalesce(src, '') || ':' || coalesce(CAST(src_port AS VARCHAR), '') || ' -> '
      || coalesce(dst, '') || ':443 eni=' || eni END AS message,
  concat_ws(';', 'src_endpoint.ip=' || real_src, 'dst_endpoint.ip=' || dst, 'src_endpoint.port=' || src_port,
    'dst_endpoint.port=443', 'cloud.account.uid=' || account, 'src_endpoint.interface_uid=' || eni) AS observed
FROM s"""


@query("vpc_network_activity", VPC_SQL)
def vpc_network_activity(spark, sf):
    dash = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("-"))
    record = F.to_variant_object(
        F.struct(
            *(
                column.alias(key)
                for key, column in {
                    "account-id": F.col("account"), "interface-id": F.col("eni"), "srcaddr": dash("src"),
                    "dstaddr": dash("dst"), "srcport": F.col("src_port"), "dstport": F.lit(443),
                    "protocol": F.col("proto"), "action": dash("verdict"), "log-status": dash("log"),
                    "pkt-srcaddr": dash("pkt_src"), "reject-reason": dash("reason"), "flow-direction": dash("flow"),
                    "start": F.col("started"), "end": F.col("started") + 60, "bytes": F.col("size"), "packets": F.col("packets"),
                    "vpc-id": F.col("vpc"), "az-id": dash("zone"), "region": dash("region"), "instance-id": dash("instance"),
                    "pkt-src-aws-service": dash("service"), "pkt-dst-aws-service": dash("service"),
                }.items()
            )
        )
    )
    gold = mapped(spark, sf, "lineitem", VPC, record, aws_vpc.flow(), "network_activity")
    return flat(
        gold,
        "activity_id type_uid type_name severity_id severity status_id status status_detail action_id action "
        "disposition src_endpoint.ip src_endpoint.port dst_endpoint.ip connection_info.protocol_num "
        "connection_info.protocol_name connection_info.direction_id connection_info.uid traffic.bytes traffic.packets "
        "src_endpoint.vpc_uid src_endpoint.zone cloud.region cloud.provider src_endpoint.svc_name dst_endpoint.svc_name "
        "src_endpoint.instance_uid src_endpoint.interface_uid dst_endpoint.port status_code cloud.account.uid message",
        time=iso("time"), start_time=iso("start_time"), end_time=iso("end_time"), observed=pairs("observables"), left_reason=at("$.reject_reason"),
    )


# -- Cisco IOS -----------------------------------------------------------------------------------

IOS = {
    "who": "concat('u', CAST(user_id AS STRING))",
    "addr": "concat('10.1.', CAST(user_id % 200 AS STRING), '.9')",
    "kind": "event_id % 10",
}
_IOS_LINES = [
    "concat('%SEC_LOGIN-5-LOGIN_SUCCESS: Login Success [user: ', who, '] [Source: ', addr, '] [localport: 22]')",
    "concat('%SEC_LOGIN-4-LOGIN_FAILED: Login failed [user: ', who, '] [Source: none] [localport: x]')",
    "concat('%SYS-6-LOGOUT: User ', who, ' has exited tty session (', addr, ')')",
    "concat('%LINK-3-UPDOWN: Interface Gi0/', CAST(user_id AS STRING), ', changed state to up')",
    "concat('%LINEPROTO-5-UPDOWN: Line protocol on Interface Gi0/', CAST(user_id AS STRING), ', changed state to down')",
    "concat('%PARSER-4-CLI_DENIED: User ', who, ' attempted to reload now')",
    "concat('%SYS-5-CONFIG_I: Configured from console by ', who, ' on vty0')",
    "'%CPU-2-FAILURE: CPU 1 stopped'",
    "concat('%SYS-5-RELOAD: Reload requested by user ', who, ' on console')",
    "'%AAA-7-LOGIN: nothing known'",
]


def _ios(spark, sf, name):
    text = "CASE kind " + " ".join(f"WHEN {i} THEN {line}" for i, line in enumerate(_IOS_LINES)) + " END"
    at_time = F.date_format(F.col("ts").cast("timestamp"), "MMM d yyyy HH:mm:ss")
    record = F.concat_ws(": ", F.col("event_id").cast("string"), at_time, F.expr(text))
    return mapped(spark, sf, "events", IOS, record, cisco_ios.flow(), name)


IOS_TIME = "strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, CAST(event_id AS VARCHAR) AS metadata_uid"


@query(
    "ios_authentication",
    f"""
    {attributes(IOS, "events")}
    SELECT {IOS_TIME}, [1, 2, 2, 0][i] AS activity_id, ['Logon', 'Logoff', 'Logoff', 'Unknown'][i] AS activity_name,
      [300201, 300202, 300202, 300200][i] AS type_uid, [1, 2, 1, 99][i] AS action_id,
      ['Allowed', 'Denied', 'Allowed', 'Other'][i] AS action, [1, 2, 1, 99][i] AS status_id,
      ['Success', 'Failure', 'Success', 'Other'][i] AS status, [1, 2, 1, 0][i] AS disposition_id,
      ['Allowed', 'Blocked', 'Allowed', 'Unknown'][i] AS disposition, [2, 3, 1, 1][i] AS severity_id,
      ['Low', 'Medium', 'Informational', 'Informational'][i] AS severity, [true, false, true, false][i] AS is_remote,
      CASE WHEN i = 4 THEN '' ELSE who END AS user_name, CASE WHEN i IN (1, 3) THEN addr ELSE '' END AS src_endpoint_ip,
      CASE WHEN i = 1 THEN 22 END AS src_endpoint_port,
      CASE i WHEN 2 THEN 'user.name=' || who WHEN 4 THEN '' ELSE 'src_endpoint.ip=' || addr || ';user.name=' || who END AS observed,
      ['5', '4', '6', '7'][i] AS left_severity
    FROM (SELECT *, CASE kind WHEN 9 THEN 4 ELSE kind + 1 END AS i FROM r WHERE kind IN (0, 1, 2, 9))""",
)
def ios_authentication(spark, sf):
    return flat(
        _ios(spark, sf, "authentication"),
        "activity_id activity_name type_uid action_id action status_id status disposition_id disposition severity_id "
        "severity is_remote user.name src_endpoint.ip src_endpoint.port metadata.uid",
        time=iso("time"), observed=pairs("observables"), left_severity=at("$.severity"),
    )


@query(
    "ios_authorize_session",
    f"""
    {attributes(IOS, "events")}
    SELECT {IOS_TIME}, 300399 AS type_uid, 'Denied' AS action, 'Failure' AS status, 'CLI_DENIED' AS status_code,
      'Medium' AS severity, who AS user_name, 'reload' AS dst_endpoint_svc_name,
      'User ' || who || ' attempted to reload now' AS message
    FROM r WHERE kind = 5""",
)
def ios_authorize_session(spark, sf):
    return flat(
        _ios(spark, sf, "authorize_session"),
        "type_uid action status status_code severity user.name dst_endpoint.svc_name message metadata.uid",
        time=iso("time"),
    )


@query(
    "ios_network_activity",
    f"""
    {attributes(IOS, "events")}
    SELECT {IOS_TIME}, CASE kind WHEN 3 THEN 1 ELSE 2 END AS activity_id,
      'Network Activity: ' || CASE kind WHEN 3 THEN 'Open' ELSE 'Close' END AS type_name,
      CASE kind WHEN 3 THEN 'Allowed' ELSE 'Blocked' END AS action, CASE kind WHEN 3 THEN 1 ELSE 2 END AS disposition_id,
      CASE kind WHEN 3 THEN 'High' ELSE 'Low' END AS severity, 99 AS status_id,
      CASE kind WHEN 3 THEN 'LINK' ELSE 'LINEPROTO' END AS connection_info_protocol_name,
      'Gi0/' || user_id AS dst_endpoint_interface_name
    FROM r WHERE kind IN (3, 4)""",
)
def ios_network_activity(spark, sf):
    return flat(
        _ios(spark, sf, "network_activity"),
        "activity_id type_name action disposition_id severity status_id connection_info.protocol_name "
        "dst_endpoint.interface_name metadata.uid",
        time=iso("time"),
    )


@query(
    "ios_process_activity",
    f"""
    {attributes(IOS, "events")}
    SELECT {IOS_TIME}, 100799 AS type_uid, CASE WHEN kind = 7 THEN 'Failed' ELSE 'Allowed' END AS action,
      CASE WHEN kind = 7 THEN 0 ELSE 1 END AS action_id, CASE WHEN kind = 7 THEN 2 ELSE 1 END AS status_id,
      CASE WHEN kind = 7 THEN 4 ELSE 1 END AS disposition_id,
      CASE kind WHEN 2 THEN 'LOGOUT' WHEN 6 THEN 'CONFIG_I' WHEN 7 THEN 'FAILURE' ELSE 'RELOAD' END AS metadata_event_code,
      CASE WHEN kind IN (6, 8) THEN who END AS actor_user_name,
      CASE kind WHEN 2 THEN 1 WHEN 7 THEN 5 ELSE 2 END AS severity_id
    FROM r WHERE kind IN (2, 6, 7, 8)""",
)
def ios_process_activity(spark, sf):
    return flat(
        _ios(spark, sf, "process_activity"),
        "type_uid action action_id status_id disposition_id metadata.event_code actor.user.name severity_id metadata.uid",
        time=iso("time"),
    )


# -- Cloudflare DNS ----------------------------------------------------------------------------------

DNS = {
    "query_id": "concat('q', CAST(o_orderkey AS STRING))",
    "host": "CASE WHEN o_orderkey % 13 > 0 THEN concat('h', CAST(o_custkey AS STRING), '.example') END",
    "qtype": pick("o_orderkey", ["A", "AAAA", "TXT"]),
    "code": "CASE WHEN o_orderkey % 7 > 0 THEN o_orderkey % 30 END",
    "transport": pick("o_custkey", ["UDP", "tcp", "doh", "DoT", None]),
    "decision": "CASE WHEN o_custkey % 11 = 0 THEN 'weird' WHEN o_orderstatus = 'F' THEN 'block' WHEN o_orderstatus = 'O' "
    "THEN 'Allow' WHEN o_custkey % 2 = 0 THEN 'challenge' END",
    "policy": "CASE WHEN o_orderkey % 3 > 0 THEN 'p1' END",
    "day": "CAST(o_orderdate AS STRING)",
    "has_categories": "o_orderkey % 4 = 0",
    "has_feed": "o_orderkey % 6 = 0",
    "has_ips": "o_orderkey % 5 = 0",
    "has_answers": "o_orderkey % 2 = 0",
    "policy_name": "CASE WHEN o_orderkey % 3 > 0 THEN concat('Policy ', CAST(o_custkey % 5 AS STRING)) END",
    "who": "CASE WHEN o_custkey % 4 > 0 THEN concat('u', CAST(o_custkey AS STRING)) END",
    "device": pick("o_custkey", ["laptop", "phone", None]),
    "place": pick("o_orderkey", ["Berlin", None]),
    "query_size": "CASE WHEN o_custkey % 2 = 0 THEN o_custkey END",
}
RCODE_NAMES = [
    "NoError", "FormError", "ServError", "NXDomain", "NotImp", "Refused", "YXDomain", "YXRRSet", "NXRRSet", "NotAuth", "NotZone",
    "DSOTYPENI", *["Unassigned"] * 4, "BADSIG_VERS", "BADKEY", "BADTIME", "BADMODE", "BADNAME", "BADALG", "BADTRUNC", "BADCOOKIE",
    *["Unassigned"] * 6,
]
RCODE_DETAILS = [
    "No Error", "Format Error", "Server Failure", "Non-Existent Domain", "Not Implemented", "Query Refused",
    "Name Exists When It Should Not", "RR Set Exists When It Should Not", "RR Set That Should Exist Does Not",
    "Not Authorized or Server Not Authoritative For Zone", "Name Not Contained in Zone", "DSO-TYPE Not Implemented",
    *["Unassigned"] * 4, "TSIG Signature Failure or Bad OPT Version", "Key Not Recognized", "Signature Out of Time Window",
    "Bad TKEY Mode", "Duplicate Key Name", "Algorithm Not Supported", "Bad Truncation", "Bad or Missing Server Cookie",
    *["Unassigned"] * 6,
]

DNS_SQL = f"""
{attributes(DNS, "orders")},
s AS (SELECT *, CASE WHEN has_answers THEN 'Response' ELSE 'Query' END AS aname FROM r)
SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS time, CASE WHEN has_answers THEN 2 ELSE 1 END AS activity_id,
  aname AS activity_name, 'DNS Activity: ' || aname || ' [' || qtype || ']' AS type_name,
  400300 + CASE WHEN has_answers THEN 2 ELSE 1 END AS type_uid, code AS rcode_id,
  CASE WHEN code IS NULL THEN 0 WHEN code = 0 THEN 1 ELSE 2 END AS status_id,
  CASE WHEN code = 0 THEN 'Success' WHEN code > 0 THEN 'Failure' ELSE 'Unknown' END AS status,
  CAST(code AS VARCHAR) AS status_code,
  CASE lower(transport) WHEN 'udp' THEN 17 WHEN 'tcp' THEN 6 WHEN 'doh' THEN 17 WHEN 'dot' THEN 6 END AS connection_info_protocol_num,
  CASE lower(decision) WHEN 'allow' THEN 1 WHEN 'block' THEN 2 WHEN 'challenge' THEN 3 ELSE 99 END AS action_id,
  CASE lower(decision) WHEN 'allow' THEN 'Allowed' WHEN 'block' THEN 'Denied' WHEN 'challenge' THEN 'Challenged' ELSE 'Other' END AS action,
  CASE lower(decision) WHEN 'allow' THEN 1 WHEN 'block' THEN 2 WHEN 'challenge' THEN 99 ELSE 0 END AS disposition_id,
  CASE lower(decision) WHEN 'allow' THEN 'Allowed' WHEN 'block' THEN 'Blocked' WHEN 'challenge' THEN 'Other' ELSE 'Unknown' END AS disposition,
  CASE WHEN has_categories OR has_feed THEN concat_ws(';', CASE WHEN has_categories THEN 'Matched Category=Malware;Matched Category=Ads' END,
    CASE WHEN has_feed THEN 'Matched Threat Feed=Feed' END) END AS enriched,
  concat_ws(';', 'query_hostname=' || host, CASE WHEN has_ips THEN 'resolved_ip=192.0.2.1;resolved_ip=192.0.2.2' END) AS observed,
  CASE WHEN has_answers THEN 2 END AS n_answers, CASE WHEN has_answers THEN 300 END AS first_ttl,
  CASE WHEN has_ips THEN 'DE' END AS dst_endpoint_location_country, policy IS NOT NULL AS policy_is_applied,
  coalesce({RCODE_NAMES}[code + 1], 'Other') AS rcode, coalesce({RCODE_DETAILS}[code + 1], 'Other') AS status_detail,
  policy_name AS policy_name, policy AS policy_uid, who AS src_endpoint_uid, device AS src_endpoint_domain,
  place AS dst_endpoint_location_city, query_size AS traffic_bytes_in, qtype AS query_type, 'IN' AS query_class,
  lower(transport) AS connection_info_protocol_name, query_id AS connection_info_uid, query_id AS metadata_correlation_uid,
  host AS query_hostname, query_id AS metadata_uid, decision AS left_decision,
  'DNS ' || aname || ' for ' || host || ' (' || qtype || ') - ' || coalesce(CAST(code AS VARCHAR), 'Unknown')
    || coalesce(' - Decision: ' || decision, '') AS message
FROM s"""


@query("dns_activity", DNS_SQL)
def dns_activity(spark, sf):
    c = F.col
    texts = lambda *values: F.array(*(F.lit(v) for v in values))
    answer = lambda rdata, ttl: F.struct(
        F.lit("IN").alias("class"), F.lit("A").alias("type"), F.lit(ttl).alias("ttl"), F.lit(rdata).alias("rdata")
    )
    record = json_record(
        Datetime=c("day"), QueryID=c("query_id"), QueryName=c("host"), QueryTypeName=c("qtype"), RCode=c("code"),
        Protocol=c("transport"), ResolverDecision=c("decision"), PolicyID=c("policy"), PolicyName=c("policy_name"),
        UserID=c("who"), DeviceName=c("device"), Location=c("place"), QuerySize=c("query_size"),
        MatchedCategoryNames=F.when(c("has_categories"), texts("Malware", "Ads")),
        MatchedIndicatorFeedNames=F.when(c("has_feed"), texts("Feed", None)),
        ResolvedIPs=F.when(c("has_ips"), texts("192.0.2.1", None, "192.0.2.2")),
        ResolvedIPCountryCodes=F.when(c("has_ips"), texts("DE", "FR")).otherwise(F.array().cast("array<string>")),
        ResourceRecordsJSON=F.when(c("has_answers"), F.array(answer("192.0.2.1", "300"), answer("192.0.2.2", "x"))),
    )
    gold = mapped(spark, sf, "orders", DNS, record, cloudflare_dns.flow(), "dns_activity")
    return flat(
        gold,
        "activity_id activity_name type_name type_uid rcode_id status_id status status_code "
        "connection_info.protocol_num action_id action disposition_id disposition dst_endpoint.location.country "
        "policy.is_applied rcode status_detail policy.name policy.uid src_endpoint.uid src_endpoint.domain "
        "dst_endpoint.location.city traffic.bytes_in query.type query.class connection_info.protocol_name "
        "connection_info.uid metadata.correlation_uid query.hostname metadata.uid message",
        time=iso("time"), enriched=pairs("enrichments"), observed=pairs("observables"),
        n_answers=F.when(F.col("answers").isNotNull(), F.size("answers")),
        first_ttl=F.get("answers", F.lit(0))["ttl"], left_decision=at("$.ResolverDecision"),
    )


# -- Okta ----------------------------------------------------------------------------------------------

OKTA_EVENTS = [
    "user.session.start", "user.session.end", "user.authentication.sso", "user.authentication.auth_via_mfa",
    "user.authentication.verify_push_approve", "user.authentication.verify_push_reject", "user.lifecycle.create",
    "user.lifecycle.reactivate", "user.lifecycle.deactivate", "user.lifecycle.delete_initiated", "user.account.lock",
    "user.account.unlock", "user.account.reset_password", "group.lifecycle.create", "group.lifecycle.delete",
    "group.user_membership.add", "group.user_membership.remove", "system.api_token.create",
]
OKTA = {
    "uid": "concat('e', CAST(event_id AS STRING))",
    "kind": pick("event_id", OKTA_EVENTS),
    "outcome": pick("user_id", ["SUCCESS", "FAILURE", "ALLOW", "DENY", "CHALLENGE", None]),
    "level": pick("user_id", ["DEBUG", "INFO", "WARN", "ERROR", "ODD", None, "INFO"]),
    "credential": pick("user_id", ["OTP", "PASSWORD", "CERT", None]),
    "interface": "CASE WHEN user_id % 9 = 0 THEN 'SAML2.0' END",
    "actor_name": "CASE WHEN user_id % 5 > 0 THEN concat('ann', CAST(user_id AS STRING)) END",
    "target_name": "CASE WHEN event_id % 3 > 0 THEN concat('bob', CAST(user_id AS STRING)) END",
    "grp": "CASE WHEN event_id % 4 > 0 THEN concat('g', CAST(user_id AS STRING)) END",
    "isp": "CASE WHEN event_id % 2 = 0 THEN 'net' END",
    "full_name": "CASE WHEN user_id % 5 > 0 THEN concat('Ann ', CAST(user_id AS STRING)) END",
    "session": "CASE WHEN event_id % 6 > 0 THEN concat('s', CAST(user_id AS STRING)) END",
    "city": pick("user_id", ["Oslo", "Lyon", None]),
    "reason": pick("event_id", [None, "INVALID_CREDENTIALS", "LOCKED_OUT"]),
}


def _okta(spark, sf, name):
    c = F.col
    target = lambda kind, key, label: F.struct(
        F.lit(kind).alias("type"), F.concat(F.lit("id-"), c(key)).alias("id"), c(key).alias(label)
    )
    # Targets come in an order that puts another type first.
    person = F.to_json(target("User", "target_name", "alternateId"))
    group = F.to_json(target("UserGroup", "grp", "displayName"))
    targets = F.concat(
        F.lit("["),
        F.array_join(
            F.array_compact(
                F.array(
                    F.lit('{"type":"Other","id":"o"}'),
                    F.when(c("grp").isNotNull(), group),
                    F.when(c("target_name").isNotNull(), person),
                )
            ),
            ",",
        ),
        F.lit("]"),
    )
    body = F.to_json(
        F.struct(
            c("uid").alias("uuid"), F.date_format(c("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("published"),
            c("kind").alias("eventType"), c("level").alias("severity"),
            F.struct(c("outcome").alias("result"), c("reason").alias("reason")).alias("outcome"),
            F.struct(
                c("uid").alias("id"), c("actor_name").alias("alternateId"), c("full_name").alias("displayName"), F.lit("User").alias("type")
            ).alias("actor"),
            F.struct(
                F.lit("10.0.0.1").alias("ipAddress"),
                F.struct(c("city").alias("city"), F.lit("X").alias("country"), F.lit("Y").alias("state")).alias("geographicalContext"),
            ).alias("client"),
            F.struct(c("isp").alias("isp")).alias("securityContext"),
            F.struct(
                c("credential").alias("credentialType"), c("interface").alias("interface"), c("session").alias("externalSessionId")
            ).alias("authenticationContext"),
            F.parse_json(targets).alias("target"),
        )
    )
    return mapped(spark, sf, "events", OKTA, F.parse_json(body), okta.flow(), name)


OKTA_SHARED = """strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, uid AS metadata_uid, outcome AS status_code,
  CASE level WHEN 'DEBUG' THEN 1 WHEN 'INFO' THEN 1 WHEN 'WARN' THEN 3 WHEN 'ERROR' THEN 4 ELSE 0 END AS severity_id,
  CASE level WHEN 'DEBUG' THEN 'Informational' WHEN 'INFO' THEN 'Informational' WHEN 'WARN' THEN 'Medium' WHEN 'ERROR' THEN 'High'
    ELSE 'Unknown' END AS severity"""


@query(
    "okta_authentication",
    f"""
    {attributes(OKTA, "events")},
    s AS (SELECT *, CASE WHEN k IN (0, 2, 3, 4) THEN 1 WHEN k = 1 THEN 2 ELSE 99 END AS aid
          FROM (SELECT *, event_id % 18 AS k FROM r) WHERE k <= 5)
    SELECT {OKTA_SHARED}, aid AS activity_id, CASE aid WHEN 1 THEN 'Logon' WHEN 2 THEN 'Logoff' ELSE 'Other' END AS activity_name,
      300200 + aid AS type_uid,
      'Authentication: ' || CASE WHEN k IN (0, 2, 3) THEN 'Logon' WHEN k = 1 THEN 'Logoff' ELSE 'Other' END AS type_name,
      CASE WHEN outcome IN ('SUCCESS', 'ALLOW') THEN 1 WHEN outcome IN ('FAILURE', 'DENY') THEN 2 WHEN outcome = 'CHALLENGE' THEN 99
        ELSE 0 END AS status_id,
      CASE WHEN outcome IN ('SUCCESS', 'ALLOW') THEN 'Success' WHEN outcome IN ('FAILURE', 'DENY') THEN 'Failure'
        WHEN outcome = 'CHALLENGE' THEN 'Other' ELSE 'Unknown' END AS status,
      CASE WHEN outcome IN ('SUCCESS', 'ALLOW') THEN 'Allowed' WHEN outcome IN ('FAILURE', 'DENY') THEN 'Denied' ELSE 'Unknown' END AS action,
      k IN (3, 4, 5) AS is_mfa, true AS is_remote,
      CASE WHEN interface IS NOT NULL THEN 'SAML' WHEN credential = 'OTP' THEN 'TOTP' WHEN credential = 'PASSWORD' THEN 'Password'
        ELSE credential END AS auth_protocol,
      CASE WHEN interface IS NOT NULL THEN 5 WHEN credential = 'OTP' THEN 99 WHEN credential = 'PASSWORD' THEN 1 ELSE 0 END AS auth_protocol_id,
      actor_name AS user_name, full_name AS user_full_name, uid AS user_uid, 'User' AS user_type, session AS session_uid,
      city AS src_endpoint_location_city, 'X' AS src_endpoint_location_country, 'Y' AS src_endpoint_location_region,
      reason AS status_detail, kind AS metadata_event_code, 'Okta' AS dst_endpoint_name,
      concat_ws(';', 'user.name=' || actor_name, 'src_endpoint.ip=10.0.0.1') AS observed,
      coalesce('isp=' || isp, '') AS enriched, credential AS left_credential
    FROM s""",
)
def okta_authentication(spark, sf):
    return flat(
        _okta(spark, sf, "authentication"),
        "status_code severity_id severity activity_id activity_name type_uid type_name status_id status action is_mfa "
        "is_remote auth_protocol auth_protocol_id user.name user.full_name user.uid user.type session.uid "
        "src_endpoint.location.city src_endpoint.location.country src_endpoint.location.region status_detail "
        "metadata.event_code dst_endpoint.name metadata.uid",
        time=iso("time"), observed=pairs("observables"), enriched=pairs("enrichments"),
        left_credential=at("$.auth_credential_type"),
    )


@query(
    "okta_account_change",
    f"""
    {attributes(OKTA, "events")},
    s AS (SELECT *, [1, 2, 4, 5, 99, 2, 3][k - 5] AS aid,
            ['Create', 'Enable', 'Disable', 'Delete', 'Other', 'Enable', 'Password Change'][k - 5] AS aname
          FROM (SELECT *, event_id % 18 AS k FROM r) WHERE k BETWEEN 6 AND 12)
    SELECT {OKTA_SHARED}, aid AS activity_id, aname AS activity_name, 300100 + aid AS type_uid, 'Account Change: ' || aname AS type_name,
      CASE WHEN outcome IN ('SUCCESS', 'ALLOW') THEN 1 WHEN outcome IN ('FAILURE', 'DENY') THEN 2 ELSE 0 END AS status_id,
      CASE WHEN outcome IN ('SUCCESS', 'ALLOW') THEN 1 ELSE 2 END AS action_id,
      CASE WHEN outcome IN ('SUCCESS', 'ALLOW') THEN 'Allowed' ELSE 'Denied' END AS action,
      actor_name AS actor_user_name, target_name AS user_name, 'id-' || target_name AS user_uid, 'User' AS user_type,
      concat_ws(';', 'actor.user.name=' || actor_name, 'user.name=' || target_name, 'src_endpoint.ip=10.0.0.1') AS observed
    FROM s""",
)
def okta_account_change(spark, sf):
    return flat(
        _okta(spark, sf, "account_change"),
        "status_code severity_id severity activity_id activity_name type_uid type_name status_id action_id action "
        "actor.user.name user.name user.uid user.type metadata.uid",
        time=iso("time"), observed=pairs("observables"),
    )


@query(
    "okta_group_management",
    f"""
    {attributes(OKTA, "events")},
    s AS (SELECT *, [1, 4, 5, 6][k - 12] AS aid, ['Create', 'Delete', 'Add', 'Remove'][k - 12] AS aname
          FROM (SELECT *, event_id % 18 AS k FROM r) WHERE k BETWEEN 13 AND 16)
    SELECT {OKTA_SHARED.replace("outcome AS status_code", "NULL::VARCHAR AS status_code")},
      aid AS activity_id, 300600 + aid AS type_uid, 'Group Management: ' || aname AS type_name,
      'Allowed' AS action, grp AS group_name, 'id-' || grp AS group_uid, target_name AS user_name,
      concat_ws(';', 'actor.user.name=' || actor_name, 'user.name=' || target_name, 'group.name=' || grp) AS observed
    FROM s""",
)
def okta_group_management(spark, sf):
    return flat(
        _okta(spark, sf, "group_management"),
        "status_code severity_id severity activity_id type_uid type_name action group.name group.uid user.name metadata.uid",
        time=iso("time"), observed=pairs("observables"),
    )


# -- GitHub --------------------------------------------------------------------------------------------

GITHUB_ACTIONS = [
    "org.add_member", "org.remove_member", "org.update_member", "org.add_billing_manager", "user.login", "user.logout",
    "user.login_failed", "oauth_authorization.create", "oauth_authorization.destroy", "repo.add_member",
    "repo.remove_member", "protected_branch.create", "team.add_member", "team.remove_member", "team.create",
    "team.destroy", "repo.create", "repo.destroy", "repo.rename", "org.rename", "repo.archived", "git.clone", "git.push",
    "pull_request.merge", "deploy.finish", "workflow.run", "release.create", "unknown.thing",
]
GITHUB = {
    "uid": "concat('g', CAST(event_id AS STRING))",
    "act": pick("event_id", GITHUB_ACTIONS),
    "made": "CAST(1700000000123 + event_id * 1000 AS BIGINT)",
    "who": "concat('a', CAST(user_id AS STRING))",
    "usr": "CASE WHEN user_id % 3 > 0 THEN concat('b', CAST(user_id AS STRING)) END",
    "target": "CASE WHEN user_id % 4 = 0 THEN concat('t', CAST(user_id AS STRING)) END",
    "place": "CASE WHEN user_id % 5 = 0 THEN 'plain' WHEN user_id % 5 > 1 THEN concat('acme/r', CAST(user_id AS STRING)) END",
    "perm": "CASE WHEN user_id % 2 = 0 THEN 'write' END",
    "grp": "CASE WHEN user_id % 7 > 0 THEN 'core' END",
}


def _github(spark, sf, name):
    c = F.col
    record = json_record(
        id=c("uid"), action=c("act"), created_at=c("made"), actor=c("who"), user=c("usr"), org=F.lit("acme"),
        repo=c("place"), actor_location=F.struct(F.lit("192.0.2.9").alias("ip"), F.lit("Bonn").alias("city")),
        data=F.struct(c("target").alias("target_login"), c("perm").alias("permission"), c("grp").alias("team")),
    )
    return mapped(spark, sf, "events", GITHUB, record, github_audit.flow(), name)


GITHUB_SHARED = """strftime(make_timestamp(made // 1000 * 1000000), '%Y-%m-%d %H:%M:%S') AS time, uid AS metadata_uid,
      act AS metadata_event_code, CAST(made AS VARCHAR) AS metadata_original_time, who AS actor_user_name, act AS left_action"""


def _github_flat(spark, sf, name, paths, **more):
    return flat(
        _github(spark, sf, name),
        "metadata.uid metadata.event_code metadata.original_time actor.user.name " + paths,
        time=iso("time"), left_action=at("$.action"), observed=pairs("observables"), **more,
    )


def _github_rows(picked: str) -> str:
    return f"{attributes(GITHUB, 'events')}, s AS (SELECT * FROM (SELECT *, event_id % 28 AS k FROM r) WHERE {picked})"


@query(
    "github_account_change",
    f"""
    {_github_rows("k IN (0, 1, 2)")}
    SELECT {GITHUB_SHARED}, 99 AS activity_id, 'Account Change: Other' AS type_name, CASE k WHEN 2 THEN 2 ELSE 1 END AS severity_id,
      'Allowed' AS action, 'Success' AS status, coalesce(target, usr) AS user_name,
      'GitHub member ' || ['added to', 'removed from', 'updated in'][k + 1] || ' organization: ' || coalesce(target, usr, who) AS message,
      concat_ws(';', 'actor=' || who, 'target_user=' || coalesce(target, usr)) AS observed,
      'organization=acme;source=github' AS enriched, uid AS raw_id
    FROM s""",
)
def github_account_change(spark, sf):
    return _github_flat(
        spark, sf, "account_change", "activity_id type_name severity_id action status user.name message",
        enriched=pairs("enrichments"), raw_id=at("$.payload.id", "string", "raw_data"),
    )


@query(
    "github_authentication",
    f"""
    {_github_rows("k BETWEEN 4 AND 8")}
    SELECT {GITHUB_SHARED}, [1, 2, 99, 1, 2][k - 3] AS activity_id, ['Logon', 'Logoff', 'Other', 'Logon', 'Logoff'][k - 3] AS activity,
      CASE WHEN k = 6 THEN 'High' ELSE 'Informational' END AS severity, CASE WHEN k = 6 THEN 2 ELSE 1 END AS status_id,
      CASE WHEN k = 6 THEN 'Denied' ELSE 'Allowed' END AS action, CASE WHEN k >= 7 THEN 'OAuth' ELSE 'Password' END AS auth_protocol,
      CASE WHEN k >= 7 THEN 2 ELSE 1 END AS auth_protocol_id, '192.0.2.9' AS src_endpoint_ip, 'Bonn' AS src_endpoint_location_city,
      'actor=' || who || ';src_ip=192.0.2.9' AS observed
    FROM s""",
)
def github_authentication(spark, sf):
    return _github_flat(
        spark, sf, "authentication",
        "activity_id activity severity status_id action auth_protocol auth_protocol_id src_endpoint.ip src_endpoint.location.city",
    )


@query(
    "github_authorize_session",
    f"""
    {_github_rows("k BETWEEN 9 AND 11")}
    SELECT {GITHUB_SHARED}, [5, 6, 99][k - 8] AS activity_id, ['Low', 'Medium', 'Informational'][k - 8] AS severity,
      coalesce(place, 'acme') AS resource_name, CASE WHEN place IS NULL THEN 'Organization' ELSE 'Repository' END AS resource_type,
      'acme' AS resource_owner_name, target AS user_name, perm AS first_privilege,
      concat_ws(';', 'actor=' || who, 'repository=' || place) AS observed
    FROM s""",
)
def github_authorize_session(spark, sf):
    return _github_flat(
        spark, sf, "authorize_session",
        "activity_id severity resource.name resource.type resource.owner.name user.name",
        first_privilege=F.get("privileges", F.lit(0)),
    )


@query(
    "github_user_access",
    f"""
    {_github_rows("k IN (2, 3)")}
    SELECT {GITHUB_SHARED}, CASE k WHEN 2 THEN 3 ELSE 5 END AS activity_id, 300500 + CASE k WHEN 2 THEN 3 ELSE 5 END AS type_uid,
      CASE k WHEN 2 THEN 1 ELSE 2 END AS severity_id, 'User Access' AS class_name, coalesce(target, usr) AS user_name,
      'acme' AS resource_name, coalesce(perm, 'member') AS first_privilege,
      concat_ws(';', 'actor=' || who, 'target_user=' || coalesce(target, usr)) AS observed
    FROM s""",
)
def github_user_access(spark, sf):
    return _github_flat(
        spark, sf, "user_access", "activity_id type_uid severity_id class_name user.name resource.name",
        first_privilege=F.get("privileges", F.lit(0)),
    )


@query(
    "github_group_management",
    f"""
    {_github_rows("k BETWEEN 12 AND 15")}
    SELECT {GITHUB_SHARED}, [5, 6, 1, 4][k - 11] AS activity_id, ['Add', 'Remove', 'Create', 'Delete'][k - 11] AS activity_name,
      [1, 1, 2, 3][k - 11] AS severity_id, grp AS group_name, target AS user_name,
      concat_ws(';', 'actor=' || who, 'team=' || grp) AS observed
    FROM s""",
)
def github_group_management(spark, sf):
    return _github_flat(
        spark, sf, "group_management", "activity_id activity_name severity_id group.name user.name"
    )


@query(
    "github_entity_management",
    f"""
    {_github_rows("k BETWEEN 16 AND 20")}
    SELECT {GITHUB_SHARED}, [1, 4, 3, 3, 3][k - 15] AS activity_id, [2, 3, 1, 1, 1][k - 15] AS severity_id,
      'Entity Management: ' || ['Create', 'Delete', 'Update', 'Update', 'Update'][k - 15] AS type_name, place AS entity_uid,
      CASE WHEN user_id % 5 > 1 THEN 'r' || user_id END AS entity_name, 'acme' AS cloud_account_uid,
      concat_ws(';', 'actor=' || who, 'entity.uid=' || place) AS observed
    FROM s""",
)
def github_entity_management(spark, sf):
    return _github_flat(
        spark, sf, "entity_management", "activity_id severity_id type_name entity.uid entity.name cloud.account.uid"
    )


@query(
    "github_api_activity",
    f"""
    {_github_rows("k BETWEEN 21 AND 26")}
    SELECT {GITHUB_SHARED}, [2, 1, 3, 5, 99, 1][k - 20] AS activity_id,
      'API Activity: ' || ['Read', 'Create', 'Update', 'Connect', 'Other', 'Create'][k - 20] AS type_name, act AS api_operation,
      '192.0.2.9' AS src_endpoint_ip, place AS resource_uid,
      concat_ws(';', 'actor.user.name=' || who, 'resources.uid=' || place) AS observed
    FROM s""",
)
def github_api_activity(spark, sf):
    return _github_flat(
        spark, sf, "api_activity", "activity_id type_name api.operation src_endpoint.ip",
        resource_uid=F.get("resources", F.lit(0))["uid"],
    )
