"""Zeek connection log (JSON) to network activity."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions import codes
from siltstone.functions import normalize as n
from siltstone.plans.spec import Field, Flow, GoldSpec, Ingest, SilverSpec, fields

PARSED = "zeek_conn_silver"

# Parsed column -> record key (keys hold dots) and type.
ENDS = {
    "id_origin_host": (("id.orig_h",), "string"),
    "id_origin_port": (("id.orig_p",), "int"),
    "id_response_host": (("id.resp_h",), "string"),
    "id_response_port": (("id.resp_p",), "int"),
    "conn_state": (("conn_state",), "string"),
}
# Record keys read while mapping, by type.
DETAILS = {
    **dict.fromkeys(("uid", "proto", "history", "service", "orig_l2_addr", "resp_l2_addr", "tunnel_parents"), "string"),
    **dict.fromkeys(
        ("orig_bytes", "resp_bytes", "orig_pkts", "resp_pkts", "missed_bytes", "orig_ip_bytes", "resp_ip_bytes"), "bigint"
    ),
    **dict.fromkeys(("vlan", "inner_vlan"), "int"),
    **dict.fromkeys(("local_orig", "local_resp"), "boolean"),
    "duration": "double",
}


def flow(*inputs: str) -> Flow:
    return Flow(
        name="zeek_conn",
        provider="zeek",
        log_name="conn",
        ingest=Ingest(
            name="zeek_conn_bronze",
            inputs=inputs,
            format="json",
            single_variant=True,
            pre=(
                (
                    F.lit("zeek").alias("source"),
                    F.lit("conn").alias("sourcetype"),
                    F.try_variant_get("data", "$.ts", "timestamp").alias("time"),
                    "data",
                ),
            ),
        ),
        silver=(parsed(),),
        gold=(network_activity(),),
    )


def parsed() -> SilverSpec:
    return SilverSpec(
        name=PARSED,
        preserve=True,
        temporary=(Field("record", n.record({key: kind for key, kind in ENDS.values()})),),
        fields=fields({name: n.member(key) for name, (key, _) in ENDS.items()}),
    )


def _by_state(position: int, default):
    return n.lookup(F.col("conn_state"), n.column_of(codes.ZEEK_STATES, position), default)


def network_activity() -> GoldSpec:
    src, dst, state = F.col("id_origin_host"), F.col("id_response_host"), F.col("conn_state")
    activity = n.lookup(F.col("activity_id"), codes.ZEEK_ACTIVITY_NAMES)
    return GoldSpec(
        name="network_activity",
        input=PARSED,
        temporary=(
            Field("src_private", n.is_private(src)),
            Field("dst_private", n.is_private(dst)),
            Field("direction_code", n.direction_id(F.col("src_private"), F.col("dst_private"))),
            Field("record", n.record(DETAILS)),
        ),
        fields=fields(
            {
                "time": F.col("time"),
                **n.class_columns("network_activity"),
                "activity_id": _by_state(0, 6),
                "activity_name": activity,
                "activity": activity,
                "action_id": _by_state(1, 1),
                "action": n.lookup(F.col("action_id"), codes.ZEEK_ACTION_NAMES),
                "disposition_id": _by_state(2, 1),
                "disposition": n.lookup(F.col("disposition_id"), codes.ZEEK_DISPOSITION_NAMES),
                "severity_id": F.lit(1),
                "severity": F.lit("Informational"),
                "type_uid": n.type_uid(F.col("class_uid"), F.col("activity_id")),
                "type_name": n.type_name("Network Activity", F.col("activity_name")),
                "start_time": F.col("time"),
                # Whole seconds, as the source log's end is derived from a rounded start.
                "end_time": F.timestamp_seconds((F.unix_seconds("time") + n.member("duration")).cast("bigint")),
                "timezone_offset": n.null_of("int"),
                "status_id": n.first_match([(F.col("activity_id") == 4, 2)], 1),
                "status": n.status_name(F.col("status_id")),
                "status_code": state,
                "status_detail": F.coalesce(_by_state(3, None), state),
                "message": n.sentence(
                    "Network connection ", F.col("activity_name"),
                    " from ", (src, "unknown"), ":", (F.col("id_origin_port"), "?"),
                    " to ", (dst, "unknown"), ":", (F.col("id_response_port"), "?"),
                    " (", (F.upper(n.member("proto")), "unknown"), ") - ", F.col("status_detail"),
                ),
                **n.metadata(
                    "Zeek Conn", "Zeek", "zeek", "conn", "JSON",
                    uid=n.member("uid"),
                    processed_time=F.current_timestamp(),
                    logged_time=F.col("time"),
                ),
                "src_endpoint.ip": src,
                "src_endpoint.port": F.col("id_origin_port"),
                "src_endpoint.mac": n.member("orig_l2_addr"),
                "dst_endpoint.ip": dst,
                "dst_endpoint.port": F.col("id_response_port"),
                "dst_endpoint.svc_name": n.member("service"),
                "dst_endpoint.mac": n.member("resp_l2_addr"),
                "connection_info.uid": n.member("uid"),
                "connection_info.protocol_name": F.lower(n.member("proto")),
                "connection_info.protocol_num": n.protocol_number(n.member("proto")),
                "connection_info.flag_history": n.member("history"),
                "connection_info.direction_id": F.col("direction_code"),
                "connection_info.direction": n.direction_name(F.col("direction_code")),
                "traffic.bytes_in": n.member("resp_bytes"),
                "traffic.bytes_out": n.member("orig_bytes"),
                "traffic.bytes": n.member("resp_bytes") + n.member("orig_bytes"),
                "traffic.packets_in": n.member("resp_pkts"),
                "traffic.packets_out": n.member("orig_pkts"),
                "traffic.packets": n.member("orig_pkts") + n.member("resp_pkts"),
                "traffic.bytes_missed": n.member("missed_bytes"),
                "raw_data": n.raw_record(F.col("data")),
                "unmapped": n.unmapped(
                    {
                        "uid": n.member("uid"),
                        "conn_state": state,
                        **{
                            name: n.member(name)
                            for name in (
                                "local_orig", "local_resp", "history", "orig_ip_bytes", "resp_ip_bytes",
                                "tunnel_parents", "duration", "vlan", "inner_vlan",
                            )
                        },
                    }
                ),
            }
        ),
    )
