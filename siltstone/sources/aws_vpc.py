"""AWS VPC flow logs (space-separated, header line) to network activity."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions import normalize as n
from siltstone.plans.spec import Field, Flow, GoldSpec, Ingest, SilverSpec, fields

PARSED = "aws_vpc_flowlogs_silver"

# Record keys whose column is named otherwise than key.replace("-", "_").
RENAMED = {
    "srcaddr": "src_addr",
    "dstaddr": "dst_addr",
    "srcport": "src_port",
    "dstport": "dst_port",
    "start": "start_epoch",
    "end": "end_epoch",
    "type": "flow_type",
    "pkt-srcaddr": "pkt_src_addr",
    "pkt-dstaddr": "pkt_dst_addr",
}
# Record keys by type; `-` marks a missing text.
TEXTS = (
    "account-id", "interface-id", "srcaddr", "dstaddr", "action", "log-status", "vpc-id", "subnet-id",
    "instance-id", "type", "pkt-srcaddr", "pkt-dstaddr", "region", "az-id", "sublocation-type",
    "sublocation-id", "pkt-src-aws-service", "pkt-dst-aws-service", "flow-direction", "ecs-cluster-arn",
    "ecs-cluster-name", "ecs-container-instance-arn", "ecs-container-instance-id", "ecs-container-id",
    "ecs-second-container-id", "ecs-service-name", "ecs-task-definition-arn", "ecs-task-arn", "ecs-task-id",
    "reject-reason", "resource-id", "tgw-id", "tgw-attachment-id", "tgw-src-vpc-account-id",
    "tgw-dst-vpc-account-id", "tgw-src-vpc-id", "tgw-dst-vpc-id", "tgw-src-subnet-id", "tgw-dst-subnet-id",
    "tgw-pair-attachment-id", "resource-type",
)
INTS = (
    "version", "srcport", "dstport", "protocol", "tcp-flags", "traffic-path", "encryption-status",
)
LONGS = (
    "packets", "bytes", "start", "end", "packets-lost-no-route", "packets-lost-blackhole",
    "packets-lost-mtu-exceeded", "packets-lost-ttl-expired",
)
# Parsed columns kept as leftovers of the mapped row.
LEFTOVERS = (
    "interface_id", "subnet_id", "tcp_flags", "traffic_path", "flow_type", "sublocation_type",
    "sublocation_id", "log_status", "reject_reason", "resource_id", "encryption_status", "tgw_id",
    "tgw_attachment_id", "tgw_pair_attachment_id", "resource_type", "packets_lost_no_route",
    "packets_lost_blackhole", "packets_lost_mtu_exceeded", "packets_lost_ttl_expired", "ecs_cluster_arn",
    "ecs_cluster_name", "ecs_container_instance_id", "ecs_container_id", "ecs_service_name", "ecs_task_id",
    "ecs_task_arn",
)


def flow(*inputs: str) -> Flow:
    start, end = n.number("$.start", "bigint"), n.number("$.end", "bigint")
    return Flow(
        name="aws_vpc_flowlogs",
        provider="aws",
        log_name="vpc_flowlogs",
        version="2.0",
        ingest=Ingest(
            name="aws_vpc_flowlogs_bronze",
            inputs=inputs,
            format="csv",
            options={"sep": " ", "header": "true"},
            single_variant=True,
            pre=(
                (
                    F.lit("aws").alias("source"),
                    F.lit("vpc_flowlogs").alias("sourcetype"),
                    n.event_time(start, end).alias("time"),
                    "data",
                ),
            ),
        ),
        silver=(parsed(),),
        gold=(network_activity(),),
    )


def parsed() -> SilverSpec:
    kinds = {**dict.fromkeys(TEXTS, "string"), **dict.fromkeys(INTS, "int"), **dict.fromkeys(LONGS, "bigint")}
    columns = {}
    for key, kind in kinds.items():
        value = n.member((key,))
        columns[RENAMED.get(key, key.replace("-", "_"))] = n.missing_as_null(value) if kind == "string" else value
    return SilverSpec(
        name=PARSED,
        filter=F.col("data").isNotNull(),
        preserve=True,
        temporary=(Field("record", n.record(kinds)),),
        fields=fields(columns),
    )


def network_activity() -> GoldSpec:
    col = F.col
    src, dst = F.coalesce("pkt_src_addr", "src_addr"), F.coalesce("pkt_dst_addr", "dst_addr")
    log_status = col("log_status")
    quiet = col("src_addr").isNull() & col("dst_addr").isNull()
    return GoldSpec(
        name="network_activity",
        input=PARSED,
        temporary=(
            Field("src_private", n.is_private(col("src_addr"))),
            Field("dst_private", n.is_private(col("dst_addr"))),
            Field("direction_code", n.direction_id(col("src_private"), col("dst_private"), col("flow_direction"))),
            Field(
                "flow_id",
                n.flow_uid(
                    *(col(name) for name in ("interface_id", "src_addr", "src_port", "dst_addr", "dst_port")),
                    col("protocol"),
                    col("start_epoch"),
                ),
            ),
        ),
        fields=fields(
            {
                "time": col("time"),
                "activity_id": F.lit(6),
                "activity_name": F.lit("Traffic"),
                "activity": F.lit("Traffic"),
                **n.class_columns("network_activity"),
                "type_uid": n.type_uid(col("class_uid"), col("activity_id")),
                "type_name": n.type_name("Network Activity", col("activity_name")),
                # `action` is the vendor's word here; the output of that name follows below.
                "severity_id": n.first_match([(col("action") == "REJECT", 3)], 1),
                "severity": n.severity_name(col("severity_id")),
                "status_id": n.lookup(log_status, {"OK": 1, "NODATA": 99, "SKIPDATA": 99}, 0),
                "status": n.status_name(col("status_id")),
                "status_code": log_status,
                "status_detail": n.first_match(
                    [
                        (
                            (log_status == "OK") & col("reject_reason").isNotNull(),
                            n.sentence("Flow rejected: ", col("reject_reason")),
                        ),
                        (log_status == "OK", F.lit("Flow log recorded")),
                        (log_status == "NODATA", F.lit("No data during aggregation interval")),
                        (log_status == "SKIPDATA", F.lit("Data skipped during aggregation interval")),
                    ],
                    F.coalesce(log_status, F.lit("Unknown")),
                ),
                "action_id": n.lookup(col("action"), {"ACCEPT": 1, "REJECT": 2}, 0),
                "action": n.action_name(col("action_id")),
                "disposition_id": col("action_id"),
                "disposition": n.disposition_name(col("disposition_id")),
                "start_time": n.epoch_time(col("start_epoch")),
                "end_time": n.epoch_time(col("end_epoch")),
                "timezone_offset": n.null_of("int"),
                "message": F.when(
                    quiet, n.sentence((log_status, "NODATA"), " on eni=", (col("interface_id"), ""))
                ).otherwise(
                    n.sentence(
                        (col("action"), ""), " ", (col("src_addr"), ""), ":", (col("src_port"), ""), " -> ",
                        (col("dst_addr"), ""), ":", (col("dst_port"), ""), " eni=", (col("interface_id"), ""),
                    )
                ),
                "observables": n.observables(
                    [
                        ("src_endpoint.ip", "IP Address", src),
                        ("dst_endpoint.ip", "IP Address", dst),
                        ("src_endpoint.port", "Port", col("src_port")),
                        ("dst_endpoint.port", "Port", col("dst_port")),
                        ("cloud.account.uid", "Account Object: uid", col("account_id")),
                        ("src_endpoint.interface_uid", "Resource UID", col("interface_id")),
                    ]
                ),
                "raw_data": n.raw_record(col("data")),
                "unmapped": n.unmapped(LEFTOVERS),
                "src_endpoint.ip": src,
                "src_endpoint.port": col("src_port"),
                "src_endpoint.interface_uid": col("interface_id"),
                "src_endpoint.instance_uid": col("instance_id"),
                "src_endpoint.vpc_uid": col("vpc_id"),
                "src_endpoint.zone": col("az_id"),
                "src_endpoint.svc_name": col("pkt_src_aws_service"),
                "dst_endpoint.ip": dst,
                "dst_endpoint.port": col("dst_port"),
                "dst_endpoint.svc_name": col("pkt_dst_aws_service"),
                "connection_info.protocol_num": col("protocol"),
                "connection_info.protocol_name": n.protocol_name(col("protocol")),
                "connection_info.direction_id": col("direction_code"),
                "connection_info.direction": n.direction_name(col("direction_code")),
                "connection_info.uid": col("flow_id"),
                "traffic.bytes": col("bytes"),
                "traffic.packets": col("packets"),
                "cloud.provider": F.lit("AWS"),
                "cloud.account.uid": col("account_id"),
                "cloud.region": col("region"),
                **n.metadata(
                    "VPC Flow Logs", "AWS", "aws", "vpc_flowlogs", "CSV", version="2.0",
                    processed_time=F.current_timestamp(),
                    logged_time=col("time"),
                    uid=col("flow_id"),
                ),
            }
        ),
    )
