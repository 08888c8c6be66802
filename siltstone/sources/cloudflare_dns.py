"""Cloudflare Gateway DNS log (JSON) to DNS activity."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions import codes
from siltstone.functions import normalize as n
from siltstone.plans.spec import Field, Flow, GoldSpec, Ingest, SilverSpec, fields

PARSED = "cloudflare_gateway_dns_silver"

# Record keys by type; a column keeps the name of its key.
TEXTS = (
    "AccountID", "ApplicationID", "ApplicationName", "ColoCode", "CustomResolverAddress",
    "CustomResolverPolicyID", "CustomResolverPolicyName", "CustomResolverResponse", "DeviceID", "DeviceName",
    "DoHSubdomain", "DoTSubdomain", "DstIP", "Email", "InternalDNSFallbackStrategy", "InternalDNSViewID",
    "InternalDNSZoneID", "Location", "LocationID", "Policy", "PolicyID", "PolicyName", "Protocol", "QueryID",
    "QueryName", "QueryNameReversed", "QueryTypeName", "RedirectTargetURI", "RegistrationID",
    "ResolverDecision", "ResolverPolicyID", "ResolverPolicyName", "SrcIP", "SrcIPContinentCode",
    "SrcIPCountryCode", "TimeZone", "TimeZoneInferredMethod", "UserID",
)
# Numbers may be delivered as text, so both are read through text.
INTS = (
    "ColoID", "CustomResolveDurationMs", "DstPort", "InternalDNSRCode", "QuerySize", "QueryType", "RCode",
    "SrcPort",
)
BOOLEANS = ["IsResponseCached"]
TEXT_LISTS = (
    "AuthoritativeNameServerIPs", "CNAMECategoryNames", "CNAMEs", "CNAMEsReversed", "InitialCategoryNames",
    "InitialResolvedIPs", "MatchedCategoryNames", "MatchedIndicatorFeedNames", "QueryApplicationNames",
    "QueryCategoryNames", "QueryIndicatorFeedNames", "RequestContextCategoryNames", "ResolvedIPCategoryNames",
    "ResolvedIPContinentCodes", "ResolvedIPCountryCodes", "ResolvedIPs",
)
INT_LISTS = (
    "CNAMECategoryIDs", "EDEErrors", "InitialCategoryIDs", "MatchedCategoryIDs", "MatchedIndicatorFeedIDs",
    "QueryApplicationIDs", "QueryCategoryIDs", "QueryIndicatorFeedIDs", "RequestContextCategoryIDs",
    "ResolvedIPCategoryIDs",
)
RECORD_LISTS = ["RData", "ResourceRecords", "ResourceRecordsJSON"]

# Parsed columns that have a place in the class, so are no leftovers.
MAPPED = (
    "ApplicationName", "DeviceID", "DeviceName", "DstIP", "DstPort", "Location", "LocationID",
    "MatchedCategoryNames", "MatchedIndicatorFeedNames", "Policy", "PolicyID", "PolicyName", "Protocol",
    "QueryName", "QuerySize", "QueryTypeName", "RCode", "ResolvedIPContinentCodes", "ResolvedIPCountryCodes",
    "ResolvedIPs", "ResourceRecordsJSON", "SrcIP", "SrcIPContinentCode", "SrcIPCountryCode", "SrcPort",
    "UserID",
)


def flow(*inputs: str) -> Flow:
    return Flow(
        name="cloudflare_gateway_dns",
        provider="cloudflare",
        log_name="gateway_dns",
        ingest=Ingest(
            name="cloudflare_gateway_dns_bronze",
            inputs=inputs,
            format="json",
            single_variant=True,
            pre=(
                (
                    F.lit("cloudflare").alias("source"),
                    F.lit("gateway_dns").alias("sourcetype"),
                    n.text("$.Datetime").try_cast("timestamp").alias("time"),
                    "data",
                ),
            ),
        ),
        silver=(parsed(),),
        gold=(dns_activity(),),
    )


RECORDS = "array<map<string,string>>"
# The type each key is read as.
KINDS = {
    **dict.fromkeys((*TEXTS, *INTS, *BOOLEANS), "string"),
    **dict.fromkeys(TEXT_LISTS, "array<string>"),
    **dict.fromkeys(INT_LISTS, "array<int>"),
    **dict.fromkeys(RECORD_LISTS, RECORDS),
}


def _parsed_columns() -> dict:
    # A list may also be delivered as a text of JSON; only then is it parsed.
    records = lambda key: F.coalesce(n.member(key), F.from_json(n.text(f"$.{key}"), RECORDS))
    columns = {
        **{key: n.member(key) for key in (*TEXTS, *TEXT_LISTS, *INT_LISTS)},
        **{key: n.member(key).try_cast("int") for key in INTS},
        **{key: n.member(key).try_cast("boolean") for key in BOOLEANS},
        **{key: records(key) for key in RECORD_LISTS},
    }
    return dict(sorted(columns.items(), key=lambda item: item[0].lower()))


def parsed() -> SilverSpec:
    return SilverSpec(
        name=PARSED, preserve=True, temporary=(Field("record", n.record(KINDS)),), fields=fields(_parsed_columns())
    )


def dns_activity() -> GoldSpec:
    col = F.col
    code, decision = col("RCode"), F.lower("ResolverDecision")
    by_decision = lambda position, default: n.lookup(
        decision, n.column_of(codes.RESOLVER_DECISIONS, position), default
    )
    activity = n.lookup(col("activity_id"), {1: "Query", 2: "Response"}, "Unknown")
    categories, feeds = col("MatchedCategoryNames"), col("MatchedIndicatorFeedNames")
    return GoldSpec(
        name="dns_activity",
        input=PARSED,
        temporary=(Field("found_answers", n.dns_answers(col("ResourceRecordsJSON"))),),
        fields=fields(
            {
                "time": col("time"),
                "answers": col("found_answers"),
                "activity_id": n.first_match([(col("found_answers").isNotNull(), 2)], 1),
                "activity_name": activity,
                "activity": activity,
                "app_name": col("ApplicationName"),
                **n.class_columns("dns_activity"),
                "type_uid": n.type_uid(col("class_uid"), col("activity_id")),
                "type_name": F.concat(
                    F.lit("DNS Activity: "), col("activity_name"), F.lit(" ["), col("QueryTypeName"), F.lit("]")
                ),
                "rcode": n.dns_rcode_name(code),
                "rcode_id": code,
                "severity_id": F.lit(1),
                "severity": F.lit("Informational"),
                "status_id": n.dns_status_id(code),
                "status": n.dns_status(code),
                "status_code": code.cast("string"),
                "status_detail": n.dns_rcode_detail(code),
                "timezone_offset": n.null_of("int"),
                "action_id": by_decision(0, 99),
                "action": by_decision(1, "Other"),
                "disposition_id": by_decision(2, 0),
                "disposition": by_decision(3, "Unknown"),
                "enrichments": F.when(
                    (F.size(categories) > 0) | (F.size(feeds) > 0),
                    F.concat(
                        n.enrichments_of("Matched Category", categories),
                        n.enrichments_of("Matched Threat Feed", feeds),
                    ),
                ),
                # The number, not the code's name: the input column wins over the output.
                "message": n.sentence(
                    "DNS ", col("activity_name"), " for ", col("QueryName"), " (", col("QueryTypeName"), ") - ",
                    (code, "Unknown"),
                    F.coalesce(F.concat(F.lit(" - Decision: "), col("ResolverDecision")), F.lit("")),
                ),
                "observables": F.concat(
                    n.observables([("query_hostname", "Hostname", col("QueryName"))]),
                    n.observables_of("resolved_ip", "IP Address", col("ResolvedIPs")),
                ),
                "raw_data": n.raw_record(col("data")),
                "unmapped": n.unmapped(sorted((name for name in KINDS if name not in MAPPED), key=str.lower)),
                "connection_info.uid": col("QueryID"),
                "connection_info.protocol_name": F.lower("Protocol"),
                "connection_info.protocol_num": n.protocol_number(col("Protocol"), codes.DNS_TRANSPORT_NUMBERS),
                "connection_info.direction": F.lit("Unknown"),
                "connection_info.direction_id": F.lit(0),
                "src_endpoint.ip": col("SrcIP"),
                "src_endpoint.port": col("SrcPort"),
                "src_endpoint.location.continent": col("SrcIPContinentCode"),
                "src_endpoint.location.country": col("SrcIPCountryCode"),
                "src_endpoint.uid": col("UserID"),
                "src_endpoint.domain": col("DeviceName"),
                "dst_endpoint.ip": col("DstIP"),
                "dst_endpoint.port": col("DstPort"),
                "dst_endpoint.location.continent": F.get("ResolvedIPContinentCodes", F.lit(0)),
                "dst_endpoint.location.country": F.get("ResolvedIPCountryCodes", F.lit(0)),
                "dst_endpoint.location.city": col("Location"),
                "dst_endpoint.uid": col("LocationID"),
                "query.hostname": col("QueryName"),
                "query.type": col("QueryTypeName"),
                "query.class": F.lit("IN"),
                "query.packet_uid": n.null_of("int"),
                "query.opcode": F.lit("Query"),
                "query.opcode_id": F.lit(0),
                "policy.name": col("PolicyName"),
                "policy.uid": col("PolicyID"),
                "policy.is_applied": col("PolicyID").isNotNull(),
                "traffic.bytes_in": col("QuerySize"),
                **n.metadata(
                    "Gateway DNS", "Cloudflare", "cloudflare", "gateway_dns", "JSON",
                    correlation_uid=col("QueryID"),
                    logged_time=col("time"),
                    processed_time=F.current_timestamp(),
                    uid=col("QueryID"),
                ),
            }
        ),
    )
