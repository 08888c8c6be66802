"""Cisco IOS syslog text to four event classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions import normalize as n
from siltstone.plans.spec import Field, Flow, GoldSpec, Ingest, SilverSpec, fields

PARSED = "cisco_ios_silver"

# Which facilities and mnemonics belong to which class.
LOGIN_FACILITIES = ("AAA", "SEC_LOGIN")
DENIALS = ("EXEC_FAILED", "CLI_DENIED", "ACCESS_DENIED")
INTERFACE_FACILITIES = ("LINK", "LINEPROTO", "ETHCNTR", "IFMON", "DEBUG")
SYSTEM_FACILITIES = ("SYS", "CPU", "MEM", "ENV")

ADDRESS = r"(\d+\.\d+\.\d+\.\d+)"


def flow(*inputs: str) -> Flow:
    return Flow(
        name="cisco_ios",
        provider="cisco",
        log_name="ios",
        ingest=Ingest(
            name="cisco_ios_bronze",
            inputs=inputs,
            format="text",
            pre=(
                (
                    F.lit("cisco").alias("source"),
                    F.lit("ios").alias("sourcetype"),
                    n.ios_time(F.col("value")).alias("time"),
                    "value",
                ),
            ),
        ),
        silver=(parsed(),),
        gold=(authentication(), authorize_session(), network_activity(), process_activity()),
    )


def parsed() -> SilverSpec:
    return SilverSpec(
        name=PARSED,
        preserve=True,
        temporary=(Field("ios_parts", n.ios_parts(F.col("value"))),),
        fields=fields(
            {
                **{name: F.get("ios_parts", F.lit(position)) for position, name in enumerate(n.IOS_PARTS)},
                # Mappings choose rows by these, so each is read alone: a filter needs no more.
                **{name: n.ios_part(F.col("value"), name) for name in ("facility", "mnemonic")},
            }
        ),
    )


def _found(pattern: str) -> Column:
    """First group of a pattern in the message text; empty when it does not occur."""
    return F.regexp_extract("description", pattern, 1)


def _shared(event_class: str) -> dict[str, Column]:
    return {
        "time": F.col("time"),
        **n.class_columns(event_class),
        "type_uid": n.type_uid(F.col("class_uid"), F.col("activity_id")),
        "status_code": F.col("mnemonic"),
        "status_detail": F.col("description"),
        # The parsed column `severity` is the syslog digit, not the output name.
        "severity_id": n.syslog_severity(F.col("severity")),
        "severity": n.severity_name(F.col("severity_id")),
        "timezone_offset": n.null_of("int"),
        "message": F.col("description"),
        **n.metadata(
            "IOS", "Cisco", "cisco", "ios", "syslog",
            processed_time=F.current_timestamp(),
            logged_time=F.col("time"),
            event_code=F.col("mnemonic"),
            uid=F.col("seq_no"),
        ),
        "raw_data": n.raw_record(F.col("value")),
        "unmapped": n.unmapped(("seq_no", "facility", "severity", "mnemonic", "timestamp")),
    }


def authentication() -> GoldSpec:
    mnemonic, level = F.col("mnemonic"), F.col("severity")
    logout = mnemonic == "LOGOUT"
    success = F.upper(mnemonic).contains("SUCCESS")
    failure = F.upper(mnemonic).contains("FAIL")
    address, account = F.col("found_address"), F.col("found_user")
    activity = n.lookup(F.col("activity_id"), {0: "Unknown", 1: "Logon", 2: "Logoff"})
    return GoldSpec(
        name="authentication",
        input=PARSED,
        filter=F.concat_ws("-", "facility", "mnemonic").rlike(f"^({'|'.join(LOGIN_FACILITIES)})-LOGIN|^SYS-LOGOUT$"),
        temporary=(
            Field("found_address", F.when(logout, _found(rf"\({ADDRESS}\)")).otherwise(_found(rf"Source:\s*{ADDRESS}"))),
            Field("found_user", F.when(logout, _found(r"User\s+(\w+)")).otherwise(_found(r"user:\s*(\w+)"))),
        ),
        fields=fields(
            {
                "activity_id": n.first_match(
                    [(logout, 2), (success | (level == "5"), 1), (failure | (level == "4"), 2)], 0
                ),
                "activity_name": activity,
                "activity": activity,
                **_shared("authentication"),
                "action_id": n.first_match([(success | logout, 1), (failure, 2)], 99),
                "action": n.action_name(F.col("action_id")),
                "status_id": n.first_match(
                    [(success | (level == "5") | logout, 1), (failure | (level == "4"), 2)], 99
                ),
                "status": n.status_name(F.col("status_id")),
                "disposition_id": n.first_match([(success | logout, 1), (failure, 2)], 0),
                "disposition": n.disposition_name(F.col("disposition_id")),
                "type_name": n.type_name("Authentication", F.col("activity_name")),
                "auth_protocol": F.lit("Unknown"),
                "auth_protocol_id": F.lit(0),
                "is_remote": F.coalesce(address != "", F.lit(False)),
                "user.name": account,
                "src_endpoint.ip": address,
                "src_endpoint.port": _found(r"localport:\s*(\d+)").try_cast("int"),
                "observables": n.observables(
                    [
                        ("src_endpoint.ip", "IP Address", n.missing_as_null(address, "")),
                        ("user.name", "User Name", n.missing_as_null(account, "")),
                    ]
                ),
            }
        ),
    )


def authorize_session() -> GoldSpec:
    return GoldSpec(
        name="authorize_session",
        input=PARSED,
        filter=F.col("mnemonic").isin(*DENIALS),
        fields=fields(
            {
                "activity_id": F.lit(99),
                "activity_name": F.lit("Other"),
                **_shared("authorize_session"),
                "action_id": F.lit(2),
                "action": F.lit("Denied"),
                "status_id": F.lit(2),
                "status": F.lit("Failure"),
                "type_name": F.lit("Authorize Session: Other"),
                "user.name": _found(r"User\s+(\w+)"),
                "dst_endpoint.svc_name": _found(r"attempted to\s+(\w+)"),
            }
        ),
    )


def network_activity() -> GoldSpec:
    updown = F.col("mnemonic") == "UPDOWN"
    shout = F.upper("description")
    link = n.first_match([(updown & shout.contains("UP"), 1), (updown & shout.contains("DOWN"), 2)], 99)
    activity = n.lookup(F.col("activity_id"), {1: "Open", 2: "Close", 99: "Other"})
    return GoldSpec(
        name="network_activity",
        input=PARSED,
        filter=F.col("facility").isin(*INTERFACE_FACILITIES),
        fields=fields(
            {
                "activity_id": link,
                "activity_name": activity,
                "activity": activity,
                **_shared("network_activity"),
                "action_id": F.col("activity_id"),
                "action": n.lookup(F.col("activity_id"), {1: "Allowed", 2: "Blocked", 99: "Other"}),
                "status_id": F.lit(99),
                "status": F.lit("Other"),
                "disposition_id": n.lookup(F.col("activity_id"), {1: 1, 2: 2}, 0),
                "disposition": n.disposition_name(F.col("disposition_id")),
                "start_time": F.col("time"),
                "end_time": n.null_of("timestamp"),
                "type_name": n.type_name("Network Activity", F.col("activity_name")),
                "connection_info.uid": F.col("seq_no"),
                "connection_info.protocol_name": F.col("facility"),
                "dst_endpoint.interface_name": _found(r"Interface\s+([^,]+)"),
            }
        ),
    )


def process_activity() -> GoldSpec:
    failed = F.col("mnemonic").contains("FAILURE")
    either = lambda bad, good: n.first_match([(failed, bad)], good)
    return GoldSpec(
        name="process_activity",
        input=PARSED,
        filter=F.col("facility").isin(*SYSTEM_FACILITIES),
        fields=fields(
            {
                "activity_id": F.lit(99),
                "activity_name": F.lit("Other"),
                "activity": F.lit("Other"),
                **_shared("process_activity"),
                "action_id": either(0, 1),
                "action": either("Failed", "Allowed"),
                "status_id": either(2, 1),
                "status": either("Failure", "Success"),
                "disposition_id": either(4, 1),
                "disposition": either("Failed", "Allowed"),
                "type_name": F.lit("Process Activity: Other"),
                "actor.user.name": n.first_match(
                    [
                        (F.col("mnemonic") == "RELOAD", _found(r"requested by user\s+(\w+)")),
                        (F.col("mnemonic") == "CONFIG_I", _found(r"by\s+(\w+)\s+on")),
                    ]
                ),
            }
        ),
    )
