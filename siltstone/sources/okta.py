"""Okta system log (JSON) to authentication, account change and group management."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions import codes
from siltstone.functions import normalize as n
from siltstone.plans.spec import Field, Flow, GoldSpec, Ingest, SilverSpec, fields

PARSED = "okta_system_log_silver"

# Column -> path of a text in the record.
TEXT_PATHS = {
    "uuid": "uuid",
    "display_message": "displayMessage",
    "severity": "severity",
    "legacy_event_type": "legacyEventType",
    "outcome_result": "outcome.result",
    "outcome_reason": "outcome.reason",
    "actor_id": "actor.id",
    "actor_type": "actor.type",
    "actor_alternate_id": "actor.alternateId",
    "actor_display_name": "actor.displayName",
    "client_ip": "client.ipAddress",
    "client_device": "client.device",
    "client_os": "client.userAgent.os",
    "client_browser": "client.userAgent.browser",
    "client_user_agent": "client.userAgent.rawUserAgent",
    "geo_city": "client.geographicalContext.city",
    "geo_state": "client.geographicalContext.state",
    "geo_country": "client.geographicalContext.country",
    "sec_isp": "securityContext.isp",
    "sec_domain": "securityContext.domain",
    "sec_as_org": "securityContext.asOrg",
    "auth_provider": "authenticationContext.authenticationProvider",
    "auth_credential_type": "authenticationContext.credentialType",
    "auth_interface": "authenticationContext.interface",
    "auth_external_session_id": "authenticationContext.externalSessionId",
    "transaction_id": "transaction.id",
    "debug_request_uri": "debugContext.debugData.requestUri",
    "debug_request_id": "debugContext.debugData.requestId",
}
PROXY = "securityContext.isProxy"
TARGETS = "array<struct<id:string,type:string,alternateId:string,displayName:string>>"

# Event types of each class.
AUTHENTICATION = (
    r"user\.session\.(start|end)|user\.authentication\."
    r"(sso|auth_via_mfa|auth_via_radius|verify_push_approve|verify_push_reject)"
)
ACCOUNT_CHANGE = (
    r"user\.lifecycle\.(create|activate|deactivate|reactivate|delete_initiated)"
    r"|user\.account\.(lock|unlock|reset_password|update_password)"
)
GROUP_MANAGEMENT = r"group\.user_membership\.(add|remove)|group\.lifecycle\.(create|delete)"

# Event type -> (activity id, activity name); anything else is 99, Other.
ACCOUNT_ACTIVITIES = {
    "user.lifecycle.create": (1, "Create"),
    "user.lifecycle.activate": (2, "Enable"),
    "user.lifecycle.reactivate": (2, "Enable"),
    "user.account.unlock": (2, "Enable"),
    "user.account.reset_password": (3, "Password Change"),
    "user.account.update_password": (3, "Password Change"),
    "user.lifecycle.deactivate": (4, "Disable"),
    "user.lifecycle.delete_initiated": (5, "Delete"),
    "user.account.lock": (99, "Other"),
}
GROUP_ACTIVITIES = {
    "group.lifecycle.create": (1, "Create"),
    "group.lifecycle.delete": (4, "Delete"),
    "group.user_membership.add": (5, "Add"),
    "group.user_membership.remove": (6, "Remove"),
}


def flow(*inputs: str) -> Flow:
    return Flow(
        name="okta_system_log",
        provider="okta",
        log_name="system_log",
        ingest=Ingest(
            name="okta_system_log_bronze",
            inputs=inputs,
            format="json",
            single_variant=True,
            pre=(
                (
                    F.lit("okta").alias("source"),
                    F.lit("system_log").alias("sourcetype"),
                    n.text("$.published").try_cast("timestamp").alias("time"),
                    "data",
                ),
            ),
        ),
        silver=(parsed(),),
        gold=(authentication(), account_change(), group_management()),
    )


def parsed() -> SilverSpec:
    first = lambda kind, member: n.first_of_type(n.member("target"), kind)[member]
    kinds = {**dict.fromkeys(TEXT_PATHS.values(), "string"), PROXY: "string", "target": TARGETS}
    return SilverSpec(
        name=PARSED,
        preserve=True,
        temporary=(Field("record", n.record(kinds)),),
        fields=fields(
            {
                # Mappings choose rows by it, so it is read alone: a filter on it needs no more.
                "event_type": n.text("$.eventType"),
                **{name: n.member(path) for name, path in TEXT_PATHS.items()},
                "sec_is_proxy": n.member(PROXY).try_cast("boolean"),
                "target_user_id": first("User", "id"),
                "target_user_alternate_id": first("User", "alternateId"),
                "target_user_display_name": first("User", "displayName"),
                "target_group_id": first("UserGroup", "id"),
                "target_group_name": first("UserGroup", "displayName"),
                "target_app_id": first("AppInstance", "id"),
                "target_app_name": first("AppInstance", "displayName"),
            }
        ),
    )


def _shared(event_class: str, challenge: int = 0) -> dict[str, Column]:
    outcome = {**codes.OUTCOME_STATUS, "CHALLENGE": challenge}
    return {
        "time": F.col("time"),
        **n.class_columns(event_class),
        "type_uid": n.type_uid(F.col("class_uid"), F.col("activity_id")),
        "status_id": n.lookup(F.col("outcome_result"), outcome, 0),
        "status": n.status_name(F.col("status_id")),
        # The parsed column `severity` is the vendor's word, not the output name.
        "severity_id": n.word_severity(F.col("severity")),
        "severity": n.severity_name(F.col("severity_id")),
        "timezone_offset": n.null_of("int"),
        "message": F.col("display_message"),
        "raw_data": n.raw_record(F.col("data")),
        "src_endpoint.ip": F.col("client_ip"),
        "src_endpoint.location.city": F.col("geo_city"),
        "src_endpoint.location.country": F.col("geo_country"),
        **n.metadata(
            "Okta System Log", "Okta", "okta", "system_log", "JSON",
            uid=F.col("uuid"),
            event_code=F.col("event_type"),
            logged_time=F.col("time"),
            processed_time=F.current_timestamp(),
        ),
    }


def _outcome_text() -> dict[str, Column]:
    return {"status_code": F.col("outcome_result"), "status_detail": F.col("outcome_reason")}


def _actor(prefix: str) -> dict[str, Column]:
    return n.user(
        prefix,
        F.col("actor_id"),
        F.col("actor_alternate_id"),
        full_name=F.col("actor_display_name"),
        type=F.col("actor_type"),
    )


def _target_user() -> dict[str, Column]:
    return n.user(
        "user",
        F.col("target_user_id"),
        F.col("target_user_alternate_id"),
        full_name=F.col("target_user_display_name"),
        type=F.lit("User"),
    )


def authentication() -> GoldSpec:
    event = F.col("event_type")
    opened = event.endswith("session.start") | event.endswith(".sso") | event.contains("auth_via")
    closed = event.endswith("session.end")
    logon = opened | event.endswith("verify_push_approve")
    activity = n.lookup(F.col("activity_id"), {1: "Logon", 2: "Logoff"}, "Other")
    interface, credential = F.col("auth_interface"), F.col("auth_credential_type")
    by_protocol = lambda saml, otp, password, other: n.first_match(
        [(interface == "SAML2.0", saml), (credential == "OTP", otp), (credential == "PASSWORD", password)], other
    )
    return GoldSpec(
        name="authentication",
        input=PARSED,
        filter=event.rlike(AUTHENTICATION),
        fields=fields(
            {
                "activity_id": n.first_match([(logon, 1), (closed, 2)], 99),
                "activity_name": activity,
                "activity": activity,
                **_shared("authentication", challenge=99),
                **_outcome_text(),
                "action_id": n.lookup(F.col("outcome_result"), codes.OUTCOME_STATUS, 0),
                "action": n.action_name(F.col("action_id")),
                "is_mfa": event.rlike("auth_via_mfa|verify_push"),
                "is_remote": F.lit(True),
                "auth_protocol": by_protocol("SAML", "TOTP", "Password", F.coalesce(interface, credential)),
                "auth_protocol_id": by_protocol(5, 99, 1, 0),
                # An approved push counts as a logon, yet its type name says otherwise.
                "type_name": n.type_name("Authentication", n.first_match([(opened, "Logon"), (closed, "Logoff")], "Other")),
                **_actor("user"),
                "src_endpoint.location.region": F.col("geo_state"),
                "dst_endpoint.hostname": F.lit("acme.okta.com"),
                "dst_endpoint.name": F.lit("Okta"),
                "session.uid": F.col("auth_external_session_id"),
                "observables": n.observables(
                    [
                        ("user.name", "User Name", F.col("actor_alternate_id")),
                        ("src_endpoint.ip", "IP Address", F.col("client_ip")),
                    ]
                ),
                "enrichments": n.enrichments([("isp", F.col("sec_isp")), ("target_app", F.col("target_app_name"))]),
                "unmapped": n.unmapped(
                    (
                        "uuid", "event_type", "legacy_event_type", "auth_provider", "auth_credential_type",
                        "client_device", "client_os", "client_browser", "client_user_agent", "sec_domain",
                        "sec_is_proxy", "sec_as_org", "transaction_id", "debug_request_uri",
                    )
                ),
            }
        ),
    )


def _change_leftovers() -> Column:
    return n.unmapped(
        (
            "uuid", "event_type", "legacy_event_type", "actor_type", "client_device", "client_os",
            "client_user_agent", "sec_is_proxy", "sec_domain", "debug_request_uri", "transaction_id",
        )
    )


def _change(event_class: str, activities: dict[str, tuple[int, str]]) -> dict[str, Column]:
    """Fields that account change and group management have in common."""
    event = F.col("event_type")
    activity = n.lookup(event, n.column_of(activities, 1), "Other")
    return {
        "activity_id": n.lookup(event, n.column_of(activities, 0), 99),
        "activity_name": activity,
        "activity": activity,
        **_shared(event_class),
        "type_name": n.type_name(codes.CLASSES[event_class][1], F.col("activity_name")),
        **_actor("actor.user"),
        **_target_user(),
        "enrichments": n.enrichments([("isp", F.col("sec_isp"))]),
        "unmapped": _change_leftovers(),
    }


def account_change() -> GoldSpec:
    return GoldSpec(
        name="account_change",
        input=PARSED,
        filter=F.col("event_type").rlike(ACCOUNT_CHANGE),
        fields=fields(
            {
                **_change("account_change", ACCOUNT_ACTIVITIES),
                **_outcome_text(),
                "action_id": n.first_match([(F.col("outcome_result").isin("SUCCESS", "ALLOW"), 1)], 2),
                "action": n.action_name(F.col("action_id")),
                "observables": n.observables(
                    [
                        ("actor.user.name", "User Name", F.col("actor_alternate_id")),
                        ("user.name", "User Name", F.col("target_user_alternate_id")),
                        ("src_endpoint.ip", "IP Address", F.col("client_ip")),
                    ]
                ),
            }
        ),
    )


def group_management() -> GoldSpec:
    return GoldSpec(
        name="group_management",
        input=PARSED,
        filter=F.col("event_type").rlike(GROUP_MANAGEMENT),
        fields=fields(
            {
                **_change("group_management", GROUP_ACTIVITIES),
                "action_id": F.lit(1),
                "action": F.lit("Allowed"),
                "group.uid": F.col("target_group_id"),
                "group.name": F.col("target_group_name"),
                "group.type": F.lit("Security Group"),
                "observables": n.observables(
                    [
                        ("actor.user.name", "User Name", F.col("actor_alternate_id")),
                        ("user.name", "User Name", F.col("target_user_alternate_id")),
                        ("group.name", "Group Name", F.col("target_group_name")),
                    ]
                ),
            }
        ),
    )
