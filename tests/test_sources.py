"""Golden rows: hand-written log lines and the class values they must give."""

import pytest
from pyspark.sql import functions as F

import samples
from siltstone.plans.chain import run_batch, summary
from siltstone.sources.catalogue import FLOWS


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    made = {}

    def build(name):
        if name not in made:
            path = samples.write(tmp_path_factory.mktemp(name), samples.BY_FLOW[name])
            made[name] = run_batch(spark, FLOWS[name](path))
        return made[name].gold

    return build


def values(df, *columns):
    uid = F.col("metadata.uid")
    return {r[0]: tuple(r[1:]) for r in df.select(uid, *(F.expr(c) for c in columns)).collect()}


OBSERVED = "array_join(transform(observables, x -> concat(x.name, '=', x.value)), ';')"
ENRICHED = "array_join(transform(enrichments, x -> concat(x.name, '=', x.value)), ';')"


def test_zeek(gold):
    rows = values(
        gold("zeek_conn")["network_activity"],
        "activity_id", "activity_name", "action", "action_id", "disposition", "disposition_id", "status", "status_detail",
        "type_uid", "connection_info.direction_id", "connection_info.direction", "connection_info.protocol_num",
        "traffic.bytes", "string(time)", "string(end_time)",
    )
    assert rows == {
        "C1": (2, "Close", "Allowed", 1, "Allowed", 1, "Success", "Normal establishment and termination", 400102, 2,
               "Outbound", 17, 160, "2023-11-14 22:13:20.5", "2023-11-14 22:13:21"),
        "C2": (3, "Refuse", "Denied", 2, "Blocked", 2, "Success", "Connection attempt rejected", 400103, 1, "Inbound", 6,
               None, "2023-11-14 22:13:21", None),
        "C3": (4, "Fail", "Failed", 0, "Failed", 4, "Failure", "Connection attempt seen, no reply", 400104, 3, "Lateral",
               6, None, "2023-11-14 22:13:22", None),
        "C4": (6, "Traffic", "Failed", 0, "Failed", 4, "Success", "Originator sent a SYN followed by a RST", 400106, 0,
               "Unknown", 1, None, "2023-11-14 22:13:23", None),
        "C5": (6, "Traffic", "Allowed", 1, "Allowed", 1, "Success", "WEIRD", 400106, 0, "Unknown", None, None,
               "2023-11-14 22:13:24", None),
    }
    messages = values(gold("zeek_conn")["network_activity"], "message")
    assert messages["C3"] == (
        "Network connection Fail from 192.168.1.2:5555 to 172.31.0.1:? (TCP) - Connection attempt seen, no reply",
    )
    assert messages["C5"] == ("Network connection Traffic from unknown:? to unknown:? (GRE) - WEIRD",)


def test_ios_authentication(gold):
    rows = values(
        gold("cisco_ios")["authentication"],
        "activity_name", "action", "status", "disposition", "severity_id", "severity", "type_name", "is_remote",
        "user.name", "src_endpoint.ip", "src_endpoint.port", OBSERVED,
    )
    assert rows == {
        "000101": ("Logon", "Allowed", "Success", "Allowed", 2, "Low", "Authentication: Logon", True, "ann", "10.1.1.9",
                   22, "src_endpoint.ip=10.1.1.9;user.name=ann"),
        "000102": ("Logoff", "Denied", "Failure", "Blocked", 3, "Medium", "Authentication: Logoff", True, "bob",
                   "203.0.113.4", 22, "src_endpoint.ip=203.0.113.4;user.name=bob"),
        "000103": ("Logoff", "Allowed", "Success", "Allowed", 1, "Informational", "Authentication: Logoff", True, "ann",
                   "10.1.1.9", None, "src_endpoint.ip=10.1.1.9;user.name=ann"),
    }


def test_ios_other_classes(gold):
    classes = gold("cisco_ios")
    assert values(classes["authorize_session"], "action", "user.name", "dst_endpoint.svc_name", "type_uid") == {
        "000106": ("Denied", "eve", "reload", 300399),
    }
    assert values(
        classes["network_activity"], "activity_name", "action_id", "disposition", "severity", "dst_endpoint.interface_name"
    ) == {
        "000104": ("Open", 1, "Allowed", "High", "Gi0/1"),
        "000105": ("Close", 2, "Blocked", "Low", "Gi0/2"),
    }
    # The logout is in two classes; the last line is no syslog line and in none.
    assert values(classes["process_activity"], "action", "status", "disposition_id", "actor.user.name", "string(time)") == {
        "000103": ("Allowed", "Success", 1, None, "2025-03-03 08:00:03"),
        "000107": ("Allowed", "Success", 1, "ann", "2025-03-03 08:00:07"),
        "000108": ("Failed", "Failure", 4, None, "2025-03-03 08:00:08"),
        "000109": ("Allowed", "Success", 1, "ann", "2025-03-03 08:00:09"),
    }


def test_vpc(gold):
    df = gold("aws_vpc_flowlogs")["network_activity"].withColumn(
        "metadata", F.struct(F.coalesce("src_endpoint.interface_uid", F.lit("?")).alias("uid"))
    )
    rows = sorted(
        tuple(r)
        for r in df.select(
            F.date_format("time", "ss").alias("s"), "src_endpoint.ip", "dst_endpoint.port", "connection_info.protocol_name",
            "connection_info.direction", "action", "disposition", "severity", "status", "status_detail", "message",
        ).collect()
    )
    assert rows == [
        ("20", "10.0.0.9", 443, "tcp", "Outbound", "Allowed", "Allowed", "Informational", "Success", "Flow log recorded",
         "ACCEPT 10.0.0.1:40000 -> 52.1.1.1:443 eni=eni-a"),
        ("21", "52.1.1.1", 40000, "tcp", "Inbound", "Allowed", "Allowed", "Informational", "Success", "Flow log recorded",
         "ACCEPT 52.1.1.1:443 -> 10.0.0.1:40000 eni=eni-a"),
        ("22", "10.0.0.1", 22, "tcp", "Lateral", "Denied", "Blocked", "Medium", "Success", "Flow rejected: BPA",
         "REJECT 10.0.0.1:40001 -> 10.9.0.1:22 eni=eni-b"),
        ("23", None, None, None, "Unknown", "Unknown", "Unknown", "Informational", "Other",
         "No data during aggregation interval", "NODATA on eni=eni-c"),
        ("24", "10.0.0.1", None, "icmp", "Lateral", "Allowed", "Allowed", "Informational", "Success", "Flow log recorded",
         "ACCEPT 10.0.0.1: -> 192.168.0.7: eni=eni-d"),
        # Without a start, the end of the interval is the event time.
        ("25", None, None, None, "Unknown", "Unknown", "Unknown", "Informational", "Other",
         "Data skipped during aggregation interval", "SKIPDATA on eni=eni-e"),
    ]


def test_dns(gold):
    rows = values(
        gold("cloudflare_gateway_dns")["dns_activity"],
        "activity_name", "rcode", "rcode_id", "status_id", "status", "status_detail", "action", "disposition",
        "connection_info.protocol_num", "size(answers)", "answers[0].ttl", "dst_endpoint.location.country",
        "policy.is_applied", OBSERVED, ENRICHED, "message",
    )
    assert rows == {
        "q1": ("Response", "NoError", 0, 1, "Success", "No Error", "Allowed", "Allowed", 17, 2, 300, "DE", True,
               "query_hostname=a.example;resolved_ip=192.0.2.1;resolved_ip=192.0.2.2", None,
               "DNS Response for a.example (A) - 0 - Decision: Allow"),
        "q2": ("Query", "NXDomain", 3, 2, "Failure", "Non-Existent Domain", "Denied", "Blocked", 17, None, None, None,
               False, "query_hostname=bad.example", "Matched Category=Malware;Matched Threat Feed=Feed",
               "DNS Query for bad.example (AAAA) - 3 - Decision: block"),
        "q3": ("Query", "Other", None, 0, "Unknown", "Other", "Challenged", "Other", 6, None, None, None, False,
               "query_hostname=odd.example", None, "DNS Query for odd.example (TXT) - Unknown - Decision: challenge"),
        "q4": ("Query", "Reserved", 4000, 2, "Failure", "Reserved", "Other", "Unknown", None, None, None, None, False, "",
               None, None),
    }


def test_okta(gold):
    classes = gold("okta_system_log")
    assert values(
        classes["authentication"], "activity_name", "type_name", "status", "action", "severity_id", "is_mfa", "auth_protocol",
        "auth_protocol_id", "user.name", "src_endpoint.location.city", OBSERVED, ENRICHED,
    ) == {
        "u1": ("Logon", "Authentication: Logon", "Success", "Allowed", 1, False, "TOTP", 99, "ann@x", "Bonn",
               "user.name=ann@x;src_endpoint.ip=10.0.0.1", "isp=net;target_app=App"),
        "u2": ("Logon", "Authentication: Other", "Other", "Unknown", 3, True, "SAML", 5, "ann@x", None, "user.name=ann@x", ""),
    }
    assert values(
        classes["account_change"], "activity_id", "activity_name", "status_id", "action_id", "severity", "user.name", "user.uid"
    ) == {"u3": (99, "Other", 2, 2, "High", "bob@x", "t3")}
    assert values(classes["group_management"], "activity_id", "type_uid", "group.name", "user.uid", "status_code") == {
        "u4": (5, 300605, "G", "t3", None),
    }


def test_github(gold):
    classes = gold("github_audit_logs")
    assert values(
        classes["account_change"], "activity_id", "severity", "action", "message", "user.name", OBSERVED, ENRICHED, "string(time)"
    ) == {
        "g1": (99, "Informational", "Allowed", "GitHub member added to organization: bob", "bob",
               "actor=ann;target_user=bob", "organization=acme;source=github", "2023-11-14 22:13:20"),
        "g2": (99, "Low", "Allowed", "GitHub member updated in organization: bob", "bob", "actor=ann;target_user=bob",
               "organization=acme;source=github", "2023-11-14 22:13:21"),
    }
    # A member update is in two classes.
    assert values(classes["user_access"], "activity_name", "privileges[0]", "class_name") == {
        "g2": ("Update", "admin", "User Access"),
    }
    assert values(classes["authentication"], "activity_name", "auth_protocol", "src_endpoint.ip") == {
        "g3": ("Logon", "Password", "192.0.2.9"),
        "g4": ("Logoff", "OAuth", None),
    }
    assert values(classes["authorize_session"], "activity_name", "resource.type", "privileges[0]", "user.name") == {
        "g5": ("Add", "Repository", "write", "bob"),
    }
    assert values(classes["group_management"], "activity_name", "severity", "group.name") == {"g6": ("Delete", "Medium", "core")}
    assert values(classes["entity_management"], "activity_name", "entity.uid", "entity.name") == {"g7": ("Update", "plain", None)}
    assert values(classes["api_activity"], "activity_name", "size(resources)", "api.operation") == {
        "g8": ("Create", 1, "git.push"),
        "g9": ("Connect", None, "deploy.finish"),
    }


@pytest.mark.parametrize("name", sorted(FLOWS))
def test_raw_record_and_version_are_kept(gold, name):
    for table, df in gold(name).items():
        row = df.select("raw_data", "metadata.log_version", "metadata.version", "dsl_id").withColumn(
            "origin", F.try_variant_get("raw_data", "$.source", "string")
        ).first()
        if row is not None:
            assert row["log_version"].startswith(row["origin"] + "@") and row["version"] == "1.7.0"
            assert len(row["dsl_id"]) == 24


def test_summary_counts_every_layer(spark, tmp_path):
    path = samples.write(tmp_path / "in", samples.IOS)
    result = {(r.layer, r.table): r.row_count for r in summary(run_batch(spark, FLOWS["cisco_ios"](path))).collect()}
    assert result[("bronze", "bronze")] == 10 and result[("gold", "process_activity")] == 4
