"""The ready-made flows by name."""

from __future__ import annotations

from collections.abc import Callable

from siltstone.plans.spec import Flow
from siltstone.sources import aws_vpc, cisco_ios, cloudflare_dns, github_audit, okta, zeek

FLOWS: dict[str, Callable[..., Flow]] = {
    "aws_vpc_flowlogs": aws_vpc.flow,
    "cisco_ios": cisco_ios.flow,
    "cloudflare_gateway_dns": cloudflare_dns.flow,
    "github_audit_logs": github_audit.flow,
    "okta_system_log": okta.flow,
    "zeek_conn": zeek.flow,
}
