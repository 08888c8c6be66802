"""Ids and names that the event classes and log formats prescribe."""

from __future__ import annotations

# Event class -> (class id, class name, category id).
CLASSES = {
    "file_activity": (1001, "File System Activity", 1),
    "kernel_extension_activity": (1003, "Kernel Extension Activity", 1),
    "scheduled_job_activity": (1006, "Scheduled Job Activity", 1),
    "process_activity": (1007, "Process Activity", 1),
    "script_activity": (1008, "Script Activity", 1),
    "vulnerability_finding": (2002, "Vulnerability Finding", 2),
    "detection_finding": (2004, "Detection Finding", 2),
    "data_security_finding": (2006, "Data Security Finding", 2),
    "account_change": (3001, "Account Change", 3),
    "authentication": (3002, "Authentication", 3),
    "authorize_session": (3003, "Authorize Session", 3),
    "entity_management": (3004, "Entity Management", 3),
    "user_access": (3005, "User Access", 3),
    "group_management": (3006, "Group Management", 3),
    "network_activity": (4001, "Network Activity", 4),
    "http_activity": (4002, "HTTP Activity", 4),
    "dns_activity": (4003, "DNS Activity", 4),
    "dhcp_activity": (4004, "DHCP Activity", 4),
    "ssh_activity": (4007, "SSH Activity", 4),
    "email_activity": (4009, "Email Activity", 4),
    "api_activity": (6003, "API Activity", 6),
    "datastore_activity": (6005, "Datastore Activity", 6),
}

# Category id -> name.
CATEGORIES = {
    1: "System Activity",
    2: "Findings",
    3: "Identity & Access Management",
    4: "Network Activity",
    5: "Discovery",
    6: "Application Activity",
}

# Names of the shared id columns.
SEVERITY_NAMES = {0: "Unknown", 1: "Informational", 2: "Low", 3: "Medium", 4: "High", 5: "Critical", 6: "Fatal", 99: "Other"}
STATUS_NAMES = {0: "Unknown", 1: "Success", 2: "Failure", 99: "Other"}
ACTION_NAMES = {0: "Unknown", 1: "Allowed", 2: "Denied", 99: "Other"}
DISPOSITION_NAMES = {0: "Unknown", 1: "Allowed", 2: "Blocked", 99: "Other"}
DIRECTION_NAMES = {0: "Unknown", 1: "Inbound", 2: "Outbound", 3: "Lateral"}

# Syslog severity digit -> severity id; anything else is 99.
SYSLOG_SEVERITY = {0: 6, 1: 5, 2: 5, 3: 4, 4: 3, 5: 2, 6: 1, 7: 1}

# Vendor severity word -> severity id; anything else is 0.
WORD_SEVERITY = {"DEBUG": 1, "INFO": 1, "WARN": 3, "ERROR": 4}

# IP protocol numbers.
PROTOCOL_NAMES = {1: "icmp", 6: "tcp", 17: "udp", 47: "gre", 58: "icmpv6"}
TRANSPORT_NUMBERS = {"icmp": 1, "tcp": 6, "udp": 17}
DNS_TRANSPORT_NUMBERS = {"udp": 17, "tcp": 6, "doh": 17, "dot": 6}

# DNS response code -> (name, description).
DNS_RCODES = {
    0: ("NoError", "No Error"),
    1: ("FormError", "Format Error"),
    2: ("ServError", "Server Failure"),
    3: ("NXDomain", "Non-Existent Domain"),
    4: ("NotImp", "Not Implemented"),
    5: ("Refused", "Query Refused"),
    6: ("YXDomain", "Name Exists When It Should Not"),
    7: ("YXRRSet", "RR Set Exists When It Should Not"),
    8: ("NXRRSet", "RR Set That Should Exist Does Not"),
    9: ("NotAuth", "Not Authorized or Server Not Authoritative For Zone"),
    10: ("NotZone", "Name Not Contained in Zone"),
    11: ("DSOTYPENI", "DSO-TYPE Not Implemented"),
    16: ("BADSIG_VERS", "TSIG Signature Failure or Bad OPT Version"),
    17: ("BADKEY", "Key Not Recognized"),
    18: ("BADTIME", "Signature Out of Time Window"),
    19: ("BADMODE", "Bad TKEY Mode"),
    20: ("BADNAME", "Duplicate Key Name"),
    21: ("BADALG", "Algorithm Not Supported"),
    22: ("BADTRUNC", "Bad Truncation"),
    23: ("BADCOOKIE", "Bad or Missing Server Cookie"),
}
# Code ranges without a name of their own.
DNS_RCODE_RANGES = (
    (12, 15, "Unassigned"),
    (24, 3840, "Unassigned"),
    (3841, 4095, "Reserved"),
    (4096, 65534, "Unassigned"),
    (65535, 65535, "Reserved"),
)

# Zeek connection state -> (activity id, action id, disposition id, description).
ZEEK_STATES = {
    "S0": (4, 0, 4, "Connection attempt seen, no reply"),
    "S1": (6, 0, 1, "Connection established, not terminated"),
    "SF": (2, 1, 1, "Normal establishment and termination"),
    "REJ": (3, 2, 2, "Connection attempt rejected"),
    "S2": (6, 1, 1, "Connection established and close attempt by originator seen"),
    "S3": (6, 1, 1, "Connection established and close attempt by responder seen"),
    "RSTO": (2, 1, 1, "Connection established, originator aborted"),
    "RSTR": (2, 1, 1, "Responder sent a RST"),
    "RSTOS0": (6, 0, 4, "Originator sent a SYN followed by a RST"),
    "RSTRH": (2, 1, 1, "Responder sent a SYN ACK followed by a RST"),
    "SH": (2, 1, 1, "Originator sent a SYN followed by a FIN"),
    "SHR": (2, 1, 1, "Responder sent a SYN ACK followed by a FIN"),
    "OTH": (6, 0, 1, "No SYN seen, just midstream traffic"),
}
ZEEK_ACTIVITY_NAMES = {2: "Close", 3: "Refuse", 4: "Fail", 6: "Traffic"}
ZEEK_ACTION_NAMES = {0: "Failed", 1: "Allowed", 2: "Denied"}
ZEEK_DISPOSITION_NAMES = {1: "Allowed", 2: "Blocked", 4: "Failed"}

# Outcome word of an identity provider -> status id.
OUTCOME_STATUS = {"SUCCESS": 1, "ALLOW": 1, "FAILURE": 2, "DENY": 2}

# Resolver decision -> (action id, action, disposition id, disposition).
RESOLVER_DECISIONS = {
    "allow": (1, "Allowed", 1, "Allowed"),
    "block": (2, "Denied", 2, "Blocked"),
    "challenge": (3, "Challenged", 99, "Other"),
}
