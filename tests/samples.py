"""Hand-written log lines in the shape of each source."""

ZEEK = [
    '{"ts":1700000000.5,"uid":"C1","id.orig_h":"10.0.0.5","id.orig_p":51000,"id.resp_h":"8.8.4.4","id.resp_p":53,'
    '"proto":"udp","service":"dns","duration":1.25,"orig_bytes":40,"resp_bytes":120,"conn_state":"SF",'
    '"local_orig":true,"local_resp":false,"missed_bytes":0,"history":"Dd","orig_pkts":1,"resp_pkts":2}',
    '{"ts":1700000001.0,"uid":"C2","id.orig_h":"198.51.100.7","id.orig_p":4444,"id.resp_h":"172.16.9.9","id.resp_p":22,'
    '"proto":"TCP","conn_state":"REJ","orig_bytes":0}',
    '{"ts":1700000002.0,"uid":"C3","id.orig_h":"192.168.1.2","id.orig_p":5555,"id.resp_h":"172.31.0.1",'
    '"proto":"tcp","conn_state":"S0"}',
    '{"ts":1700000003.0,"uid":"C4","id.orig_h":"172.32.0.1","id.resp_h":"9.9.9.9","proto":"icmp","conn_state":"RSTOS0"}',
    '{"ts":1700000004.0,"uid":"C5","proto":"gre","conn_state":"WEIRD"}',
]

IOS = [
    "000101: Mar  3 2025 08:00:01: %SEC_LOGIN-5-LOGIN_SUCCESS: Login Success [user: ann] [Source: 10.1.1.9] [localport: 22]",
    "000102: Mar  3 2025 08:00:02: %SEC_LOGIN-4-LOGIN_FAILED: Login failed [user: bob] [Source: 203.0.113.4] [localport: 22]",
    "000103: Mar  3 2025 08:00:03: %SYS-6-LOGOUT: User ann has exited tty session 2(10.1.1.9)",
    "000104: Mar  3 2025 08:00:04: %LINK-3-UPDOWN: Interface Gi0/1, changed state to up",
    "000105: Mar  3 2025 08:00:05: %LINEPROTO-5-UPDOWN: Line protocol on Interface Gi0/2, changed state to down",
    "000106: Mar  3 2025 08:00:06: %PARSER-4-CLI_DENIED: User eve attempted to reload the device",
    "000107: Mar  3 2025 08:00:07: %SYS-5-CONFIG_I: Configured from console by ann on vty0 (10.1.1.9)",
    "000108: Mar  3 2025 08:00:08: %CPU-2-FAILURE: CPU 1 stopped",
    "000109: Mar  3 2025 08:00:09: %SYS-5-RELOAD: Reload requested by user ann on console",
    "no syslog line at all",
]

VPC = [
    "version account-id interface-id srcaddr dstaddr srcport dstport protocol packets bytes start end action log-status "
    "pkt-srcaddr flow-direction reject-reason",
    "2 111122223333 eni-a 10.0.0.1 52.1.1.1 40000 443 6 10 900 1700000000 1700000060 ACCEPT OK 10.0.0.9 - -",
    "2 111122223333 eni-a 52.1.1.1 10.0.0.1 443 40000 6 8 700 1700000001 1700000061 ACCEPT OK - ingress -",
    "2 111122223333 eni-b 10.0.0.1 10.9.0.1 40001 22 6 1 60 1700000002 1700000062 REJECT OK - - BPA",
    "2 111122223333 eni-c - - - - - - - 1700000003 1700000063 - NODATA - - -",
    "2 111122223333 eni-d 10.0.0.1 192.168.0.7 - - 1 4 336 1700000004 1700000064 ACCEPT OK - - -",
    "2 111122223333 eni-e - - - - - - - - 1700000065 - SKIPDATA - - -",
]

DNS = [
    '{"Datetime":"2025-03-03T08:00:00Z","QueryID":"q1","QueryName":"a.example","QueryTypeName":"A","RCode":0,"Protocol":"UDP",'
    '"SrcIP":"10.0.0.1","SrcPort":5300,"DstIP":"1.1.1.1","DstPort":"53","ResolverDecision":"Allow","PolicyID":"p1",'
    '"PolicyName":"base","ResolvedIPs":["192.0.2.1",null,"192.0.2.2"],"ResolvedIPCountryCodes":["DE"],'
    '"ResourceRecordsJSON":[{"class":"IN","type":"A","ttl":"300","rdata":"192.0.2.1"},{"class":"IN","type":"A","ttl":"x","rdata":"192.0.2.2"}]}',
    '{"Datetime":"2025-03-03T08:00:01Z","QueryID":"q2","QueryName":"bad.example","QueryTypeName":"AAAA","RCode":3,"Protocol":"doh",'
    '"ResolverDecision":"block","MatchedCategoryNames":["Malware"],"MatchedIndicatorFeedNames":["Feed"],"ResolvedIPCountryCodes":[]}',
    '{"Datetime":"2025-03-03T08:00:02Z","QueryID":"q3","QueryName":"odd.example","QueryTypeName":"TXT","Protocol":"dot",'
    '"ResolverDecision":"challenge"}',
    '{"Datetime":"2025-03-03T08:00:03Z","QueryID":"q4","QueryTypeName":"A","RCode":4000,"ResolverDecision":"other"}',
]

OKTA = [
    '{"uuid":"u1","published":"2025-03-03T08:00:00.000Z","eventType":"user.session.start","severity":"INFO",'
    '"displayMessage":"login","outcome":{"result":"SUCCESS"},"actor":{"id":"a1","type":"User","alternateId":"ann@x","displayName":"Ann"},'
    '"client":{"ipAddress":"10.0.0.1","geographicalContext":{"city":"Bonn"}},"securityContext":{"isProxy":false,"isp":"net"},'
    '"authenticationContext":{"credentialType":"OTP"},"target":[{"id":"t1","type":"AppInstance","displayName":"App"}]}',
    '{"uuid":"u2","published":"2025-03-03T08:00:01.000Z","eventType":"user.authentication.verify_push_approve","severity":"WARN",'
    '"outcome":{"result":"CHALLENGE"},"actor":{"id":"a1","alternateId":"ann@x"},"authenticationContext":{"interface":"SAML2.0"}}',
    '{"uuid":"u3","published":"2025-03-03T08:00:02.000Z","eventType":"user.account.lock","severity":"ERROR","outcome":{"result":"DENY"},'
    '"actor":{"id":"a2"},"target":[{"id":"t2","type":"UserGroup","displayName":"G"},{"id":"t3","type":"User","alternateId":"bob@x"}]}',
    '{"uuid":"u4","published":"2025-03-03T08:00:03.000Z","eventType":"group.user_membership.add","severity":"DEBUG",'
    '"outcome":{"result":"SUCCESS"},"actor":{"id":"a2"},"target":[{"id":"t3","type":"User","alternateId":"bob@x"},'
    '{"id":"t2","type":"UserGroup","displayName":"G"}]}',
    '{"uuid":"u5","published":"2025-03-03T08:00:04.000Z","eventType":"system.api_token.create","severity":"INFO"}',
]

GITHUB = [
    '{"id":"g1","action":"org.add_member","created_at":1700000000123,"actor":"ann","user":"bob","org":"acme"}',
    '{"id":"g2","action":"org.update_member","created_at":1700000001999,"actor":"ann","user":"bob","org":"acme","data":{"permission":"admin"}}',
    '{"id":"g3","action":"user.login","created_at":1700000002000,"actor":"bob","actor_location":{"ip":"192.0.2.9","city":"Bonn","country":"DE"}}',
    '{"id":"g4","action":"oauth_authorization.destroy","created_at":1700000003000,"actor":"bob"}',
    '{"id":"g5","action":"repo.add_member","created_at":1700000004000,"actor":"ann","org":"acme","repo":"acme/web",'
    '"data":{"target_login":"bob","permission":"write","visibility":"private"}}',
    '{"id":"g6","action":"team.destroy","created_at":1700000005000,"actor":"ann","org":"acme","data":{"team":"core"}}',
    '{"id":"g7","action":"repo.archived","created_at":1700000006000,"actor":"ann","org":"acme","repo":"plain"}',
    '{"id":"g8","action":"git.push","created_at":1700000007000,"actor":"bob","org":"acme","repo":"acme/web"}',
    '{"id":"g9","action":"deploy.finish","created_at":1700000008000,"actor":"bob","org":"acme"}',
]

BY_FLOW = {
    "aws_vpc_flowlogs": VPC,
    "cisco_ios": IOS,
    "cloudflare_gateway_dns": DNS,
    "github_audit_logs": GITHUB,
    "okta_system_log": OKTA,
    "zeek_conn": ZEEK,
}


def write(folder, lines, name="part.log"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)
