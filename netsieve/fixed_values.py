"""Lists, patterns and numbers that results depend on.

Everything in this module is a constant of the data rules, kept together so the
functions that use them hold no literals of their own.
"""

# --- priority and severity (fixed values) ---
SEVERITY_NAMES = ["Emergency", "Alert", "Critical", "Error", "Warning", "Notice", "Info", "Debug"]
MAX_PRIORITY = 191
DEFAULT_PRIORITY = 134

# --- line formats (fixed values) ---
RFC5424_LINE = r"^<(\d+)>(\d+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(.*)$"
RFC3164_LINE = r"^<(\d+)>(\w+\s+\d+\s+\d+:\d+:\d+)\s+(\S+)\s+([^:\[]+)(?:\[(\d+)\])?:\s*(.*)$"
PRIORITY_ONLY_LINE = r"^<(\d+)>(.*)$"
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

# --- quality issue names (fixed values) ---
ISSUE_FORMAT = "malformed_syslog_format"
ISSUE_PRIORITY_RANGE = "invalid_priority_range"
ISSUE_PRIORITY_PARSE = "unparseable_priority"
ISSUE_TIMESTAMP = "unparseable_timestamp"
ISSUE_HOSTNAME = "missing_hostname"

# --- device vendors by host name substring, in priority order (fixed values) ---
VENDOR_HOST_MARKS = {
    "paloalto": ["pa-fw", "pa-", "paloalto"],
    "juniper": ["jun-", "mx-", "ex-", "srx-", "qfx-"],
    "fortigate": ["fgt-", "fortigate"],
    "checkpoint": ["cp-", "checkpoint"],
    "cisco": ["rtr", "sw", "core", "edge", "dist", "access", "wan", "mpls"],
}
DEVICE_PROGRAM_MARKS = {
    "router": ["bgp", "ospf", "rpd", "routing"],
    "firewall": ["firewall", "threat", "security", "fw"],
    "switch": ["switch", "vlan", "spanning"],
}
FIREWALL_MESSAGE_MARKS = ["globalprotect", "vpn"]

# --- event categories: substrings of the lower-cased text (fixed values) ---
AUTHENTICATION_WORDS = [
    "login", "authentication", "ssh", "telnet", "console",
    "succeeded", "failed", "accepted", "denied",
    "password", "certificate", "key",
]
SECURITY_WORDS = [
    "attack", "threat", "malware", "virus", "trojan", "backdoor",
    "intrusion", "breach", "compromise", "exploit",
    "scan", "probe", "reconnaissance",
    "ddos", "dos", "flood", "amplification",
    "botnet", "c2", "exfiltration",
]
NETWORK_WORDS = [
    "bgp", "ospf", "eigrp", "isis", "rip",
    "interface", "link", "port", "ethernet",
    "route", "routing", "nexthop", "gateway",
    "vlan", "trunk", "stp",
    "up", "down", "flap", "change", "transition",
]
SYSTEM_WORDS = [
    "cpu", "memory", "disk", "temperature", "fan",
    "utilization", "usage", "threshold", "alarm",
    "power", "supply", "redundancy", "backup",
    "config", "configuration", "startup", "shutdown",
]
# Words of the lists above that need a pattern: (substring that must be there, pattern).
AUTHENTICATION_PATTERNS = [("user", r"user\s+\S")]
SECURITY_PATTERNS = [("brute", r"brute.?force"), ("command", r"command.?control")]
NETWORK_PATTERNS = [("spanning", r"spanning.?tree")]
SYSTEM_PATTERNS = []

# --- subcategories: ordered (substrings, label), then a default (fixed values) ---
SUBCATEGORIES = {
    "authentication": (
        [(["success", "accept"], "login_success"), (["fail", "denied"], "login_failure")],
        "authentication_event",
    ),
    "security": (
        [
            (["attack", "threat"], "threat_detection"),
            (["scan", "probe"], "reconnaissance"),
            (["malware", "virus"], "malware_detection"),
        ],
        "security_event",
    ),
    "network": (
        [
            (["bgp"], "bgp_event"),
            (["ospf"], "ospf_event"),
            (["interface", "link"], "interface_event"),
            (["route"], "routing_event"),
        ],
        "network_event",
    ),
    "system": (
        [
            (["cpu", "memory"], "resource_monitoring"),
            (["temperature", "fan"], "hardware_monitoring"),
            (["config"], "configuration_event"),
        ],
        "system_event",
    ),
    "other": ([], "unclassified"),
}

# --- content classes of raw records, ordered (fixed values) ---
CONTENT_CLASSES = [
    (["login", "authentication", "ssh"], "Login Events"),
    (["bgp"], "BGP Events"),
    (["ospf"], "OSPF Events"),
    (["latency", "rtt", "ping"], "Latency Events"),
    (["attack", "threat", "malware", "security"], "Security Events"),
    (["interface", "link"], "Interface Events"),
    (["cpu", "memory", "temperature", "disk"], "System Events"),
    (["route", "routing"], "Routing Events"),
    (["vpn", "globalprotect"], "VPN Events"),
]
CONTENT_CLASS_DEFAULT = "Other Events"

# --- extraction patterns (fixed values) ---
OCTET = r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"
IP_TEXT = r"(?:" + OCTET + r"\.){3}" + OCTET + r"|(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}"
IPV4_VALID = (
    r"^(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    r"(?:\.(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$"
)
PORT_TEXT = r"(?:port|:)\s*(\d{1,5})"
PROTOCOL_TEXT = r"(?i)\b(tcp|udp|icmp|esp|ah|gre|ospf|bgp|eigrp)\b"
USER_QUOTED_OR_BARE = r"(?i)user\s+(?:'([^']+)'|(\S+))"
USER_AFTER_COLON = r"(?i)User:\s+(\S+)"
INTERFACE_NAMED = r"(?i)interface\s+([a-zA-Z0-9\/\.-]+)"
INTERFACE_AFTER_ON = r"(?i)on\s+([a-zA-Z0-9\/\.-]+)"
INTERFACE_PREFIX = (
    r"(?i)(GigabitEthernet|TenGigabitEthernet|FastEthernet|Serial|Loopback|Tunnel|Vlan|ethernet|ge-|xe-|et-)\S*"
)
INTERFACE_PREFIX_WORDS = ["ethernet", "serial", "loopback", "tunnel", "vlan", "ge-", "xe-", "et-"]
# an address with an octet like 07, in a comma-joined list
LEADING_ZERO_IP = r"(?<![^,])(?:\d+\.)*0\d+(?:\.\d+)*(?![^,])"
THREAT_AFTER_THREAT = r"(?i)threat[^:]*:\s*([^,\s]+)"
THREAT_AFTER_MALWARE = r"(?i)malware[^:]*:\s*([^,\s]+)"
THREAT_AFTER_SIGNATURE = r"(?i)signature[^:]*:\s*([^,\s]+)"
THREAT_QUOTED = r'(?i)"([^"]*(?:malware|threat|exploit|trojan)[^"]*)"'
BGP_NEIGHBOR = r"(?i)bgp.*neighbor\s+([0-9.]+)"
BGP_PEER = r"(?i)peer\s+([0-9.]+)"
AS_NUMBER = r"(?i)AS\s*(\d+)"
OSPF_NEIGHBOR = r"(?i)ospf.*neighbor\s+([0-9.]+)"
OSPF_AREA = r"(?i)area\s+([0-9.]+)"

# --- risk score (fixed values) ---
RISK_BY_SEVERITY = {0: 50, 1: 50, 2: 40, 3: 30, 4: 20, 5: 10, 6: 5, 7: 5}
RISK_SECURITY = 30
RISK_NAMED_THREAT = 20
RISK_PORT = 10
RISK_EXTERNAL_SOURCE = 15
RISK_CAP = 100
RISK_PORTS = [22, 23, 1433, 3389, 5900]
RISK_INTERNAL_PREFIXES = ["192.168.", "10.", "172.16."]

# --- output column order of the cleaned CSV (fixed values) ---
CSV_COLUMNS = [
    "id", "timestamp", "normalized_time", "facility", "severity", "severity_name",
    "priority", "hostname", "program", "pid", "message", "device_type",
    "event_category", "event_subcategory", "source_ip", "destination_ip",
    "source_port", "destination_port", "protocol", "username", "interface",
    "threat_name", "bgp_peer", "as_number", "ospf_area", "risk_score",
    "is_security", "is_authentication", "is_network_event", "is_system_event",
    "data_quality_issues",
]
EXTRACTED_FIELDS = [
    "source_ip", "destination_ip", "destination_port", "protocol", "username",
    "interface", "threat_name", "bgp_peer", "as_number", "ospf_area",
]

# --- feature rules (fixed values) ---
LOOSE_IP = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"
INTERFACE_TOKEN = r"(?i)(?:Gi|Fa|Te|Se|Et|Lo)\d+(?:/\d+)*"
ERROR_CODE = r"%\w+-\d+-\w+"
ERROR_KEYWORDS = ["error", "fail", "critical", "alert", "warning", "exception", "timeout"]
LEVEL_CODES_MINING = {"DEBUG": 0, "INFO": 1, "WARNING": 2, "ERROR": 3, "CRITICAL": 4}
LEVEL_CODES_MONITOR = {"INFO": 0, "WARNING": 1, "ERROR": 2, "CRITICAL": 3}
PROTOCOL_CODES_MONITOR = {"TCP": 0, "UDP": 1, "ICMP": 2}
COMMON_PORTS = [22, 23, 53, 80, 443, 993, 995]
INTERNAL_FIRST_OCTETS = [10, 172, 192]
# name -> (first hour, last hour, weekdays only)
BUSINESS_HOURS = {
    "mining": (8, 17, True),
    "anomaly": (9, 17, False),
    "classifier": (8, 18, False),
    "events": (9, 17, False),
}
LOG_FEATURES = [
    "hour", "day_of_week", "is_weekend", "level_encoded",
    "message_length", "word_count", "uppercase_ratio", "digit_ratio",
    "special_char_ratio", "ip_count", "has_ip",
    "has_error", "has_fail", "has_critical", "has_alert",
    "has_warning", "has_exception", "has_timeout",
]
FLOW_FEATURES = [
    "src_port", "dst_port", "protocol_encoded", "duration", "packets", "bytes",
    "packets_per_second", "bytes_per_second", "bytes_per_packet",
    "is_well_known_src", "is_well_known_dst", "is_common_port",
    "hour", "day_of_week", "is_weekend", "is_business_hours",
    "src_ip_class", "dst_ip_class", "is_internal_src", "is_internal_dst",
    "duration_log", "packets_log", "bytes_log",
]
EVENT_FEATURES = [
    "hour", "day_of_week", "is_weekend", "is_business_hours",
    "source_is_internal", "dest_is_internal", "internal_to_external", "external_to_internal",
    "byte_count", "packet_count", "session_duration",
    "bytes_per_packet", "packets_per_second", "bytes_per_second",
]
CLASSIFIER_NUMERIC = [
    "facility", "severity", "priority", "pid", "risk_score",
    "destination_port", "source_port", "as_number",
]
CLASSIFIER_BOOLEAN = ["is_security", "is_authentication", "is_network_event", "is_system_event"]
CLASSIFIER_CATEGORICAL = ["device_type", "program", "severity_name", "protocol"]

# --- text mining (fixed values) ---
SYMBOLS = r"[^\p{L}\p{N}_\s\-/:]"
JOINED_FORMS = r"\b(?:(can(?=not)|gim(?=me)|gon(?=na)|got(?=ta)|lem(?=me)|wan(?=na)))(not|me|na|ta)\b"
NETWORK_STOP_WORDS = [
    "interface", "config", "system", "device", "network",
    "connection", "status", "message", "log", "entry",
]
# The public English stop-word list of the common NLP toolkit.
GENERAL_STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
he him his himself she she's her hers herself it it's its itself they them their theirs themselves
what which who whom this that that'll these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don don't should should've
now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# --- report rules (fixed values) ---
ERROR_LEVELS = ["ERROR", "CRITICAL"]
ERROR_SHARE_LIMIT = 0.1
INTERFACE_DOWN_LIMIT = 50
BGP_ISSUE_LIMIT = 20
HOUR_SPIKE_FACTOR = 3
HIGH_RISK_SCORE = 0.8
ALERT_THRESHOLD = 0.5
