"""Names, ports, patterns, labels and thresholds that results depend on."""

# --- fixed values: feature names, in vector order ---
TRAFFIC_FEATURES = [
    "sentbyte", "rcvdbyte", "sentpkt", "rcvdpkt", "duration", "sentdelta", "rcvddelta",
    "srcport", "dstport", "is_tcp", "is_udp", "is_icmp",
    "hour", "day_of_week", "is_weekend", "is_business_hours", "is_night",
    "bytes_per_packet_sent", "bytes_per_packet_rcvd", "total_bytes", "total_packets",
    "bytes_ratio", "bytes_sent_ratio", "packets_sent_ratio",
    "is_external", "is_internal_src", "is_internal_dst",
    "is_high_port", "is_common_port", "is_suspicious_port",
    "action_deny", "action_accept", "port_entropy", "byte_variance",
]
UTM_FEATURES = [
    "srcport", "dstport", "is_tcp", "is_udp", "is_icmp",
    "hour", "day_of_week", "is_weekend", "is_business_hours", "is_night",
    "appid", "apprisk_low", "apprisk_medium", "apprisk_high", "apprisk_critical",
    "action_deny", "action_accept", "is_external", "is_internal_src", "is_internal_dst",
    "is_high_port", "is_common_port", "is_suspicious_port", "port_entropy",
]

# --- fixed values: ports, protocols, actions ---
COMMON_PORTS = [20, 21, 22, 23, 25, 53, 80, 110, 123, 143, 443, 465, 587, 993, 995, 3389]
SUSPICIOUS_PORTS = [1337, 4444, 5555, 6666, 6667, 9001, 31337]
DENY_ACTIONS = ["deny", "block", "drop", "reset", "reject"]
ACCEPT_ACTIONS = ["allow", "accept", "permit", "pass"]
PROTOCOL_ALIASES = {"tcp": ["tcp", "6"], "udp": ["udp", "17"], "icmp": ["icmp", "1"]}
PROTOCOL_NAMES = {6: "TCP", 17: "UDP", 1: "ICMP"}
SERVICE_NAMES = {
    80: "HTTP", 443: "HTTPS", 22: "SSH", 21: "FTP", 23: "Telnet",
    25: "SMTP", 53: "DNS", 3389: "RDP", 445: "SMB", 3306: "MySQL",
}
APP_RISKS = ["low", "medium", "high", "critical"]

# --- fixed values: address ranges the Python 3.13 standard library calls private ---
PRIVATE_V4 = [
    "0.0.0.0/8", "10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12",
    "192.0.0.0/24", "192.0.2.0/24", "192.168.0.0/16", "198.18.0.0/15",
    "198.51.100.0/24", "203.0.113.0/24", "240.0.0.0/4",
]
PRIVATE_V4_EXCEPT = ["192.0.0.9/32", "192.0.0.10/32"]
PRIVATE_V6 = [
    "::1/128", "::/128", "::ffff:0:0/96", "64:ff9b:1::/48", "100::/64",
    "2001::/23", "2001:db8::/32", "2002::/16", "3fff::/20", "fc00::/7", "fe80::/10",
]
PRIVATE_V6_EXCEPT = [
    "2001:1::1/128", "2001:1::2/128", "2001:3::/32",
    "2001:4:112::/48", "2001:20::/28", "2001:30::/28",
]

# --- fixed values: attack signatures in priority order, matched without regard to case ---
SIGNATURES = [
    ("sql_injection", r"(\bUNION\b.*\bSELECT\b|\bOR\b.*=.*)"),
    ("sql_injection", r"(\b(DROP|DELETE|INSERT|UPDATE)\b.*\b(TABLE|FROM|INTO)\b)"),
    ("xss_attack", r"(<script|javascript:|onerror=|onload=)"),
    ("xss_attack", r"(alert\(|eval\(|document\.cookie)"),
    ("command_injection", r"(;|\||&&|`|\$\(.*\))"),
    ("command_injection", r"(\.\./|\.\.\\|/etc/passwd)"),
    ("brute_force", r"(failed.*password|authentication.*failed).*(\d+.*times?)"),
    ("brute_force", r"(too many.*attempts|account.*locked)"),
    ("malware", r"(virus|trojan|ransomware|malware|infected)"),
    ("malware", r"(cryptominer|rootkit|keylogger)"),
    ("port_scan", r"(SYN.*flood|port.*scan|nmap|masscan)"),
    ("web_attack", r"(\.\./|\.\./\.\./|path.*traversal)"),
    ("web_attack", r"(cmd\.exe|/bin/bash|powershell)"),
]
# For each signature its ways to match; a way needs at least one literal (lower case) of each of its groups.
SIGNATURE_LITERALS = [
    [[["union"], ["select"]], [["or"], ["="]]],
    [[["drop", "delete", "insert", "update"], ["table", "from", "into"]]],
    [[["<script", "javascript:", "onerror=", "onload="]]],
    [[["alert(", "eval(", "document.cookie"]]],
    [[[";", "|", "&&", "`"]], [["$("], [")"]]],
    [[["../", "..\\", "/etc/passwd"]]],
    [[["failed"], ["password", "authentication"], ["time"]]],
    [[["too many"], ["attempts"]], [["account"], ["locked"]]],
    [[["virus", "trojan", "ransomware", "malware", "infected"]]],
    [[["cryptominer", "rootkit", "keylogger"]]],
    [[["syn"], ["flood"]], [["port"], ["scan"]], [["nmap", "masscan"]]],
    [[["../"]], [["path"], ["traversal"]]],
    [[["cmd.exe", "/bin/bash", "powershell"]]],
]
# Letters outside ASCII that match s, k or i when case is ignored.
FOLDING_LETTERS = ["ſ", "K", "İ", "ı"]
SIGNATURE_CONFIDENCE = 0.95
PATTERN_CHARS = 50
LOG_CHARS = 300

# --- fixed values: classifier labels ---
LABELS = ["normal", "DoS", "PortScan", "Malware", "BruteForce"]

# --- fixed values: behaviour profile ---
HISTORY_ROWS = 40
RING_ROWS = 20
ERROR_ROWS = 100
TRAINING_ROWS = 15
MIN_ERRORS = 10
ERROR_PERCENTILE = 0.98
RECENT_ROWS = 10
MIN_VECTOR_ROWS = 5
MAX_ENTITIES = 1000
MIN_ENTITY_ROWS = 10
PEER_REFRESH_ROWS = 100
MIN_GROUP_SIZE = 3
MAX_GROUPS = 50
PEER_SEED = 42
PEER_ITERATIONS = 100
INDIVIDUAL_WEIGHT = 0.6
PEER_WEIGHT = 0.4

# --- fixed values: decisions and review ---
DFP_THREAT_SCORE = 0.70
REVIEW_SCORE = 0.98
REVIEW_CONFIDENCE = 0.40
COOLDOWN_SECONDS = 600
PATTERN_SECONDS = 120
PATTERN_EVENTS = 3
MATCH_SECONDS = 300
VERDICT_KEYWORDS = ["threat", "malicious", "attack", "suspicious", "anomaly"]
DETECTOR_KEYWORDS = ["true", "attack", "suspicious", "threat", "malicious", "exfiltration", "scanning"]
COOLDOWN_REASON = "Duplicate IP within cooldown window"

# --- fixed values: ingest ---
INGEST_TAGS = {"ingest": "udp5514", "ingest_type": "syslog", "ingest_vendor": "fortinet", "ingest_proto": "udp"}
INGEST_ZONE = "Asia/Bangkok"
INTEGER_FIELDS = ["srcport", "dstport", "proto", "policyid", "sessionid", "appid", "eventtime"]
SYSLOG_FACILITIES = [
    "kernel", "user-level", "mail", "daemon", "security/authorization", "syslogd", "line printer",
    "network news", "uucp", "clock", "security/authorization", "ftp", "ntp", "log audit", "log alert",
    "clock", "local0", "local1", "local2", "local3", "local4", "local5", "local6", "local7",
]
SYSLOG_SEVERITIES = [
    "emergency", "alert", "critical", "error", "warning", "notice", "informational", "debug",
]
