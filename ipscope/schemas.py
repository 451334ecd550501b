"""Explicit schemas and the fixed values the scoring rules depend on.

Schemas are never inferred: every edge reads with one of these StructTypes and
casts tolerantly (``try_cast``) because ANSI mode is on in Spark 4.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)


def _struct(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, I, D, B, TS, L = StringType(), IntegerType(), DoubleType(), BooleanType(), TimestampType(), LongType()
ARR_S = ArrayType(StringType())

# ---------------------------------------------------------------- raw feeds
# One abuse blacklist entry as returned by the feed (camelCase keys).
RAW_ABUSE_RECORD = _struct(
    ("ipAddress", S), ("countryCode", S), ("abuseConfidenceScore", S), ("lastReportedAt", S),
)
# Score is read as text and converted with safe_int: a float-typed writer emits
# ``100.0`` which an int schema would turn into null.

RAW_GEO_RECORD = _struct(
    ("ip", S), ("status", S), ("continent_name", S), ("country_code2", S),
    ("country_name", S), ("state_prov", S), ("city", S), ("latitude", S), ("longitude", S),
    ("is_eu", S), ("asn_number", S), ("asn_organization", S), ("asn_country", S),
    ("timezone_name", S), ("timezone_offset", S), ("first_ingestion_time", S),
    ("last_ingestion_time", S), ("seen_count", S),
)

RAW_PULSE_RECORD = _struct(
    ("ip", S), ("otx_reputation", S), ("pulse_count", S), ("pulse_names", ARR_S),
    ("passive_dns_count", S), ("general_status", S), ("passive_dns_status", S),
    ("first_ingestion_time", S), ("last_ingestion_time", S), ("seen_count", S),
)


def envelope_schema(record_schema: StructType) -> StructType:
    """Snapshot envelope ``{source, ingestion_time, ..., data: [records]}``."""
    return _struct(
        ("source", S), ("ingestion_time", S), ("last_ingestion_time", S),
        ("source_abuse_object", S), ("source_abuse_processed_object", S),
        ("record_count", L), ("data", ArrayType(record_schema)),
    )


# ---------------------------------------------------------- processed tables
ABUSE = _struct(
    ("ip_address", S), ("country_code", S), ("abuse_confidence_score", I),
    ("last_reported_at", S), ("ingestion_time", S), ("processed_at", S),
)

PULSE = _struct(
    ("ip_address", S), ("otx_reputation", D), ("otx_pulse_count", I), ("otx_pulse_names", ARR_S),
    ("otx_passive_dns_count", I), ("otx_general_status", S), ("otx_passive_dns_status", S),
    ("first_ingestion_time", S), ("last_ingestion_time", S), ("seen_count", I),
    ("raw_ingestion_time", S), ("processed_at", S),
)

GEO = _struct(
    ("ip_address", S), ("geo_continent_name", S), ("geo_country_code2", S), ("geo_country_name", S),
    ("geo_state_province", S), ("geo_city", S), ("geo_latitude", D), ("geo_longitude", D),
    ("geo_is_eu", B), ("geo_asn_number", S), ("geo_asn_organization", S), ("geo_asn_country", S),
    ("geo_timezone_name", S), ("geo_timezone_offset", D), ("geo_status", S),
    ("first_ingestion_time", S), ("last_ingestion_time", S), ("seen_count", I),
    ("raw_ingestion_time", S), ("processed_at", S),
)

# Committed change-control state, one row per record.
STATE_RECORD = _struct(
    ("ip_address", S), ("abuse_confidence_score", I), ("last_reported_at", S), ("country_code", S),
)

# ------------------------------------------------------------ profile store
GEO_FIELDS = [
    "geo_continent_name", "geo_country_code2", "geo_country_name", "geo_state_province",
    "geo_city", "geo_latitude", "geo_longitude", "geo_is_eu", "geo_asn_number",
    "geo_asn_organization", "geo_asn_country", "geo_timezone_name", "geo_timezone_offset",
]

# The 26 columns an enriched report carries out of the join stage.
ENRICHED_COLUMNS = [
    "ip_address", "abuse_confidence_score", "abuse_country_code", "abuse_country_name",
    "abuse_last_reported_at", "abuse_total_reports", "otx_reputation", "otx_pulse_count",
    "otx_pulse_names", "otx_passive_dns_count", "otx_general_status", "otx_passive_dns_status",
    *GEO_FIELDS, "enriched_at",
]

COMPUTED_COLUMNS = ["risk_score", "status", "attack_categories", "attack_keywords_matched"]

PROFILE = _struct(
    ("ip_address", S), ("abuse_confidence_score", I), ("abuse_country_code", S),
    ("abuse_country_name", S), ("abuse_last_reported_at", TS), ("abuse_total_reports", I),
    ("otx_reputation", D), ("otx_pulse_count", I), ("otx_pulse_names", ARR_S),
    ("otx_passive_dns_count", I), ("otx_general_status", S), ("otx_passive_dns_status", S),
    ("geo_continent_name", S), ("geo_country_code2", S), ("geo_country_name", S),
    ("geo_state_province", S), ("geo_city", S), ("geo_latitude", D), ("geo_longitude", D),
    ("geo_is_eu", B), ("geo_asn_number", S), ("geo_asn_organization", S), ("geo_asn_country", S),
    ("geo_timezone_name", S), ("geo_timezone_offset", D), ("risk_score", D), ("status", S),
    ("attack_categories", ARR_S), ("attack_keywords_matched", ARR_S), ("profile_source", S),
    ("first_seen_at", TS), ("last_merged_at", TS), ("enriched_at", TS),
    ("geo_location", _struct(("lat", D), ("lon", D))),
)
PROFILE_COLUMNS = [f.name for f in PROFILE.fields]

# Landed API responses: one row per (ip, kind) call, body kept as JSON text.
RESPONSES = _struct(("ip", S), ("kind", S), ("http_status", I), ("body", S))

GEO_BODY = _struct(
    ("ip", S),
    ("location", _struct(("continent_name", S), ("country_code2", S), ("country_name", S),
                         ("state_prov", S), ("city", S), ("latitude", S), ("longitude", S),
                         ("is_eu", B))),
    ("asn", _struct(("as_number", S), ("organization", S), ("country", S))),
    ("time_zone", _struct(("name", S), ("offset", D))),
)
ABUSE_CHECK_BODY = _struct(
    ("data", _struct(("abuseConfidenceScore", S), ("countryCode", S), ("countryName", S),
                     ("lastReportedAt", S), ("totalReports", S))),
)
PULSE_GENERAL_BODY = _struct(
    ("reputation", D),
    ("pulse_info", _struct(("pulses", ArrayType(_struct(("name", S)))))),
)
PASSIVE_DNS_BODY = _struct(("passive_dns", ArrayType(_struct(("hostname", S), ("address", S)))))

# ------------------------------------------------------------ fixed values
# FIXED VALUES — these must equal the reference for identical results.
# Attack lexicon, category -> keywords, in the reference's order.
ATTACK_KEYWORDS = {
    "Brute Force": ["brute force", "bruteforce", "ssh", "telnet", "rdp", "login attempt"],
    "Phishing": ["phishing", "credential", "spoof", "email lure"],
    "Botnet / C2": ["botnet", "c2", "command and control", "cnc", "beacon"],
    "Scanning": ["scan", "scanner", "masscan", "zmap", "recon"],
    "Malware": ["malware", "trojan", "loader", "backdoor", "stealer"],
    "Ransomware": ["ransomware", "locker", "encryptor"],
    "Exploitation": ["exploit", "vulnerability", "rce", "remote code execution"],
}
# Score added once per matched category.
CATEGORY_BONUS = {
    "Brute Force": 12, "Phishing": 18, "Botnet / C2": 25, "Scanning": 8,
    "Malware": 20, "Ransomware": 30, "Exploitation": 25,
}
# Score added once per matched keyword; other keywords add 0.
KEYWORD_BONUS = {
    "rce": 20, "remote code execution": 20, "exploit": 12, "brute force": 10, "bruteforce": 10,
    "ssh": 6, "telnet": 8, "rdp": 10, "botnet": 18, "c2": 18, "command and control": 18,
    "ransomware": 25, "malware": 15, "phishing": 15,
}
# Pulse-count steps (threshold, bonus), first match wins; ">0" is the last step.
PULSE_STEPS = [(50, 35), (20, 25), (10, 18), (5, 10), (1, 5)]
ABUSE_WEIGHT, ABUSE_CAP = 0.6, 100
DNS_WEIGHT, DNS_CAP = 0.5, 20
# Status thresholds.
HIGH_RISK_AT, MEDIUM_RISK_AT = 70, 30
STATUS_HIGH, STATUS_MEDIUM, STATUS_LOW = "High Risk", "Medium Risk", "Low Risk"
PROFILE_SOURCE_BATCH, PROFILE_SOURCE_LIVE = "pipeline", "live_lookup"
# Boolean spellings accepted by safe_bool.
TRUE_WORDS = ["true", "1", "yes", "y"]
FALSE_WORDS = ["false", "0", "no", "n"]
# Live lookup report recency window (days).
REPORT_MAX_AGE_DAYS = 90
