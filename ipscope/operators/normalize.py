"""Normalisation of raw feed records into typed processed tables (P1..P4, P15).

Raw records arrive with every scalar as text (see ``schemas.RAW_*``) and are
converted with the tolerant casts, so one odd value (``"100.0"``, ``"abc"``)
becomes a typed value or null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ipscope.functions.casts import (
    normalize_string_array, safe_bool, safe_float, safe_int, safe_string,
)
from ipscope.operators.enrich import conform


def _lit_s(v: str | None) -> Column:
    return F.lit(v).cast("string")


def _meta(df: DataFrame, name: str, fallback: str | None) -> Column:
    """Envelope metadata column when present, else the given literal."""
    if name in df.columns:
        return F.coalesce(F.col(name), _lit_s(fallback))
    return _lit_s(fallback)


def normalize_abuse(raw: DataFrame, ingestion_time: str | None = None,
                    processed_at: str | None = None) -> DataFrame:
    """camelCase blacklist entries -> processed abuse rows."""
    return raw.select(
        *[c for c in ("pos",) if c in raw.columns],
        F.col("ipAddress").alias("ip_address"),
        F.col("countryCode").alias("country_code"),
        safe_int("abuseConfidenceScore", None, raw.schema["abuseConfidenceScore"].dataType)
        .alias("abuse_confidence_score"),
        F.col("lastReportedAt").alias("last_reported_at"),
        _meta(raw, "envelope_ingestion_time", ingestion_time).alias("ingestion_time"),
        _lit_s(processed_at).alias("processed_at"))


def normalize_pulses(raw: DataFrame, processed_at: str | None = None,
                     raw_ingestion_time: str | None = None) -> DataFrame:
    """Pulse records; counts default 0, names default [] (Q7: either envelope time)."""
    t = raw.schema
    env_time = F.coalesce(
        *[F.col(c) for c in ("envelope_last_ingestion_time", "envelope_ingestion_time") if c in raw.columns],
        _lit_s(raw_ingestion_time))
    return raw.select(
        *[c for c in ("pos",) if c in raw.columns],
        F.col("ip").alias("ip_address"),
        safe_float("otx_reputation", None, t["otx_reputation"].dataType).alias("otx_reputation"),
        safe_int("pulse_count", 0, t["pulse_count"].dataType).alias("otx_pulse_count"),
        normalize_string_array("pulse_names", t["pulse_names"].dataType).alias("otx_pulse_names"),
        safe_int("passive_dns_count", 0, t["passive_dns_count"].dataType).alias("otx_passive_dns_count"),
        F.col("general_status").alias("otx_general_status"),
        F.col("passive_dns_status").alias("otx_passive_dns_status"),
        "first_ingestion_time", "last_ingestion_time",
        safe_int("seen_count", None, t["seen_count"].dataType).alias("seen_count"),
        env_time.alias("raw_ingestion_time"),
        _lit_s(processed_at).alias("processed_at"))


def normalize_geo(raw: DataFrame, processed_at: str | None = None,
                  raw_ingestion_time: str | None = None) -> DataFrame:
    """Geo records -> 20 typed columns; coordinates tolerant to text or numbers."""
    t = raw.schema
    return raw.select(
        *[c for c in ("pos",) if c in raw.columns],
        F.col("ip").alias("ip_address"),
        F.col("continent_name").alias("geo_continent_name"),
        F.col("country_code2").alias("geo_country_code2"),
        F.col("country_name").alias("geo_country_name"),
        F.col("state_prov").alias("geo_state_province"),
        F.col("city").alias("geo_city"),
        safe_float("latitude", None, t["latitude"].dataType).alias("geo_latitude"),
        safe_float("longitude", None, t["longitude"].dataType).alias("geo_longitude"),
        safe_bool("is_eu", None, t["is_eu"].dataType).alias("geo_is_eu"),
        F.col("asn_number").alias("geo_asn_number"),
        F.col("asn_organization").alias("geo_asn_organization"),
        F.col("asn_country").alias("geo_asn_country"),
        F.col("timezone_name").alias("geo_timezone_name"),
        safe_float("timezone_offset", None, t["timezone_offset"].dataType).alias("geo_timezone_offset"),
        F.col("status").alias("geo_status"),
        "first_ingestion_time", "last_ingestion_time",
        safe_int("seen_count", None, t["seen_count"].dataType).alias("seen_count"),
        _meta(raw, "envelope_last_ingestion_time", raw_ingestion_time).alias("raw_ingestion_time"),
        _lit_s(processed_at).alias("processed_at"))


def normalize_state(abuse_raw: DataFrame) -> DataFrame:
    """P4 + F1: change-control state rows (4 columns), blank IPs dropped."""
    return (abuse_raw
            .filter(F.col("ipAddress").isNotNull() & (F.col("ipAddress") != ""))
            .select(*[c for c in ("pos",) if c in abuse_raw.columns],
                    F.col("ipAddress").alias("ip_address"),
                    safe_int("abuseConfidenceScore", None, abuse_raw.schema["abuseConfidenceScore"].dataType)
                    .alias("abuse_confidence_score"),
                    F.col("lastReportedAt").alias("last_reported_at"),
                    F.col("countryCode").alias("country_code")))


def normalize_typed(df: DataFrame, schema) -> DataFrame:
    """Re-type an already processed table (pulse / geo / profile) tolerantly."""
    out = []
    dt = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        if f.name not in dt:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        src = dt[f.name]
        tn = f.dataType.simpleString()
        if tn == "int":
            c = safe_int(f.name, None, src)
        elif tn == "double":
            c = safe_float(f.name, None, src)
        elif tn == "boolean":
            c = safe_bool(f.name, None, src)
        elif tn == "array<string>":
            c = normalize_string_array(f.name, src)
        elif tn == "string":
            c = safe_string(f.name)
        else:
            c = F.col(f.name).cast(f.dataType)
        out.append(c.alias(f.name))
    return df.select(out)


__all__ = ["normalize_abuse", "normalize_pulses", "normalize_geo", "normalize_state",
           "normalize_typed", "conform"]
