"""Batch IP lookup: a request table answered from the profile store and landed
live responses (J8, J9, H10, P17, P18).

    requests -> trim -> valid / invalid (F3)
    valid ⟕ store ⟕ answers -> stored columns (hits) or live ones (misses)
             -> recompute computed fields (H10)
             -> one profile per requested IP (ready for the dual save, K9)

Every step is a join keyed by ip; the store side is never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ipscope import schemas as S
from ipscope.functions.ip import is_valid_ip
from ipscope.functions.scoring import score_columns
from ipscope.functions.sqltext import ident, lit, strip
from ipscope.operators.enrich import conform
from ipscope.sources.responses import live_answers


def split_requests(requests: DataFrame, col: str = "ip") -> tuple[DataFrame, DataFrame]:
    """(valid distinct IPs, invalid rows with an error message)."""
    ip = strip(F.col(col).cast("string"))
    r = requests.select(ip.alias("ip_address"))
    valid = r.filter(is_valid_ip(F.col("ip_address"))).distinct()
    invalid = (r.filter(~is_valid_ip(F.col("ip_address")) | F.col("ip_address").isNull())
               .withColumn("error", F.lit("Invalid IP address")))
    return valid, invalid


def recompute(profiles: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Recompute classification, score and status; stamp merge times."""
    now = f"to_timestamp({lit(run_ts)})" if run_ts else "current_timestamp()"
    p = score_columns(conform(profiles, S.PROFILE))
    return p.selectExpr(*[
        f"coalesce(first_seen_at, {now}) AS first_seen_at" if c == "first_seen_at"
        else f"{now} AS last_merged_at" if c == "last_merged_at"
        else ident(c) for c in S.PROFILE_COLUMNS])


def _live_columns(run_ts: str | None) -> dict[str, str]:
    """The profile columns of an IP known from its answers only."""
    now = f"to_timestamp({lit(run_ts)})" if run_ts else "current_timestamp()"
    return {
        "abuse_confidence_score": "coalesce(abuse_confidence_score, 0)",
        "abuse_total_reports": "coalesce(abuse_total_reports, 0)",
        "abuse_last_reported_at": "try_to_timestamp(abuse_last_reported_at)",
        "otx_pulse_count": "coalesce(otx_pulse_count, 0)",
        "otx_passive_dns_count": "coalesce(otx_passive_dns_count, 0)",
        "otx_pulse_names": "coalesce(otx_pulse_names, CAST(array() AS ARRAY<STRING>))",
        "enriched_at": now,
        "profile_source": lit(S.PROFILE_SOURCE_LIVE),
        "geo_location": ("CASE WHEN geo_latitude IS NOT NULL AND geo_longitude IS NOT NULL "
                         "THEN named_struct('lat', geo_latitude, 'lon', geo_longitude) END"),
    }


def split_hits(requests: DataFrame, store: DataFrame, col: str = "ip") -> tuple[DataFrame, DataFrame]:
    """Valid requested IPs found in the store (hits) and not found (misses)."""
    valid, _ = split_requests(requests, col)
    keys = store.select("ip_address")
    return valid.join(keys, "ip_address", "left_semi"), valid.join(keys, "ip_address", "left_anti")


def lookup(requests: DataFrame, store: DataFrame, responses: DataFrame,
           run_ts: str | None = None, col: str = "ip") -> tuple[DataFrame, DataFrame]:
    """Answer a table of requested IPs; returns ``(profiles, invalid_requests)``.

    J8 + J9 in one pass: requests ⟕ store ⟕ answers, each read once and unique per
    IP, so there is one profile per requested IP.  Rows found in the store take its
    columns, the others the live ones.
    """
    valid, invalid = split_requests(requests, col)
    kept = conform(store, S.PROFILE).selectExpr(
        "ip_address", "true AS _hit", *[f"{ident(c)} AS _s_{c}" for c in S.PROFILE_COLUMNS if c != "ip_address"])
    live = live_answers(responses).withColumnRenamed("ip", "ip_address")
    j = valid.join(kept, "ip_address", "left").join(live, "ip_address", "left")
    rule, have = _live_columns(run_ts), set(live.columns)
    cols = ["ip_address"]
    for f in S.PROFILE.fields:
        if f.name != "ip_address":
            now = rule.get(f.name, ident(f.name) if f.name in have else f"CAST(NULL AS {f.dataType.simpleString()})")
            cols.append(f"CASE WHEN _hit THEN _s_{f.name} ELSE {now} END AS {ident(f.name)}")
    return recompute(j.selectExpr(*cols), run_ts), invalid


def display_profile(profiles: DataFrame) -> DataFrame:
    """The lookup page's display fields with its defaults."""
    def joined(c):
        return F.coalesce(F.array_join(F.col(c), ", "), F.lit("None"))

    return profiles.select(
        F.coalesce("ip_address", F.lit("")).alias("ip_address"),
        F.coalesce("geo_country_name", "abuse_country_name", F.lit("Unknown")).alias("country"),
        F.coalesce("geo_city", F.lit("Unknown")).alias("city"),
        F.coalesce("geo_asn_organization", F.lit("Unknown")).alias("asn_organization"),
        F.coalesce("abuse_confidence_score", F.lit(0)).alias("abuse_confidence_score"),
        F.coalesce("otx_pulse_count", F.lit(0)).alias("otx_pulse_count"),
        F.coalesce("otx_passive_dns_count", F.lit(0)).alias("otx_passive_dns_count"),
        F.coalesce("risk_score", F.lit(0.0)).alias("risk_score"),
        F.coalesce("status", F.lit(S.STATUS_LOW)).alias("status"),
        joined("attack_categories").alias("attack_categories"),
        joined("attack_keywords_matched").alias("attack_keywords_matched"),
        F.coalesce("profile_source", F.lit(S.PROFILE_SOURCE_BATCH)).alias("profile_source"))


def point_lookup(store: DataFrame, ip: str) -> DataFrame:
    """one profile for one IP (pushed-down equality filter, limit 1)."""
    return store.filter(F.col("ip_address") == F.lit(ip.strip())).limit(1)
