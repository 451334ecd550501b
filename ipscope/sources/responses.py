"""Landed API responses -> typed feed records (P5..P9).

The HTTP collectors are not part of this library; their responses are landed as
a table ``(ip, kind, http_status, body, landed_at)`` with the JSON body as text, and
parsed here with ``from_json`` on explicit schemas.  ``kind`` is one of ``geo``,
``abuse_check``, ``pulse_general``, ``passive_dns``; ``landed_at`` may be missing.

A call that was tried again has several rows.  Each IP keeps one answer per kind: a
good one (status 200) before any other, then the newest.  Bodies are parsed before
the shuffle, so only the typed values that are needed move.  They are dealt into
partitions of bounded size first, since a task sorts what it reduces; a hot IP is
dealt by landing time too, and reduced to one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ipscope import schemas as S
from ipscope.functions.casts import safe_float, safe_int
from ipscope.functions.ip import is_valid_ip


def _parsed(kind: str) -> Column:
    """The typed values of one kind's body; null unless the call succeeded."""
    body = F.col("body")
    if kind == "geo":
        value = F.from_json(body, S.GEO_BODY)
    elif kind == "abuse_check":
        value = F.from_json(body, S.ABUSE_CHECK_BODY)["data"]
    elif kind == "pulse_general":
        general = F.from_json(body, S.PULSE_GENERAL_BODY)
        value = F.struct(general["reputation"].alias("reputation"),
                         F.transform(F.coalesce(general["pulse_info"]["pulses"], F.array()), lambda x: x["name"]).alias("names"))
        value = F.when(is_valid_ip(F.col("ip")), value)
    else:
        value = F.struct(F.size(F.coalesce(F.from_json(body, S.PASSIVE_DNS_BODY)["passive_dns"], F.array())).alias("n"))
        value = F.when(is_valid_ip(F.col("ip")), value)
    return F.when(F.col("http_status") == 200, value)


def answers(responses: DataFrame, *kinds: str) -> DataFrame:
    """One row per IP that has a response of these kinds: ip and a struct per kind
    (http_status, value), null where that kind has none."""
    if "landed_at" not in responses.columns:
        responses = responses.withColumn("landed_at", F.lit(None).cast("string"))
    good = F.coalesce(F.col("http_status") == 200, F.lit(False))
    parsed = responses.filter(F.col("kind").isin(*kinds)).select("ip", "landed_at", *[
        F.when(F.col("kind") == k, F.struct(good.alias("good"), "landed_at", "http_status", _parsed(k).alias("value"))).alias(k)
        for k in kinds])
    best = parsed.hint("rebalance", "ip", "landed_at").groupBy("ip").agg(*[F.max(k).alias(k) for k in kinds])
    return best.select("ip", *[F.when(F.col(k).isNotNull(), F.struct(
        F.col(f"{k}.http_status").alias("http_status"), F.col(f"{k}.value").alias("value"))).alias(k) for k in kinds])


def fetch_status(answer: Column, valid_ip: Column | None = None) -> Column:
    """P9 vocabulary for the pulse feed, of the best answer of a kind (a struct with ``http_status``).

    ok / rate_limited / not_found; request_failed for any other status and for a try that
    got no status; unknown_error where no try was landed; invalid_ip whatever was landed.
    """
    code = answer["http_status"]
    s = (F.when(answer.isNull(), F.lit("unknown_error"))
         .when(code == 200, F.lit("ok"))
         .when(code == 429, F.lit("rate_limited"))
         .when(code == 404, F.lit("not_found"))
         .otherwise(F.lit("request_failed")))
    return s if valid_ip is None else F.when(~valid_ip, F.lit("invalid_ip")).otherwise(s)


def geo_error_text(http_status: Column) -> Column:
    """Geo status text: ``ok`` or the error the collector recorded."""
    return (F.when(http_status == 200, F.lit("ok"))
            .when(http_status == 429, F.lit("HTTPError: 429 Too Many Requests"))
            .when(http_status.isNull(), F.lit("ReadTimeout"))
            .otherwise(F.concat(F.lit("HTTPError: "), http_status.cast("string"))))


def parse_geo(responses: DataFrame, ingestion_time: str | None) -> DataFrame:
    """Geo responses -> one raw geo record per IP; failed calls give an error row."""
    b, status = F.col("geo.value"), F.col("geo.http_status")
    t = F.lit(ingestion_time).cast("string")
    return answers(responses, "geo").select(
        F.coalesce(b["ip"], F.col("ip")).alias("ip"),
        geo_error_text(status).alias("status"),
        b["location"]["continent_name"].alias("continent_name"),
        b["location"]["country_code2"].alias("country_code2"),
        b["location"]["country_name"].alias("country_name"),
        b["location"]["state_prov"].alias("state_prov"),
        b["location"]["city"].alias("city"),
        b["location"]["latitude"].alias("latitude"),
        b["location"]["longitude"].alias("longitude"),
        b["location"]["is_eu"].cast("string").alias("is_eu"),
        b["asn"]["as_number"].alias("asn_number"),
        b["asn"]["organization"].alias("asn_organization"),
        b["asn"]["country"].alias("asn_country"),
        b["time_zone"]["name"].alias("timezone_name"),
        b["time_zone"]["offset"].cast("string").alias("timezone_offset"),
        t.alias("first_ingestion_time"), t.alias("last_ingestion_time"),
        F.lit("1").alias("seen_count"))


def parse_pulses(responses: DataFrame, ingestion_time: str | None) -> DataFrame:
    """Pulse general + passive DNS -> raw pulse records (batch feed vocabulary)."""
    p = answers(responses, "pulse_general", "passive_dns")
    valid = is_valid_ip(F.col("ip"))
    names = F.coalesce(F.col("pulse_general.value.names"), F.array().cast("array<string>"))
    t = F.lit(ingestion_time).cast("string")
    return p.select(
        F.col("ip"),
        F.col("pulse_general.value.reputation").cast("string").alias("otx_reputation"),
        F.size(names).cast("string").alias("pulse_count"),
        F.filter(names, lambda n: n.isNotNull() & (n != F.lit(""))).alias("pulse_names"),
        F.coalesce(F.col("passive_dns.value.n"), F.lit(0)).cast("string").alias("passive_dns_count"),
        fetch_status(F.col("pulse_general"), valid).alias("general_status"),
        fetch_status(F.col("passive_dns"), valid).alias("passive_dns_status"),
        t.alias("first_ingestion_time"), t.alias("last_ingestion_time"),
        F.lit("1").alias("seen_count"))


def parse_abuse_check(responses: DataFrame) -> DataFrame:
    """Good abuse checks -> score / reports with zero defaults, country, last report; one row per IP."""
    d = answers(responses, "abuse_check").filter("abuse_check.value IS NOT NULL").select("ip", F.col("abuse_check.value").alias("d"))
    return d.select(
        F.col("ip"),
        safe_int("d.abuseConfidenceScore", 0).alias("abuse_confidence_score"),
        F.col("d.countryCode").alias("abuse_country_code"),
        F.col("d.countryName").alias("abuse_country_name"),
        F.col("d.lastReportedAt").alias("abuse_last_reported_at"),
        safe_int("d.totalReports", 0).alias("abuse_total_reports"))


def live_answers(responses: DataFrame) -> DataFrame:
    """P5/P6/P8 for the lookup: one row per IP with the geo, abuse and pulse fields of its
    answers; counts are 0 and pulse statuses ``unavailable`` where there is no good one."""
    a = answers(responses, "geo", "abuse_check", "pulse_general", "passive_dns")
    g, d, p = F.col("geo.value"), F.col("abuse_check.value"), F.col("pulse_general.value")
    names = F.coalesce(p["names"], F.array().cast("array<string>"))
    flat = a.select(
        F.col("ip"),
        g["location"]["continent_name"].alias("geo_continent_name"),
        g["location"]["country_code2"].alias("geo_country_code2"),
        g["location"]["country_name"].alias("geo_country_name"),
        g["location"]["state_prov"].alias("geo_state_province"),
        g["location"]["city"].alias("geo_city"),
        g["location"]["latitude"].alias("latitude"), g["location"]["longitude"].alias("longitude"),
        g["location"]["is_eu"].alias("geo_is_eu"), g["asn"]["as_number"].alias("geo_asn_number"),
        g["asn"]["organization"].alias("geo_asn_organization"), g["asn"]["country"].alias("geo_asn_country"),
        g["time_zone"]["name"].alias("geo_timezone_name"), g["time_zone"]["offset"].alias("geo_timezone_offset"),
        d["abuseConfidenceScore"].alias("abuse_score"), d["totalReports"].alias("abuse_reports"),
        d["countryCode"].alias("abuse_country_code"), d["countryName"].alias("abuse_country_name"),
        d["lastReportedAt"].alias("abuse_last_reported_at"),
        p["reputation"].alias("reputation"), p.isNotNull().alias("has_pulse"), names.alias("names"),
        F.col("passive_dns.value.n").alias("dns"))
    return flat.select(
        "ip", *[c for c in flat.columns if c.startswith("geo_")],
        safe_float("latitude", None).alias("geo_latitude"), safe_float("longitude", None).alias("geo_longitude"),
        safe_int("abuse_score", 0).alias("abuse_confidence_score"), safe_int("abuse_reports", 0).alias("abuse_total_reports"),
        "abuse_country_code", "abuse_country_name", "abuse_last_reported_at",
        safe_float("reputation", None).alias("otx_reputation"), F.size("names").alias("otx_pulse_count"),
        F.filter("names", lambda n: n.isNotNull() & (n != F.lit(""))).alias("otx_pulse_names"),
        F.coalesce(F.col("dns"), F.lit(0)).alias("otx_passive_dns_count"),
        F.when(F.col("has_pulse"), F.lit("ok")).otherwise(F.lit("unavailable")).alias("otx_general_status"),
        F.when(F.col("dns").isNotNull(), F.lit("ok")).otherwise(F.lit("unavailable")).alias("otx_passive_dns_status"))
