"""Report enrichment: abuse reports joined with pulse and geo snapshots, scored.

Plan shape (one micro-batch or one batch run):

    reports --dedupe by ip (partial agg)--+
                                          +-- left join on ip --+-- left join on ip -- project/score
    pulses  --dedupe by ip----------------+                      |
    geo     --dedupe by ip-----------------------------------------+

All three inputs are hash-partitioned on ``ip_address`` by their dedupe, so the
two left joins reuse that partitioning (no extra exchange on the big side).
When a snapshot is small, Spark's size-checked broadcast (static threshold on
the estimated size, AQE on the measured shuffle size) replaces the sort-merge
join; nothing is broadcast without that check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ipscope import schemas as S
from ipscope.functions.casts import normalize_string_array
from ipscope.functions.scoring import score_columns
from ipscope.functions.sqltext import ident, strip
from ipscope.operators.dedupe import dedupe_latest, latest_snapshot_rows


def run_time(ts: str | None) -> Column:
    """The run's "now": an injected literal, or ``current_timestamp()``."""
    return F.to_timestamp(F.lit(ts)) if ts else F.current_timestamp()


def conform(df: DataFrame, schema) -> DataFrame:
    """Select ``schema``'s columns in order, typed; missing ones become null."""
    if [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in schema.fields]:
        return df  # already conforming: no extra projection to analyse
    have = set(df.columns)
    return df.selectExpr(*[
        f"CAST({ident(f.name) if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS {ident(f.name)}"
        for f in schema.fields])


def join_snapshots(reports: DataFrame, pulses: DataFrame, geo: DataFrame,
                   run_ts: str | None = None, preserve_missing: bool = False,
                   dedupe_reports: bool = True) -> DataFrame:
    """J1 + J2 + P10..P13: the 26 enriched columns, one row per report ip.

    ``preserve_missing`` skips the zero fill so that a later COALESCE merge keeps
    stored values for IPs the snapshots do not cover (Q6).
    """
    abuse = reports.select("ip_address", "country_code", "abuse_confidence_score", "last_reported_at",
                           *[c for c in ("ingestion_time", "processed_at") if c in reports.columns])
    if dedupe_reports:
        abuse = dedupe_latest(abuse)
    o = latest_snapshot_rows(conform(pulses, S.PULSE)).select(
        "ip_address", "otx_reputation", "otx_pulse_count", "otx_pulse_names",
        "otx_passive_dns_count", "otx_general_status", "otx_passive_dns_status")
    g = latest_snapshot_rows(conform(geo, S.GEO)).select("ip_address", *S.GEO_FIELDS)
    j = abuse.join(o, "ip_address", "left").join(g, "ip_address", "left")
    if not preserve_missing:
        j = j.fillna({"otx_reputation": 0.0, "otx_pulse_count": 0,
                      "otx_passive_dns_count": 0, "abuse_confidence_score": 0})
    derived = {
        "abuse_country_code": F.col("country_code"),
        "abuse_country_name": F.col("geo_country_name"),
        "abuse_last_reported_at": F.col("last_reported_at"),
        "abuse_total_reports": F.lit(None).cast("int"),
        "enriched_at": run_time(run_ts),
    }
    return j.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in S.ENRICHED_COLUMNS])


def geo_point(lat="geo_latitude", lon="geo_longitude") -> Column:
    """``{lat, lon}`` only when both coordinates exist."""
    la, lo = F.col(lat), F.col(lon)
    return F.when(la.isNotNull() & lo.isNotNull(), F.struct(la.alias("lat"), lo.alias("lon")))


def score_profiles(df: DataFrame, source: str = S.PROFILE_SOURCE_BATCH,
                   run_ts: str | None = None, word_boundary: bool = False) -> DataFrame:
    """P14 + H7..H9 + P16: batch defaults, classification, score, status, geo point."""
    now = run_time(run_ts)
    enriched = (F.col("enriched_at").cast("timestamp") if "enriched_at" in df.columns
                else F.lit(None).cast("timestamp"))
    enriched = F.coalesce(enriched, now)
    names_t = df.schema["otx_pulse_names"].dataType
    repl = {
        "profile_source": F.lit(source),
        "enriched_at": enriched,
        "last_merged_at": enriched,
        "first_seen_at": enriched,
        "abuse_last_reported_at": F.try_to_timestamp(F.col("abuse_last_reported_at").cast("string")),
        "otx_pulse_names": normalize_string_array("otx_pulse_names", names_t),
    }
    base = df.select(*[c for c in df.columns if c not in repl],
                     *[v.alias(k) for k, v in repl.items()])
    out = score_columns(base, word_boundary=word_boundary)
    out = out.select("*", geo_point().alias("geo_location"))
    return conform(out, S.PROFILE)


def enrich_and_score(reports: DataFrame, pulses: DataFrame, geo: DataFrame,
                     run_ts: str | None = None, preserve_missing: bool = False) -> DataFrame:
    """Flagship: reports -> one scored profile row per IP (PROFILE schema)."""
    return score_profiles(join_snapshots(reports, pulses, geo, run_ts, preserve_missing),
                          run_ts=run_ts)


def split_dead_letters(df: DataFrame, key: str = "ip_address") -> tuple[DataFrame, DataFrame]:
    """Rows without a usable key go to a dead-letter output, not the stores."""
    ok = F.col(key).isNotNull() & (strip(F.col(key)) != "")
    return df.filter(ok), df.filter(~ok | F.col(key).isNull())
