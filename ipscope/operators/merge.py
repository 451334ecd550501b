"""Keyed profile merges: the table (COALESCE upsert) and document policies.

Both are one full outer join of the stored profiles with the incoming batch on
``ip_address`` followed by per-column policy expressions — no driver-side row
loop, no per-key lookups.

Table policy (J4): COALESCE(new, old) for the feed columns; risk_score, status,
both attack arrays and last_merged_at always from the new row; profile_source
COALESCE(new, old); first_seen_at COALESCE(old, new); enriched_at new (or
COALESCE(new, old) for the lookup variant, Q15).  Scores are not recomputed.

Document policy (J3): geo fields are overwritten only by non-null, non-empty
values; other fields by non-null values (so ``''`` and ``[]`` overwrite); the
four computed fields are recomputed from the merged values; last_merged_at is
the run time; first_seen_at is the incoming one when present (Q5); the geo
point is rebuilt when both coordinates exist.  Stored rows without an incoming
row stay exactly as stored.

Policies are written as SQL text per column (one projection each).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ipscope import schemas as S
from ipscope.functions.scoring import score_columns
from ipscope.functions.sqltext import ident, lit
from ipscope.operators.enrich import conform

FEED_COLUMNS = [c for c in S.PROFILE_COLUMNS if c not in (
    "ip_address", *S.COMPUTED_COLUMNS, "profile_source", "first_seen_at", "last_merged_at",
    "enriched_at", "geo_location")]


def _now_sql(run_ts: str | None) -> str:
    return f"to_timestamp({lit(run_ts)})" if run_ts else "current_timestamp()"


def _sides(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    e = conform(existing, S.PROFILE)
    i = conform(incoming, S.PROFILE)
    e = e.selectExpr(*[f"{ident(c)} AS e_{c}" for c in e.columns], "true AS e_present")
    i = i.selectExpr(*[f"{ident(c)} AS i_{c}" for c in i.columns], "true AS i_present")
    return e.join(i, F.col("e_ip_address") == F.col("i_ip_address"), "full_outer")


def _geo_point_sql(lat: str, lon: str) -> str:
    return (f"CASE WHEN ({lat}) IS NOT NULL AND ({lon}) IS NOT NULL "
            f"THEN named_struct('lat', {lat}, 'lon', {lon}) END")


def merge_table_policy(existing: DataFrame, incoming: DataFrame,
                       keep_old_enriched_at: bool = False) -> DataFrame:
    """COALESCE upsert of ``incoming`` into ``existing`` (PROFILE schema out)."""
    j = _sides(existing, incoming)
    out = {"ip_address": "coalesce(i_ip_address, e_ip_address)"}
    for c in FEED_COLUMNS:
        out[c] = f"coalesce(i_{c}, e_{c})"
    for c in (*S.COMPUTED_COLUMNS, "last_merged_at"):
        out[c] = f"i_{c}"
    out["enriched_at"] = "coalesce(i_enriched_at, e_enriched_at)" if keep_old_enriched_at else "i_enriched_at"
    out["profile_source"] = "coalesce(i_profile_source, e_profile_source)"
    out["first_seen_at"] = "coalesce(e_first_seen_at, i_first_seen_at)"
    out["geo_location"] = _geo_point_sql(out["geo_latitude"], out["geo_longitude"])
    return j.selectExpr(*[f"CASE WHEN i_present THEN {out[c]} ELSE e_{c} END AS {ident(c)}"
                          for c in S.PROFILE_COLUMNS])


def merge_document_policy(existing: DataFrame, incoming: DataFrame,
                          run_ts: str | None = None) -> DataFrame:
    """Document merge with recomputed score (PROFILE schema out)."""
    j = _sides(existing, incoming)
    now = _now_sql(run_ts)
    m = {"ip_address": "coalesce(i_ip_address, e_ip_address)"}
    for c in FEED_COLUMNS:
        if c in S.GEO_FIELDS:
            m[c] = (f"CASE WHEN i_{c} IS NOT NULL AND CAST(i_{c} AS STRING) <> '' "
                    f"THEN i_{c} ELSE e_{c} END")
        else:
            m[c] = f"coalesce(i_{c}, e_{c})"
    m["enriched_at"] = "coalesce(i_enriched_at, e_enriched_at)"
    src = "coalesce(i_profile_source, e_profile_source)"
    m["profile_source"] = f"CASE WHEN {src} IS NOT NULL AND {src} <> '' THEN {src} ELSE {lit(S.PROFILE_SOURCE_BATCH)} END"
    m["first_seen_at"] = f"coalesce(i_first_seen_at, e_first_seen_at, i_enriched_at, {now})"
    m["last_merged_at"] = now
    m["geo_location"] = (f"coalesce({_geo_point_sql(m['geo_latitude'], m['geo_longitude'])}, "
                         f"e_geo_location)")
    merged = j.selectExpr("i_present", *[f"e_{c}" for c in S.PROFILE_COLUMNS],
                          *[f"{v} AS {ident(k)}" for k, v in m.items()])
    scored = score_columns(merged)
    # Stored rows without an incoming row are kept exactly as stored.
    return scored.selectExpr(*[f"CASE WHEN i_present THEN {ident(c)} ELSE e_{c} END AS {ident(c)}"
                               for c in S.PROFILE_COLUMNS])


def merge_profiles(existing: DataFrame, incoming: DataFrame, policy: str = "table",
                   run_ts: str | None = None, keep_old_enriched_at: bool = False) -> DataFrame:
    if policy == "table":
        return merge_table_policy(existing, incoming, keep_old_enriched_at)
    if policy == "document":
        return merge_document_policy(existing, incoming, run_ts)
    raise ValueError(f"unknown merge policy {policy!r}")


def version_order(delta: int, at: str, writer: str, batch: str) -> str:
    """SQL of a row's place: base rows (``delta`` 0) first, then batches by run time, writer and number."""
    return f"named_struct('delta', {delta}, 'at', {at}, 'writer', {writer}, 'batch', CAST({batch} AS BIGINT))"


def resolve_versions(rows: DataFrame, policy: str = "table") -> DataFrame:
    """Fold a base table and appended batch rows per IP under a merge policy.

    ``rows`` holds PROFILE columns plus ``_ord`` (see ``version_order``), ``_merge_ts`` (the run
    time of the row's batch) and ``_keep`` (whether that write keeps the stored
    ``enriched_at`` where it brings none).  The result equals applying
    ``merge_profiles`` batch after batch, but it is a single ``groupBy(ip)`` of
    ``max_by``/``min_by`` aggregates: map-side combinable, and the rows per IP are
    bounded by the batches since the last compaction.  Columns under one rule share
    one aggregate where the rule does not look at the column's own nulls.
    """
    delta = "_ord.delta = 1"
    has = lambda c: f"CASE WHEN {c} IS NOT NULL THEN _ord END"
    newest_nn = lambda c: f"max_by({c}, {has(c)})"
    pack = lambda cols: "named_struct(" + ", ".join(f"'{c}', {ident(c)}" for c in cols) + ")"
    newest = lambda cols: f"max_by({pack(cols)}, _ord)"
    of_base = lambda cols: f"max_by({pack(cols)}, CASE WHEN NOT ({delta}) THEN _ord END)"
    agg = {"_any": f"max({delta})"}
    if policy == "table":
        for c in (*FEED_COLUMNS, "profile_source"):
            agg[c] = newest_nn(c)
        last = [*S.COMPUTED_COLUMNS, "last_merged_at"]
        agg["_last"] = newest(last)
        agg["enriched_at"] = "max_by(enriched_at, CASE WHEN NOT coalesce(_keep, false) OR enriched_at IS NOT NULL THEN _ord END)"
        agg["first_seen_at"] = f"min_by(first_seen_at, {has('first_seen_at')})"
        agg["_base"] = of_base(["geo_location"])
        out = rows.groupBy("ip_address").agg(*[F.expr(v).alias(k) for k, v in agg.items()])
        point = _geo_point_sql("geo_latitude", "geo_longitude")
        return out.selectExpr(*[
            f"CASE WHEN _any THEN {point} ELSE _base.geo_location END AS geo_location" if c == "geo_location"
            else f"_last.{ident(c)} AS {ident(c)}" if c in last else ident(c) for c in S.PROFILE_COLUMNS])
    if policy != "document":
        raise ValueError(f"unknown merge policy {policy!r}")
    for c in FEED_COLUMNS:
        if c in S.GEO_FIELDS:
            ok = f"CASE WHEN NOT ({delta}) OR ({c} IS NOT NULL AND CAST({c} AS STRING) <> '') THEN _ord END"
            agg[c] = f"max_by({c}, {ok})"
        else:
            agg[c] = newest_nn(c)
    agg["enriched_at"] = newest_nn("enriched_at")
    agg["_src"] = newest_nn("profile_source")
    agg["_first"] = newest_nn("first_seen_at")
    # When no row carries first_seen_at, the first batch fixes it (its enriched_at, else its run time).
    agg["_first_delta"] = f"min_by(named_struct('e', enriched_at, 'm', _merge_ts), CASE WHEN {delta} THEN _ord END)"
    agg["_merge_ts"] = "max_by(_merge_ts, _ord)"
    stored = [*S.COMPUTED_COLUMNS, "last_merged_at", "profile_source", "first_seen_at", "geo_location"]
    agg["_base"] = of_base(stored)
    out = rows.groupBy("ip_address").agg(*[F.expr(v).alias(k) for k, v in agg.items()])
    out = out.selectExpr(
        "*",
        f"CASE WHEN _any THEN (CASE WHEN _src IS NOT NULL AND _src <> '' THEN _src "
        f"ELSE {lit(S.PROFILE_SOURCE_BATCH)} END) ELSE _base.profile_source END AS _source",
        "CASE WHEN _any THEN coalesce(_first, _first_delta.e, _first_delta.m) ELSE _base.first_seen_at END AS _fs",
        "CASE WHEN _any THEN _merge_ts ELSE _base.last_merged_at END AS _lm",
        f"CASE WHEN _any THEN coalesce({_geo_point_sql('geo_latitude', 'geo_longitude')}, _base.geo_location) "
        f"ELSE _base.geo_location END AS _geo")
    scored = score_columns(out)
    named = {"profile_source": "_source", "first_seen_at": "_fs", "last_merged_at": "_lm", "geo_location": "_geo"}
    cols = []
    for c in S.PROFILE_COLUMNS:
        if c in S.COMPUTED_COLUMNS:
            cols.append(f"CASE WHEN _any THEN {ident(c)} ELSE _base.{ident(c)} END AS {ident(c)}")
        else:
            cols.append(f"{named.get(c, ident(c))} AS {ident(c)}")
    return scored.selectExpr(*cols)
