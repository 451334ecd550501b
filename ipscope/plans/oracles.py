"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the rules, not from the Spark code: dedupe by window, classification
by ``contains`` over the keyword list, score by CASE arithmetic.  The stand-in
input views come from ``ipscope.standin`` (same text in both engines).
"""

from __future__ import annotations

from itertools import chain

from ipscope import schemas as S
from ipscope import standin

RUN_TS = standin.RUN_TS
ALL_KW = sorted(set(chain.from_iterable(S.ATTACK_KEYWORDS.values())))
CATS = sorted(S.ATTACK_KEYWORDS)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def kw_list(t: str) -> str:
    """Sorted matched keywords of lower-case text expression ``t``."""
    items = ", ".join(q(k) for k in ALL_KW)
    return f"list_filter([{items}], lambda k: contains({t}, k))"


def cat_list(t: str) -> str:
    parts = []
    for c in CATS:
        cond = " OR ".join(f"contains({t}, {q(k)})" for k in S.ATTACK_KEYWORDS[c])
        parts.append(f"CASE WHEN {cond} THEN {q(c)} END")
    return f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)"


def score_sql(a: str, p: str, d: str, C: str, W: str) -> str:
    cat_bonus = " + ".join(f"CASE WHEN list_contains({C}, {q(c)}) THEN {b} ELSE 0 END"
                           for c, b in S.CATEGORY_BONUS.items())
    kw_bonus = " + ".join(f"CASE WHEN list_contains({W}, {q(k)}) THEN {b} ELSE 0 END"
                          for k, b in S.KEYWORD_BONUS.items())
    base = (f"CAST(least({a}, 100) AS DOUBLE) * 0.6 + CASE WHEN {p} >= 50 THEN 35 WHEN {p} >= 20 THEN 25 "
            f"WHEN {p} >= 10 THEN 18 WHEN {p} >= 5 THEN 10 WHEN {p} > 0 THEN 5 ELSE 0 END "
            f"+ CAST(least({d}, 20) AS DOUBLE) * 0.5 + ({cat_bonus}) + ({kw_bonus})")
    floors = (f"CASE WHEN {p} >= 20 AND len({C}) > 0 THEN 55 END, "
              f"CASE WHEN list_contains({C}, 'Exploitation') OR list_contains({W}, 'rce') "
              f"OR list_contains({W}, 'remote code execution') THEN 70 END, "
              f"CASE WHEN list_contains({C}, 'Botnet / C2') OR list_contains({C}, 'Ransomware') "
              f"THEN 80 END, "
              f"CASE WHEN {a} >= 40 AND len({C}) > 0 THEN 65 END")
    return f"CAST(round(least(greatest({base}, {floors}), 100), 2) AS DOUBLE)"


def status_sql(s: str) -> str:
    return (f"CASE WHEN {s} >= 70 THEN 'High Risk' WHEN {s} >= 30 THEN 'Medium Risk' "
            f"ELSE 'Low Risk' END")


GEO_COLS = ", ".join(f"g.{c}" for c in S.GEO_FIELDS)


def profiles_ctes(reports: str = "v_abuse", name: str = "prof", fill: bool = True,
                  run_ts: str = RUN_TS, geo: str = "v_geo") -> str:
    """CTEs ``{name}_a`` (deduped reports), ``{name}_j`` (joined) and ``{name}``
    (scored, rendered profile rows) over the report view ``reports``."""
    z = (lambda x, d: f"coalesce({x}, {d})") if fill else (lambda x, d: x)
    return f""",
{name}_a AS (
  SELECT ip_address, country_code, abuse_confidence_score, last_reported_at FROM (
    SELECT *, row_number() OVER (PARTITION BY ip_address ORDER BY last_reported_at DESC NULLS LAST,
             abuse_confidence_score DESC NULLS LAST, country_code DESC NULLS LAST) AS rn
    FROM {reports}) t WHERE rn = 1),
{name}_j AS (
  SELECT a.ip_address,
         {z('a.abuse_confidence_score', '0')} AS abuse_confidence_score,
         a.country_code AS abuse_country_code,
         g.geo_country_name AS abuse_country_name,
         a.last_reported_at AS abuse_last_reported_at,
         CAST(NULL AS INTEGER) AS abuse_total_reports,
         {z('p.otx_reputation', '0.0')} AS otx_reputation,
         {z('p.otx_pulse_count', '0')} AS otx_pulse_count,
         CASE WHEN p.pulse_text IS NULL THEN CAST([] AS VARCHAR[])
              ELSE string_split(p.pulse_text, ' | ') END AS names,
         lower(coalesce(p.pulse_text, '')) AS ptext,
         {z('p.otx_passive_dns_count', '0')} AS otx_passive_dns_count,
         p.otx_general_status, p.otx_passive_dns_status,
         {GEO_COLS}
  FROM {name}_a a LEFT JOIN v_pulse p ON p.ip_address = a.ip_address
  LEFT JOIN {geo} g ON g.ip_address = a.ip_address),
{name}_c AS (
  SELECT *, {kw_list('ptext')} AS W, {cat_list('ptext')} AS C FROM {name}_j),
{name}_s AS (
  SELECT *, {score_sql('coalesce(abuse_confidence_score, 0)', 'coalesce(otx_pulse_count, 0)',
                       'coalesce(otx_passive_dns_count, 0)', 'C', 'W')} AS risk_score FROM {name}_c),
{name} AS (
  SELECT ip_address, abuse_confidence_score, abuse_country_code, abuse_country_name,
         abuse_last_reported_at, abuse_total_reports, otx_reputation, otx_pulse_count,
         array_to_string(names, ', ') AS otx_pulse_names, otx_passive_dns_count,
         otx_general_status, otx_passive_dns_status,
         {', '.join(S.GEO_FIELDS)},
         risk_score, {status_sql('risk_score')} AS status,
         array_to_string(C, ', ') AS attack_categories,
         array_to_string(W, ', ') AS attack_keywords_matched,
         'pipeline' AS profile_source,
         {q(run_ts)} AS first_seen_at, {q(run_ts)} AS last_merged_at, {q(run_ts)} AS enriched_at,
         C AS cat_list, W AS kw_list, names AS names_list
  FROM {name}_s)"""


def with_profiles(reports: str = "v_abuse") -> str:
    return standin.with_clause("duckdb").rstrip() + profiles_ctes(reports) + "\n"


PROFILE_OUT = ", ".join(c for c in S.PROFILE_COLUMNS if c != "geo_location")


def classify_cte_cols(names: str) -> str:
    """Lower-cased text of a names list, as the classifier sees it."""
    return (f"lower(array_to_string(list_filter({names}, lambda x: x IS NOT NULL AND x <> ''), ' | '))")


NO_GEO = "(SELECT * FROM v_geo WHERE false)"
from ipscope.plans.catalog import ODD_VALUES, PREV_RUN_TS  # noqa: E402
CUT = standin.PREV_CUTOFF.replace(" ", "T")


def merge_ctes() -> str:
    early = f"(SELECT * FROM v_abuse WHERE last_reported_at < {q(CUT)})"
    late = f"(SELECT * FROM v_abuse WHERE NOT (last_reported_at < {q(CUT)}))"
    return (standin.with_clause("duckdb").rstrip()
            + profiles_ctes(early, "pe", run_ts=PREV_RUN_TS)
            + profiles_ctes(late, "pi", run_ts=RUN_TS, geo=NO_GEO) + "\n")


FEED = [c for c in S.PROFILE_COLUMNS if c not in (
    "ip_address", *S.COMPUTED_COLUMNS, "profile_source", "first_seen_at", "last_merged_at",
    "enriched_at", "geo_location")]


def merge_table_sql() -> str:
    sel = ["coalesce(i.ip_address, e.ip_address) AS ip_address"]
    for c in S.PROFILE_COLUMNS:
        if c in ("ip_address", "geo_location"):
            continue
        if c in FEED or c == "profile_source":
            sel.append(f"coalesce(i.{c}, e.{c}) AS {c}")
        elif c == "first_seen_at":
            sel.append(f"coalesce(e.{c}, i.{c}) AS {c}")
        else:  # computed, last_merged_at, enriched_at: new row wins when present
            sel.append(f"CASE WHEN i.ip_address IS NOT NULL THEN i.{c} ELSE e.{c} END AS {c}")
    return (merge_ctes() + "SELECT " + ",\n  ".join(sel)
            + "\nFROM pe e FULL OUTER JOIN pi i ON e.ip_address = i.ip_address")


def merge_document_sql() -> str:
    m = ["coalesce(i.ip_address, e.ip_address) AS ip_address"]
    for c in FEED:
        if c in S.GEO_FIELDS:
            m.append(f"CASE WHEN i.{c} IS NOT NULL AND CAST(i.{c} AS VARCHAR) <> '' THEN i.{c} "
                     f"ELSE e.{c} END AS {c}")
        elif c == "otx_pulse_names":
            m.append("coalesce(i.names_list, e.names_list) AS mnames")
        else:
            m.append(f"coalesce(i.{c}, e.{c}) AS {c}")
    m.append("i.ip_address IS NOT NULL AS hit")
    for c in (*S.COMPUTED_COLUMNS, "profile_source", "first_seen_at", "last_merged_at", "enriched_at"):
        m.append(f"e.{c} AS e_{c}")
    m.append("coalesce(i.enriched_at, e.enriched_at) AS m_enriched_at")
    m.append("coalesce(i.profile_source, e.profile_source) AS m_source")
    m.append(f"coalesce(i.first_seen_at, e.first_seen_at, i.enriched_at, {q(RUN_TS)}) AS m_first_seen")
    base = ", ".join(m)
    t = classify_cte_cols("mnames")
    out = ["ip_address"]
    for c in FEED:
        out.append("array_to_string(mnames, ', ') AS otx_pulse_names" if c == "otx_pulse_names" else c)
    out += [
        f"CASE WHEN hit THEN rs ELSE e_risk_score END AS risk_score",
        f"CASE WHEN hit THEN {status_sql('rs')} ELSE e_status END AS status",
        "CASE WHEN hit THEN array_to_string(C, ', ') ELSE e_attack_categories END AS attack_categories",
        "CASE WHEN hit THEN array_to_string(W, ', ') ELSE e_attack_keywords_matched END AS attack_keywords_matched",
        "CASE WHEN hit THEN (CASE WHEN m_source IS NOT NULL AND m_source <> '' THEN m_source "
        "ELSE 'pipeline' END) ELSE e_profile_source END AS profile_source",
        "CASE WHEN hit THEN m_first_seen ELSE e_first_seen_at END AS first_seen_at",
        f"CASE WHEN hit THEN {q(RUN_TS)} ELSE e_last_merged_at END AS last_merged_at",
        "CASE WHEN hit THEN m_enriched_at ELSE e_enriched_at END AS enriched_at",
    ]
    score = score_sql("coalesce(abuse_confidence_score, 0)", "coalesce(otx_pulse_count, 0)",
                      "coalesce(otx_passive_dns_count, 0)", "C", "W")
    return (merge_ctes() + f""",
md AS (SELECT {base} FROM pe e FULL OUTER JOIN pi i ON e.ip_address = i.ip_address),
mc AS (SELECT *, {kw_list('mt')} AS W, {cat_list('mt')} AS C FROM (SELECT *, {t} AS mt FROM md) x),
ms AS (SELECT *, {score} AS rs FROM mc)
SELECT {', '.join(out)} FROM ms""")


def lookup_sql() -> str:
    """Store = profiles of all reports; requests = every customer IP; misses from responses."""
    names = ("CASE WHEN p.pulse_text IS NULL THEN CAST([] AS VARCHAR[]) "
             "ELSE string_split(p.pulse_text, ' | ') END")
    live = f"""
live_j AS (
  SELECT {standin.ip_of('c.c_custkey')} AS ip_address,
         CAST(abs(floor(c.c_acctbal)) % 101 AS INTEGER) AS abuse_confidence_score,
         substr(n.n_name, 1, 2) AS abuse_country_code, n.n_name AS abuse_country_name,
         CAST(NULL AS VARCHAR) AS abuse_last_reported_at,
         CAST(c.c_custkey % 13 AS INTEGER) AS abuse_total_reports,
         c.c_acctbal AS otx_reputation,
         CAST(len({names}) AS INTEGER) AS otx_pulse_count,
         list_filter({names}, lambda x: x IS NOT NULL AND x <> '') AS names,
         CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 0 ELSE CAST(c.c_custkey % 5 + 1 AS INTEGER) END
           AS otx_passive_dns_count,
         'ok' AS otx_general_status,
         CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'unavailable' ELSE 'ok' END AS otx_passive_dns_status,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE r.r_name END AS geo_continent_name,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE substr(n.n_name, 1, 2) END AS geo_country_code2,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE n.n_name END AS geo_country_name,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_mktsegment END AS geo_state_province,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE 'City_' || CAST(c.c_custkey % 40 AS VARCHAR) END AS geo_city,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE CAST(c.c_custkey * 7 % 180 - 90 AS DOUBLE) END AS geo_latitude,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE CAST(c.c_custkey * 11 % 360 - 180 AS DOUBLE) END AS geo_longitude,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE r.r_name = 'EUROPE' END AS geo_is_eu,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE 'AS' || CAST(c.c_custkey % 900 + 100 AS VARCHAR) END AS geo_asn_number,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE 'Org ' || c.c_mktsegment END AS geo_asn_organization,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE substr(n.n_name, 1, 2) END AS geo_asn_country,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE r.r_name END AS geo_timezone_name,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE CAST(c.c_custkey % 24 - 12 AS DOUBLE) END AS geo_timezone_offset
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey
  LEFT JOIN v_pulse p ON p.ip_address = {standin.ip_of('c.c_custkey')}
  WHERE {standin.ip_of('c.c_custkey')} NOT IN (SELECT ip_address FROM pe)),
live_c AS (SELECT *, {kw_list('lt')} AS W, {cat_list('lt')} AS C
           FROM (SELECT *, {classify_cte_cols('names')} AS lt FROM live_j) x),
live_s AS (SELECT *, {score_sql('abuse_confidence_score', 'otx_pulse_count', 'otx_passive_dns_count', 'C', 'W')}
           AS risk_score FROM live_c)"""
    ctes = (standin.with_clause("duckdb").rstrip()
            + profiles_ctes("v_abuse", "pe", run_ts=PREV_RUN_TS) + ",\n" + live + "\n")
    cols = [c for c in S.PROFILE_COLUMNS if c != "geo_location"]
    hit_sel = []
    live_sel = []
    for c in cols:
        if c == "last_merged_at":
            hit_sel.append(f"{q(RUN_TS)} AS {c}")
        else:
            hit_sel.append(c)
        if c == "otx_pulse_names":
            live_sel.append("array_to_string(names, ', ') AS otx_pulse_names")
        elif c in ("attack_categories", "attack_keywords_matched"):
            live_sel.append(f"array_to_string({'C' if c == 'attack_categories' else 'W'}, ', ') AS {c}")
        elif c == "status":
            live_sel.append(f"{status_sql('risk_score')} AS status")
        elif c == "profile_source":
            live_sel.append("'live_lookup' AS profile_source")
        elif c in ("first_seen_at", "last_merged_at", "enriched_at"):
            live_sel.append(f"{q(RUN_TS)} AS {c}")
        else:
            live_sel.append(c)
    return (ctes + "SELECT " + ", ".join(hit_sel) + " FROM pe\nUNION ALL\nSELECT "
            + ", ".join(live_sel) + " FROM live_s")


def oracle_sql() -> dict[str, str]:
    W = with_profiles()
    V = standin.with_clause("duckdb")
    o = {}
    o["left_enrich"] = W + f"SELECT {PROFILE_OUT} FROM prof"
    o["risk_score"] = W + "SELECT ip_address, risk_score, status FROM prof"
    o["status_counts"] = W + ("SELECT status, count(*) AS ip_count, round(avg(risk_score), 2) AS avg_risk_score "
                              "FROM prof GROUP BY status")
    o["country_counts"] = W + (
        "SELECT *, CAST(row_number() OVER (ORDER BY ip_count DESC, country NULLS LAST) AS INTEGER) AS country_rank FROM ("
        "SELECT abuse_country_code AS country, count(*) AS ip_count, "
        "CAST(sum(CASE WHEN status = 'High Risk' THEN 1 ELSE 0 END) AS BIGINT) AS high_risk_count "
        "FROM prof GROUP BY abuse_country_code) c")
    o["score_histogram"] = W + ("SELECT CAST(floor(risk_score / 10) * 10 AS INTEGER) AS score_bucket, "
                                "count(*) AS ip_count FROM prof GROUP BY 1")
    o["abuse_by_status"] = W + (
        "SELECT status, count(*) AS ip_count, round(avg(abuse_confidence_score), 2) AS avg_abuse_score, "
        "min(abuse_confidence_score) AS min_abuse_score, max(abuse_confidence_score) AS max_abuse_score "
        "FROM prof GROUP BY status")
    o["normalize_abuse"] = V + (
        f"SELECT pos, ip_address, country_code, abuse_confidence_score, last_reported_at, "
        f"{q(RUN_TS)} AS ingestion_time, {q(RUN_TS)} AS processed_at FROM v_abuse")
    o["normalize_pulses"] = V + (
        "SELECT ip_address, otx_reputation, otx_pulse_count, "
        "coalesce(array_to_string(string_split(pulse_text, ' | '), ', '), '') AS otx_pulse_names, "
        "otx_passive_dns_count, otx_general_status, otx_passive_dns_status, "
        "CAST(NULL AS VARCHAR) AS first_ingestion_time, CAST(NULL AS VARCHAR) AS last_ingestion_time, "
        f"CAST(NULL AS INTEGER) AS seen_count, {q(RUN_TS)} AS raw_ingestion_time, "
        f"{q(RUN_TS)} AS processed_at FROM v_pulse")
    o["normalize_geo"] = V + (
        f"SELECT ip_address, {', '.join(S.GEO_FIELDS)}, geo_status, "
        "CAST(NULL AS VARCHAR) AS first_ingestion_time, CAST(NULL AS VARCHAR) AS last_ingestion_time, "
        f"CAST(NULL AS INTEGER) AS seen_count, {q(RUN_TS)} AS raw_ingestion_time, "
        f"{q(RUN_TS)} AS processed_at FROM v_geo")
    o["safe_casts"] = (
        "SELECT event_id, CAST(trunc(value) AS INTEGER) AS int_value, value AS float_value, "
        "CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int, "
        "CASE WHEN json_extract_string(props, '$.k') IN ('1') THEN true "
        "WHEN json_extract_string(props, '$.k') IN ('0') THEN false END AS k_bool, "
        "0 AS props_int, trim(props) AS props_array FROM events")
    o["document_keywords"] = (
        f"SELECT doc_id, array_to_string({kw_list('lower(text)')}, ', ') AS attack_keywords_matched, "
        f"array_to_string({cat_list('lower(text)')}, ', ') AS attack_categories FROM documents")
    from ipscope.functions.ip import IPV4_RE, IPV4_TOKEN_RE
    o["document_ips"] = (
        f"SELECT ip_token, count(*) AS n_occurrences, count(DISTINCT doc_id) AS n_docs, "
        f"CASE WHEN regexp_full_match(ip_token, {q(IPV4_RE)}) THEN 'IPv4' END AS ip_version "
        f"FROM (SELECT doc_id, unnest(regexp_extract_all(text, {q(IPV4_TOKEN_RE)})) AS ip_token "
        f"FROM documents) t GROUP BY ip_token")
    o["attack_classify"] = V + (
        f"SELECT ip_address, array_to_string({cat_list('lower(coalesce(pulse_text, \'\'))')}, ', ') "
        f"AS attack_categories, array_to_string({kw_list('lower(coalesce(pulse_text, \'\'))')}, ', ') "
        f"AS attack_keywords_matched FROM v_pulse")
    o["distinct_ips"] = V + (
        "SELECT trim(ip_address) AS ip_address, min(pos) AS first_pos FROM v_abuse "
        "WHERE ip_address IS NOT NULL AND trim(ip_address) <> '' GROUP BY 1")
    o["top_n_latest"] = V + (
        "SELECT pos, ip_address, last_reported_at FROM v_abuse "
        "WHERE ip_address IS NOT NULL AND ip_address <> '' "
        "ORDER BY coalesce(last_reported_at, '') DESC, pos ASC LIMIT 100")
    o["dedupe_latest"] = V + (
        "SELECT ip_address, country_code, abuse_confidence_score, last_reported_at FROM ("
        "SELECT *, row_number() OVER (PARTITION BY ip_address ORDER BY last_reported_at DESC NULLS LAST, "
        "abuse_confidence_score DESC NULLS LAST, country_code DESC NULLS LAST) AS rn FROM v_abuse) t WHERE rn = 1")
    o["last_wins"] = V + (
        "SELECT ip_address, pos, country_code, abuse_confidence_score, last_reported_at FROM ("
        "SELECT *, row_number() OVER (PARTITION BY ip_address ORDER BY pos DESC) AS rn FROM v_abuse) t "
        "WHERE rn = 1")
    o["latest_reported"] = V + (
        "SELECT pos, ip_address, country_code, abuse_confidence_score, last_reported_at FROM v_abuse "
        "ORDER BY last_reported_at DESC NULLS LAST, ip_address ASC, pos ASC LIMIT 20")
    diff = V.rstrip() + """,
d AS (SELECT coalesce(p.ip_address, c.ip_address) AS ip_address,
        CASE WHEN p.ip_address IS NULL THEN 'new' WHEN c.ip_address IS NULL THEN 'removed'
             WHEN p.abuse_confidence_score IS DISTINCT FROM c.abuse_confidence_score
               OR p.last_reported_at IS DISTINCT FROM c.last_reported_at
               OR p.country_code IS DISTINCT FROM c.country_code THEN 'changed'
             ELSE 'same' END AS change
      FROM v_prev p FULL OUTER JOIN v_curr c ON p.ip_address = c.ip_address)
"""
    o["diff_new"] = diff + "SELECT ip_address FROM d WHERE change = 'new'"
    o["diff_removed"] = diff + "SELECT ip_address FROM d WHERE change = 'removed'"
    o["diff_changed"] = diff + "SELECT ip_address FROM d WHERE change = 'changed'"
    o["diff_summary"] = diff + (
        "SELECT count(*) FILTER (WHERE change = 'new') AS new_ip_count, "
        "count(*) FILTER (WHERE change = 'changed') AS changed_ip_count, "
        "count(*) FILTER (WHERE change = 'removed') AS removed_ip_count FROM d")
    o["diff_samples"] = diff + (
        "SELECT ip_address, change FROM (SELECT *, row_number() OVER (PARTITION BY change "
        "ORDER BY ip_address) AS rn FROM d WHERE change <> 'same') t WHERE rn <= 10")
    js = ("'{\"abuse_confidence_score\":' || coalesce(CAST(abuse_confidence_score AS VARCHAR), 'null') || "
          "',\"country_code\":' || coalesce(CAST(to_json(country_code) AS VARCHAR), 'null') || "
          "',\"ip_address\":' || coalesce(CAST(to_json(ip_address) AS VARCHAR), 'null') || "
          "',\"last_reported_at\":' || coalesce(CAST(to_json(last_reported_at) AS VARCHAR), 'null') || '}'")
    parts = ", ".join(f"sum(CAST(('0x' || substr(h, {1 + 15 * i}, 15)) AS BIGINT)) AS s{i}" for i in range(4))
    fp = lambda v: (f"(SELECT sha256(concat_ws(':', CAST(n AS VARCHAR), CAST(s0 AS VARCHAR), "  # noqa: E731
                    f"CAST(s1 AS VARCHAR), CAST(s2 AS VARCHAR), CAST(s3 AS VARCHAR))) AS fingerprint, n "
                    f"FROM (SELECT count(*) AS n, {parts} FROM (SELECT sha256({js}) AS h FROM {v}) a) b)")
    o["fingerprint"] = V + (
        f"SELECT p.fingerprint AS previous_fingerprint, c.fingerprint AS current_fingerprint, "
        f"c.n AS record_count, p.fingerprint IS NULL OR p.fingerprint <> c.fingerprint AS changed "
        f"FROM {fp('v_prev')} p, {fp('v_curr')} c")
    carry = V.rstrip() + f""",
cand AS (SELECT DISTINCT ip_address AS ip FROM v_abuse),
fresh AS (
  SELECT {standin.ip_of('c.c_custkey')} AS ip,
         CASE WHEN c.c_acctbal < 0 THEN 'HTTPError: 429 Too Many Requests' ELSE 'ok' END AS status,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE n.n_name END AS country_name,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE 'City_' || CAST(c.c_custkey % 40 AS VARCHAR) END AS city,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE CAST(c.c_custkey * 7 % 180 - 90 AS VARCHAR) END AS latitude,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE CAST(c.c_custkey * 11 % 360 - 180 AS VARCHAR) END AS longitude,
         {q(RUN_TS)} AS first_ingestion_time, '1' AS seen_count
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey),
old AS (SELECT ip_address AS ip, geo_status AS status, geo_country_name AS country_name, geo_city AS city,
               CAST(geo_latitude AS VARCHAR) AS latitude, CAST(geo_longitude AS VARCHAR) AS longitude,
               CAST(NULL AS VARCHAR) AS first_ingestion_time, CAST(NULL AS VARCHAR) AS seen_count FROM v_geo),
newf AS (SELECT f.* FROM fresh f JOIN cand ON cand.ip = f.ip WHERE f.ip NOT IN (SELECT ip FROM old))
"""
    o["carry_forward"] = carry + "SELECT * FROM old UNION ALL SELECT * FROM newf"
    o["carry_forward_counts"] = carry + (
        "SELECT (SELECT count(*) FROM newf) AS new_count, CAST(0 AS BIGINT) AS updated_count, "
        "(SELECT count(*) FROM cand WHERE ip IN (SELECT ip FROM old)) AS skipped_count, "
        "(SELECT count(*) FROM old) + (SELECT count(*) FROM newf) AS total_unique")
    o["merge_table"] = merge_table_sql()
    o["merge_document"] = merge_document_sql()
    o["geo_point"] = V + (
        "SELECT ip_address, CASE WHEN geo_longitude IS NOT NULL THEN geo_latitude END AS lat, "
        "CASE WHEN geo_latitude IS NOT NULL THEN geo_longitude END AS lon FROM v_geo")
    lk = lookup_sql()
    o["lookup_profile"] = lk
    o["display_profile"] = (
        "SELECT coalesce(ip_address, '') AS ip_address, "
        "coalesce(geo_country_name, abuse_country_name, 'Unknown') AS country, "
        "coalesce(geo_city, 'Unknown') AS city, coalesce(geo_asn_organization, 'Unknown') AS asn_organization, "
        "coalesce(abuse_confidence_score, 0) AS abuse_confidence_score, "
        "coalesce(otx_pulse_count, 0) AS otx_pulse_count, "
        "coalesce(otx_passive_dns_count, 0) AS otx_passive_dns_count, "
        "coalesce(risk_score, 0.0) AS risk_score, coalesce(status, 'Low Risk') AS status, "
        "coalesce(attack_categories, 'None') AS attack_categories, "
        "coalesce(attack_keywords_matched, 'None') AS attack_keywords_matched, "
        "coalesce(profile_source, 'pipeline') AS profile_source FROM (" + lk + ") lp")
    o["country_spikes"] = V.rstrip() + """,
h AS (SELECT country_code AS country, date_trunc('hour', reported_ts) AS hour, count(*) AS reports
      FROM v_abuse GROUP BY ALL),
w AS (SELECT *, CAST(coalesce(sum(reports) OVER win, 0) AS DOUBLE) AS s,
             CAST(coalesce(sum(reports * reports) OVER win, 0) AS DOUBLE) AS ss,
             eh - min(eh) OVER (PARTITION BY country) AS age
      FROM (SELECT *, CAST(epoch(hour) / 3600 AS BIGINT) AS eh FROM h) x
      WINDOW win AS (PARTITION BY country ORDER BY eh RANGE BETWEEN 24 PRECEDING AND 1 PRECEDING))
SELECT country, strftime(hour, '%Y-%m-%dT%H:%M:%S.%fZ') AS hour, reports,
       round(s / 24.0, 4) AS baseline_mean,
       round(sqrt(greatest(ss / 24.0 - (s / 24.0) * (s / 24.0), 0.0)), 4) AS baseline_std
FROM w
WHERE age >= 24 AND reports >= 3 AND reports > s / 24.0 + 3.0 * sqrt(greatest(ss / 24.0 - (s / 24.0) * (s / 24.0), 0.0))"""
    o["high_risk_ips"] = W + ("SELECT ip_address, risk_score, abuse_country_code FROM prof "
                              "WHERE status = 'High Risk'")
    req = (f"(SELECT DISTINCT {standin.ip_of('c_custkey')} AS ip_address FROM customer)")
    early_ips = "(SELECT DISTINCT ip_address FROM v_abuse)"
    o["lookup_hits"] = V + f"SELECT ip_address FROM {req} r WHERE ip_address IN {early_ips}"
    o["lookup_misses"] = V + f"SELECT ip_address FROM {req} r WHERE ip_address NOT IN {early_ips}"
    o["merge_on_read_table"] = o["merge_table"]
    o["merge_on_read_document"] = o["merge_document"]
    o["snapshot_manifest"] = V + (
        f"SELECT 'abuse_blacklist' AS source, {q(RUN_TS)} AS ingestion_time, count(*) AS record_count "
        f"FROM v_abuse UNION ALL SELECT 'pulses', {q(RUN_TS)}, count(*) FROM v_pulse "
        f"UNION ALL SELECT 'geo', {q(RUN_TS)}, count(*) FROM v_geo")
    o["publish_roundtrip"] = V + (
        f"SELECT ip_address, country_code, abuse_confidence_score, last_reported_at, "
        f"{q(RUN_TS)} AS ingestion_time, {q(RUN_TS)} AS processed_at FROM v_abuse")
    # IP rules spelled out part by part, apart from the library's patterns.
    cand = V.rstrip() + f""",
cand AS (SELECT DISTINCT ip FROM (
  SELECT unnest(regexp_extract_all(text, {q(IPV4_TOKEN_RE)})) AS ip FROM documents
  UNION ALL SELECT ip_address AS ip FROM v_abuse
  UNION ALL SELECT ip FROM v_typed_ip) t),
bare AS (SELECT ip, CASE WHEN contains(ip, '%') THEN substr(ip, 1, strpos(ip, '%') - 1) ELSE ip END AS b,
                contains(ip, '%') AS scoped, CASE WHEN contains(ip, '%') THEN substr(ip, strpos(ip, '%') + 1) END AS scope FROM cand),
part AS (SELECT *, string_split(b, ':') AS g, string_split(b, '::') AS halves, string_split(list_last(string_split(b, ':')), '.') AS o FROM bare),
flag AS (SELECT *,
  len(o) = 4 AND len(list_filter(o, lambda x: regexp_full_match(x, '0|[1-9][0-9]{{0,2}}') AND try_cast(x AS INTEGER) <= 255)) = 4 AS quad,
  list_filter(g, lambda x: x <> '') AS grp FROM part),
six AS (SELECT *, quad AND len(g) > 1 AS tail4, len(grp) + CASE WHEN quad AND len(g) > 1 THEN 1 ELSE 0 END AS n,
  len(list_filter(grp, lambda x: regexp_full_match(x, '[0-9A-Fa-f]{{1,4}}'))) + CASE WHEN quad AND len(g) > 1 THEN 1 ELSE 0 END = len(grp) AS hexed
  FROM flag),
v AS (SELECT ip, CASE WHEN NOT scoped AND len(g) = 1 AND quad THEN 'IPv4'
  WHEN len(g) > 2 AND hexed AND (NOT scoped OR (scope <> '' AND NOT contains(scope, '%')))
   AND ((len(halves) = 1 AND len(grp) = len(g) AND n = 8)
     OR (len(halves) = 2 AND n <= 7 AND len(grp) = len(g) - CASE WHEN halves[1] = '' AND halves[2] = '' THEN 3
                                                              WHEN halves[1] = '' OR halves[2] = '' THEN 2 ELSE 1 END))
  THEN 'IPv6' END AS ip_version FROM six)
"""
    o["ip_version"] = cand + "SELECT ip, ip_version FROM v"
    o["valid_ip_filter"] = cand + "SELECT ip FROM v WHERE ip_version IS NOT NULL"
    o["first_n_distinct"] = V + (
        "SELECT trim(ip_address) AS ip_address, min(pos) AS first_pos FROM v_abuse "
        "WHERE ip_address IS NOT NULL AND trim(ip_address) <> '' GROUP BY 1 ORDER BY first_pos LIMIT 100")
    o["point_lookup"] = (standin.with_clause("duckdb").rstrip()
                         + profiles_ctes("v_abuse", "pe", run_ts=PREV_RUN_TS)
                         + f"\nSELECT {PROFILE_OUT} FROM pe WHERE ip_address = '10.0.0.1'")
    names = "CASE WHEN v.pulse_text IS NULL THEN CAST([] AS VARCHAR[]) ELSE string_split(v.pulse_text, ' | ') END"
    o["pulse_responses"] = V + (
        f"SELECT {standin.ip_of('c.c_custkey')} AS ip_address, c.c_acctbal AS otx_reputation, "
        f"CAST(len({names}) AS INTEGER) AS otx_pulse_count, "
        f"array_to_string(list_filter({names}, lambda x: x IS NOT NULL AND trim(x) <> ''), ', ') AS otx_pulse_names, "
        "CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 0 ELSE CAST(c.c_custkey % 5 + 1 AS INTEGER) END "
        "AS otx_passive_dns_count, 'ok' AS otx_general_status, "
        "CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'not_found' ELSE 'ok' END AS otx_passive_dns_status, "
        f"{q(RUN_TS)} AS first_ingestion_time, {q(RUN_TS)} AS last_ingestion_time, 1 AS seen_count, "
        f"{q(RUN_TS)} AS raw_ingestion_time, {q(RUN_TS)} AS processed_at "
        f"FROM customer c LEFT JOIN v_pulse v ON v.ip_address = {standin.ip_of('c.c_custkey')}")
    o["recent_report_counts"] = V + (
        "SELECT ip_address, count(*) AS recent_reports, "
        "strftime(max(reported_ts), '%Y-%m-%dT%H:%M:%S.%fZ') AS last_report_ts FROM v_abuse "
        f"WHERE reported_ts >= TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 10 DAY GROUP BY ip_address")
    strip = lambda x: f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"  # noqa: E731  the inputs have ASCII white space only
    odd = ", ".join("NULL" if v is None else q(v) for v in ODD_VALUES)
    num = "regexp_full_match(s, '[+-]?[0-9]+(_[0-9]+)*([.][0-9]*)?([eE][+-]?[0-9]+)?')"
    o["odd_values"] = f"""
WITH v AS (SELECT c_custkey, list_value({odd})[CAST(c_custkey % {len(ODD_VALUES)} + 1 AS INT)] AS v FROM customer),
t AS (SELECT *, {strip('v')} AS s FROM v),
n AS (SELECT *, CASE WHEN {num} THEN try_cast(replace(s, '_', '') AS DOUBLE) END AS d,
             CASE WHEN starts_with(s, '[') AND json_valid(s) THEN from_json(s, '["VARCHAR"]') END AS j FROM t)
SELECT c_custkey,
       coalesce(CASE WHEN abs(d) < 2147483648 THEN CAST(trunc(d) AS INTEGER) END, 0) AS as_int,
       CASE WHEN s = '-inf' THEN '-Infinity' WHEN d IS NULL THEN NULL WHEN d = 99999999999 THEN '9.9999999999E10'
            ELSE CAST(d AS VARCHAR) END AS as_float,
       CASE WHEN lower(s) = 'yes' THEN true WHEN lower(s) = 'n' THEN false END AS as_bool,
       CASE WHEN s IS NULL OR s = '' THEN '' WHEN j IS NOT NULL
            THEN coalesce(array_to_string(list_filter(j, lambda x: x IS NOT NULL AND trim(x) <> ''), '|'), '') ELSE s END AS as_list
FROM n"""
    update = carry.replace("WHERE f.ip NOT IN (SELECT ip FROM old)", "") + (
        ", up AS (SELECT coalesce(n.ip, o.ip) AS ip, CASE WHEN n.ip IS NULL THEN o.status ELSE n.status END AS status, "
        + ", ".join(f"CASE WHEN n.ip IS NULL THEN o.{c} ELSE n.{c} END AS {c}" for c in ("country_name", "city", "latitude", "longitude"))
        + ", CASE WHEN n.ip IS NULL THEN o.first_ingestion_time ELSE coalesce(o.first_ingestion_time, n.first_ingestion_time) END "
        "AS first_ingestion_time, CASE WHEN n.ip IS NULL THEN o.seen_count WHEN o.ip IS NULL THEN n.seen_count "
        "ELSE CAST(coalesce(CAST(o.seen_count AS INT), 1) + 1 AS VARCHAR) END AS seen_count, "
        "o.ip IS NOT NULL AS was, n.ip IS NOT NULL AS now FROM old o FULL OUTER JOIN newf n ON o.ip = n.ip)\n")
    o["carry_update"] = update + "SELECT * EXCLUDE (was, now) FROM up"
    o["carry_update_counts"] = update + (
        "SELECT count(*) FILTER (WHERE now AND NOT was) AS new_count, count(*) FILTER (WHERE now AND was) AS updated_count, "
        "CAST(0 AS BIGINT) AS skipped_count, count(*) AS total_unique FROM up")
    o["store_merge_table"] = o["merge_table"]
    # The first batch goes through the document rule too: an empty city is not written.
    o["store_merge_document"] = o["merge_document"].replace(
        "FROM pe e FULL", "FROM (SELECT * REPLACE (nullif(geo_city, '') AS geo_city) FROM pe) e FULL")
    o["dual_save"] = (f"SELECT *, 'table' AS store FROM ({o['merge_table']}) a UNION ALL BY NAME "
                      f"SELECT *, 'document' AS store FROM ({o['store_merge_document']}) b")
    o["snapshot_write_read"] = V + (
        f"SELECT ip_address, country_code, abuse_confidence_score, last_reported_at, {q(RUN_TS)} AS ingestion_time, "
        f"{q(RUN_TS)} AS processed_at, '2024' AS year, '02' AS month, '01' AS day FROM v_abuse")
    o["envelope_records"] = V + (
        "SELECT pos AS doc, 0 AS pos, 'feed' AS source, ip_address FROM v_abuse WHERE pos % 4 = 0 UNION ALL "
        "SELECT a.pos, p.pos, NULL, ip_address FROM v_abuse a, (VALUES (0), (1)) p(pos) WHERE a.pos % 4 = 1")
    o["raw_snapshot"] = V + (
        f"SELECT 'feed' AS source, {q(RUN_TS)} AS ingestion_time, (SELECT count(*) FROM v_abuse) AS record_count, "
        "ip_address, last_reported_at FROM v_abuse")
    o["state_gate"] = diff + (
        "SELECT 'same' AS step, false AS changed, 0 AS new_ip_count, 0 AS changed_ip_count, 0 AS removed_ip_count "
        "UNION ALL SELECT 'next', true, count(*) FILTER (WHERE change = 'new'), count(*) FILTER (WHERE change = 'changed'), "
        "count(*) FILTER (WHERE change = 'removed') FROM d")
    from ipscope.plans import flows, snapshots, values
    for module in (flows, snapshots, values):
        o.update(module.oracle_sql(o))
    return o
