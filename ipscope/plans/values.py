"""Registered queries of value rules: nested records, odd spellings, statuses, lexicons, merges of blank values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ipscope import schemas as S
from ipscope import standin
from ipscope.functions.casts import normalize_string_array, safe_bool, safe_float, safe_int, safe_string
from ipscope.functions.nested import plain_records
from ipscope.functions.scoring import matched_categories
from ipscope.operators import lexicon, merge, normalize
from ipscope.operators.enrich import enrich_and_score
from ipscope.operators.parallel import for_few_files
from ipscope.plans.render import render
from ipscope.sources.responses import parse_pulses

RUN_TS, PREV_RUN_TS = standin.RUN_TS, "2024-01-16T00:00:00.000000Z"


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------- H6, P15, H4
def nested_records(spark, sf_dir) -> DataFrame:
    """A record per event: its reading (NaN for some) and the order of the same number, in structs, lists and a map."""
    nan = F.lit(float("nan"))
    reading = F.when(F.col("event_id") % 5 == 0, nan).otherwise(F.col("value"))
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    e = _table(spark, sf_dir, "events").join(orders, F.col("event_id") == F.col("o_orderkey"), "left")
    whole_second = F.date_trunc("second", "ts").cast("timestamp_ntz")
    return e.select(
        "event_id", F.when(F.col("event_id") % 2 == 0, whole_second).otherwise(F.col("ts")).alias("seen"),
        F.when(F.col("event_id") % 7 != 0, F.struct(
            reading.alias("reading"), F.array(F.col("value"), nan, F.lit(None).cast("double")).alias("history"),
            F.struct(F.col("o_orderdate").cast("timestamp_ntz").alias("at"), F.col("o_totalprice").alias("price")).alias("order"))).alias("body"),
        F.create_map(F.col("event_type"), F.array(F.struct(F.col("ts").alias("at"), reading.alias("v")))).alias("marks"),
        F.col("ts").cast("date").alias("day"))


def nested_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6: plain values at every depth, then the leaves of each record."""
    p = plain_records(nested_records(spark, sf_dir))
    mark = F.map_values("marks")[0][0]
    return p.select("event_id", "seen", F.col("body").isNull().alias("bodiless"), F.col("body.reading").alias("reading"),
                    F.size("body.history").alias("n_history"), F.col("body.history")[0].alias("first"), F.col("body.history")[1].alias("second"),
                    F.col("body.order.at").alias("ordered_at"), F.col("body.order.price").alias("price"),
                    F.map_keys("marks")[0].alias("mark"), mark["at"].alias("mark_at"), mark["v"].alias("mark_v"), "day")


def typed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A processed pulse table whose every column came back as text or as a wider type, typed again.

    Names are text here: blank, a JSON list or one name; counts are floats, some NaN.
    """
    v = standin.view(spark, sf_dir, "v_pulse")
    names = (F.when(F.col("pulse_text").isNull(), F.lit("  ")).when(F.col("pulse_text").contains("|"), F.to_json(F.split("pulse_text", r" \| ")))
             .otherwise(F.concat(F.lit(" "), "pulse_text", F.lit("\t"))))
    loose = v.select("ip_address", F.col("otx_reputation").cast("string").alias("otx_reputation"),
                     F.when(F.col("otx_pulse_count") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("otx_pulse_count") + F.lit(0.75)).alias("otx_pulse_count"),
                     names.alias("otx_pulse_names"), F.concat(F.lit(" "), F.col("otx_passive_dns_count").cast("string"), F.lit(".0")).alias("otx_passive_dns_count"),
                     F.col("otx_pulse_count").alias("otx_general_status"), F.lit("").alias("otx_passive_dns_status"))
    return render(normalize.normalize_typed(loose, S.PULSE)).select(
        "ip_address", "otx_reputation", "otx_pulse_count", "otx_pulse_names", "otx_passive_dns_count", "otx_general_status", "otx_passive_dns_status")


# ------------------------------------------------------------- H1-H5, F8 from columns
def spelt_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1-H5/F8: numbers, flags and lists as odd texts, each made from the customer's own columns."""
    c = standin.view(spark, sf_dir, "customer")
    n, bal, seg, name = F.col("c_custkey").cast("string"), F.col("c_acctbal").cast("string"), F.col("c_mktsegment"), F.col("c_name")
    way = F.col("c_custkey") % 10
    text = (F.when(way == 0, F.concat(F.lit(" "), bal, F.lit("\t"))).when(way == 1, F.concat(n, F.lit("e1"))).when(way == 2, F.concat(n, F.lit("d")))
            .when(way == 3, F.concat(F.lit("1_"), F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"))).when(way == 4, F.to_json(F.array(seg, F.lit(" "), name)))
            .when(way == 5, F.concat(F.lit("["), seg)).when(way == 6, F.when(F.col("c_acctbal") < 5000, " YES\n").otherwise("n"))
            .when(way == 7, F.lit("   ")).when(way == 8, F.concat(n, F.lit("00000000000"))).otherwise(F.concat(F.lit("  "), seg)))
    v = c.select("c_custkey", text.alias("v"), F.array(F.lit(""), seg, F.lit(None).cast("string"), F.lit("\t"), name).alias("a"))
    return v.select("c_custkey", safe_int("v", -1).alias("as_int"), F.round(safe_float("v"), 4).alias("as_float"), safe_bool("v").alias("as_bool"),
                    F.array_join(normalize_string_array("v"), "|").alias("as_list"), safe_string("v", "none").alias("as_text"),
                    F.array_join(normalize_string_array("a", v.schema["a"].dataType), "|").alias("kept"))


# ------------------------------------------------------------- P9
def pulse_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every status word; calls that failed, were refused, got no status, or were never landed, and keys that are no IP."""
    c = standin.view(spark, sf_dir, "customer").select("c_custkey", F.expr(standin.ip_of("c_custkey")).alias("good"))
    ip = F.when(F.col("c_custkey") % 11 == 0, F.concat(F.lit("host"), F.col("c_custkey").cast("string"))).otherwise(F.col("good"))
    code = F.element_at(F.array(*[F.lit(x).cast("int") for x in (200, 404, 429, 500, None, 301)]), (F.col("c_custkey") % 6 + 1).cast("int"))
    general = c.select(ip.alias("ip"), F.lit("pulse_general").alias("kind"), code.alias("http_status"),
                       F.to_json(F.struct(F.col("c_custkey").cast("double").alias("reputation"))).alias("body"))
    dns = c.filter("c_custkey % 4 <> 0").select(ip.alias("ip"), F.lit("passive_dns").alias("kind"), F.lit(200).alias("http_status"), F.lit("{}").alias("body"))
    return parse_pulses(general.unionByName(dns), RUN_TS).select("ip", "otx_reputation", "general_status", "passive_dns_status")


# ------------------------------------------------------------- J10
def lexicon_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attack lexicon as a table, joined through the substring index; same answer as ``document_keywords``."""
    terms = spark.createDataFrame([(k,) for ks in S.ATTACK_KEYWORDS.values() for k in ks], "term string")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = lexicon.match_lexicon(docs, terms, partitions=for_few_files(docs))
    return render(found.select("doc_id", F.col("terms").alias("attack_keywords_matched"), matched_categories("terms").alias("attack_categories")))


def _words(spark, sf_dir):
    """Words of the benchmark passages, some joined to the next: a lexicon that grows with the table."""
    words = F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda w: w != "")
    b = _table(spark, sf_dir, "benchmark").select(words.alias("w")).select("w", F.posexplode("w").alias("i", "word"))
    pair = F.when(F.col("i") % 5 == 0, F.concat_ws(" ", "word", F.get("w", F.col("i") + 1)))
    return b.select(F.coalesce(pair, "word").alias("term")).filter("length(term) >= 3")


def lexicon_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lexicon of the benchmark's words in all documents, as substrings and between word boundaries."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    m = lexicon.match_rules(docs, _words(spark, sf_dir), partitions=for_few_files(docs))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("terms")) for r in ("anywhere", "whole")])
    return m.select("doc_id", F.inline(rules)).select(
        "doc_id", "rule", F.size("terms").cast("long").alias("n_terms"), F.md5(F.array_join("terms", ",")).alias("terms_md5"))


# ------------------------------------------------------------- J3, F7, Q6
def _merge_sides(spark, sf_dir, preserve_missing=False):
    cut = F.col("last_reported_at") < F.lit(standin.PREV_CUTOFF.replace(" ", "T"))
    reports, pulses, geo = standin.abuse_reports(spark, sf_dir), standin.pulse_snapshot(spark, sf_dir), standin.geo_snapshot(spark, sf_dir)
    return reports.filter(cut), reports.filter(~cut), pulses, geo


def merge_blank_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incoming geo snapshot has '' where the stored one has values, and values where that has ''."""
    early, late, pulses, geo = _merge_sides(spark, sf_dir)
    blank = geo.withColumn("geo_city", F.when(F.col("geo_city") == "", F.lit("Found")).otherwise(F.lit(""))).withColumn(
        "geo_country_name", F.when(F.col("geo_is_eu"), F.col("geo_country_name")).otherwise(F.lit("")))
    e = enrich_and_score(early, pulses, geo, run_ts=PREV_RUN_TS)
    i = enrich_and_score(late, pulses, blank, run_ts=RUN_TS)
    return merge.merge_profiles(e, i, "document", RUN_TS).select("ip_address", "geo_city", "geo_country_name", "geo_asn_number", "risk_score")


def merge_preserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: the incoming run has no pulse snapshot; with ``preserve_missing`` the stored pulse values stay."""
    early, late, pulses, geo = _merge_sides(spark, sf_dir)
    e = enrich_and_score(early, pulses, geo, run_ts=PREV_RUN_TS)
    out = None
    for name, keep in (("filled", False), ("kept", True)):
        i = enrich_and_score(late, pulses.limit(0), geo, run_ts=RUN_TS, preserve_missing=keep)
        m = merge.merge_profiles(e, i, "table").select(F.lit(name).alias("rule"), "ip_address", "otx_reputation", "otx_pulse_count", "otx_passive_dns_count")
        out = m if out is None else out.unionByName(m)
    return out


QUERIES = {"nested_values": nested_values, "typed_records": typed_records, "spelt_values": spelt_values, "pulse_statuses": pulse_statuses,
           "lexicon_keywords": lexicon_keywords, "lexicon_terms": lexicon_terms, "merge_blank_geo": merge_blank_geo,
           "merge_preserved": merge_preserved}


# ------------------------------------------------------------------ DuckDB
def oracle_sql(base: dict[str, str]) -> dict[str, str]:
    views = standin.with_clause("duckdb")
    iso = lambda t: f"(strftime({t}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({t}) % 1000000 = 0 THEN '' ELSE strftime({t}, '.%f') END)"
    seen = "CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts) ELSE ts END"
    reading = "CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END"
    body = lambda x: f"CASE WHEN event_id % 7 <> 0 THEN {x} END"
    names = "CASE WHEN pulse_text IS NULL THEN '' ELSE replace(pulse_text, ' | ', ', ') END"
    lpad = "'1' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0')"
    n = "CAST(c_custkey AS VARCHAR)"
    status = lambda code: f"CASE {code} WHEN 0 THEN 'ok' WHEN 1 THEN 'not_found' WHEN 2 THEN 'rate_limited' ELSE 'request_failed' END"
    word = "list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda w: w <> '')"
    terms = f"""
WITH b AS (SELECT {word} AS w FROM benchmark),
p AS (SELECT w, unnest(range(len(w))) AS i FROM b),
lex AS (SELECT DISTINCT CASE WHEN i % 5 = 0 THEN concat_ws(' ', w[i + 1], w[i + 2]) ELSE w[i + 1] END AS term FROM p),
t AS (SELECT term FROM lex WHERE length(term) >= 3),
d AS (SELECT doc_id, lower(coalesce(text, '')) AS x FROM documents),
hit AS (SELECT doc_id, term, regexp_matches(x, '(^|[^a-z0-9_])' || term || '([^a-z0-9_]|$)') AS whole FROM d JOIN t ON contains(x, term))
"""
    pick = lambda name, cond: (f"SELECT d.doc_id, '{name}' AS rule, count(term) AS n_terms, md5(coalesce(string_agg(term, ',' ORDER BY term), '')) AS terms_md5 "  # noqa: E731
                               f"FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id AND {cond} GROUP BY d.doc_id")
    from ipscope.plans.oracles import CUT, profiles_ctes
    early, late = f"(SELECT * FROM v_abuse WHERE last_reported_at < '{CUT}')", f"(SELECT * FROM v_abuse WHERE NOT (last_reported_at < '{CUT}'))"
    blank = ("(SELECT * REPLACE (CASE WHEN geo_city = '' THEN 'Found' ELSE '' END AS geo_city, "
             "CASE WHEN geo_is_eu THEN geo_country_name ELSE '' END AS geo_country_name) FROM v_geo)")
    doc = base["merge_document"]
    start = doc.index("md AS (")
    blank_sides = views.rstrip() + profiles_ctes(early, "pe", run_ts=PREV_RUN_TS) + profiles_ctes(late, "pi", run_ts=RUN_TS, geo=blank) + ",\n"
    filled = lambda c, z: f"CASE WHEN i.ip_address IS NULL THEN e.{c} ELSE {z} END AS {c}"
    pulse = ("otx_reputation", "otx_pulse_count", "otx_passive_dns_count")
    early_late = views.rstrip() + profiles_ctes(early, "pe", run_ts=PREV_RUN_TS) + profiles_ctes(late, "pi", run_ts=RUN_TS) + "\n"
    side = "FROM pe e FULL OUTER JOIN pi i ON e.ip_address = i.ip_address"
    return {
        "nested_values": f"""
SELECT event_id, {iso(seen)} AS seen, event_id % 7 = 0 AS bodiless, {body(reading)} AS reading,
       CAST({body('3')} AS INTEGER) AS n_history, {body('value')} AS "first", CAST(NULL AS DOUBLE) AS "second",
       {body(iso('o_orderdate'))} AS ordered_at, {body('o_totalprice')} AS price, event_type AS mark, {iso('ts')} AS mark_at,
       {reading} AS mark_v, strftime(ts, '%Y-%m-%d') AS day
FROM events LEFT JOIN orders ON o_orderkey = event_id""",
        "typed_records": views + f"""SELECT ip_address, otx_reputation, CASE WHEN otx_pulse_count % 4 <> 0 THEN otx_pulse_count END AS otx_pulse_count,
       {names} AS otx_pulse_names, otx_passive_dns_count, CAST(otx_pulse_count AS VARCHAR) AS otx_general_status, '' AS otx_passive_dns_status FROM v_pulse""",
        "spelt_values": f"""
WITH x AS (SELECT *, c_custkey % 10 AS way, c_mktsegment AS seg,
  CASE c_custkey % 10 WHEN 0 THEN c_acctbal WHEN 1 THEN c_custkey * 10.0 WHEN 3 THEN CAST({lpad} AS DOUBLE) WHEN 8 THEN c_custkey * 100000000000.0 END::DOUBLE AS d
  FROM customer)
SELECT c_custkey, CASE WHEN d IS NULL OR abs(d) >= 2147483648 THEN -1 ELSE CAST(trunc(d) AS INTEGER) END AS as_int, round(d, 4) AS as_float,
  CASE WHEN way = 6 THEN c_acctbal < 5000 END AS as_bool,
  CASE way WHEN 0 THEN t WHEN 1 THEN {n} || 'e1' WHEN 2 THEN {n} || 'd' WHEN 3 THEN '1_' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0')
    WHEN 4 THEN seg || '|' || c_name WHEN 5 THEN '[' || seg WHEN 6 THEN CASE WHEN c_acctbal < 5000 THEN 'YES' ELSE 'n' END WHEN 7 THEN ''
    WHEN 8 THEN {n} || '00000000000' ELSE seg END AS as_list,
  CASE way WHEN 0 THEN ' ' || t || chr(9) WHEN 1 THEN {n} || 'e1' WHEN 2 THEN {n} || 'd' WHEN 3 THEN '1_' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0')
    WHEN 4 THEN '["' || seg || '"," ","' || c_name || '"]' WHEN 5 THEN '[' || seg WHEN 6 THEN CASE WHEN c_acctbal < 5000 THEN ' YES' || chr(10) ELSE 'n' END
    WHEN 7 THEN '   ' WHEN 8 THEN {n} || '00000000000' ELSE '  ' || seg END AS as_text,
  seg || '|' || c_name AS kept
FROM (SELECT *, CAST(c_acctbal AS VARCHAR) AS t FROM x) y""",
        "pulse_statuses": f"""
WITH c AS (SELECT c_custkey, c_custkey % 11 = 0 AS bad, CASE WHEN c_custkey % 11 = 0 THEN 'host' || {n} ELSE {standin.ip_of('c_custkey')} END AS ip FROM customer)
SELECT ip, CASE WHEN NOT bad AND c_custkey % 6 = 0 THEN CAST(CAST(c_custkey AS DOUBLE) AS VARCHAR) END AS otx_reputation,
       CASE WHEN bad THEN 'invalid_ip' ELSE {status('c_custkey % 6')} END AS general_status,
       CASE WHEN bad THEN 'invalid_ip' WHEN c_custkey % 4 = 0 THEN 'unknown_error' ELSE 'ok' END AS passive_dns_status FROM c""",
        "lexicon_keywords": base["document_keywords"].replace("lower(text)", "lower(coalesce(text, ''))"),
        "lexicon_terms": terms + pick("anywhere", "true") + " UNION ALL " + pick("whole", "whole"),
        "merge_blank_geo": "SELECT ip_address, geo_city, geo_country_name, geo_asn_number, risk_score FROM (" + blank_sides + doc[start:] + ") m",
        "merge_preserved": early_late
                           + "SELECT 'filled' AS rule, coalesce(i.ip_address, e.ip_address) AS ip_address, "
                           + ", ".join(filled(c, "0") for c in pulse) + f" {side} UNION ALL SELECT 'kept', coalesce(i.ip_address, e.ip_address), "
                           + ", ".join(f"e.{c}" for c in pulse) + f" {side}",
    }
