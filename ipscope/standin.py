"""Stand-in intel inputs derived from the driver's test tables.

The test tables are a TPC-H-like star schema plus ``events`` and ``documents``;
none of them is an IP feed.  The views below only reshape them into rows of the
schemas the jobs expect (abuse reports, pulse snapshot, geo snapshot, blacklist
snapshots).  They do none of the jobs' work: no dedupe, no scoring, no merge.

The SQL text is shared by Spark and DuckDB so that both engines see identical
inputs; only the timestamp formatting and list-splitting functions differ and
are filled in per dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Fixed run time used wherever a job stamps "now", so results are reproducible.
RUN_TS = "2024-02-01T00:00:00.000000Z"
PREV_CUTOFF = "2024-01-16 00:00:00"

_DIALECT = {
    "spark": {
        "iso": "date_format({x}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")",
        "split": "split({x}, ' \\\\| ')",
        "ts": "TIMESTAMP_NTZ '{x}'",
    },
    "duckdb": {
        "iso": "strftime({x}, '%Y-%m-%dT%H:%M:%S.%fZ')",
        "split": "string_split({x}, ' | ')",
        "ts": "TIMESTAMP '{x}'",
    },
}


def ip_of(key: str) -> str:
    """An IPv4 address spelled from an integer key: one for each key up to 2**32 (same text both engines)."""
    octet = lambda n: f"CAST(CAST(floor({key} / {1 << n}) AS bigint) % 256 AS string)"
    first = f"CAST((CAST(floor({key} / {1 << 24}) AS bigint) + 10) % 256 AS string)"
    return " || '.' || ".join([first, octet(16), octet(8), octet(0)])


def _f(dialect: str, name: str, x: str) -> str:
    return _DIALECT[dialect][name].format(x=x)


def views(dialect: str) -> dict[str, str]:
    """name -> SELECT text of every stand-in view, in dependency order."""
    iso = lambda x: _f(dialect, "iso", x)
    v = {}
    # One abuse report per event: reporter = user, score from the event value.
    v["v_abuse"] = f"""
SELECT e.event_id AS pos,
       {ip_of('e.user_id')} AS ip_address,
       n.n_name AS country_code,
       CAST(floor(e.value) AS int) % 101 AS abuse_confidence_score,
       {iso('e.ts')} AS last_reported_at,
       e.ts AS reported_ts, e.user_id
FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25"""
    # Pulse snapshot: one row per customer, names spelled from the market segment
    # and account balance band; null names for negative balances.
    v["v_pulse"] = f"""
SELECT {ip_of('c_custkey')} AS ip_address,
       c_acctbal AS otx_reputation,
       CAST(c_custkey % 60 AS int) AS otx_pulse_count,
       CAST(c_custkey % 25 AS int) AS otx_passive_dns_count,
       CASE WHEN c_acctbal < 0 THEN NULL
            WHEN c_mktsegment = 'AUTOMOBILE' AND c_acctbal < 3000 THEN 'SSH Brute Force | telnet probes'
            WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Phishing kit'
            WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 3000 THEN 'Mirai botnet C2'
            WHEN c_mktsegment = 'BUILDING' THEN 'zmap recon'
            WHEN c_mktsegment = 'FURNITURE' AND c_acctbal < 3000 THEN 'Trojan loader | stealer'
            WHEN c_mktsegment = 'FURNITURE' THEN 'Ransomware locker'
            WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 3000 THEN 'vulnerability list'
            WHEN c_mktsegment = 'MACHINERY' THEN 'telnet'
            ELSE 'benign list' END AS pulse_text,
       'ok' AS otx_general_status,
       'ok' AS otx_passive_dns_status
FROM customer"""
    # Geo snapshot: one row per supplier (so only part of the abuse keys have geo).
    v["v_geo"] = f"""
SELECT {ip_of('s.s_suppkey')} AS ip_address,
       r.r_name AS geo_continent_name,
       substr(n.n_name, 1, 2) AS geo_country_code2,
       n.n_name AS geo_country_name,
       'Province ' || CAST(s.s_nationkey AS string) AS geo_state_province,
       CASE WHEN s.s_acctbal < 0 THEN NULL WHEN s.s_acctbal < 2000 THEN ''
            ELSE 'City_' || CAST(CAST(floor(s.s_acctbal / 100) AS bigint) AS string) END AS geo_city,
       CAST(s.s_nationkey * 7 - 90 AS double) AS geo_latitude,
       CASE WHEN s.s_acctbal > 8000 THEN NULL ELSE CAST(s.s_nationkey * 14 - 180 AS double) END AS geo_longitude,
       n.n_regionkey = 3 AS geo_is_eu,
       'AS' || CAST(s.s_nationkey + 64500 AS string) AS geo_asn_number,
       'Org ' || s.s_name AS geo_asn_organization,
       substr(n.n_name, 1, 2) AS geo_asn_country,
       r.r_name || '/' || n.n_name AS geo_timezone_name,
       CAST(n.n_regionkey - 2 AS double) AS geo_timezone_offset,
       'ok' AS geo_status
FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey"""
    # Requested IPs as users type them: both versions, scopes, and spellings that are none.
    k = "c_custkey"
    group = f"lower(hex(CAST({k} % 65536 AS bigint)))"
    v["v_typed_ip"] = f"""
SELECT CASE CAST({k} % 12 AS int)
         WHEN 0 THEN {ip_of(k)}
         WHEN 1 THEN 'fe80::' || {group}
         WHEN 2 THEN '2001:DB8:0:0:0:0:0:' || {group}
         WHEN 3 THEN '::ffff:' || {ip_of(k)}
         WHEN 4 THEN 'fe80::1%eth' || CAST({k} AS string)
         WHEN 5 THEN '1.2.3.' || CAST({k} % 400 AS string)
         WHEN 6 THEN '01.2.3.' || CAST({k} % 200 AS string)
         WHEN 7 THEN '1::2::' || {group}
         WHEN 8 THEN '12345::' || {group}
         WHEN 9 THEN {ip_of(k)} || chr(10)
         WHEN 10 THEN '1:2:3:4:5:6:7:8:' || {group}
         ELSE 'host' || CAST({k} AS string) END AS ip
FROM customer"""
    # Blacklist snapshots as the feed publishes them: one row per listed IP, its latest
    # report as of the cutoff.  Each snapshot lists some users the other does not.
    ts = _f(dialect, "ts", PREV_CUTOFF)
    # Newest report per IP by (time, position): one aggregation with max_by on a
    # fixed-width order key — combinable map-side, no window over a hot IP.
    order = "last_reported_at || '#' || lpad(CAST(pos AS string), 20, '0')"
    latest = f"""
SELECT ip_address, country_code, abuse_confidence_score, last_reported_at, pos FROM (
  SELECT ip_address,
         max_by(country_code, {order}) AS country_code,
         max_by(abuse_confidence_score, {order}) AS abuse_confidence_score,
         max_by(last_reported_at, {order}) AS last_reported_at,
         max_by(pos, {order}) AS pos
  FROM v_abuse WHERE {{where}} GROUP BY ip_address) t"""
    v["v_prev"] = latest.format(where=f"reported_ts < {ts} AND user_id % 10 <> 7")
    v["v_curr"] = latest.format(where="user_id % 10 <> 3")
    return v


def with_clause(dialect: str, names: list[str] | None = None) -> str:
    """``WITH`` clause defining the stand-in views (all by default)."""
    vs = views(dialect)
    names = names or list(vs)
    return "WITH " + ",\n".join(f"{n} AS ({vs[n]})" for n in vs if n in names) + "\n"


_REGISTERED: dict[str, str] = {}


def register(spark: SparkSession, sf_dir: str) -> None:
    """Register the test tables and stand-in views as Spark temp views (once per dir)."""
    try:
        sid = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - remote sessions expose no SparkContext
        sid = str(id(spark))
    if _REGISTERED.get(sid) == sf_dir and spark.catalog.tableExists("v_abuse"):
        return
    for t in TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    for name, sql in views("spark").items():
        spark.sql(sql).createOrReplaceTempView(name)
    _REGISTERED[sid] = sf_dir


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register(spark, sf_dir)
    return spark.table(name)


def pulse_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed pulse rows with the names as ``array<string>``."""
    from ipscope.schemas import PULSE
    from pyspark.sql import functions as F
    df = view(spark, sf_dir, "v_pulse")
    have = set(df.columns)
    names = "CASE WHEN pulse_text IS NULL THEN CAST(array() AS ARRAY<STRING>) ELSE split(pulse_text, ' \\\\| ') END"
    cols = []
    for f in PULSE.fields:
        src = names if f.name == "otx_pulse_names" else (f.name if f.name in have else "NULL")
        cols.append(f"CAST({src} AS {f.dataType.simpleString()}) AS {f.name}")
    return df.selectExpr(*cols)


def geo_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ipscope.schemas import GEO
    from pyspark.sql import functions as F
    df = view(spark, sf_dir, "v_geo")
    have = set(df.columns)
    return df.selectExpr(*[f"CAST({f.name if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) "
                           f"AS {f.name}" for f in GEO.fields])


def abuse_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed abuse rows (stream value schema) plus ``pos`` for ordering."""
    from pyspark.sql import functions as F
    return view(spark, sf_dir, "v_abuse").select(
        "pos", "ip_address", "country_code",
        F.col("abuse_confidence_score").cast("int").alias("abuse_confidence_score"),
        "last_reported_at",
        F.lit(None).cast("string").alias("ingestion_time"),
        F.lit(None).cast("string").alias("processed_at"))


# ---------------------------------------------------------------- raw text
# The feeds land as JSON text.  These builders only spell stand-in rows as JSON
# values with the feeds' raw field names; parsing and typing is the jobs' work.

def raw_abuse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pos, value): one blacklist entry per report as a JSON object."""
    from pyspark.sql import functions as F
    v = view(spark, sf_dir, "v_abuse")
    return v.select("pos", F.to_json(F.struct(
        F.col("ip_address").alias("ipAddress"), F.col("country_code").alias("countryCode"),
        F.col("abuse_confidence_score").alias("abuseConfidenceScore"),
        F.col("last_reported_at").alias("lastReportedAt"))).alias("value"))


def raw_pulse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    v = view(spark, sf_dir, "v_pulse")
    names = F.when(F.col("pulse_text").isNotNull(), F.split("pulse_text", r" \| "))
    return v.select(F.to_json(F.struct(
        F.col("ip_address").alias("ip"), "otx_reputation",
        F.col("otx_pulse_count").alias("pulse_count"), names.alias("pulse_names"),
        F.col("otx_passive_dns_count").alias("passive_dns_count"),
        F.col("otx_general_status").alias("general_status"),
        F.col("otx_passive_dns_status").alias("passive_dns_status"))).alias("value"))


def raw_geo_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geo rows with coordinates spelled as text, as the geo API returns them."""
    from pyspark.sql import functions as F
    v = view(spark, sf_dir, "v_geo")
    return v.select(F.to_json(F.struct(
        F.col("ip_address").alias("ip"), F.col("geo_status").alias("status"),
        F.col("geo_continent_name").alias("continent_name"),
        F.col("geo_country_code2").alias("country_code2"),
        F.col("geo_country_name").alias("country_name"),
        F.col("geo_state_province").alias("state_prov"), F.col("geo_city").alias("city"),
        F.col("geo_latitude").cast("string").alias("latitude"),
        F.col("geo_longitude").cast("string").alias("longitude"),
        F.col("geo_is_eu").alias("is_eu"), F.col("geo_asn_number").alias("asn_number"),
        F.col("geo_asn_organization").alias("asn_organization"),
        F.col("geo_asn_country").alias("asn_country"),
        F.col("geo_timezone_name").alias("timezone_name"),
        F.col("geo_timezone_offset").alias("timezone_offset"))).alias("value"))


def landed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ip, kind, http_status, body, landed_at): API answers for every customer IP.

    Every call was tried before and answered 429; pulse calls once more after the
    good answer.  Geo answers fail with 429 for negative balances; pulse answers carry the
    customer's pulse names; abuse checks carry the account balance band.
    """
    from pyspark.sql import functions as F
    register(spark, sf_dir)
    base = f"""
        SELECT {ip_of('c.c_custkey')} AS ip, c.c_custkey AS k, c.c_acctbal AS bal, c.c_mktsegment AS seg,
               n.n_name AS nation, r.r_name AS region, p.pulse_text
        FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
        JOIN region r ON r.r_regionkey = n.n_regionkey
        LEFT JOIN v_pulse p ON p.ip_address = {ip_of('c.c_custkey')}
        DISTRIBUTE BY c.c_custkey"""
    # One row per customer, its four answers and their tries exploded from it; customers
    # may come in one split, far smaller than their answers.
    return spark.sql(f"""
    WITH c AS ({base}),
    a AS (SELECT ip, inline(array(
      named_struct('kind', 'geo', 'good', CASE WHEN bal < 0 THEN 429 ELSE 200 END, 'text',
           to_json(named_struct(
             'ip', ip,
             'location', named_struct('continent_name', region, 'country_code2', substr(nation, 1, 2),
                'country_name', nation, 'state_prov', seg, 'city', 'City_' || CAST(k % 40 AS STRING),
                'latitude', CAST(k * 7 % 180 - 90 AS STRING), 'longitude', CAST(k * 11 % 360 - 180 AS STRING),
                'is_eu', region = 'EUROPE'),
             'asn', named_struct('as_number', 'AS' || CAST(k % 900 + 100 AS STRING),
                'organization', 'Org ' || seg, 'country', substr(nation, 1, 2)),
             'time_zone', named_struct('name', region, 'offset', CAST(k % 24 - 12 AS DOUBLE))))),
      named_struct('kind', 'abuse_check', 'good', 200, 'text',
           to_json(named_struct('data', named_struct(
             'abuseConfidenceScore', CAST(abs(floor(bal)) % 101 AS STRING),
             'countryCode', substr(nation, 1, 2), 'countryName', nation,
             'lastReportedAt', CAST(NULL AS STRING), 'totalReports', CAST(k % 13 AS STRING))))),
      named_struct('kind', 'pulse_general', 'good', 200, 'text',
           to_json(named_struct('reputation', bal, 'pulse_info', named_struct('pulses',
             transform(coalesce(split(pulse_text, ' \\\\| '), CAST(array() AS ARRAY<STRING>)),
                       x -> named_struct('name', x)))))),
      named_struct('kind', 'passive_dns', 'good', CASE WHEN seg = 'HOUSEHOLD' THEN 404 ELSE 200 END, 'text',
           to_json(named_struct('passive_dns', transform(sequence(1, CAST(k % 5 AS INT) + 1),
             i -> named_struct('hostname', 'h' || CAST(i AS STRING) || '.example', 'address', ip))))))) FROM c),
    t AS (SELECT *, explode(CASE WHEN kind = 'pulse_general' THEN array(0, 1, 2) ELSE array(0, 1) END) AS try FROM a)
    SELECT ip, kind, CASE WHEN try = 1 THEN good ELSE 429 END AS http_status, CASE WHEN try = 1 THEN text END AS body,
           '2024-01-31T00:00:0' || CAST(try AS STRING) || 'Z' AS landed_at FROM t""")
