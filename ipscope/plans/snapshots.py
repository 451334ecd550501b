"""Registered queries of change control, snapshot files, versions and ordered tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ipscope import standin
from ipscope.operators import asof, changes, normalize
from ipscope.plans.render import render
from ipscope.session import scratch_path
from ipscope.sinks import ordered
from ipscope.sinks.state import SnapshotGate
from ipscope.sinks.store import ProfileStore, write_snapshot
from ipscope.sources.snapshots import newest_run, read_newest, read_run

RUN_TS, PREV_RUN_TS = standin.RUN_TS, "2024-01-16T00:00:00.000000Z"


def _raw_state(spark, sf_dir, name):
    """A snapshot as the feed spells it, with entries that have a null or blank IP."""
    v = standin.view(spark, sf_dir, name)
    ip = F.when(F.col("pos") % 11 == 0, F.lit(None)).when(F.col("pos") % 11 == 1, F.lit("")).otherwise(F.col("ip_address"))
    spelt = lambda ip: v.select("pos", ip.alias("ipAddress"), F.col("country_code").alias("countryCode"),
                                F.col("abuse_confidence_score").cast("string").alias("abuseConfidenceScore"),
                                F.col("last_reported_at").alias("lastReportedAt"))
    return spelt(F.col("ip_address")).unionByName(spelt(ip).filter("ipAddress IS NULL OR ipAddress = ''"))


def tree_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The diff read through the committed digest tree, blank IPs dropped on the way in."""
    gate = SnapshotGate(spark, scratch_path(spark, "state"), buckets=32)
    gate.commit(normalize.normalize_state(_raw_state(spark, sf_dir, "v_prev")), "first", PREV_RUN_TS)
    return gate.diff(normalize.normalize_state(_raw_state(spark, sf_dir, "v_curr")))


def ordered_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current snapshot written in global order; each IP's place as the files have it."""
    path = scratch_path(spark, "ordered")
    ordered.write_ordered(standin.view(spark, sf_dir, "v_curr").select(*changes.STATE_COLUMNS), path, "ip_address", 8)
    return ordered.positions(spark, path, "ip_address").select("ip_address", "position")


def newest_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of three feeds under one root; the newest of each feed, with its run from the file's path."""
    root = scratch_path(spark, "feeds")
    raw = standin.view(spark, sf_dir, "v_abuse").select(F.col("ip_address").alias("ip"), "pos")
    feeds = {"abuse": raw, "pulse": standin.view(spark, sf_dir, "v_pulse").select(F.col("ip_address").alias("ip"), F.lit(0).cast("long").alias("pos")),
             "geo": standin.view(spark, sf_dir, "v_geo").select(F.col("ip_address").alias("ip"), F.lit(0).cast("long").alias("pos"))}
    for name, df in feeds.items():
        df.limit(1).write.json(f"{root}/{name}/run=1")
        df.write.json(f"{root}/{name}/run=2")
    feeds["geo"].filter("ip IS NULL").write.json(f"{root}/geo/run=3")  # a run without a file of rows is no snapshot
    got = read_newest(spark, root, StructType.fromDDL("ip string, pos long"), ".json", unit="folder")
    return got.select("prefix", "ip", "pos", F.regexp_extract("source_file", "/run=([0-9]+)/", 1).alias("run"),
                      F.col("source_modified").isNotNull().alias("dated"))


VERSION_DAYS = ("2024-01-05", "2024-01-15", "2024-01-25")
PINNED_AT = "2024-01-20"


def _pulse_versions(spark, sf_dir):
    """Pulse snapshots of three days; the second leaves some IPs out, counts go up by version."""
    v = standin.view(spark, sf_dir, "v_pulse")
    out = None
    for i, day in enumerate(VERSION_DAYS):
        part = v.filter("otx_pulse_count % 3 <> 0" if i == 1 else "true").select(
            "ip_address", (F.col("otx_pulse_count") + i).alias("pulses"), F.lit(day).cast("timestamp_ntz").alias("version_ts"))
        out = part if out is None else out.unionByName(part)
    return out


def asof_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every report with the pulse count pinned at one time, and with the one in force at its own time."""
    reports = standin.view(spark, sf_dir, "v_abuse").select("pos", "ip_address", "reported_ts")
    versions = _pulse_versions(spark, sf_dir)
    fixed = asof.pinned(reports, versions, F.lit(PINNED_AT).cast("timestamp_ntz"))
    moving = asof.asof_versions(reports, versions, "reported_ts")
    return render(fixed.select("pos", "ip_address", F.lit("pinned").alias("flag"), "pulses", "version_ts").unionByName(
        moving.select("pos", "ip_address", F.lit("newest").alias("flag"), "pulses", "version_ts")))


def observed_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The carried snapshot written once; its counters come from that write, its rows are counted again on reading."""
    from ipscope.plans.catalog import carry_inputs
    root = scratch_path(spark, "geo")
    rows = changes.carry_changes(*carry_inputs(spark, sf_dir))
    got = write_snapshot(rows, root, RUN_TS, counters=changes.carry_counters(), required=True, drop=("_run_change",))
    back = read_run(spark, root, newest_run(spark, root), rows.drop("_run_change").schema)
    return back.agg(F.count(F.lit(1)).alias("rows_read")).select(
        *[F.lit(v).cast("long").alias(k) for k, v in got.items()], "rows_read")


def carry_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12: rows whose stored status is an error are fetched again."""
    from ipscope.plans.catalog import CARRY_COLUMNS, carry_inputs
    old, cands, fresh = carry_inputs(spark, sf_dir)
    failed = old.withColumn("status", F.when(F.col("city") == "", F.lit("HTTPError: 429 Too Many Requests")).otherwise(F.col("status")))
    return changes.carry_forward(failed, cands, fresh, retry_errors=True)[0].select(*CARRY_COLUMNS)


def store_rows_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of a third of the customers, read by key from a store of two batches."""
    from ipscope.plans.catalog import merge_inputs
    store = ProfileStore(spark, scratch_path(spark, "store"), "table")
    for n, (batch, ts) in enumerate(zip(merge_inputs(spark, sf_dir), (PREV_RUN_TS, RUN_TS))):
        store.merge(batch, n, ts)
    keys = standin.view(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select(F.expr(standin.ip_of("c_custkey")).alias("ip_address"))
    return render(store.rows_for(keys))


QUERIES = {"tree_diff": tree_diff, "ordered_state": ordered_state, "newest_snapshots": newest_snapshots, "asof_reports": asof_reports,
           "observed_carry": observed_carry, "carry_retry": carry_retry, "store_rows_for": store_rows_for}


# ------------------------------------------------------------------ DuckDB
def oracle_sql(base: dict[str, str]) -> dict[str, str]:
    views = standin.with_clause("duckdb")
    carry = base["carry_forward"][:base["carry_forward"].index("SELECT * FROM old UNION")]
    counts = base["carry_forward_counts"]
    versions = " UNION ALL ".join(
        f"SELECT ip_address, otx_pulse_count + {i} AS pulses, TIMESTAMP '{day}' AS version_ts FROM v_pulse" + (" WHERE otx_pulse_count % 3 <> 0" if i == 1 else "")
        for i, day in enumerate(VERSION_DAYS))
    iso = "strftime(version_ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS version_ts"
    error = "'HTTPError: 429 Too Many Requests'"
    retry = carry.replace("old AS (SELECT ip_address AS ip, geo_status AS status",
                          f"old AS (SELECT ip_address AS ip, CASE WHEN geo_city = '' THEN {error} ELSE geo_status END AS status").replace(
        "WHERE f.ip NOT IN (SELECT ip FROM old)", "WHERE f.ip NOT IN (SELECT ip FROM old WHERE status = 'ok')")
    fields = ("status", "country_name", "city", "latitude", "longitude")
    return {
        "tree_diff": base["diff_new"].rsplit("SELECT ip_address FROM d", 1)[0] + "SELECT ip_address, change FROM d WHERE change <> 'same'",
        "ordered_state": views + "SELECT ip_address, row_number() OVER (ORDER BY ip_address) - 1 AS position FROM v_curr",
        "newest_snapshots": views + "SELECT 'abuse' AS prefix, ip_address AS ip, pos, '2' AS run, true AS dated FROM v_abuse UNION ALL "
                            "SELECT 'pulse', ip_address, 0, '2', true FROM v_pulse UNION ALL SELECT 'geo', ip_address, 0, '2', true FROM v_geo",
        "asof_reports": views.rstrip() + f""",
ver AS ({versions}),
pin AS (SELECT * FROM ver WHERE version_ts <= TIMESTAMP '{PINNED_AT}' QUALIFY row_number() OVER (PARTITION BY ip_address ORDER BY version_ts DESC) = 1)
SELECT pos, a.ip_address, 'pinned' AS flag, pulses, {iso} FROM v_abuse a LEFT JOIN pin ON pin.ip_address = a.ip_address
UNION ALL SELECT pos, a.ip_address, 'newest', pulses, {iso} FROM v_abuse a
ASOF LEFT JOIN ver ON ver.ip_address = a.ip_address AND a.reported_ts >= ver.version_ts""",
        "observed_carry": f"SELECT *, total_unique AS record_count, total_unique AS rows_read FROM ({counts}) c",
        "carry_retry": retry + "SELECT coalesce(n.ip, o.ip) AS ip, "
                       + ", ".join(f"CASE WHEN n.ip IS NULL THEN o.{c} ELSE n.{c} END AS {c}" for c in fields)
                       + ", CASE WHEN n.ip IS NULL THEN o.first_ingestion_time ELSE coalesce(o.first_ingestion_time, n.first_ingestion_time) END "
                         "AS first_ingestion_time, CASE WHEN n.ip IS NULL THEN o.seen_count WHEN o.ip IS NULL THEN n.seen_count "
                         "ELSE CAST(coalesce(CAST(o.seen_count AS INT), 1) + 1 AS VARCHAR) END AS seen_count "
                         "FROM old o FULL OUTER JOIN newf n ON o.ip = n.ip",
        "store_rows_for": f"SELECT * FROM ({base['merge_table']}) m WHERE ip_address IN (SELECT {standin.ip_of('c_custkey')} FROM customer WHERE c_custkey % 3 = 0)",
    }
