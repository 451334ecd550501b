"""Registered queries of the streaming jobs: bounded streams over files landed by Spark.

Reports are landed in drops by time; after each drop the stream is started on its
checkpoint, takes what is new and ends, so every query also goes through restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ipscope import standin
from ipscope.operators import analytics, quarantine
from ipscope.plans.render import render
from ipscope.session import scratch_path
from ipscope.sinks.store import ProfileStore
from ipscope.streaming.enrich_stream import country_spike_stream, parse_values, read_source, start_enrichment, write_closed_windows

RUN_TS, PREV_RUN_TS = standin.RUN_TS, "2024-01-16T00:00:00.000000Z"
#: Drops of the windowed streams: reports before each day in turn, then the rest, then the late ones.
DROP_DAYS = ("2024-01-09", "2024-01-17")
LATE_BEFORE = "2024-01-04"
DROP = (f"CASE WHEN last_reported_at < '{LATE_BEFORE}' AND pos % 10 = 3 THEN 3 WHEN last_reported_at < '{DROP_DAYS[0]}' THEN 0 "
        f"WHEN last_reported_at < '{DROP_DAYS[1]}' THEN 1 ELSE 2 END")
#: Ways in which a feed spoils a message; each makes a bad copy of the reports with that remainder of 13.
POISON = {0: "cut off", 1: "no json", 2: "null key", 3: "blank key", 4: "no number", 5: "blank", 6: "a list"}


def _run(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pos, last_reported_at, value): every report as a JSON message; odd ones with a float score."""
    v = standin.view(spark, sf_dir, "v_abuse")
    score = F.when(F.col("pos") % 2 == 1, F.concat(F.col("abuse_confidence_score").cast("string"), F.lit(".0"))).otherwise(
        F.col("abuse_confidence_score").cast("string"))
    return v.select("pos", "last_reported_at", "ip_address", "country_code", score.alias("score")).select(
        "pos", "last_reported_at", F.to_json(F.struct("ip_address", "country_code", F.col("score").alias("abuse_confidence_score"),
                                                      "last_reported_at")).alias("value"))


def poisoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pos, last_reported_at, value): spoilt copies of some reports' messages."""
    m = messages(spark, sf_dir).withColumn("way", F.col("pos") % 13).filter(F.col("way") < len(POISON))
    whole = F.from_json("value", "ip_address string, country_code string, abuse_confidence_score string, last_reported_at string")
    with_field = lambda name, x: F.to_json(F.col("r").withField(name, x), {"ignoreNullFields": "false"})
    way = F.col("way")
    spoilt = (F.when(way == 0, F.expr("substring(value, 1, length(value) - 3)"))
              .when(way == 1, F.col("r.country_code"))
              .when(way == 2, with_field("ip_address", F.lit(None).cast("string")))
              .when(way == 3, with_field("ip_address", F.lit(" \t")))
              .when(way == 4, with_field("abuse_confidence_score", F.col("r.country_code")))
              .when(way == 5, F.lit("  ")).otherwise(F.concat(F.lit("["), "value", F.lit("]"))))
    return m.withColumn("r", whole).select("pos", "last_reported_at", spoilt.alias("value"))


def _land(values: DataFrame, path: str) -> None:
    values.select("value").write.mode("append").text(path)


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and spoilt copies through one pass; both outputs read back."""
    path = scratch_path(spark, "landing")
    both = messages(spark, sf_dir).unionByName(poisoned(spark, sf_dir))
    quarantine.land(quarantine.judge_values(both), path, 0)
    fields = ["reason", "ip_address", "country_code", "abuse_confidence_score", "last_reported_at"]
    good, bad = (quarantine.landed(spark, path, o, 0).select(F.lit(o).alias("outcome"), *fields) for o in ("good", "quarantine"))
    return good.unionByName(bad)


def stream_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three drops with spoilt messages between, a restart before each, merged into two stores; both read back.

    The first two drops are of the run before the cutoff, with its geo snapshot; the last
    run has none.  The pulse snapshot is pinned, the geo snapshot is looked up per batch.
    """
    source, checkpoint, landing = (scratch_path(spark, n) for n in ("feed", "checkpoint", "landing"))
    stores = [ProfileStore(spark, scratch_path(spark, "store"), p) for p in ("table", "document")]
    both = messages(spark, sf_dir).unionByName(poisoned(spark, sf_dir))
    cut = standin.PREV_CUTOFF.replace(" ", "T")
    drops = [(f"last_reported_at < '{DROP_DAYS[0]}'", PREV_RUN_TS, True),
             (f"last_reported_at >= '{DROP_DAYS[0]}' AND last_reported_at < '{cut}'", PREV_RUN_TS, True),
             (f"last_reported_at >= '{cut}'", RUN_TS, False)]
    for rows, run_ts, has_geo in drops:
        _land(both.filter(rows), source)
        geo = (lambda: standin.geo_snapshot(spark, sf_dir)) if has_geo else (lambda: standin.geo_snapshot(spark, sf_dir).limit(0))
        _run(start_enrichment(spark, read_source(spark, "text", source), stores, standin.pulse_snapshot(spark, sf_dir), geo,
                              checkpoint, landing, {"availableNow": True}, run_ts))
    table, document = (render(s.profiles()) for s in stores)
    return table.withColumn("store", F.lit("table")).unionByName(document.withColumn("store", F.lit("document")))


def _closed_windows(spark: SparkSession, sf_dir: str, window: str, slide: str | None) -> DataFrame:
    """Windows that a stream over the four drops has closed; the last drop lies far behind the watermark."""
    source, checkpoint, out = (scratch_path(spark, n) for n in ("feed", "checkpoint", "windows"))
    m = messages(spark, sf_dir).withColumn("drop", F.expr(DROP))
    for drop in range(4):
        _land(m.filter(F.col("drop") == drop), source)
        counts = country_spike_stream(parse_values(read_source(spark, "text", source)), window=window, slide=slide)
        _run(write_closed_windows(counts, out, checkpoint, {"availableNow": True}))
    return spark.read.schema("start timestamp, end timestamp, country_code string, reports long").parquet(out)


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding windows of six hours every two, per country."""
    return render(_closed_windows(spark, sf_dir, "6 hours", "2 hours"))


def stream_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spike rule over the hours that the stream has counted and closed."""
    hours = _closed_windows(spark, sf_dir, "1 hour", None)
    return render(analytics.spikes_of_counts(hours.select(F.col("country_code").alias("country"), F.col("start").alias("hour"), "reports")))


QUERIES = {"quarantine_rows": quarantine_rows, "stream_saved": stream_saved, "stream_windows": stream_windows,
           "stream_spikes": stream_spikes}


# ------------------------------------------------------------------ DuckDB
def _closed_sql(hours: int, every: int) -> str:
    """CTEs up to ``closed``: per window and country the reports that came before the watermark had passed it."""
    return standin.with_clause("duckdb").rstrip() + f""",
m AS (SELECT *, {DROP} AS drop FROM v_abuse),
mark AS (SELECT d.drop, (SELECT max(reported_ts) FROM m WHERE m.drop < d.drop) - INTERVAL 1 HOUR AS mark
         FROM (SELECT DISTINCT drop FROM m) d),
win AS (SELECT m.drop, country_code, date_trunc('hour', reported_ts) - INTERVAL 1 HOUR * (hour(reported_ts) % {every})
             - INTERVAL 1 HOUR * {every} * k AS start FROM m, (SELECT unnest(range({hours // every})) AS k)),
ended AS (SELECT win.*, start + INTERVAL {hours} HOUR AS stop FROM win),
closed AS (SELECT start, stop, country_code, count(*) AS reports FROM ended JOIN mark USING (drop)
           WHERE (mark IS NULL OR stop > mark) AND stop <= (SELECT max(reported_ts) - INTERVAL 1 HOUR FROM m) GROUP BY ALL)
"""


def oracle_sql(base: dict[str, str]) -> dict[str, str]:
    iso = "strftime({}, '%Y-%m-%dT%H:%M:%S.%fZ')"
    spikes = base["country_spikes"]
    reports = "ip_address, country_code, abuse_confidence_score, last_reported_at"
    bad = {0: "'not_json', NULL, NULL, NULL, NULL", 1: "'not_json', NULL, NULL, NULL, NULL", 2: "'null_key', NULL, " + reports.split(", ", 1)[1],
           3: "'blank_key', '', " + reports.split(", ", 1)[1], 4: "'wrong_type', ip_address, country_code, NULL, last_reported_at",
           5: "'not_json', NULL, NULL, NULL, NULL", 6: "'not_json', NULL, NULL, NULL, NULL"}
    return {
        "quarantine_rows": standin.with_clause("duckdb") + f"SELECT 'good' AS outcome, CAST(NULL AS VARCHAR) AS reason, {reports} FROM v_abuse "
                           + " ".join(f"UNION ALL SELECT 'quarantine', {v} FROM v_abuse WHERE pos % 13 = {k}" for k, v in bad.items()),
        "stream_saved": base["dual_save"],
        "stream_windows": _closed_sql(6, 2) + f"SELECT {iso.format('start')} AS start, {iso.format('stop')} AS \"end\", country_code, reports FROM closed",
        "stream_spikes": _closed_sql(1, 1).rstrip() + ",\nh AS (SELECT country_code AS country, start AS hour, reports FROM closed),\n"
                         + spikes[spikes.index("w AS (SELECT *, CAST(coalesce(sum(reports)"):],
    }
