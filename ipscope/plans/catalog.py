"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Inputs are the driver's test tables reshaped by ``ipscope.standin``; the work is
done by the library operators.  Outputs are rendered (arrays joined, timestamps
as ISO text) so they can be compared with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ipscope import schemas as S
from ipscope import standin
from ipscope.functions.casts import normalize_string_array, safe_bool, safe_float, safe_int
from ipscope.functions.scoring import classify
from ipscope.operators import analytics, changes, dedupe, lookup, merge, normalize, textscan
from ipscope.operators.enrich import enrich_and_score, geo_point
from ipscope.operators.parallel import for_few_files
from ipscope.plans.render import render
from ipscope.sources.responses import parse_geo

RUN_TS = standin.RUN_TS


def profiles(spark: SparkSession, sf_dir: str, reports: str = "v_abuse") -> DataFrame:
    """Scored profile rows (PROFILE schema) for the stand-in report stream."""
    rep = standin.abuse_reports(spark, sf_dir) if reports == "v_abuse" else standin.view(spark, sf_dir, reports)
    return enrich_and_score(rep, standin.pulse_snapshot(spark, sf_dir),
                            standin.geo_snapshot(spark, sf_dir), run_ts=RUN_TS)


def q_left_enrich(spark, sf_dir):
    return render(profiles(spark, sf_dir))


def q_risk_score(spark, sf_dir):
    return profiles(spark, sf_dir).select("ip_address", "risk_score", "status")


def q_status_counts(spark, sf_dir):
    return analytics.status_counts(profiles(spark, sf_dir))


def q_country_counts(spark, sf_dir):
    return analytics.country_counts(profiles(spark, sf_dir))


def q_high_risk_ips(spark, sf_dir):
    return analytics.high_risk(profiles(spark, sf_dir)).select(
        "ip_address", "risk_score", "abuse_country_code")


def q_score_histogram(spark, sf_dir):
    return analytics.score_histogram(profiles(spark, sf_dir))


def q_abuse_by_status(spark, sf_dir):
    return analytics.abuse_by_status(profiles(spark, sf_dir))


# ------------------------------------------------------------- normalise
def _parse(text_df, schema):
    return text_df.select(*[c for c in text_df.columns if c != "value"],
                          F.from_json("value", schema).alias("r")).select(
        *[c for c in text_df.columns if c != "value"], "r.*")


def raw_abuse(spark, sf_dir):
    return _parse(standin.raw_abuse_json(spark, sf_dir), S.RAW_ABUSE_RECORD)


def q_normalize_abuse(spark, sf_dir):
    return normalize.normalize_abuse(raw_abuse(spark, sf_dir), RUN_TS, RUN_TS)


def q_normalize_pulses(spark, sf_dir):
    raw = _parse(standin.raw_pulse_json(spark, sf_dir), S.RAW_PULSE_RECORD)
    return render(normalize.normalize_pulses(raw, RUN_TS, RUN_TS))


def q_normalize_geo(spark, sf_dir):
    raw = _parse(standin.raw_geo_json(spark, sf_dir), S.RAW_GEO_RECORD)
    return normalize.normalize_geo(raw, RUN_TS, RUN_TS)


def q_safe_casts(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "props", F.col("value").cast("string").alias("v"),
        F.get_json_object("props", "$.k").alias("k"))
    return ev.select(
        "event_id",
        safe_int("v", 0).alias("int_value"), safe_float("v").alias("float_value"),
        safe_int("k", 0).alias("k_int"), safe_bool("k").alias("k_bool"),
        safe_int("props", 0).alias("props_int"),
        F.array_join(normalize_string_array("props"), ", ").alias("props_array"))


# ------------------------------------------------------------- text scans
def q_document_keywords(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return render(textscan.classify_text(docs, partitions=for_few_files(docs)).drop("text"))


def q_document_ips(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return textscan.ip_token_counts(docs, partitions=for_few_files(docs))


def q_attack_classify(spark, sf_dir):
    p = standin.pulse_snapshot(spark, sf_dir)
    cats, kws = classify("otx_pulse_names")
    return render(p.select("ip_address", cats.alias("attack_categories"),
                           kws.alias("attack_keywords_matched")))


# ------------------------------------------------------------- dedupe / top-n
def _reports(spark, sf_dir):
    return standin.abuse_reports(spark, sf_dir).select(
        "pos", "ip_address", "country_code", "abuse_confidence_score", "last_reported_at")


def q_distinct_ips(spark, sf_dir):
    return dedupe.distinct_ips(_reports(spark, sf_dir))


def q_top_n_latest(spark, sf_dir):
    return dedupe.top_n_latest(_reports(spark, sf_dir), n=100).select("pos", "ip_address", "last_reported_at")


def q_dedupe_latest(spark, sf_dir):
    return dedupe.dedupe_latest(_reports(spark, sf_dir).drop("pos"))


def q_last_wins(spark, sf_dir):
    return dedupe.last_wins(_reports(spark, sf_dir))


def q_latest_reported(spark, sf_dir):
    return analytics.latest_reported(_reports(spark, sf_dir), n=20)


# ------------------------------------------------------------- change control
def _state(spark, sf_dir, name):
    return standin.view(spark, sf_dir, name).select("pos", *changes.STATE_COLUMNS)


def _diff(spark, sf_dir):
    return changes.diff_snapshots(_state(spark, sf_dir, "v_prev"), _state(spark, sf_dir, "v_curr"))


def q_diff_new(spark, sf_dir):
    return _diff(spark, sf_dir).filter(F.col("change") == "new").select("ip_address")


def q_diff_removed(spark, sf_dir):
    return _diff(spark, sf_dir).filter(F.col("change") == "removed").select("ip_address")


def q_diff_changed(spark, sf_dir):
    return _diff(spark, sf_dir).filter(F.col("change") == "changed").select("ip_address")


def q_diff_summary(spark, sf_dir):
    return changes.diff_summary(_diff(spark, sf_dir))


def q_diff_samples(spark, sf_dir):
    return changes.diff_samples(_diff(spark, sf_dir))


def q_fingerprint(spark, sf_dir):
    prev = changes.fingerprint(_state(spark, sf_dir, "v_prev").drop("pos"))
    curr = changes.fingerprint(_state(spark, sf_dir, "v_curr").drop("pos"))
    return changes.snapshots_differ(prev, curr)


# Every text a feed may carry for a number, a flag or a list, spread over the customers.
ODD_VALUES = ["12.7", " 12 ", "\t12\n", "1e3", "nan", "-inf", "12d", "1_000", "", "  ", None, "yes", "\tyes", "N ", "maybe",
              '["a", "", " b", null]', "[bad", "[]", " x ", "99999999999"]


def q_odd_values(spark, sf_dir):
    """H1-H6: every odd spelling through the tolerant conversions, one row per customer."""
    values = F.array(*[F.lit(v).cast("string") for v in ODD_VALUES])
    v = standin.view(spark, sf_dir, "customer").select(
        "c_custkey", F.element_at(values, (F.col("c_custkey") % len(ODD_VALUES) + 1).cast("int")).alias("v"))
    return v.select("c_custkey", safe_int("v", 0).alias("as_int"), safe_float("v").cast("string").alias("as_float"),
                    safe_bool("v").alias("as_bool"), F.array_join(normalize_string_array("v"), "|").alias("as_list"))


CARRY_COLUMNS = ["ip", "status", "country_name", "city", "latitude", "longitude",
                 "first_ingestion_time", "seen_count"]


def carry_inputs(spark, sf_dir):
    """Old geo snapshot, wanted IPs, fetched records."""
    old = _parse(standin.raw_geo_json(spark, sf_dir), S.RAW_GEO_RECORD)
    cands = standin.abuse_reports(spark, sf_dir).select(F.col("ip_address").alias("ip"))
    return old, cands, parse_geo(standin.landed_responses(spark, sf_dir), RUN_TS)


def _carry(spark, sf_dir):
    return changes.carry_forward(*carry_inputs(spark, sf_dir))


def _carry_update(spark, sf_dir):
    """A run that fetches every candidate again: rows it knows are updated."""
    return changes.carry_forward(*carry_inputs(spark, sf_dir), update_existing=True)


def q_carry_update(spark, sf_dir):
    return _carry_update(spark, sf_dir)[0].select(*CARRY_COLUMNS)


def q_carry_update_counts(spark, sf_dir):
    return _carry_update(spark, sf_dir)[1]


def q_carry_forward(spark, sf_dir):
    return _carry(spark, sf_dir)[0].select(*CARRY_COLUMNS)


def q_carry_forward_counts(spark, sf_dir):
    return _carry(spark, sf_dir)[1]


# ------------------------------------------------------------- merge / store
PREV_RUN_TS = "2024-01-16T00:00:00.000000Z"


def _cut():
    return F.col("last_reported_at") < F.lit(standin.PREV_CUTOFF.replace(" ", "T"))


def stored_profiles(spark, sf_dir):
    """Profiles as stored after the run at the cutoff (reports before it)."""
    rep = standin.abuse_reports(spark, sf_dir).filter(_cut())
    return enrich_and_score(rep, standin.pulse_snapshot(spark, sf_dir),
                            standin.geo_snapshot(spark, sf_dir), run_ts=PREV_RUN_TS)


def incoming_profiles(spark, sf_dir):
    """The next batch (reports after the cutoff), enriched without a geo snapshot."""
    rep = standin.abuse_reports(spark, sf_dir).filter(~_cut())
    no_geo = spark.createDataFrame([], S.GEO)  # S5: no geo snapshot for this run
    return enrich_and_score(rep, standin.pulse_snapshot(spark, sf_dir), no_geo, run_ts=RUN_TS)


def merge_inputs(spark, sf_dir):
    """Stored profiles from the reports before the cutoff; an incoming batch from
    the reports after it, enriched without a geo snapshot (so COALESCE matters)."""
    return stored_profiles(spark, sf_dir), incoming_profiles(spark, sf_dir)


def q_merge_table(spark, sf_dir):
    e, i = merge_inputs(spark, sf_dir)
    return render(merge.merge_profiles(e, i, "table"))


def q_merge_document(spark, sf_dir):
    e, i = merge_inputs(spark, sf_dir)
    return render(merge.merge_profiles(e, i, "document", run_ts=RUN_TS))


def _saved(spark, sf_dir, policy):
    """Two batches merged into a new store under the shared folder, read back."""
    from ipscope.session import scratch_path
    from ipscope.sinks.store import ProfileStore
    store = ProfileStore(spark, scratch_path(spark, "store"), policy)
    e, i = merge_inputs(spark, sf_dir)
    store.merge(e, 0, PREV_RUN_TS)
    store.merge(i, 1, RUN_TS)
    return render(store.profiles())


def q_store_merge_table(spark, sf_dir):
    return _saved(spark, sf_dir, "table")


def q_store_merge_document(spark, sf_dir):
    return _saved(spark, sf_dir, "document")


def q_dual_save(spark, sf_dir):
    """K9: both batches saved to a table store and a document store; both read back."""
    from ipscope.session import scratch_path
    from ipscope.sinks.store import ProfileStore, save_profiles
    stores = [ProfileStore(spark, scratch_path(spark, "store"), p) for p in ("table", "document")]
    e, i = merge_inputs(spark, sf_dir)
    save_profiles(e, stores, 0, PREV_RUN_TS)
    save_profiles(i, stores, 1, RUN_TS)
    table, document = (render(s.profiles()) for s in stores)
    return table.withColumn("store", F.lit("table")).unionByName(document.withColumn("store", F.lit("document")))


def q_snapshot_write_read(spark, sf_dir):
    """The processed reports written as a run's partition, twice, and the newest run read back."""
    from ipscope.plans.jobs import latest_processed
    from ipscope.session import scratch_path
    from ipscope.sinks.store import write_snapshot
    root = scratch_path(spark, "processed")
    ab = normalize.normalize_abuse(raw_abuse(spark, sf_dir), RUN_TS, RUN_TS).drop("pos")
    write_snapshot(ab.limit(0), root, PREV_RUN_TS)
    for _ in range(2):  # a run that is run again replaces its rows
        write_snapshot(ab, root, RUN_TS)
    return latest_processed(spark, root).drop("run_id")


def q_envelope_records(spark, sf_dir):
    """One small document per report, as an envelope, a bare list, without data, or no JSON."""
    from ipscope.sources.snapshots import parse_envelope_text
    raw = standin.raw_abuse_json(spark, sf_dir)
    text = (F.when(F.col("pos") % 4 == 0, F.concat(F.lit('{"source":"feed","ingestion_time":"t","record_count":1,"data":['), "value", F.lit("]}")))
            .when(F.col("pos") % 4 == 1, F.concat(F.lit(" ["), "value", F.lit(","), "value", F.lit("]")))
            .when(F.col("pos") % 4 == 2, F.lit('{"source":"feed"}')).otherwise(F.lit("no json")))
    docs = raw.select(F.col("pos").alias("doc"), text.alias("value"))
    return parse_envelope_text(docs, S.RAW_ABUSE_RECORD).select(
        "doc", "pos", F.col("envelope_source").alias("source"), F.col("ipAddress").alias("ip_address"))


def q_raw_snapshot(spark, sf_dir):
    """K1/S3: two raw snapshots with their envelopes written, the newer one twice, and read back."""
    from ipscope.session import scratch_path
    from ipscope.sinks.store import read_raw_snapshot, write_raw_snapshot
    root = scratch_path(spark, "raw")
    raw = raw_abuse(spark, sf_dir).drop("pos")
    write_raw_snapshot(raw.limit(1), root, PREV_RUN_TS, "feed")
    for _ in range(2):
        write_raw_snapshot(raw, root, RUN_TS, "feed")
    return read_raw_snapshot(spark, root, raw.schema).select(
        "source", "ingestion_time", "record_count", F.col("ipAddress").alias("ip_address"),
        F.col("lastReportedAt").alias("last_reported_at"))


def q_state_gate(spark, sf_dir):
    """The gate before and after a commit, and the committed state in order of IP."""
    from ipscope.session import scratch_path
    from ipscope.sinks.state import SnapshotGate
    gate = SnapshotGate(spark, scratch_path(spark, "state"))
    prev, curr = _state(spark, sf_dir, "v_prev").drop("pos"), _state(spark, sf_dir, "v_curr").drop("pos")
    gate.commit(prev, "first", PREV_RUN_TS)
    rows = [("same", gate.detect(prev)), ("next", gate.detect(curr))]
    out = None
    for name, d in rows:
        part = d.select(F.lit(name).alias("step"), "changed", "new_ip_count", "changed_ip_count", "removed_ip_count")
        out = part if out is None else out.unionByName(part)
    return out


def q_geo_point(spark, sf_dir):
    g = standin.geo_snapshot(spark, sf_dir).withColumn("geo_location", geo_point())
    return g.select("ip_address", F.col("geo_location.lat").alias("lat"),
                    F.col("geo_location.lon").alias("lon"))


# ------------------------------------------------------------- lookup
def lookup_store(spark, sf_dir):
    """The store the lookups read: profiles of all reports, as of an earlier run."""
    return enrich_and_score(standin.abuse_reports(spark, sf_dir), standin.pulse_snapshot(spark, sf_dir),
                            standin.geo_snapshot(spark, sf_dir), run_ts=PREV_RUN_TS)


def _lookup(spark, sf_dir):
    e = lookup_store(spark, sf_dir)
    reqs = standin.view(spark, sf_dir, "customer").select(
        F.expr(standin.ip_of("c_custkey")).alias("ip"))
    return lookup.lookup(reqs, e, standin.landed_responses(spark, sf_dir), run_ts=RUN_TS)


def _hit_split(spark, sf_dir):
    reqs = standin.view(spark, sf_dir, "customer").select(F.expr(standin.ip_of("c_custkey")).alias("ip"))
    return lookup.split_hits(reqs, lookup_store(spark, sf_dir))


def q_lookup_hits(spark, sf_dir):
    return _hit_split(spark, sf_dir)[0]


def q_lookup_misses(spark, sf_dir):
    return _hit_split(spark, sf_dir)[1]


def q_lookup_profile(spark, sf_dir):
    return render(_lookup(spark, sf_dir)[0])


def q_display_profile(spark, sf_dir):
    return lookup.display_profile(_lookup(spark, sf_dir)[0])


# ------------------------------------------------------------- spikes
def q_country_spikes(spark, sf_dir):
    rep = standin.view(spark, sf_dir, "v_abuse")
    return render(analytics.country_spikes(rep))


# ------------------------------------------------------------- IPs, lists, recency
def _ip_candidates(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    toks = textscan.ip_tokens(docs).select(F.col("ip_token").alias("ip"))
    reps = standin.abuse_reports(spark, sf_dir).select(F.col("ip_address").alias("ip"))
    return toks.unionByName(reps).unionByName(standin.view(spark, sf_dir, "v_typed_ip")).distinct()


def q_ip_version(spark, sf_dir):
    from ipscope.functions.ip import ip_version
    return _ip_candidates(spark, sf_dir).select("ip", ip_version("ip").alias("ip_version"))


def q_valid_ip_filter(spark, sf_dir):
    from ipscope.functions.ip import is_valid_ip
    return _ip_candidates(spark, sf_dir).filter(is_valid_ip("ip"))


def q_first_n_distinct(spark, sf_dir):
    return dedupe.first_n_distinct(_reports(spark, sf_dir), n=100)


def q_point_lookup(spark, sf_dir):
    return render(lookup.point_lookup(lookup_store(spark, sf_dir), " 10.0.0.1 "))


def q_pulse_responses(spark, sf_dir):
    from ipscope.sources.responses import parse_pulses
    raw = parse_pulses(standin.landed_responses(spark, sf_dir), RUN_TS)
    return render(normalize.normalize_pulses(raw, RUN_TS, RUN_TS))


RECENT_DAYS = 10  # shorter than the feed's rule, so that the reports of the test month are on both sides


def q_recent_report_counts(spark, sf_dir):
    rep = standin.view(spark, sf_dir, "v_abuse")
    return render(analytics.recent_report_counts(rep, RUN_TS, RECENT_DAYS))


def _versions(spark, sf_dir):
    """Stored profiles as the base and the next batch as a delta."""
    e, i = merge_inputs(spark, sf_dir)
    rows = lambda df, ts, delta: df.selectExpr(
        "*", f"CAST({ts} AS TIMESTAMP) AS _merge_ts", "false AS _keep", f"{merge.version_order(delta, f'CAST({ts} AS TIMESTAMP)', repr('w'), '0')} AS _ord")
    return rows(e, "NULL", 0).unionByName(rows(i, f"'{RUN_TS}'", 1))


def q_merge_on_read_table(spark, sf_dir):
    return render(merge.resolve_versions(_versions(spark, sf_dir), "table"))


def q_merge_on_read_document(spark, sf_dir):
    return render(merge.resolve_versions(_versions(spark, sf_dir), "document"))


def q_snapshot_manifest(spark, sf_dir):
    from ipscope.sinks.store import snapshot_manifest
    ab = normalize.normalize_abuse(raw_abuse(spark, sf_dir), RUN_TS, RUN_TS)
    return (snapshot_manifest(ab, "abuse_blacklist", RUN_TS)
            .unionByName(snapshot_manifest(standin.pulse_snapshot(spark, sf_dir), "pulses", RUN_TS))
            .unionByName(snapshot_manifest(standin.geo_snapshot(spark, sf_dir), "geo", RUN_TS)))


def q_publish_roundtrip(spark, sf_dir):
    """K4 + S7: processed rows published as JSON values, then parsed as the stream does."""
    from ipscope.streaming.enrich_stream import parse_values
    ab = normalize.normalize_abuse(raw_abuse(spark, sf_dir), RUN_TS, RUN_TS).drop("pos")
    values = ab.select(F.to_json(F.struct(*ab.columns), {"ignoreNullFields": "false"}).alias("value"))
    return parse_values(values).drop("raw_value")


def _utc(fn):
    """Rendered timestamps are UTC text: pin the session zone before building."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from ipscope.plans import flows, snapshots, values
    return {k: _utc(v) for k, v in (_QUERIES | flows.QUERIES | snapshots.QUERIES | values.QUERIES).items()}


_QUERIES = {
        "left_enrich": q_left_enrich,
        "risk_score": q_risk_score,
        "status_counts": q_status_counts,
        "country_counts": q_country_counts,
        "score_histogram": q_score_histogram,
        "abuse_by_status": q_abuse_by_status,
        "normalize_abuse": q_normalize_abuse,
        "normalize_pulses": q_normalize_pulses,
        "normalize_geo": q_normalize_geo,
        "safe_casts": q_safe_casts,
        "document_keywords": q_document_keywords,
        "document_ips": q_document_ips,
        "attack_classify": q_attack_classify,
        "distinct_ips": q_distinct_ips,
        "top_n_latest": q_top_n_latest,
        "dedupe_latest": q_dedupe_latest,
        "last_wins": q_last_wins,
        "latest_reported": q_latest_reported,
        "diff_new": q_diff_new,
        "diff_removed": q_diff_removed,
        "diff_changed": q_diff_changed,
        "diff_summary": q_diff_summary,
        "diff_samples": q_diff_samples,
        "fingerprint": q_fingerprint,
        "carry_forward": q_carry_forward,
        "carry_forward_counts": q_carry_forward_counts,
        "merge_table": q_merge_table,
        "merge_document": q_merge_document,
        "geo_point": q_geo_point,
        "lookup_profile": q_lookup_profile,
        "display_profile": q_display_profile,
        "country_spikes": q_country_spikes,
        "ip_version": q_ip_version,
        "valid_ip_filter": q_valid_ip_filter,
        "first_n_distinct": q_first_n_distinct,
        "point_lookup": q_point_lookup,
        "pulse_responses": q_pulse_responses,
        "recent_report_counts": q_recent_report_counts,
        "high_risk_ips": q_high_risk_ips,
        "lookup_hits": q_lookup_hits,
        "lookup_misses": q_lookup_misses,
        "merge_on_read_table": q_merge_on_read_table,
        "merge_on_read_document": q_merge_on_read_document,
        "snapshot_manifest": q_snapshot_manifest,
        "publish_roundtrip": q_publish_roundtrip,
        "odd_values": q_odd_values,
        "carry_update": q_carry_update,
        "carry_update_counts": q_carry_update_counts,
        "store_merge_table": q_store_merge_table,
        "store_merge_document": q_store_merge_document,
        "dual_save": q_dual_save,
        "snapshot_write_read": q_snapshot_write_read,
        "state_gate": q_state_gate,
        "envelope_records": q_envelope_records,
        "raw_snapshot": q_raw_snapshot,
}
