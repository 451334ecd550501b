"""End-to-end jobs composed from the operators.

* ``run_daily`` — entry point A: newest raw blacklist envelope -> normalise ->
  change gate -> (when changed) processed snapshot + publish + commit state.
  The state is committed last, after every output is written, so a failed run
  is simply re-run.
* ``run_lookup`` — entry point C: a table of requested IPs answered from the
  profile stores and landed responses, then saved to every store (K9).

* ``run_enrichment_batch`` — entry point B as a batch over landed reports; the
  streaming form is ``streaming.enrich_stream.start_enrichment``.
Every step takes explicit paths; nothing is read "latest" twice within a run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ipscope import schemas as S
from ipscope.operators.lookup import lookup
from ipscope.operators.normalize import normalize_abuse, normalize_state
from ipscope.sinks.state import SnapshotGate
from ipscope.sinks.store import ProfileStore, publish_json, run_id_of, save_profiles, write_snapshot
from ipscope.session import checkpoint_root
from ipscope.sources.snapshots import newest_file, newest_run, read_envelope, read_json_lines, read_run


def run_daily(spark: SparkSession, raw_root: str, processed_root: str, state_path: str,
              publish_path: str | None, run_ts: str, publish_format: str = "text",
              publish_options: dict | None = None, raw_format: str = "envelope") -> dict:
    """Gate, transform and publish the newest raw blacklist snapshot.

    ``raw_format`` is ``envelope`` (one JSON document, one task) or ``lines`` (JSON
    lines, read by as many tasks as the file has splits).

    Returns a small summary dict (one bounded row of counters).
    """
    raw_path = newest_file(spark, raw_root, ".json")
    if raw_path is None:
        raise FileNotFoundError(f"no raw blacklist snapshot under {raw_root}")  # S11
    read = {"envelope": read_envelope, "lines": read_json_lines}[raw_format]
    raw = read(spark, raw_path, S.RAW_ABUSE_RECORD).persist()
    try:
        gate = SnapshotGate(spark, state_path)
        decision = gate.detect(normalize_state(raw)).first().asDict()
        summary = {"source_object_name": raw_path, **decision}
        if not decision["changed"]:
            return summary
        processed = normalize_abuse(raw, None, run_ts).drop("pos")
        counted = write_snapshot(processed, processed_root, run_ts, required=True)    # K2, S11
        if publish_path is not None or publish_format == "kafka":
            publish_json(processed, publish_format, publish_path, publish_options,
                         run_id=run_id_of(run_ts))                   # K4
        summary["record_count"] = counted["record_count"]
        gate.commit(normalize_state(raw), raw_path, run_ts)                           # K8, last
        return summary
    finally:
        raw.unpersist()


def run_lookup(spark: SparkSession, requests: DataFrame, stores: list[ProfileStore],
               responses: DataFrame, batch_id: int, run_ts: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Answer requests from the first store + landed responses, then save to all stores."""
    from ipscope.operators.lookup import split_requests
    valid, _ = split_requests(requests)
    known = stores[0].rows_for(valid)
    profiles, invalid = lookup(requests, known, responses, run_ts)
    # Fix the answer before the save changes the store it was computed from:
    # a reliable checkpoint in the shared folder (survives executor loss).
    checkpoint_root(spark)
    profiles = profiles.checkpoint(eager=True)
    save_profiles(profiles, stores, batch_id, run_ts, writer="lookup", keep_old_enriched_at=True)
    return profiles, invalid


def run_enrichment_batch(spark: SparkSession, reports: DataFrame, pulses: DataFrame, geo: DataFrame,
                         stores: list[ProfileStore], batch_id: int, run_ts: str | None = None,
                         dead_letter_path: str | None = None) -> DataFrame:
    """Entry point B as a batch: enrich one landed report set and merge it into every store.

    Same steps as one streaming micro-batch (quarantine, enrich, score, merge);
    returns the scored profiles of this batch, fixed by a reliable checkpoint.
    """
    from ipscope.operators.enrich import enrich_and_score, split_dead_letters
    ok, bad = split_dead_letters(reports)
    if dead_letter_path:
        (bad.withColumn("batch_id", F.lit(int(batch_id)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").json(dead_letter_path))
    checkpoint_root(spark)
    profiles = enrich_and_score(ok, pulses, geo, run_ts=run_ts).checkpoint(eager=True)
    save_profiles(profiles, stores, batch_id, run_ts, writer="batch")
    return profiles


def latest_processed(spark: SparkSession, processed_root: str, schema: StructType = S.ABUSE) -> DataFrame:
    """The newest processed run, with its ``year``, ``month``, ``day`` and ``run_id`` as written ('02', not 2).

    The newest run is found among the folder names (``newest_run``), so only its files
    are opened, and the schema is given, so that no session setting can infer another
    type for a partition column.  No run at all gives an empty table.
    """
    return read_run(spark, processed_root, newest_run(spark, processed_root), schema)
