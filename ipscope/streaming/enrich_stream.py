"""Structured Streaming enrichment job (S6, S7, K7, X1..X7).

    source (kafka / files) -> value as text
      -> foreachBatch:
           one pass over the micro-batch: parse, reason codes, good and quarantine folders
           static side: the newest snapshots, or those pinned at start-up (X3)
           enrich + classify + score the batch's good rows (one shuffle by ip)
           merge into each profile store under its policy

Nothing is collected to the driver: the callback only composes DataFrames and
issues writes, each into a folder of its batch number.  Offsets are committed by
the checkpoint after the callback returns; a replayed batch replaces what it wrote (X2).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ipscope.operators.enrich import enrich_and_score
from ipscope.operators.quarantine import judge_values, land, landed
from ipscope.session import scratch_path
from ipscope.sinks.store import ProfileStore

#: A snapshot fixed when the query starts, or a function that finds the newest one for each batch.
Snapshot = DataFrame | Callable[[], DataFrame]


def read_source(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                options: dict | None = None) -> DataFrame:
    """A streaming source with a ``value`` column (Kafka, or text files for tests).

    A first run on Kafka starts with the backlog unless ``options`` says otherwise.
    """
    if fmt == "kafka":
        return spark.readStream.format(fmt).options(**{"startingOffsets": "earliest", **(options or {})}).load()
    return spark.readStream.format(fmt).options(**(options or {})).load(path)


def parse_values(raw: DataFrame, value: str = "value") -> DataFrame:
    """Value -> text -> JSON record, keeping the raw text."""
    return judge_values(raw, value).drop("reason")


def _now(snapshot: Snapshot) -> DataFrame:
    return snapshot if isinstance(snapshot, DataFrame) else snapshot()


def make_batch_fn(stores: list[ProfileStore], pulses: Snapshot, geo: Snapshot, landing: str,
                  run_ts: str | None = None, writer: str = "stream", preserve_missing: bool = False):
    """The ``foreachBatch`` callback.

    ``writer`` names the query to the stores: its batch numbers are its own.  ``landing``
    gets the batch's rows by outcome; its good rows are read back from there, so the
    source is read once and the stores need no cache of it.  ``preserve_missing`` keeps
    stored values for IPs that the snapshots do not cover (Q6).
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        land(judge_values(batch), landing, batch_id)
        good = landed(spark, landing, "good", batch_id).drop("raw_value", "reason")
        if good.isEmpty():  # S11: skip micro-batches without a good row
            return
        # Scored once per store, from the landed rows: nothing of the batch is held in memory.
        profiles = enrich_and_score(good, _now(pulses), _now(geo), run_ts=run_ts, preserve_missing=preserve_missing)
        for store in stores:
            store.merge(profiles, batch_id, run_ts, writer)

    return process


def start_enrichment(spark: SparkSession, source: DataFrame, stores: list[ProfileStore],
                     pulses: Snapshot, geo: Snapshot, checkpoint: str, landing: str | None = None,
                     trigger: dict | None = None, run_ts: str | None = None, preserve_missing: bool = False):
    """Start the append-mode micro-batch query; returns the StreamingQuery.

    The writer's name is the checkpoint's path: a query with a new checkpoint numbers
    its batches anew and is a new writer.  A snapshot given as a DataFrame is pinned for
    the life of the query, one given as a function is looked up for every batch (X3).
    """
    fn = make_batch_fn(stores, pulses, geo, landing or scratch_path(spark, "landing"), run_ts, f"stream:{checkpoint}", preserve_missing)
    w = (source.select("value").writeStream.foreachBatch(fn)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def country_spike_stream(parsed: DataFrame, ts: str = "last_reported_at", window: str = "1 hour",
                         slide: str | None = None, watermark: str = "1 hour") -> DataFrame:
    """Report counts per (window, country) with a watermark; late rows are dropped.

    Columns window, country_code, reports.  Windows tumble, or slide by ``slide``.  A window
    is written out, once, when the watermark (the latest time seen before the batch, less
    ``watermark``) has passed its end; a row that is in closed windows only is dropped.  Rows
    whose time cannot be read are dropped as well.
    """
    t = F.try_to_timestamp(F.col(ts))
    w = F.window("event_ts", window, slide) if slide else F.window("event_ts", window)
    return (parsed.withColumn("event_ts", t).filter(F.col("event_ts").isNotNull())
            .withWatermark("event_ts", watermark)
            .groupBy(w.alias("window"), F.col("country_code"))
            .agg(F.count("*").alias("reports")))


def write_closed_windows(counts: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Append closed windows to a Parquet folder (each exactly once); returns the StreamingQuery."""
    flat = counts.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "country_code", "reports")
    w = flat.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(**trigger) if trigger else w).start()
